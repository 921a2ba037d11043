"""Every registered query against its SQL counterpart on the small driver tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_compare import compare, duck
from tickerloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    result, *_ = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
    assert result.startswith("ok"), result


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_has_a_stable_schema(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
