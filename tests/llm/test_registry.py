"""Every operator has one query; each is tested against SQL or a named brute-force test."""

import re
from pathlib import Path

from __spark_entry__ import oracle_sql, queries

BRUTE_FORCE = {
    "op1": "test_models.py",
    "op2": "test_models.py",
    "op4": "test_native.py",
    "op5": "test_join_dedup.py",
    "op6": "test_bpe_packing_rules.py",
    "op7": "test_bpe_packing_rules.py",
    "op8": "test_native.py",
    "pipeline": "test_pipeline.py",
}


def test_every_operator_is_registered_and_tested():
    names = {re.match(r"op\d+", n)[0] for n in queries() if re.match(r"op\d+_", n)}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in queries()
    with_sql = {re.match(r"op\d+", n)[0] for n in oracle_sql() if re.match(r"op\d+_", n)}
    assert names | {"pipeline"} == with_sql | set(BRUTE_FORCE) and not with_sql & set(BRUTE_FORCE)
    assert all((Path(__file__).parent / f).exists() for f in BRUTE_FORCE.values())


def test_sql_of_the_operators_equals_their_queries(spark, sf_dir):
    from tests.oracle_compare import compare, duck

    con, sql = duck(sf_dir), oracle_sql()
    for name, run in queries().items():
        if re.match(r"op\d+_", name) and name in sql:
            result, *_ = compare(spark, con, sf_dir, name, run, sql[name])
            assert result.startswith("ok"), (name, result)
