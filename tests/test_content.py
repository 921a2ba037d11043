"""The registered queries show something: each flag, reason and check has zero and non-zero rows."""

import pytest

from tickerloom.functions.text import UNIVERSE_RULES
from tickerloom.plans.catalog import ORACLES

from .oracle_compare import duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows():
    con = duck(SF)

    def of(name):
        cursor = con.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        return [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]

    return of


@pytest.mark.parametrize(
    "name,flags",
    [
        ("c06_screen_wide_bands", "abcdefgh"),
        ("c04_weekly_flags_wide_bands", "gh"),
        ("p12_p13_daily_flags_wide_bands", "ef"),
        ("c09_screen_fundamentals_relaxed", ("a", "b", "ab")),
    ],
)
def test_flags_are_set_and_unset(rows, name, flags):
    got = rows(name)
    for flag in flags:
        values = {r[f"flag_{flag}"] for r in got}
        assert values == {True, False}, flag


def test_every_reason_occurs_alone_and_with_others(rows):
    assert {r["reason"] for r in rows("a19_company_reason_counts")} == {r[0] for r in UNIVERSE_RULES}
    reasons = {r["exclusion_reason"] for r in rows("c10_security_master")}
    assert "" in reasons and any(";" in r for r in reasons) and any(r and ";" not in r for r in reasons)


@pytest.mark.parametrize(
    "sound,broken", [("q08_outcome_integrity", "q08_broken_outcomes"), ("q09_confirmation_timing", "q09_broken_timing"), ("q04_future_field_checks", "q04_broken_future_fields")]
)
def test_checks_fail_on_broken_rows_only(rows, sound, broken):
    good, bad = ({r["check_name"]: r["failures"] for r in rows(n)} for n in (sound, broken))
    assert set(good) == set(bad)
    assert all(v > 0 for v in bad.values()), bad
    assert sum(v == 0 for v in good.values()) >= len(good) - 1


def test_filter_changes_counts(rows):
    counts = rows("a18_flag_counts")
    assert any(r["before_filter"] > r["after_filter"] > 0 for r in counts)
    assert {r["week_end_count"] for r in rows("q02_broken_week_ends")} == {1, 2}
    assert {r["failures"] > 0 for r in rows("q05_load_checks")} == {True, False}
    outputs = {r["output"]: (r["row_count"], r["excluded_rows"]) for r in rows("s20_screen_outputs")}
    assert outputs["unfiltered"][0] == outputs["parquet"][0] + outputs["excluded"][0] and outputs["excluded"][1] > 0
