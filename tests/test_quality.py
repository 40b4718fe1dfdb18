import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrload import schemas
from zephyrload.operators import gaps, lookups, quality

RULES = {"valid_a": "a IS NOT NULL", "valid_b": "b > 0"}


def test_expectations_drop_and_count(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (1, None), (1, -1), (None, None)], "a int, b int")
    assert rows(quality.expect(df, RULES)) == [(1, 1)]
    assert quality.expect(df, {}).count() == 5
    assert quality.violations(df, RULES).first().asDict() == {"valid_a": 2, "valid_b": 3, "dropped_rows": 4, "all_rows": 5}


def test_declared_rules():
    contracts = [c for c in vars(schemas).values() if isinstance(c, schemas.Contract)]
    rules = {c.name: len(c.expectations) for c in contracts if c.expectations}
    assert sum(n for name, n in rules.items() if name.startswith("silver.dim")) == 8
    assert sum(n for name, n in rules.items() if name.startswith("silver.fact")) == 8
    assert sum(len(c.references) for c in contracts) == 9
    assert schemas.FACT_WEATHER.expectations == {
        "valid_observed_at_utc": "observed_at_utc IS NOT NULL", "valid_station_id": "station_id IS NOT NULL"
    }


def test_key_and_reference_audits(spark):
    counties = spark.createDataFrame([("Z1", "1"), ("Z2", "1"), ("Z1", "2")], "state_zone string, fips string")
    assert rows(quality.key_audit(counties, ["fips"])) == [("1", 2)]
    facts = spark.createDataFrame([("J",), ("X",), ("X",), (None,)], "zone string")
    dim = spark.createDataFrame([("J",), ("J",)], "nyiso_zone string")
    assert rows(quality.reference_audit(facts, "zone", dim, "nyiso_zone")) == [("X", 2)]


def test_acceptance(spark):
    model = spark.createDataFrame(
        [(date(2026, 7, 1), "J"), (date(2026, 7, 1), "J"), (date(2026, 7, 2), "Overall"), (date(2026, 7, 2), None)], "d date, z string"
    )
    dim = spark.createDataFrame([("J",)], "zone string")
    report = quality.acceptance(model, ["d", "z"], "d", 2, "z", dim, "zone")
    assert {r.check_name: (r.passed, r.detail) for r in report.collect()} == {
        "not_empty": (True, 4), "one_row_per_grain": (False, 1), "grain_known": (False, 1),
        "no_overall_row": (False, 1), "expected_days": (True, 2), "keys_matched": (False, 1),
    }
    empty = quality.acceptance(model.limit(0), ["d", "z"], "d", 2)
    assert {r.check_name: r.passed for r in empty.collect()}["not_empty"] is False


@pytest.mark.parametrize("seed", range(3))
def test_missing_hours(spark, session_zone, seed):
    draw = random.Random(seed)
    start = datetime(2026, 3, 7)
    name = lambda h: (start + timedelta(hours=h)).strftime("%Y-%m-%dT%H")
    present = {(s, draw.randrange(-5, 60)) for s in "abc" for _ in range(draw.randrange(1, 40))} | {("early", -3), ("late", 90)}
    df = spark.createDataFrame([(s, name(h)) for s, h in present for _ in (0, 1)] + [("a", None)], "s string, k string")
    got = gaps.missing_hours(df, ["s"], "k", name(0), name(50))
    series = {s for s, _ in present}
    assert rows(got) == sorted((s, name(h)) for s in series for h in range(51) if (s, h) not in present)


def test_hours_per_local_day(spark, session_zone):
    from zephyrload.functions.timekeys import hour_spine

    feed = hour_spine(spark, "2026-03-07T05", "2026-03-10T03").withColumn("s", F.lit("a"))
    twice = feed.unionByName(feed)
    assert rows(gaps.hours_per_local_day(twice, ["s"], "hour_key")) == [
        ("a", date(2026, 3, 7), 24, True), ("a", date(2026, 3, 8), 23, True), ("a", date(2026, 3, 9), 24, True),
    ]


def test_distinct_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "x string, y int")
    assert lookups.distinct_counts(df, ["x", "y"]).first().asDict() == {"distinct_x": 2, "distinct_y": 2}
    assert lookups.distinct_counts(df, ["x"], 0.05).first().asDict() == {"distinct_x": 2}


def test_conformed_join_disappears(spark):
    left = spark.createDataFrame([("J", "n")], "code string, name string")
    right = spark.createDataFrame([("J", "a"), ("J", "b")], "zone string, label string")
    out = lookups.conformed_zones(left, right, {"code": "zone"}, {"zone": "code", "zone_name": "name"})
    assert rows(out) == [("J", "n")]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_acceptance_counts_codes_outside_the_grain(spark):
    """Codes of rows that share a grain row; a NULL code is no orphan, a repeated dimension row adds none."""
    model = spark.createDataFrame([("d1", "a", 1), ("d1", "x", 2), ("d2", "x", 3), ("d2", None, 4)], "d string, c string, n int")
    dim = spark.createDataFrame([("a",), ("a",)], "code string")
    report = {r.check_name: r.detail for r in quality.acceptance(model, ["d"], "d", 2, "c", dim, "code").collect()}
    assert report == {"not_empty": 4, "one_row_per_grain": 2, "grain_known": 0, "no_overall_row": 0, "expected_days": 2, "keys_matched": 2}
