import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrload.operators import dedupe, upserts
from zephyrload.sources.tables import create_layers
from zephyrload.streaming import incremental

PAGE = "target_dt string, page bigint, response_hash string, body string"
KEYS = ["target_dt", "page"]


def pages(spark, *items):
    return spark.createDataFrame(list(items), PAGE)


def test_upsert_replaces_only_changed_rows(spark):
    target = pages(spark, ("h1", 1, "a", "old"), ("h2", 1, "b", "old"), ("h3", 1, "c", "old"), (None, 1, "n", "old"), ("h5", 1, None, "old"))
    source = pages(spark, ("h1", 1, "a", "new"), ("h2", 1, "B", "new"), ("h4", 1, "d", "new"), (None, 1, "n", "new"), ("h5", 1, "x", "new"))
    merged = upserts.upsert_if_changed(target, source, KEYS)
    assert rows(merged, "target_dt", "body") == [
        ("h1", "old"), ("h2", "new"), ("h3", "old"), ("h4", "new"), ("h5", "old"), (None, "new"), (None, "old")
    ]
    no_nulls = source.dropna(subset=KEYS)
    again = upserts.upsert_if_changed(merged.dropna(subset=KEYS), no_nulls, KEYS)
    assert rows(again) == rows(merged.dropna(subset=KEYS))


def test_failed_page_may_keep_the_good_one(spark):
    target = pages(spark, ("h1", 1, "a", "good"))
    source = pages(spark, ("h1", 1, "e", "failed"), ("h2", 1, "e", "failed"))
    keep = F.col("body") == "failed"
    assert rows(upserts.upsert_if_changed(target, source, KEYS, keep_good=keep), "target_dt", "body") == [("h1", "good"), ("h2", "failed")]
    assert rows(upserts.upsert_if_changed(target, source, KEYS), "target_dt", "body") == [("h1", "failed"), ("h2", "failed")]


def test_staged_batch_does_not_shuffle_the_target(spark):
    target = upserts.staged(
        spark.range(1000).selectExpr("cast(id as string) target_dt", "1L page", "'a' response_hash", "'x' body"), "target"
    )
    batch = upserts.staged(pages(spark, ("1", 1, "b", "y"), ("new", 1, "c", "z")), "batch")
    changed = upserts.staged(upserts.changed_rows(target, batch, KEYS), "changed")
    merged = upserts.with_changes(target, changed, KEYS)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "hashpartitioning" not in plan
    assert merged.count() == 1001 and merged.filter("body <> 'x'").count() == 2


def test_load_changed_through_a_table(spark):
    create_layers(spark)
    first = pages(spark, ("h1", 1, "a", "1"), ("h2", 1, "b", "1"))
    second = pages(spark, ("h2", 1, "B", "2"), ("h3", 1, "c", "2"))
    upserts.load_changed(spark, first, "landing.raw_test", KEYS, comment="it's raw")
    for _ in range(2):
        upserts.load_changed(spark, second, "landing.raw_test", KEYS)
    assert rows(spark.table("landing.raw_test"), "target_dt", "body") == [("h1", "1"), ("h2", "2"), ("h3", "2")]
    generations = spark.sql("show tables in landing like 'raw_test__*'").count()
    assert generations == 2
    with pytest.raises(ValueError, match="repeats keys"):
        upserts.load_changed(spark, second.unionByName(second), "landing.raw_test", KEYS)
    assert rows(spark.table("landing.raw_test"), "target_dt", "body") == [("h1", "1"), ("h2", "2"), ("h3", "2")]


READING = "state_zone string, fips string, observed_at_utc timestamp_ntz, temperature double"
READING_KEYS = ["state_zone", "fips", "observed_at_utc"]


def readings(spark, *items):
    day = datetime(2026, 7, 1)
    return spark.createDataFrame([("Z", f, day + timedelta(hours=h), t) for f, h, t in items], READING)


def test_insert_only_never_updates(spark):
    target = readings(spark, ("1", 0, 10.0))
    source = readings(spark, ("1", 0, 99.0), ("1", 1, 11.0), ("1", 1, 12.0), ("2", 0, 13.0))
    merged = upserts.insert_only(target, source, READING_KEYS, ["temperature"])
    assert rows(merged, "fips", "temperature") == [("1", 10.0), ("1", 11.0), ("2", 13.0)]
    assert rows(upserts.insert_only(merged, source, READING_KEYS, ["temperature"])) == rows(merged)


def test_load_new_appends_once(spark):
    create_layers(spark)
    by_day = lambda df: df.withColumn("utc_day", F.to_date("observed_at_utc"))
    first = by_day(readings(spark, ("1", 0, 10.0), ("1", 30, 10.5)))
    second = by_day(readings(spark, ("1", 0, 99.0), ("1", 1, 11.0), ("2", 50, 13.0)))
    for batch in (first, second, second, first, first.limit(0)):
        upserts.load_new(spark, batch, "bronze.readings_test", READING_KEYS, "utc_day", ["temperature"])
    assert rows(spark.table("bronze.readings_test"), "fips", "temperature") == [("1", 10.0), ("1", 10.5), ("1", 11.0), ("2", 13.0)]


def test_high_water(spark, session_zone):
    at = datetime(2026, 7, 1, 12)
    source = spark.createDataFrame(
        [("A", at), ("A", at - timedelta(minutes=1)), ("A", at + timedelta(minutes=1)), ("B", datetime(2025, 1, 1)), ("B", datetime(2024, 12, 31, 23, 59))],
        "station_id string, observed_at_utc timestamp_ntz",
    )
    stored = spark.createDataFrame([("A", at), ("A", at - timedelta(days=1))], source.schema)
    latest = upserts.latest_per_series(stored, "station_id", "observed_at_utc")
    fresh = upserts.newer_than_stored(source, latest, "station_id", "observed_at_utc", "2025-01-01")
    assert rows(fresh) == [("A", at + timedelta(minutes=1)), ("B", datetime(2025, 1, 1))]
    assert rows(upserts.load_summary(fresh, latest, "station_id", "observed_at_utc"), "station_id", "new_rows", "previous_max") == [
        ("A", 1, at), ("B", 1, None)
    ]


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(5000).selectExpr("id % 3 as k", "id as v", "cast(null as int) as n")
    first = dedupe.keep_first(df, ["k"], ["v"])
    assert rows(first, "k", "v") == [(0, 0), (1, 1), (2, 2)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def replayed(log):
    """Hash-guarded upserts of the log, one row at a time."""
    table = {}
    for key, at, digest in sorted(log, key=lambda r: (r[1], r[2])):
        if key not in table or table[key][1] != digest:
            table[key] = (at, digest)
    return sorted((k, *v) for k, v in table.items())


@pytest.mark.parametrize("seed", range(4))
def test_current_rows_replays_upserts(spark, seed):
    draw = random.Random(seed)
    start = datetime(2026, 7, 1)
    log = {(draw.choice("kkkkkxyz"), start + timedelta(hours=draw.randrange(12)), draw.choice("abc")) for _ in range(40)}
    df = spark.createDataFrame(sorted(log), "target_dt string, request_timestamp timestamp_ntz, response_hash string")
    assert rows(incremental.current_rows(df, ["target_dt"])) == replayed(log)


def test_current_rows_keeps_null_keys(spark):
    at = datetime(2026, 7, 1)
    df = spark.createDataFrame([(None, at, "a"), (None, at, "a"), ("k", at, "a")], "target_dt string, request_timestamp timestamp_ntz, response_hash string")
    assert incremental.current_rows(df, ["target_dt"]).count() == 3


def test_stream_reads_each_file_once(spark, tmp_path):
    import json

    def deliver(name, hour, value):
        body = json.dumps({"response": {"data": [{"value": value}]}})
        row = {"run_id": "r", "request_timestamp": f"2026-07-0{name}T00:00:00Z", "target_dt": hour, "offset_start": 0, "status_code": 200, "status": "OK", "body": body}
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}-{hour}.json").write_text(json.dumps(row))
        incremental.append_new_responses(spark, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "cp"))
        return incremental.read_log(spark, str(tmp_path / "log"))

    assert deliver(1, "2026-07-01T00", 5).count() == 1
    assert deliver(2, "2026-07-01T00", 5).count() == 2
    log = deliver(3, "2026-07-01T01", 6)
    current = incremental.current_rows(log, KEYS)
    assert rows(current, "target_dt", F.dayofmonth("request_timestamp")) == [("2026-07-01T00", 1), ("2026-07-01T01", 3)]
    incremental.append_new_responses(spark, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "cp"))
    assert incremental.read_log(spark, str(tmp_path / "log")).count() == 3
    assert incremental.first_rows(log, KEYS, ["request_timestamp"]).count() == 2
