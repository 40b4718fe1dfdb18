from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrload.functions import timekeys as tk


def ntz(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").withColumn("u", F.col("t").cast("timestamp_ntz"))


def test_nearest_hour(spark, session_zone):
    df = ntz(
        spark, "2026-07-01 10:29:59.999999", "2026-07-01 10:30:00", "2026-07-01 10:51:00",
        "2026-07-01 23:45:00", "2026-12-31 23:30:00", "2026-03-08 02:10:00",
    )
    got = [r[0] for r in df.select(tk.nearest_hour_key(F.col("u"))).collect()]
    assert got == [
        "2026-07-01T10", "2026-07-01T11", "2026-07-01T11", "2026-07-02T00", "2027-01-01T00", "2026-03-08T02",
    ]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "Asia/Kathmandu"])
def test_local_date_matches_calendar(spark, session_zone, zone):
    keys = tk.hour_spine(spark, "2025-12-30T00", "2026-12-02T23")
    got = dict(keys.select("hour_key", tk.local_date(F.col("hour_key"), zone)).collect())
    assert len(got) == 338 * 24
    for key, day in got.items():
        at = datetime.strptime(key, "%Y-%m-%dT%H").replace(tzinfo=timezone.utc)
        assert day == at.astimezone(ZoneInfo(zone)).date()


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Australia/Lord_Howe"])
def test_first_key_of_day_bounds_the_day(spark, session_zone, zone):
    keys = tk.hour_spine(spark, "2026-01-01T00", "2026-12-31T23").withColumn("d", tk.local_date(F.col("hour_key"), zone))
    firsts = keys.groupBy("d").agg(F.min("hour_key").alias("first"))
    # the spine starts within the first of these days
    whole = firsts.filter(F.col("d") > firsts.agg(F.min("d")).first()[0])
    assert whole.count() >= 364
    assert whole.filter(tk.first_key_of_local_day(F.col("d"), zone) != F.col("first")).count() == 0


def test_clock_change_days_have_23_and_25_hours(spark, session_zone):
    keys = tk.hour_spine(spark, "2026-01-01T05", "2027-01-01T04").withColumn("d", tk.local_date(F.col("hour_key")))
    hours = dict(keys.groupBy("d").count().collect())
    assert hours.pop(date(2026, 3, 8)) == 23
    assert hours.pop(date(2026, 11, 1)) == 25
    assert set(hours.values()) == {24} and len(hours) == 363


def test_spine_includes_both_ends(spark):
    assert rows(tk.hour_spine(spark, "2026-02-28T22", "2026-03-01T01")) == [
        ("2026-02-28T22",), ("2026-02-28T23",), ("2026-03-01T00",), ("2026-03-01T01",)
    ]
    assert rows(tk.hour_spine(spark, "2026-03-01T01", "2026-03-01T00")) == []


def test_instants_and_texts_become_utc(spark, session_zone):
    at = datetime(2026, 11, 1, 5, 30, 0, 250000, tzinfo=timezone.utc)
    moments = [(at + timedelta(minutes=30 * i),) for i in range(4)]
    df = spark.createDataFrame(moments, "i timestamp")
    got = [r[0] for r in df.select(tk.utc_from_instant(F.col("i"))).collect()]
    assert got == [m[0].replace(tzinfo=None) for m in moments]
    old = spark.createDataFrame([(datetime(1960, 5, 5, 1, 2, 3, tzinfo=timezone.utc),)], "i timestamp")
    assert old.select(tk.utc_from_instant(F.col("i"))).first()[0] == datetime(1960, 5, 5, 1, 2, 3)
    texts = ntz(spark, "2026-03-08 02:30", "2026-03-08T02:30:00Z", "2026-03-08T02:30:00-05:00", "2025-01-01")
    assert [r[0] for r in texts.select(tk.utc_from_text(F.col("t"))).collect()] == [
        datetime(2026, 3, 8, 2, 30), datetime(2026, 3, 8, 2, 30), datetime(2026, 3, 8, 7, 30), datetime(2025, 1, 1),
    ]
