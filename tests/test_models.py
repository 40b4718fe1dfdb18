from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrload import schemas
from zephyrload.functions.timekeys import hour_spine
from zephyrload.plans import bronze, gold, silver

WEATHER = "nyiso_zone string, station_id string, fips string, observed_at_utc timestamp_ntz, temperature double, wind_speed double"
DEMAND = "period_timestamp string, sub_ba_code string, value_mwh double"


def weather(spark, *items):
    """Facts from (zone, station, moment, temperature, wind), one county each."""
    full = [(z, s, f"{s}-1", datetime.fromisoformat(t), temp, wind) for z, s, t, temp, wind in items]
    df = spark.createDataFrame(full, WEATHER)
    for name in ("state_zone", "zone_name", "county", "nyiso_zone_name", "station_name"):
        df = df.withColumn(name, F.lit("x"))
    df = df.withColumn("distance_km", F.lit(1.0)).withColumn("ingested_at_utc", F.current_timestamp())
    return silver.weather_fact(df.withColumn("temperature_unit", F.lit("F")).withColumn("wind_speed_unit", F.lit("mph")))


def demand(spark, *items):
    return spark.createDataFrame(list(items), DEMAND)


def zones(spark, *items):
    return spark.createDataFrame(list(items), "nyiso_zone string, nyiso_zone_name string")


def test_mean_of_station_means(spark):
    readings = [("J", "A", "2026-07-01T10:00", 60.0, 1.0), ("J", "A", "2026-07-01T10:10", 70.0, 3.0), ("J", "B", "2026-07-01T09:51", 90.0, None)]
    fact = weather(spark, *readings)
    assert rows(silver.hourly_zone_weather(fact), "observation_hour", "avg_temperature_f", "avg_wind_speed_mph") == [("2026-07-01T10", 77.5, 2.0)]
    counties = fact.unionByName(fact.filter("station_id = 'A'").withColumn("fips", F.lit("A-2")))
    assert rows(silver.hourly_zone_weather(counties)) == rows(silver.hourly_zone_weather(fact))


def test_daily_demand_and_weather(spark, session_zone):
    fact = weather(
        spark, ("J", "A", "2026-07-01T10:00", 60.0, 1.0), ("J", "A", "2026-07-01T11:00", 80.0, 2.0), ("J", "A", "2026-07-01T12:00", 10.0, 2.0),
    )
    hours = demand(
        spark, ("2026-07-01T10", "J", 5.0), ("2026-07-01T11", "J", None), ("2026-07-01T11", "J", 7.0), ("2026-07-01T10", "H", 1.0),
        (None, "J", 9.0), ("2026-07-01T10", None, 9.0), ("2026-07-02T03", "J", 100.0),
    )
    got = gold.daily_demand_weather(hours, fact, zones(spark, ("J", "N.Y.C.")))
    assert rows(got.drop("gold_processed_timestamp")) == [
        (date(2026, 7, 1), "H", None, 1.0, 1.0, 1.0, 1, None, None, None, None, 0, None, None, False),
        # the last hour is still July 1st locally; an hour counts once per record, only hours with demand count
        (date(2026, 7, 1), "J", "N.Y.C.", 112.0, 37.33, 100.0, 3, 73.33, 60.0, 80.0, 1.67, 3, 0.0, 8.33, False),
    ]
    assert got.columns[-1] == "gold_processed_timestamp" and dict(got.dtypes)["demand_hours"] == "bigint"


def full_feed(spark, start, end, value=1.0):
    return hour_spine(spark, start, end, "period_timestamp").select(
        "period_timestamp", F.lit("J").alias("sub_ba_code"), F.lit(value).alias("value_mwh")
    )


def test_clock_changes_make_complete_days(spark, session_zone):
    got = gold.daily_demand_weather(full_feed(spark, "2026-01-01T05", "2026-12-01T04"), weather(spark, ("A", "x", "2026-01-01", 1.0, 1.0)), zones(spark))
    hours = {r.demand_date: (r.demand_hours, r.is_complete_day) for r in got.collect()}
    assert hours[date(2026, 3, 8)] == (23, True) and hours[date(2026, 11, 1)] == (25, True)
    assert len(hours) == 334 and all(done for _, done in hours.values())


def test_trailing_window_shows_gaps(spark, session_zone):
    hours = demand(
        spark, ("2026-07-10T12", "J", 5.0), ("2026-07-08T12", "J", 6.0), ("2026-07-07T12", "J", 7.0), ("2026-07-11T12", "J", None), ("2026-07-30T12", "K", 1.0),
    )
    fact = weather(spark, *[("J", "A", f"2026-07-{d:02d}T12:00", float(d), 1.0) for d in (6, 8, 9, 10, 12)])
    got = gold.trailing_daily(hours, fact, zones(spark, ("K", "LONGIL")), window_days=4)
    assert rows(got, "report_date", "total_demand_mwh", "demand_hours", "avg_temperature_f", "weather_hours", "nyiso_zone", "nyiso_zone_name") == [
        (date(2026, 7, 8), 6.0, 1, 8.0, 1, "J", None),
        (date(2026, 7, 9), None, 0, 9.0, 1, "J", None),
        (date(2026, 7, 10), 5.0, 1, 10.0, 1, "J", None),
        (date(2026, 7, 11), None, 0, None, 0, "J", None),
    ]


@pytest.mark.parametrize("stored_by_day", [False, True])
def test_windows_end_on_different_days(spark, stored_by_day):
    """An hour without a value ends the daily window but not that of the bands."""
    hours = demand(spark, *[(f"2026-07-{d:02d}T12", "J", float(d)) for d in (1, 2, 3)], ("2026-07-04T12", "J", None))
    fact = weather(spark, *[("J", "A", f"2026-07-{d:02d}T12:00", 71.0, 1.0) for d in (1, 2, 3, 4)])
    if stored_by_day:
        from zephyrload.sources.tables import by_utc_day

        hours, fact = by_utc_day(hours, "period_timestamp"), by_utc_day(fact, "observation_hour")
    days = [r.report_date.day for r in gold.trailing_daily(hours, fact, zones(spark), window_days=2).orderBy("report_date").collect()]
    bands = gold.demand_by_band(hours, fact, window_days=2, complete_hours=1).first()
    assert days == [3, 4] and (bands.first_date.day, bands.last_date.day, bands.day_count) == (2, 3, 2)


def test_bands_baseline_and_uplift(spark, session_zone):
    totals = {1: (4.0, -3.2), 2: (8.0, 71.0), 3: (4.0, 33.0), 4: (12.0, 74.9)}
    hours = demand(spark, *[(f"2026-07-{d:02d}T12", "J", v) for d, (v, _) in totals.items()], ("2026-07-05T12", "J", 1.0))
    fact = weather(spark, *[("J", "A", f"2026-07-{d:02d}T12:00", t, 1.0) for d, (_, t) in totals.items()], ("J", "A", "2026-07-05T12:00", None, 2.0))
    got = gold.demand_by_band(hours, fact, complete_hours=1)
    assert rows(got, "temperature_band_low_f", "temperature_band_high_f", "temperature_band", "day_count", "avg_daily_demand_mwh",
                "baseline_temperature_band", "demand_uplift_vs_baseline_mwh", "demand_uplift_vs_baseline_pct") == [
        (-5, 0, "-5-0F", 1, 4.0, "-5-0F", 0.0, 0.0), (30, 35, "30-35F", 1, 4.0, "-5-0F", 0.0, 0.0), (70, 75, "70-75F", 2, 10.0, "-5-0F", 6.0, 150.0),
    ]
    assert dict(got.dtypes)["temperature_band_low_f"] == "int"
    zero = gold.demand_by_band(hours.withColumn("value_mwh", F.lit(0.0)), fact, complete_hours=1)
    assert {r.demand_uplift_vs_baseline_pct for r in zero.collect()} == {None}


def test_empty_demand_gives_empty_reports(spark):
    fact = weather(spark, ("J", "A", "2026-07-01T12:00", 1.0, 1.0))
    none = spark.createDataFrame([], DEMAND)
    assert gold.trailing_daily(none, fact, zones(spark)).count() == 0
    assert gold.demand_by_band(none, fact).count() == 0
    assert gold.daily_demand_weather(none, fact, zones(spark)).count() == 0


def test_monthly_and_daily_weather(spark, session_zone):
    fact = weather(
        spark, ("J", "A", "2026-07-01T12:00", 60.0, 1.0), ("J", "A", "2026-07-02T12:00", 70.0, 1.0), ("J", "A", "2026-07-02T13:00", 80.0, 3.0),
        ("K", "A", "2026-07-01T12:00", 10.0, 1.0), ("J", "A", "2026-08-01T03:00", 50.0, 1.0), (None, "A", "2026-07-01T12:00", 0.0, 0.0),
    )
    monthly = gold.monthly_temperature(fact, zones(spark, ("J", "N.Y.C.")))
    assert rows(monthly.drop("gold_processed_timestamp")) == [
        (date(2026, 7, 1), "J", "N.Y.C.", 61.67, 50.0, 75.0, 3, 35.83), (date(2026, 7, 1), "K", None, 10.0, 10.0, 10.0, 1, 35.83),
    ]
    daily = gold.daily_weather(fact, zones(spark))
    assert rows(daily.filter("nyiso_zone = 'J'"), "observation_date", "avg_temperature_f", "max_temperature_f", "weather_hours") == [
        (date(2026, 7, 1), 60.0, 60.0, 1), (date(2026, 7, 2), 75.0, 80.0, 2), (date(2026, 7, 31), 50.0, 50.0, 1),
    ]


def test_silver_drops_and_reports_bad_rows(spark):
    typed = spark.createDataFrame(
        [("a", "2026-07-01T00", "AA", "area", "ZONJ", "zone j", 1.0), ("b", None, "AA", "area", "ZONK", "zone k", 1.0), ("c", "2026-07-01T00", None, None, "XYZ", "odd", 2.0)],
        "srd_id string, period string, ba_code string, ba_name string, sub_ba_code string, sub_ba_name string, value_mwh double",
    ).withColumn("processed_timestamp", F.current_timestamp())
    fact = silver.electricity_fact(typed, schemas.FACT_DEMAND)
    assert rows(fact, "srd_id", "sub_ba_code") == [("a", "J"), ("c", None)]
    assert rows(silver.dim_subregion(typed)) == [("J", "zone j"), ("K", "zone k")]
    assert rows(silver.dim_balancing_authority(typed, typed, typed)) == [("AA", "area")]
    assert fact.schema["value_mwh"].metadata["comment"]
    combined = silver.dim_combined_zone(silver.dim_subregion(typed), zones(spark, ("J", "a"), ("J", "b"), ("Z", "c")))
    assert rows(combined) == [("J", "zone j"), ("K", "zone k")]


def test_weather_bronze_repeats_readings_per_county(spark):
    day = datetime(2026, 7, 1)
    readings = spark.createDataFrame(
        [("A", day, 50.0), ("A", day + timedelta(hours=1), 51.0), ("A", day, 99.0), ("unused", day, 1.0)], "station_id string, observed_at_utc timestamp_ntz, temperature double"
    ).withColumn("temperature_unit", F.lit("F")).withColumn("wind_speed", F.lit(None).cast("double")).withColumn("wind_speed_unit", F.lit("mph"))
    served = spark.createDataFrame(
        [("Z1", "n", "c", f, "J", "N.Y.C.", "A", "st", 1.5) for f in ("1", "2", "3")],
        "state_zone string, zone_name string, county string, fips string, nyiso_zone string, nyiso_zone_name string, station_id string, station_name string, distance_km double",
    )
    got = bronze.bronze_weather(readings, served)
    assert got.columns == schemas.WEATHER_BRONZE.schema.fieldNames()
    assert rows(got, "fips", "temperature") == [(f, t) for f in "123" for t in (50.0, 51.0)]
