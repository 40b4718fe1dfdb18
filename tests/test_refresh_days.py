"""Loads followed by a refresh of their days alone, and responses that cannot be read."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_records import envelope, response, responses
from zephyrload import schemas
from zephyrload.plans import refresh
from zephyrload.sources import tables
from zephyrload.sources.landing import landing_rows
from zephyrload.streaming import incremental

OPERATOR = {"respondent": "NY", "respondent-name": "New York"}
FEEDS = {
    refresh.LANDING_OPERATIONS: {**OPERATOR, "type": "D", "type-name": "Demand"},
    refresh.LANDING_GENERATION: {**OPERATOR, "fueltype": "WND", "type-name": "Wind"},
    refresh.LANDING_DEMAND: {"subba": "ZONJ", "subba-name": "zone j", "parent": "NY", "parent-name": "New York"},
}
FACTS = [schemas.FACT_OPERATIONS, schemas.FACT_GENERATION, schemas.FACT_DEMAND, schemas.FACT_WEATHER]
GOLD = [schemas.GOLD_DAILY_BY_ZONE, schemas.GOLD_DAILY_WEATHER, schemas.GOLD_MONTHLY_TEMPERATURE, schemas.GOLD_NYC_DAILY, schemas.GOLD_NYC_BANDS]
STAMPS = [f"{layer}_processed_timestamp" for layer in ("bronze", "silver", "gold")]


def land(spark, values):
    """Landing tables whose pages hold the value of each hour, or nothing."""
    for table, fields in FEEDS.items():
        pages = [
            response(0, 200, envelope(*([{**fields, "period": h, "value": str(v), "value-units": "MWh"}] if v is not None else [])), h)
            for h, v in values.items()
        ]
        tables.publish(landing_rows(responses(spark, *pages)), table)


def content(spark):
    return {c.name: rows(spark.table(c.name).drop(*STAMPS)) for c in [*FACTS, *GOLD]}


def test_refreshing_days_brings_loaded_pages(spark):
    """Corrected, new and withdrawn pages reach facts and gold; other days' files stay."""
    tables.create_layers(spark)
    hours = [f"2026-07-0{d}T{h:02d}" for d in (1, 2, 3) for h in range(24)]
    weather = spark.createDataFrame([(h,) for h in hours], "h string").select(
        F.lit("NYZ072").alias("state_zone"), F.lit("New York").alias("zone_name"), F.lit("New York").alias("county"), F.lit("36061").alias("fips"),
        F.lit("J").alias("nyiso_zone"), F.lit("N.Y.C.").alias("nyiso_zone_name"), F.lit("NYC").alias("station_id"), F.lit("Park").alias("station_name"),
        F.lit(1.0).alias("distance_km"), F.concat("h", F.lit(":05")).cast("timestamp_ntz").alias("observed_at_utc"), F.lit(80.0).alias("temperature"),
        F.lit("F").alias("temperature_unit"), F.lit(4.0).alias("wind_speed"), F.lit("mph").alias("wind_speed_unit"), F.current_timestamp().alias("ingested_at_utc"),
    )
    tables.publish(schemas.conform(weather, schemas.WEATHER_BRONZE.schema), schemas.WEATHER_BRONZE.name)
    values = dict.fromkeys(hours, 10)
    land(spark, values)
    refresh.refresh_all(spark)
    before = content(spark)

    def files(day):
        fact = spark.table(schemas.FACT_DEMAND.name).filter(F.col("utc_day") == F.lit(day))
        return {r[0] for r in fact.select(F.input_file_name()).distinct().collect()}

    kept = files(date(2026, 7, 1))
    values |= {h: None for h in hours if h.startswith("2026-07-02")}  # withdrawn
    values |= {h: 99 for h in hours if h.startswith("2026-07-03")}  # corrected
    values |= {f"2026-07-04T{h:02d}": 7 for h in range(24)}  # new
    land(spark, values)
    refresh.refresh_days(spark, date(2026, 7, 2), date(2026, 7, 4))
    by_days = content(spark)
    assert files(date(2026, 7, 1)) == kept
    days = {r[0] for r in spark.table(schemas.FACT_DEMAND.name).select("utc_day").distinct().collect()}
    assert days == {date(2026, 7, 1), date(2026, 7, 3), date(2026, 7, 4)} and by_days != before
    refresh.refresh_all(spark)
    assert content(spark) == by_days


def test_unreadable_bodies_land_as_failures(spark):
    landed = landing_rows(responses(spark, response(0, 200, '{"response": {"da'), response(1, 200, None), response(2, 200, envelope())), strict=False)
    found = rows(landed, "error_msg", "record_count", F.col("response_hash").isNotNull())
    assert found == [("None", 0, True), ("no body", 0, True), ('{"response": {"da', 0, True)]


def replayed(log):
    """Hash-guarded upserts one row at a time: NULL never differs from anything."""
    table = {}
    for key, at, digest in sorted(log, key=lambda r: r[1]):
        stored = table.get(key)
        if stored is None or (stored[1] is not None and digest is not None and stored[1] != digest):
            table[key] = (at, digest)
    return table


def test_current_rows_with_null_hashes(spark):
    for seed in range(3):
        draw = random.Random(seed)
        start = datetime(2026, 7, 1)
        log = [(draw.choice("kkkkxyz"), start + timedelta(minutes=m), draw.choice(["a", "b", None])) for m in range(30)]
        log += [("only", start, None), ("only", start + timedelta(hours=1), None)]
        df = spark.createDataFrame(log, "target_dt string, request_timestamp timestamp_ntz, response_hash string")
        found = {r[0]: (r[1], r[2]) for r in incremental.current_rows(df, ["target_dt"]).collect()}
        assert found == replayed(log)
