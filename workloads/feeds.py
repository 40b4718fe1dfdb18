"""The benchmark tables seen as electricity and weather feeds.

``events`` stands for both feeds. By user, every user is a station in one of
25 zones (the letters A to Y, named by the 25 nations). By type, the five
event types are five zones. Measures: value, and the number k in props.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload import schemas
from zephyrload.functions.records import row_key
from zephyrload.functions.timekeys import hour_key
from zephyrload.plans import silver
from zephyrload.sources.landing import landing_rows


def load_time() -> Column:
    return F.expr("TIMESTAMP'2024-02-01 00:00:00'")


# Zone letter of each event type, for demand and for weather.
DEMAND_ZONES = {"purchase": "J", "click": "K", "signup": "I", "error": "A", "view": "B"}
WEATHER_ZONES = {"view": "J", "click": "K", "signup": "I", "error": "A", "purchase": "B"}


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A benchmark table; its schema is read from the file once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def user_zone(user: str = "user_id") -> Column:
    return F.char(F.lit(65) + F.col(user) % 25)


def type_zone(zones: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for kind, letter in zones.items():
        chosen = F.when(F.col("event_type") == kind, F.lit(letter)).otherwise(chosen)
    return chosen


def wind(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("double")


def county_rows(station: Column) -> Column:
    """Three zone-counties per station, all served by it alone."""
    return F.array(*[F.concat(station, F.lit(f"-{i}")) for i in range(3)])


def weather_bronze(spark: SparkSession, sf: str, zone: Column) -> DataFrame:
    """Readings of all events, each repeated for three counties."""
    station = F.concat(F.lit("S"), F.col("user_id").cast("string"))
    rows = table(spark, sf, "events").select(
        F.explode(county_rows(station)).alias("fips"),
        zone.alias("nyiso_zone"),
        station.alias("station_id"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("station_name"),
        F.col("ts").alias("observed_at_utc"),
        F.col("value").alias("temperature"),
        wind().alias("wind_speed"),
    )
    named = (
        rows.withColumn("state_zone", F.concat(F.lit("NY"), F.col("nyiso_zone")))
        .withColumn("zone_name", F.concat(F.lit("Zone "), F.col("nyiso_zone")))
        .withColumn("county", F.concat(F.lit("County "), F.col("fips")))
        .withColumn("nyiso_zone_name", F.concat(F.lit("Load "), F.col("nyiso_zone")))
        .withColumn("distance_km", F.lit(1.0))
        .withColumn("temperature_unit", F.lit("F"))
        .withColumn("wind_speed_unit", F.lit("mph"))
        .withColumn("ingested_at_utc", load_time())
    )
    return schemas.conform(named, schemas.WEATHER_BRONZE.schema)


def weather_fact(spark: SparkSession, sf: str, zone: Column | None = None) -> DataFrame:
    zone = user_zone() if zone is None else zone
    return silver.weather_fact(weather_bronze(spark, sf, zone), load_time())


def electricity_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events under the names that all three feeds draw from."""
    return table(spark, sf, "events").select(
        "event_id",
        hour_key(F.col("ts")).alias("period"),
        F.col("user_id").cast("string").alias("user"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("user_name"),
        "event_type",
        F.upper("event_type").alias("type_name"),
        F.concat(F.lit("ZON"), user_zone()).alias("subba"),
        F.concat(F.lit("ZON"), type_zone(DEMAND_ZONES)).alias("type_subba"),
        "value",
    )


def operations_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf, "rom_id", "user", "user_name", "type_code", "event_type", "type_name", "type_name")


def generation_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf, "ges_id", "user", "user_name", "fuel_code", "event_type", "fuel_name", "type_name")


def demand_bronze(spark: SparkSession, sf: str, code: str = "subba") -> DataFrame:
    records = electricity_records(spark, sf)
    return records.select(
        row_key(F.col("period"), F.col(code), F.col("user")).alias("srd_id"),
        "period",
        F.col("user").alias("ba_code"),
        F.col("user_name").alias("ba_name"),
        F.col(code).alias("sub_ba_code"),
        F.concat(F.lit("Area "), F.col(code)).alias("sub_ba_name"),
        F.col("value").alias("value_mwh"),
        F.lit("megawatthours").alias("value_units"),
        load_time().alias("processed_timestamp"),
    )


def _bronze(spark, sf, key, ba, ba_name, code, code_from, name, name_from) -> DataFrame:
    records = electricity_records(spark, sf)
    return records.select(
        row_key(F.col("period"), F.col(ba), F.col(code_from)).alias(key),
        "period",
        F.col(ba).alias("ba_code"),
        F.col(ba_name).alias("ba_name"),
        F.col(code_from).alias(code),
        F.col(name_from).alias(name),
        F.col("value").alias("value_mwh"),
        F.lit("megawatthours").alias("value_units"),
        load_time().alias("processed_timestamp"),
    )


def demand_fact(spark: SparkSession, sf: str, code: str = "subba") -> DataFrame:
    return silver.electricity_fact(demand_bronze(spark, sf, code), schemas.FACT_DEMAND, load_time())


def nation_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Zone names: the letter of every nation."""
    return table(spark, sf, "nation").select(
        user_zone("n_nationkey").alias("nyiso_zone"), F.col("n_name").alias("nyiso_zone_name")
    )


PAGE = 1000


def saved_responses(
    spark: SparkSession, sf: str, failing_hours: bool = False, at: Column | None = None
) -> DataFrame:
    """Events packed into response pages per hour, all feeds' fields on each record.

    A page takes the events of one hour from a run of 1,000 ids, so it holds
    1,000 records at most however many an hour has. They stand by id, so that a page
    asked for again has the same text, whichever tasks its events were read by.
    """
    records = electricity_records(spark, sf)
    record = F.struct(
        "period",
        F.col("user").alias("respondent"),
        F.col("user_name").alias("respondent-name"),
        F.col("event_type").alias("type"),
        F.col("type_name").alias("type-name"),
        F.col("event_type").alias("fueltype"),
        "subba",
        F.concat(F.lit("Area "), F.col("subba")).alias("subba-name"),
        F.col("user").alias("parent"),
        F.col("user_name").alias("parent-name"),
        "value",
        F.lit("megawatthours").alias("value-units"),
    )
    pages = (
        records.withColumn("chunk", F.floor(F.col("event_id") / PAGE))
        .groupBy("period", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", record.alias("record")))).alias("listed"))
        .select("period", "chunk", F.col("listed.record").alias("data"))
    )
    body = F.to_json(F.struct(F.struct("data").alias("response")))
    fails = F.substring("period", 12, 2) == "10" if failing_hours else F.lit(False)
    return pages.select(
        F.lit("run-1").alias("run_id"),
        (load_time() if at is None else at).alias("request_timestamp"),
        F.col("period").alias("target_dt"),
        (F.col("chunk") * PAGE).cast("bigint").alias("offset_start"),
        F.when(fails, F.lit(500)).otherwise(F.lit(200)).cast("bigint").alias("status_code"),
        F.when(fails, F.lit("Server Error")).otherwise(F.lit("OK")).alias("status"),
        F.when(fails, F.lit("upstream failed")).otherwise(body).alias("body"),
    )


def landing(spark: SparkSession, sf: str) -> DataFrame:
    return landing_rows(saved_responses(spark, sf), page_size=PAGE)
