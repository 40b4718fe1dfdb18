"""Silver models: dimensions, facts and the hourly view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrload import schemas
from zephyrload.functions.records import zone_letter
from zephyrload.functions.timekeys import nearest_hour_key, utc_column
from zephyrload.operators.lookups import conformed_zones, entity_rows, union_of_entities
from zephyrload.operators.quality import expect_contract
from zephyrload.operators.steps import stepped_mean
from zephyrload.plans.bronze import stamp
from zephyrload.schemas import Contract, conform


def _publishable(df: DataFrame, contract: Contract) -> DataFrame:
    return conform(expect_contract(df, contract), contract.schema)


def dimension(bronze: DataFrame, contract: Contract) -> DataFrame:
    """Distinct rows of the contract's columns, key known."""
    return _publishable(entity_rows(bronze, contract.schema.fieldNames()), contract)


def dim_balancing_authority(*bronze: DataFrame) -> DataFrame:
    """Authorities of all electricity feeds."""
    contract = schemas.DIM_BALANCING_AUTHORITY
    return _publishable(union_of_entities(list(bronze), contract.schema.fieldNames()), contract)


def dim_subregion(bronze_demand: DataFrame) -> DataFrame:
    """Sub-areas by zone letter."""
    lettered = bronze_demand.withColumn("sub_ba_code", zone_letter(F.col("sub_ba_code")))
    return dimension(lettered, schemas.DIM_SUBREGION)


def dim_combined_zone(subregions: DataFrame, weather_zones: DataFrame) -> DataFrame:
    """The zones of demand under the name both sides use."""
    zones = conformed_zones(
        subregions,
        weather_zones,
        {"sub_ba_code": "nyiso_zone"},
        {"nyiso_zone": "sub_ba_code", "nyiso_zone_name": "sub_ba_name"},
    )
    return _publishable(zones, schemas.DIM_COMBINED_ZONE)


def electricity_fact(
    bronze: DataFrame, contract: Contract, processed_at: Column | None = None
) -> DataFrame:
    """Records under their silver names; zone letters for demand."""
    rows = bronze.withColumnsRenamed(
        {"period": "period_timestamp", "processed_timestamp": "bronze_processed_timestamp"}
    ).withColumn("silver_processed_timestamp", stamp(processed_at))
    if "sub_ba_code" in contract.schema.fieldNames():
        rows = rows.withColumn("sub_ba_code", zone_letter(F.col("sub_ba_code")))
    return _publishable(rows, contract)


def weather_fact(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Readings with the key of their nearest hour."""
    rows = (
        bronze.withColumn("observed_at_utc", utc_column(bronze, "observed_at_utc"))
        .withColumn("observation_hour", nearest_hour_key(F.col("observed_at_utc")))
        .withColumnRenamed("ingested_at_utc", "bronze_processed_timestamp")
        .withColumn("silver_processed_timestamp", stamp(processed_at))
    )
    return _publishable(rows, schemas.FACT_WEATHER)


def hourly_zone_weather(fact_weather: DataFrame) -> DataFrame:
    """V1: station-hour means, then zone-hour means."""
    return stepped_mean(
        fact_weather,
        [["observation_hour", "nyiso_zone", "station_id"], ["observation_hour", "nyiso_zone"]],
        {"avg_temperature_f": "temperature", "avg_wind_speed_mph": "wind_speed"},
    )
