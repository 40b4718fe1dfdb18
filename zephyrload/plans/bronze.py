"""Bronze models (B1-B4; P1-P5, P11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrload.functions.records import row_key
from zephyrload.operators.dedupe import keep_first
from zephyrload.operators.lookups import fan_out
from zephyrload.schemas import WEATHER_BRONZE, WEATHER_KEY, conform
from zephyrload.sources.landing import RECORDS_PATH


def stamp(at: Column | None) -> Column:
    """Processing time, the clock unless one is given."""
    return F.current_timestamp() if at is None else at


@dataclass(frozen=True)
class Feed:
    """One electricity feed: output column to record field, and its key fields."""

    id_column: str
    key_fields: tuple[str, ...]
    columns: dict[str, str]
    value_columns: tuple[str, ...] = ("value_mwh",)


# Field names of the service's records.
_OPERATOR = {"ba_code": "respondent", "ba_name": "respondent-name"}
_VALUE = {"value_mwh": "value", "value_units": "value-units"}
OPERATIONS = Feed(
    "rom_id",
    ("period", "respondent", "type"),
    {"period": "period", **_OPERATOR, "type_code": "type", "type_name": "type-name", **_VALUE},
)
GENERATION = Feed(
    "ges_id",
    ("period", "respondent", "fueltype"),
    {"period": "period", **_OPERATOR, "fuel_code": "fueltype", "fuel_name": "type-name", **_VALUE},
)
SUBREGION_DEMAND = Feed(
    "srd_id",
    ("period", "subba", "parent"),
    {
        "period": "period",
        "ba_code": "parent",
        "ba_name": "parent-name",
        "sub_ba_code": "subba",
        "sub_ba_name": "subba-name",
        **_VALUE,
    },
)


def payload_records(landing: DataFrame, payload: str = "raw_response") -> DataFrame:
    """One row per record; a payload without records yields none."""
    records = F.variant_get(F.col(payload), RECORDS_PATH, "array<variant>")
    return landing.select(F.explode(records).alias("record"))


def bronze_feed(
    landing: DataFrame, feed: Feed, strict: bool = True, processed_at: Column | None = None
) -> DataFrame:
    """Typed records of one feed.

    All fields are read in one pass over the payload. A value that is no number
    fails the load, or becomes NULL when not strict.
    """
    read = F.variant_get if strict else F.try_variant_get
    fields = ", ".join(
        f"`{name}`: {'double' if column in feed.value_columns else 'string'}"
        for column, name in feed.columns.items()
    )
    records = read(F.col("raw_response"), RECORDS_PATH, f"array<struct<{fields}>>")

    def field(name: str) -> Column:
        return F.col("record").getField(name)

    return landing.select(F.explode(records).alias("record")).select(
        row_key(*[field(name) for name in feed.key_fields]).alias(feed.id_column),
        *[field(name).alias(column) for column, name in feed.columns.items()],
        stamp(processed_at).alias("processed_timestamp"),
    )


def bronze_weather(
    readings: DataFrame, zone_stations: DataFrame, ingested_at: Column | None = None
) -> DataFrame:
    """Readings fanned out to zone-counties, one row per key and moment."""
    served = zone_stations.select(
        "state_zone", "zone_name", "county", "fips", "nyiso_zone", "nyiso_zone_name",
        "station_id", "station_name", "distance_km",
    )
    rows = fan_out(readings, served).withColumn("ingested_at_utc", stamp(ingested_at))
    order = ["station_id", "temperature", "wind_speed"]
    return keep_first(conform(rows, WEATHER_BRONZE.schema), list(WEATHER_KEY), order)
