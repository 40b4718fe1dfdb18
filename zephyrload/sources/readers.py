"""Weather source files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.functions.records import number_or_null
from zephyrload.functions.timekeys import utc_from_text
from zephyrload.operators.dedupe import keep_first
from zephyrload.schemas import (
    OBSERVATION_COLUMNS,
    OBSERVATIONS,
    STATION_COLLECTION,
    ZONE_COUNTY_TEXT,
    conform,
)


def require_columns(df: DataFrame, needed: tuple[str, ...]) -> DataFrame:
    """Fail before any job runs, naming the columns that are missing."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, but the full schema."""
    return spark.createDataFrame([], schema)


def read_zone_counties(spark: SparkSession, path: str) -> DataFrame:
    """S3: pipe-delimited text without header; coordinates as numbers or NULL."""
    text = spark.read.csv(path, sep="|", header=False, schema=ZONE_COUNTY_TEXT)
    return text.withColumn("latitude", number_or_null(F.col("latitude"))).withColumn(
        "longitude", number_or_null(F.col("longitude"))
    )


def state_zone_counties(zone_counties: DataFrame, state: str = "NY") -> DataFrame:
    """located zone-county pairs of one state, one row per pair."""
    located = zone_counties.filter(F.col("state") == state).na.drop(
        subset=["latitude", "longitude"]
    )
    return keep_first(located, ["state_zone", "fips"])


def read_stations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stations of GeoJSON feature collections, coordinates as [lon, lat].

    ``multi_line=False`` reads files holding one collection per line.
    """
    collections = spark.read.schema(STATION_COLLECTION).json(path, multiLine=multi_line)
    feature = collections.select(F.explode("features").alias("f"))
    return feature.select(
        F.col("f.properties.sid").alias("station_id"),
        F.col("f.properties.sname").alias("station_name"),
        F.col("f.properties.archive_begin").alias("archive_begin"),
        F.col("f.properties.archive_end").alias("archive_end"),
        F.get(F.col("f.geometry.coordinates"), F.lit(0)).alias("station_longitude"),
        F.get(F.col("f.geometry.coordinates"), F.lit(1)).alias("station_latitude"),
    )


def active_stations(stations: DataFrame, since: str) -> DataFrame:
    """F8: stations that already reported at ``since`` (UTC) and never stopped."""
    begin = utc_from_text(F.col("archive_begin"))
    return stations.filter(
        (begin <= F.lit(since).cast("timestamp_ntz")) & F.col("archive_end").isNull()
    )


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Hourly readings of stations from CSV files with a header.

    Every file must carry the same header; a differing one fails the job
    instead of shifting columns.
    """
    header = spark.read.csv(path, header=True)
    if not header.columns:
        return empty_frame(spark, OBSERVATIONS)
    require_columns(header, OBSERVATION_COLUMNS)
    text = spark.read.csv(
        path, header=True, schema=header.schema, enforceSchema=False, nullValue="M"
    )
    return observations(text)


def observations(text: DataFrame) -> DataFrame:
    """Typed readings with their units."""
    typed = text.select(
        F.col("station").alias("station_id"),
        utc_from_text(F.col("valid")).alias("observed_at_utc"),
        number_or_null(F.col("tmpf")).alias("temperature"),
        F.lit("F").alias("temperature_unit"),
        number_or_null(F.col("sped")).alias("wind_speed"),
        F.lit("mph").alias("wind_speed_unit"),
    )
    return conform(typed, OBSERVATIONS)


def measured(readings: DataFrame, measures: tuple[str, ...] = ("temperature", "wind_speed")) -> DataFrame:
    """drop readings that miss every measure."""
    return readings.na.drop(how="all", subset=list(measures))
