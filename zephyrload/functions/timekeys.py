"""Hour keys, local calendar days and hourly spines (P8, P9, T-SPINE).

An hour key is the text ``yyyy-MM-ddTHH`` of an hour in UTC. No conversion
passes through the session time zone, so no result depends on it and no hour
is lost where that zone changes its clocks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key format and the calendar the daily models report on.
HOUR_KEY_FORMAT = "%Y-%m-%dT%H"
LOCAL_ZONE = "America/New_York"

_TEXT_WITH_OFFSET = r"\d\d:\d\d.*(Z|[+-]\d\d(:?\d\d)?)$"


def utc_from_instant(instant: Column) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) of a TIMESTAMP, whatever the session zone."""
    micros = F.unix_micros(instant)
    in_minute = F.pmod(micros, F.lit(60_000_000))
    minutes = ((micros - in_minute) / F.lit(60_000_000)).cast("int")
    seconds = (in_minute.cast("decimal(18,6)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), minutes, seconds
    )


def utc_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as UTC wall clock, for either timestamp type."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return column
    return utc_from_instant(column.cast("timestamp"))


def utc_from_text(text: Column) -> Column:
    """Parse a date-time text; without an offset it is taken as UTC."""
    return F.when(
        text.rlike(_TEXT_WITH_OFFSET), utc_from_instant(text.try_cast("timestamp"))
    ).otherwise(text.cast("timestamp_ntz"))


def hour_key(utc: Column) -> Column:
    """Key of the hour that contains ``utc`` (TIMESTAMP_NTZ)."""
    hour = F.hour(utc)
    mark = F.when(hour < 10, F.lit("T0")).otherwise(F.lit("T"))
    return F.concat(utc.cast("date").cast("string"), mark, hour.cast("string"))


def nearest_hour_key(utc: Column) -> Column:
    """Key of the closest hour; half past belongs to the next one."""
    return hour_key(utc + F.expr("INTERVAL 30 MINUTES"))


def hour_of_key(key: Column) -> Column:
    """Hour key back to UTC wall clock; text that is no hour key fails."""
    return F.concat(key, F.lit(":00")).cast("timestamp_ntz")


def local_date(key: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar day of an hour key in ``zone``.

    The day is counted from the shifted instant, which is some seven times
    cheaper per row than ``convert_timezone`` and as independent of the
    session zone.
    """
    day = F.substring(key, 1, 10).cast("date")
    hours = F.unix_date(day).cast("bigint") * 24 + F.substring(key, 12, 2).cast("int")
    local = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(hours * 3600), zone))
    return F.date_from_unix_date(F.floor(local / 86400).cast("int"))


def first_key_of_local_day(day: Column, zone: str = LOCAL_ZONE) -> Column:
    """Key of the first hour that ``local_date`` puts on ``day``.

    Hour keys sort like the hours they name, so a range of local days is a
    range of keys, which storage can prune on without any conversion per row.
    """
    midnight = F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))
    return hour_key(midnight + F.expr("INTERVAL '59:59.999999' MINUTE TO SECOND"))


def utc_day_of_key(key: Column) -> Column:
    """UTC date part of an hour key, the partition column of the fact tables."""
    return F.substring(key, 1, 10).cast("date")


def hour_spine(spark: SparkSession, start: str, end: str, name: str = "hour_key") -> DataFrame:
    """T-SPINE: every hour key from ``start`` to ``end``, both included."""
    first = datetime.strptime(start, HOUR_KEY_FORMAT)
    last = datetime.strptime(end, HOUR_KEY_FORMAT)
    hours = int((last - first).total_seconds() // 3600) + 1
    at = F.expr(f"TIMESTAMP_NTZ'{first:%Y-%m-%d %H}:00:00'") + F.make_dt_interval(
        F.lit(0), F.col("id").cast("int")
    )
    return spark.range(max(hours, 0)).select(hour_key(at).alias(name))
