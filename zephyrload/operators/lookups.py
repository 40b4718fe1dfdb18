"""Dimension lookups and fan-out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# None of these joins is hinted: Spark broadcasts a side only when its known or
# measured size is below spark.sql.autoBroadcastJoinThreshold, and otherwise
# shuffles and splits skewed partitions.

#: Two to this power is the number of a sketch's registers.
SKETCH_SIZE = 14


def entity_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct entities."""
    return df.select(*columns).distinct()


def union_of_entities(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Distinct entities over several tables, with one deduplication."""
    parts = [frame.select(*columns) for frame in frames]
    return reduce(DataFrame.unionByName, parts).distinct()


def left_lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], take: list[str]) -> DataFrame:
    """Attach dimension columns; rows without a match keep NULL."""
    renamed = dim.select(
        *[F.col(theirs).alias(f"_key_{theirs}") for theirs in on.values()],
        *[F.col(c) for c in take],
    )
    condition = [F.col(ours) == F.col(f"_key_{theirs}") for ours, theirs in on.items()]
    joined = df.join(renamed, condition, "left")
    return joined.drop(*[f"_key_{theirs}" for theirs in on.values()])


def add_zone(zone_counties: DataFrame, county_zones: DataFrame, zone_names: DataFrame) -> DataFrame:
    """County code to load zone to zone name; unmapped counties stay."""
    with_zone = left_lookup(zone_counties, county_zones, {"fips": "fips"}, ["nyiso_zone"])
    return left_lookup(
        with_zone, zone_names, {"nyiso_zone": "nyiso_zone"}, ["nyiso_zone_name"]
    )


def unmapped(df: DataFrame, zone: str, report: list[str]) -> DataFrame:
    """Q5: distinct keys that found no zone."""
    return df.filter(F.col(zone).isNull()).select(*report).distinct()


def fan_out(readings: DataFrame, served: DataFrame, on: str = "station_id") -> DataFrame:
    """Every reading once per zone-county its station serves."""
    return readings.join(served, on, "inner")


def conformed_zones(left: DataFrame, right: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Left join that keeps left columns only.

    The right side is reduced to its distinct keys, so it cannot repeat a left
    row and Spark can drop the join altogether.
    """
    keys = right.select(*[F.col(theirs).alias(f"_key_{theirs}") for theirs in on.values()]).distinct()
    condition = [F.col(ours) == F.col(f"_key_{theirs}") for ours, theirs in on.items()]
    return left.join(keys, condition, "left").select(
        *[F.col(source).alias(name) for name, source in take.items()]
    )


def distinct_sketches(df: DataFrame, columns: list[str], by: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """HyperLogLog sketches of each column, (by, sketch_<column>), one row per value of ``by``.

    A sketch takes at most ``2 ** size`` bytes and some, whatever it has counted, and is made before the
    shuffle. NULL is not counted. Stored by day, sketches answer for any span of days.
    """
    made = [F.hll_sketch_agg(F.col(c).cast("string"), size).alias(f"sketch_{c}") for c in columns]
    return df.groupBy(*by).agg(*made)


def united_counts(sketches: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Estimated distinct values of the united sketches, per value of ``by`` or over all.

    The standard error is 1.04 / sqrt(2 ** size), 0.8 % by default. A value that occurs on many days counts once.
    """
    united = [F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(f"distinct_{c}") for c in columns]
    return sketches.groupBy(*(by or [])).agg(*united)


def distinct_counts(df: DataFrame, columns: list[str], relative_error: float | None = None) -> DataFrame:
    """Distinct values per column; approximate when an error is given."""
    def count(column: str):
        if relative_error is None:
            return F.countDistinct(column)
        return F.approx_count_distinct(column, relative_error)

    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])
