"""Keep-first deduplication (W2) and key ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_first(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row of every key; without ``order`` by all other columns.

    The rank filter becomes a per-task limit ahead of the shuffle, so a key
    with very many rows sends at most one row per input task.
    """
    order = order or [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _total_order(df: DataFrame, keys: list[str]) -> list[str]:
    """The keys, then all other sortable columns.

    Ties are settled the same way on every run, and a key borne by most rows
    still spreads over many ranges.
    """
    unsortable = (T.VariantType, T.MapType)
    rest = [f.name for f in df.schema.fields if not isinstance(f.dataType, unsortable)]
    return [*keys, *[c for c in rest if c not in keys]]


def sorted_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """O2: range-partitioned and sorted by key, ready to be written."""
    order = _total_order(df, keys)
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def export_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in the one order that pages of an export are cut from."""
    return df.orderBy(*_total_order(df, keys))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """O3: ordered distinct values."""
    return df.select(column).distinct().orderBy(column)
