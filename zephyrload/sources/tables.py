"""Published tables.

A refreshed table is written under a new name and a view is then repointed to it, so
readers see the old or the new content and never a part, and a failed refresh leaves the
old content in place.

A table stored by day keeps each day in a directory of its own. Replacing some days writes
these alone; the next generation points at the new directories for them and at the old
ones for all others, and one change of the view shows all replaced days at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date, timedelta

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.functions.timekeys import utc_day_of_key

LAYERS = ("landing", "bronze", "silver", "gold")
#: Days named in one statement when a generation's partitions are listed.
_DAYS_A_STATEMENT = 400
#: Rows that a page of a clustered file holds at most: readers skip whole pages.
CLUSTER_PAGE_ROWS = 5_000
#: How files of payloads are written: rows of a row group, its compressed bytes, and rows between two looks at these.
#: Readers take up to 4,096 rows at once, but never of two row groups, so payloads of any size stay few in memory.
PAYLOAD_GROUPS = {
    "parquet.block.row.count.limit": "64",
    "parquet.block.size": str(4 << 20),
    "parquet.page.size.row.check.min": "16",
}
_CLUSTERED = "clustered_by"
_prefix: ContextVar[str] = ContextVar("layer_prefix", default="")


@contextmanager
def layers_named(prefix: str) -> Iterator[None]:
    """Work in a second set of layers, whose names begin with ``prefix``."""
    token = _prefix.set(prefix)
    try:
        yield
    finally:
        _prefix.reset(token)


def full_name(name: str) -> str:
    """The name of a layer's table in the set of layers in use."""
    return f"{_prefix.get()}{name}"


def stored(spark: SparkSession, name: str) -> DataFrame:
    """A published table of the set of layers in use."""
    return spark.table(full_name(name))


def create_layers(spark: SparkSession, root: str | None = None) -> None:
    """The layer namespaces, kept if they exist; ``root`` places new ones."""
    for layer in LAYERS:
        place = f" LOCATION '{root}/{layer}'" if root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {full_name(layer)}{place}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """S10."""
    return spark.catalog.tableExists(full_name(name))


def by_utc_day(fact: DataFrame, key: str) -> DataFrame:
    """Add the UTC day of the hour key, the partition column of large facts."""
    return fact.withColumn("utc_day", utc_day_of_key(F.col(key)))


def payload_writer(df: DataFrame) -> DataFrameWriter:
    """A writer whose files hold the rows in small row groups, for rows that may be large."""
    return df.write.options(**PAYLOAD_GROUPS)


def writer_of(df: DataFrame) -> DataFrameWriter:
    """A writer for these rows: small row groups if they hold payloads."""
    holds_payload = any(isinstance(f.dataType, T.VariantType) for f in df.schema.fields)
    return payload_writer(df) if holds_payload else df.write


def publish(
    df: DataFrame,
    name: str,
    comment: str = "",
    partition_by: tuple[str, ...] = (),
    properties: dict[str, str] | Callable[[DataFrame], dict[str, str]] | None = None,
    cluster_by: tuple[str, ...] = (),
) -> DataFrame:
    """Write the content of ``name`` anew, then let the view show it.

    The content shown before stays until the next refresh, for readers that
    have already planned on it. ``partition_by`` may name one column, a date.
    ``properties`` are texts that change with the content, in the same step; a function gets the rows
    as written and is called before they are shown. ``cluster_by`` names columns that the rows of
    every file are sorted by, inside a day: a filter on them skips the pages that hold no such
    value. Days replaced later are sorted likewise.
    """
    spark = df.sparkSession
    layer, short = full_name(name).split(".")
    earlier = _generations(spark, layer, short)
    generation = _next(earlier, short)
    if partition_by:
        (day,) = partition_by
        written = _write_days(df, layer, short, day, cluster_by)
        _show_days(spark, layer, short, generation, df, day, written, cluster_by)
    else:
        _clustered_writer(df, cluster_by).format("parquet").saveAsTable(f"{layer}.{generation}")
    if callable(properties):
        properties = properties(spark.table(f"{layer}.{generation}"))
    _repoint(spark, full_name(name), f"{layer}.{generation}", comment, properties)
    _drop(spark, layer, short, earlier[:-1])
    return spark.table(full_name(name))


def publish_days(
    df: DataFrame,
    name: str,
    day: str = "utc_day",
    span: tuple[date, date] | None = None,
    days: Iterable[date | None] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Replace only the days that ``df`` holds, in a table stored by day, as one step.

    With ``days`` or a ``span``, ``df`` is all there is for these: stored ones that it has
    no row for are dropped. The frame is evaluated once. Files of other days are neither
    read nor written, and repeating the call leaves the same content, so a lost job is simply rerun.
    """
    spark = df.sparkSession
    layer, short = full_name(name).split(".")
    earlier = _generations(spark, layer, short)
    current = spark.table(f"{layer}.{earlier[-1]}")
    gone = {_day_text(d) for d in days or ()} | {_day_text(d) for d in _span_days(span)}
    rows = df.select(*current.columns)
    cluster_by = _clustered_by(spark, f"{layer}.{earlier[-1]}")
    written = _write_days(rows, layer, short, day, cluster_by)
    kept = {d: at for d, at in _places(spark, layer, earlier[-1]).items() if d not in gone}
    generation = _next(earlier, short)
    _show_days(spark, layer, short, generation, current, day, kept | written, cluster_by)
    _repoint(spark, full_name(name), f"{layer}.{generation}", _comment(spark, full_name(name)), properties)
    _drop(spark, layer, short, earlier[:-1])
    return spark.table(full_name(name))


def _span_days(span: tuple[date, date] | None) -> list[date]:
    return [] if span is None else [span[0] + timedelta(days=n) for n in range((span[1] - span[0]).days + 1)]


def _day_text(day: date | None) -> str:
    return "" if day is None else day.isoformat()


def _next(earlier: list[str], short: str) -> str:
    number = int(earlier[-1].rsplit("__", 1)[1].split("_")[0]) + 1 if earlier else 0
    return f"{short}__{number:06d}_{uuid.uuid4().hex[:8]}"


def _layer_place(spark: SparkSession, layer: str) -> str:
    rows = spark.sql(f"DESCRIBE SCHEMA {layer}").collect()
    return next(r[1] for r in rows if r[0] == "Location").rstrip("/")


def _clustered_writer(df: DataFrame, cluster_by: tuple[str, ...], day: str | None = None) -> DataFrameWriter:
    """A writer whose files hold the rows in the order of ``cluster_by``, in pages of few rows."""
    if not cluster_by:
        return writer_of(df)
    # the day first: Spark then writes day by day without sorting anew
    rows = df.sortWithinPartitions(*([day] if day else []), *cluster_by)
    return writer_of(rows).option("parquet.page.row.count.limit", str(CLUSTER_PAGE_ROWS))


def _clustered_by(spark: SparkSession, generation: str) -> tuple[str, ...]:
    found = spark.sql(f"SHOW TBLPROPERTIES {generation}").collect()
    return tuple(json.loads(next((r.value for r in found if r.key == _CLUSTERED), "[]")))


def _write_days(df: DataFrame, layer: str, short: str, day: str, cluster_by: tuple[str, ...] = ()) -> dict[str, str]:
    """Write the rows by day in a new directory; day as text ('' is NULL) to the day's place."""
    spark = df.sparkSession
    root = f"{_layer_place(spark, layer)}/{short}.days/{uuid.uuid4().hex}"
    # rebalancing keeps files few and splits a day that holds far more rows
    _clustered_writer(df.hint("rebalance", day), cluster_by, day).partitionBy(day).parquet(root)
    # partition values alone: no column of the files is read
    held = spark.read.schema(df.schema).parquet(root).select(F.col(day).cast("string")).distinct().collect()
    null = "__HIVE_DEFAULT_PARTITION__"
    return {d or "": f"{root}/{day}={d or null}" for (d,) in held}


def _show_days(
    spark: SparkSession, layer: str, short: str, generation: str, like: DataFrame, day: str, places: dict[str, str],
    cluster_by: tuple[str, ...] = (),
) -> None:
    """A table whose days lie in the given places, and the list of them for the next generation."""
    place = _layer_place(spark, layer)
    columns = ", ".join(_column(f) for f in like.schema.fields)
    sorting = json.dumps(cluster_by).replace("'", "''")
    spark.sql(
        f"CREATE TABLE {layer}.{generation} ({columns}) USING parquet PARTITIONED BY (`{day}`) "
        f"LOCATION '{place}/{short}.days/none' TBLPROPERTIES ('{_CLUSTERED}' = '{sorting}')"
    )
    listed = sorted(places.items())
    for at in range(0, len(listed), _DAYS_A_STATEMENT):
        added = " ".join(
            f"PARTITION (`{day}` = {repr(d) if d else 'NULL'}) LOCATION '{where}'"
            for d, where in listed[at : at + _DAYS_A_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {layer}.{generation} ADD {added}")
    rows = spark.createDataFrame(listed, "day string, place string")
    rows.coalesce(1).write.parquet(f"{place}/{short}.days/list-{generation.lower()}")


def _column(field: T.StructField) -> str:
    said = (field.metadata or {}).get("comment", "").replace("'", "''")
    return f"`{field.name}` {field.dataType.simpleString()}" + (f" COMMENT '{said}'" if said else "")


def _places(spark: SparkSession, layer: str, generation: str) -> dict[str, str]:
    """Day to place of a generation; one row per stored day."""
    short = generation.rsplit("__", 1)[0]
    found = spark.read.schema("day string, place string").parquet(
        f"{_layer_place(spark, layer)}/{short}.days/list-{generation}"
    )
    return {r.day: r.place for r in found.collect()}


def _repoint(spark: SparkSession, view: str, generation: str, comment: str, properties: dict[str, str] | None) -> None:
    text = comment.replace("'", "''")
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    more = f" TBLPROPERTIES ({pairs})" if pairs else ""
    spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT '{text}'{more} AS SELECT * FROM {generation}")


def _comment(spark: SparkSession, view: str) -> str:
    return spark.catalog.getTable(view).description or ""


def property_of(spark: SparkSession, name: str, key: str) -> str | None:
    """A text published together with the content of ``name``."""
    found = spark.sql(f"SHOW TBLPROPERTIES {full_name(name)}").collect()
    return next((r.value for r in found if r.key == key), None)


def _drop(spark: SparkSession, layer: str, short: str, old: list[str]) -> None:
    """Drop generations that are no longer read, and the days that no later one points at."""
    if not old:
        return
    listed = [g for g in old if _listed(spark, layer, short, g)]
    if listed:
        later = [g for g in _generations(spark, layer, short) if g not in old and _listed(spark, layer, short, g)]
        needed = {p for g in later for p in _places(spark, layer, g).values()}
        place = _layer_place(spark, layer)
        for generation in listed:
            for where in set(_places(spark, layer, generation).values()) - needed:
                _delete(spark, where)
            _delete(spark, f"{place}/{short}.days/list-{generation}")
    for generation in old:
        spark.sql(f"DROP TABLE IF EXISTS {layer}.{generation}")


def _path(spark: SparkSession, where: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _listed(spark: SparkSession, layer: str, short: str, generation: str) -> bool:
    files, path = _path(spark, f"{_layer_place(spark, layer)}/{short}.days/list-{generation}")
    return files.exists(path)


def _delete(spark: SparkSession, where: str) -> None:
    files, path = _path(spark, where)
    files.delete(path, True)


def stored_days(spark: SparkSession, name: str, day: str = "utc_day") -> list[date]:
    """The days a published table is stored by, newest first, from its partition list."""
    layer, short = full_name(name).split(".")
    current = f"{layer}.{_generations(spark, layer, short)[-1]}"
    values = [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {current}").collect()]
    return sorted((date.fromisoformat(v) for v in values if v[:1].isdigit()), reverse=True)


def newest_rows(rows: DataFrame, days: list[date], day: str = "utc_day") -> DataFrame:
    """Rows of the newest days that hold any, without reading the days before them.

    Days are tried from the newest on, in spans of one, two, four and so on; the first
    span with a row is the result, and holds the newest rows of all.
    """
    at, span = 0, 1
    while at < len(days):
        newest, oldest = days[at], days[min(at + span, len(days)) - 1]
        found = rows.filter(F.col(day).between(F.lit(oldest), F.lit(newest)))
        if not found.isEmpty():
            return found
        at, span = at + span, 2 * span
    return rows.filter(F.lit(False))


def on_days(df: DataFrame, days: Iterable[date | None], day: str = "utc_day") -> DataFrame:
    """Rows of these days of a table stored by day (None: of no day); any other table as it is."""
    if day not in df.columns:
        return df
    known = sorted(d for d in days if d is not None)
    wanted = F.col(day).isin(known) if known else F.lit(False)
    return df.filter(wanted | F.col(day).isNull() if None in set(days) else wanted)


def _generations(spark: SparkSession, layer: str, short: str) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {layer} LIKE '{short.lower()}__*'")
    return sorted(row.tableName for row in found.collect())


def save_zone_station_map(zone_stations: DataFrame, path: str) -> None:
    """S9."""
    zone_stations.write.mode("overwrite").parquet(path)


def plain_view(df: DataFrame, name: str) -> DataFrame:
    """A named view for the session."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
