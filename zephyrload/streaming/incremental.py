"""Incremental ingest with Structured Streaming (R-INC).

New response files are appended to a change log by a file stream: its
checkpoint makes every file count once, also after a lost executor or a
restarted job. The current table is read from the log per key, so loads never
rewrite stored payloads; ``upserts.load_changed`` is the batch form.

The log grows with every delivery. ``compact`` keeps the current rows of each target day in a
table stored by day and notes the newest batch in it, in the same step that shows
the rows; afterwards only that table and the batches since are opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zephyrload.functions.records import PAGE_SIZE
from zephyrload.operators.dedupe import keep_first
from zephyrload.operators.upserts import staged
from zephyrload.schemas import SAVED_RESPONSE
from zephyrload.sources.landing import landing_rows
from zephyrload.sources.tables import on_days, payload_writer, property_of, publish, publish_days, stored, table_exists

# VARIANT columns are kept as JSON text in the log, which every file sink takes.
_PAYLOAD = "raw_response"
_UPTO = "upto_batch"


def append_new_responses(
    spark: SparkSession, arrivals: str, log: str, checkpoint: str, page_size: int = PAGE_SIZE
) -> None:
    """Land all response files that arrived since the last call.

    A batch is a directory of its own, so a batch that is run again replaces itself.
    """
    responses = spark.readStream.schema(SAVED_RESPONSE).json(arrivals)
    rows = landing_rows(responses, strict=False, page_size=page_size)
    rows = rows.withColumn(_PAYLOAD, F.to_json(_PAYLOAD)).withColumn(
        "target_day", F.substring("target_dt", 1, 10).try_cast("date")
    )

    def keep(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("batch", F.lit(number).cast("bigint"))
        writer = payload_writer(numbered).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch", "target_day").parquet(log)

    query = (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The change log with its payload as VARIANT again."""
    rows = spark.read.parquet(log).withColumn(_PAYLOAD, F.parse_json(_PAYLOAD))
    return rows.withColumns({"batch": F.col("batch").cast("bigint"), "target_day": F.col("target_day").cast("date")})


def current_rows(
    log: DataFrame, keys: list[str], hash_column: str = "response_hash", at: str = "request_timestamp"
) -> DataFrame:
    """What hash-guarded upserts of the log in time order would have stored.

    That is, per key, the first row after its last change of hash. The newest
    hash and the moment the one before it was last seen are found on keys,
    hashes and times alone; both steps shrink ahead of their shuffle, so a key
    with very many versions is never gathered in one place. Rows with a NULL
    key are all kept, like those of an upsert that finds no match.
    """
    every = log.dropna(subset=keys)
    # a NULL hash is never a change: it stays where a key began with it and else counts for nothing
    began = keep_first(every, keys, [at]).filter(F.col(hash_column).isNull()).select(*log.columns)
    keyed = every.filter(F.col(hash_column).isNotNull()).join(began.select(*keys), keys, "left_anti")
    seen = (
        keyed.groupBy(*keys, hash_column)
        .agg(F.max(at).alias("_last"))
        .withColumn("_seen", F.struct("_last", hash_column))
    )
    newest_first = Window.partitionBy(*keys).orderBy(F.col("_seen").desc())
    settled = (
        seen.withColumn("_rank", F.row_number().over(newest_first))
        .filter("_rank <= 2")
        .groupBy(*keys)
        .agg(
            F.max("_seen").getField(hash_column).alias("_tip"),
            F.max(F.when(F.col("_rank") == 2, F.col("_seen"))).alias("_before"),
        )
    )
    after = F.col("_before").isNull() | (
        F.struct(F.col(at).alias("_last"), F.col(hash_column)) > F.col("_before")
    )
    candidates = (
        keyed.join(settled, keys)
        .filter((F.col(hash_column) == F.col("_tip")) & after)
        .select(*log.columns)
    )
    any_null = " OR ".join(f"{k} IS NULL" for k in keys)
    return keep_first(candidates, keys, [at]).unionByName(began).unionByName(log.filter(any_null))


def _changed_days(
    log: DataFrame, kept: DataFrame, fresh: DataFrame, days: list, keys: list[str], at: str
) -> DataFrame:
    """Current rows of the days of new batches.

    Rows newer than all that a day was made of go on from its kept rows. A row that
    comes late could have been a change in between, so its day is made from its whole log.
    """
    seen = kept.groupBy(F.col("target_day").alias("_day")).agg(F.max("seen_until").alias("_until"))
    behind = fresh.select("target_day", F.col(at).alias("_at")).join(seen, F.col("target_day").eqNullSafe(F.col("_day")))
    late = [r[0] for r in behind.filter("_at <= _until").select("target_day").distinct().collect()]
    parts = [on_days(log, late, "target_day").filter(F.col("batch") <= _newest(fresh))] if late else []
    in_time = [d for d in days if d not in late]
    if in_time:
        columns = log.columns
        parts += [
            on_days(fresh, in_time, "target_day"),
            on_days(kept, in_time, "target_day").withColumn("batch", F.lit(-1).cast("bigint")).select(*columns),
        ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return current_rows(every, keys, at=at)


def _newest(fresh: DataFrame) -> int:
    return fresh.agg(F.max("batch")).first()[0]


def _fresh(spark: SparkSession, log: str, table: str) -> tuple[DataFrame, DataFrame, int, list]:
    """The log, its batches that the table does not hold, the newest of them (-1: none), their days."""
    every = read_log(spark, log)
    upto = int(property_of(spark, table, _UPTO) or -1) if table_exists(spark, table) else -1
    fresh = every.filter(F.col("batch") > upto)
    # both are directories' names: no file's columns are read
    found = fresh.groupBy("target_day").agg(F.max("batch").alias("b")).collect()
    return every, fresh, max((r.b for r in found), default=-1), [r.target_day for r in found]


def compact(
    spark: SparkSession, log: str, table: str, keys: list[str], at: str = "request_timestamp"
) -> DataFrame:
    """Take the batches since the last call into the table of current rows.

    Only days of these batches are read and replaced. Rows and the number of the newest
    batch appear in one step, so a call that fails, or is repeated, changes nothing.
    """
    every, fresh, newest, days = _fresh(spark, log, table)
    if newest < 0:
        return stored(spark, table)
    until = fresh.groupBy(F.col("target_day").alias("_day")).agg(F.max(at).alias("seen_until"))
    properties = {_UPTO: str(newest)}
    if not table_exists(spark, table):
        rows = staged(current_rows(fresh, keys, at=at).drop("batch"), "compacted")
        rows = rows.join(until, F.col("target_day").eqNullSafe(F.col("_day"))).drop("_day")
        return publish(rows, table, "Current responses by target day", ("target_day",), properties)
    kept = on_days(stored(spark, table), days, "target_day")
    rows = _changed_days(every, kept, fresh, days, keys, at).drop("batch")
    before = kept.groupBy(F.col("target_day").alias("_day")).agg(F.max("seen_until").alias("seen_until"))
    until = until.unionByName(before).groupBy("_day").agg(F.max("seen_until").alias("seen_until"))
    rows = staged(rows.join(until, F.col("target_day").eqNullSafe(F.col("_day"))).drop("_day"), "compacted")
    return publish_days(rows, table, "target_day", days=days, properties=properties)


def current_from_compacted(
    spark: SparkSession, log: str, table: str, keys: list[str], at: str = "request_timestamp"
) -> DataFrame:
    """Current rows of everything landed: the compacted days, and those with newer batches."""
    every, fresh, newest, days = _fresh(spark, log, table)
    kept = stored(spark, table)
    if newest < 0:
        return kept.drop("seen_until")
    changed = _changed_days(every, on_days(kept, days, "target_day"), fresh, days, keys, at).drop("batch")
    same = kept.filter(~F.coalesce(F.col("target_day").isin([d for d in days if d is not None]), F.lit(None in days)))
    return same.drop("seen_until").unionByName(changed)


def first_rows(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """What insert-only upserts of the log would have stored."""
    return keep_first(log, keys, order)
