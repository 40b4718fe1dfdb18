"""Packing documents into sequences of fixed length by the sum-of-squares rule.

A document becomes token pieces of at most ``capacity``; only longer documents are
cut, and the first piece takes what does not fill a whole one. Whole pieces are
sequences by themselves. The others are placed one after the other where the sum,
over all residual gaps, of the squared number of open sequences with that gap becomes
smallest, a sequence without gap being closed.

The rule needs lengths alone, and there are fewer than ``capacity`` of them. So the
driver gets a histogram, packs it into a plan of at most ``plan_pieces`` placements,
and the plan is carried out by joins: when there are more pieces, the plan holds for
``lanes`` sequences at a time, and the pieces left over by a length (fewer than
``lanes``) form the histogram of a next plan. A piece's place in the plan follows from
its rank among the pieces of its length, which is counted in buckets, so that a
length, however frequent, is never in one task.

Defined cases: a NULL or empty text is a document of the end token alone; a NULL id is
kept; repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.bpe import ByteBpe
from zephyrload.llm.common import added_name, bound_batches, per_process, quoted, stage

CAPACITY = 1024
END_TOKEN = 2
PLAN_PIECES = 1 << 16
#: Pieces a bucket holds on average.
BUCKET_PIECES = 20_000

def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    keep: list[str] | None = None,
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: columns ``keep``, piece, start, length, ids_crc32 (and ids).

    A new column whose name is kept already gets underscores.
    """
    keep = ["doc_id"] if keep is None else keep
    bound_batches(docs.sparkSession)
    # placeholder names inside the pass: column names may clash or hold dots
    source = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(keep)], quoted(text).cast("binary").alias("value"))
    fields = [T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32"))]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType([*(T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)), *fields])
    end = np.array([end_token], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = per_process(ByteBpe, tokenizer_path)
        for batch in batches:
            ids = bpe.encode(batch.column(batch.num_columns - 1).to_pylist())
            data = memoryview(end.join([*ids, b""]))
            n = np.array([len(i) // 4 + 1 for i in ids], np.int64)
            pieces = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            # the first piece takes what does not fill a whole one
            first = (n - (pieces - 1) * capacity)[row]
            start = np.where(piece > 0, first + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first)
            low = 4 * ((np.cumsum(n) - n)[row] + start)
            spans = list(zip(low.tolist(), (low + 4 * length).tolist(), strict=True))
            made = [
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(data[a:b]) for a, b in spans], pa.int64()),
            ]
            if with_ids:
                made.append(pa.array([bytes(data[a:b]) for a, b in spans], pa.binary()))
            kept = [batch.column(i).take(pa.array(row)) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    names = list(keep)
    for f in fields:
        names.append(added_name(names, f.name))
    return source.mapInArrow(run, schema).toDF(*names)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every length, placed in the order given.

    A sequence is opened when no open one has room. Moving a sequence from gap g to gap
    g - size changes the sum of squares by 2 * (N[g - size] - N[g]) + 2, closing it by
    1 - 2 * N[g]; the smallest change wins, then the smallest gap.
    """
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)  # gap 0, closed, stays 0
    used = 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, size in enumerate(lengths.tolist()):
        change = 2 * (counts[: capacity - size + 1] - counts[size:]) + 2
        change[0] -= 1
        change[counts[size:] == 0] = 1 << 40
        gap = int(np.argmin(change)) + size
        if counts[gap]:
            where = open_by_gap[gap].pop()
            counts[gap] -= 1
        else:
            gap, where = capacity, used
            used += 1
        sequence[k], offset[k] = where, capacity - gap
        if gap > size:
            open_by_gap[gap - size].append(where)
            counts[gap - size] += 1
    return sequence, offset


def plans(histogram: dict[int, int], capacity: int, plan_pieces: int) -> tuple[list, dict]:
    """Placements of all lengths below ``capacity``, longest first.

    A plan holds at least ``capacity`` placements, so that some length always fills a lane.

    Rows (length, first rank, first sequence, offset): ranks first rank + i, for i
    below lanes, go to sequence first sequence + i. The lanes of a length's ranks:
    length -> [(from rank, lanes)], in order.
    """
    rows, used, lanes_of = [], 0, {}
    left = {size: n for size, n in histogram.items() if 0 < size < capacity and n}
    ranks = dict.fromkeys(left, 0)
    while left:
        lanes = -(-sum(left.values()) // max(plan_pieces, capacity))
        sizes = np.array(sorted((s for s in left if left[s] >= lanes), reverse=True), np.int64)
        times = np.array([left[s] // lanes for s in sizes.tolist()], np.int64)
        for size in sizes.tolist():
            lanes_of.setdefault(size, []).append((ranks[size], lanes))
        order = np.repeat(sizes, times)
        if len(order):
            sequence, offset = sum_of_squares(order, capacity)
            for size, where, at in zip(order.tolist(), sequence.tolist(), offset.tolist(), strict=True):
                rows.append((size, ranks[size], used + where * lanes, at))
                ranks[size] += lanes
            used += (int(sequence.max()) + 1) * lanes
        left = {s: n % lanes for s, n in left.items() if n % lanes}
    return rows, lanes_of


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    plan_pieces: int = PLAN_PIECES,
    bucket_pieces: int = BUCKET_PIECES,
    label: str = "pieces",
) -> DataFrame:
    """Add sequence_id and offset to rows of doc_id, piece, start, length, ids_crc32."""
    spark = pieces.sparkSession
    pieces = stage(pieces, label)
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, lanes_of = plans(histogram, capacity, plan_pieces)
    buckets = 1 + sum(histogram.values()) // bucket_pieces

    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = dealt.withColumn("nth", F.row_number().over(inside) - 1).join(offsets, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth"))

    # which lanes a rank falls in: a few entries for each of the lengths below capacity
    lanes = spark.createDataFrame(
        [(size, [{"first": a, "lanes": n} for a, n in found]) for size, found in lanes_of.items()],
        "length long, steps array<struct<first:long,lanes:long>>",
    )
    plan = spark.createDataFrame(
        pa.table(
            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], [], []))],
            names=["length", "first_rank", "first_sequence", "offset"],
        )
    )
    step = F.element_at(F.filter("steps", lambda s: s["first"] <= F.col("rank")), -1)
    lane = (F.col("rank") - F.col("step.first")) % F.col("step.lanes")
    cut = (
        ranked.where(F.col("length") < capacity)
        .join(lanes, "length")
        .withColumn("step", step)
        .withColumn("lane", lane)
        .withColumn("first_rank", F.col("rank") - F.col("lane"))
        .join(plan, ["length", "first_rank"])
        .withColumn("sequence_id", F.col("first_sequence") + F.col("lane"))
    )
    whole = ranked.where(F.col("length") >= capacity).select(
        *pieces.columns, (-1 - F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return cut.select(*pieces.columns, "sequence_id", "offset").unionByName(whole)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    capacity: int = CAPACITY,
    plan_pieces: int = PLAN_PIECES,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    texts = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return pack(token_pieces(texts, tokenizer_path, capacity=capacity), capacity, plan_pieces)
