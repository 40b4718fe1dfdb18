"""Near-duplicate documents by min-max hashing.

A document's set is its distinct 2-word shingles (A-Z lower-cased, split at ASCII white
space; a single word is the whole set of its document). Under every permutation both
the smallest and the largest hash are kept, so ``BANDS * ROWS`` signature values need
half as many permutations. Each band's values make a bucket key. At a similarity of
0.8 a pair shares no bucket with probability (1 - 0.8**ROWS)**BANDS, about 5e-6.

Links are confirmed on full sets:

1. Documents with equal sets form a class; only its smallest id goes on.
2. In every bucket all members are compared with the bucket's smallest id.
3. Components are formed; where a bucket still holds several, members of different
   components are compared. Large buckets are split into blocks and each two blocks
   meet in a cell, where intersections are counted by matrix products over 32-bit
   shingle hashes; no pairs are joined, and only pairs that may be links come out, to be
   confirmed like the others. Pairs within a component need no test.

Components are found by passing the smallest id along links until nothing changes, all
by joins and grouped minima, with each round written to the shared folder.

Defined cases: documents without words have an empty set and stay alone; rows that
repeat an id and a text share their class; a NULL id takes no part in links and is its
own component, kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import WordHashes, bound_batches, map_texts, mix, per_process, placeholders, quoted, stage

ROWS = 6
BANDS = 40
PERCENT = 80
#: Members of a block of a bucket.
BLOCK = 512

_SEED = 20240229

FIELDS = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_hi", T.LongType()),
    T.StructField("set_lo", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType(), containsNull=False)),
]


def shingles(data: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Ascending distinct 64-bit shingle hashes."""
    words = data.lower().split() if data else []
    h = hashes.of(words)
    if len(h) > 1:
        h = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(h[1:]))
    return np.unique(h)


class MinMax:
    """Signatures of sets: the smallest and largest value under each permutation."""

    def __init__(self, rows: int = ROWS, bands: int = BANDS):
        if rows * bands % 2:
            raise ValueError("signature values come in pairs: rows * bands must be even")
        random = np.random.default_rng(_SEED)
        n = rows * bands // 2
        self.a = random.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
        self.b = random.integers(0, 1 << 32, n, dtype=np.uint32)
        self.rows, self.bands = rows, bands
        # the values of a band come from different permutations
        self.order = random.permutation(2 * n)
        self.salt = random.integers(0, 1 << 63, bands, dtype=np.uint64)

    def signature(self, members: np.ndarray) -> np.ndarray:
        """Minima of all permutations, then their maxima."""
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        high = np.zeros(len(self.a), np.uint32)
        x = (members >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(x), 2048):
            part = x[None, at : at + 2048] * self.a[:, None]
            part += self.b[:, None]
            part ^= part >> np.uint32(15)
            np.minimum(low, part.min(1), out=low)
            np.maximum(high, part.max(1), out=high)
        return np.concatenate([low, high])

    def keys(self, members: np.ndarray) -> np.ndarray:
        """One 64-bit bucket key for each band."""
        values = self.signature(members)[self.order].reshape(self.bands, self.rows).astype(np.uint64)
        key = self.salt.copy()
        for k in range(self.rows):
            key = mix(key ^ values[:, k] * np.uint64(0x9E3779B97F4A7C15))
        return key.view(np.int64)


def sketches(docs: DataFrame, text: str, keep: list[str], rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Columns ``keep``, n_shingles, a 128-bit digest of the set and its bucket keys."""

    def factory():
        hashes, minmax = per_process(WordHashes), per_process(MinMax, rows, bands)

        def compute(texts):
            sets = [shingles(t, hashes) for t in texts]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            keys = [minmax.keys(s) if len(s) else np.zeros(0, np.int64) for s in sets]
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            return [
                list(map(len, sets)),
                np.array([d >> 64 for d in digests], np.uint64).view(np.int64),
                np.array([d & 0xFFFFFFFFFFFFFFFF for d in digests], np.uint64).view(np.int64),
                pa.ListArray.from_arrays(ends, np.concatenate([*keys, np.zeros(0, np.int64)])),
            ]

        return compute

    return map_texts(docs, text, keep, FIELDS, factory)


class _Recent(dict):
    """Sets of the ids met last: a bucket's first id recurs in many pairs."""

    def of(self, key: int, data: bytes, hashes: WordHashes) -> np.ndarray:
        if len(data) > 1 << 16 or key not in self:
            found = shingles(data, hashes)
            if len(data) > 1 << 16:
                return found
            if len(self) >= 256:
                self.clear()
            self[key] = (data, found)
        known, found = self[key]
        return found if known == data else shingles(data, hashes)


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def check(batches):
        hashes, recent = per_process(WordHashes), _Recent()
        for batch in batches:
            linked = []
            for a, x, y in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                s, t = recent.of(a, x, hashes), shingles(y, hashes)
                common = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * common >= percent * (len(s) + len(t) - common))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], names=["a", "b"])

    return stage(both.mapInArrow(check, "a long, b long"), "near-links")


def _similar_across(inside: DataFrame, texts: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of different components that meet in a bucket and may be links.

    ``inside`` has key, id, n, component and the size of the bucket. Short hashes can
    only merge shingles, and as many as a set loses by that are granted to each pair,
    so no link is lost here.
    """

    def factory():
        hashes = per_process(WordHashes)
        return lambda found: [[np.unique(shingles(t, hashes).astype(np.uint32)).tobytes() for t in found]]

    sets = map_texts(texts, "text", ["id"], [T.StructField("short", T.BinaryType())], factory)
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = inside.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    cell = ["key", "low", "high"]
    dealt = dealt.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "id", "n", "component",
    ).join(sets, "id")
    order = [*cell, "block", "id", "n", "component", "short"]
    dealt = dealt.select(*order).repartition(*cell).sortWithinPartitions(*cell)

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(len(order))), strict=True):
                if row[:3] != key:
                    if len(rows) > 1:
                        yield _cell_links(rows, percent)
                    key, rows = row[:3], []
                rows.append(row)
        if len(rows) > 1:
            yield _cell_links(rows, percent)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _cell_links(rows: list[tuple], percent: int, width: int = 4096) -> pa.RecordBatch:
    """Possible links between the two blocks of a cell, or within its only one."""
    low, high = rows[0][1], rows[0][2]
    left = [k for k, r in enumerate(rows) if r[3] == low]
    right = left if low == high else [k for k, r in enumerate(rows) if r[3] == high]
    sets = [np.frombuffer(r[7], np.uint32) for r in rows]
    used, counts = np.unique(np.concatenate(sets), return_counts=True)
    used = used[counts > 1]
    spots = [np.searchsorted(used, x[np.isin(x, used, assume_unique=True)]) for x in sets]
    common = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(used), width):
        grid = np.zeros((len(rows), min(width, len(used) - at)), np.float32)
        for k, x in enumerate(spots):
            grid[k, x[np.searchsorted(x, at) : np.searchsorted(x, at + width)] - at] = 1
        common += grid[left] @ grid[right].T
    ids, n, component = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 6))
    lost = n - np.array([len(x) for x in sets])
    i, j = (np.array(x, np.int64) for x in (left, right))
    most = common.astype(np.int64) + np.minimum.outer(lost[i], lost[j])
    linked = (100 + percent) * most >= percent * np.add.outer(n[i], n[j])
    linked &= np.not_equal.outer(component[i], component[j])
    x, y = np.nonzero(linked)
    a, b = ids[i[x]], ids[j[y]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (a, b): the smallest id it reaches.

    Alternates between linking larger neighbours, then all neighbours, to the smallest
    neighbour, so the links become stars within a number of rounds that grows with the
    logarithm of the longest path.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc"
    )
    shape = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = edges.agg(*shape).first()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = small.union(down.select("u", F.col("m").alias("v"))).distinct()
        after = stage(after, "cc")
        now = after.agg(*shape).first()
        if now == before:
            stars = after.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
            roots = stars.select(F.col("component").alias("id"), "component").distinct()
            return stage(stars.union(roots), "components")
        edges, before = after, now


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept of every row."""
    bound_batches(docs.sparkSession)
    source = docs.select(quoted(doc_id).cast("long").alias("id"), quoted(text).cast("binary").alias("text"))
    signed = stage(sketches(source, "text", ["id"], rows, bands), "near-sketches")
    real = signed.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    equal = ["n_shingles", "set_hi", "set_lo"]
    classes = real.groupBy(*equal).agg(F.min("id").alias("class_id"), F.min("bands").alias("bands"))
    classes = stage(classes, "near-classes")

    slots = classes.select(F.col("class_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    firsts = slots.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("size"), F.min_by("n", "id").alias("n_first"))
    shared = firsts.where("size > 1")
    members = stage(slots.join(shared.drop("size"), "key"), "near-members")

    def fits(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    # whole texts of the documents that share any bucket, for both rounds
    some = members.select(F.col("id").alias("id_")).distinct()
    texts = stage(source.join(some, source["id"] == some["id_"], "left_semi"), "near-texts")

    star = members.where((F.col("id") != F.col("first")) & fits("n", "n_first"))
    tried = star.select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = _confirmed(tried, texts, percent)
    found = components(links)

    labelled = members.join(found, "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    )
    several = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")
    )
    open_buckets = several.where("low <> high").select("key", "size")
    inside = stage(labelled.join(open_buckets, "key"), "near-open")
    more = _similar_across(inside, texts, percent).join(tried, ["a", "b"], "left_anti")
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = components(stars.union(_confirmed(stage(more, "near-more"), texts, percent)))

    ends = classes.select(*equal, "class_id").join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
    ends = ends.select(*equal, "class_id", F.coalesce("component", "class_id").alias("component_id"))
    rows_out = signed.select("id", *equal).join(ends, equal, "left")
    alone = F.col("id").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.coalesce("component_id", "id"))
    return rows_out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.coalesce("class_id", "id")).alias("class_id"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def distinct_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents, with all their columns, of which each group keeps its smallest id."""
    plain, stands = placeholders(docs)
    found = near_duplicates(docs, text, doc_id)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return plain.join(gone, F.col(stands[doc_id]) == F.col("gone"), "left_anti").toDF(*docs.columns)
