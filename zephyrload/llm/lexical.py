"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through its normaliser m, a small whole number.
Documents of equal m form a stratum. Within a stratum the postings of a term are grouped by
tf, and as score per unit of weight follows from (m, tf) alone, every impact is computed
once per tf of a stratum. The largest tf of each term in a stratum bounds what any of its
documents can score for a query; a task visits its strata from the highest bound down and leaves
out those that cannot reach the query's k-th best score so far.

Queries are dealt with in blocks of bounded vocabulary, each a pass over the documents:
term counts of every document for the block's terms, dealt by ranges of m that hold about
as many postings each, so that a stratum's documents lie together; a stratum that fills several ranges is
dealt to them by a hash. Each task returns its best k per query, and a window
takes the best of those.

Terms are runs of ASCII letters and digits and of anything beyond ASCII; A-Z are lower-cased.

Defined cases: a NULL or empty text, or one without terms, is in no stratum and is
not counted; a query without terms, or whose terms no document holds, returns no row; repeated
rows of documents rank each, repeated query rows as one per row; equal scores go by
ascending doc_id, a NULL id last, and equal ids by nothing further; very long texts count like any other.
Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import as_bytes, bound_batches, plain_words, stage, vector_sum

TOP = 20
#: Distinct terms and bytes of terms that one block of queries may have.
BLOCK_TERMS = 200_000
BLOCK_BYTES = 4 << 20
#: Postings a scoring task gets on average, and holds at a time at most (but for one stratum's document).
TASK_POSTINGS = 2_000_000
HELD_POSTINGS = 1_000_000
#: Ranges of m that the strata are cut into at most; beyond, a range is dealt by hash.
MOST_RANGES = 1024
# Fixed values of the score.
_B, _K, _ONE, _THOUSAND = 25, 12, 1_000_000_000, 1000


def weight(n_documents: int, df: int) -> int:
    return math.floor(_THOUSAND * math.log((2 * n_documents + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    """Score of tf occurrences per unit of weight, in documents of normaliser m."""
    return (_ONE * tf) // (_THOUSAND * tf + _K * m)


def query_blocks(queries: DataFrame, item_id: str, text: str, most_terms: int, most_bytes: int) -> Iterator[list[tuple]]:
    """Blocks of (item number, item_id, Counter of terms), each with a bounded vocabulary.

    One query's text is held at a time; a query that alone has more terms is a block
    alone, so a block is bounded by these or by its one query's text.
    """
    rows = queries.select(F.col(f"`{item_id}`").alias("item_id"), as_bytes(f"`{text}`").alias("data"))
    block, terms, size = [], set(), 0
    for number, row in enumerate(rows.toLocalIterator()):
        counts = Counter(plain_words(row.data))
        if not counts:
            continue
        new = counts.keys() - terms
        new_size = sum(map(len, new))
        if block and (len(terms) + len(new) > most_terms or size + new_size > most_bytes):
            yield block
            block, terms, size, new_size = [], set(), 0, sum(map(len, counts))
            new = set(counts)
        block.append((number, row.item_id, counts))
        terms |= new
        size += new_size
    if block:
        yield block


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """doc_id, n (all terms) and, for terms of the vocabulary, their numbers and tf as int32 arrays in binary."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), as_bytes(f"`{text}`").alias("data"))
    schema = T.StructType(
        [
            T.StructField("doc_id", source.schema["doc_id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("n_postings", T.LongType()),
            T.StructField("terms", T.BinaryType()),
            T.StructField("tf", T.BinaryType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = shared.value.get
        for batch in batches:
            n, held, terms, tf = [], [], [], []
            for data in batch.column(1).to_pylist():
                words = plain_words(data)
                numbers = np.fromiter(map(number_of, words, repeat(size)), np.int32, len(words))
                if len(words) > size:
                    times = np.bincount(numbers, minlength=size + 1)[:size]
                    found = np.flatnonzero(times).astype(np.int32)
                    times = times[found]
                else:
                    found, times = _counted(numbers[numbers < size])
                n.append(len(words))
                held.append(len(found))
                terms.append(found.tobytes())
                tf.append(times.astype(np.int32).tobytes())
            made = [pa.array(n, pa.int64()), pa.array(held, pa.int64()), pa.array(terms, pa.binary()), pa.array(tf, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    return source.mapInArrow(run, schema).where(F.col("n") > 0)


def _counted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    numbers = np.sort(numbers)
    edge = np.flatnonzero(np.diff(numbers)) + 1
    edges = np.concatenate(([0], edge, [len(numbers)])) if len(numbers) else np.zeros(1, np.int64)
    return numbers[edges[:-1]], np.diff(edges)


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """Documents holding each term of a vocabulary of ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size, np.int64)
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(data, np.int32), minlength=size)
        part = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([part, pa.array([total.tobytes()], pa.binary())], names=["part", "vector"])

    return vector_sum(counts.select("terms").mapInArrow(run, "part int, vector binary"), size)


class Best:
    """The k best (score, row) of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A score below this one is of no use; one equal to it may be, by its id."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]


class Stratum:
    """Documents of one normaliser: postings by term, each with the impact of its tf."""

    def __init__(self, m: int, docs: np.ndarray, owner: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        self.docs = docs
        # impacts once per tf of the stratum
        tfs, which = np.unique(tf, return_inverse=True)
        impacts = impact(tfs.astype(np.int64), m)
        order = np.lexsort((which, terms))  # by term, and by tf within a term
        self.owner = owner[order]
        self.impact = impacts[which[order]]
        ordered = terms[order]
        starts = np.flatnonzero(np.concatenate(([True], np.diff(ordered) > 0))) if len(ordered) else np.zeros(0, np.int64)
        self.terms = ordered[starts]
        self.edges = np.append(starts, len(ordered))
        # postings of a term ascend by tf, so its last one has the largest impact
        self.top = self.impact[self.edges[1:] - 1] if len(starts) else np.zeros(0, np.int64)

    def places(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms the stratum holds, and where."""
        at = np.searchsorted(self.terms, terms)
        held = at < len(self.terms)
        held[held] = self.terms[at[held]] == terms[held]
        return held, at[held]

    def score(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.docs), np.int64)
        for a, w in zip(at.tolist(), weights.tolist(), strict=True):
            low, high = self.edges[a], self.edges[a + 1]
            total[self.owner[low:high]] += w * self.impact[low:high]
        return total


def visit(strata: list[Stratum], queries: list[tuple[np.ndarray, np.ndarray]], best: list[Best]) -> None:
    """Score all queries, each in the order of the strata's bounds."""
    for (terms, weights), found in zip(queries, best, strict=True):
        plan = []
        for stratum in strata:
            held, at = stratum.places(terms)
            w = weights[held]
            plan.append((int((w * stratum.top[at]).sum()), at, w, stratum))
        plan.sort(key=lambda p: -p[0])
        for bound, at, w, stratum in plan:
            if bound < found.least or bound <= 0:
                break
            score = stratum.score(at, w)
            hits = np.flatnonzero(score >= max(found.least, 1))
            if len(hits):
                found.add(score[hits], stratum.docs[hits])


def best_documents(
    documents: DataFrame,
    queries: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    query_text: str = "text",
    k: int = TOP,
    block_terms: int = BLOCK_TERMS,
    block_bytes: int = BLOCK_BYTES,
    task_postings: int = TASK_POSTINGS,
    held_postings: int = HELD_POSTINGS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every query with a score above 0."""
    spark = documents.sparkSession
    schema = T.StructType(
        [
            T.StructField("item", T.LongType()),
            T.StructField("item_id", queries.schema[item_id].dataType),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )
    found = []
    for block in query_blocks(queries, item_id, query_text, block_terms, block_bytes):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(counts for _, _, counts in block))))}
        counts = stage(term_counts(documents, vocabulary, doc_id, text), "term-counts")
        totals = counts.agg(F.count("*").alias("N"), F.sum("n").alias("L"), F.sum("n_postings").alias("p")).first()
        if not totals.N:
            break
        df = document_frequencies(counts, len(vocabulary))
        weights = np.array([weight(totals.N, int(d)) for d in df], np.int64)
        wanted = []
        for number, item, terms in block:
            places = np.array([vocabulary[t] for t in terms], np.int64)
            order = np.argsort(places)
            times = np.array(list(terms.values()), np.int64)
            wanted.append((number, item, places[order], (times * weights[places])[order]))
        found.append(stage(_block_best(counts, totals, wanted, schema, k, task_postings, held_postings), "best"))
    if not found:
        every = spark.createDataFrame([], schema)
    else:
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values]) if values else F.expr("array()").cast("array<long>")


def _block_best(counts, totals, wanted, schema, k, task_postings, held_postings) -> DataFrame:
    """Each task's best documents for the queries of a block."""
    m = F.lit(100 - _B) + F.expr(f"({_B} * n * {totals.N}L) div {totals.L}L")
    rows = counts.where(F.col("n_postings") > 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), m.cast("long").alias("m"), "terms", "tf", "n_postings"
    )
    parts = max(1, -(-int(totals.p) // task_postings))
    ranges = min(4 * parts, MOST_RANGES)
    share = F.array(*[F.lit((i + 1) / ranges) for i in range(ranges - 1)])
    cuts = rows.agg(F.percentile("m", share, F.col("n_postings"))).first()[0] if ranges > 1 else []
    cuts = [math.floor(c) for c in cuts or []]
    # a stratum that several cuts fall into is dealt to all the ranges between them
    edges = _longs(cuts)
    low, high = (F.size(F.filter(edges, below)) for below in (lambda c: c < F.col("m"), lambda c: c <= F.col("m")))
    hash_ = F.xxhash64("doc_id", "terms")
    more = -(-4 * parts // ranges)
    dealt = (
        rows.withColumn("range", low + F.pmod(hash_, high - low + 1))
        .repartition(parts, "range", F.pmod(F.xxhash64(hash_), F.lit(more)))
        .sortWithinPartitions("m")
        .select("doc_id", "m", "terms", "tf")
    )
    queries = counts.sparkSession.sparkContext.broadcast(wanted)
    none = np.iinfo(np.int64).max  # a NULL id comes after all others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(terms, weights) for _, _, terms, weights in queries.value]
        best = [Best(k) for _ in asked]
        pending: list[tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]] = []
        held = 0

        def settle() -> None:
            nonlocal held
            if pending:
                visit(_strata(pending), asked, best)
            pending.clear()
            held = 0

        for batch in batches:
            docs = np.asarray(batch.column(0).fill_null(none))
            ms = np.asarray(batch.column(1))
            terms, tf = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            pending.append((docs, ms, terms, tf))
            held += sum(map(len, terms)) // 4
            if held >= held_postings:
                settle()
        settle()
        rows = [(n, item, int(d), int(s)) for (n, item, _, _), b in zip(queries.value, best, strict=True) for d, s in zip(b.doc, b.score, strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        kinds = [pa.int64(), _arrow_kind(schema["item_id"].dataType), pa.int64(), pa.int64()]
        columns[2] = [None if d == none else d for d in columns[2]]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)

    return dealt.mapInArrow(run, schema)


def _strata(pending: list[tuple]) -> list[Stratum]:
    docs = np.concatenate([p[0] for p in pending])
    ms = np.concatenate([p[1] for p in pending])
    terms = [t for p in pending for t in p[2]]
    tf = [t for p in pending for t in p[3]]
    out = []
    edges = np.flatnonzero(np.diff(ms)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(ms)], strict=True):
        sizes = np.array([len(t) // 4 for t in terms[low:high]])
        owner = np.repeat(np.arange(high - low), sizes)
        out.append(
            Stratum(
                int(ms[low]),
                docs[low:high],
                owner,
                np.frombuffer(b"".join(terms[low:high]), np.int32),
                np.frombuffer(b"".join(tf[low:high]), np.int32),
            )
        )
    return out


def _arrow_kind(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
