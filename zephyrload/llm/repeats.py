"""Removal of word passages that occur earlier in the corpus, by De Bruijn compaction.

A window of ``WINDOW`` consecutive words is an edge of a De Bruijn graph over tokens. An
edge is repeated when its word sequence starts earlier, in a smaller doc_id or earlier
in the same document; the words under repeated edges are removed.

* Consecutive edges of a document that share their smallest ``MINIMIZER``-word hash form
  a path. Equal edges have equal smallest hashes, so paths are dealt by that hash and
  equal edges meet, while a path costs one row. Under a hash that very many edges share,
  by a sample's count, edges are dealt by their own hash too: equal ones still meet.
* Edges that recur within a chunk of documents are settled there, word by word, and only
  the chunk's first goes on, so a passage however common reaches a bucket once a chunk.
* A bucket comes in the order of its keys and settles some whole keys at a time: it
  sorts their edges by fingerprint and place; the first is the source. Runs of
  repeated edges whose sources run along with them (paths without a branch) are
  compacted to one span with the coordinates of its source.
* The source's coordinates verify every span: the words of both places are fetched and
  compared by SHA-256. Windows that differ from their source are compared among each
  other; their words' first window stays.
* Spans join their document, where spans that meet are compacted further.

Fingerprints only propose sources: 48 bits of the whole window tell apart the windows
under one smallest hash.

Defined cases: a NULL or empty text has no words; fewer words than a window have no
edge; a NULL id comes after all others and NULL ids count as one; rows that repeat an id
count as one document, so equal rows keep equal words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import (
    WordHashes,
    added_name,
    as_bytes,
    bound_batches,
    flatten,
    mix,
    per_process,
    placeholders,
    stage,
)

WINDOW = 20
MINIMIZER = 6
#: Words of a chunk, and bytes of text a bucket stands for.
CHUNK_WORDS = 400_000
BUCKET_BYTES = 16 << 20
#: Edges of whole keys that are settled at a time.
SETTLE_EDGES = 250_000
#: Edges under one smallest hash from which on they are dealt one by one, and the share
#: of documents, one in so many, that they are counted on. Neither changes the result.
HEAVY_EDGES = 1_000_000
HEAVY_SAMPLE = 32

_LAST = np.iinfo(np.int64).max
_PATHS = "key long, doc_id long, start int, n int, edges binary"
_SPANS = "doc_id long, start int, n int, from_doc long, from_start int"


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values, by its first position; the last ones are unfinished."""
    total = np.zeros(len(hashes), np.uint64)
    for k in range(width):
        total[: len(hashes) - k] = total[: len(hashes) - k] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:]
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` values, by the first position."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step] = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _runs(*changes: np.ndarray) -> np.ndarray:
    """Where runs begin, given for each member but the first whether it differs from the one before."""
    return np.flatnonzero(np.r_[True, np.logical_or.reduce(changes)])


def _confirm(again: np.ndarray, at: np.ndarray, source: np.ndarray, flat: list[bytes], window: int) -> None:
    """Take back the repeats of a chunk whose words are not those of their source."""
    found = np.flatnonzero(again)
    if not len(found):
        return
    here, there = at[found], at[source[found]]
    begins = _runs(here[1:] != here[:-1] + 1, there[1:] != there[:-1] + 1)
    for b, n in zip(begins.tolist(), np.diff(np.r_[begins, len(found)]).tolist(), strict=True):
        x, y, width = int(here[b]), int(there[b]), n + window - 1
        if flat[x : x + width] != flat[y : y + width]:
            for k in range(n):
                again[found[b + k]] = flat[x + k : x + k + window] == flat[y + k : y + k + window]


def chunk_paths(
    ids: list[int | None], words: list[list[bytes]], hashes: WordHashes, window: int, minimizer: int, heavy: np.ndarray | None = None
):
    """Path rows of a chunk; rows without edges are spans settled within the chunk.

    Edges under the smallest hashes ``heavy`` have keys and rows of their own.
    """
    order = sorted(range(len(ids)), key=lambda k: _LAST if ids[k] is None else ids[k])
    flat, ends = flatten([words[k] for k in order])
    if not flat:
        return None
    h = hashes.of(flat)
    sizes = np.diff(ends)
    own = np.repeat(np.array([_LAST if ids[k] is None else ids[k] for k in order], np.int64), sizes)
    text = np.repeat(np.arange(len(order)), sizes)
    start = np.arange(len(flat)) - ends[:-1][text]
    at = np.flatnonzero(start + window <= sizes[text])
    if not len(at):
        return None
    edge = rolling(h, window)[at]
    low = sliding_min(rolling(h, minimizer), window - minimizer + 1)[at]
    if heavy is not None and len(heavy):
        low = np.where(np.isin(low, heavy), mix(low ^ edge), low)
    own, text, start = own[at], text[at], start[at]
    _, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
    source = first[inverse]
    again = (own != own[source]) | (start != start[source])
    _confirm(again, at, source, flat, window)
    begins = _runs(
        text[1:] != text[:-1],
        start[1:] != start[:-1] + 1,
        again[1:] != again[:-1],
        ~again[1:] & (low[1:] != low[:-1]),
    )
    counts = np.diff(np.r_[begins, len(at)])
    settled = again[begins]
    key = np.where(settled, mix(own[begins].view(np.uint64) + start[begins].astype(np.uint64)), low[begins])
    packed = edge.view(np.uint8).reshape(-1, 8)[~again, :6].tobytes()
    offsets = np.r_[0, np.cumsum(np.where(settled, 0, counts) * 6)].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)),
            pa.array(own[begins]),
            pa.array(start[begins].astype(np.int32)),
            pa.array(counts.astype(np.int32)),
            pa.BinaryArray.from_buffers(
                pa.binary(), len(begins), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed)]
            ),
        ],
        names=["key", "doc_id", "start", "n", "edges"],
    )


def _paths(docs: DataFrame, window: int, minimizer: int, heavy: np.ndarray | None = None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids, words, size = per_process(WordHashes), [], [], 0
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                words.append(data.split() if data else [])
                size += len(words[-1])
                if size >= CHUNK_WORDS:
                    if (made := chunk_paths(ids, words, hashes, window, minimizer, heavy)) is not None:
                        yield made
                    ids, words, size = [], [], 0
        if (made := chunk_paths(ids, words, hashes, window, minimizer, heavy)) is not None:
            yield made

    return docs.mapInArrow(run, _PATHS)


def _heavy_keys(docs: DataFrame, window: int, minimizer: int) -> np.ndarray:
    """Smallest hashes that many edges share: at most as many as ``HEAVY_EDGES`` goes into all edges."""
    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(HEAVY_SAMPLE)) == 0)
    edges = _paths(part, window, minimizer).where(F.octet_length("edges") > 0)
    found = edges.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") * HEAVY_SAMPLE > HEAVY_EDGES)
    return np.array([r.key for r in found.select("key").collect()], np.int64).view(np.uint64)


def bucket_spans(rows: pa.Table) -> pa.RecordBatch:
    """Repeated spans among the paths of whole buckets, with their sources (-1: settled before)."""
    key, doc, start, n = (rows.column(k).to_numpy() for k in range(4))
    edges = rows.column(4).combine_chunks()
    settled = np.asarray(pc.binary_length(edges)) == 0
    out = [np.stack([doc[settled], start[settled], n[settled], np.full(settled.sum(), -1), np.full(settled.sum(), -1)])]
    key, doc, start, n = (x[~settled] for x in (key, doc, start, n))
    if len(key):
        raw = np.frombuffer(b"".join(edges.to_pylist()), np.uint8).reshape(-1, 6)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :6] = raw
        edge = wide.view(np.uint64).ravel()
        step = np.arange(len(edge)) - np.repeat(np.cumsum(n) - n, n)
        key, doc, start = np.repeat(key, n), np.repeat(doc, n), np.repeat(start, n).astype(np.int64) + step
        order = np.lexsort((start, doc, edge, key))
        key, edge, doc, start = key[order], edge[order], doc[order], start[order]
        begins = _runs(key[1:] != key[:-1], edge[1:] != edge[:-1])
        source = np.repeat(begins, np.diff(np.r_[begins, len(key)]))
        again = np.flatnonzero((doc != doc[source]) | (start != start[source]))
        doc, start, from_doc, from_start = doc[again], start[again], doc[source[again]], start[source[again]]
        order = np.lexsort((start, doc))
        doc, start, from_doc, from_start = (x[order] for x in (doc, start, from_doc, from_start))
        if len(doc):
            begins = _runs(
                doc[1:] != doc[:-1],
                start[1:] != start[:-1] + 1,
                from_doc[1:] != from_doc[:-1],
                from_start[1:] != from_start[:-1] + 1,
            )
            n = np.diff(np.r_[begins, len(doc)])
            out.append(np.stack([doc[begins], start[begins], n, from_doc[begins], from_start[begins]]))
    doc, start, n, from_doc, from_start = np.concatenate(out, axis=1)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc),
            pa.array(start.astype(np.int32)),
            pa.array(n.astype(np.int32)),
            pa.array(from_doc),
            pa.array(from_start.astype(np.int32)),
        ],
        names=["doc_id", "start", "n", "from_doc", "from_start"],
    )


def settled_keys(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Spans of paths that come in the order of their keys, some whole keys at a time."""
    limit = most = SETTLE_EDGES if most is None else most
    held, edges = [], 0
    for batch in batches:
        held.append(batch)
        edges += pc.sum(batch.column(3)).as_py() or 0
        if edges < limit:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(0).to_numpy()
        whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
        if whole:
            yield bucket_spans(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
            edges, limit = sum(pc.sum(b.column(3)).as_py() or 0 for b in held), most
        else:
            limit = 2 * edges
    if held:
        yield bucket_spans(pa.Table.from_batches(held))


def repeated_spans(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, minimizer: int = MINIMIZER
) -> DataFrame:
    """Runs of repeated windows: doc_id, first start, number of windows, and where they run first.

    The largest 64-bit integer stands for a NULL id; a source of -1 lies in the same chunk.
    All words have been compared with the source's.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), as_bytes(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES

    # a word takes two bytes at least
    heavy = _heavy_keys(source, window, minimizer) if size > 2 * HEAVY_EDGES else None
    spans = _paths(source, window, minimizer, heavy).repartition(buckets, "key")
    spans = spans.sortWithinPartitions("key").mapInArrow(settled_keys, _SPANS)
    texts = source.withColumn("doc_id", F.coalesce("doc_id", F.lit(int(_LAST))))
    return _verified(stage(spans, "repeat-spans"), texts, window)


def _passages(asked: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """doc_id, start, n and the digests of the words under these windows, one for each text of the id."""
    # staged, so that its size is known and a small one spares the texts a shuffle
    listed = stage(asked.groupBy(F.col("doc_id").alias("of_")).agg(F.collect_set(F.struct("start", "n")).alias("asked")), "repeat-asked")
    joined = texts.join(listed, F.col("doc_id") == F.col("of_")).select("doc_id", "text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, data, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = data.split() if data else []
                for start, n in ((x["start"], x["n"]) for x in asked):
                    passage = words[start : start + n + window - 1]
                    if len(passage) == n + window - 1:  # an id's other texts may be shorter
                        out.append((doc, start, n, hashlib.sha256(b" ".join(passage)).digest()))
            kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary()
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "n", "words"]
            )

    found = joined.mapInArrow(run, "doc_id long, start int, n int, words binary")
    return stage(found.groupBy("doc_id", "start", "n").agg(F.collect_set("words").alias("words")), "repeat-words")


def _compared(spans: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """The spans with the digests of their words and whether their source's words are the same."""
    own = ["doc_id", "start", "n"]
    other = [F.col("from_doc").alias("doc_id"), F.col("from_start").alias("start"), "n"]
    found = _passages(spans.select(*own).union(spans.select(*other)), texts, window)
    there = found.select(F.col("doc_id").alias("from_doc"), F.col("start").alias("from_start"), "n", F.col("words").alias("there"))
    both = spans.join(found, own).join(there, ["from_doc", "from_start", "n"])
    return stage(both.select(*spans.columns, "words", F.arrays_overlap("words", "there").alias("same")), "repeat-compared")


def _verified(spans: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """The spans without windows that only a fingerprint matched with their source."""
    columns = spans.columns
    compared = _compared(spans.where("from_start >= 0"), texts, window)
    sure = spans.where("from_start < 0").union(compared.where("same").select(*columns))
    apart = compared.where(~F.col("same"))
    if apart.isEmpty():
        return sure
    step = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("step")
    single = apart.select(*columns, step).select(
        "doc_id", (F.col("start") + F.col("step")).alias("start"), F.lit(1).alias("n"),
        "from_doc", (F.col("from_start") + F.col("step")).alias("from_start"),
    )
    single = _compared(single, texts, window)
    # equal windows have one fingerprint and one source, so all of them are here or none
    left = single.where(~F.col("same")).select("doc_id", "start", "n", F.explode("words").alias("words"))
    first = left.groupBy("words").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = left.join(first, "words").where(F.struct("doc_id", "start") != F.col("first"))
    later = later.select("doc_id", "start", "n", F.col("first.doc_id").alias("from_doc"), F.col("first.start").alias("from_start"))
    return sure.union(single.where("same").select(*columns)).union(later)


def without_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, window: int = WINDOW
) -> DataFrame:
    """Columns ``keep``, then one struct column ``repeats``: n_words, n_removed, kept_text.

    ``kept_text`` is NULL where nothing is removed.
    """
    names = list(docs.columns if keep is None else keep)
    docs, stands = placeholders(docs)
    keep, text, doc_id = [stands[c] for c in names], stands[text], stands[doc_id]
    spans = repeated_spans(docs, text, doc_id, window)
    listed = spans.groupBy(F.col("doc_id").alias("of_doc")).agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    id_ = F.coalesce(F.col(doc_id).cast("long"), F.lit(int(_LAST)))
    joined = docs.join(listed, id_ == F.col("of_doc"), "left")
    kept_fields = [docs.schema[c] for c in keep]
    made = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    )
    schema = T.StructType([*kept_fields, T.StructField("repeats", made)])
    source = joined.select(*[F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep)], as_bytes(text).alias("text_bytes"), "spans")
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            out = []
            for data, spans in zip(texts, found, strict=True):
                words = data.split() if data else []
                rest = _outside(words, spans, window) if spans else words
                out.append(
                    {
                        "n_words": len(words),
                        "n_removed": len(words) - len(rest),
                        "kept_text": b" ".join(rest).decode() if len(rest) < len(words) else None,
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))), pa.array(out, kind)], names=schema.names
            )

    return source.mapInArrow(run, schema).toDF(*names, added_name(names, "repeats"))


def _outside(words: list[bytes], spans: list[dict], window: int) -> list[bytes]:
    """The words that no window of the spans covers."""
    out, at = [], 0
    for start, end in sorted((s["start"], s["start"] + s["n"] - 1 + window) for s in spans):
        if start > at:
            out += words[at:start]
        at = max(at, end)
    return out + words[at:]


def kept_text(text: str, repeats: str):
    """The words kept, joined by one space."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.coalesce(F.col(f"{repeats}.kept_text"), F.trim(plain))


def documents_without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_chars: str = "n_chars") -> DataFrame:
    """The documents with all their columns, texts cut; untouched texts stay as they are."""
    plain, stands = placeholders(docs)
    found = without_repeats(plain, stands[text], stands[doc_id])
    cut = F.col("repeats.kept_text")
    new = {stands[text]: F.coalesce(cut, F.col(stands[text]))}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        new[stands[n_chars]] = F.when(cut.isNotNull(), F.length(cut).cast(kind)).otherwise(F.col(stands[n_chars]))
    return found.withColumns(new).drop("repeats").toDF(*docs.columns)
