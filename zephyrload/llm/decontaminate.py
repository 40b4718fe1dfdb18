"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Items and documents are normalised alike (A-Z lower-cased, every other ASCII
character that is no letter or digit becomes a space). The automaton holds every
window of ``window`` consecutive item words, bounded by spaces; an item of fewer
words, but not none, is one window. Each text is scanned once, and every occurrence
is carried back to word numbers and to character offsets of the original text.

Defined cases: a NULL or empty text has no words and no hits; a NULL item text has no
window; windows of an item without id still hit, but no item is named; rows that
repeat an item_id count as one item; repeated document rows are scanned each.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import free_name, map_texts, placeholders, plain_words, quoted, stage

WINDOW = 10
#: Bytes of windows, of which each word is in up to ``WINDOW``, that one automaton is
#: built from and so the most nodes it has; a larger benchmark is scanned in several
#: passes, each with its own automaton and its hits staged before the next.
AUTOMATON_BYTES = 1 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
HITS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_spans", SPANS),
    T.StructField("char_spans", SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def item_windows(items: list[tuple[str | None, bytes]], window: int) -> dict[str, tuple[int, set[str]]]:
    """Pattern -> (number of words, ids of its items)."""
    patterns: dict[str, tuple[int, set[str]]] = {}
    for item_id, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            pattern = (b" " + b" ".join(words[at : at + size]) + b" ").decode("latin-1")
            ids = patterns.setdefault(pattern, (size, set()))[1]
            if item_id is not None:
                ids.add(item_id)
    return patterns


def _scanner(patterns: dict[str, tuple[int, set[str]]]):
    """Gives a function from texts to word counts, hit spans and items."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for pattern, found in patterns.items():
        automaton.add_word(pattern, found)
    if patterns:
        automaton.make_automaton()

    def scan(texts: list[bytes | None]) -> list:
        counts, spans, places, items = [], [], [], []
        for data in texts:
            words = plain_words(data)
            counts.append(len(words))
            hits: list[tuple[int, int]] = []
            ids: set[str] = set()
            if patterns and words:
                line = (b" " + b" ".join(words) + b" ").decode("latin-1")
                found = list(automaton.iter(line))
                if found:
                    # word w ends at the w-th separator after the leading one
                    ends = np.cumsum([0, *(len(w) + 1 for w in words)])
                    for at, (size, of) in found:
                        last = int(np.searchsorted(ends, at))
                        hits.append((last - size, last))
                        ids |= of
            merged = merge(hits)
            spans.append([{"start": a, "end": b} for a, b in merged])
            places.append(_characters(data, merged))
            items.append(sorted(ids))
        return [counts, spans, places, items]

    return scan


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _characters(data: bytes | None, spans: list[tuple[int, int]]) -> list[dict]:
    """Word spans as character offsets of the original text."""
    if not spans:
        return []
    words = [m.span() for m in _WORD.finditer(data.lower().decode())]
    return [{"start": words[a][0], "end": words[b - 1][1]} for a, b in spans]


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, most: int):
    """The benchmark's patterns in blocks of bounded size, one at a time in the driver.

    A long item is cut between two windows, so its windows may be in several blocks.
    """
    patterns: dict[str, tuple[int, set[str]]] = {}
    size = 0
    for row in benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("binary")).toLocalIterator():
        for pattern, found in item_windows([(row[0], bytes(row[1]) if row[1] is not None else None)], window).items():
            if pattern not in patterns:
                if patterns and size + len(pattern) > most:
                    yield patterns
                    patterns, size = {}, 0
                size += len(pattern)
            patterns.setdefault(pattern, (found[0], set()))[1].update(found[1])
    yield patterns


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    block_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Columns ``keep`` of the documents with one column ``hits``: n_words, word_spans,
    char_spans and items (ids as text, sorted)."""
    keep = docs.columns if keep is None else keep
    found = free_name(docs, "hits")
    row = free_name(docs, "row")
    carried = [*dict.fromkeys([*keep, text])]
    first, later = None, []
    for patterns in _blocks(benchmark, item_id, item_text, window, block_bytes):

        def factory(patterns=patterns):
            scan = _scanner(patterns)
            return lambda texts: [[dict(zip(("n_words", "word_spans", "char_spans", "items"), x)) for x in zip(*scan(texts))]]

        fields = [T.StructField(found, T.StructType(HITS))]
        if first is None:
            first = map_texts(docs, text, carried, fields, factory)
            continue
        if not later:
            first = stage(first.withColumn(row, F.monotonically_increasing_id()), "scanned")
        more = map_texts(first, text, [row], fields, factory).where(F.size(f"{found}.word_spans") > 0)
        later.append(stage(more, "hits"))
    if not later:
        return first.select(*[quoted(c) for c in keep], found)
    every, of = free_name(docs, "every"), free_name(docs, "of_row")
    more = reduce(DataFrame.union, later).groupBy(F.col(row).alias(of)).agg(F.collect_list(found).alias(every))
    joined = first.join(more, F.col(row) == F.col(of), "left")
    none = F.array().cast(T.ArrayType(T.StructType(HITS)))
    parts = F.concat(F.array(found), F.coalesce(F.col(every), none))
    merged = F.struct(
        F.col(f"{found}.n_words").alias("n_words"),
        *(_union(F.transform(parts, _member(c))).alias(c) for c in ("word_spans", "char_spans")),
        F.array_sort(F.array_distinct(F.flatten(F.transform(parts, _member("items"))))).alias("items"),
    )
    return joined.select(*[quoted(c) for c in keep], merged.alias(found))


def _member(name: str):
    return lambda hits: hits[name]


def _union(spans):
    """Union of an array of span arrays as one sorted array of disjoint spans."""

    def step(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["start"] <= last["end"])
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))).otherwise(
            F.concat(done, F.array(span))
        )

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(F.array_sort(F.flatten(spans)), empty, step)


def digest(item_ids: str | F.Column) -> F.Column:
    """SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(item_ids, ",").cast("binary"), 256)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no window occurs."""
    plain, stands = placeholders(docs)
    found = benchmark_hits(plain, benchmark, text=stands[text])
    return found.where(F.size("hits.word_spans") == 0).drop("hits").toDF(*docs.columns)
