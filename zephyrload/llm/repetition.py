"""Repetition rules from a suffix array over each text's words.

Words are split at ASCII white space. Texts are handled in chunks: every word gets a
number that differs between documents, so one suffix array holds a chunk and no common
prefix crosses documents. Suffixes are sorted by doubling, each round only among those
that are still tied; common prefixes of neighbours come from the ranks of the rounds.
A suffix's longest prefix shared with a neighbour is its longest repeat: these are the
maximal repeats, whose spans are united.

Defined cases: a NULL or empty text has no words and fails the base rules; repeated
rows are judged each.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zephyrload.llm.common import added_name, flatten, map_texts, quoted

#: A repeat counts from this many words on.
MIN_REPEAT = 10
#: Most words, per hundred, that repeats may cover.
MAX_COVERED_PERCENT = 20
#: Longest repeat, in words.
MAX_REPEAT = 100
#: Words of one chunk.
CHUNK_WORDS = 500_000

_SYMBOLS = b"#*$%&|<>"
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FIELDS = [
    *(T.StructField(n, T.LongType()) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat",
    )),
    T.StructField("repeat_spans", SPANS),
]


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before it (first: 0).

    ``ends[i]`` is where the text of position i ends; equal symbols belong to one text.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = _group_starts(symbols[order][1:] != symbols[order][:-1])
    levels, width = [rank.copy()], 1
    sizes = np.bincount(rank, minlength=n)
    active = np.flatnonzero(sizes[rank] > 1)
    while len(active):
        ahead = active + width
        inside = ahead < ends[active]
        second = np.where(inside, rank[np.where(inside, ahead, 0)], -1)
        order = np.lexsort((second, rank[active]))
        active, first, second = active[order], rank[active][order], second[order]
        starts = np.arange(len(active))
        new_group = np.r_[True, first[1:] != first[:-1]]
        base = np.maximum.accumulate(np.where(new_group, starts, 0))
        split = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[active] = first + np.maximum.accumulate(np.where(split, starts, 0)) - base
        width *= 2
        sizes = np.bincount(rank[active], minlength=n)
        active = active[sizes[rank[active]] > 1]
        if len(active):
            levels.append(rank.copy())
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, _common_prefixes(suffixes, levels)


def _group_starts(differs: np.ndarray) -> np.ndarray:
    """Index of the first member of each sorted group, for every member."""
    starts = np.arange(len(differs) + 1)
    return np.maximum.accumulate(np.where(np.r_[True, differs], starts, 0))


def _common_prefixes(suffixes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Ranks after round r agree exactly where the first 2**r symbols do."""
    n = len(suffixes)
    common = np.zeros(n, np.int64)
    left, right = suffixes[:-1], suffixes[1:]
    tied = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b, length = left[tied], right[tied], np.zeros(len(tied), np.int64)
    for r in range(len(levels) - 1, -1, -1):
        i, j = a + length, b + length
        inside = (i < n) & (j < n)
        same = inside.copy()
        same[inside] = levels[r][i[inside]] == levels[r][j[inside]]
        length += same * (1 << r)
    common[tied + 1] = length
    return common


def longest_repeats(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring from there that occurs again."""
    suffixes, common = suffix_array(symbols, ends)
    longest = np.zeros(len(symbols), np.int64)
    longest[suffixes] = np.maximum(common, np.r_[common[1:], 0]) if len(symbols) else 0
    return longest


def _covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Positions inside the spans of repeats of at least ``least`` words."""
    steps = np.zeros(len(longest) + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + longest[at], -1)
    return np.cumsum(steps[:-1]) > 0


def _measure(texts: list[bytes], min_repeat: int) -> list[np.ndarray | list]:
    words = [data.split() for data in texts]
    flat, ends = flatten(words)
    numbers = np.fromiter(map(defaultdict(itertools.count().__next__).__getitem__, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    longest = longest_repeats(numbers * len(texts) + owner, ends[1:][owner])
    covered, repeated = _covered(longest, min_repeat), _covered(longest, 3)

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(values)]
        return total[ends[1:]] - total[ends[:-1]]

    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, owner, longest)
    lines = [[x for x in data.split(b"\n") if x.strip()] for data in texts]
    edge = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
    begins = np.flatnonzero(covered & (edge | ~np.r_[False, covered[:-1]])) if len(owner) else []
    lasts = np.flatnonzero(covered & (np.r_[edge[1:], True] | ~np.r_[covered[1:], False])) if len(owner) else []
    spans: list[list] = [[] for _ in texts]
    for a, b in zip(begins, lasts, strict=True):
        text = owner[a]
        spans[text].append({"start": int(a - ends[text]), "end": int(b + 1 - ends[text])})
    return [
        np.diff(ends),
        [len(b"".join(w).decode()) for w in words],
        [len(data) - len(data.translate(None, _SYMBOLS)) for data in texts],
        [len(x) - len(set(x)) for x in lines],
        per_text(repeated),
        per_text(covered),
        most,
        spans,
    ]


def repetition(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, min_repeat: int = MIN_REPEAT
) -> DataFrame:
    """Columns ``keep`` and the measures of every whole text; spans are word numbers."""
    keep = docs.columns if keep is None else keep

    def factory():
        def compute(texts: list[bytes | None]) -> list[pa.Array]:
            parts, chunk, size = [], [], 0
            for data in texts:
                chunk.append(data or b"")
                size += len(chunk[-1]) // 4
                if size > CHUNK_WORDS:
                    parts.append(_measure(chunk, min_repeat))
                    chunk, size = [], 0
            if chunk:
                parts.append(_measure(chunk, min_repeat))
            return [list(itertools.chain.from_iterable(x)) for x in zip(*parts, strict=True)]

        return compute

    return map_texts(docs, text, keep, FIELDS, factory)


def verdicts(
    measures: DataFrame, max_covered_percent: int = MAX_COVERED_PERCENT, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """Add base_failed and kept to rows whose last columns are those of ``repetition``."""
    kept = measures.columns[: -len(FIELDS)]
    # the measures, whatever names they got beside the kept columns
    held = dict(zip((f.name for f in FIELDS), measures.columns[-len(FIELDS) :], strict=True))
    n_words, n_repeat, n_covered, longest = (
        quoted(held[n]) for n in ("n_words", "n_repeat_words", "n_covered_words", "longest_repeat")
    )
    base = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    repeats = (100 * n_covered > max_covered_percent * n_words) | (longest > max_repeat)
    failed, passed = added_name(kept, "base_failed"), added_name(kept, "kept")
    return measures.withColumns({failed: base, passed: ~base & ~repeats})
