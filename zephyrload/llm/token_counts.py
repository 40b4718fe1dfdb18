"""Exact token counts at every prefix of a text, by dynamic programming.

In byte-pair encoding the encoding of a prefix ends with one token whose preceding
prefix is encoded independently: a sequence of tokens is the encoding of its text
exactly when every neighbouring pair is. So, from left to right,

    last[i]  = the vocabulary piece t ending at i for which (last[i - len(t)], t) is
               how the library itself encodes their two texts joined
    count[i] = count[i - len(t)] + 1

A character without a piece counts one token per UTF-8 byte. No piece of the
vocabulary reaches over a word's end, so counts of a text are sums over its words;
words, with their leading space, are remembered. ``PrefixCounts`` answers how many
tokens any prefix has and how much text a budget holds without encoding again.

Defined cases: a NULL or empty text has 0 tokens; special strings are plain text.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zephyrload.llm.common import map_texts, per_process

LIMIT = 4096
#: Words remembered by one worker process at a time.
MOST_WORDS = 1_000_000
#: Neighbouring pieces whose joining it remembers at a time.
MOST_PAIRS = 2_000_000
SPACE = "▁"
MISSING = object()

FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
    T.StructField("chars_in_limit", T.LongType()),
]


class PrefixCounter:
    """Counts for one SentencePiece BPE vocabulary with byte fallback."""

    def __init__(self, model_path: str, most_words: int = MOST_WORDS):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        special = (model.is_control, model.is_byte, model.is_unknown, model.is_unused)
        named = {
            model.id_to_piece(i): i for i in range(model.vocab_size()) if not any(f(i) for f in special)
        }
        if any(SPACE in p.lstrip(SPACE) for p in named):
            raise ValueError("a piece of this vocabulary reaches over a word's end")
        self.lead = len(model.encode("\n"))
        texts = list(named)
        #: pieces that are the encoding of their own text
        self.pieces = {
            p: named[p]
            for p, ids in zip(texts, model.encode(["\n" + p for p in texts], num_threads=1), strict=True)
            if ids[self.lead :] == [named[p]]
        }
        #: texts that end some piece: the tokens known to come before it or not, None if no piece itself
        self.endings: dict[str, dict[str, bool] | None] = {
            p[at:]: None for p in self.pieces for at in range(1, len(p))
        }
        self.endings.update((p, {"": True}) for p in self.pieces)
        self.n_pairs = 0
        self.words: dict[str, bytes] = {}
        self.most_words = most_words

    def _joins(self, before: str, token: str) -> bool:
        """Whether two pieces stay two tokens when their texts stand together."""
        if self.n_pairs >= MOST_PAIRS:
            for p in self.pieces:
                self.endings[p] = {"": True}
            self.n_pairs = 0
        ids = self.model.encode("\n" + before + token)[self.lead :]
        joins = self.endings[token][before] = ids == [self.pieces[before], self.pieces[token]]
        self.n_pairs += 1
        return joins

    def learn(self, words: Iterable[str]) -> None:
        """Remember the change of the count with every character of each word.

        Words are taken in order, so a word goes on from the prefix it shares with the
        one before it.
        """
        endings, known = self.endings, self.words
        counts, last, changes, previous = [0], [""], [], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, previous, strict=False):
                if a != b:
                    break
                shared += 1
            del counts[shared + 1 :], last[shared + 1 :], changes[shared:]
            previous = word
            for end in range(shared + 1, len(word) + 1):
                found = []
                for start in range(end - 1, -1, -1):
                    token = word[start:end]
                    befores = endings.get(token, MISSING)
                    if befores is MISSING:
                        break
                    if befores is not None:
                        found.append((start, token, befores))
                for start, token, befores in reversed(found):
                    joins = befores.get(last[start])
                    if joins is None:
                        joins = self._joins(last[start], token)
                    if joins:
                        count = counts[start] + 1
                        break
                else:
                    token, count = "", counts[-1] + len(word[end - 1].encode())  # bytes join with nothing
                changes.append(count - counts[-1])
                counts.append(count)
                last.append(token)
            known[word] = array("i", changes).tobytes()

    def changes(self, texts: list[str]) -> list[np.ndarray]:
        """Change of the count with every character of each text, after the mark put before it."""
        split = [_words(t) if t else [] for t in texts]
        known = self.words
        fresh = {w for words in split for w in words if w not in known}
        if len(known) + len(fresh) > self.most_words:
            known.clear()
            fresh = {w for words in split for w in words}
        self.learn(fresh)
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), "i4") for words in split]

    def prefixes(self, text: str) -> PrefixCounts:
        return self.prefixes_of([text])[0]

    def prefixes_of(self, texts: list[str]) -> list[PrefixCounts]:
        return [PrefixCounts(c) for c in self.changes(texts)]


class PrefixCounts:
    """Tokens of every prefix of one text: ``counts[i]`` for its first i characters."""

    def __init__(self, changes: np.ndarray):
        self.counts = np.cumsum(changes, dtype=np.int64)
        if len(self.counts):
            self.counts[0] = 0  # the mark alone stands for the empty prefix
        else:
            self.counts = np.zeros(1, np.int64)

    def tokens(self, n_chars: int) -> int:
        return int(self.counts[n_chars])

    def total(self) -> int:
        return int(self.counts[-1])

    def fitting(self, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        return int(np.flatnonzero(self.counts <= budget)[-1])


def _words(text: str) -> list[str]:
    """The text with its mark, cut before every run of spaces that follows anything else."""
    marked = SPACE + text.replace(" ", SPACE)
    parts = marked.split(SPACE)
    if "" not in parts[1:]:
        return [SPACE + p for p in parts[1:]]
    out, spaces = [], ""
    for part in parts[1:]:
        spaces += SPACE
        if part:
            out.append(spaces + part)
            spaces = ""
    return [*out, spaces] if spaces else out


def token_counts(
    docs: DataFrame,
    model_path: str,
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Columns ``keep``, n_bytes, n_tokens, over_limit, and how many characters the limit holds."""
    keep = docs.columns if keep is None else keep

    def factory() -> Callable[[list[bytes | None]], list]:
        counter = per_process(PrefixCounter, model_path)

        def compute(texts: list[bytes | None]) -> list:
            found = counter.prefixes_of([data.decode() if data else "" for data in texts])
            return [
                [len(data or b"") for data in texts],
                [f.total() for f in found],
                [f.total() > limit for f in found],
                [f.fitting(limit) for f in found],
            ]

        return compute

    return map_texts(docs, text, keep, FIELDS, factory)
