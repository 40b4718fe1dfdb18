"""Byte-level BPE by forced boundaries: certain cuts, fragments by themselves, concatenation.

A merge makes a token of the vocabulary out of two neighbours, so two bytes that stand
side by side inside no token can never come together: between them the text is cut for
certain. Where the left byte ends a character that is no white space and the right one
is white space, the file's own splitting cuts there too, whatever stands around. These
cuts divide the text into chunks, found for a whole batch at once. A chunk is split as
the file says, and every word of it is cut again at each pair of bytes that is inside no
token; the fragments are encoded apart, all fragments not met before in one array, and
a text's ids are the concatenation of its fragments' ids. Equal chunks of a batch, and
equal fragments, are looked up once, and a worker process remembers chunks and fragments up to a number of bytes.

Decoding looks up the bytes of each id and concatenates them; bytes that are no UTF-8
become U+FFFD, ids outside the vocabulary nothing.

Defined cases: a NULL or empty text has no ids and decodes to the empty text; equal
texts and repeated rows give equal ids, row by row; the special string of the file
is one id wherever it occurs. A text however long is handled in windows of chunks; only
a run of bytes without any certain cut is merged as a whole, with a heap. ``ids`` and ``text`` are
added beside the columns asked for: where such a name is taken already, whatever its
letter case, the new column gets underscores (``added_name`` tells which).
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zephyrload.llm.common import added_name, bound_batches, per_process, quoted

#: What a worker process remembers of chunks, in bytes; of fragments it remembers a third of that.
MEMORY_BYTES = 192 << 20
#: Chunks looked up at a time.
WINDOW = 1 << 18
#: Fragments up to this length are merged side by side in an array, longer ones with a heap.
ARRAY_BYTES = 24
_ENTRY = 180  # bytes of a dictionary entry besides its key and value
#: Stands between chunks that are split at once: a code point that is no character.
_BETWEEN = "\uffff".encode()
#: Characters from U+10000 on begin with such a byte.
_FAR = 0xF0

# The white space and the contractions of the file kind's own splitting.
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII_SPACES = b"\t\n\x0b\x0c\r "


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """First letter of the category of every code point."""
    return np.array([unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)])


def _characters(kind: str, end: int) -> str:
    """Inside of a character class: the characters below ``end`` whose category begins with ``kind``."""
    points = _kinds()[:end] == kind
    edges = np.flatnonzero(np.diff(np.concatenate(([False], points, [False])).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


def splitting_pattern(between: str = "", end: int = sys.maxunicode + 1) -> re.Pattern:
    """The splitting into words that byte-level files of this kind name, for characters below ``end``.

    The character ``between``, if given, is a word by itself and ends a text as if nothing followed.
    """
    letters, numbers = _characters("L", end), _characters("N", end)
    apart = [between] if between else []
    # no two of the first four can begin alike, so the most frequent one stands first
    return re.compile(
        "|".join(
            [
                f" ?[{letters}]+",
                *apart,
                f" ?[{numbers}]+",
                _CONTRACTIONS,
                f" ?[^{_SPACES}{letters}{numbers}{between}]+",
                f"[{_SPACES}]+(?![^{_SPACES}{between}])",
                f"[{_SPACES}]+",
            ]
        )
    )


def byte_of_character() -> dict[str, int]:
    """How the file writes bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Ids of texts, and texts of ids, by one tokenizer file."""

    def __init__(self, path: str, memory_bytes: int = MEMORY_BYTES):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _check(spec, path)
        of = byte_of_character()
        self.vocab = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self._special = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or b"(?!)")
        self._special_ids = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        # character classes within the first 65,536 code points are looked up, not searched
        self._words, self._far_words = splitting_pattern(_BETWEEN.decode(), 1 << 16), splitting_pattern()

        size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.size = size
        self.tokens: list[bytes] = [b""] * size
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self._lengths = np.array([len(t) for t in self.tokens], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._blob = np.frombuffer(b"".join(self.tokens), np.uint8)

        self.of_byte = np.array([self.vocab[bytes([b])] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        numbers = spec["model"]["vocab"]
        left = np.array([numbers[a] for a, _ in pairs], np.int64)
        right = np.array([numbers[b] for _, b in pairs], np.int64)
        made = np.array([numbers[a + b] for a, b in pairs], np.int64)
        keys = left * size + right
        self._keys, self._ranks = np.unique(keys, return_index=True)  # a pair's first rank
        self._by_rank = made
        every = np.arange(1 << 16)
        self._byte_ranks = self._rank(self.of_byte[every >> 8], self.of_byte[every & 255])
        self._rank_of: dict[int, int] | None = None

        self.inside = inside_pairs(self.vocab)
        space = np.zeros(256, bool)
        space[list(_ASCII_SPACES)] = True
        # pairs cut for certain by the vocabulary and by the splitting alike
        self._chunk_cut = ~self.inside & (~space[:, None] & space[None, :]).ravel()
        self.chunks = Remembered(memory_bytes)
        self.fragments = Remembered(memory_bytes // 3)

    # --- texts to ids --------------------------------------------------------

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        parts, places = [], []

        def part(i: int, data: bytes) -> None:
            if data:
                parts.append(data)
                places.append((i, len(out[i])))
                out[i].append(b"")

        for i, text in enumerate(texts):
            at = 0
            for hit in self._special.finditer(text) if text and self.special else ():
                part(i, text[at : hit.start()])
                out[i].append(self._special_ids[hit.group()])
                at = hit.end()
            part(i, text[at:] if at else text or b"")
        for (i, k), ids in zip(places, self._encode_parts(parts), strict=True):
            out[i][k] = ids
        return [found[0] if len(found) == 1 else b"".join(found) for found in out]

    def _encode_parts(self, parts: list[bytes]) -> list[bytes]:
        data = b"".join(parts)
        if not data:
            return []
        ends = np.cumsum([len(p) for p in parts])
        edge = np.zeros(len(data) + 1, bool)
        edge[0] = True
        edge[1:-1] = self._chunk_cuts(data)
        edge[ends] = True
        edges = np.flatnonzero(edge)
        # where a window's ids of each part end
        upto = np.searchsorted(edges, ends)
        out: list[list[bytes]] = [[] for _ in parts]
        part = 0
        for low in range(0, len(edges) - 1, WINDOW):
            high = min(low + WINDOW, len(edges) - 1)
            ids, at = _looked_up(data, edges[low : high + 1], self.chunks, self._split_and_encode)
            last = int(np.searchsorted(upto, high))  # the part that goes on behind the window, or ends with it
            stops = at[np.minimum(upto[part : last + 1], high) - low].tolist()
            for i, (begun, stop) in enumerate(zip([0, *stops], stops, strict=False), part):
                out[i].append(ids[begun:stop])
            part = last + (upto[last] == high)
        return [found[0] if len(found) == 1 else b"".join(found) for found in out]

    def _chunk_cuts(self, data: bytes) -> np.ndarray:
        """For each place inside ``data``: is it cut for certain by vocabulary and splitting?"""
        raw = np.frombuffer(data, np.uint8)
        cut = self._chunk_cut[(raw[:-1].astype(np.uint16) << np.uint16(8)) | raw[1:]]
        wide = _wide_space_ends(data)
        cut[wide[wide < len(data)] - 1] = False
        return cut

    def _split_and_encode(self, chunks: list[bytes]) -> list[bytes]:
        """Words of every chunk, fragments of every word, their ids concatenated."""
        near = [c for c in chunks if _BETWEEN not in c and max(c) < _FAR]
        data = _BETWEEN.join(near)
        ends = np.cumsum([len(c) + len(_BETWEEN) for c in near]) - len(_BETWEEN)
        ids = self._fragment_ids(data, self._word_ends(data), ends) if near else []
        if len(near) == len(chunks):
            return ids
        known = dict(zip(near, ids, strict=True))
        return [known[c] if c in known else self._fragment_ids(c, self._words_apart(c))[0] for c in chunks]

    def _word_ends(self, data: bytes) -> np.ndarray:
        """Where the words of the file's splitting end; chunks stand between separators."""
        raw = np.frombuffer(data, np.uint8)
        characters = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        lengths = np.fromiter(map(len, self._words.findall(data.decode())), np.int64)
        return characters[np.cumsum(lengths)]

    def _words_apart(self, chunk: bytes) -> np.ndarray:
        return np.cumsum([len(w.encode()) for w in self._far_words.findall(chunk.decode())])

    def _fragment_ids(self, data: bytes, word_ends: np.ndarray, ends: np.ndarray | None = None) -> list[bytes]:
        """Ids of each chunk of ``data``, from its fragments; chunks end at ``ends``."""
        ends = np.array([len(data)]) if ends is None else ends
        raw = np.frombuffer(data, np.uint8)
        edge = np.zeros(len(raw) + 1, bool)
        edge[1:-1] = ~self.inside[(raw[:-1].astype(np.uint16) << np.uint16(8)) | raw[1:]]
        edge[word_ends] = True
        starts = np.append(0, ends[:-1] + len(_BETWEEN))
        edge[starts] = edge[ends] = True
        edges = np.flatnonzero(edge)
        ids, at = _looked_up(data, edges, self.fragments, self.merge)
        first, last = at[np.searchsorted(edges, starts)].tolist(), at[np.searchsorted(edges, ends)].tolist()
        return [ids[a:b] for a, b in zip(first, last, strict=True)]

    def merge(self, fragments: list[bytes]) -> list[bytes]:
        """Ids of fragments, each merged by itself."""
        out: list[bytes] = [b""] * len(fragments)
        lengths = np.array([len(f) for f in fragments])
        for i in np.flatnonzero(lengths > ARRAY_BYTES).tolist():
            out[i] = np.array(self._merge_long(fragments[i]), "<u4").tobytes()
        low = 0
        for high in (4, 8, 14, ARRAY_BYTES):  # rows of a like length side by side
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            for at in range(0, len(rows), 8192):
                block = rows[at : at + 8192].tolist()
                for i, ids in zip(block, self._merge_rows([fragments[i] for i in block], high), strict=True):
                    out[i] = ids
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of pairs of ids; pairs that do not merge rank behind all."""
        none = len(self._by_rank)
        if not none:
            return np.full(left.shape, none)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (left >= 0) & (right >= 0), self._ranks[at], none)

    def _merge_rows(self, fragments: list[bytes], width: int) -> list[bytes]:
        """Merge all rows at the same time, each its best pair a round."""
        none = len(self._by_rank)
        n = len(fragments)
        raw = np.frombuffer(b"".join(f.ljust(width, b"\0") for f in fragments), np.uint8).reshape(n, width)
        count = np.array([len(f) for f in fragments])
        ids = np.where(np.arange(width) < count[:, None], self.of_byte[raw], -1)
        ids = np.concatenate([ids, np.full((n, 1), -1)], axis=1)
        # ranks of neighbours among the bytes; the last one of a row has none
        ranks = np.full((n, width), none)
        pairs = self._byte_ranks[(raw[:, :-1].astype(np.uint16) << np.uint16(8)) | raw[:, 1:]]
        ranks[:, :-1] = np.where(np.arange(1, width) < count[:, None], pairs, none)
        rows = np.arange(n)
        columns = np.arange(width)
        while len(rows):
            best = ranks[rows].argmin(axis=1)
            found = ranks[rows, best]
            going = found < none
            rows, best, found = rows[going], best[going], found[going]
            if not len(rows):
                break
            # one id less: what stands behind the pair moves up by one
            source = columns + (columns > best[:, None])
            block = np.take_along_axis(ids[rows], source, axis=1)
            block[np.arange(len(rows)), best] = self._by_rank[found]
            ids[rows, :-1] = block
            ids[rows, -1] = -1
            moved = np.take_along_axis(ranks[rows], np.minimum(source, width - 1), axis=1)
            moved[:, -1] = none
            at = np.arange(len(rows))
            moved[at, best] = self._rank(block[at, best], ids[rows, best + 1])
            before = best > 0
            moved[at[before], best[before] - 1] = self._rank(block[at[before], best[before] - 1], block[at[before], best[before]])
            ranks[rows] = moved
            count[rows] -= 1
        joined = ids[:, :-1][np.arange(width) < count[:, None]].astype("<u4").tobytes()
        ends = (np.cumsum(count) * 4).tolist()
        return [joined[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_long(self, fragment: bytes) -> list[int]:
        """The same merges for one long fragment: a heap of pairs over linked neighbours."""
        if self._rank_of is None:
            self._rank_of = dict(zip(self._keys.tolist(), self._ranks.tolist(), strict=True))
        rank_of, by_rank, size = self._rank_of, self._by_rank.tolist(), self.size
        ids = self.of_byte[np.frombuffer(fragment, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(a: int) -> None:
            b = after[a]
            if b < n:
                key = ids[a] * size + ids[b]
                rank = rank_of.get(key)
                if rank is not None:
                    heapq.heappush(heap, (rank, a, key))

        for a in range(n - 1):
            offer(a)
        while heap:
            rank, a, key = heapq.heappop(heap)
            b = after[a]
            if ids[a] < 0 or b >= n or ids[a] * size + ids[b] != key:
                continue  # one of the two has been merged since
            ids[a], ids[b] = by_rank[rank], -1
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [i for i in ids if i >= 0]

    # --- ids to texts --------------------------------------------------------

    def decode(self, ids: bytes | None) -> str:
        """Text of little-endian unsigned 32-bit ids."""
        if not ids:
            return ""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        numbers = numbers[numbers < self.size]
        out = []
        for at in range(0, len(numbers), 1 << 20):
            part = numbers[at : at + (1 << 20)]
            lengths = self._lengths[part]
            ends = np.cumsum(lengths)
            shift = np.repeat(self._starts[part] - (ends - lengths), lengths)
            out.append(self._blob[shift + np.arange(len(shift))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


class Remembered(dict):
    """Ids of byte strings, up to a number of bytes."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.held = most, 0

    def add(self, keys: list[bytes], values: list[bytes]) -> None:
        """Remember keys not held yet."""
        if max(map(len, keys)) > 64:  # long strings seldom come again
            lasting = [(k, v) for k, v in zip(keys, values, strict=True) if len(k) <= 64]
            keys, values = [k for k, _ in lasting], [v for _, v in lasting]
        size = sum(map(len, keys)) + sum(map(len, values)) + _ENTRY * len(keys)
        if self.held + size > self.most:
            self.clear()
            self.held = 0
        if size <= self.most:
            self.update(zip(keys, values, strict=True))
            self.held += size


def _looked_up(
    data: bytes, edges: np.ndarray, known: Remembered, encode: Callable[[list[bytes]], list[bytes]]
) -> tuple[bytes, np.ndarray]:
    """Ids of the strings between neighbouring edges, one after the other, and at each edge the bytes before it.

    Every distinct string is looked up once, and encoded if it is not known.
    """
    bounds = np.ascontiguousarray(edges, np.int64)
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = strings.dictionary_encode()
    _, ends, held = coded.dictionary.buffers()
    held = held.to_pybytes()
    ends = np.frombuffer(ends, np.int64, len(coded.dictionary) + 1).tolist()
    distinct = [held[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    ids = list(map(known.get, distinct))
    missing = [i for i, found in enumerate(ids) if found is None]
    if missing:
        fresh = [distinct[i] for i in missing]
        made = encode(fresh)
        known.add(fresh, made)
        for i, found in zip(missing, made, strict=True):
            ids[i] = found
    nth = coded.indices.to_numpy()
    counts = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
    starts = np.cumsum(counts) - counts
    counts = counts[nth]
    at = np.zeros(len(edges), np.int64)
    np.cumsum(counts, out=at[1:])
    shift = np.repeat(starts[nth] - at[:-1], counts)
    shift += np.arange(len(shift))
    return np.frombuffer(b"".join(ids), "<u4")[shift].tobytes(), 4 * at


def inside_pairs(tokens) -> np.ndarray:
    """For each pair of bytes, as 256 * left + right: does any token hold the two side by side?"""
    inside = np.zeros(1 << 16, bool)
    data = np.frombuffer(b"".join(tokens), np.uint8)
    pairs = (data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]
    ends = np.cumsum([len(t) for t in tokens])[:-1] - 1
    within = np.ones(len(pairs), bool)
    within[ends[(ends >= 0) & (ends < len(pairs))]] = False
    inside[pairs[within]] = True
    return inside


def _wide_space_ends(data: bytes) -> np.ndarray:
    """Places right after white space beyond ASCII."""
    if not any(lead in data for lead in (b"\xc2", b"\xe1", b"\xe2", b"\xe3")):
        return np.zeros(0, np.int64)
    found = re.finditer(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80", data)
    return np.array([m.end() for m in found], np.int64)


def _check(spec: dict, path: str) -> None:
    """Only byte-level BPE with its own splitting is encoded; anything else is an error, not wrong ids."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    expected = {
        "BPE": model.get("type"),
        "ByteLevel": before.get("type"),
        "no normalizer": "no normalizer" if spec.get("normalizer") is None else "normalizer",
        "no added space": "no added space" if not before.get("add_prefix_space") else "added space",
        "own splitting": "own splitting" if before.get("use_regex", True) else "no splitting",
        "byte-level decoder": "byte-level decoder" if (spec.get("decoder") or {}).get("type") == "ByteLevel" else "other decoder",
        "whole bytes": "whole bytes" if not any(model.get(k) for k in ("dropout", "byte_fallback", "fuse_unk", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")) else "options",
        "plain added tokens": "options"
        if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        else "plain added tokens",
    }
    odd = [f"{found} instead of {wanted}" for wanted, found in expected.items() if wanted != found]
    if odd:
        raise ValueError(f"{path} is no byte-level BPE file of the kind encoded here: {', '.join(odd)}")


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) and ``ids``: little-endian unsigned 32-bit ids as binary."""
    return _map_values(df, text, keep, "ids", T.BinaryType(), tokenizer_path, lambda bpe, texts: bpe.encode(texts))


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) and ``text``: the text of the ids."""
    return _map_values(df, ids, keep, "text", T.StringType(), tokenizer_path, lambda bpe, found: [bpe.decode(i) for i in found])


def _map_values(df, column, keep, made, kind, path, compute) -> DataFrame:
    keep = list(df.columns) if keep is None else keep
    bound_batches(df.sparkSession)
    name = added_name(keep, made)
    # placeholder names inside the pass: column names may clash or hold dots
    source = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(keep)], quoted(column).cast("binary").alias("value"))
    schema = T.StructType([*(T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(keep)), T.StructField("made", kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = per_process(ByteBpe, path)
        for batch in batches:
            values = pa.array(compute(bpe, batch.column(batch.num_columns - 1).to_pylist()), type=arrow)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, values], names=schema.names)

    return source.mapInArrow(run, schema).toDF(*keep, name)
