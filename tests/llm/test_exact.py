"""Operators whose results are exact: against brute force, on odd and on random texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import sentence
from zephyrload.llm import decontaminate, near_dup, packing, queries, repeats, repetition, token_counts
from zephyrload.llm.common import stage

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sort_key(row):
    return (row[0] is None, row[0] or 0, *map(str, row[1:]))


# -- decontamination


def brute_hits(text, items, window=10):
    words = PLAIN.findall(lower(text))
    hit, found = set(), set()
    for item_id, item in items:
        w = PLAIN.findall(lower(item))
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == w[a : a + size]:
                    hit |= set(range(i, i + size))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_decontamination(spark, make_docs, odd_docs, block):
    items = [
        (1, sentence(5, 25)), (2, "WORD"), (3, None), (4, "..."), (2, sentence(1, 15)), (None, sentence(9, 12)), (10, "The the"),
    ]
    docs = make_docs(odd_docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.benchmark_hits(docs, bench, keep=["doc_id", "text", "hits"], block_bytes=block)
    hits = [c for c in found.columns if c.startswith("hits")][-1]
    for row in found.collect():
        n, hit, ids = brute_hits(row.text, items)
        got = row[hits]
        assert (got.n_words, sum(s.end - s.start for s in got.word_spans), got.items) == (n, hit, ids)
        for span in got.char_spans:
            assert PLAIN.findall(lower(row.text[span.start : span.end]))
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {1, 2, 3}
    empty = decontaminate.clean_documents(docs, bench.limit(0))
    assert empty.count() == docs.count()


def test_decontamination_bounds_automata(make_docs, spark, monkeypatch):
    """Every automaton is bounded by its windows, also within an item, and hits are staged between them."""
    item = sentence(41, 60)
    bench = spark.createDataFrame([(1, item), (2, item + " end")], "item_id long, text string")
    sizes, scanner, staged = [], decontaminate.map_texts, []
    monkeypatch.setattr(decontaminate, "stage", lambda df, label: staged.append(label) or stage(df, label))

    def counted(df, text, keep, fields, factory):
        sizes.append(sum(map(len, factory.__defaults__[0])))
        return scanner(df, text, keep, fields, factory)

    monkeypatch.setattr(decontaminate, "map_texts", counted)
    docs = make_docs([(1, "a " + item + " b"), (2, sentence(42, 30))]).drop("hits")
    found = decontaminate.benchmark_hits(docs, bench, block_bytes=800)
    rows = {r.doc_id: r.hits for r in found.collect()}
    assert max(sizes) <= 800 and 2 < len(sizes) == len(staged) and staged.count("hits") == len(sizes) - 1
    assert [(s.start, s.end) for s in rows[1].word_spans] == [(1, 61)] and rows[1].items == ["1", "2"]
    assert rows[2].word_spans == [] and rows[2].items == []


def test_decontamination_places_upper_case(make_docs, spark):
    docs = make_docs([(1, "Say: ALPHA-Beta gamma!")])
    bench = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    row = decontaminate.benchmark_hits(docs.drop("hits"), bench).first()
    assert [docs.first().text[s.start : s.end] for s in row.hits.char_spans] == ["ALPHA-Beta"]


# -- repetition


def brute_repeats(words, least):
    longest, covered = 0, set()
    seen = Counter()
    for n in range(1, len(words) + 1):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        seen = Counter(grams)
        again = [i for i, g in enumerate(grams) if seen[g] > 1]
        if not again:
            break
        longest = n
        if n == least:
            covered = {p for i in again for p in range(i, i + n)}
    return longest, covered


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c dd".split()), max_size=40), max_size=5))
def test_suffix_array_repeats(texts):
    out = repetition._measure([" ".join(t).encode() for t in texts], 3)
    for k, words in enumerate(texts):
        longest, covered = brute_repeats(words, 3)
        spans = {p for s in out[7][k] for p in range(s["start"], s["end"])}
        assert (out[6][k], out[5][k], out[4][k], spans) == (longest, len(covered), len(covered), covered)


def test_repetition_rules(make_docs, odd_docs):
    docs = make_docs(odd_docs).drop("n_words")
    rows = {r.doc_id: r for r in repetition.verdicts(repetition.repetition(docs)).collect()}
    assert rows[1].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert rows[10].n_repeat_words == 500 and rows[10].longest_repeat == 499 and not rows[10].kept
    assert rows[5].kept and not rows[5].base_failed
    assert repetition.repetition(docs.limit(0)).count() == 0


# -- repeated passages


def brute_kept(docs, window=20):
    """docs: (doc_id, text) with distinct ids; windows are judged on the input."""
    first = {}
    for doc_id, text in sorted(docs):
        words = SPACED.findall(text or "")
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), (doc_id, i))
    out = {}
    for doc_id, text in docs:
        words = SPACED.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (doc_id, i):
                gone |= set(range(i, i + window))
        out[doc_id] = [w for i, w in enumerate(words) if i not in gone]
    return out


def test_repeated_passages(make_docs, monkeypatch):
    shared, line = sentence(77, 70), sentence(78, 25)
    texts = [sentence(k, 40) + " " + (shared if k % 3 else "") + "\n" + (line + "\t") * (k % 4) for k in range(40)]
    texts += [texts[3], texts[3] + " tail", "x " * 100, None, "", "  " + sentence(2, 19)]
    pairs = list(enumerate(texts))
    random.Random(3).shuffle(pairs)
    for chunk in (200, 100_000):
        monkeypatch.setattr(repeats, "CHUNK_WORDS", chunk)
        docs = make_docs(pairs).drop("repeats").repartition(3)
        want = brute_kept(pairs)
        found = repeats.without_repeats(docs, keep=["doc_id", "text"])
        found = found.select("doc_id", "repeats.*", repeats.kept_text("text", "repeats").alias("kept"))
        for row in found.collect():
            assert row.kept == " ".join(want[row.doc_id])
            assert row.n_words - row.n_removed == len(want[row.doc_id])


@pytest.mark.parametrize("chunk", [200, 100_000])
def test_repeated_passages_are_verified(make_docs, monkeypatch, chunk):
    """Fingerprints of two bits, so that most windows under one smallest hash share one."""

    def colliding(*arguments):
        from zephyrload.llm import repeats as module

        whole = module.rolling
        module.rolling = lambda h, width: whole(h, width) & (3 if width == module.WINDOW else 0xFFFFFFFFFFFFFFFF)
        try:
            return module.chunk_paths(*arguments)
        finally:
            module.rolling = whole

    monkeypatch.setattr(repeats, "chunk_paths", colliding)
    monkeypatch.setattr(repeats, "CHUNK_WORDS", chunk)
    line = sentence(79, 9)
    texts = [f"{sentence(k, 30)} {line} {sentence(k + 50 - k % 2, 30)}" for k in range(24)]
    texts += [texts[3] + " tail", sentence(90, 8) + " " + texts[5], "x " * 60]
    pairs = list(enumerate(texts))
    want = brute_kept(pairs)
    found = repeats.documents_without_repeats(make_docs(pairs).repartition(3))
    assert {r.doc_id: r.text.split() for r in found.collect()} == want


def test_repeated_passages_of_a_heavy_hash(make_docs, monkeypatch):
    """A short line with different text around it puts many different windows under one smallest hash."""
    monkeypatch.setattr(repeats, "HEAVY_EDGES", 60)
    monkeypatch.setattr(repeats, "HEAVY_SAMPLE", 1)
    hashes = repeats.WordHashes()
    line = min((sentence(k, 6) for k in range(500)), key=lambda x: repeats.rolling(hashes.of(x.encode().split()), 6)[0])
    texts = [f"{sentence(k, 30)} {line} {sentence(1000 + k, 30)}" for k in range(60)]
    texts += [texts[k] + " tail" for k in range(0, 60, 7)]
    pairs = list(enumerate(texts))
    docs = make_docs(pairs).repartition(3)
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def most(heavy):
        rows = repeats._paths(source, 20, 6, heavy).where(F.octet_length("edges") > 0)
        return rows.groupBy("key").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]

    heavy = repeats._heavy_keys(source, 20, 6)
    assert most(None) > 300 and len(heavy) and most(heavy) <= 60
    assert {r.doc_id: r.text.split() for r in repeats.documents_without_repeats(docs).collect()} == brute_kept(pairs)


def test_repeated_passages_odd(make_docs, odd_docs):
    docs = make_docs(odd_docs)
    cut = repeats.documents_without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(odd_docs)
    rows = [(r.doc_id, r.text, r.n_chars) for r in cut.collect()]
    assert sorted((t, n) for i, t, n in rows if i == 5) == [(sentence(5, 60), len(sentence(5, 60)))] * 2
    assert (6, "", 0) in rows and (9, "", 0) in rows and (3, " \t\n", 3) in rows
    assert repeats.documents_without_repeats(docs.limit(0)).count() == 0


# -- near-duplicates


def brute_components(docs):
    sets = {}
    for i, text in docs:
        words = SPACED.findall(lower(text))
        sets[i] = frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset((w,) for w in words)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_group(seed, n, change):
    """Texts each differing from one base by a share of changed words, most below the threshold of each other."""
    r = random.Random(seed)
    base = sentence(seed, 120).split()
    out = []
    for k in range(n):
        words = list(base)
        for p in r.sample(range(len(words)), int(change * len(words))):
            words[p] = f"n{seed}x{k}x{p}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [8, 512])
def test_near_duplicates(make_docs, block, monkeypatch):
    monkeypatch.setattr(near_dup._similar_across, "__defaults__", (block,))
    texts = [sentence(k, 50) for k in range(30)] + near_group(5, 40, 0.035) + near_group(6, 40, 0.06) + near_group(7, 30, 0.02)
    texts += [texts[2], texts[2].upper(), None, "", "one", "One", "two words", "two words more"]
    pairs = list(enumerate(texts))
    found = near_dup.near_duplicates(make_docs(pairs).repartition(3))
    want = brute_components(pairs)
    for row in found.collect():
        assert (row.n_shingles, row.component_id) == want[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def test_near_duplicates_odd(make_docs, odd_docs):
    docs = make_docs(odd_docs)
    kept = near_dup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [1, 2, 3, 4, 5, 5, 8, 10, None]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 101)], "a long, b long")
    found = {r.id: r.component for r in near_dup.components(links).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 103: 100}


# -- tokens


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(queries.tokenizer_path("piece_bpe_32k.model"))


PARTS = ["a", "b", " ", "  ", "the", "tion", "\n", "é", "漢", "😀", "▁", "1", "!!", "<s>", " the", "\t", "aaaa", "ﬁ", "<0x0A>"]


@settings(max_examples=80, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=12))
def test_every_prefix_count(counter, parts):
    text = "".join(parts)
    counts = counter.prefixes(text)
    assert [counts.tokens(i) for i in range(len(text) + 1)] == [len(counter.model.encode(text[:i])) for i in range(len(text) + 1)]
    assert all(counts.tokens(counts.fitting(b)) <= b for b in range(5))


def test_token_counts(make_docs, odd_docs, counter):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    found = token_counts.token_counts(make_docs(odd_docs), path, keep=["doc_id", "text", "n_words"])
    for r in found.collect():
        n = len(counter.model.encode(r.text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 4096)


# -- packing


def test_pieces_beside_clashing_columns(make_docs):
    docs = make_docs([(1, "some words"), (2, None)]).withColumnRenamed("hits", "length").withColumnRenamed("score", "a.b")
    path = queries.tokenizer_path("byte_bpe_50k.json")
    found = packing.token_pieces(docs, path, keep=["doc_id", "length", "a.b"], with_ids=True)
    assert found.columns == ["doc_id", "length", "a.b", "piece", "start", "length_", "ids_crc32", "ids"]
    for r in found.collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length_ and r.length == "x"


@pytest.mark.parametrize(("capacity", "plan"), [(1024, 1 << 16), (32, 1)])
def test_packing(make_docs, odd_docs, capacity, plan):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    pairs = odd_docs + [(100 + k, sentence(k, 1 + 37 * k % 600)) for k in range(60)]
    docs = make_docs(pairs)
    rows = packing.pack_documents(docs, path, capacity=capacity, plan_pieces=plan).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in pairs}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    want = Counter()
    for i, _ in pairs:
        n = len(ids[i])
        first = n % capacity or capacity
        edges = [0, *range(first, n + 1, capacity)]
        want.update((i, k, a, b - a) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.1 * sum(len(ids[i]) for i, _ in pairs) / capacity + 1
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_sum_of_squares_closes_sequences():
    lengths = np.array([900, 800, 700, 324, 224, 124])
    sequence, _ = packing.sum_of_squares(lengths, 1024)
    assert sequence.max() + 1 == 3
    rows, lanes = packing.plans({5: 1001, 7: 3}, 16, 10)
    placed = Counter()
    for size, steps in lanes.items():
        starts = [r[1] for r in rows if r[0] == size]
        for k, (first, width) in enumerate(steps):
            last = steps[k + 1][0] if k + 1 < len(steps) else None
            placed[size] += width * sum(first <= s and (last is None or s < last) for s in starts)
    assert placed == {5: 1001, 7: 3}


def test_keys_are_settled_whole():
    """Some keys at a time, one larger than the rest: the spans of all at once."""
    import pyarrow as pa

    r = random.Random(6)
    rows = sorted((r.choice([1, 1, 1, 2, 3, 9]), d, 0, 4, bytes(r.choice(b"ab") for _ in range(24))) for d in range(60))
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                     names=["key", "doc_id", "start", "n", "edges"])
    whole = repeats.bucket_spans(table).to_pylist()
    parts = list(repeats.settled_keys(iter(table.to_batches(max_chunksize=5)), most=12))
    got = [x for b in parts for x in b.to_pylist()]

    def windows(spans):
        return sorted((x["doc_id"], x["start"] + k, x["from_doc"], x["from_start"] + k) for x in spans for k in range(x["n"]))

    assert len(parts) > 2 and windows(got) == windows(whole)


def test_passage_digest_of_nothing(make_docs):
    docs = make_docs([(1, None)]).drop("repeats")
    found = repeats.without_repeats(docs, keep=["doc_id", "text"])
    digest = found.select(F.sha2(repeats.kept_text("text", "repeats").cast("binary"), 256)).first()[0]
    assert digest == hashlib.sha256(b"").hexdigest()
