"""Ranked search against plain loops over all documents and queries."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zephyrload.llm import lexical

TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def plain(docs, items, k=20):
    counted = [(i, Counter(w), len(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scored = []
        for i, held, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * held[t]) // (1000 * held[t] + 12 * m))
                for t, times in asked.items() if held[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "漢字", "A1", "don't"]
    return [(i, " ".join(r.choice(vocabulary[: 4 + r.randrange(60)]) for _ in range(r.choice([0, 1, 5, 5, 30, 200])))) for i in range(n)]


def found(spark, docs, items, **limits):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("m", F.lit(1)).withColumn("TF", F.lit("x")).repartition(3)
    q = spark.createDataFrame(items, "item_id string, text string").withColumn("rank", F.lit(2))
    return [tuple(r) for r in lexical.best_documents(d, q, **limits).collect()]


def key(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] is None, r[2] or 0))


@pytest.mark.parametrize("limits", [{}, {"k": 3, "block_terms": 10, "task_postings": 50, "held_postings": 20}])
def test_against_all_pairs(spark, limits):
    docs = corpus(1, 150)
    docs += [(500, docs[7][1]), (501, docs[7][1]), (3, docs[3][1]), (600, None), (601, "?!"), (None, docs[7][1]), (602, "w1 " * 30_000)]
    items = [(f"q{i}", t) for i, t in corpus(2, 14)] + [("none", None), ("empty", " .,"), ("unknown", "zzz"), ("q1", "w1 w1 w2"), (None, "w3 w4")]
    assert key(found(spark, docs, items, **limits)) == key(plain(docs, items, limits.get("k", 20)))


@pytest.mark.parametrize("docs, items", [([], [("a", "w")]), ([(1, "w")], []), ([(1, None)], [("a", "w")]), ([(1, "w")], [("a", "w")])])
def test_empty_tables_and_single_rows(spark, docs, items):
    assert found(spark, docs, items) == plain(docs, items)


def test_strata_out_of_reach_are_left_out(monkeypatch):
    """Once k documents score more than a stratum's bound, it is not scored."""
    import numpy as np

    scored = []
    score = lexical.Stratum.score
    monkeypatch.setattr(lexical.Stratum, "score", lambda self, *a: scored.append(len(self.docs)) or score(self, *a))
    one = np.zeros(2, np.int32)
    near = lexical.Stratum(75, np.array([1, 2]), np.arange(2), one, np.array([5, 5], np.int32))
    far = lexical.Stratum(900, np.array([3]), np.arange(1), one[:1], np.array([1], np.int32))
    best = [lexical.Best(2)]
    lexical.visit([far, near], [(np.zeros(1, np.int64), np.array([1000]))], best)
    assert scored == [2] and best[0].doc.tolist() == [1, 2]
