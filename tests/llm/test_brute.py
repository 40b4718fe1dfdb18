"""Learned operators against plain Python that follows their formulas term by term."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import sentence
from zephyrload.llm import langid, site_quality, toxicity
from zephyrload.llm.common import mix


def sigmoid(z, bound):
    return 1 / (1 + math.exp(-max(-bound, min(bound, z))))


# --- language ----------------------------------------------------------------


def plain_grams(text, buckets):
    """Bucket to count of the 1- to 3-grams of lower-cased letters and single spaces."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    if not words:
        return {}
    line = f" {' '.join(words)} "
    grams = [c for c in line if c != " "] + [line[i : i + n] for n in (2, 3) for i in range(len(line) - n + 1)]
    found = Counter()
    for gram in grams:
        value = 0
        for c in gram:
            value = (value << 21) + ord(c)
        found[int(mix(np.array([value], np.uint64))[0]) % buckets] += 1
    return dict(found)


def plain_fit(rows, idf, epochs=3, alpha=0.5, beta=1.0, l1=0.05, l2=0.01):
    """Follow the regularised leader, one weight after the other."""
    languages = sorted({r[0] for r in rows})
    z = defaultdict(float)
    n = defaultdict(float)

    def weight(key):
        if abs(z[key]) <= l1:
            return 0.0
        return -(z[key] - math.copysign(l1, z[key])) / ((beta + math.sqrt(n[key])) / alpha + l2)

    examples = [(languages.index(lang), unit(grams, idf)) for lang, grams in rows]
    training = [e for k, e in enumerate(examples) if k % langid.CALIBRATION_EVERY]
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(training)):
            label, x = training[k]
            x = {**x, "bias": 1.0}
            w = {(c, g): weight((c, g)) for c in range(len(languages)) for g in x}
            p = shares([sum(w[c, g] * v for g, v in x.items()) for c in range(len(languages))])
            for c in range(len(languages)):
                for g, v in x.items():
                    gradient = (p[c] - (c == label)) * v
                    sigma = (math.sqrt(n[c, g] + gradient**2) - math.sqrt(n[c, g])) / alpha
                    z[c, g] += gradient - sigma * w[c, g]
                    n[c, g] += gradient**2
    return languages, weight


def unit(grams, idf):
    x = {g: math.log1p(k) * idf[g] for g, k in grams.items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    return {g: v / norm for g, v in x.items()}


def shares(z):
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def test_grams_are_those_of_strings():
    for text in ("Ein Haus, das 3 Türen hat!", "a", "..", "ß 漢字 x", "ÀÉ  b\n\nc", sentence(3, 50)):
        found, counts = langid.ngram_counts(text, 512)
        assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == plain_grams(text, 512)


def test_language_weights_are_those_of_single_steps():
    r = random.Random(2)
    rows = []
    for k in range(60):
        words = ["".join(r.choices({"a": "aeiou", "b": "bcdfg", "c": "abcde"}["abc"[k % 3]], k=4)) for _ in range(8)]
        rows.append(("abc"[k % 3], plain_grams(" ".join(words), 64)))
    idf = np.linspace(0.5, 2.0, 64)
    arrays = [(lang, np.array(sorted(g)), np.array([float(g[k]) for k in sorted(g)])) for lang, g in rows]
    model = langid.fit(arrays, idf)
    languages, weight = plain_fit(rows, idf)
    assert model.languages == languages
    for c in range(len(languages)):
        assert model.bias[c] == pytest.approx(weight((c, "bias")), abs=1e-9)
        assert model.weights[c] == pytest.approx([weight((c, g)) for g in range(64)], abs=1e-9)
    assert 0 < (model.weights == 0).sum()


def test_temperature_is_the_best_of_many():
    r = np.random.default_rng(5)
    z = r.normal(0, 4, (200, 3))
    labels = np.where(r.random(200) < 0.7, z.argmax(1), r.integers(0, 3, 200))

    def loss(t):
        return -sum(math.log(shares((row / t).tolist())[k]) for row, k in zip(z, labels.tolist(), strict=True)) / len(z)

    best = min(loss(t) for t in np.geomspace(0.05, 20, 200))
    assert loss(langid.fit_temperature(z, labels)) <= best + 1e-6


def test_identified_languages_are_those_of_the_formula(spark):
    r = random.Random(9)
    rows = [(k, " ".join("".join(r.choices(s, k=4)) for _ in range(r.randint(1, 30))), lang) for k in range(90) for lang, s in [[("x", "aeioub"), ("y", "bcdfga")][k % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    usable = [plain_grams(text, langid.BUCKETS) for k, text, _ in rows if not is_held_out(k)]
    df = Counter(g for grams in usable for g in grams)
    for g, n in df.items():
        assert model.idf[g] == pytest.approx(math.log((1 + len(usable)) / (1 + n)) + 1)
    found = {x.doc_id: x for x in langid.identify(docs, model, keep=["doc_id"]).collect()}
    for k, text, _ in rows:
        x = unit(plain_grams(text, langid.BUCKETS), model.idf)
        z = [(model.bias[c] + sum(model.weights[c, g] * v for g, v in x.items())) / model.temperature for c in range(2)]
        p = shares(z)
        assert found[k].score == pytest.approx(max(p), abs=1e-9)
        assert found[k].lang_pred == model.languages[p.index(max(p))]


def is_held_out(k):
    import zlib

    return zlib.crc32(str(k).encode()) % 5 == 0


# --- toxicity ----------------------------------------------------------------


def test_scores_are_the_sum_over_all_pairs(spark, make_docs, odd_docs):
    """Every pair of a text's distinct words counts once, beside the words themselves."""
    import xxhash

    texts = [(100 + k, sentence(k, 3 + k % 40, 60)) for k in range(120)]
    own = [(k % 2, np.array(sorted({xxhash.xxh3_64_intdigest(w.encode()) for w in t.split()}), np.uint64)) for k, t in texts]
    machine = toxicity.fit(own, epochs=10, rate=0.05, l1=0.1, min_docs=3)
    weights = {t: (w, v) for t, w, v in zip(machine.terms.tolist(), machine.linear.tolist(), machine.factors, strict=True)}
    assert len(weights) > 20 and np.abs(machine.factors).max() > 0.01
    docs = make_docs(texts + odd_docs)
    for row in toxicity.score(docs, machine, keep=["doc_id", "text"]).collect():
        plain = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in (row.text or ""))
        words = {"".join(c.lower() if c.isascii() else c for c in w) for w in plain.split(" ") if w}
        held = [weights[h] for h in (xxhash.xxh3_64_intdigest(w.encode()) for w in words) if h in weights]
        z = machine.bias + sum(w for w, _ in held)
        z += sum(float(a @ b) for i, (_, a) in enumerate(held) for _, b in held[:i])
        assert row.score == pytest.approx(sigmoid(z, 35), abs=1e-9)
        assert row.predicted == int(row.score >= 0.5)


# --- quality -----------------------------------------------------------------


def plain_strength(sites):
    """Beta strength from (values, base) of every site, by moments weighted by size."""
    rows = []
    for values, base in sites:
        n = len(values)
        if n > 1:
            mean = sum(values) / n
            within = max((sum(v * v for v in values) / n - mean * mean) * n / (n - 1), 0.0)
            rows.append((n, (mean - base) ** 2 - within / n, mean * (1 - mean)))
    total = sum(n for n, _, _ in rows)
    between = sum(n * b for n, b, _ in rows) / total if total else 0.0
    spread = sum(n * s for n, _, s in rows) / total if total else 0.0
    low, high = site_quality.STRENGTHS
    return high if between <= 0 else min(max(spread / between - 1, low), high)


def plain_posteriors(scored):
    """(host, path) to (host posterior, path posterior)."""
    hosts, paths = defaultdict(list), defaultdict(list)
    for host, path, p in scored:
        hosts[host].append(p)
        paths[host, path].append(p)
    base = sum(p for _, _, p in scored) / len(scored)
    m = plain_strength([(v, base) for v in hosts.values()])
    host = {h: (sum(v) + m * base) / (len(v) + m) for h, v in hosts.items()}
    m = plain_strength([(v, host[h]) for (h, _), v in paths.items()])
    return {(h, q): (host[h], (sum(v) + m * host[h]) / (len(v) + m)) for (h, q), v in paths.items()}


def test_posteriors_are_those_of_plain_sums(spark):
    r = random.Random(8)
    scored = [(h, q, min(max(r.gauss(0.3 + 0.1 * k, 0.2), 0.0), 1.0)) for k, (h, q) in enumerate([("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), ("c", None)]) for _ in range(3 + 17 * k)]
    scored += [("one", "x", 0.9)]
    found = site_quality.site_posteriors(spark.createDataFrame(scored, "host string, path string, p double")).collect()
    expected = plain_posteriors(scored)
    assert {(x.host, x.path) for x in found} == set(expected)
    for x in found:
        assert (x.host_posterior, x.path_posterior) == pytest.approx(expected[x.host, x.path], abs=1e-9)


def test_verdicts_are_those_of_the_formula(spark):
    """Own evidence less the base rate, on the posterior of the document's path."""
    r = random.Random(3)
    rows = []
    for k in range(300):
        good = r.random() < 0.7
        text = sentence(k, 40).capitalize() + "." if good else sentence(k, 40).upper().replace(" ", "*** ")
        rows.append((k, text, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3"]) if good else "s3", int(good)))
    rows += [(300, None, "en", "s1", 1), (301, "", None, None, 0)]
    docs = spark.createDataFrame([x[:4] for x in rows], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(x[0], x[4]) for x in rows], "doc_id long, quality int")
    model = site_quality.train(docs, labels)

    def own(text):
        x = site_quality.measures(text.encode() if text is not None else None)
        z = [max(-6.0, min(6.0, (v - m) / s)) for v, m, s in zip(x, model.mean.tolist(), model.scale.tolist(), strict=True)]
        return sigmoid(sum(w * v for w, v in zip(model.weights.tolist(), [*z, *(v * v for v in z), 1.0], strict=True)), 12)

    def logit(p):
        p = min(max(p, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p))

    p = {x[0]: own(x[1]) for x in rows}
    sites = plain_posteriors([(x[3], x[2], p[x[0]]) for x in rows])
    found = {x.doc_id: x.verdict for x in site_quality.judge(docs, labels, keep=["doc_id"]).collect()}
    assert len(found) == len(rows)
    for k, _, lang, source, _ in rows:
        score = sigmoid(logit(p[k]) - logit(model.base) + logit(sites[source, lang][1]), 700)
        assert found[k].p == pytest.approx(p[k], abs=1e-9)
        assert found[k].path_posterior == pytest.approx(sites[source, lang][1], abs=1e-9)
        assert found[k].score == pytest.approx(score, abs=1e-6)
        assert found[k].kept == (found[k].score >= 0.5)
