"""Toxicity by a factorization machine over hashed terms.

    score = bias + sum of w[t] + sum over pairs of <v[t], v[u]>

over the distinct terms of a text, so that a pair of terms can mean more than its
members. Terms are lower-cased words, hashed; terms seen in fewer than ``MIN_DOCS``
training texts have no weight. All is learned from the log loss of whole labelled texts, positives
weighted up to at most ``MOST_WEIGHT``.

Bounds: at most ``MOST_PER_LABEL`` labelled texts of each label are learned from.

Defined cases: a NULL or empty text has no terms and scores by the bias alone; labels
that are NULL, or of documents that are missing, are not learned from; without any
training row every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import WordHashes, as_bytes, bound_batches, bounded_sample, held_out, map_texts, per_process, plain_words, stage

MOST_PER_LABEL = 4000
MIN_DOCS = 10
FACTORS = 4
MOST_WEIGHT = 3.0

FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


@dataclass
class FactorizationMachine:
    terms: np.ndarray  # hashes with a weight, ascending
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # terms x FACTORS

    def margin(self, at: np.ndarray) -> float:
        v = self.factors[at]
        total = v.sum(0)
        return float(self.bias + self.linear[at].sum() + 0.5 * ((total**2).sum() - (v**2).sum()))

    def score(self, hashes: np.ndarray) -> float:
        if not np.isfinite(self.bias):
            return 0.0
        at = np.searchsorted(self.terms, hashes)
        at = np.minimum(at, max(len(self.terms) - 1, 0))
        known = at[self.terms[at] == hashes] if len(self.terms) else at[:0]
        return _sigmoid(self.margin(known))


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def term_hashes(data: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct words of a text."""
    return hashes.of(list(set(plain_words(data))))


def fit(
    rows: list[tuple[int, np.ndarray]],
    epochs: int = 3,
    alpha: float = 1.0,
    l1: float = 4.0,
    l2: float = 0.1,
    rate: float = 0.005,
    decay: float = 1e-3,
    min_docs: int = MIN_DOCS,
) -> FactorizationMachine:
    """Learn from (label, distinct term hashes) rows, given in a fixed order.

    Linear weights follow the regularised leader, so most are exactly 0; factors take
    AdaGrad steps of ``rate`` and shrink by ``decay``.
    """
    if not rows:
        return FactorizationMachine(np.zeros(0, np.uint64), -np.inf, np.zeros(0), np.zeros((0, FACTORS)))
    terms, counts = np.unique(np.concatenate([h for _, h in rows]), return_counts=True)
    terms = terms[counts >= min_docs]
    examples = [(label, np.intersect1d(terms, h, return_indices=True)[1]) for label, h in rows]
    positive = sum(label for label, _ in examples)
    negative = len(examples) - positive
    weight = min(MOST_WEIGHT, negative / positive) if positive else 1.0
    random = np.random.default_rng(11)
    bias, g_bias = float(np.log((positive * weight + 1) / (negative + 1))), 1.0
    z_linear, n_linear = np.zeros(len(terms)), np.zeros(len(terms))
    factors = random.normal(0, 0.005, (len(terms), FACTORS))
    g_factors = np.full((len(terms), FACTORS), 1e-2)

    def linear(at: np.ndarray | slice) -> np.ndarray:
        z = z_linear[at]
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((1 + np.sqrt(n_linear[at])) / alpha + l2)

    for _ in range(epochs):
        for k in random.permutation(len(examples)):
            label, at = examples[k]
            w, v = linear(at), factors[at]
            total = v.sum(0)
            z = bias + w.sum() + 0.5 * ((total**2).sum() - (v**2).sum())
            error = (_sigmoid(z) - label) * (weight if label else 1.0)
            g_bias += error**2
            bias -= 0.05 * error / np.sqrt(g_bias)
            grown = n_linear[at] + error**2
            z_linear[at] += error - (np.sqrt(grown) - np.sqrt(n_linear[at])) / alpha * w
            n_linear[at] = grown
            step = error * (total - v) + decay * v
            g_factors[at] += step**2
            factors[at] = v - rate * step / np.sqrt(g_factors[at])
    return FactorizationMachine(terms, bias, linear(slice(None)), factors)


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    most_per_label: int = MOST_PER_LABEL,
) -> FactorizationMachine:
    """Learn from labelled rows that are not held out."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out("doc_id")
    )
    # staged: of known size, so the texts are streamed past it
    sample = stage(bounded_sample(known, "label", most_per_label, ["doc_id"]), "labelled")
    texts = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text).alias("text"))

    def features(batches):
        hashes = per_process(WordHashes)
        for batch in batches:
            found = [term_hashes(d, hashes).tobytes() for d in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "nth": batch["nth"], "terms": found})

    found = texts.join(sample, "doc_id").select("label", "nth", "text")
    found = found.mapInPandas(features, "label int, nth int, terms binary")
    rows = sorted((r.nth, r.label, bytes(r.terms)) for r in found.toLocalIterator())
    return fit([(r[1], np.frombuffer(r[2], np.uint64)) for r in rows])


def score(
    docs: DataFrame, machine: FactorizationMachine, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Columns ``keep``, score (0 to 1) and predicted (1 from one half on)."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the training sample

    def factory():
        machine, hashes = shared.value, per_process(WordHashes)

        def compute(texts):
            found = [machine.score(term_hashes(t, hashes)) for t in texts]
            return [found, [int(s >= 0.5) for s in found]]

        return compute

    return map_texts(docs, text, keep, FIELDS, factory)
