"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams (1 to 3, of the lower-cased text with every run
of other characters as one space), weighted by their frequency in the text and their
inverse document frequency over all training texts, scaled to unit length. Weights are
learned by follow-the-regularised-leader with an elastic net, which leaves most of
them at zero; one temperature is then fitted on training texts that the weights have
not seen. Predictions read whole texts and nothing but texts.

Bounds: weights are learned from at most ``MOST_PER_LANGUAGE`` texts of each language;
document frequencies count every training text.

Defined cases: a NULL text or one without a letter gives ``und`` and score 0; rows with
a NULL language are never learned from; without any training row every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import as_bytes, bound_batches, bounded_sample, held_out, map_texts, mix, vector_sum

BUCKETS = 1 << 15
MOST_PER_LANGUAGE = 800
#: Of the sampled texts, every fifth is kept for the temperature.
CALIBRATION_EVERY = 5
UNKNOWN = "und"

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


@cache
def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, every run of other characters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return points[:0]
    points = np.concatenate([[32], np.where(letter, points, 32), [32]]).astype(np.uint64)
    return points[np.r_[True, (points[1:] != 32) | (points[:-1] != 32)]]


def ngram_counts(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's 1- to 3-grams and how often each occurs."""
    points = letters(text)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0)
    grams = [points[points != 32]]
    for n in (2, 3):
        if len(points) >= n:
            h = points[: len(points) - n + 1]
            for k in range(1, n):
                h = (h << np.uint64(21)) | points[k : len(points) - n + 1 + k]
            grams.append(h)
    at = (mix(np.concatenate(grams)) % np.uint64(buckets)).astype(np.int64)
    counts = np.bincount(at, minlength=buckets)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.float64)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x buckets
    bias: np.ndarray
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found, counts = ngram_counts(text, len(self.idf))
        values = np.log1p(counts) * self.idf[found]
        norm = np.sqrt(values @ values)
        return found, values / norm if norm else values

    def scores(self, found: np.ndarray, values: np.ndarray) -> np.ndarray:
        return self.weights[:, found] @ values + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        found, values = self.vector(text)
        if not len(found):
            return UNKNOWN, 0.0
        p = softmax(self.scores(found, values) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader, one learning rate per weight, with l1 and l2 penalties."""

    def __init__(self, shape: tuple[int, int], alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(shape), np.zeros(shape)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, w: np.ndarray, gradient: np.ndarray) -> None:
        n = self.n[:, at]
        grown = n + gradient**2
        self.z[:, at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = grown


def fit(
    rows: list[tuple[str, np.ndarray, np.ndarray]],
    idf: np.ndarray,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.01,
) -> LanguageModel:
    """Learn from (language, buckets, counts) rows, given in a fixed order."""
    languages = sorted({r[0] for r in rows})
    model = LanguageModel(languages, idf, np.zeros((len(languages), len(idf))), np.zeros(len(languages)), 1.0)
    examples = []
    for language, found, counts in rows:
        values = np.log1p(counts) * idf[found]
        norm = np.sqrt(values @ values)
        if norm:
            examples.append((languages.index(language), found, values / norm))
    if not examples:
        return LanguageModel([], idf, model.weights, model.bias, 1.0)
    learner = Ftrl((len(languages), len(idf) + 1), alpha, beta, l1, l2)
    training = [e for k, e in enumerate(examples) if k % CALIBRATION_EVERY] or examples
    rest = examples[::CALIBRATION_EVERY]
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(training)):
            label, found, values = training[k]
            at, x = np.append(found, len(idf)), np.append(values, 1.0)
            w = learner.weights(at)
            error = softmax(w @ x)
            error[label] -= 1
            learner.update(at, w, np.outer(error, x))
    learned = learner.weights(slice(None))
    model.weights, model.bias = learned[:, :-1], learned[:, -1]
    z = np.array([model.scores(found, values) for _, found, values in rest])
    labels = np.array([label for label, _, _ in rest])
    model.temperature = fit_temperature(z, labels)
    return model


def fit_temperature(z: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""

    def loss(log_t: float) -> float:
        p = softmax(z / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    buckets: int = BUCKETS,
    most_per_language: int = MOST_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the rows with a language that are not held out."""
    usable = docs.select(
        as_bytes(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    bound_batches(docs.sparkSession)

    def frequencies(batches):
        from pyspark import TaskContext

        total, n = np.zeros(buckets + 1, np.int64), 0
        for batch in batches:
            for data in batch["text"]:
                found, _ = ngram_counts(data.decode(), buckets)
                total[found] += 1
                total[buckets] += 1
            n += len(batch)
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "vector": [total.tobytes()]})

    df = vector_sum(usable.select("text").mapInPandas(frequencies, "part int, vector binary"), buckets + 1)
    idf = np.log((1 + df[buckets]) / (1 + df[:buckets])) + 1.0
    sample = bounded_sample(usable, "lang", most_per_language, ["doc_id", "text"])

    def features(batches):
        for batch in batches:
            made = [ngram_counts(d.decode(), buckets) for d in batch["text"]]
            yield pd.DataFrame(
                {
                    "lang": batch["lang"],
                    "nth": batch["nth"],
                    "found": [f.astype(np.int32).tobytes() for f, _ in made],
                    "counts": [c.astype(np.float32).tobytes() for _, c in made],
                }
            )

    found = sample.select("lang", "nth", "text").mapInPandas(
        features, "lang string, nth int, found binary, counts binary"
    )
    rows = sorted(
        (
            (r.nth, r.lang, np.frombuffer(r.found, np.int32), np.frombuffer(r.counts, np.float32).astype(float))
            for r in found.toLocalIterator()
        ),
        key=lambda r: r[:2],
    )
    return fit([r[1:] for r in rows], idf)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep``, lang_pred and score."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets numbers

    def factory():
        model = shared.value

        def compute(texts):
            found = [model.predict(t.decode() if t else None) for t in texts]
            return [[f[0] for f in found], [f[1] for f in found]]

        return compute

    return map_texts(docs, text, keep, FIELDS, factory)
