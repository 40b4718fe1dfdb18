"""Quality by hierarchical empirical Bayes over document, path and host.

A logistic regression over measures of form (symbols, capitals, repetition, lines)
gives every document evidence: the log odds that its text adds to the base rate. Hosts
and the paths below them get a beta posterior of their mean document probability,

    host = (sum of p + m * base) / (n + m),    path = (sum of p + m' * host) / (n + m')

where the strengths m and m' are estimated from all hosts and paths by the method of
moments, so that a sparse site shrinks to what lies above it. A document's score is
its evidence on top of its path's posterior. Sums are grouped aggregates with partial
sums before the shuffle, so a host with a third of all rows costs no more than others.

Bounds: the regression learns from at most ``MOST_PER_LABEL`` labelled texts of each
label; sites and strengths are computed over all documents.

Defined cases: a NULL or empty text has all measures 0; a NULL host or path is a site
of its own; without any training row evidence is 0 and all documents are kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import (
    added_name,
    as_bytes,
    bound_batches,
    bounded_sample,
    free_name,
    held_out,
    map_texts,
    placeholders,
    stage,
)

MOST_PER_LABEL = 4000
THRESHOLD = 0.5
#: Bounds of the shrinkage strengths, in documents.
STRENGTHS = (1.0, 1e6)

MEASURES = (
    "log_words", "symbols", "pipes", "capitals", "digits", "punctuation", "exclamations", "word_length",
    "distinct_words", "top_word", "same_neighbours", "distinct_lines", "log_line_words", "marked_words",
)

_SYMBOLS = b"#*$%&<>~^\\{}[]=+@_"
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_PUNCTUATION = b".,;:!?'\"()-"


def measures(data: bytes | None) -> list[float]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = data.split() if data else []
    if not words:
        return [0.0] * len(MEASURES)
    n, size = len(words), len(data)

    def share(of: bytes) -> float:
        return (size - len(data.translate(None, of))) / size

    lines = [x for x in data.split(b"\n") if x.strip()]
    seen = Counter(words)
    marked = sum(not w[-1:].isalnum() and w[-1:] not in b".,;:!?" and w[-1] < 128 for w in words)
    return [
        float(np.log1p(n)),
        share(_SYMBOLS),
        share(b"|"),
        share(_CAPITALS),
        share(_DIGITS),
        share(_PUNCTUATION),
        share(b"!"),
        sum(map(len, words)) / n,
        len(seen) / n,
        seen.most_common(1)[0][1] / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        marked / n,
    ]


@dataclass
class FormModel:
    """Standardised logistic regression; ``base`` is the share of good training texts."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float
    fitted: bool = True

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), 0.5)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.column_stack([z, z**2, np.ones(len(x))]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def fit(x: np.ndarray, y: np.ndarray, base: float, l2: float = 1.0, rounds: int = 25) -> FormModel:
    """Newton steps on measures and their squares, rows weighted to the base rate."""
    if len(y) == 0 or y.min() == y.max():
        return FormModel(np.zeros(len(MEASURES)), np.ones(len(MEASURES)), np.zeros(0), 0.5, False)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -6, 6)
    z = np.column_stack([z, z**2, np.ones(len(z))])
    row = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    weights = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        curve = z.T @ (z * (row * p * (1 - p))[:, None]) + l2 * np.eye(z.shape[1])
        weights += np.linalg.solve(curve, z.T @ (row * (y - p)) - l2 * weights)
    return FormModel(mean, scale, weights, base)


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    most_per_label: int = MOST_PER_LABEL,
) -> FormModel:
    """Learn from labelled rows that are not held out."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out("doc_id")
    )
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    base = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    # staged: of known size, so the texts are streamed past it
    sample = stage(bounded_sample(known, "label", most_per_label, ["doc_id"]), "labelled")

    def features(batches):
        for batch in batches:
            made = np.array([measures(d) for d in batch["text"]]).reshape(-1, len(MEASURES))
            yield pd.DataFrame({"label": batch["label"], "nth": batch["nth"], **dict(zip(MEASURES, made.T, strict=True))})

    texts = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text).alias("text"))
    schema = "label int, nth int, " + ", ".join(f"{m} double" for m in MEASURES)
    found = texts.join(sample, "doc_id").select("label", "nth", "text").mapInPandas(features, schema).collect()
    rows = sorted(tuple(r) for r in found)
    x = np.array([r[2:] for r in rows]).reshape(-1, len(MEASURES))
    return fit(x, np.array([r[0] for r in rows]), base)


def evidence(docs: DataFrame, model: FormModel, text: str = "text", keep: list[str] | None = None, name: str = "p") -> DataFrame:
    """Columns ``keep`` and the text's own probability of good quality."""
    keep = docs.columns if keep is None else keep

    def factory():
        return lambda texts: [model.probabilities(np.array([measures(t) for t in texts]).reshape(-1, len(MEASURES)))]

    return map_texts(docs, text, keep, [T.StructField(name, T.DoubleType())], factory)


def _strength(sites: DataFrame, base: Column | float) -> float:
    """Beta strength by moments: how much sites differ beyond what their sizes explain."""
    n, mean = F.col("n"), F.col("total") / F.col("n")
    within = F.greatest((F.col("squares") / n - mean * mean) * n / F.greatest(n - 1, F.lit(1)), F.lit(0.0))
    row = (
        sites.where(n > 1)
        .select(((mean - base) ** 2 - within / n).alias("between"), (mean * (1 - mean)).alias("spread"), n.alias("n"))
        .agg(
            (F.sum(F.col("between") * F.col("n")) / F.sum("n")).alias("between"),
            (F.sum(F.col("spread") * F.col("n")) / F.sum("n")).alias("spread"),
        )
        .first()
    )
    if row.between is None or row.between <= 0 or row.spread is None:
        return STRENGTHS[1]
    return float(np.clip(row.spread / row.between - 1, *STRENGTHS))


def site_posteriors(scored: DataFrame, host: str = "host", path: str = "path", p: str = "p") -> DataFrame:
    """host, path, host_posterior, path_posterior, n for every path, written to the shared folder."""
    sums = lambda: [F.count("*").alias("n"), F.sum(p).alias("total"), F.sum(F.col(p) ** 2).alias("squares")]
    paths = stage(scored.groupBy(host, path).agg(*sums()), "paths")
    hosts = paths.groupBy(host).agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    whole = paths.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    base = whole.total / whole.n if whole.n else 0.5
    m_host = _strength(hosts, F.lit(base))
    hosts = hosts.select(
        F.col(host).alias("host_"), ((F.col("total") + m_host * base) / (F.col("n") + m_host)).alias("host_posterior")
    )
    joined = paths.join(hosts, F.col(host).eqNullSafe(F.col("host_"))).drop("host_")
    m_path = _strength(joined, F.col("host_posterior"))
    posterior = (F.col("total") + m_path * F.col("host_posterior")) / (F.col("n") + m_path)
    return stage(joined.select(host, path, "host_posterior", posterior.alias("path_posterior"), "n"), "sites")


def _logit(p: Column) -> Column:
    clipped = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(clipped / (1 - clipped))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    host: str = "source",
    path: tuple[str, ...] = ("lang",),
    keep: list[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Columns ``keep``, then one struct column ``verdict``: p, host_posterior, path_posterior, score, kept."""
    names = list(docs.columns if keep is None else keep)
    model = train(docs, labels, text, doc_id)
    docs, stands = placeholders(docs)
    keep, text, host = [stands[c] for c in names], stands[text], stands[host]
    path = [F.col(stands[c]).alias(c) for c in path]
    host_, path_, p_ = (free_name(docs, n) for n in ("host", "path", "p"))
    named = docs.withColumns({host_: F.col(host), path_: F.to_json(F.struct(*path))})
    # one pass over the texts: sites sum up what is staged
    scored = stage(evidence(named, model, text, [*keep, host_, path_], p_), "evidence")
    h_, l_, site_ = (free_name(docs, n) for n in ("site_host", "site_path", "site"))
    sites = site_posteriors(scored.select(host_, path_, p_), host_, path_, p_).select(
        F.col(host_).alias(h_), F.col(path_).alias(l_), F.struct("host_posterior", "path_posterior").alias(site_)
    )
    verdict = free_name(docs, "verdict")
    joined = scored.join(sites, F.col(host_).eqNullSafe(F.col(h_)) & F.col(path_).eqNullSafe(F.col(l_)), "left")
    added = _logit(F.col(p_)) - _logit(F.lit(float(model.base)))
    score = 1 / (1 + F.exp(-(added + _logit(F.col(f"{site_}.path_posterior")))))
    score = score if model.fitted else F.lit(1.0)
    return joined.select(
        *[F.col(f"`{c}`") for c in keep],
        F.struct(
            F.col(p_).alias("p"),
            F.col(f"{site_}.host_posterior").alias("host_posterior"),
            F.col(f"{site_}.path_posterior").alias("path_posterior"),
            score.alias("score"),
            (score >= threshold).alias("kept"),
        ).alias(verdict),
    ).toDF(*names, added_name(names, verdict))


def good_documents(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """The documents that are kept, with all their columns."""
    verdict = added_name(docs.columns, "verdict")
    return judge(docs, labels, **names).where(F.col(f"{verdict}.kept")).drop(verdict)
