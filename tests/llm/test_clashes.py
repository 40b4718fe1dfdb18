"""Operators beside columns whose names they use themselves: all are kept, none is replaced."""

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sentence
from zephyrload.llm import decontaminate, html_text, langid, near_dup, repeats, repetition, site_quality, token_counts, toxicity
from zephyrload.llm.queries import tokenizer_path

CLASHES = ["spans_", "of_", "gone", "site", "h_", "l_", "main_text", "Lang_Pred", "PREDICTED", "N_TOKENS", "length", "Kept", "a.b", "b`c"]
TEXTS = [(k, sentence(k, 60)) for k in range(12)] + [(20, sentence(3, 60)), (21, None), (None, "")]


@pytest.fixture(scope="module")
def docs(make_docs):
    plain = make_docs(TEXTS).repartition(2)
    return plain.select("*", *[F.lit("x").alias(c) for c in CLASHES]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(12)], "doc_id long, quality int, toxic int")


def same_rows(found, docs):
    assert found.columns == docs.columns
    assert found.exceptAll(docs).count() == 0


def beside(found, docs, added):
    """All input columns first and unchanged, then the new ones under names of their own."""
    kept = found.columns[: len(docs.columns)]
    assert kept == docs.columns
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    assert [c.rstrip("_") for c in found.columns[len(kept) :]] == added
    plain = found.toDF(*[str(k) for k in range(len(found.columns))]).select(*[str(k) for k in range(len(kept))])
    assert sorted(map(str, plain.collect())) == sorted(map(str, docs.toDF(*plain.columns).collect()))


def test_filters_keep_all_columns(spark, docs, labels):
    benchmark = spark.createDataFrame([(1, sentence(4, 60))], "item_id long, text string")
    same_rows(near_dup.distinct_documents(docs), docs)
    assert near_dup.distinct_documents(docs).count() == len(TEXTS) - 1
    same_rows(decontaminate.clean_documents(docs, benchmark), docs)
    assert decontaminate.clean_documents(docs, benchmark).count() == len(TEXTS) - 1
    same_rows(site_quality.good_documents(docs, labels), docs)
    cut = repeats.documents_without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(TEXTS)
    assert {r.doc_id: r.text for r in cut.collect()}[20] == ""


def test_measures_stand_beside_the_input(spark, docs, labels):
    path = tokenizer_path("piece_bpe_32k.model")
    beside(langid.identify(docs, langid.train(docs, most_per_language=5)), docs, ["lang_pred", "score"])
    beside(toxicity.score(docs, toxicity.train(docs, labels)), docs, ["score", "predicted"])
    beside(token_counts.token_counts(docs, path), docs, [f.name for f in token_counts.FIELDS])
    measures = repetition.repetition(docs)
    beside(measures, docs, [f.name for f in repetition.FIELDS])
    judged = repetition.verdicts(measures)
    beside(judged, docs, [*(f.name for f in repetition.FIELDS), "base_failed", "kept"])
    found = {r[0]: r[len(docs.columns)] for r in judged.collect()}
    assert found[3] == 60 and found[21] == 0
    beside(repeats.without_repeats(docs), docs, ["repeats"])
    beside(site_quality.judge(docs, labels), docs, ["verdict"])
    beside(decontaminate.benchmark_hits(docs, docs.select("doc_id", "text").limit(3), item_id="doc_id"), docs, ["hits"])
    beside(html_text.extract(docs, {}, source="text"), docs, ["main_text"])


def test_empty_tables(docs, labels):
    none = docs.limit(0)
    assert langid.identify(none, langid.train(docs, most_per_language=5)).count() == 0
    assert toxicity.score(none, toxicity.train(docs, labels)).count() == 0
    assert token_counts.token_counts(none, tokenizer_path("piece_bpe_32k.model")).count() == 0
    assert repeats.documents_without_repeats(none).count() == 0
    assert near_dup.distinct_documents(none).count() == 0
