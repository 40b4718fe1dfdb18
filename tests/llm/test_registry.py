"""Queries that have no SQL, through the registry, against their contracts on the smallest tables."""

import zlib

import __spark_entry__ as contract
import numpy as np
import pytest
from tokenizers import Tokenizer

from zephyrload.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return contract.queries()[name](spark, SF).collect()


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language(spark, documents):
    rows = run(spark, "op1_language")
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out and langs[r.doc_id] and len(documents[r.doc_id] or "") > 100]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in tested]) > 0.9


def test_toxicity(spark, documents):
    rows = run(spark, "op3_toxicity")
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_main_text(spark):
    rows = run(spark, "op4_main_text")
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text) and "  " not in r.text and r.text == r.text.strip()
    assert np.mean([r.n_chars > 0 for r in rows]) > 0.9


def test_token_counts(spark, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    rows = run(spark, "op8_token_counts")
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r.doc_id] or ""
        n = len(model.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def test_site_quality(spark, documents):
    rows = run(spark, "op9_site_quality")
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(0 <= r.score <= 1 and 0 <= r.path_posterior <= 1 and r.kept == (r.score >= 0.5) for r in rows) or len({r.kept for r in rows}) == 2


@pytest.mark.parametrize("name", ["op10_packing", "pipeline"])
def test_packing(spark, documents, name):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = run(spark, name)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if name == "op10_packing":
            ids = [*tokenizer.encode(documents[r.doc_id] or "", add_special_tokens=False).ids, 2]
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    held = {r.doc_id for r in rows}
    assert held == set(documents) if name == "op10_packing" else held <= set(documents) and len(held) > len(documents) / 4
