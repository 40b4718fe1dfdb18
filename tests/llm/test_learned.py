"""Learned operators: accuracy on held-out rows, planted cases and odd texts."""

import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import sentence
from zephyrload.llm import html_text, langid, site_quality, toxicity

SYLLABLES = {"en": "the tion ing er and on".split(), "de": "sch ung keit der ein ü".split(), "es": "ción que ado ñ es lo".split()}


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def speech(lang, seed, n=40):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n))


def test_language(spark):
    rows = [(k, speech(lang, k), lang) for k in range(300) for lang in [list(SYLLABLES)[k % 3]]]
    rows += [(900, None, "en"), (901, "12 - 34", "de"), (902, "", None), (903, speech("de", 1), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, most_per_language=60)
    found = {r.doc_id: r for r in langid.identify(docs, model, keep=["doc_id", "lang"]).collect()}
    assert len(found) == len(rows) and 0 < model.temperature
    assert (model.weights == 0).mean() > 0.5
    assert all(found[k].lang_pred == found[k].lang for k in range(300) if is_held_out(k))
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (900, 901, 902))
    assert found[903].lang_pred == "de" and 0 <= found[903].score <= 1
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, nothing, keep=["doc_id"]).collect()} == {"und"}


def test_held_out_language_is_not_learned(spark):
    out = next(k for k in range(100) if is_held_out(k))
    docs = spark.createDataFrame([(out, "xyz zyx", "xx"), (out + 1 if not is_held_out(out + 1) else out + 2, "the and", "en")], "doc_id long, text string, lang string")
    assert langid.train(docs).languages == ["en"]


def test_pairs_of_terms():
    """Two terms that are harmless alone and mean label 1 together."""
    r = random.Random(4)
    rows = []
    for _ in range(1500):
        a, b = r.random() < 0.5, r.random() < 0.5
        terms = {10 + r.randrange(30) for _ in range(4)} | ({1} if a else set()) | ({2} if b else set())
        rows.append((int(a and b), np.array(sorted(terms), np.uint64)))
    machine = toxicity.fit(rows[:1200], epochs=30, rate=0.05)
    right = [int(machine.score(h) >= 0.5) == y for y, h in rows[1200:]]
    both = machine.margin(np.searchsorted(machine.terms, [1, 2]))
    alone = sum(machine.margin(np.searchsorted(machine.terms, [t])) for t in (1, 2)) - machine.bias
    assert np.mean(right) > 0.95 and both > alone


def test_toxicity(spark, make_docs, odd_docs):
    clean = [(k, sentence(k, 60)) for k in range(100, 500)]
    toxic = [(k, sentence(k, 60) + " You IDIOT, " + sentence(k + 1, 30)) for k in range(500, 700)]
    docs = make_docs(odd_docs + clean + toxic)
    labels = [(i, int(i >= 500), 1) for i, _ in clean + toxic] + [(1, None, None), (None, 1, 1), (99999, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    machine = toxicity.train(docs, labels)
    found = toxicity.score(docs, machine, keep=["doc_id"]).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    tested = [r for r in found if r.doc_id is not None and r.doc_id >= 100 and is_held_out(r.doc_id)]
    assert np.mean([r.predicted == int(r.doc_id >= 500) for r in tested]) > 0.97
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0)), keep=["doc_id"]).select("score").collect()} == {0.0}


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    good = [(k, sentence(k, 80, 5000).capitalize() + ".") for k in range(1000, 1400)]
    bad = [(k, " ".join(w + "***" for w in sentence(k, 80, 5000).upper().split())) for k in range(1400, 1500)]
    labels = [(i, int(i < 1400), 0) for i, _ in good + bad] + [(None, 1, 1), (1, None, None)]
    return make_docs(good + bad), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_site_quality(labelled, make_docs, odd_docs, spark):
    docs, labels = labelled
    all_docs = docs.union(make_docs(odd_docs, lang=None))
    kept = site_quality.good_documents(all_docs, labels)
    assert kept.columns == all_docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(1000 <= (i or 0) < 1400 for i in ids) == 400 and not any(1400 <= (i or 0) for i in ids)
    everything = site_quality.good_documents(all_docs, labels.limit(0))
    assert everything.count() == all_docs.count()
    assert site_quality.good_documents(docs.limit(0), labels).count() == 0


def test_sparse_sites_shrink(spark):
    rows = [("big", "a", 0.9)] * 200 + [("big", "b", 0.2)] * 200 + [("low", "a", 0.1)] * 200 + [("tiny", "a", 0.0), (None, None, 1.0)]
    scored = spark.createDataFrame(rows, "host string, path string, p double")
    found = {(r.host, r.path): r for r in site_quality.site_posteriors(scored).collect()}
    assert len(found) == 5
    assert abs(found["big", "a"].path_posterior - 0.9) < 0.02 and abs(found["big", "b"].path_posterior - 0.2) < 0.02
    assert 0.02 < found["tiny", "a"].host_posterior and found[None, None].host_posterior < 0.98


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>menu one</a></li></ul></nav><!-- note --><div class='ad'>buy now</div>"
    "<article><h1>Head &amp; shoulders</h1><p>{}</p><aside>see also</aside><p>Last.</p>"
    "<div class='comments'><p>first comment here</p></div></article><footer>&copy; us</footer></body></html>"
)


def test_main_text(spark):
    rows = [(k, "u", PAGE.format(sentence(k, 30).replace(" ", "\n\t", 3))) for k in range(40)]
    rows += [(100, "u", None), (101, "u", ""), (102, "u", "<p"), (103, "u", PAGE.format("cut off")[:-100]), (104, "u", "plain words")]
    rows += [(105, "u", "<body><div id=menu>a b</div><div><p>one <b>t</b>wo<br>three &#233;</div><form>no</form>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = html_text.train(pages)
    found = {r.page_id: r.main_text for r in html_text.extract(pages, weights, keep=["page_id"]).collect()}
    for k in range(40):
        assert found[k] == f"Head & shoulders {sentence(k, 30)} Last."
    assert [found[k] for k in (100, 101, 102, 104, 105)] == ["", "", "", "plain words", "one two three é"]
    assert found[103].startswith("Head & shoulders cut off Last.")
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).count() == 0


def test_main_text_in_wrappers():
    """Elements named as left out that hold the article, with and without learned weights."""
    head, body, last = sentence(4, 20), sentence(3, 60), sentence(5, 20)
    weights = html_text.learn(sum((html_text.count_places(PAGE.format(sentence(k, 30))) for k in range(40)), Counter()))
    article = f"<article><h1>{head}</h1><p>{body}</p><aside>see also</aside><p>{last}</p></article>"
    plain = f"<div><p>{body}</p><div class='ad'>buy now</div><p>{last}</p></div>"
    late = f"<main><p>{body}</p></main><aside><article><p>a teaser of another text</p></article></aside>"
    for learned in (weights, {}):
        for opened in ("<form>", "<nav>home", "<header>site", "<aside>x", "<main><form>", "<div class='has-sidebar'><form>"):
            assert html_text.main_text(opened + article, learned) == f"{head} {body} {last}"
        for opened in ("<form>", "<div class='content has-sidebar'>", "<div id=search-result-page><div class=with-comments>"):
            assert html_text.main_text(opened + plain, learned) == f"{body} {last}"
        assert html_text.main_text(f"<article><div class='has-sidebar'>{plain}</div></article>", learned) == f"{body} {last}"
        assert html_text.main_text(late, learned) == body


FRAMES = (
    "<form>{}</form>",
    "<div class='content has-sidebar'>{}</div>",
    "<div id='widget-page'>{}</div>",
    "<form><div class='with-menu'>{}</div></form>",
)


@pytest.mark.parametrize("others", [0, 30, 2000])
@pytest.mark.parametrize("frame", FRAMES)
def test_frames_keep_their_text_beside_any_other(frame, others):
    body = f"<p>{sentence(1, 200)}</p>"
    beside = f"<p>{sentence(2, others)}</p>" if others else ""
    fields = "<p>Write to us</p><input name='a'><textarea></textarea><button>Send</button>"
    page = f"<body><div class='sidebar'><p>aside</p></div>{frame.format(body)}{beside}<form>{fields}</form></body>"
    assert html_text.main_text(page, {}) == f"{sentence(1, 200)} {sentence(2, others)}".strip()


def test_names_seen_beside_the_main_part_are_no_wrappers():
    labelled = "<body><article><p>{0}</p></article><div class='comments'><p>{0}</p></div></body>"
    learned = html_text.learn(sum((html_text.count_places(labelled.format(sentence(k, 30))) for k in range(40)), Counter()))
    page = f"<body><p>{sentence(1, 40)}</p><div class='comments'><p>{sentence(2, 400)}</p></div></body>"
    assert html_text.main_text(page, learned) == sentence(1, 40)
    # a mark that no labelled page shows: the larger part is the text
    unknown = page.replace("comments", "promo")
    assert html_text.main_text(unknown, learned) == f"{sentence(1, 40)} {sentence(2, 400)}"


@pytest.mark.parametrize("opened", ["<div>a ", "<form><div>a ", "<nav>a ", "<article>a ", "<form><article>a ", "<b>a</i>"])
def test_deep_markup_is_linear(opened):
    begun = time.process_time()
    html_text.main_text(opened * 8000, {})
    assert time.process_time() - begun < 2


def test_best_region_is_that_of_all_regions():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice([-3.0, -1.0, 0.0, 1.0, 2.0]) for _ in range(rng.randint(0, 12))]
        nodes = [rng.randint(0, 2) for _ in scores]
        out = [False, True, rng.random() < 0.5]
        counted = [0.0 if out[n] else s for s, n in zip(scores, nodes, strict=True)]
        every = [sum(counted[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        best, span = html_text._best(scores, out, nodes)
        assert best == max([0.0, *every]) == sum(counted[span])
