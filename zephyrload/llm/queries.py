"""The operators on the benchmark tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrload.llm import (
    bpe,
    centroids,
    decontaminate,
    html_text,
    langid,
    lexical,
    near_dup,
    packing,
    repeats,
    repetition,
    site_quality,
    token_counts,
    toxicity,
)
from zephyrload.llm.common import held_out, table


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; TOKENIZER_DIR replaces the installed folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    hits = decontaminate.benchmark_hits(docs, benchmark, keep=["doc_id"])
    n_hit = F.aggregate("hits.word_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return hits.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        decontaminate.digest("hits.items").alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.extract(pages, html_text.train(pages), keep=["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = repetition.verdicts(repetition.repetition(docs, keep=["doc_id"]))
    return found.drop("repeat_spans", "longest_repeat")


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = repeats.without_repeats(docs, keep=["doc_id", "text"])
    return found.select(
        "doc_id",
        F.col("repeats.n_words").alias("n_words"),
        F.col("repeats.n_removed").alias("n_removed"),
        F.sha2(repeats.kept_text("text", "repeats").cast("binary"), 256).alias("kept_sha256"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"])


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return site_quality.judge(docs, labels, keep=["doc_id"]).select("doc_id", "verdict.*")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    decoded = bpe.decode(encoded, path, keep=["doc_id", "ids"])
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.clusters(table(spark, sf_dir, "embeddings")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language,
        op2_decontamination,
        op3_toxicity,
        op4_main_text,
        op5_repetition,
        op6_repeated_passages,
        op7_near_duplicates,
        op8_token_counts,
        op9_site_quality,
        op10_packing,
        op11_byte_bpe,
        op12_centroids,
        op13_lexical_search,
    )
}

# Words as the contracts name them; a lone separator never matches.
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_PLAIN}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_PLAIN}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
),
grams AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)
),
occ AS (SELECT doc_id, item_id, i, k FROM grams JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM occ) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _covered(k: int) -> str:
    """Words of each document under word windows of length k that occur again in it."""
    return f"""
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + {k})) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
        SELECT doc_id, i, array_to_string(w[i : i + {k} - 1], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM d WHERE len(w) >= {k})
      )
    ) WHERE c > 1
  ) GROUP BY 1"""


_OP5 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents
),
three AS ({_covered(3)}),
many AS ({_covered(repetition.MIN_REPEAT)}),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '{_SPACED}') GROUP BY 1
),
toolong AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id, g, count(*) AS c FROM (
      SELECT doc_id, array_to_string(w[i : i + {repetition.MAX_REPEAT}], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {repetition.MAX_REPEAT} + 1)) AS i FROM d WHERE len(w) > {repetition.MAX_REPEAT})
    ) GROUP BY 1, 2
  ) WHERE c > 1
),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
    coalesce(three.n, 0)::BIGINT AS n_repeat_words, coalesce(many.n, 0)::BIGINT AS n_covered_words,
    toolong.doc_id IS NOT NULL AS over_long
  FROM d LEFT JOIN three USING (doc_id) LEFT JOIN many USING (doc_id) LEFT JOIN lines USING (doc_id)
  LEFT JOIN toolong USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, base_failed,
  NOT base_failed AND 100 * n_covered_words <= {repetition.MAX_COVERED_PERCENT} * n_words AND NOT over_long AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
"""

_OP6 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(i, i + 20)) AS p
    FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM g) WHERE n > 1
  )
),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM (
    SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d
  ) a WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = a.doc_id AND gone.p = a.p) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP7 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_SPACED}') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, x FROM (
    SELECT doc_id, w[i] || ' ' || w[i + 1] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d WHERE len(w) > 1)
    UNION ALL SELECT doc_id, w[1] AS x FROM d WHERE len(w) = 1
  )
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)
),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.seen
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(seen) AS component_id, d.doc_id = min(seen) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id, n.n
"""



def _op12() -> str:
    """Ten rounds, one after the other; lists hold the 64 entries."""
    square = "list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))"
    nearest = f"""
SELECT v.vec_id, v.v, c.k, {square}::BIGINT AS d FROM v, c{{0}} c
QUALIFY row_number() OVER (PARTITION BY v.vec_id ORDER BY d, c.k) = 1"""
    steps = [
        """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, v FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8
)"""
    ]
    for n in range(10):
        steps.append(f"""
a{n} AS MATERIALIZED ({nearest.format(n)}),
s{n} AS MATERIALIZED (
  SELECT k, list(m ORDER BY i) AS v FROM (
    SELECT k, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM (SELECT k, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY k, i
  ) GROUP BY k
),
c{n + 1} AS MATERIALIZED (SELECT k, coalesce(s.v, c.v) AS v FROM c{n} c LEFT JOIN s{n} s USING (k))""")
    return f"""{",".join(steps)},
a AS MATERIALIZED ({nearest.format(10)})
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a JOIN c10 USING (k)"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OP13 = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS w FROM documents
),
held AS (SELECT doc_id, r, w, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS cn, sum(n)::BIGINT AS cl FROM held),
m AS (SELECT doc_id, r, 75 + (25 * n * cn) // cl AS m FROM held, s),
p AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM held) GROUP BY 1, 2),
f AS (SELECT t, floor(1000 * ln((2 * cn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY t, cn),
q AS (
  SELECT item_id, t, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS t FROM benchmark) GROUP BY 1, 2
),
scored AS (
  SELECT item_id, r, m.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN f USING (t) JOIN p USING (t) JOIN m USING (r) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0
) WHERE rank <= 20
"""

ORACLE = {
    "op2_decontamination": _OP2,
    "op5_repetition": _OP5,
    "op6_repeated_passages": _OP6,
    "op7_near_duplicates": _OP7,
    "op12_centroids": _op12(),
    "op13_lexical_search": _OP13,
}
