"""The named queries of this package and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    collocations, licenses, mixing, neardup, ngram_join, packing, quality, spelling, substrings, token_counts,
    topk, toxicity, warc,
)
from tickloom.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_digests(warc.read_archives(warc.write_pages(table(spark, sf_dir, "pages"))))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


TOXICITY_CHAIN = {"poor": "quality = 0", "toxic": "toxic = 1"}


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), TOXICITY_CHAIN)
    return toxicity.score(docs, chain, list(TOXICITY_CHAIN)).drop("is_poor")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack_documents(table(spark, sf_dir, "documents")))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("passage")


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_topk": op4_topk,
    "op5_token_counts": op5_token_counts,
    "op6_neardup": op6_neardup,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_repeats": op10_repeats,
    "op11_spelling": op11_spelling,
    "op12_collocations": op12_collocations,
    "op13_ngram_join": op13_ngram_join,
}
SQL: dict[str, str] = {
    "op4_topk": """
WITH points AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM points q JOIN points c ON q.rid <> c.rid WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 10
""",
    "op10_repeats": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
gone AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS place FROM grams)
  WHERE place > 1),
lost AS (SELECT doc_id, list_distinct(flatten(list(range(s, s + 20)))) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
    array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ') AS text
  FROM d LEFT JOIN lost USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(text) AS kept_sha256
FROM kept
""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_page FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
    ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31)
    AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_page OR first_page IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM f
""",
    "op13_ngram_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) END AS s
  FROM d),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT DISTINCT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id
FROM sets LEFT JOIN comp ON a = doc_id
""",
    "op12_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c AS longer WHERE longer.lang = c.lang AND longer.k > c.k AND 100 * longer.a >= 80 * c.a
      AND contains(concat(' ', longer.phrase, ' '), concat(' ', c.phrase, ' ')))),
cuts AS (
  SELECT lang, phrase, a, k, cut, array_to_string(list_slice(w, 1, cut), ' ') AS x,
    array_to_string(list_slice(w, cut + 1, k), ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, fx.f AS l, fy.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * a // (fx.f + fy.f) AS BIGINT) AS score
  FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.phrase = x AND fx.k = cut
    JOIN f fy ON fy.lang = cuts.lang AND fy.phrase = y AND fy.k = cuts.k - cut),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored) WHERE place = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
