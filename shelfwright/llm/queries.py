"""Registered queries of the training-data operators and their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm import (
    bpe_lexicon, cotraining, embedding_dedup, language, ngram_join, packing, rns_negatives, rp_forest, substring, tier_packing, warc,
    wavelet, whitening,
)
from shelfwright.llm.common import prepare, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(prepare(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


@query("op1_wavelet_shards")
def wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.token_shards(read(spark, folder, "documents"))


EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN named USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


@query("op2_embedding_near_duplicates", EMBEDDING_SQL)
def embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, folder, "embeddings"))


PAGES_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, max(page_id) AS first FROM p GROUP BY hex),
bits AS (
  SELECT hex, array_to_string(list_transform(range(1, 41), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111',
    4 * (instr('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4)), '') AS b
  FROM firsts
), named AS (
  SELECT hex, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * CAST(substr(b, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INTEGER)
    + 4 * CAST(substr(b, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INTEGER)
    + CAST(substr(b, 5 * i + 5, 1) AS INTEGER), 1)), '') AS payload_digest
  FROM bits
)
SELECT page_id, strlen(html) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN firsts USING (hex) JOIN named USING (hex)
"""


@query("op3_warc_records", PAGES_SQL)
def warc_records(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_records(read(spark, folder, "pages"))


WINDOWS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i : i + 19], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, list(DISTINCT place) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS place FROM later) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN covered USING (doc_id)
"""


@query("op4_repeated_windows", WINDOWS_SQL)
def repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return substring.word_digests(read(spark, folder, "documents"))


@query("op5_nearest_vectors")
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return rp_forest.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(read(spark, folder, "documents"))


@query("op7_language")
def language_of(spark: SparkSession, folder: str) -> DataFrame:
    return language.predictions(read(spark, folder, "documents"))


@query("op8_bpe_lexicon")
def lexicon_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_lexicon.token_digests(read(spark, folder, "documents"))


NGRAMS_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n, sum(g::HUGEINT) AS s, bit_xor(g) AS x FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 5 * m >= 4 * (p.n + q.n - m)
), links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), named AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY n, s, x) AS equal_id FROM sizes)
SELECT doc_id, coalesce(n_links, 0) AS n_links, class_id, coalesce(equal_id, doc_id) AS equal_id
FROM documents JOIN named USING (doc_id) LEFT JOIN degree USING (doc_id) LEFT JOIN classes USING (doc_id)
"""


@query("op9_ngram_join", NGRAMS_SQL)
def ngram_links(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_documents(read(spark, folder, "documents"))


@query("op10_quality_scores")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.scores(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op11_tier_packing")
def tiers(spark: SparkSession, folder: str) -> DataFrame:
    return tier_packing.packed_tiers(read(spark, folder, "documents"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same,
    CAST(list_inner_product(a.x, v.x) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id <> v.vec_id AND len(a.x) = len(v.x) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rns_negatives.hard_negatives(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@query("op13_whitened_embeddings")
def whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_rows(read(spark, folder, "embeddings"))
