"""The operators as registered queries over whole tables, and the SQL of those that SQL can express (see README)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from helixframe.llm import byte_cnn, gnat_negatives, hamming_index, license_join, minhash_dedup, mixture, packing, periodic_runs, pitman_yor, quality_bands, secret_ownership, toxicity_zstd, url_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.quality(table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


@query
def op2_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.Mixture(table(spark, sf_dir, "documents")).totals()


@query
def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


# All pairs of documents that share a shingle, and what they reach.
ORACLE["op3_circulant_minhash"] = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM d),
n AS (SELECT r, COUNT(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, COUNT(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y JOIN d da ON da.r = x JOIN d db ON db.r = y
  WHERE 100 * k >= 80 * (a.n + b.n - k) AND da.doc_id IS NOT NULL AND db.doc_id IS NOT NULL),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c(r, t) AS (SELECT r, r FROM d UNION SELECT c.r, e.y FROM c JOIN e ON e.x = c.t),
m AS (SELECT c.r, min(d.doc_id) AS component_id FROM c JOIN d ON d.r = c.t GROUP BY c.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, coalesce(d.doc_id = component_id, true) AS kept FROM d JOIN m USING (r) LEFT JOIN n USING (r)"""


@query
def op4_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_zstd.score(docs, toxicity_zstd.fit(docs, table(spark, sf_dir, "labels")))


@query
def op5_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


@query
def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.reported(secret_ownership.scan_secrets(table(spark, sf_dir, "documents")))


@query
def op7_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"))


@query
def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, sf_dir, "documents"))


@query
def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.predict(docs, byte_cnn.fit(docs)).drop("n_windows")


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op11_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat_negatives.hard_negatives(gnat_negatives.quantized(table(spark, sf_dir, "embeddings")), lambda vec_id: vec_id % 50 == 0)


# Every score of every anchor.
ORACLE["op11_gnat_negatives"] = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS MATERIALIZED (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
  coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r))::INT AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.ar = p.ar AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3"""


@query
def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).withColumn("patterns", F.array_join("patterns", " "))


ORACLE["op12_url_rules"] = url_rules.oracle_sql()


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.find_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
