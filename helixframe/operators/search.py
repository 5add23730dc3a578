"""Keyword search over text records with BM25 ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

WORD = r"(?U)\w+"


def tokens(docs: DataFrame, fields: list[str], key: str = "doc_id") -> DataFrame:
    """Lower-case word tokens per field, one row per occurrence."""
    texts = F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])
    words = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(F.lower(t), F.lit(WORD), 0)))
    return docs.select(key, F.explode(words).alias("token"))


def query_tokens(query: str) -> list[str]:
    """Distinct word tokens of a query string."""
    import re

    return list(dict.fromkeys(re.findall(r"\w+", query.lower())))


def matching(docs: DataFrame, query: str, fields: list[str], key: str = "doc_id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Records holding every query token, with their BM25 score (lower is better, as full-text engines report it).

    Term counts are reduced per record before the shuffle; lengths and document frequencies are one small row
    per token.  A query without any token finds nothing unless it is blank.
    """
    wanted = query_tokens(query)
    if not wanted:
        return docs.select(key).withColumn("score", F.lit(0.0)) if not query.strip() else docs.select(key).withColumn("score", F.lit(0.0)).where("false")
    texts = F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])
    words = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(F.lower(t), F.lit(WORD), 0)))
    occurrences = lambda t: F.size(F.filter("_w", lambda w: w == t))
    # Counting inside the row keeps the text out of every shuffle.
    counted = docs.select(key, words.alias("_w")).select(key, F.size("_w").alias("_len"), *[occurrences(t).alias(f"_f{i}") for i, t in enumerate(wanted)])
    stats = counted.agg(F.count("*").alias("_docs"), F.avg("_len").alias("_avg"), *[F.count_if(F.col(f"_f{i}") > 0).alias(f"_d{i}") for i in range(len(wanted))])
    every = reduce(lambda a, c: a & c, [F.col(f"_f{i}") > 0 for i in range(len(wanted))])
    score = F.lit(0.0)
    for i in range(len(wanted)):
        tf = F.col(f"_f{i}").cast("double")
        raw = F.ln((F.col("_docs") - F.col(f"_d{i}") + 0.5) / (F.col(f"_d{i}") + 0.5))
        # Terms in more than half of the records keep a tiny positive weight.
        idf = F.when(raw <= 0, 1e-6).otherwise(raw)
        score = score + idf * (tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("_len") / F.col("_avg"))))
    return counted.where(every).join(stats).select(key, (-score).alias("score"))


def search(
    docs: DataFrame, query: str, fields: list[str], key: str = "doc_id", status: str = "verified", domain: str | None = None, taxon: str | None = None,
    data_type: str | None = None, limit: int = 5,
) -> DataFrame:
    """Ranked search with exact filters applied before the limit; ties by key.

    `docs` carries status, domain and the arrays taxa and data_types; `status='all'` switches that filter off.
    """
    found = docs.join(matching(docs, query, fields, key), key)
    if status != "all":
        found = found.where(F.col("status") == status)
    if domain:
        found = found.where(F.col("domain") == domain)
    if taxon:
        found = found.where(F.exists("taxa", lambda t: F.lower(t) == taxon.lower()))
    if data_type:
        found = found.where(F.exists("data_types", lambda t: F.lower(t) == data_type.lower()))
    return found.orderBy("score", key).limit(limit)
