"""Taxonomic screening of marker hits by lowest common ancestor, and the sample verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe.functions.text import strip

# Names accepted for an expected taxon.
TAXON_ALIASES = {"昆虫": "Insecta", "insect": "Insecta", "insects": "Insecta", "节肢动物": "Arthropoda"}


def alias_taxon(requests: DataFrame, aliases: dict[str, str] = TAXON_ALIASES) -> DataFrame:
    """Replace a known alias of the expected taxon by its scientific name."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return requests.withColumn("expected", F.coalesce(F.try_element_at(table, F.lower(strip("expected"))), strip("expected")))


def near_best_hits(hits: DataFrame, min_identity: float = 75, min_coverage: float = 0.8, near_best: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Qualified hits near the best score, and per marker the best score, near-best count and strong blocked hits.

    `hits(marker, hit, taxids, ranking_bitscore, coverage, identity, blockers)`.
    """
    blocked = F.size("blockers") > 0
    good = ~blocked & F.col("identity").isNotNull() & (F.col("identity") >= min_identity) & (F.col("coverage") >= min_coverage)
    best = hits.groupBy("marker").agg(
        F.max(F.when(good, F.col("ranking_bitscore"))).alias("best"), F.max(F.when(blocked, F.col("ranking_bitscore"))).alias("_blocked")
    )
    close = hits.where(good).join(best.select("marker", "best"), "marker").where(F.col("ranking_bitscore") >= F.col("best") * near_best)
    stats = best.join(close.groupBy("marker").agg(F.count("*").alias("near_best")), "marker", "left")
    return close, stats.select(
        "marker", "best", F.coalesce("near_best", F.lit(0)).alias("near_best"),
        F.coalesce(F.col("_blocked") >= F.col("best") * near_best, F.lit(False)).alias("blocked_competitor"),
    )


def classify_markers(hits: DataFrame, taxa: DataFrame, expected: DataFrame, saturation: int = 30, **thresholds) -> DataFrame:
    """compatible / discordant / insufficient per marker with the common ancestor of its near-best hits.

    `taxa(taxid, name, rank, lineage)` holds the path from the root down to the taxon itself;
    `expected(marker, expected_taxid)`.  Any gap in the evidence gives `insufficient` with its reason.
    """
    close, stats = near_best_hits(hits, **thresholds)
    # Saturated markers are decided by their count, so only bounded sets of hits are expanded.
    open_ = stats.where((F.col("near_best") > 0) & (F.col("near_best") < saturation) & ~F.col("blocked_competitor")).select("marker")
    ids = close.join(open_, "marker").select("marker", F.explode(F.coalesce(F.nullif("taxids", F.array().cast("array<bigint>")), F.array(F.lit(None).cast("long")))).alias("taxid")).distinct()
    known = ids.join(taxa.select("taxid", "lineage"), "taxid", "left")
    complete = known.groupBy("marker").agg(F.count("*").alias("_taxa"), F.bool_or(F.col("lineage").isNull()).alias("_missing"))
    nodes = known.select("marker", F.posexplode("lineage").alias("depth", "node"))
    shared = nodes.groupBy("marker", "node.taxid").agg(F.count("*").alias("_n"), F.max("depth").alias("depth"), F.first("node.name").alias("name"), F.first("node.rank").alias("rank"))
    common = shared.join(complete.where(~F.col("_missing")), "marker").where(F.col("_n") == F.col("_taxa"))
    wanted = expected.join(taxa.select(F.col("taxid").alias("expected_taxid"), F.col("lineage").alias("_expected")), "expected_taxid", "left")
    lca = common.join(wanted.select("marker", "expected_taxid"), "marker").groupBy("marker").agg(
        F.max_by(F.struct("taxid", "name", "rank"), F.struct("depth", "taxid")).alias("lca"), F.bool_or(F.col("taxid") == F.col("expected_taxid")).alias("_inside")
    )
    joined = wanted.join(stats, "marker", "left").join(complete, "marker", "left").join(lca, "marker", "left")
    above = F.exists("_expected", lambda n: n["taxid"] == F.col("lca.taxid"))
    reason = (
        F.when(F.coalesce("near_best", F.lit(0)) == 0, "no_qualified_hit").when(F.col("blocked_competitor"), "strong_blocked_hit")
        .when(F.col("near_best") >= saturation, "saturated").when(F.coalesce("_missing", F.lit(True)), "taxonomy_incomplete")
        .when(F.col("lca").isNull(), "no_common_lineage")
    )
    joined = joined.withColumn("reason", reason)
    status = (
        F.when(F.col("reason").isNotNull(), "insufficient").when(F.col("_inside"), "compatible")
        .when(F.coalesce(above, F.lit(False)), "insufficient").otherwise("discordant")
    )
    return joined.select(
        "marker", status.alias("status"), F.col("reason"), F.coalesce("near_best", F.lit(0)).alias("near_best"), F.col("lca.taxid").alias("lca_taxid"),
        F.col("lca.name").alias("lca_name"), F.col("lca.rank").alias("lca_rank"),
    )


def sample_verdict(markers: DataFrame, samples: DataFrame) -> DataFrame:
    """Mixed before insufficient before mismatch before compatible; `samples(sample, failures)`."""
    seen = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    stats = markers.groupBy("sample").agg(seen("compatible").alias("_c"), seen("discordant").alias("_d"), seen("insufficient").alias("_i"), F.count("*").alias("markers"))
    joined = samples.select("sample", "failures").join(stats, "sample", "left")
    c, d, i = (F.coalesce(x, F.lit(False)) for x in ("_c", "_d", "_i"))
    status = (
        F.when(c & d, "suspected_mixed").when((F.coalesce("failures", F.lit(0)) > 0) | F.col("markers").isNull() | i, "insufficient")
        .when(d, "suspected_mismatch").when(c, "compatible").otherwise("insufficient")
    )
    return joined.select("sample", F.coalesce("markers", F.lit(0)).alias("markers"), status.alias("status"))


def exact_profile(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile of exactly the requested taxon name; relatives never stand in."""
    wanted = requests.select(F.col("name").alias("requested"), F.lower(strip("name")).alias("_k"))
    known = profiles.withColumn("_k", F.lower("name")).withColumn("_hit", F.lit(True))
    return wanted.join(known, "_k", "left").withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_k", "_hit")
