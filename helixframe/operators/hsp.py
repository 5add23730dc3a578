"""Local alignment segments (HSPs): validity, hit summaries, selection and chaining.

HSPs of searches: `query, hit, accession, query_from, query_to, hit_from, hit_to, align_len, identity, bitscore,
query_len, hit_len` with 1-based closed coordinates; a hit on the minus strand has hit_from > hit_to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from helixframe.functions.rules import flags
from helixframe.operators import intervals as iv
from helixframe.session import cut_lineage, global_rank

HIT = ["query", "hit"]
BIN = 1000


def validity_reasons(strand_text: bool = False) -> Column:
    """Reasons why an HSP row cannot be used; such rows are a format failure, never 'no match'."""
    c = F.col
    required = ["query_from", "query_to", "hit_from", "hit_to", "align_len", "identity", "bitscore"]
    missing = c(required[0]).isNull()
    for name in required[1:]:
        missing = missing | c(name).isNull()
    span = F.abs(c("query_to") - c("query_from")) + 1
    pairs = [
        (missing, "missing_field"),
        (F.least("query_from", "query_to", "hit_from", "hit_to") < 1, "coordinate_below_one"),
        (c("align_len") <= 0, "empty_alignment"),
        ((c("identity") < 0) | (c("identity") > c("align_len")), "identity_out_of_range"),
        (F.isnan(c("bitscore").cast("double")) | (c("bitscore") == float("inf")) | (c("bitscore") < 0), "bad_bitscore"),
        (span > c("align_len"), "span_exceeds_alignment"),
        ((c("query_len") <= 0) | (F.greatest("query_from", "query_to") > c("query_len")), "outside_query"),
        ((c("hit_len") <= 0) | (F.greatest("hit_from", "hit_to") > c("hit_len")), "outside_hit"),
    ]
    if strand_text:
        plus = c("hit_to") >= c("hit_from")
        pairs.append(((F.lower("hit_strand") == "plus") != plus, "strand_contradiction"))
    return flags(*pairs)


def findings(hsps: DataFrame, strand_text: bool = False) -> DataFrame:
    return hsps.withColumn("reasons", validity_reasons(strand_text)).where(F.size("reasons") > 0)


def monotonic_hits(hsps: DataFrame) -> DataFrame:
    """Whether hit coordinates advance in the target's own direction when HSPs are ordered by query start.

    Order is checked inside bins of the query axis and then between the bins' first and last values, so the
    windows stay small for a hit with very many HSPs.  HSPs with one query start are ordered by hit position.
    """
    forward = F.when(F.col("hit_to") >= F.col("hit_from"), F.col("hit_from")).otherwise(-F.col("hit_from"))
    points = hsps.select(*HIT, F.floor(F.col("query_from") / BIN).alias("_bin"), "query_from", forward.alias("_h")).distinct()
    inside = W.partitionBy(*HIT, "_bin").orderBy("query_from", "_h")
    steps = points.withColumn("_ok", F.coalesce(F.col("_h") >= F.lag("_h").over(inside), F.lit(True)))
    bins = steps.groupBy(*HIT, "_bin").agg(
        F.bool_and("_ok").alias("_ok"), F.min_by("_h", F.struct("query_from", "_h")).alias("_first"), F.max_by("_h", F.struct("query_from", "_h")).alias("_last")
    )
    across = F.coalesce(F.col("_first") >= F.lag("_last").over(W.partitionBy(*HIT).orderBy("_bin")), F.lit(True))
    return bins.withColumn("_ok", F.col("_ok") & across).groupBy(*HIT).agg(F.bool_and("_ok").alias("monotonic"))


HELD = 1000  # HSPs of a hit that are summed up in one row


def held_sums(points: Column) -> list[Column]:
    """Covered positions of the query and of the hit, and whether the hit advances (`monotonic_hits`), from a hit's list of HSPs."""
    def covered(side: str) -> Column:
        closed = F.transform(points, lambda p: F.struct(F.least(p[f"{side}_from"], p[f"{side}_to"]).alias("s"), (F.greatest(p[f"{side}_from"], p[f"{side}_to"]) + 1).alias("e")))
        start = F.struct(F.lit(None).cast("long").alias("reach"), F.lit(0).cast("long").alias("sum"))
        step = lambda t, p: F.struct(F.greatest(t["reach"], p["e"]).alias("reach"), (t["sum"] + F.greatest(F.lit(0).cast("long"), p["e"] - F.greatest(p["s"], t["reach"]))).alias("sum"))
        return F.aggregate(F.array_sort(F.filter(closed, lambda p: p["e"].isNotNull())), start, step, lambda t: t["sum"])

    forward = lambda p: F.when(p["hit_to"] >= p["hit_from"], p["hit_from"]).otherwise(-p["hit_from"])
    ordered = F.array_sort(F.transform(points, lambda p: F.struct(p["query_from"].alias("q"), forward(p).alias("h"))))
    begin = F.struct(F.lit(None).cast("long").alias("last"), F.lit(True).alias("ok"))
    advance = lambda t, p: F.struct(p["h"].alias("last"), (t["ok"] & F.coalesce(p["h"] >= t["last"], F.lit(True))).alias("ok"))
    return [covered("query").alias("_query"), covered("hit").alias("_hit"), F.aggregate(ordered, begin, advance, lambda t: t["ok"]).alias("monotonic")]


def hit_sums(hsps: DataFrame, *sums: Column) -> DataFrame:
    """`sums` per hit with the covered positions of its query and hit side (`_query`, `_hit`) and `monotonic`.

    A hit of up to HELD HSPs is summed up from their list, so its HSPs are moved once; the few that have more are counted
    beforehand, and their intervals and order are checked in bins.
    """
    known = hsps.where(F.col("query").isNotNull() & F.col("hit").isNotNull())
    big = cut_lineage(known.groupBy(*HIT).agg(F.count("*").alias("_n")).where(F.col("_n") > HELD).select(*HIT))
    points = F.collect_list(F.struct(*[F.col(p).cast("long").alias(p) for p in ("query_from", "query_to", "hit_from", "hit_to")]))
    any_big = not big.isEmpty()
    few = known.join(big, HIT, "left_anti") if any_big else known
    small = few.groupBy(*HIT).agg(*sums, points.alias("_points"))
    small = small.select("*", *held_sums(F.col("_points"))).drop("_points")
    if not any_big:
        return small
    many = known.join(big, HIT, "left_semi")
    covered = lambda side: iv.union_length(iv.from_closed(many.select(*HIT, F.col(f"{side}_from").alias("start"), F.col(f"{side}_to").alias("end"))), HIT)
    sides = covered("query").select(*HIT, F.col("union_length").alias("_query")).join(covered("hit").select(*HIT, F.col("union_length").alias("_hit")), HIT)
    return small.unionByName(many.groupBy(*HIT).agg(*sums).join(sides, HIT).join(monotonic_hits(many), HIT))


def hit_summaries(hsps: DataFrame, max_span_ratio: float = 3.0, origin_margin: int = 200) -> DataFrame:
    """One row per hit: union coverage, reuse, collinearity, blockers and, only without blockers, one identity."""
    c = F.col
    span = F.abs(c("query_to") - c("query_from")) + 1
    signature = F.concat(F.when(c("query_to") >= c("query_from"), "+").otherwise("-"), F.when(c("hit_to") >= c("hit_from"), "+").otherwise("-"))
    pct = c("identity") / c("align_len") * 100
    joined = hit_sums(
        hsps,
        F.min("accession").alias("accession"), F.max("query_len").alias("query_len"), F.max("hit_len").alias("hit_len"), F.count("*").alias("hsp_count"),
        F.sum(span).alias("spanned_bases"), F.sum("identity").alias("_id"), F.sum("align_len").alias("_al"), F.min(pct).alias("identity_low"), F.max(pct).alias("identity_high"),
        F.max("bitscore").alias("bitscore"), F.sum("bitscore").alias("ranking_bitscore"), F.min(signature).alias("_s1"), F.max(signature).alias("_s2"),
        F.min(F.least("hit_from", "hit_to")).alias("_lo"), F.max(F.greatest("hit_from", "hit_to")).alias("_hi"), F.bool_or(c("identity") == 0).alias("_zero"),
        F.coalesce(F.sum(span), F.lit(0)).alias("_sq"), F.coalesce(F.sum(F.abs(c("hit_to") - c("hit_from")) + 1), F.lit(0)).alias("_sh"),
    )
    joined = joined.withColumns({"aligned_bases": c("_query"), "redundant_bases": c("_sq") - c("_query"), "subject_overlap_bases": c("_sh") - c("_hit")})
    single = c("hsp_count") < 2
    one_way = c("_s1") == c("_s2")
    ratio = F.when(single, F.lit(1.0)).when(one_way, (c("_hi") - c("_lo") + 1) / c("spanned_bases")).otherwise(F.lit(0.0))
    mono = single | (one_way & c("monotonic"))
    joined = joined.withColumn("span_ratio", ratio).withColumn("monotonic", mono)
    joined = joined.withColumn("collinear", single | (c("monotonic") & (c("span_ratio") <= max_span_ratio)))
    crosses = one_way & ~c("monotonic") & (c("hit_len") > 0) & (c("_lo") <= origin_margin) & (c("_hi") >= c("hit_len") - origin_margin)
    blockers = flags(
        (c("_zero"), "zero_identity"), (c("redundant_bases") > 0, "overlapping_hsps"), (c("subject_overlap_bases") > 0, "subject_overlap"),
        (~c("collinear"), "non_collinear_hsps"),
    )
    joined = joined.withColumn("blockers", blockers)
    return joined.select(
        *HIT, "accession", "query_len", "hit_len", "hsp_count", "aligned_bases", "spanned_bases", "redundant_bases", "subject_overlap_bases",
        F.when(F.size("blockers") == 0, c("_id") / c("_al") * 100).alias("identity"), "identity_low", "identity_high", "bitscore", "ranking_bitscore",
        F.when(one_way, F.substring("_s1", 2, 1)).otherwise("mixed").alias("subject_strand"), "monotonic", "span_ratio", "collinear",
        F.coalesce(crosses, F.lit(False)).alias("cross_origin_candidate"), "blockers",
        F.coalesce(c("aligned_bases") / F.nullif("query_len", F.lit(0)), F.lit(0.0)).alias("coverage"),
    )


def best_per_accession(hits: DataFrame) -> DataFrame:
    """One hit per (query, accession): best identity, then bit score, then hit name."""
    order = F.struct(-F.coalesce("identity", F.lit(0.0)), -F.col("bitscore"), F.col("hit"))
    others = [c for c in hits.columns if c not in ("query", "accession")]
    return hits.groupBy("query", "accession").agg(F.min_by(F.struct(*others), order).alias("_r")).select("query", "accession", "_r.*")


def hit_order(hits: DataFrame) -> DataFrame:
    """Position of each hit by descending bit score, then identity.

    The hits are laid down first, since the range sort reads its input twice; columns that are not needed are best dropped before.
    """
    placed = cut_lineage(hits.withColumn("_i", F.coalesce("identity", F.lit(0.0))))
    return global_rank(placed, ["query"], [F.col("bitscore").desc(), F.col("_i").desc(), F.col("hit").asc()], "position").drop("_i")


def supported_hit(hits: DataFrame, min_identity: float = 85.0, min_coverage: float | None = 0.8, margin: float = 1.0) -> DataFrame:
    """The unique best supported hit per query, or no row when the evidence does not discriminate."""
    ident = F.coalesce("identity", F.lit(0.0))
    kept = hits.withColumn("_i", ident).where(F.col("_i") >= min_identity)
    if min_coverage:
        kept = kept.where(F.col("coverage") >= min_coverage)
    top = kept.groupBy("query").agg(F.max("_i").alias("_top"))
    marked = kept.join(top, "query")
    stats = marked.groupBy("query").agg(F.count_if(F.col("_i") == F.col("_top")).alias("_n"), F.max(F.when(F.col("_i") < F.col("_top"), F.col("_i"))).alias("_next"))
    clear = stats.where(F.col("_n") == 1)
    return marked.where(F.col("_i") == F.col("_top")).join(clear, "query").where(F.col("_next").isNull() | (F.col("_top") - F.col("_next") >= margin)).drop("_i", "_top", "_n", "_next")


def barcode_verdict(identity: Column, coverage: Column, min_identity: float = 85.0, min_coverage: float = 0.8) -> Column:
    """insufficient / ambiguous / provisional_candidate; missing numbers are insufficient, not negative."""
    return (
        F.when(identity.isNull() | coverage.isNull() | (coverage < min_coverage), "insufficient")
        .when(identity < min_identity, "ambiguous")
        .otherwise("provisional_candidate")
    )


# -- gene location ---------------------------------------------------------------------------------
# HSPs of genes: `gene, target, strand, qstart, qend, start, end, identity, evalue, aln_len, query_len`.

GROUP = ["gene", "target", "strand"]
SPOT = ["qstart", "qend", "start", "end"]


def distinct_hsps(hsps: DataFrame) -> DataFrame:
    """Equal coordinates collapse to the best e-value."""
    return hsps.groupBy(*GROUP, *SPOT).agg(
        F.min_by(F.struct("evalue", "identity", "aln_len", "query_len"), F.struct("evalue", -F.col("identity"), F.col("aln_len"))).alias("_r")
    ).select(*GROUP, *SPOT, "_r.*")


def follow_links(hsps: DataFrame) -> DataFrame:
    """Pairs where the second HSP continues the first on query and target within the gap limit.

    Both gaps are limited, so the join runs on bins of both axes instead of over all pairs of a group.
    """
    step = 100
    gap = F.greatest(F.lit(20), F.floor(F.col("query_len") * 0.2)).cast("long")
    plus = F.col("strand") == "+"
    # The target axis runs backwards on the minus strand.
    nodes = hsps.select(
        *GROUP, *SPOT, gap.alias("gap"), F.when(plus, F.col("start")).otherwise(-F.col("end")).alias("_from"), F.when(plus, F.col("end")).otherwise(-F.col("start")).alias("_to")
    )
    bins = lambda c: F.sequence(F.floor((F.col(c) + 1) / step), F.floor((F.col(c) + 1 + F.col("gap")) / step))
    left = nodes.select(*GROUP, *[F.col(c).alias(f"_a_{c}") for c in SPOT], F.col("_to").alias("_ta"), "gap", F.explode(bins("qend")).alias("_qb"), bins("_to").alias("_tbs"))
    left = left.withColumn("_tb", F.explode("_tbs")).drop("_tbs")
    right = nodes.select(*GROUP, *[F.col(c).alias(f"_b_{c}") for c in SPOT], F.col("_from").alias("_ts"), F.floor(F.col("qstart") / step).alias("_qb"), F.floor(F.col("_from") / step).alias("_tb"))
    pairs = left.join(right, [*GROUP, "_qb", "_tb"])
    qgap, tgap = F.col("_b_qstart") - F.col("_a_qend") - 1, F.col("_ts") - F.col("_ta") - 1
    fits = qgap.between(0, F.col("gap")) & tgap.between(0, F.col("gap")) & (F.abs(qgap - tgap) <= F.col("gap"))
    return pairs.where(fits).select(*GROUP, *[F.struct(*[F.col(f"_{side}_{c}").alias(c) for c in SPOT]).alias(f"node_{side}") for side in "ab"])


def linked_roots(links: DataFrame) -> DataFrame:
    """The first HSP of the chain (root) of every linked HSP, of links where no HSP has two neighbours on a side.

    Found by pointer jumping: every round doubles the distance looked back, so the number of joins grows with the
    logarithm of the longest chain.  Only HSPs with a neighbour take part.
    """
    followers = links.select(*GROUP, F.col("node_b").alias("node"), F.col("node_a").alias("root"))
    heads = links.select(*GROUP, F.col("node_a").alias("node")).join(followers.select(*GROUP, "node"), [*GROUP, "node"], "left_anti")
    pointers = cut_lineage(followers.unionByName(heads.withColumn("root", F.col("node"))))
    while True:
        hop = pointers.select(*GROUP, F.col("node").alias("root"), F.col("root").alias("_next"))
        moved = cut_lineage(pointers.join(hop, [*GROUP, "root"]).select(*GROUP, "node", F.col("_next").alias("root"), (F.col("_next") != F.col("root")).alias("_moved")))
        pointers = moved.select(*GROUP, "node", "root")
        if not moved.where("_moved").limit(1).count():
            return pointers.select(*GROUP, *[F.col(f"node.{c}").alias(c) for c in SPOT], "root")


def locus_chains(hsps: DataFrame) -> DataFrame:
    """Chains of mutually unique neighbours; a group with any branch keeps its HSPs apart, marked ambiguous.

    An HSP without a neighbour, or in a group with a branch, is a chain by itself and is not shuffled to be one.
    """
    unique = cut_lineage(distinct_hsps(hsps))
    links = cut_lineage(follow_links(unique))
    many = lambda side: links.groupBy(*GROUP, side).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select(*GROUP)
    branched = many("node_a").union(many("node_b")).distinct()
    roots = linked_roots(links.join(branched, GROUP, "left_anti"))
    chained = unique.join(roots, [*GROUP, *SPOT]).groupBy(*GROUP, "root").agg(
        F.lit(False).alias("ambiguous_chain"), F.count("*").alias("hsps"), F.max("query_len").alias("query_len"),
        F.sum(F.col("qend") - F.col("qstart") + 1).alias("aln_len"), F.sum("aln_len").alias("alignment_columns"),
        (F.sum(F.col("identity") * F.col("aln_len")) / F.sum("aln_len")).alias("identity"), F.max("evalue").alias("evalue"),
        F.min("qstart").alias("qstart"), F.max("qend").alias("qend"), F.min("start").alias("start"), F.max("end").alias("end"),
    )
    alone = unique.join(roots, [*GROUP, *SPOT], "left_anti").join(branched.withColumn("_b", F.lit(True)), GROUP, "left").select(
        *GROUP, F.coalesce("_b", F.lit(False)).alias("ambiguous_chain"), F.lit(1).cast("long").alias("hsps"), "query_len",
        (F.col("qend") - F.col("qstart") + 1).alias("aln_len"), F.col("aln_len").alias("alignment_columns"),
        (F.col("identity") * F.col("aln_len") / F.col("aln_len")).alias("identity"), "evalue", "qstart", "qend", "start", "end",
    )
    return chained.drop("root").unionByName(alone)


def gene_hits(chains: DataFrame, genes: DataFrame, min_identity: float = 80.0, min_coverage: float = 0.8) -> DataFrame:
    """Unique location per gene, or the reason why there is none."""
    good = (F.col("identity") >= min_identity) & (F.col("aln_len") / F.col("query_len") >= min_coverage)
    best = F.min_by(F.struct("target", "strand", "start", "end", "identity"), F.when(good, F.struct("target", "start", "end", "strand")))
    stats = chains.groupBy("gene").agg(F.bool_or("ambiguous_chain").alias("_b"), F.count_if(good).alias("_n"), best.alias("_h"))
    joined = genes.select("gene").distinct().join(stats, "gene", "left")
    status = F.when(F.coalesce("_b", F.lit(False)), "branched").when(F.coalesce("_n", F.lit(0)) == 0, "none").when(F.col("_n") > 1, "multiple").otherwise("unique")
    out = joined.withColumn("status", status)
    return out.select("gene", "status", *[F.when(F.col("status") == "unique", F.col(f"_h.{c}")).alias(c) for c in ("target", "strand", "start", "end", "identity")])


def unique_labels(features: DataFrame) -> DataFrame:
    """Label per reference feature: its name, with the location added where the name is repeated in a record."""
    counts = features.groupBy("record", F.lower("name").alias("_k")).agg(F.count("*").alias("_n"))
    place = F.concat(F.col("name"), F.lit("@"), (F.col("start") + 1).cast("string"), F.lit(".."), F.col("end").cast("string"), F.lit(":"), F.col("strand"))
    joined = features.withColumn("_k", F.lower("name")).join(counts, ["record", "_k"])
    return joined.withColumn("label", F.when(F.col("_n") == 1, F.col("name")).otherwise(place)).drop("_k", "_n")
