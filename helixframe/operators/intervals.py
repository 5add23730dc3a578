"""Interval unions over half-open integer intervals (keys…, start, end).

Intervals are cut at fixed bin borders first.  Inside a bin at most one interval per start survives, so every
window is bounded by the bin width, however many intervals one key holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

WIDTH = 10_000


def from_closed(df: DataFrame) -> DataFrame:
    """Closed intervals in any order to half-open ones; adjacent closed intervals become touching ones."""
    low, high = F.least("start", "end"), F.greatest("start", "end") + 1
    return df.withColumn("_e", high).withColumn("start", low).withColumn("end", F.col("_e")).drop("_e")


def binned_pieces(df: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """Disjoint merged pieces per (keys, bin); `_gain` is the part not covered by earlier pieces of the bin."""
    spread = df.where(F.col("end") > F.col("start")).select(
        *keys, "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))).alias("bin"),
    )
    pieces = spread.groupBy(*keys, "bin", F.greatest(F.col("start"), F.col("bin") * width).alias("s")).agg(
        F.max(F.least(F.col("end"), (F.col("bin") + 1) * width)).alias("e")
    )
    before = W.partitionBy(*keys, "bin").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    reach = F.max("e").over(before)
    return pieces.withColumn("_reach", reach).withColumn(
        "_gain", F.greatest(F.lit(0).cast("long"), (F.col("e") - F.greatest("s", F.coalesce("_reach", F.col("s")))).cast("long"))
    )


def union_length(df: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """Covered positions, spanned positions (with repeats) and their difference per key."""
    covered = binned_pieces(df, keys, width).groupBy(*keys).agg(F.sum("_gain").alias("union_length"))
    spanned = df.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0).cast("long"), (F.col("end") - F.col("start")).cast("long"))).alias("spanned"), F.count("*").alias("intervals"))
    joined = spanned.join(covered, keys, "left")
    union = F.coalesce("union_length", F.lit(0))
    return joined.select(*keys, "intervals", "spanned", union.alias("union_length"), (F.col("spanned") - union).alias("redundant"))


def islands(df: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """Merged intervals, numbered per key; touching intervals merge.

    Pieces are merged inside bins; a piece that reaches a bin border is continued if another one starts
    there.  The k-th remaining start belongs to the k-th remaining end, and both are numbered from counts
    per bin, so no window runs over all intervals of a key.
    """
    pieces = binned_pieces(df, keys, width)
    fresh = (F.col("_reach").isNull() | (F.col("s") > F.col("_reach"))).cast("int")
    upto = W.partitionBy(*keys, "bin").orderBy("s").rowsBetween(W.unboundedPreceding, W.currentRow)
    merged = pieces.withColumn("_g", F.sum(fresh).over(upto)).groupBy(*keys, "bin", "_g").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    left = merged.where(F.col("e") == (F.col("bin") + 1) * width).select(*keys, F.col("e").alias("border"))
    right = merged.where(F.col("s") == F.col("bin") * width).select(*keys, F.col("s").alias("border"))
    bridges = left.join(right, [*keys, "border"]).withColumn("_bridge", F.lit(True))

    def numbered(side: str) -> DataFrame:
        ends = merged.select(*keys, "bin", F.col(side).alias("border")).join(bridges, [*keys, "border"], "left").where(F.col("_bridge").isNull())
        counts = ends.groupBy(*keys, "bin").agg(F.count("*").alias("_n"))
        prior = F.sum("_n").over(W.partitionBy(*keys).orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
        counts = counts.select(*keys, "bin", F.coalesce(prior, F.lit(0)).alias("_before"))
        inside = F.row_number().over(W.partitionBy(*keys, "bin").orderBy("border"))
        return ends.withColumn("_i", inside).join(counts, [*keys, "bin"]).select(*keys, (F.col("_before") + F.col("_i")).alias("island"), F.col("border"))

    starts = numbered("s").withColumnRenamed("border", "start")
    return starts.join(numbered("e").withColumnRenamed("border", "end"), [*keys, "island"])
