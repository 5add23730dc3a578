"""Gene orders as cycles: adjacency, equivalence up to rotation and reversal, arrangement differences.

A cycle is a set of rows (record, ord, name, strand).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe.session import global_rank


def adjacent_pairs(cycle: DataFrame) -> DataFrame:
    """Each gene with the next one, the last with the first; a single gene has no pair.

    Positions come from a distributed rank and neighbours from an equi-join, so no record is held in one task.
    """
    placed = global_rank(cycle.select("record", "ord", "name", "strand"), ["record"], [F.col("ord"), F.col("name"), F.col("strand")], "_p")
    sizes = placed.groupBy("record").agg(F.max("_p").alias("_n"))
    nxt = placed.select("record", F.col("_p").alias("_q"), F.col("name").alias("next_name"), F.col("strand").alias("next_strand"))
    here = placed.join(sizes, "record").where(F.col("_n") > 1).withColumn("_q", F.when(F.col("_p") == F.col("_n"), 1).otherwise(F.col("_p") + 1))
    return here.join(nxt, ["record", "_q"]).select("record", "name", "strand", "next_name", "next_strand")


def flipped(strand):
    return F.when(strand == "+", "-").otherwise("+")


def reversed_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs of the reverse complement of the same cycle."""
    return pairs.select("record", F.col("next_name").alias("name"), flipped(F.col("next_strand")).alias("strand"), F.col("name").alias("next_name"), flipped(F.col("strand")).alias("next_strand"))


PAIR = ["name", "strand", "next_name", "next_strand"]


def induced(cycles: DataFrame, comparisons: DataFrame, side: str) -> DataFrame:
    """Genes of one side of each comparison, keyed by comparison."""
    return comparisons.select(F.col("comparison"), F.col(side).alias("record")).join(cycles, "record").drop("record").withColumnRenamed("comparison", "record")


def compare_orders(cycles: DataFrame, comparisons: DataFrame) -> DataFrame:
    """Equivalence and number of differing adjacencies per comparison(comparison, record_a, record_b).

    Differences are counted over shared genes only; gained or lost genes are reported apart.
    """
    a, b = induced(cycles, comparisons, "record_a"), induced(cycles, comparisons, "record_b")
    key = comparisons.select(F.col("comparison").alias("record")).distinct()
    names_a, names_b = a.select("record", "name").distinct(), b.select("record", "name").distinct()
    shared = names_a.join(names_b, ["record", "name"])
    count = lambda df, n: df.groupBy("record").agg(F.count("*").alias(n))
    pa = adjacent_pairs(a.join(shared, ["record", "name"], "left_semi")).distinct()
    pb = adjacent_pairs(b.join(shared, ["record", "name"], "left_semi")).distinct()
    rb = reversed_pairs(pb)
    on = ["record", *PAIR]
    parts = [
        (names_a, "_na"), (names_b, "_nb"), (shared, "_ns"), (a, "_la"), (b, "_lb"),
        (pa, "_pa"), (pb, "_pb"), (pa.join(pb, on, "left_semi"), "_fwd"), (pa.join(rb, on, "left_semi"), "_rev"),
    ]
    out = key
    for df, name in parts:
        out = out.join(count(df, name), "record", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    same = (F.col("_pa") == F.col("_pb")) & ((F.col("_fwd") == F.col("_pa")) | (F.col("_rev") == F.col("_pa")))
    sets = (F.col("_na") == F.col("_ns")) & (F.col("_nb") == F.col("_ns"))
    return out.select(
        F.col("record").alias("comparison"), F.col("_ns").alias("shared_genes"), (F.col("_na") - F.col("_ns")).alias("missing_genes"), (F.col("_nb") - F.col("_ns")).alias("extra_genes"),
        (sets & (F.col("_la") == F.col("_lb")) & same).alias("equivalent"),
        F.when(same, 0).otherwise(F.col("_pa") + F.col("_pb") - 2 * F.col("_fwd")).alias("different_pairs"),
    )


def differing_pairs(cycles: DataFrame, comparisons: DataFrame) -> DataFrame:
    """Adjacencies found on one side only, for comparisons whose shared order differs."""
    a, b = induced(cycles, comparisons, "record_a"), induced(cycles, comparisons, "record_b")
    shared = a.select("record", "name").distinct().join(b.select("record", "name").distinct(), ["record", "name"])
    pa = adjacent_pairs(a.join(shared, ["record", "name"], "left_semi")).distinct()
    pb = adjacent_pairs(b.join(shared, ["record", "name"], "left_semi")).distinct()
    verdict = compare_orders(cycles, comparisons).where("different_pairs > 0").select(F.col("comparison").alias("record"))
    on = ["record", *PAIR]
    only_a = pa.join(pb, on, "left_anti").withColumn("side", F.lit("a"))
    only_b = pb.join(pa, on, "left_anti").withColumn("side", F.lit("b"))
    return only_a.unionByName(only_b).join(verdict, "record", "left_semi").withColumnRenamed("record", "comparison")
