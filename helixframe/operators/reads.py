"""Sequencing reads: mate pairing, lane sampling, quality summary and template consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from helixframe.functions import text as tx
from helixframe.functions.rules import flags
from helixframe.functions.windows import agreed_letters
from helixframe.session import cut_lineage, global_rank


def pair_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Reads of both mates by (lane, ord), with the reason where they do not belong together."""
    a = r1.select("lane", "ord", F.col("id").alias("id1"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    b = r2.select("lane", "ord", F.col("id").alias("id2"), F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    pairs = a.join(b, ["lane", "ord"], "full_outer")
    same = tx.read_name(F.col("id1")) == tx.read_name(F.col("id2"))
    problem = F.when(F.col("id1").isNull() | F.col("id2").isNull(), "missing_mate").when(~same, "id_mismatch")
    return pairs.withColumn("problem", problem)


def lane_status(pairs: DataFrame) -> DataFrame:
    """Pair counts and the first bad record per lane; one bad record refuses the lane."""
    return pairs.groupBy("lane").agg(
        F.count("*").alias("pairs"), F.count("problem").alias("problems"), F.min(F.when(F.col("problem").isNotNull(), F.col("ord"))).alias("first_bad"),
    ).withColumn("status", F.when(F.col("problems") > 0, "refused").otherwise("ok"))


def lane_allocation(lanes: DataFrame, budget: int) -> DataFrame:
    """Equal share per lane, capped by its size; what is left goes to the lanes in order.

    Works on one row per lane.
    """
    n = F.count("*").over(W.partitionBy())
    share = lanes.withColumn("_lanes", n).withColumn("_base", F.least(F.col("pairs"), F.floor(F.lit(budget) / F.col("_lanes"))))
    left = F.least(F.lit(budget), F.sum("pairs").over(W.partitionBy())) - F.sum("_base").over(W.partitionBy())
    room = F.col("pairs") - F.col("_base")
    used = F.coalesce(F.sum(room).over(W.orderBy("lane").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(room, left - used))
    return share.select("lane", "pairs", (F.col("_base") + extra).cast("long").alias("amount"))


def sample_pairs(records: DataFrame, budget: int, seed: str = "0") -> DataFrame:
    """Stratified sample of (lane, id, …) without replacement, reproducible by a seeded hash of the identifier.

    Positions come from a range-partitioned sort, so one huge lane is spread over many tasks.
    """
    lanes = records.groupBy("lane").agg(F.count("*").alias("pairs"))
    amount = lane_allocation(lanes, budget).select("lane", "amount")
    hashed = records.withColumn("_h", F.md5(F.concat(F.lit(seed), F.lit("#"), F.col("id").cast("string"))))
    placed = global_rank(hashed, ["lane"], [F.col("_h"), F.col("id")], "position")
    return placed.join(amount, "lane").where(F.col("position") <= F.col("amount")).drop("_h", "amount")


def sample_plan(lanes: DataFrame, requests: DataFrame) -> DataFrame:
    """(sample, lane, pairs, amount, status) of every lane of the requested samples.

    lanes(sample, lane, lane_ord, pairs), requests(sample, budget).  A budget that does not allow a pair for each lane and a
    sample with an empty lane are refused, with an amount of 0; else each lane gets an equal share of the budget as far as it
    reaches, and what is left goes to the lanes in order.
    """
    every, before = W.partitionBy("sample"), W.partitionBy("sample").orderBy("lane_ord", "lane").rowsBetween(W.unboundedPreceding, -1)
    rows = lanes.join(requests, "sample").withColumns({"_lanes": F.count("*").over(every), "_least": F.min("pairs").over(every)})
    status = F.when(F.col("budget") < F.col("_lanes"), "budget_below_lanes").when(F.col("_least") < 1, "empty_lane").otherwise("ok")
    rows = rows.withColumn("_base", F.least(F.col("pairs"), F.floor(F.col("budget") / F.col("_lanes"))))
    room = F.col("pairs") - F.col("_base")
    left = F.least(F.col("budget"), F.sum("pairs").over(every)) - F.sum("_base").over(every)
    extra = F.greatest(F.lit(0), F.least(room, left - F.coalesce(F.sum(room).over(before), F.lit(0))))
    return rows.select("sample", "lane", "pairs", F.when(status == "ok", F.col("_base") + extra).otherwise(0).cast("long").alias("amount"), status.alias("status"))


def sample_lanes(records: DataFrame, plan: DataFrame, seed: str = "0") -> DataFrame:
    """The records (sample, lane, id, …) of `sample_plan`'s amounts: those with the least seeded hashes of each lane.

    Hashes are counted in 65,536 buckets of each lane, which merge over the tasks; all buckets before the one that reaches the amount are
    taken whole, and only the records of that one are ranked.  No lane is sorted or gathered.
    """
    digest = F.md5(F.concat(F.lit(seed), F.lit("#"), F.col("id").cast("string")))
    hashed = records.withColumn("_h", digest).withColumn("_bucket", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    lane = ["sample", "lane"]
    upto = W.partitionBy(*lane).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = hashed.groupBy(*lane, "_bucket").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    reached = counts.join(plan.where("amount > 0").select(*lane, "amount"), lane).where(F.col("_upto") >= F.col("amount"))
    cut = reached.groupBy(*lane).agg(F.min(F.struct("_bucket", (F.col("amount") - F.col("_upto") + F.col("_n")).alias("_need"))).alias("_cut"))
    near = hashed.join(cut, lane).where(F.col("_bucket") <= F.col("_cut._bucket"))
    place = F.row_number().over(W.partitionBy(*lane).orderBy("_h", "id"))
    last = near.where(F.col("_bucket") == F.col("_cut._bucket")).withColumn("_place", place).where(F.col("_place") <= F.col("_cut._need")).drop("_place")
    return near.where(F.col("_bucket") < F.col("_cut._bucket")).unionByName(last).drop("_h", "_bucket", "_cut")


def template_name(lane_index, identifier, mate):
    """Stable name binding a read to its template: lane, hashed identifier, mate."""
    return F.concat(F.lit("L"), lane_index.cast("string"), F.lit("_P"), F.sha2(tx.read_name(identifier), 256), F.lit("/"), mate.cast("string"))


def keep_templates(reads: DataFrame, sampled: DataFrame) -> DataFrame:
    """Both mates of the sampled templates."""
    return reads.join(sampled.select("lane", "template").distinct(), ["lane", "template"], "left_semi")


def quality_summary(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reads, bases, Q20 and Q30 bases and GC per key, over (seq, qual)."""
    removed = lambda chars: F.length(F.regexp_replace("qual", chars, ""))
    gc = F.length("seq") - F.length(F.translate(F.upper("seq"), "GC", ""))
    sums = reads.groupBy(*keys).agg(
        F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"), F.sum(removed("[!-4]")).alias("q20_bases"), F.sum(removed("[!->]")).alias("q30_bases"), F.sum(gc).alias("gc_bases")
    )
    rate = lambda c: (F.col(c) / F.nullif("bases", F.lit(0)))
    return sums.withColumn("q20_rate", rate("q20_bases")).withColumn("q30_rate", rate("q30_bases")).withColumn("gc_rate", rate("gc_bases"))


def read_count_status(summary: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Observed read count against the validated pair count."""
    joined = expected.join(summary.select(*keys, "reads"), keys, "left")
    return joined.withColumn(
        "status", F.when(F.col("reads").isNull(), "failed_no_report").when(F.col("reads") != F.col("pairs"), "failed_read_count_mismatch").otherwise("ok")
    )


# -- consensus -------------------------------------------------------------------------------------


PIECE = 1_000


def consensus_columns(rows: DataFrame, min_templates: int = 5, fraction: float = 0.9) -> DataFrame:
    """Called base per alignment column from (alignment, template, seq); mates that disagree count for nothing.

    The rows of a template meet in pieces of `PIECE` letters and are merged there; the letters left become rows inside the tasks and
    are counted there, so what is shuffled is a letter a base and then counts, not a row a base.
    """
    pieces = F.regexp_extract_all(F.upper("seq"), F.lit("([\\s\\S]{1,%d})" % PIECE), F.lit(1))
    cut = rows.select("alignment", "template", F.posexplode(pieces).alias("_piece", "_letters"))
    merged = cut.groupBy("alignment", "template", "_piece").agg(agreed_letters(F.collect_list("_letters")).alias("_letters"))
    letters = merged.select("alignment", "_piece", F.posexplode(F.split("_letters", "")).alias("_at", "base"))
    agreed = letters.where(F.col("base").isin("A", "C", "G", "T")).select("alignment", (F.col("_piece") * PIECE + F.col("_at")).alias("site"), "base")
    counts = agreed.groupBy("alignment", "site").agg(*[F.count_if(F.col("base") == b).alias(b) for b in "ACGT"])
    # Equal counts are decided in favour of the first base in the alphabet.
    ranked = F.array_sort(F.array(*[F.struct((-F.col(b)).alias("n"), F.lit(b).alias("base")) for b in "ACGT"]))
    counts = counts.withColumn("_r", ranked).withColumn("depth", F.col("A") + F.col("C") + F.col("G") + F.col("T"))
    first, second = -F.col("_r")[0]["n"], -F.col("_r")[1]["n"]
    call = F.when((F.col("depth") >= min_templates) & (first / F.col("depth") >= fraction), F.col("_r")[0]["base"]).otherwise("N")
    return counts.select("alignment", "site", "depth", call.alias("call"), ((second >= 3) & (second / F.col("depth") >= 0.2)).alias("mixed"))


def consensus_segments(rows: DataFrame, min_length: int = 300, min_templates: int = 5, fraction: float = 0.9) -> DataFrame:
    """Called stretches of at least `min_length` per alignment; any mixed column leaves the alignment without one.

    The collected consensus of an alignment is as long as one of its rows, not as their sum.
    """
    columns = cut_lineage(consensus_columns(rows, min_templates, fraction))
    mixed = columns.groupBy("alignment").agg(F.count_if("mixed").alias("mixed_columns"))
    clean = columns.where(F.col("call") != "N").join(mixed.where("mixed_columns = 0"), "alignment", "left_semi")
    placed = F.array_sort(F.collect_list(F.struct("site", "call")))
    # A gap in the called columns is an unknown base: stretches are never glued together over it.
    joined = clean.groupBy("alignment").agg(placed.alias("_c")).select("alignment", "_c")
    text = F.concat_ws("", F.transform("_c", lambda c, i: F.concat(F.when((i > 0) & (c["site"] != F.get(F.col("_c"), i - 1)["site"] + 1), "N").otherwise(""), c["call"])))
    segments = joined.select("alignment", F.posexplode(F.regexp_extract_all(text, F.lit("[ACGT]{%d,}" % min_length), 0)).alias("segment", "seq"))
    return segments


def single_record_segments(records: DataFrame, min_length: int = 300) -> DataFrame:
    """Segments of an assembled record: maximal unambiguous stretches."""
    stretches = F.regexp_extract_all(F.upper("seq"), F.lit("[ACGT]{%d,}" % min_length), 0)
    return records.select("id", F.posexplode(stretches).alias("segment", "seq"))


def alignment_findings(rows: DataFrame) -> DataFrame:
    """Alignments whose rows differ in length, or rows that cannot be bound to a template."""
    stats = rows.groupBy("alignment").agg(
        F.min(F.length("seq")).alias("_lo"), F.max(F.length("seq")).alias("_hi"), F.count_if(~F.col("name").rlike("L[0-9]+_P[0-9a-f]+")).alias("_unbound")
    )
    found = flags((F.col("_lo") != F.col("_hi"), "unequal_lengths"), (F.col("_unbound") > 0, "unbound_rows"))
    return stats.select("alignment", found.alias("findings")).where(F.size("findings") > 0)
