"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in DataFrame operations only.

The words of a source, its documents in hashed order, form a stream that is cut into blocks of nearly equal size.  A target
of k whole sizes and a rest takes every block k times and, of one more pass, so many as the rest needs: the source's exact
block quota.  A binary tree splits the quotas of all sources among output shards: a node hands half of its blocks to its left
child, and how many of each source go there is drawn from the multivariate hypergeometric distribution (source by source,
each a hypergeometric draw given those before).  A leaf is a shard; it owns a range of places in each source's
permuted block sequence, so shards are disjoint.  Inside a shard the blocks are ordered by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from helixframe.llm.common import unused, written

WORD = r"[^\x20\x09-\x0D]+"
#: A word with the blanks before it.
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) * F.lit(2.0**-53)


def hashed_below(n: Column, *parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), n)


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """source, sid, source_size, target: the sizes' sum shared by weight, no target above `most` sizes.

    Filling up is done at once: with sources ordered by most * size / weight, the first k are full where the level
    that the others would reach exceeds their ratio.  One row for each source; their list is held in one task.
    """
    by_name, by_ratio = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("ratio", "sid")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("sid", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(cycle, F.pmod("sid", F.lit(len(weights))) + 1))
    rows = rows.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("total", F.sum("source_size").over(W.partitionBy()))
    before, rest = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(0, W.unboundedFollowing)
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    rows = rows.withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
    level = F.first("fits", ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return rows.withColumn("target", F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap"))).select("source", "sid", "source_size", "target")


def quotas(target: DataFrame, block_words: int) -> DataFrame:
    """Adds side_a * side_b = n blocks, base and extra words of a block (the first `extra` have one more), whole passes, quota."""
    wanted = F.ceil(F.col("source_size") / block_words)
    df = target.withColumn("side_b", F.greatest(F.lit(1), F.ceil(F.sqrt(wanted))).cast("long")).withColumn("side_a", F.greatest(F.lit(1), F.ceil(wanted / F.col("side_b"))).cast("long"))
    df = df.withColumn("n", F.col("side_a") * F.col("side_b"))
    df = df.withColumn("base", F.expr("source_size div n")).withColumn("extra", F.col("source_size") % F.col("n"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return df.withColumn("passes", F.floor(share + 1e-12)).withColumn("quota", F.col("passes") * F.col("n") + F.round(F.greatest(F.lit(0.0), share - F.col("passes")) * F.col("n")).cast("long"))


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` from `total` are among the `good`: inverse of the distribution at u.

    The probabilities come from their ratios, one after the other, from 12 standard deviations below the mean to
    12 above it; what lies outside is below the precision of a double.
    """
    t, g, d = total.cast("double"), good.cast("double"), drawn.cast("double")
    mean = d * g / F.greatest(t, F.lit(1.0))
    deviation = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - g / F.greatest(t, F.lit(1.0))) * (t - d) / F.greatest(t - 1, F.lit(1.0))))
    low = F.greatest(F.lit(0.0), d - (t - g), F.floor(mean - 12 * deviation - 1).cast("double"))
    high = F.greatest(low, F.least(d, g, F.ceil(mean + 12 * deviation + 1).cast("double")))
    places = F.sequence(low.cast("long"), high.cast("long"))

    def after(w: Column, x: Column) -> Column:
        x = x.cast("double")
        return w * (g - x) * (d - x) / ((x + 1) * (t - g - d + x + 1))

    # weight and sum so far; the weight belongs to the place about to be added
    begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    sum_all = F.aggregate(places, begin, lambda a, x: F.struct(after(a["w"], x).alias("w"), (a["sum"] + a["w"]).alias("sum")), lambda a: a["sum"])
    begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), low.cast("long").alias("pick"), (u * sum_all).alias("wanted"))
    return F.aggregate(
        places, begin,
        lambda a, x: F.struct(after(a["w"], x).alias("w"), (a["sum"] + a["w"]).alias("sum"), F.when(a["sum"] < a["wanted"], x).otherwise(a["pick"]).alias("pick"), a["wanted"].alias("wanted")),
        lambda a: a["pick"],
    )


def left_share(seed: int, level: int) -> Column:
    """Blocks of each source that the node's left child gets: half of all, drawn source by source."""
    total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, q: a + q)
    begin = F.struct(total.alias("total"), F.expr("0L").alias("draw"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, q: Column) -> Column:
        place = F.size(a["out"])
        draw = F.when(place == 0, F.shiftright(a["total"], 1)).otherwise(a["draw"])
        got = hypergeometric(a["total"], q, draw, uniform(F.lit(seed), F.lit(level), F.col("node"), place))
        # `got` is wanted twice: a one-element transform names it.
        return F.transform(F.array(got), lambda x: F.struct((a["total"] - q).alias("total"), (draw - x).alias("draw"), F.concat(a["out"], F.array(x)).alias("out")))[0]

    return F.aggregate("quota", begin, step, lambda a: a["out"])


def split(quota: DataFrame, levels: int, seed: int) -> DataFrame:
    """shard, sid, first, places: each shard's range of places in each source's permuted blocks.

    The tree starts with one row that holds all sources' quotas and doubles its rows at each level.
    """
    tree = quota.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("sid", "quota"))), lambda s: s["quota"]).alias("quota"))
    tree = tree.select(F.lit(0).cast("long").alias("node"), "quota", F.transform("quota", lambda q: F.lit(0).cast("long")).alias("first"))
    for level in range(levels):
        tree = tree.withColumn("left", left_share(seed, level))
        rest, after = F.zip_with("quota", "left", lambda q, x: q - x), F.zip_with("first", "left", lambda f, x: f + x)
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quota"), F.col("first").alias("first")), F.struct((F.col("node") * 2 + 1).alias("node"), rest.alias("quota"), after.alias("first")))
        tree = tree.select(F.inline(halves))
        if level % 6 == 5:
            tree = tree.repartition(F.col("node"))
    parts = F.arrays_zip(F.col("quota").alias("places"), F.col("first").alias("first"))
    return tree.select(F.col("node").alias("shard"), F.posexplode(parts).alias("sid", "p")).select("shard", "sid", "p.first", "p.places").where("places > 0")


def permuted(block: Column, pass_no: Column, seed: int) -> Column:
    """A bijection of 0..n-1 (n = side_a * side_b), another one for each source and pass: rounds that shift one coordinate by a hash of the other."""
    a, b = F.col("side_a"), F.col("side_b")
    x, y = F.expr("block div side_b"), block % b
    for k in range(3):
        x = F.pmod(x + hashed_below(a, F.lit(seed), F.lit(2 * k), F.col("sid"), pass_no, y), a)
        y = F.pmod(y + hashed_below(b, F.lit(seed), F.lit(2 * k + 1), F.col("sid"), pass_no, x), b)
    return x * b + y


def block_of(word: Column) -> Column:
    """The block of a word's place in its source's stream."""
    long_part = F.col("extra") * (F.col("base") + 1)
    return F.when(word < long_part, F.floor(word / (F.col("base") + 1))).otherwise(F.col("extra") + F.floor((word - long_part) / F.greatest(F.lit(1), F.col("base")))).cast("long")


def block_start(block: Column) -> Column:
    return block * F.col("base") + F.least(block, F.col("extra"))


class Mixture:
    """The mix of a table: `documents` (one row each, with sizes and its source's target) and `pieces` (what is taken)."""

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0, block_words: int = 128, shard_words: int = 1_000_000, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None, bucket_rows: int = 1000):
        """weights: repeated over the sources in code point order, null last; most: largest number of times that a source's size is taken.

        A null text has size 0; rows of size 0 are listed and nothing of them is taken; repeated rows are rows of
        their own; columns beyond the three named are ignored; an empty table gives empty results.  Runs agree: every draw is a hash of
        the seed, the ids and the sizes.  `row_col` names a column of unique numbers, if there is one; else rows are numbered.
        """
        size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
        number = F.col(row_col) if row_col else F.monotonically_increasing_id()
        rows = docs.select(number.cast("long").alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
        rows = written(rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size")), "mix-sizes")
        count, words = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        self.shard_levels = max(0, (-(-words // shard_words) - 1).bit_length())
        self.seed = seed
        self.target = written(quotas(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), block_words), "mix-targets")
        same = F.col("t.source").eqNullSafe(F.col("r.source"))
        fields = ["sid", "source_size", "target", "side_a", "side_b", "n", "base", "extra", "passes", "quota"]
        keyed = rows.alias("r").join(self.target.alias("t"), same).select("r.row", "r.doc_id", "r.source", "r.size", "r.h", *fields)
        self.documents = keyed.select("row", "doc_id", "source", "size", "source_size", "target")
        # Place of a document's first word in its source's stream: words of earlier buckets of the hash, then within the bucket.
        bits = max(0, (-(-count // bucket_rows) - 1).bit_length())
        keyed = keyed.where("size > 0").withColumn("bucket", F.shiftrightunsigned(F.shiftrightunsigned("h", 1), 63 - bits) if bits else F.lit(0).cast("long"))
        sums = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_size"))
        earlier = sums.select("sid", "bucket", F.coalesce(F.sum("bucket_size").over(W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        inside = F.coalesce(F.sum("size").over(W.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        self.placed = keyed.withColumn("inside", inside).join(earlier, ["sid", "bucket"]).withColumn("at", F.col("before") + F.col("inside"))

    def shards(self) -> DataFrame:
        return split(self.target.select("sid", "quota"), self.shard_levels, self.seed)

    def taken_blocks(self) -> DataFrame:
        """row, pass, start, length (words of the document) and the place in the source's permuted blocks, of every part taken."""
        blocks = F.explode(F.sequence(block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1)))
        df = self.placed.withColumn("block", blocks).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
        df = df.withColumn("place", F.col("pass") * F.col("n") + permuted(F.col("block"), F.col("pass"), self.seed)).where("place < quota")
        start = F.greatest(F.lit(0), block_start(F.col("block")) - F.col("at"))
        end = F.least(F.col("size"), block_start(F.col("block") + 1) - F.col("at"))
        return df.select("row", "doc_id", "sid", "quota", "size", "pass", "place", start.alias("start"), (end - start).alias("length")).where("length > 0")

    def pieces(self) -> DataFrame:
        """The mix: shard, order (inside the shard), row, doc_id, pass, start, length."""
        n = 1 << self.shard_levels
        step = F.greatest(F.lit(1).cast("long"), F.floor(F.col("quota") / n))
        shards = self.shards().join(self.target.select("sid", "quota"), "sid").withColumn("slot", F.explode(F.sequence(F.floor(F.col("first") / step), F.floor((F.col("first") + F.col("places") - 1) / step))))
        shards = shards.select(F.col("sid"), "slot", "shard", "first", "places")
        parts = self.taken_blocks().withColumn("slot", F.floor(F.col("place") / step))
        found = parts.join(shards, ["sid", "slot"]).where((F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("places")))
        return found.select("shard", F.xxhash64(F.lit(self.seed), "shard", "sid", "place").alias("order"), "row", "doc_id", "pass", "start", "length")

    def laid_out(self) -> DataFrame:
        """The pieces, each shard in one partition and shuffled there."""
        return self.pieces().repartition(F.col("shard")).sortWithinPartitions("shard", "order", "row", "start")

    def totals(self) -> DataFrame:
        """doc_id, size, source_size, target, taken of every document, taken words counted with repeats."""
        taken = self.pieces().groupBy("row").agg(F.sum("length").alias("taken"))
        return self.documents.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def texts(self, docs: DataFrame, row_col: str, text_col: str = "text") -> DataFrame:
        """`docs` as mixed: a row for each pass over a document, its text cut to the words taken in that pass.

        Words taken whole leave the text as it is; of a part, each word comes with the blanks before it.  A row goes to the
        shard of its first part, and each shard lies in one partition in its hashed order.  Columns of `docs` may have any names.
        """
        end = F.col("start") + F.col("length")
        by_pass = self.pieces().groupBy("row", "pass").agg(
            F.min_by(F.struct("shard", "order"), "start").alias("at"), F.sum("length").alias("words"), F.array_sort(F.collect_list(F.struct("start", end.alias("end")))).alias("parts")
        )
        parts = F.transform("parts", lambda p: F.struct(p["start"].alias("start"), (p["end"] - p["start"]).alias("length")))
        row, part, runs, shard, order, cut_words = unused(docs, "taken", "part", "runs", "shard", "order", "words")
        taken = by_pass.join(self.documents.select("row", "size"), "row").select(F.col("row").alias(row), (F.col("words") < F.col("size")).alias(part), parts.alias(runs), F.col("at.shard").alias(shard), F.col("at.order").alias(order))
        text = F.col(text_col)
        words = F.regexp_extract_all(text, F.lit("(" + SPACED_WORD + ")"), F.lit(1))
        cut = F.array_join(F.flatten(F.transform(runs, lambda p: F.slice(cut_words, p["start"].cast("int") + 1, p["length"].cast("int")))), "")
        joined = docs.join(taken, F.col(row_col) == F.col(row)).withColumn(cut_words, F.when(F.col(part), words))
        mixed = joined.select(shard, order, *[F.when(F.col(part), cut).otherwise(text).alias(c) if c == text_col else F.col(c) for c in docs.columns])
        return mixed.repartition(shard).sortWithinPartitions(shard, order).drop(shard, order)
