"""Sequence records: composition, windows, intake findings, overlaps, shared stretches and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.functions import seq as sq
from helixframe.functions.windows import last_window, letters_around, longest_shared, places_of_ends, seeds as seeds_of, stretches_of, suffix_prefix_overlap, whole_stretches  # noqa: F401
from helixframe.functions.rules import flags
from helixframe.session import cut_lineage


def composition(records: DataFrame) -> DataFrame:
    """Length, base counts, ambiguous bases and GC over unambiguous bases per record (path, id, seq)."""
    b = sq.base_counts(F.col("seq"))
    counted = records.select("path", "id", *[b[c].cast("long").alias(c) for c in ("length", "a", "c", "g", "t", "ambiguous")])
    return counted.withColumn("gc_percent", (F.col("g") + F.col("c")) / F.nullif(F.col("a") + F.col("c") + F.col("g") + F.col("t"), F.lit(0)) * 100)


def totals(records: DataFrame) -> DataFrame:
    """The same over all records of a file; GC and AT are 0 where no base is unambiguous."""
    sums = composition(records).groupBy("path").agg(F.count("*").alias("records"), *[F.sum(c).alias(c) for c in ("length", "a", "c", "g", "t", "ambiguous")])
    acgt = F.nullif(F.col("a") + F.col("c") + F.col("g") + F.col("t"), F.lit(0))
    pct = lambda x, y: F.coalesce((F.col(x) + F.col(y)) / acgt * 100, F.lit(0.0))
    return sums.withColumn("gc_percent", pct("g", "c")).withColumn("at_percent", pct("a", "t"))


def gc_windows(records: DataFrame, window: int = 500, low: float = 18.0) -> DataFrame:
    """GC per fixed window, 1-based closed, with a flag for low GC; a window without bases counts as 0."""
    cut = records.select("path", "id", F.explode(sq.windows(F.upper("seq"), window)).alias("w"))
    gc = F.coalesce(sq.gc_percent(F.col("w.piece")), F.lit(0.0))
    return cut.select("path", "id", (F.col("w.start") + 1).alias("start"), (F.col("w.start") + F.length("w.piece")).alias("end"), gc.alias("gc_percent"), (gc < low).alias("low_gc"))


def symbol_runs(records: DataFrame, letters: str) -> DataFrame:
    """Maximal runs of the given letters, 1-based closed."""
    return records.select("path", "id", F.explode(sq.runs_of(F.upper("seq"), letters)).alias("r")).select("path", "id", "r.start", "r.end")


def intake_findings(records: DataFrame) -> DataFrame:
    """Findings per file: several records, repeated identifiers, ambiguous bases; INFO when there is none."""
    ids = records.groupBy("path", "id").agg(F.count("*").alias("_n"), F.sum(F.length("seq") - sq.letter_count(F.upper("seq"), "ACGT")).alias("_amb"))
    files = ids.groupBy("path").agg(F.sum("_n").alias("records"), F.count_if(F.col("_n") > 1).alias("duplicate_ids"), F.sum("_amb").alias("ambiguous"))
    found = flags((F.col("records") > 1, "MULTIPLE_RECORDS"), (F.col("duplicate_ids") > 0, "DUPLICATE_IDS"), (F.col("ambiguous") > 0, "AMBIGUOUS_BASES"))
    codes = F.when(F.size(found) == 0, F.array(F.lit("BASIC_INTAKE_CLEAR"))).otherwise(found)
    rows = files.select("path", "records", F.explode(codes).alias("code"))
    level = F.when(F.col("code") == "DUPLICATE_IDS", "BLOCK").when(F.col("code") == "BASIC_INTAKE_CLEAR", "INFO").otherwise("REVIEW")
    return rows.withColumn("level", level)


# -- overlaps --------------------------------------------------------------------------------------


# The four ways to orient two scaffolds.
ORIENTATIONS = (("s1+s2", False, False), ("s1+rc(s2)", False, True), ("rc(s1)+s2", True, False), ("rc(s1)+rc(s2)", True, True))


def oriented_joins(pairs: DataFrame, minimum: int = 20, flank: int = 10) -> DataFrame:
    """Four joins per (case_id, seq1, seq2): overlap, joined sequence, the anchor region over the join, and a status.

    Sequences with fewer than `minimum` letters are joined end to end without an overlap and marked insufficient.
    """
    rc = pairs.select("case_id", "seq1", "seq2", sq.reverse_complement(F.col("seq1")).alias("_r1"), sq.reverse_complement(F.col("seq2")).alias("_r2"))
    ways = [
        F.struct(F.lit(name).alias("variant"), F.col("_r1" if a else "seq1").alias("left"), F.col("_r2" if b else "seq2").alias("right"))
        for name, a, b in ORIENTATIONS
    ]
    cases = rc.select("case_id", F.explode(F.array(*ways)).alias("w")).select("case_id", "w.*")
    cases = cases.withColumn("overlap", suffix_prefix_overlap(F.col("left"), F.col("right"), minimum))
    joined = F.concat(F.col("left"), F.expr("substr(right, overlap + 1)"))
    short = F.least(F.length("left"), F.length("right")) < minimum
    status = F.when(short, "insufficient").when(F.col("overlap") > 0, "overlap").otherwise("no_overlap")
    cases = cases.select("case_id", "variant", "overlap", F.length("left").alias("_ll"), joined.alias("joined"), status.alias("status"))
    anchor = sq.anchor_region(F.col("_ll"), F.col("overlap"), F.length("joined"), flank)
    return cases.select("case_id", "variant", "overlap", "joined", anchor["low"].alias("anchor_low"), anchor["high"].alias("anchor_high"), "status")


def end_overlaps(scaffolds: DataFrame, minimum: int = 20) -> DataFrame:
    """Which ends of the scaffolds of a case overlap: (case_id, left_id, left_strand, right_id, right_strand, overlap), left_id < right_id.

    Scaffolds (case_id, scaffold_id, seq) meet the hashes of the last `minimum` letters of their case, `ENDS` at a time, and look
    for them among their own windows, so no window is shuffled.  The last place of an end bounds its overlap: only the
    letters up to there are sent, and the longest overlap is found in them exactly.  Shorter sequences have no end to join.
    """
    long = scaffolds.where(F.length("seq") >= minimum).select("case_id", "scaffold_id", "seq")
    turned = lambda strand: F.when(F.col(strand) == "-", sq.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    strands = F.explode(F.array(F.lit("+"), F.lit("-")))
    tails = F.array(F.right("seq", F.lit(minimum)), sq.reverse_complement(F.left("seq", F.lit(minimum))))
    ends = long.select("case_id", F.col("scaffold_id").alias("left_id"), F.length("seq").alias("size"), F.posexplode(tails).alias("_s", "tail"))
    ends = ends.select("case_id", "left_id", F.when(F.col("_s") == 0, "+").otherwise("-").alias("left_strand"), last_window(F.col("tail"), minimum).alias("mark"), "size")
    # A case of many scaffolds has its ends dealt to parts, and its sequences to as many shares.
    parts = long.groupBy("case_id").agg(F.ceil(F.count("*") * 2 / ENDS).cast("int").alias("parts"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ends = ends.join(parts, "case_id").withColumn("part", F.pmod(F.xxhash64("left_id", "left_strand"), F.col("parts")).cast("int"))
    ends = ends.groupBy("case_id", "part", "parts").agg(F.collect_list(F.struct("left_id", "left_strand", "mark", "size")).alias("ends")).withColumn("share", every)
    held = long.join(parts, "case_id").withColumn("share", F.pmod(F.xxhash64("scaffold_id"), F.col("parts")).cast("int")).withColumn("part", every)
    met = held.join(ends.drop("parts"), ["case_id", "part", "share"]).withColumn("right_strand", strands).withColumn("seq", turned("right_strand"))
    met = met.select("case_id", F.col("scaffold_id").alias("right_id"), "right_strand", "seq", "ends", F.explode(places_of_ends(F.col("seq"), F.col("ends.mark"), F.col("ends.size"), minimum)).alias("p"))
    met = met.select("case_id", "right_id", "right_strand", F.get(F.col("ends"), F.col("p.i")).alias("e"), F.left("seq", F.col("p.reach")).alias("_r"))
    pairs = met.where(F.col("e.left_id") < F.col("right_id")).select("case_id", "e.left_id", "e.left_strand", "right_id", "right_strand", "_r")
    left = long.withColumnRenamed("scaffold_id", "left_id")
    pairs = pairs.join(left, ["case_id", "left_id"]).withColumn("_l", F.right(turned("left_strand"), F.length("_r")))
    found = pairs.withColumn("overlap", suffix_prefix_overlap(F.col("_l"), F.col("_r"), minimum)).where("overlap > 0")
    return found.select("case_id", "left_id", "left_strand", "right_id", "right_strand", "overlap")


ENDS = 4096


def unique_maximum(scored: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """The row with the highest score per key, only where it is alone at the top."""
    top = scored.groupBy(*keys).agg(F.max(score).alias("_top"))
    tied = scored.join(top, keys).where(F.col(score) == F.col("_top"))
    alone = tied.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") == 1).select(*keys)
    return tied.join(alone, keys).drop("_top")


def score_variants(blocks: DataFrame, variants: DataFrame) -> DataFrame:
    """Covered query length per join, halved unless all its blocks (case_id, variant, start, end, strand) are forward."""
    from helixframe.operators.intervals import union_length

    keys = ["case_id", "variant"]
    covered = union_length(blocks.select(*keys, F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end")), keys).select(*keys, "union_length")
    ways = blocks.groupBy(*keys).agg(F.count("*").alias("blocks"), F.bool_and(F.col("strand") == "+").alias("_forward"))
    joined = variants.select(*keys).join(covered, keys, "left").join(ways, keys, "left")
    weight = F.when(F.coalesce("_forward", F.lit(False)), 1.0).otherwise(0.5)
    return joined.select(*keys, F.coalesce("blocks", F.lit(0)).alias("blocks"), (F.coalesce("union_length", F.lit(0)) * weight).alias("score"))


def best_variant(scored: DataFrame) -> DataFrame:
    """The unique best join per case, or why there is none."""
    best = unique_maximum(scored, ["case_id"])
    all_ = scored.groupBy("case_id").agg(F.max("score").alias("_top"))
    out = all_.join(best.select("case_id", "variant"), "case_id", "left")
    status = F.when(F.col("_top") == 0, "no_match").when(F.col("variant").isNull(), "ambiguous").otherwise("selected")
    return out.select("case_id", F.when(status == "selected", F.col("variant")).alias("variant"), F.col("_top").alias("score"), status.alias("status"))


def annotation_matches(segments: DataFrame, annotations: DataFrame, min_length: int = 300) -> DataFrame:
    """Segments and annotated features of the same record sharing at least `min_length` bases in one stretch, and how many.

    segments: (record, segment_id, seq); annotations: (record, feature_id, seq).  Each sequence gives the least-hashed of any
    neighbouring half-length windows as seeds, so two that share a stretch share a seed near its begin and one near its end.  Where
    the stretches begin and end is told from the letters beside the seeds (see `windows.stretches_of`); sequences are
    searched whole only where a long stretch begins at more than `windows.PLACES` pairs of places (long repeats in both).  Seeds are dealt over
    tasks by the pairs they give, and a seed that many sequences of a record hold is dealt block against block.
    """
    own = segments.select("record", "segment_id", F.explode(seeds_of(F.col("seq"), min_length)).alias("seed"))
    theirs = annotations.select("record", "feature_id", F.explode(seeds_of(F.col("seq"), min_length)).alias("seed"))
    met = cut_lineage(own.join(theirs.select("record", "seed").distinct(), ["record", "seed"], "left_semi"))
    facing = cut_lineage(theirs.join(met.select("record", "seed").distinct(), ["record", "seed"], "left_semi"))
    held = met.groupBy("record", "seed").agg(F.count("*").alias("_a")).join(facing.groupBy("record", "seed").agg(F.count("*").alias("_b")), ["record", "seed"])
    rows, pairs = held.agg(F.coalesce(F.sum(F.col("_a") + F.col("_b")), F.lit(0)), F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0))).first()
    partitions = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, rows // ROWS, pairs // PAIRS)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    crowded = held.where((F.col("_a") > BLOCK) | (F.col("_b") > BLOCK)).select("record", "seed", blocks("_a").alias("_na"), blocks("_b").alias("_nb"))
    k = max(1, min_length // 2)

    def dealt(seeds: DataFrame, records: DataFrame, name: str, mine: str, other: str) -> DataFrame:
        """A row of a crowded seed is in one block of its own side and meets every block of the other one."""
        side = flanks(seeds, records, name, k, 2 * (min_length - k) + 1).join(crowded, ["record", "seed"], "left")
        block = F.pmod(F.xxhash64(name), F.coalesce(mine, F.lit(1)))
        across = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        side = side.withColumn("_own", block.cast("int")).withColumn("_across", across)
        place = ("_own", "_across") if mine == "_na" else ("_across", "_own")
        side = side.withColumn("group", F.xxhash64("record", "seed", *place))
        return side.select(F.pmod("group", F.lit(buckets)).alias("bucket"), "group", F.col("record").alias("record"), F.col(name).alias("id"), "before", "after", "places")

    left, right = dealt(met, segments, "segment_id", "_na", "_nb"), dealt(facing, annotations, "feature_id", "_nb", "_na")
    ids = ["record", "segment_id", "feature_id"]
    ids_ddl = {c: df.schema[c].dataType.simpleString() for c, df in zip(ids, (segments, segments, annotations), strict=True)}
    ddl = ", ".join(f"{c} {kind}" for c, kind in ids_ddl.items())
    # Few bytes but much work a row, so the session may not put these partitions together.
    left, right = (side.repartition(2 * partitions, "bucket") for side in (left, right))
    told = left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(stretches_of(min_length), f"{ddl}, n int, diagonal int, low int, high int, open boolean")
    # On a diagonal, begins and ends take turns, so the n-th begin of a pair belongs to its n-th end.
    place = lambda c: F.array_sort(F.collect_set(F.when(F.col(c).isNotNull(), F.struct("diagonal", c))))
    found = cut_lineage(told.groupBy(*ids).agg(F.max("n").alias("_n"), place("low").alias("_low"), place("high").alias("_high"), F.bool_or("open").alias("_open")))
    long = F.array_max(F.zip_with("_low", "_high", lambda a, b: b["high"] - a["low"]))
    near = found.where("NOT _open").select(*ids, F.greatest("_n", long).cast("bigint").alias("matched_bp"))
    # Texts of pairs that are searched whole meet in blocks, so that a text is sent a few times however many pairs it is in.
    far = found.where("_open").select(*ids)
    size = far.agg(F.count_distinct("segment_id"), F.count_distinct("feature_id")).first()
    far = far.withColumn("bucket", F.struct("record", *[F.pmod(F.xxhash64(c), F.lit(n // 50 + 1)).alias(c) for c, n in (("segment_id", size[0]), ("feature_id", size[1]))]))
    texts = [far.select("bucket", "record", c).distinct().join(df.select("record", c, "seq"), ["record", c]) for c, df in (("segment_id", segments), ("feature_id", annotations))]
    blank = lambda df, c: df.withColumn(c, F.lit(None).cast(ids_ddl[c]))
    texts = blank(texts[0], "feature_id").unionByName(blank(texts[1], "segment_id")).select(*[F.col(c).alias(c) for c in ("bucket", *ids, "seq")])
    far, texts = (side.repartition(2 * partitions, "bucket") for side in (far, texts))
    far = far.groupBy("bucket").cogroup(texts.groupBy("bucket")).applyInArrow(whole_stretches(min_length), f"{ddl}, matched_bp bigint")
    return near.unionByName(far).where(F.col("matched_bp") >= min_length)


ROWS, PAIRS, BLOCK = 20_000, 2_000_000, 2_000  # of a bucket; occurrences in a block of a crowded seed


def flanks(seeds: DataFrame, records: DataFrame, name: str, k: int, reach: int) -> DataFrame:
    """(record, name, seed, before, after, places): see `windows.beside_seeds`."""
    held = seeds.groupBy("record", name).agg(F.collect_list("seed").alias("_s")).join(records.select("record", name, "seq"), ["record", name])
    return held.select("record", name, F.explode(letters_around(F.col("seq"), F.col("_s"), k, reach)).alias("_f")).select("record", name, "_f.*")


def segment_match_status(segments: DataFrame, matches: DataFrame, min_length: int = 300) -> DataFrame:
    """One row per segment: matched, unmatched, or insufficient where it is absent or shorter than the stretch asked for."""
    found = matches.groupBy("record", "segment_id").agg(F.count("*").alias("features"), F.max("matched_bp").alias("matched_bp"))
    rows = segments.select("record", "segment_id", F.length("seq").alias("length"))
    rows = rows.join(found, rows["record"].eqNullSafe(found["record"]) & (rows["segment_id"] == found["segment_id"]), "left").select(rows["record"], rows["segment_id"], "length", "features", "matched_bp")
    status = F.when(F.coalesce("length", F.lit(0)) < min_length, "insufficient").when(F.col("features") > 0, "matched").otherwise("unmatched")
    return rows.select("record", "segment_id", "length", F.coalesce("features", F.lit(0)).alias("features"), "matched_bp", status.alias("status"))


# -- de-duplication --------------------------------------------------------------------------------


def canonical_key(seq: Column) -> Column:
    """Hash of the sequence or its reverse complement, whichever sorts first."""
    return F.sha2(F.least(F.upper(seq), sq.reverse_complement(seq)), 256)


def strand_groups(records: DataFrame) -> DataFrame:
    """Provenance rows (marker, key, source_id): one per input, however often a sequence occurs."""
    return records.select("marker", canonical_key(F.col("seq")).alias("key"), "source_id")


def unique_sequences(records: DataFrame) -> DataFrame:
    """One row per strand-independent sequence with its first source and the number of sources.

    Only hashes are grouped; the sequence of the first source is fetched by a join, so copies of one
    sequence never travel or gather together.
    """
    keys = strand_groups(records)
    groups = keys.groupBy("marker", "key").agg(F.min("source_id").alias("source_id"), F.count("*").alias("sources"))
    return groups.join(records.select("marker", "source_id", F.upper("seq").alias("seq")), ["marker", "source_id"])


def first_by_content(files: DataFrame, keys: list[str]) -> DataFrame:
    """First file (by ordinal) per content hash and key."""
    others = [c for c in files.columns if c not in (*keys, "sha256")]
    return files.groupBy(*keys, "sha256").agg(F.min_by(F.struct(*others), "ord").alias("_r"), F.count("*").alias("copies")).select(*keys, "sha256", "_r.*", "copies")


def copied_files(files: DataFrame) -> DataFrame:
    """Content present under more than one name in a run: copies are not independent lanes."""
    return files.groupBy("run", "sha256").agg(F.countDistinct("path").alias("names"), F.min("path").alias("first_path")).where(F.col("names") > 1)


def distinct_producers(candidates: DataFrame) -> DataFrame:
    """Whether at least two different producers delivered a candidate."""
    counts = candidates.groupBy("case_id").agg(F.countDistinct("producer").alias("producers"))
    return counts.withColumn("comparison_complete", F.col("producers") >= 2)


def position_runs(points: DataFrame, keys: list[str], at: str, width: int = 10_000) -> DataFrame:
    """Maximal runs of consecutive positions held as rows."""
    from helixframe.operators.intervals import islands

    return islands(points.select(*keys, F.col(at).alias("start"), (F.col(at) + 1).alias("end")), keys, width)
