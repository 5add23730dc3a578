"""Annotation checks over features (record_id, feature_id, type, gene, product, strand, segments, partial5, partial3, qualifiers).

Segments are half-open and in transcription order.  Findings are rows (record_id, feature_id, level, code, detail) with
level ERROR, REVIEW or INFO; something that cannot be read is at least a REVIEW, never accepted silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.functions import names as nm, seq as sq
from helixframe.functions.rules import flags
from helixframe.functions.text import strip
from helixframe.operators.tiles import slices
from helixframe.session import cut_lineage

BIN = 1000
FINDING = ["record_id", "feature_id", "level", "code", "detail"]


def named(features: DataFrame) -> DataFrame:
    """Add display name, canonical name and tRNA identity."""
    label = F.coalesce(F.col("gene"), F.col("product"), F.lit("?"))
    first = lambda k: F.try_element_at(F.try_element_at("qualifiers", F.lit(k)), F.lit(1))
    out = features.withColumn("display", label).withColumn("_key", nm.gene_key(F.col("display"))).withColumn("name", nm.canonical_key(F.col("_key")))
    out = out.withColumn("_ac", nm.anticodon(first("anticodon"), first("note")))
    return out.withColumn("identity", nm.trna_identity(F.col("name"), F.col("_ac"))).drop("_key", "_ac")


def finding(df: DataFrame, level, code, detail: Column) -> DataFrame:
    col = lambda v: v if isinstance(v, Column) else F.lit(v)
    fid = F.col("feature_id") if "feature_id" in df.columns else F.lit(None).cast("string")
    return df.select("record_id", fid.cast("string").alias("feature_id"), col(level).alias("level"), col(code).alias("code"), detail.alias("detail"))


def row_findings(df: DataFrame, *rules: tuple) -> DataFrame:
    """Findings of independent rules (condition, level, code, detail) in one pass over the rows."""
    col = lambda v: v if isinstance(v, Column) else F.lit(v)
    found = F.array(*[F.when(c, F.struct(col(level).alias("level"), F.lit(code).alias("code"), d.alias("detail"))) for c, level, code, d in rules])
    rows = df.select("record_id", F.col("feature_id").cast("string").alias("feature_id"), F.explode(F.array_compact(found)).alias("f"))
    return rows.select("record_id", "feature_id", "f.level", "f.code", "f.detail")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- gene set, strands, lengths --------------------------------------------------------------------


def gene_set_findings(features: DataFrame, level: str = "ERROR") -> DataFrame:
    """Missing, unexpected and repeated genes per record and kind.

    An undetermined rRNA, or a bare tRNA-Leu/Ser, suppresses 'missing' for the identities it could be.
    `features` carries name and identity (see `named`).
    """
    resolved = F.when(F.col("type") == "tRNA", F.col("identity")).otherwise(F.col("name"))
    rows = features.where(F.col("type").isin("CDS", "tRNA", "rRNA")).select("record_id", F.col("type").alias("kind"), "name", resolved.alias("gene"))
    # Every rule below needs only these counts, so the features are read and named once.
    tally = cut_lineage(rows.groupBy("record_id", "kind", "name", "gene").agg(F.count("*").alias("n")))
    counts = tally.where(F.col("gene").isNotNull()).groupBy("record_id", "kind", "gene").agg(F.sum("n").alias("n"))
    expected = [(k, g) for k, genes in (("CDS", nm.EXPECTED_CDS), ("tRNA", nm.EXPECTED_TRNA), ("rRNA", nm.EXPECTED_RRNA)) for g in genes]
    bare = tally.where((F.col("kind") == "tRNA") & F.col("gene").isNull() & F.col("name").isin(*nm.AMBIGUOUS_TRNA)).select("record_id", "name", "n")
    loose = counts.where((F.col("kind") == "rRNA") & (F.col("gene") == "rrna"))
    # What a record has of the expected genes, and could have, is at most as long as their list: no record meets the list by a join.
    places = F.array(*[F.lit(f"{k}:{g}") for k, g in expected])
    own = F.concat_ws(":", "kind", "gene")
    could = F.when((F.col("kind") == "tRNA") & F.col("gene").isNull(), F.coalesce(*[F.when(F.col("name") == k, F.array(*[F.lit(f"tRNA:{g}") for g in v])) for k, v in nm.AMBIGUOUS_TRNA.items()]))
    could = could.when((F.col("kind") == "rRNA") & (F.col("gene") == "rrna"), F.array(*[F.lit(f"rRNA:{g}") for g in nm.EXPECTED_RRNA]))
    held = F.when(F.col("gene").isNotNull() & F.array_contains(places, own), F.array(own)).otherwise(could)
    sets = tally.groupBy("record_id").agg(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("record_id").isNotNull(), held)))).alias("_held"))
    missing = sets.select("record_id", F.explode(F.array_except(places, F.col("_held"))).alias("_place"))
    missing = missing.select("record_id", F.substring_index("_place", ":", 1).alias("kind"), F.substring_index("_place", ":", -1).alias("gene"))
    is_expected = reduce(lambda a, b: a | b, [(F.col("kind") == k) & F.col("gene").isin(*g) for k, g in (("CDS", nm.EXPECTED_CDS), ("tRNA", nm.EXPECTED_TRNA), ("rRNA", nm.EXPECTED_RRNA))])
    extra = counts.where(~is_expected & ~((F.col("kind") == "rRNA") & (F.col("gene") == "rrna")))
    repeated = counts.where(F.col("n") > 1)
    place = F.concat_ws(":", "kind", "gene")
    return union([
        finding(missing, level, "MISSING_GENE", place), finding(extra, level, "UNEXPECTED_GENE", place), finding(repeated, level, "DUPLICATE_GENE", place),
        finding(bare, "REVIEW", "UNDETERMINED_TRNA", F.col("name")), finding(loose, "REVIEW", "UNDETERMINED_RRNA", F.col("gene")),
    ])


def strand_findings(features: DataFrame, expected_plus: int = 9) -> DataFrame:
    """Plus-strand CDS count; the mirrored count means the whole record is shown reversed."""
    tally = features.where(F.col("type") == "CDS").groupBy("record_id").agg(F.count_if(F.col("strand") > 0).alias("plus"), F.count("*").alias("_n"))
    tally = tally.withColumn("minus", F.col("_n") - F.col("plus")).where(F.col("plus") != expected_plus)
    mirrored = F.col("minus") == expected_plus
    return finding(tally, F.when(mirrored, "INFO").otherwise("REVIEW"), F.when(mirrored, "ORIENTATION").otherwise("STRAND_COUNT"), F.concat_ws("/", F.col("plus").cast("string"), F.col("minus").cast("string")))


# Length bands.
TRNA_BAND, TRNA_MINIMUM = (60, 75), 50
RRNA_BANDS = {"rrnl": (1100, 1500), "rrns": (600, 850)}


def rna_length_findings(features: DataFrame) -> DataFrame:
    """tRNA and rRNA lengths against their bands; lengths never decide an identity."""
    rows = features.where(F.col("type").isin("tRNA", "rRNA")).withColumn("_len", sq.feature_length(F.col("segments")))
    detail = F.concat_ws(":", "name", F.col("_len").cast("string"))
    trna, rrna, length, name = F.col("type") == "tRNA", F.col("type") == "rRNA", F.col("_len"), F.col("name")
    noted = F.map_contains_key("qualifiers", "note")
    banded = name.isin(*RRNA_BANDS)
    inside = reduce(lambda a, b: a | b, [(name == k) & length.between(*v) for k, v in RRNA_BANDS.items()])
    return row_findings(
        rows,
        (trna & (length < TRNA_MINIMUM), F.when(noted, "REVIEW").otherwise("ERROR"), "TRNA_TOO_SHORT", detail),
        (trna & (length >= TRNA_MINIMUM) & ~length.between(*TRNA_BAND), "REVIEW", "TRNA_LENGTH", detail),
        (trna & ~F.map_contains_key("qualifiers", "anticodon"), "REVIEW", "TRNA_NO_ANTICODON", name),
        (trna & F.col("identity").isNull(), "REVIEW", "UNDETERMINED_TRNA", name),
        (rrna & banded & ~inside, "REVIEW", "RRNA_LENGTH", detail),
        (rrna & ~banded, "INFO", "UNDETERMINED_RRNA", name),
    )


# -- overlaps --------------------------------------------------------------------------------------


def overlapping_pairs(features: DataFrame) -> DataFrame:
    """Feature pairs of a record sharing bases, each once, with the shared length over compound locations.

    Segments are cut into bins and joined by (record, bin); the shared length is summed over the bins, so a
    pair needs no de-duplication.
    """
    pieces = features.select("record_id", "feature_id", "name", "type", F.explode("segments").alias("s")).select(
        "record_id", "feature_id", "name", "type", "s.start", "s.end",
        F.explode(F.sequence(F.floor(F.col("s.start") / BIN), F.floor((F.col("s.end") - 1) / BIN))).alias("bin"),
    )
    clip = pieces.select(
        "record_id", "bin", "feature_id", "name", "type", F.greatest(F.col("start"), F.col("bin") * BIN).alias("lo"), F.least(F.col("end"), (F.col("bin") + 1) * BIN).alias("hi")
    )
    left = clip.select("record_id", "bin", *[F.col(c).alias(f"{c}_a") for c in ("feature_id", "name", "type", "lo", "hi")])
    right = clip.select("record_id", "bin", *[F.col(c).alias(f"{c}_b") for c in ("feature_id", "name", "type", "lo", "hi")])
    shared = F.least("hi_a", "hi_b") - F.greatest("lo_a", "lo_b")
    pairs = left.join(right, ["record_id", "bin"]).where((F.col("feature_id_a") < F.col("feature_id_b")) & (shared > 0))
    keys = ["record_id", "feature_id_a", "feature_id_b", "name_a", "name_b", "type_a", "type_b"]
    return pairs.groupBy(*keys).agg(F.sum(shared).alias("overlap"))


def overlap_findings(pairs: DataFrame, tolerated: DataFrame | None = None, threshold: int = 8, severity: str = "REVIEW") -> DataFrame:
    """Short overlaps are recorded; long ones need review unless the pair of names is on the tolerated list."""
    low, high = F.least("name_a", "name_b"), F.greatest("name_a", "name_b")
    named_ = pairs.withColumn("low", low).withColumn("high", high)
    if tolerated is not None:
        listed = tolerated.select(F.least("first", "second").alias("low"), F.greatest("first", "second").alias("high")).distinct()
        named_ = named_.join(listed.withColumn("_ok", F.lit(True)), ["low", "high"], "left")
    else:
        named_ = named_.withColumn("_ok", F.lit(None).cast("boolean"))
    ok, long_ = F.coalesce("_ok", F.lit(False)), F.col("overlap") > threshold
    code = F.when(~long_, "OVERLAP_SHORT").when(ok, "OVERLAP_ACCEPTED").otherwise("OVERLAP_LONG")
    level = F.when(~long_, "INFO").when(ok, "REVIEW").otherwise(severity)
    detail = F.concat_ws("|", F.col("feature_id_a").cast("string"), F.col("feature_id_b").cast("string"), F.col("overlap").cast("string"))
    return named_.select("record_id", F.col("feature_id_a").cast("string").alias("feature_id"), level.alias("level"), code.alias("code"), detail.alias("detail"))


def unused_tolerances(pairs: DataFrame, tolerated: DataFrame, threshold: int = 8) -> DataFrame:
    """Tolerated name pairs that no long overlap needed."""
    used = pairs.where(F.col("overlap") > threshold).select(F.least("name_a", "name_b").alias("low"), F.greatest("name_a", "name_b").alias("high"))
    listed = tolerated.select(F.least("first", "second").alias("low"), F.greatest("first", "second").alias("high")).distinct()
    return listed.join(used, ["low", "high"], "left_anti")


# -- reference comparison --------------------------------------------------------------------------


def reference_lengths(features: DataFrame, reference: DataFrame, tolerance: float = 20) -> DataFrame:
    """CDS length against the first reference CDS of the same name, difference in percent."""
    length = sq.feature_length(F.col("segments"))
    ref = reference.where(F.col("type") == "CDS").groupBy("name").agg(F.min_by(length, F.struct(F.col("segments")[0]["start"], F.col("feature_id"))).alias("ref_length"))
    joined = features.where(F.col("type") == "CDS").select("record_id", "feature_id", "name", length.alias("length")).join(ref, "name", "left")
    delta = F.when(F.col("ref_length") > 0, F.abs(F.col("length") - F.col("ref_length")) / F.col("ref_length") * 100).otherwise(F.when(F.col("ref_length").isNotNull(), 0.0))
    return joined.withColumn("delta_pct", delta).withColumn("outside", F.col("delta_pct") > tolerance)


def set_differences(query: DataFrame, reference: DataFrame) -> DataFrame:
    """Names on one side only per record; the gene set of one reference (a few dozen names) applies to every record."""
    mine = query.select("record_id", "name").distinct()
    theirs = reference.select("name").distinct()
    listed = theirs.agg(F.collect_set("name").alias("_names"))
    wanted = mine.select("record_id").distinct().join(listed).select("record_id", F.explode("_names").alias("name"))
    missing = wanted.join(mine, ["record_id", "name"], "left_anti").withColumn("side", F.lit("missing"))
    extra = mine.join(theirs, "name", "left_anti").withColumn("side", F.lit("extra"))
    return missing.unionByName(extra)


# -- coding sequences ------------------------------------------------------------------------------


def spliced(features: DataFrame, records: DataFrame) -> DataFrame:
    """features of known records with `spliced`, the letters of their segments in transcription orientation.

    Segments meet the tiles they touch (see `tiles.slices`), so no genome travels with its features.  A repeated feature id
    is no matter: what is joined back is told by record, segments and strand.  Features are laid down once, as three steps read them.
    """
    known = cut_lineage(features.join(records.select("record_id").distinct(), "record_id", "left_semi"))
    shape = known.select("record_id", "segments", "strand").distinct()
    parts = shape.select("record_id", "segments", "strand", F.posexplode("segments").alias("_i", "_s")).withColumns({"start": F.col("_s.start"), "end": F.col("_s.end")})
    parts = parts.join(slices(parts, records, ["record_id"], "sequence"), ["record_id", "start", "end"], "left")
    letters = F.coalesce("slice", F.lit(""))
    letters = F.when(F.col("strand") < 0, sq.reverse_complement(letters)).otherwise(letters)
    whole = parts.groupBy("record_id", "segments", "strand").agg(F.array_sort(F.collect_list(F.struct("_i", letters.alias("t")))).alias("_t"))
    whole = whole.select(F.col("record_id").alias("_r"), F.col("segments").alias("_g"), F.col("strand").alias("_d"), F.array_join(F.transform("_t", lambda x: x["t"]), "").alias("_x"))
    joined = known.join(whole, (F.col("record_id") == F.col("_r")) & (F.col("segments") == F.col("_g")) & F.col("strand").eqNullSafe(F.col("_d")), "left")
    return joined.withColumn("spliced", F.coalesce("_x", F.lit(""))).drop("_r", "_g", "_d", "_x")


def coding_features(features: DataFrame, records: DataFrame, table: int) -> DataFrame:
    """CDS with their spliced sequence, frame, protein, terminal state and codon positions."""
    first = lambda k: F.try_element_at(F.try_element_at("qualifiers", F.lit(k)), F.lit(1))
    cds = spliced(features.where(F.col("type") == "CDS"), records)
    declared = F.expr("try_cast(try_element_at(try_element_at(qualifiers, 'codon_start'), 1) AS INT)")
    cds = cds.withColumn("codon_start_given", F.coalesce(declared, F.lit(1)))
    cds = cds.withColumn("codon_start", F.when(F.col("codon_start_given").isin(1, 2, 3), F.col("codon_start_given")).otherwise(1))
    cds = cds.withColumn("coding", F.expr("substr(spliced, codon_start)"))
    cds = cds.withColumn("remainder", F.length("coding") % 3).withColumn("codons", sq.codon_list(F.col("coding")))
    cds = cds.withColumn("protein", sq.translate(F.col("coding"), table)).withColumn("last3", F.right("coding", F.lit(3)))
    cds = cds.withColumn("tail", F.when(F.col("remainder") > 0, F.expr("right(coding, remainder)")).otherwise(""))
    complete = (F.col("remainder") == 0) & F.col("last3").isin(*sq.stop_codons(table))
    terminal = F.when(complete, "complete").when(F.col("tail").isin(*sq.stop_prefixes(table)), "incomplete").otherwise("nonstop")
    stops = F.filter(F.transform(F.split("protein", ""), lambda aa, i: F.when(aa == "*", i + 1)), lambda i: i.isNotNull())
    cds = cds.withColumn("terminal", terminal)
    last = F.length("protein")
    cds = cds.withColumn("stops", F.when(F.col("terminal") == "complete", F.filter(stops, lambda i: i < last)).otherwise(stops))
    positions = sq.coding_positions(F.col("segments"), F.col("strand"), F.col("codon_start"))
    cds = cds.withColumn("positions", positions).withColumn("note", F.coalesce(F.array_join(F.try_element_at("qualifiers", F.lit("note")), " ; "), F.lit("")))
    return cds.withColumn("declared_table", first("transl_table"))


COMPLETION_NOTE = r"(?i)stop codon.*completed.*addition.*3['’]?\s*A.*mRNA"


def judged_entries(table: int) -> Column:
    """Array of the declared translation exceptions with what they match, or why they match nothing.

    Codons are found by their place in the segments; no position is listed for every base.
    """
    values = F.coalesce(F.try_element_at("qualifiers", F.lit("transl_except")), F.array().cast("array<string>"))
    entries = F.flatten(F.transform(values, nm.parse_exceptions))
    segments, strand, skipped = F.col("segments"), F.col("strand"), (F.col("codon_start") - 1).cast("long")
    places = lambda first, n: F.array_sort(F.array(*[sq.place_of(segments, strand, first + i) for i in range(n)]))
    total = F.aggregate(segments, F.lit(0).cast("long"), lambda n, s: n + sq.segment_size(s))
    remainder, codons = F.col("remainder").cast("long"), F.floor(F.length("coding") / 3)
    tail_places = F.when(total - skipped >= remainder, F.when(remainder == 1, places(total - 1, 1)).when(remainder == 2, places(total - 2, 2)))
    minus = strand < 0

    def matched(e):
        numbers = F.transform(sq.letters_at(segments, strand, F.try_element_at(e["positions"], F.lit(1))), lambda n: F.floor((n - skipped) / 3))
        index = F.array_min(F.filter(numbers, lambda i: (i >= 0) & (i < codons) & (places(skipped + i * 3, 3) == e["positions"])))
        completes = (
            (e["token"] == "term") & ~e["mixed"] & (e["complement"] == minus) & (remainder > 0)
            & F.col("tail").isin(*sq.stop_prefixes(table)) & (F.coalesce(tail_places, F.array().cast("array<bigint>")) == e["positions"]) & F.col("note").rlike(COMPLETION_NOTE)
        )
        return F.struct(*[e[c].alias(c) for c in ("text", "positions", "token", "complement", "mixed")], (index + 1).cast("int").alias("codon_index"), F.coalesce(completes, F.lit(False)).alias("completes_stop"))

    def judged(e):
        problem = (
            F.when(e["completes_stop"], F.lit(None)).when(~e["token"].isin(*nm.EXCEPT_TOKENS), "bad_token").when(e["token"] == "term", "termination_token")
            .when(e["mixed"], "mixed_strands").when(e["complement"] != minus, "wrong_strand").when(F.size(e["positions"]) != 3, "not_one_codon")
            .when(e["codon_index"].isNull(), "no_such_codon").when(~F.array_contains("stops", e["codon_index"]), "not_a_stop")
        )
        codon = F.when(e["codon_index"].isNotNull(), F.col("coding").substr((e["codon_index"] - 1) * 3 + 1, F.lit(3)))
        return F.struct(*[e[c].alias(c) for c in ("text", "positions", "token", "codon_index")], codon.alias("codon"), e["completes_stop"].alias("completes_stop"), problem.alias("problem"))

    plain = F.transform(entries, lambda e: F.struct(e["text"].alias("text"), F.array_sort(e["positions"]).cast("array<bigint>").alias("positions"), F.lower(e["amino_acid"]).alias("token"), e["complement"].alias("complement"), e["mixed"].alias("mixed")))
    return F.transform(F.transform(plain, matched), judged)


def judge_exceptions(entries: DataFrame, registry: DataFrame, table: int, taxon: str | None) -> DataFrame:
    """Accept a matched exception only with a registered record for this gene, codon, residue, site, table and taxon.

    `registry(gene, codon, amino_acid, codon_index, positions, gene_wide, transl_table, taxon, source, rationale)`.
    """
    matched = entries.where(F.col("problem").isNull() & ~F.col("completes_stop"))
    names = ("gene", "codon", "amino_acid", "codon_index", "positions", "gene_wide", "transl_table", "taxon", "source", "rationale")
    reg = registry.select(*[F.col(c).alias(f"r_{c}") for c in names])
    joined = matched.join(reg, (F.col("name") == F.col("r_gene")) & (F.col("codon") == F.col("r_codon")) & (F.col("token") == F.lower("r_amino_acid")) & (F.col("name") != ""), "left")
    blank = lambda c: strip(F.coalesce(F.col(c), F.lit(""))) == ""
    wide = F.coalesce("r_gene_wide", F.lit(False))
    site = wide | F.coalesce(F.col("r_codon_index") == F.col("codon_index"), F.lit(False)) | F.coalesce(F.array_sort("r_positions") == F.col("positions"), F.lit(False))
    reasons = flags(
        (F.col("r_gene").isNull(), "not_registered"), (F.lit(not taxon), "no_sample_taxon"), (~site, "site"),
        (blank("r_taxon") | blank("r_source") | blank("r_rationale") | F.col("r_transl_table").isNull(), "incomplete"),
        (F.col("r_transl_table") != table, "transl_table"), (F.lower(strip("r_taxon")) != F.lit((taxon or "").strip().lower()), "taxon"),
    )
    judged = joined.withColumn("_why", reasons)
    return judged.groupBy("record_id", "feature_id", "name", "text", "codon_index", "codon", "token").agg(
        F.bool_or(F.size("_why") == 0).alias("accepted"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_why")))).alias("reasons")
    )


def cds_findings(cds: DataFrame, table: int, registry: DataFrame | None = None, start_exceptions: DataFrame | None = None, taxon: str | None = None) -> DataFrame:
    """All findings about coding sequences: frame, table, start, stop, internal stops and declared exceptions.

    `start_exceptions(name, codon, registered)` lists starts accepted on request.
    """
    none = F.array().cast("array<string>")
    uncertain = F.exists(F.coalesce(F.try_element_at("qualifiers", F.lit("note")), none), lambda n: n.startswith("codon_start uncertain:"))
    values = F.coalesce(F.try_element_at("qualifiers", F.lit("transl_except")), none)
    cds = cds.withColumn("uncertain", uncertain).withColumn("start_codon", F.left("coding", F.lit(3)))
    cds = cds.withColumn("unread", F.size(F.filter(values, lambda v: ~nm.exceptions_readable(v))))
    # Of codons with other letters only the numbers are kept; what the findings tell of bases is worked out from the segments.
    cds = cds.withColumn("vague", F.transform(sq.ambiguous_codons(F.col("coding")), lambda c: c["codon"])).withColumn("entries", judged_entries(table))
    if start_exceptions is not None:
        listed = start_exceptions.select("name", F.col("codon").alias("start_codon"), "registered")
        cds = cds.join(listed, ["name", "start_codon"], "left")
    else:
        cds = cds.withColumn("registered", F.lit(None).cast("boolean"))
    # Several branches follow: splice and translate once, and lay down nothing that has a value for every base.
    cds = cut_lineage(cds.drop("spliced", "coding", "codons", "protein", "positions", "qualifiers", "note", "gene", "product"))
    parts = [finding(cds.where("uncertain"), "REVIEW", "CODON_START_UNCERTAIN", F.col("name"))]
    cds = cds.where(~F.col("uncertain"))
    p5, p3 = F.coalesce("partial5", F.lit(False)), F.coalesce("partial3", F.lit(False))
    given = strip(F.coalesce("declared_table", F.lit("")))
    odd_start = ~p5 & ~F.col("start_codon").isin(*sq.START_CODONS[table])
    begin = F.col("start_codon")
    parts.append(row_findings(
        cds,
        ((given != "") & (given != str(table)), "REVIEW", "TABLE_CONFLICT", given),
        (~F.col("codon_start_given").isin(1, 2, 3), "ERROR", "INVALID_CDS", F.concat(F.lit("codon_start="), F.col("codon_start_given").cast("string"))),
        ((F.col("codon_start") != 1) & ~p5, "REVIEW", "CODON_START_CONFLICT", F.col("codon_start").cast("string")),
        (F.col("unread") > 0, "REVIEW", "TRANSL_EXCEPT_UNPARSED", F.col("unread").cast("string")),
        (odd_start & F.col("registered").isNull(), "ERROR", "INVALID_CDS", F.concat(F.lit("start="), begin)),
        (odd_start & F.col("registered").isNotNull(), "REVIEW", "NONCANONICAL_START_REVIEW", begin),
        (odd_start & ~F.col("registered"), "REVIEW", "EXCEPTION_NOT_REGISTERED", begin),
        (p5, "INFO", "PARTIAL_CDS_5P", F.col("name")),
        (p3, "INFO", "PARTIAL_CDS_3P", F.col("name")),
        (~p3 & (F.col("terminal") == "incomplete"), "REVIEW", "INCOMPLETE_STOP", F.col("tail")),
        (~p3 & (F.col("terminal") == "nonstop"), "ERROR", "INVALID_CDS", F.concat(F.lit("end="), F.col("last3"))),
    ))
    first = (F.col("_c") - 1) * 3 + F.col("codon_start") - 1
    places = F.array(*[sq.place_of(F.col("segments"), F.col("strand"), (first + i).cast("long")) for i in range(3)])
    vague = cds.select("record_id", "feature_id", "segments", "strand", "codon_start", F.explode("vague").alias("_c"))
    parts.append(finding(vague, "REVIEW", "AMBIGUOUS_CODON", F.concat_ws(":", F.col("_c").cast("string"), F.array_join(places.cast("array<string>"), ","))))

    entries = cds.select("record_id", "feature_id", "name", F.explode("entries").alias("_e")).select("record_id", "feature_id", "name", "_e.*")
    done, bad = F.col("completes_stop"), F.col("problem").isNotNull()
    matched = ~bad & ~done
    rules = [
        (done, "INFO", "PARTIAL_STOP_COMPLETION_VALIDATED", F.col("text")),
        (bad, "REVIEW", "TRANSL_EXCEPT_UNEXPLAINED", F.concat_ws(":", "text", "problem")),
        (matched, "INFO", "TRANSL_EXCEPT_MATCHED", F.concat_ws(":", "text", "codon")),
    ]
    if registry is None:
        rules.append((matched, "REVIEW", "TRANSL_EXCEPT_DECLARED_UNVERIFIED", F.concat_ws(":", F.col("text"), F.lit("not_registered"))))
    parts.append(row_findings(entries, *rules))
    idle = entries.groupBy("record_id", "feature_id").agg(F.bool_or("completes_stop").alias("_done"))
    no_stop = cds.where(F.size("stops") == 0).join(idle.where(~F.col("_done")), ["record_id", "feature_id"], "left_semi")
    parts.append(finding(no_stop, "REVIEW", "TRANSL_EXCEPT_UNEXPLAINED", F.lit("no_internal_stop")))
    unexplained = cds.select("record_id", "feature_id", F.explode("stops").alias("codon_index"))
    if registry is not None:
        judged = judge_exceptions(entries, registry, table, taxon)
        yes = F.col("accepted")
        parts.append(row_findings(
            judged,
            (yes, "INFO", "TRANSL_EXCEPT_VALIDATED", F.concat_ws(":", "text", "codon", "token")),
            (~yes, "REVIEW", "TRANSL_EXCEPT_DECLARED_UNVERIFIED", F.concat_ws(":", F.col("text"), F.array_join("reasons", ","))),
        ))
        unexplained = unexplained.join(judged.where("accepted"), ["record_id", "feature_id", "codon_index"], "left_anti")
    left = unexplained.groupBy("record_id", "feature_id").agg(F.count("*").alias("_n"))
    parts.append(finding(left, "ERROR", "INTERNAL_STOP", F.col("_n").cast("string")))
    return union(parts)


def registry_findings(records: DataFrame) -> DataFrame:
    """Exception records that must not be used: bad selectors, missing site binding, repeated identity.

    `records(ord, gene, codon, amino_acid, codon_index, pos, scope, transl_table, taxon)`; a record with
    `amino_acid` is about a stop, any other one about a start.
    """
    r = records.withColumn("_gene", nm.canonical_gene(F.col("gene"))).withColumn("_codon", nm.codon(F.col("codon")))
    about_stop = F.col("amino_acid").isNotNull()
    sites = F.col("codon_index").isNotNull().cast("int") + F.col("pos").isNotNull().cast("int") + F.col("scope").isNotNull().cast("int")
    identity = F.when(about_stop, F.concat_ws("|", F.lit("stop"), "_gene", "_codon", F.lower("amino_acid"), F.col("codon_index").cast("string"), "pos", "scope", F.lower(strip("taxon")), F.col("transl_table").cast("string")))
    r = r.withColumn("_key", F.coalesce(identity, F.concat_ws("|", F.lit("start"), "_gene", "_codon")))
    repeats = r.groupBy("_key").agg(F.count("*").alias("_n"))
    place = F.concat(F.lit("(pos:"), F.col("pos"), F.lit(",aa:Met)"))
    found = flags(
        (F.col("_gene") == "", "gene"), (F.col("_codon").isNull(), "codon"), (about_stop & ~F.lower(strip("amino_acid")).isin(*nm.EXCEPT_TOKENS), "amino_acid"),
        (about_stop & (sites != 1), "site_binding"), (F.col("scope").isNotNull() & (strip("scope") != "gene_wide"), "scope"),
        (F.col("pos").isNotNull() & ~nm.exceptions_readable(place), "pos"), (F.col("codon_index") < 1, "codon_index"), (F.col("transl_table") < 1, "transl_table"),
        (F.col("_n") > 1, "duplicate"),
    )
    return r.join(repeats, "_key").select("ord", found.alias("findings")).where(F.size("findings") > 0)


# -- annotator output ------------------------------------------------------------------------------


def annotator_features(rows: DataFrame) -> DataFrame:
    """Annotator rows with their kind; a gene row gives way to a CDS row of the same name and place.

    Rows that cannot be used keep a reason instead of being dropped.
    """
    low = F.lower(F.coalesce("name", F.lit("")))
    gene_like = F.col("type").isin("gene", "CDS")
    known = F.col("type").isin("region", "gene", "exon", "ncRNA_gene", "tRNA", "rRNA", "CDS", "origin_of_replication", "rep_origin", "D-loop")
    coding = gene_like & low.rlike(nm.CDS_NAME)
    key = ["record_id", "name", "start", "end", "strand"]
    per_key = rows.groupBy(*key).agg(F.bool_or(F.col("type") == "CDS").alias("_has_cds"))
    kind = F.when(coding, "CDS").when(F.col("type").isin("tRNA", "rRNA"), F.col("type"))
    joined = rows.join(per_key, key).where(~((F.col("type") == "gene") & F.col("_has_cds"))).withColumn("kind", kind)
    repeats = joined.where(F.col("kind").isNotNull()).groupBy(*key, "kind").agg(F.count("*").alias("_n"))
    joined = joined.join(repeats, [*key, "kind"], "left")
    problem = F.when(~known | (gene_like & ~coding & (low != "") & ~low.startswith("oh")), "unknown_type").when(F.col("_n") > 1, "duplicate_feature")
    return joined.withColumn("problem", problem).where(F.col("kind").isNotNull() | F.col("problem").isNotNull()).drop("_has_cds", "_n")


def protein_frames(features: DataFrame, table: int) -> DataFrame:
    """Reading frame per (record_id, name, nt, protein): only a unique full match of the protein counts."""
    wanted = F.regexp_replace(F.upper("protein"), r"\*$", "")
    usable = wanted.rlike("^[ACDEFGHIKLMNPQRSTVWY]+$")
    frames = features.withColumn("_want", wanted).where(usable).withColumn("offset", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    frames = frames.withColumn("_nt", F.expr("substr(nt, offset + 1)")).withColumn("_aa", F.regexp_replace(sq.translate(F.col("_nt"), table), r"\*$", ""))
    begins = F.upper(F.left("_nt", F.lit(3))).isin(*sq.START_CODONS[table]) & (F.col("_aa") != "")
    hit = (F.col("_aa") == F.col("_want")) | (begins & (F.concat(F.lit("M"), F.expr("substr(_aa, 2)")) == F.col("_want")))
    found = frames.where(hit).groupBy("record_id", "name").agg(F.count("*").alias("_n"), F.min("offset").alias("_o"))
    return features.select("record_id", "name").distinct().join(found, ["record_id", "name"], "left").select("record_id", "name", F.when(F.col("_n") == 1, F.col("_o")).alias("offset"))


def frame_conflict(phase: Column, offset: Column, has_protein: Column) -> Column:
    """State of the reading frame from the declared phase and the frame found by protein."""
    declared = F.coalesce(phase, F.lit(".")) != "."
    bad = declared & ~phase.isin("0", "1", "2")
    conflict = declared & has_protein & (offset.isNull() | (offset.cast("string") != phase))
    return F.when(bad, "invalid_phase").when(conflict, "phase_protein_conflict").when(declared, "phase").when(offset.isNotNull(), "protein").otherwise("uncertain")


def agreement(gff: DataFrame, nucleotide: DataFrame, protein: DataFrame, genomes: DataFrame) -> DataFrame:
    """Annotator rows against their sequence files and the genome slice; every disagreement is named.

    `gff(record_id, name, start, end, strand)` with 1-based closed coordinates; the others carry the same place.  Features meet the
    tiles of the genome that they touch.
    """
    n = nucleotide.select("record_id", "name", F.col("start").alias("_ns"), F.col("end").alias("_ne"), F.col("strand").alias("_nd"), F.col("seq").alias("_nseq"))
    p = protein.select("record_id", "name", F.col("start").alias("_ps"), F.col("end").alias("_pe"), F.col("strand").alias("_pd"))
    joined = gff.join(n, ["record_id", "name"], "left").join(p, ["record_id", "name"], "left").join(genomes.select("record_id", F.coalesce(F.length("seq"), F.lit(0)).alias("_g")), "record_id", "left")
    cut = slices(gff.select("record_id", (F.col("start") - 1).cast("long").alias("start"), F.col("end").cast("long").alias("end")), genomes, ["record_id"])
    cut = cut.select("record_id", (F.col("start") + 1).alias("_from"), F.col("end").alias("_to"), "slice")
    joined = joined.join(cut.withColumnRenamed("record_id", "_r"), (F.col("record_id") == F.col("_r")) & (F.col("start") == F.col("_from")) & (F.col("end") == F.col("_to")), "left")
    piece = F.when(F.col("_g").isNotNull(), F.coalesce("slice", F.lit("")))
    joined = joined.withColumn("_slice", F.when(F.col("strand") == "-", sq.reverse_complement(piece)).otherwise(piece))
    plain = lambda c: F.translate(F.upper(c), "U", "T")
    problems = flags(
        (F.col("_g").isNull(), "foreign_record"), (F.col("_g").isNotNull() & ((F.col("start") < 1) | (F.col("end") < F.col("start")) | (F.col("end") > F.col("_g"))), "outside_genome"),
        (~F.col("strand").isin("+", "-"), "bad_strand"), (F.col("_ns").isNotNull() & ((F.col("_ns") != F.col("start")) | (F.col("_ne") != F.col("end")) | (F.col("_nd") != F.col("strand"))), "place_conflict"),
        (F.col("_nseq") == "", "empty_sequence"), ((F.col("_nseq") != "") & (plain(F.col("_nseq")) != plain(F.col("_slice"))), "sequence_conflict"),
        (F.col("_ps").isNotNull() & ((F.col("_ps") != F.col("start")) | (F.col("_pe") != F.col("end")) | (F.col("_pd") != F.col("strand"))), "protein_place_conflict"),
    )
    return joined.select("record_id", "name", F.col("_ns").isNull().alias("from_genome_only"), problems.alias("problems"))


def matching_records(annotation: DataFrame, genomes: DataFrame) -> DataFrame:
    """Annotation records against genome records by identifier and sequence; anything unequal refuses the set."""
    a = annotation.select("set_id", "record_id", F.upper("sequence").alias("_a"))
    g = genomes.select("set_id", "record_id", F.upper("sequence").alias("_g"))
    joined = a.join(g, ["set_id", "record_id"], "full_outer")
    state = F.when(F.col("_a").isNull(), "not_annotated").when(F.col("_g").isNull(), "unknown_record").when(F.col("_a") != F.col("_g"), "sequence_differs").otherwise("ok")
    return joined.select("set_id", "record_id", state.alias("state"))


# -- roll-up ---------------------------------------------------------------------------------------


def roll_up(findings: DataFrame, records: DataFrame) -> DataFrame:
    """Counts by level and exit status per record: 1 with errors, 2 with reviews only, 0 without either."""
    counts = findings.groupBy("record_id").agg(*[F.count_if(F.col("level") == level).alias(level.lower()) for level in ("ERROR", "REVIEW", "INFO")])
    out = records.select("record_id").distinct().join(counts, "record_id", "left")
    out = out.select("record_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("error", "review", "info")])
    return out.withColumn("status", F.when(F.col("error") > 0, 1).when(F.col("review") > 0, 2).otherwise(0))


def annotate_ok(candidates: DataFrame, runs: DataFrame, split_records: bool = False) -> DataFrame:
    """Whether a candidate may be annotated, else the reason it is skipped.

    `candidates(case_id, path, producer, sha256, observed_sha256, records)`, `runs(case_id, tool, status)`.
    """
    ok = runs.where(F.col("status") == "succeeded").select("case_id", F.col("tool").alias("producer")).distinct().withColumn("_ran", F.lit(True))
    reason = (
        F.when(F.col("path").isNull() | F.col("_ran").isNull(), "no_successful_producer").when(F.col("observed_sha256").isNull(), "missing_file")
        .when(~F.col("sha256").eqNullSafe(F.col("observed_sha256")), "hash_mismatch").when((F.col("records") != 1) & F.lit(not split_records), "multiple_records")
    )
    return candidates.join(ok, ["case_id", "producer"], "left").withColumn("skip_reason", reason).drop("_ran")
