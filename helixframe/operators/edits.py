"""Edits to sequences and annotations: each one states the old value it expects, and is refused otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe.functions import seq as sq, text as tx
from helixframe.functions.rules import flags, none
from helixframe.operators.tiles import tiles
from helixframe.session import cut_lineage


TILE = 1000
SITE = ["set_id", "sequence_id"]


def base_edit_reasons(edits: DataFrame, records: DataFrame) -> DataFrame:
    """Reasons to refuse each base edit (set_id, sequence_id, position, old, new, evidence, rationale).

    Edits meet the tile that holds their position and the sequence's length; no sequence travels with its edits.
    """
    sites = edits.groupBy(*SITE, "position").agg(F.count("*").alias("_n"))
    joined = edits.join(sites, [*SITE, "position"], "left").join(records.select(*SITE, F.coalesce(F.length("seq"), F.lit(0)).alias("_length")), SITE, "left")
    joined = joined.withColumn("tile", F.floor((F.col("position") - 1) / TILE).cast("int")).join(tiles(records, SITE, width=TILE), [*SITE, "tile"], "left")
    inside = F.col("position").between(1, F.col("_length"))
    old, new = F.upper("old"), F.upper("new")
    letter = F.expr(f"substr(piece, CAST(position - tile * {TILE} AS INT), 1)")
    reasons = flags(
        (F.col("_length").isNull(), "unknown_sequence"), (F.col("_length").isNotNull() & ~inside, "outside_sequence"), (F.col("_n") > 1, "repeated_site"),
        (~old.rlike(f"^[{sq.IUPAC}]$") | ~new.rlike("^[ACGT]$") | (old == new), "bad_base"), (inside & (letter != old), "old_base_differs"),
        (tx.clean(F.col("evidence")) == "", "no_evidence"), (tx.clean(F.col("rationale")) == "", "no_rationale"),
    )
    return joined.withColumn("reasons", reasons).drop("_length", "_n", "tile", "piece")


def apply_base_edits(edits: DataFrame, records: DataFrame) -> DataFrame:
    """Edited sequences of the sets without any refused edit; one bad edit refuses its whole set.

    Refused are the edits that `base_edit_reasons` gives a reason.  Edits and sequences are each read once and meet by tile: there
    the edits are judged and the tile is cut between its edited positions.  Only the sets without a refused edit are joined to
    whole sequences; work is linear in the length.
    """
    old, new = F.upper("old"), F.upper("new")
    place = (F.col("position") - 1) / TILE
    wrong = ~old.rlike(f"^[{sq.IUPAC}]$") | ~new.rlike("^[ACGT]$") | (old == new) | (tx.clean(F.col("evidence")) == "") | (tx.clean(F.col("rationale")) == "")
    # An edit without a position hits no letter, but its sequence must be known: it meets the first tile.
    placed = edits.select(*SITE, F.coalesce(F.floor(place).cast("int"), F.lit(0)).alias("tile"), "position", old.alias("old"), new.alias("new"), F.coalesce(wrong, F.lit(False)).alias("_wrong"))
    at = (F.col("position") - F.col("tile") * TILE).cast("int").alias("at")
    by_tile = placed.groupBy(*SITE, "tile").agg(
        F.array_sort(F.collect_set(F.when(~F.col("_wrong"), F.struct(at, "old", "new")))).alias("_all"), F.bool_or("_wrong").alias("_wrong"),
        F.count("position").alias("_placed"),
    )
    by_tile = by_tile.withColumn("_e", F.filter("_all", lambda e: e["at"].isNotNull())).drop("_all")
    known = F.col("seq").isNotNull().alias("_known")
    held = tiles(records.select(*SITE, "seq", known), [*SITE, "_known"], width=TILE, empty=True)
    here = lambda e: F.col("piece").substr(e["at"], F.lit(1))
    missed = F.exists("_e", lambda e: F.coalesce((e["at"] > F.length("piece")) | (here(e) != e["old"]), F.lit(False)))
    # Fewer edited places than edits with a position: a place is edited twice.
    repeated = F.size(F.array_distinct(F.transform("_e", lambda e: e["at"]))) < F.col("_placed")
    refused = F.col("_placed").isNotNull() & (F.col("piece").isNull() | F.col("_wrong") | repeated | missed)
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col("_e"), i - 1)["at"])
    cuts = F.transform("_e", lambda e, i: F.concat(F.col("piece").substr((before(i) + 1).cast("int"), (e["at"] - before(i) - 1).cast("int")), e["new"]))
    rest = F.expr("substr(piece, try_element_at(_e, -1).at + 1)")
    edited = F.when(F.size("_e") > 0, F.concat(F.array_join(cuts, ""), rest)).otherwise(F.col("piece"))
    met = held.join(by_tile, [*SITE, "tile"], "full").withColumn("_refused", refused)
    cut = cut_lineage(met.select(*SITE, "tile", "_known", "_refused", F.when(~F.col("_refused"), edited).alias("piece"), F.when(F.col("_placed").isNull(), 0).otherwise(F.size("_e")).alias("_n")))
    bad = cut.where("_refused").select("set_id").distinct()
    whole = cut.where(F.col("_known").isNotNull()).join(bad, "set_id", "left_anti").groupBy(*SITE).agg(
        F.array_sort(F.collect_list(F.struct("tile", "piece"))).alias("_t"), F.sum("_n").cast("int").alias("edits"), F.bool_or("_known").alias("_known")
    )
    return whole.select(*SITE, F.when(F.col("_known"), F.array_join(F.transform("_t", lambda t: t["piece"]), "")).alias("seq"), "edits")


def select_feature(edits: DataFrame, features: DataFrame, kind: str | None = None) -> DataFrame:
    """Features hit by each edit's selector and their number; exactly one is required.

    `edits(edit_id, record_id, selector_type, selector_qualifier, selector_value, …)`.
    """
    values = features.select("record_id", "feature_id", F.col("type").alias("selector_type"), F.explode("qualifiers").alias("selector_qualifier", "_v"))
    values = values.select("record_id", "feature_id", "selector_type", "selector_qualifier", F.explode("_v").alias("selector_value")).distinct()
    sources = features.where(F.col("type") == "source").select("record_id", "feature_id")
    wanted = edits if kind is None else edits.withColumn("selector_type", F.lit(kind))
    plain = wanted.where(F.col("selector_type") != "source").join(values, ["record_id", "selector_type", "selector_qualifier", "selector_value"]).select("edit_id", "record_id", "feature_id")
    whole = wanted.where(F.col("selector_type") == "source").join(sources, "record_id").select("edit_id", "record_id", "feature_id")
    hits = plain.unionByName(whole).groupBy("edit_id").agg(F.count("*").alias("matches"), F.min("feature_id").alias("feature_id"))
    return wanted.join(hits, "edit_id", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))


def boundary_edits(edits: DataFrame, features: DataFrame, records: DataFrame, table: int = 5) -> DataFrame:
    """CDS boundary edits with the protein before and after, or the reasons to refuse them.

    `edits(edit_id, record_id, selector_qualifier, selector_value, old_start, old_end, old_strand, new_start, new_end,
    new_strand, old_codon_start, new_codon_start, evidence, rationale)`; coordinates are 1-based and closed.
    """
    f = features.select("record_id", "feature_id", "segments", "strand", "qualifiers", F.coalesce("partial5", F.lit(False)).alias("_p5"), F.coalesce("partial3", F.lit(False)).alias("_p3"))
    j = select_feature(edits, features, "CDS").join(f, ["record_id", "feature_id"], "left").join(records.select("record_id", "sequence"), "record_id", "left")
    same = j.groupBy("record_id", "selector_qualifier", "selector_value").agg(F.count("*").alias("_same"))
    j = j.join(same, ["record_id", "selector_qualifier", "selector_value"])
    here = F.col("segments")[0]
    codon = F.coalesce(F.expr("try_cast(try_element_at(try_element_at(qualifiers, 'codon_start'), 1) AS INT)"), F.lit(1))
    one = F.col("matches") == 1
    reasons = flags(
        (~F.col("selector_qualifier").isin("locus_tag", "gene"), "selector"), (~one, "not_unique"), (F.col("_same") > 1, "repeated_feature"), (one & (F.size("segments") != 1), "compound_location"),
        (one & (F.col("_p5") | F.col("_p3")), "uncertain_boundary"),
        (one & ((here["start"] + 1 != F.col("old_start")) | (here["end"] != F.col("old_end")) | (F.col("strand") != F.col("old_strand"))), "old_boundary_differs"),
        (~F.col("new_strand").isin(-1, 1), "bad_strand"), ((F.col("new_start") < 1) | (F.col("new_end") < F.col("new_start")) | (F.col("new_end") > F.length("sequence")), "outside_sequence"),
        (~F.col("old_codon_start").isin(1, 2, 3) | ~F.col("new_codon_start").isin(1, 2, 3), "bad_codon_start"), (one & (codon != F.col("old_codon_start")), "codon_start_differs"),
        (tx.clean(F.col("evidence")) == "", "no_evidence"), (tx.clean(F.col("rationale")) == "", "no_rationale"),
    )
    j = j.withColumn("reasons", reasons)
    new = F.array(F.struct((F.col("new_start") - 1).cast("long").alias("start"), F.col("new_end").cast("long").alias("end")))
    j = j.withColumn("_b", sq.extract(F.col("sequence"), F.col("segments"), F.col("strand"))).withColumn("_a", sq.extract(F.col("sequence"), new, F.col("new_strand")))
    ok = F.size("reasons") == 0
    before, after = sq.translate(F.expr("substr(_b, old_codon_start)"), table), sq.translate(F.expr("substr(_a, new_codon_start)"), table)
    return j.select(
        "edit_id", "record_id", "feature_id", "reasons", F.when(ok, before).alias("translation_before"), F.when(ok, after).alias("translation_after"),
        F.when(ok, F.map_contains_key("qualifiers", "transl_except")).alias("drops_transl_except"),
    )


def apply_boundary_edits(edits: DataFrame, features: DataFrame, records: DataFrame, table: int = 5) -> DataFrame:
    """Features after the boundary edits; a record with any refused edit keeps its features."""
    judged = boundary_edits(edits, features, records, table)
    bad = judged.where(F.size("reasons") > 0).select("record_id").distinct()
    good = judged.join(bad, "record_id", "left_anti").join(edits.select("edit_id", "new_start", "new_end", "new_strand", "new_codon_start"), "edit_id")
    j = features.join(good.select("record_id", "feature_id", "new_start", "new_end", "new_strand", "new_codon_start", "translation_after"), ["record_id", "feature_id"], "left")
    hit = F.col("new_start").isNotNull()
    kept = F.map_filter("qualifiers", lambda k, v: ~k.isin("transl_except", "codon_start") & ((k != "translation") | F.lit(False)))
    told = F.when(F.map_contains_key("qualifiers", "translation"), F.create_map(F.lit("translation"), F.array(F.regexp_replace("translation_after", r"\*$", "")))).otherwise(F.create_map().cast("map<string,array<string>>"))
    changed = F.map_concat(kept, F.create_map(F.lit("codon_start"), F.array(F.col("new_codon_start").cast("string"))), told)
    segments = F.array(F.struct((F.col("new_start") - 1).cast("long").alias("start"), F.col("new_end").cast("long").alias("end")))
    rest = [c for c in features.columns if c not in ("segments", "strand", "qualifiers")]
    return j.select(
        *rest, F.when(hit, segments).otherwise(F.col("segments")).alias("segments"), F.when(hit, F.col("new_strand")).otherwise(F.col("strand")).alias("strand"),
        F.when(hit, changed).otherwise(F.col("qualifiers")).alias("qualifiers"),
    )


def qualifier_edits(edits: DataFrame, features: DataFrame) -> DataFrame:
    """Qualifier edits (old and new value lists) with the reasons to refuse them."""
    j = select_feature(edits, features).join(features.select("record_id", "feature_id", "qualifiers"), ["record_id", "feature_id"], "left")
    same = j.where("feature_id IS NOT NULL").groupBy("record_id", "feature_id", "qualifier").agg(F.count("*").alias("_same"))
    j = j.join(same, ["record_id", "feature_id", "qualifier"], "left")
    old, new = F.coalesce("old", none()), F.coalesce("new", none())
    source = F.col("selector_type") == "source"
    selector = source | (F.col("selector_type").isin("CDS", "tRNA", "rRNA", "gene") & F.col("selector_qualifier").isin("gene", "locus_tag", "product") & (tx.clean(F.col("selector_value")) != ""))
    empty = lambda values: F.exists(values, lambda v: F.coalesce(v, F.lit("")) == "")
    reasons = flags(
        (~F.coalesce(selector, F.lit(False)), "selector"), (~F.coalesce(F.col("qualifier").rlike("^[A-Za-z][A-Za-z0-9_]*$"), F.lit(False)), "qualifier"), (empty(old) | empty(new) | (old == new), "values"),
        (F.col("matches") != 1, "not_unique"), (F.col("_same") > 1, "repeated_qualifier"), ((F.col("matches") == 1) & (F.coalesce(F.try_element_at("qualifiers", F.col("qualifier")), none()) != old), "old_value_differs"),
        (source & (F.col("qualifier") == "organism") & (F.size(new) != 1), "one_organism"), (tx.clean(F.col("evidence")) == "", "no_evidence"), (tx.clean(F.col("rationale")) == "", "no_rationale"),
    )
    return j.withColumn("reasons", reasons).drop("_same", "qualifiers")


def apply_qualifier_edits(edits: DataFrame, features: DataFrame) -> DataFrame:
    """Features after the qualifier edits; an empty new list removes the qualifier."""
    judged = qualifier_edits(edits, features)
    bad = judged.where(F.size("reasons") > 0).select("record_id").distinct()
    good = judged.join(bad, "record_id", "left_anti").groupBy("record_id", "feature_id").agg(F.map_from_entries(F.collect_list(F.struct("qualifier", F.coalesce("new", none())))).alias("_new"))
    j = features.join(good, ["record_id", "feature_id"], "left")
    kept = F.map_filter("qualifiers", lambda k, v: ~F.map_contains_key("_new", k))
    merged = F.map_concat(kept, F.map_filter("_new", lambda k, v: F.size(v) > 0))
    return j.withColumn("qualifiers", F.when(F.col("_new").isNull(), F.col("qualifiers")).otherwise(merged)).drop("_new")
