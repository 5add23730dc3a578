"""Dataset discovery: merging search hits, filtering records, sample metadata and design signals.

Search hits carry `query_ord`, `query` and `record_ord`; those ordinals, never the arrival order of rows,
decide which record comes first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from helixframe.functions import text as tx
from helixframe.functions.text import strip


def order() -> Column:
    """Order of a hit: query first, then place in its result."""
    return F.struct("query_ord", "record_ord")


def within_limit(hits: DataFrame, max_results: int = 10) -> DataFrame:
    """At most `max_results` hits per query (the search limit)."""
    order = W.partitionBy("query_ord", "query").orderBy("record_ord", "uid")
    return hits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= max_results).drop("_n")


def matched_queries(hits: DataFrame, key: str) -> DataFrame:
    """Distinct query labels per record in order of first match."""
    labels = hits.groupBy(key, tx.squeeze(F.col("query")).alias("_label")).agg(F.min(order()).alias("_o"))
    listed = F.array_sort(F.collect_list(F.struct("_o", "_label")))
    return labels.groupBy(key).agg(F.transform(listed, lambda x: x["_label"]).alias("matched_queries"), F.min("_o").alias("first_seen"))


def merge_first_wins(hits: DataFrame, key: str = "uid") -> DataFrame:
    """One record per key: the first one seen, with all queries that found it."""
    fields = [c for c in hits.columns if c not in (key, "query", "query_ord", "record_ord")]
    first = hits.groupBy(key).agg(F.min_by(F.struct(*fields), order()).alias("_r"))
    return first.select(key, "_r.*").join(matched_queries(hits, key), key)


def first_text(name: str) -> Column:
    """Aggregate: first non-empty value of a text column."""
    return F.coalesce(F.min_by(F.col(name), F.when(F.coalesce(F.col(name), F.lit("")) != "", order())), F.lit("")).alias(name)


def merged_list(hits: DataFrame, key: str, name: str) -> DataFrame:
    """Sorted union of an array column; exploded and de-duplicated before it is collected."""
    items = hits.select(key, F.explode(name).alias("_i")).distinct()
    return items.groupBy(key).agg(F.array_sort(F.collect_list("_i")).alias(name))


def merge_studies(hits: DataFrame) -> DataFrame:
    """Merge sequencing-archive hits by accession (uid when it is empty), filling gaps from later hits."""
    keyed = hits.withColumn("record_key", F.when(F.coalesce("accession", F.lit("")) != "", F.col("accession")).otherwise(F.col("uid")))
    filled = ["organism", "title", "bioproject", "biosample"]
    fixed = ["uid", "accession", "source_type", "summary", "library_strategy", "library_layout", "platform"]
    merged = keyed.groupBy("record_key").agg(
        F.min_by(F.struct(*fixed, "run_accessions"), order()).alias("_r"),
        *[first_text(c) for c in filled],
        F.min_by("sample_count", F.when(F.col("sample_count") != 0, order())).alias("_some"),
        F.max_by(F.struct("sample_count"), order()).alias("_last"),
        F.max("run_count").alias("_runs"),
        F.count("*").alias("_rows"),
    )
    merged = merged.join(merged_list(keyed, "record_key", "run_accessions"), "record_key", "left")
    merged = merged.join(matched_queries(keyed, "record_key"), "record_key")
    alone = F.col("_rows") == 1
    runs = F.when(alone, F.col("_r.run_accessions")).otherwise(F.coalesce("run_accessions", F.array().cast("array<string>")))
    counted = F.when(alone, F.col("_runs")).otherwise(F.nullif("_runs", F.lit(0)))
    return merged.select(
        "record_key", *[f"_r.{c}" for c in fixed], *filled,
        runs.alias("run_accessions"),
        F.coalesce("_some", "_last.sample_count").alias("sample_count"),
        F.when(F.size(runs) > 0, F.size(F.array_distinct(runs)).cast("long")).otherwise(counted).alias("run_count"),
        "matched_queries", "first_seen",
    )


def merge_projects(hits: DataFrame) -> DataFrame:
    """Merge project hits by accession (uid when it is empty): union of links, first non-empty texts."""
    keyed = hits.withColumn("record_key", F.when(F.coalesce("accession", F.lit("")) != "", F.col("accession")).otherwise(F.col("uid")))
    merged = keyed.groupBy("record_key").agg(
        F.min_by(F.struct("uid", "accession"), order()).alias("_r"), *[first_text(c) for c in ("title", "summary", "organism")]
    )
    for name in ("linked_sra", "linked_biosamples"):
        merged = merged.join(merged_list(keyed, "record_key", name), "record_key", "left")
        merged = merged.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return merged.select("record_key", "_r.*", "title", "summary", "organism", "linked_sra", "linked_biosamples").join(
        matched_queries(keyed, "record_key"), "record_key"
    )


def contains(text: Column, needle: str) -> Column:
    return F.lower(text).contains(needle.lower())


def filter_records(
    records: DataFrame,
    taxon_col: str,
    assay_col: str | None,
    text_cols: list[str],
    taxa: list[str] = [],
    assays: list[str] = [],
    include: list[str] = [],
    exclude: list[str] = [],
    single_species: bool = False,
) -> DataFrame:
    """Catalogue filter: any taxon, any assay, all included texts, no excluded text."""
    haystack = tx.join_parts(*[F.col(c) for c in text_cols])
    tests = []
    if single_species:
        tests.append(~F.coalesce(F.col(taxon_col), F.lit("")).rlike("[;,]"))
    if taxa:
        tests.append(reduce(lambda a, b: a | b, [contains(F.col(taxon_col), t) for t in taxa]))
    if assays and assay_col:
        tests.append(reduce(lambda a, b: a | b, [contains(F.col(assay_col), t) for t in assays]))
    tests += [contains(haystack, t) for t in include]
    tests += [~contains(haystack, t) for t in exclude]
    return records.where(reduce(lambda a, b: a & b, tests)) if tests else records


def inspectable(records: DataFrame, top: int = 3) -> DataFrame:
    """The first series records in order of discovery."""
    series = records.where(F.upper("accession").startswith("GSE"))
    return series.orderBy("first_seen", "accession").limit(max(top, 0))


def exact_accession(requests: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose accession equals the requested one, case ignored."""
    wanted = requests.select("requested", F.lower("requested").alias("_k"))
    return wanted.join(records.withColumn("_k", F.lower("accession")), "_k").drop("_k")


def resolve_anchor(requests: DataFrame, records: DataFrame) -> DataFrame:
    """Study to look at for each request: the record holding the requested accession at any level, else the first.

    `records(requested, record_ord, accession, study_accession, …, run_accessions)` are the hits per request.
    """
    levels = ["accession", "study_accession", "experiment_accession", "sample_accession", "submitter_accession"]
    ids = F.concat(F.array(*[F.col(c) for c in levels]), F.coalesce("run_accessions", F.array().cast("array<string>")))
    named = records.select(
        "requested", "record_ord",
        tx.join_parts(F.col("study_accession")).alias("_study"), tx.join_parts(F.col("accession")).alias("_acc"),
        F.exists(ids, lambda i: F.coalesce(F.upper(i), F.lit("")) == F.upper(strip(F.col("requested")))).alias("_match"),
    )
    best = named.groupBy("requested").agg(
        F.min_by(F.struct("_study", "_acc", "_match"), F.struct((~F.col("_match")).cast("int"), F.col("record_ord"))).alias("b")
    )
    first = F.when(F.col("b._study") != "", F.col("b._study")).when(F.col("b._acc") != "", F.col("b._acc"))
    return requests.select("requested").join(best, "requested", "left").select(
        "requested", F.coalesce(first, F.col("requested")).alias("anchor"), F.coalesce("b._match", F.lit(False)).alias("exact")
    )


def backfill_links(projects: DataFrame, studies: DataFrame) -> DataFrame:
    """Project links; a project without any takes the accessions of all levels from the archive records that name it."""
    own = projects.select("accession", F.explode("linked_sra").alias("linked")).withColumn("backfilled", F.lit(False))
    bare = projects.where(F.size("linked_sra") == 0).select("accession")
    levels = [studies[c] for c in ("accession", "study_accession", "experiment_accession", "sample_accession") if c in studies.columns]
    found = studies.join(bare, studies["bioproject"] == bare["accession"]).select(
        bare["accession"], F.explode(F.concat(F.array(*levels), F.coalesce("run_accessions", F.array().cast("array<string>")))).alias("linked")
    )
    found = found.where(F.coalesce("linked", F.lit("")) != "").distinct().withColumn("backfilled", F.lit(True))
    return own.unionByName(found)


# -- sample metadata -------------------------------------------------------------------------------

# Prefixes of sample columns that never describe groups.
BLOCKED_PREFIXES = (
    "geo_accession", "status", "submission_date", "last_update_date", "contact_", "supplementary_file",
    "extract_protocol", "label_protocol", "scan_protocol", "hyb_protocol", "description", "data_processing",
    "library_selection", "library_source", "library_strategy", "relation", "data_row_count", "series_id",
    "platform_id", "platform_taxid", "sample_taxid",
)


def long_samples(table: DataFrame, ids: list[str] = ["accession", "sample", "ord"]) -> DataFrame:
    """Wide sample table to one row per (sample, column)."""
    values = [c for c in table.columns if c not in ids]
    wide = table.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in values])
    return wide.unpivot(ids, values, "column", "value")


def value_counts(samples: DataFrame) -> DataFrame:
    """Counts per (accession, column, non-blank value)."""
    trimmed = samples.withColumn("value", strip("value")).where(F.col("value") != "")
    return trimmed.groupBy("accession", "column", "value").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))


def grouping_columns(samples: DataFrame) -> DataFrame:
    """Columns that may define groups, with their value counts.

    The number of distinct values is checked before any are collected, so a free-text column with millions
    of values is dropped without ever being gathered.
    """
    counts = value_counts(samples.where(~F.lower("column").rlike("^(" + "|".join(BLOCKED_PREFIXES) + ")")))
    width = counts.groupBy("accession", "column").agg(F.count("*").alias("distinct_values"), F.sum("n").alias("_total"))
    kept = width.where((F.col("distinct_values") > 1) & (F.col("distinct_values") <= F.least(F.lit(12), F.greatest(F.lit(3), F.col("_total") - 1))))
    listed = F.array_sort(F.collect_list(F.struct("first_ord", "value", "n")))
    return counts.join(kept.drop("_total"), ["accession", "column"]).groupBy("accession", "column", "distinct_values").agg(
        F.transform(listed, lambda x: x["value"]).alias("unique_values"),
        F.map_from_entries(F.transform(listed, lambda x: F.struct(x["value"], x["n"]))).alias("counts"),
    )


# Run-metadata columns that may carry the design, and their display priority.
DESIGN_KEYS = (
    "source_name", "sample_name", "sample_title", "experiment_title", "strain", "tissue", "cell_type", "treatment",
    "group", "condition", "phenotype", "genotype", "timepoint", "time_point", "sex", "age",
)
DESIGN_PRIORITY = (
    "group", "condition", "treatment", "phenotype", "genotype", "timepoint", "time_point", "source_name",
    "sample_name", "sample_title", "tissue", "cell_type", "sex", "age", "strain",
)
KEY_ALIASES = {"source_name": "source", "sample_name": "samplename", "sample_title": "sampletitle", "experiment_title": "experiment"}
CLEAR_KEYS = ("group", "condition", "treatment", "phenotype", "genotype", "timepoint", "time_point")


def design_signals(runs: DataFrame, top_values: int = 8, top_keys: int = 8) -> DataFrame:
    """Run-metadata keys with at least two values, their commonest values, in priority order per accession."""
    by_lower = {c.strip().lower(): c for c in runs.columns}
    attributes = None
    if "sample_attribute" in by_lower:
        # Parsed once per row, before the keys are looked up in it.
        runs = runs.withColumn("_attributes", tx.sample_attributes(F.col(f"`{by_lower['sample_attribute']}`")))
        attributes = F.col("_attributes")
    pairs = []
    for key in DESIGN_KEYS:
        name = by_lower.get(key) or by_lower.get(KEY_ALIASES.get(key, ""))
        options = [F.nullif(strip(F.col(f"`{name}`").cast("string")), F.lit(""))] if name else []
        if attributes is not None:
            options.append(F.try_element_at(attributes, F.lit(key)))
        if options:
            pairs.append(F.struct(F.lit(key).alias("k"), F.coalesce(*options).alias("v")))
    values = runs.select("accession", F.explode(F.array(*pairs)).alias("e")).where(F.col("e.v").isNotNull())
    counts = values.groupBy("accession", F.col("e.k").alias("column"), F.col("e.v").alias("value")).agg(F.count("*").alias("n"))
    wide = counts.groupBy("accession", "column").agg(F.count("*").alias("distinct_values")).where(F.col("distinct_values") >= 2)
    best = W.partitionBy("accession", "column").orderBy(F.desc("n"), "value")
    kept = counts.withColumn("position", F.row_number().over(best)).where(F.col("position") <= top_values)
    kept = kept.join(wide, ["accession", "column"])
    signals = kept.groupBy("accession", "column", "distinct_values").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "value", "n"))), lambda x: F.struct(x["value"], x["n"])).alias("values")
    )
    place = F.array_position(F.array(*map(F.lit, DESIGN_PRIORITY)), F.col("column"))
    rank = F.when(place == 0, 999).otherwise(place)
    order = W.partitionBy("accession").orderBy(rank, "column")
    return signals.withColumn("position", F.row_number().over(order)).where(F.col("position") <= top_keys)


def sample_counts(records: DataFrame, samples: DataFrame) -> DataFrame:
    """Verified sample count, else the one of the series summary, with the origin as a status."""
    verified = samples.groupBy("accession").agg(F.countDistinct("sample").alias("_v"))
    return records.select("accession", F.col("samples").alias("_s")).join(verified, "accession", "left").select(
        "accession", F.coalesce("_v", "_s").cast("long").alias("sample_count"),
        F.when(F.col("_v").isNotNull(), "verified_from_gsms").when(F.col("_s").isNotNull(), "series_summary_only")
        .otherwise("unavailable").alias("sample_count_status"),
    )


# The metadata columns that may name a sample or a run, in order.
SAMPLE_COLUMNS = ("biosample", "biosample_s", "sample_accession", "sample_alias")
RUN_COLUMNS = ("run", "run_accession")


def run_counts(runs: DataFrame) -> DataFrame:
    """(accession, metadata_rows, run_count, sample_count): distinct runs and samples per accession, NULL when nothing is known.

    A row's sample is the first of the columns SAMPLE_COLUMNS (whatever their case) that is not empty there, its run the
    first of RUN_COLUMNS; a value of white space alone names none.
    """
    by_lower = {c.strip().lower(): c for c in runs.columns}

    def distinct(names: tuple[str, ...]) -> Column:
        options = [F.nullif(F.col(f"`{by_lower[n]}`").cast("string"), F.lit("")) for n in names if n in by_lower]
        value = F.nullif(tx.clean(F.coalesce(*options, F.lit(None).cast("string"))), F.lit(""))
        return F.nullif(F.countDistinct(value), F.lit(0))

    return runs.groupBy("accession").agg(F.count("*").alias("metadata_rows"), distinct(RUN_COLUMNS).alias("run_count"), distinct(SAMPLE_COLUMNS).alias("sample_count"))


def metadata_union(*sources: DataFrame) -> DataFrame:
    """The metadata rows of several sources under one another; a column that a source lacks is null there, names match in any case."""
    first, *rest = sources
    names = {c.lower(): c for s in reversed(sources) for c in s.columns}
    alike = [s.select(*[F.col(f"`{c}`").alias(names[c.lower()]) for c in s.columns]) for s in (first, *rest)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike)


def first_usable(records: DataFrame, key: str, names: list[str], order: str = "record_ord") -> DataFrame:
    """First non-empty value of each text column per key."""
    return records.groupBy(key).agg(
        *[F.coalesce(F.min_by(F.col(n), F.when(tx.clean(F.col(n)) != "", F.col(order))), F.lit("")).alias(n) for n in names]
    )


def column_values(samples: DataFrame, pattern: str) -> DataFrame:
    """Distinct non-blank values of the columns matching a pattern, in order of appearance."""
    counts = value_counts(samples.where(F.lower("column").rlike(pattern)))
    seen = counts.groupBy("accession", "value").agg(F.min(F.struct("column", "first_ord")).alias("o"))
    return seen.groupBy("accession").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "value"))), lambda x: x["value"]).alias("values"))


def tissue_summary(samples: DataFrame) -> DataFrame:
    """Values of the tissue columns; accessions that have no such column use the source name."""
    named = samples.where(F.lower("column").rlike("tissue")).select("accession").distinct()
    by_tissue = column_values(samples, "tissue")
    by_source = column_values(samples.join(named, "accession", "left_anti"), "source_name")
    return by_tissue.unionByName(by_source)


def distinct_runs(records: DataFrame) -> DataFrame:
    return records.select("accession", F.explode("run_accessions").alias("run")).where(F.col("run") != "").distinct()
