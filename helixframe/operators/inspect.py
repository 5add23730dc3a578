"""Inspection of requested studies and projects: the records that count, their distinct values, counts, risks and fit.

Records of a request are what the search let through, so lists of a request's values stay as short as its search limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.functions import rules, text as tx
from helixframe.operators import discover as di
from helixframe.session import spread

# Accession levels of an archive record.
RECORDS_A_TASK = 50_000  # their lists are held while a request is summed up
LEVELS = ("accession", "study_accession", "experiment_accession", "sample_accession")


def in_order(value: Column, when: Column | None = None) -> Column:
    """Aggregate: the distinct non-blank values of a group by the order of its records."""
    kept = F.struct(F.col("record_ord").alias("o"), value.alias("v"))
    rows = F.array_sort(F.collect_list(kept if when is None else F.when(when, kept)))
    return tx.non_empty(F.transform(rows, lambda r: r["v"]))


def lists_in_order(value: Column) -> Column:
    """Aggregate: the distinct non-blank members of a group's lists by the order of its records."""
    rows = F.array_sort(F.collect_list(F.struct(F.col("record_ord").alias("o"), F.coalesce(value, F.array().cast("array<string>")).alias("v"))))
    return tx.non_empty(F.flatten(F.transform(rows, lambda r: r["v"])))


def first_of(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(1)), F.lit(""))


def named(record_levels: tuple[str, ...], wanted: Column) -> Column:
    """Whether a record holds the accession at any level, case ignored."""
    ids = F.concat(F.array(*[F.col(c) for c in record_levels]), F.coalesce("run_accessions", F.array().cast("array<string>")))
    return F.exists(ids, lambda i: F.coalesce(F.upper(i), F.lit("")) == F.upper(tx.clean(wanted)))


def anchor_records(requests: DataFrame, records: DataFrame) -> DataFrame:
    """The records that an inspection of each request looks at, with the request's `anchor` and `goal`.

    The anchor is the study of the record that names the request, see `discover.resolve_anchor`.  Where it is another accession
    that has hits of its own (records requested as the anchor), those are searched, else the request's own ones.  Of them the
    records that name the anchor count, and where none does, all of the request's own.
    """
    anchors = di.resolve_anchor(requests, records).join(requests.select("requested", "goal"), "requested")
    hits = records.withColumnRenamed("requested", "_asked")
    same = F.upper(tx.clean(F.col("anchor"))) == F.upper(tx.clean(F.col("requested")))
    own = anchors.join(hits, F.col("_asked") == F.col("requested")).withColumn("_pool", F.lit(0))
    other = anchors.where(~same).join(hits, F.col("_asked") == F.col("anchor")).withColumn("_pool", F.lit(1))
    both = own.unionByName(other).withColumn("_named", named((*LEVELS, "submitter_accession"), F.col("anchor")))
    state = both.groupBy("requested").agg(F.max("_pool").alias("_best"), F.max(F.when(F.col("_named"), F.col("_pool"))).alias("_hit"))
    kept = both.join(state, "requested")
    found = F.coalesce(F.col("_hit") == F.col("_best"), F.lit(False))
    kept = kept.where(F.when(found, (F.col("_pool") == F.col("_best")) & F.col("_named")).otherwise(F.col("_pool") == 0))
    return kept.drop("_asked", "_pool", "_named", "_best", "_hit")


def study_inspection(requests: DataFrame, records: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per request (requested, goal) that has records, ready for `evidence.study_inspections`.

    records: hits (requested, record_ord, the accession levels, submitter_accession, run_accessions, source_type, title, summary,
    organism, library_strategy, library_layout, platform, biosample, bioproject).  runs: metadata rows by accession.
    Counts come from the records, else from the metadata rows of the anchor, else they are unknown (null).
    """
    kept = anchor_records(requests, records)
    tissue = rules.title_tissue(F.col("title"), F.col("summary"))
    names = {"titles": "title", "types": "source_type", "organisms": "organism", "strategies": "library_strategy", "library_layouts": "library_layout", "platforms": "platform", "biosamples": "biosample", "projects": "bioproject", "summaries": "summary"}
    stats = kept.groupBy("requested", "anchor", "goal").agg(
        *[in_order(F.col(c)).alias(n) for n, c in names.items()], in_order(tissue).alias("tissues"),
        *[in_order(F.col(c)).alias(f"_{c}") for c in LEVELS], lists_in_order(F.col("run_accessions")).alias("runs"), F.count("*").alias("record_count"),
    )
    signals = di.design_signals(runs)
    signals = signals.groupBy("accession").agg(F.sort_array(F.collect_list(F.struct("position", "column", "values"))).alias("x"))
    counted = di.run_counts(runs).select(F.col("accession").alias("anchor"), "metadata_rows", F.col("run_count").alias("named_runs"), F.col("sample_count").alias("named_samples"))
    out = stats.join(counted, "anchor", "left").join(signals.withColumnRenamed("accession", "anchor"), "anchor", "left")
    keys = F.coalesce(F.transform("x", lambda s: s["column"]), F.array().cast("array<string>"))
    group_signals = F.transform("x", lambda s: F.struct(s["column"].alias("column"), F.map_from_entries(s["values"]).alias("counts")))
    known = lambda c, other: F.coalesce(F.nullif(F.size(c).cast("bigint"), F.lit(0)), F.col(other))
    out = out.select(
        "requested", "goal", F.col("anchor").alias("accession"), first_of(F.col("titles")).alias("title"), F.coalesce(F.nullif(first_of(F.col("types")), F.lit("")), F.lit("study")).alias("source_type"),
        "organisms", "tissues", "strategies", "library_layouts", "platforms", "biosamples", "runs", first_of(F.col("projects")).alias("bioproject"), first_of(F.col("summaries")).alias("summary"),
        F.array_join("strategies", "; ").alias("assay_family"), known("biosamples", "named_samples").alias("sample_count"), known("runs", "named_runs").alias("run_count"),
        tx.non_empty(F.concat(*[f"_{c}" for c in LEVELS], "runs")).alias("linked_sra"), F.coalesce(group_signals, F.array().cast("array<struct<column:string,counts:map<string,bigint>>>")).alias("group_signals"),
        rules.run_design_clarity(keys, di.CLEAR_KEYS).alias("design_clarity"), "record_count", F.coalesce("metadata_rows", F.lit(0)).alias("metadata_rows"), F.size("titles").alias("_t"),
    )
    risks = rules.study_risks(F.size("organisms"), F.size("strategies"), F.size("library_layouts"), F.size("platforms"), F.size("runs"), F.col("_t"))
    out = out.withColumn("risks", risks).drop("_t")
    return out.withColumn("fit", rules.study_fit(F.col("goal"), F.col("assay_family"), F.col("sample_count"), F.col("risks")))


def project_inspection(requests: DataFrame, records: DataFrame, studies: DataFrame) -> DataFrame:
    """One row per request (requested, goal) that has records, ready for `evidence.project_inspections`.

    records: hits (requested, record_ord, accession, title, summary, organism, linked_sra, linked_biosamples); those of the requested
    accession count where there are any.  A project without links takes accessions of all levels, biosamples and
    organisms from the archive records (studies) that name it, counted in `backfilled`.  Records are dealt by request over a
    number of tasks that grows with them; records that name no project, often the most, are not moved.
    """
    hits = spread(records, ["requested"], records.count(), RECORDS_A_TASK).join(requests.select("requested", "goal"), "requested").withColumn("_exact", F.upper(tx.clean(F.col("accession"))) == F.upper(tx.clean(F.col("requested"))))
    exact = hits.groupBy("requested").agg(F.max(F.coalesce("_exact", F.lit(False))).alias("_any"))
    kept = hits.join(exact, "requested").where(~F.col("_any") | F.col("_exact"))
    tissue = rules.title_tissue(F.col("title"), F.col("summary"))
    stats = kept.groupBy("requested", "goal").agg(
        F.count("*").alias("record_count"), *[in_order(F.col(c)).alias(n) for n, c in (("titles", "title"), ("summaries", "summary"), ("organisms", "organism"))],
        in_order(tissue).alias("tissues"), lists_in_order(F.col("linked_sra")).alias("own_sra"), lists_in_order(F.col("linked_biosamples")).alias("own_biosamples"),
    )
    bare = stats.where(F.size("own_sra") == 0).select("requested")
    naming = studies.where(F.col("bioproject") != "").withColumnRenamed("bioproject", "requested")
    filled = spread(naming, ["requested"], naming.count(), RECORDS_A_TASK).join(bare, "requested", "left_semi").groupBy("requested").agg(
        F.count("*").alias("backfilled"), *[in_order(F.col(c)).alias(f"_{c}") for c in LEVELS], lists_in_order(F.col("run_accessions")).alias("_runs"),
        in_order(F.col("biosample")).alias("_biosamples"), in_order(F.col("organism")).alias("_organisms"),
    )
    out = stats.join(filled, "requested", "left")
    none = F.array().cast("array<string>")
    more = lambda own, *extra: tx.non_empty(F.concat(F.col(own), *[F.coalesce(F.col(c), none) for c in extra]))
    out = out.select(
        "requested", "goal", F.col("requested").alias("accession"), first_of(F.col("titles")).alias("title"), first_of(F.col("summaries")).alias("summary"), "tissues", "record_count",
        more("own_sra", *[f"_{c}" for c in LEVELS], "_runs").alias("linked_sra"), more("own_biosamples", "_biosamples").alias("linked_biosamples"),
        more("organisms", "_organisms").alias("organisms"), F.coalesce("backfilled", F.lit(0)).alias("backfilled"),
    )
    out = out.withColumn("run_count", F.nullif(F.size(F.filter("linked_sra", lambda r: r.startswith("SRR"))).cast("bigint"), F.lit(0)))
    out = out.withColumn("risks", rules.project_risks(F.col("record_count"), F.size("linked_sra"), F.size("linked_biosamples")))
    return out.withColumn("fit", rules.project_fit(F.col("goal"), F.size("linked_sra"), F.col("risks")))
