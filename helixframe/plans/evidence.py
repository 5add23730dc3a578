"""One evidence schema for all catalogues, and the builders that bring records into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.functions import text as tx
from helixframe.session import cut_lineage

GEO_LINK = "https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc="
SRA_LINK = "https://www.ncbi.nlm.nih.gov/sra/"
PROJECT_LINK = "https://www.ncbi.nlm.nih.gov/bioproject/"
SAMPLE_LINK = "https://www.ncbi.nlm.nih.gov/biosample/"

LIST, TEXTMAP = "array<string>", "map<string,string>"
SIGNALS = "array<struct<column:string,counts:map<string,bigint>>>"


def empty_list() -> Column:
    return F.array().cast(LIST)


def one(value: Column) -> Column:
    """Single text as a list, empty when it is blank."""
    return tx.non_empty(F.array(value))


def column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """Column if the records have it, else a typed empty value."""
    if name in df.columns:
        return F.col(name)
    return F.array().cast(kind) if kind.startswith("array") else F.lit(None).cast(kind)


def notes(**values: Column) -> Column:
    """Map of texts; lists are kept as JSON."""
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values.values()]))


def as_json(values: Column) -> Column:
    return F.to_json(values)


def evidence(df: DataFrame, **fields: Column) -> DataFrame:
    """Project into the common schema; fields not given take their empty value."""
    blank = {
        "source": F.lit(""), "accession": F.lit(""), "source_type": F.lit(""), "title": F.lit(""), "organisms": empty_list(),
        "tissues": empty_list(), "assay_family": F.lit(""), "sample_count": F.lit(None), "run_count": F.lit(None),
        "group_signals": F.array(), "data_availability": F.create_map(), "geo": empty_list(), "sra": empty_list(),
        "bioproject": empty_list(), "biosample": empty_list(), "risks": empty_list(), "source_links": F.create_map(), "local_notes": F.create_map(),
    }
    v = {**blank, **fields}
    return df.select(
        *[v[c].cast("string").alias(c) for c in ("source", "accession", "source_type", "title")],
        v["organisms"].cast(LIST).alias("organisms"), v["tissues"].cast(LIST).alias("tissues"), v["assay_family"].alias("assay_family"),
        v["sample_count"].cast("long").alias("sample_count"), v["run_count"].cast("long").alias("run_count"),
        v["group_signals"].cast(SIGNALS).alias("group_signals"), v["data_availability"].cast(TEXTMAP).alias("data_availability"),
        F.struct(*[v[c].cast(LIST).alias(c) for c in ("geo", "sra", "bioproject", "biosample")]).alias("linked_accessions"),
        v["risks"].cast(LIST).alias("risks"), v["source_links"].cast(TEXTMAP).alias("source_links"), v["local_notes"].cast(TEXTMAP).alias("local_notes"),
    )


def series_fields(df: DataFrame) -> dict[str, Column]:
    context = tx.join_parts(*[column(df, c) for c in ("bioproject", "supplemental_files", "summary", "title")])
    project = F.concat(tx.split_accessions(column(df, "bioproject"), ("PRJ",)), tx.mine(context, tx.PROJECT_PATTERN))
    acc = F.col("accession")
    return dict(
        source=F.lit("GEO"), accession=acc, title=F.col("title"),
        source_type=F.when(F.upper(acc).startswith("GSE"), "series").otherwise("record"),
        geo=one(acc), sra=tx.mine(context, tx.SRA_PATTERN), bioproject=tx.non_empty(project), biosample=tx.mine(context, tx.SAMPLE_PATTERN),
        source_links=notes(geo=tx.link(GEO_LINK, acc), ftp=column(df, "ftp_link")),
    )


def series_candidates(df: DataFrame, include_summary: bool = False) -> DataFrame:
    return evidence(
        df, **series_fields(df), organisms=one(F.col("taxon")), sample_count=column(df, "samples", "long"),
        data_availability=notes(supplementary_files=column(df, "supplemental_files")),
        local_notes=notes(
            gds_type=column(df, "gds_type"), platform=column(df, "platform"), matched_queries=as_json(column(df, "matched_queries", LIST)),
            summary=column(df, "summary") if include_summary else F.lit(""),
        ),
    )


def series_inspections(df: DataFrame) -> DataFrame:
    """`df` holds the record plus organisms, tissues, assay_family, group_signals, availability, fit and verdict."""
    a = F.col("availability")
    known = tx.non_empty(column(df, "organisms", LIST))
    return evidence(
        df, **series_fields(df), organisms=F.when(F.size(known) > 0, known).otherwise(one(F.col("taxon"))),
        tissues=tx.non_empty(F.col("tissues")), assay_family=F.col("assay_family"), sample_count=F.col("sample_count"),
        group_signals=column(df, "group_signals", SIGNALS), risks=tx.non_empty(F.col("risks")),
        data_availability=notes(
            supplementary_formats=as_json(a["supplementary_formats"]),
            **{k: a[k] for k in ("processed_matrix_clues", "microarray_raw_clues", "sequencing_raw_clues", "likely_raw_counts",
                                 "normalized_expression_clues", "matrix_guess")},
        ),
        local_notes=notes(
            taxon=F.col("taxon"), gds_type=column(df, "gds_type"), platform=column(df, "platform"), design_clarity=F.col("design_clarity"),
            provisional_local_assessment=F.col("overall_usability"), usable_for=as_json(F.col("fit.usable_for")),
            not_recommended_for=as_json(F.col("fit.not_recommended_for")), rationale=as_json(F.col("fit.rationale")),
            summary=column(df, "summary"), supplemental_files=column(df, "supplemental_files"),
        ),
    )


def study_fields(df: DataFrame) -> dict[str, Column]:
    acc = F.col("accession")
    return dict(
        source=F.lit("SRA"), accession=acc, title=F.col("title"), sample_count=F.col("sample_count"), run_count=F.col("run_count"),
        bioproject=one(column(df, "bioproject")),
        source_type=F.coalesce(F.nullif(column(df, "source_type"), F.lit("")), F.lit("study")),
    )


def study_candidates(df: DataFrame, include_summary: bool = False) -> DataFrame:
    acc = F.col("accession")
    levels = ("study_accession", "experiment_accession", "sample_accession", "submitter_accession")
    return evidence(
        df, **study_fields(df), organisms=one(F.col("organism")), assay_family=F.col("library_strategy"),
        geo=tx.mine(F.col("title"), tx.GEO_PATTERN), biosample=one(column(df, "biosample")),
        sra=tx.non_empty(F.concat(F.array(acc, *[column(df, c) for c in levels]), F.coalesce(column(df, "run_accessions", LIST), empty_list()))),
        data_availability=notes(
            sra_runs_available=F.coalesce(F.col("run_count"), F.lit(0)) > 0, library_layout=F.col("library_layout"), platform=F.col("platform")
        ),
        source_links=notes(sra=tx.link(SRA_LINK, acc), bioproject=tx.link(PROJECT_LINK, column(df, "bioproject")), biosample=tx.link(SAMPLE_LINK, column(df, "biosample"))),
        local_notes=notes(
            platform=F.col("platform"), **{c: column(df, c) for c in levels}, matched_queries=as_json(column(df, "matched_queries", LIST)),
            summary=column(df, "summary") if include_summary else F.lit(""),
        ),
    )


def study_inspections(df: DataFrame) -> DataFrame:
    acc = F.col("accession")
    return evidence(
        df, **study_fields(df), organisms=tx.non_empty(F.col("organisms")), tissues=tx.non_empty(F.col("tissues")),
        assay_family=F.col("assay_family"), group_signals=column(df, "group_signals", SIGNALS), geo=column(df, "linked_geo", LIST),
        sra=tx.non_empty(F.col("linked_sra")), biosample=tx.non_empty(F.col("biosamples")), risks=tx.non_empty(F.col("risks")),
        data_availability=notes(
            sra_runs_available=F.coalesce(F.col("run_count"), F.lit(0)) > 0, raw_sequencing_available=F.coalesce(F.col("run_count"), F.lit(0)) > 0,
            library_layouts=as_json(F.col("library_layouts")), platforms=as_json(F.col("platforms")), runinfo_design_clarity=F.col("design_clarity"),
            needs_manual_check=(F.col("title") == "") | (F.size("organisms") == 0),
        ),
        source_links=notes(sra=tx.link(SRA_LINK, acc), bioproject=tx.link(PROJECT_LINK, column(df, "bioproject"))),
        local_notes=notes(
            design_clarity=F.col("design_clarity"), library_layouts=as_json(F.col("library_layouts")), platforms=as_json(F.col("platforms")),
            provisional_local_assessment=F.col("fit.overall"), usable_for=as_json(F.col("fit.usable_for")),
            not_recommended_for=as_json(F.col("fit.not_recommended_for")), rationale=as_json(F.col("fit.rationale")), summary=column(df, "summary"),
        ),
    )


def project_fields(df: DataFrame) -> dict[str, Column]:
    acc = F.col("accession")
    return dict(
        source=F.lit("BioProject"), accession=acc, source_type=F.lit("project"), title=F.col("title"), sra=tx.non_empty(F.col("linked_sra")),
        bioproject=one(acc), biosample=tx.non_empty(F.col("linked_biosamples")), source_links=notes(bioproject=tx.link(PROJECT_LINK, acc)),
    )


def project_candidates(df: DataFrame, include_summary: bool = False) -> DataFrame:
    return evidence(
        df, **project_fields(df), organisms=one(F.col("organism")), geo=tx.mine(F.col("title"), tx.GEO_PATTERN),
        data_availability=notes(linked_sra_count=F.size("linked_sra"), linked_biosample_count=F.size("linked_biosamples")),
        local_notes=notes(
            matched_queries=as_json(column(df, "matched_queries", LIST)), summary=column(df, "summary") if include_summary else F.lit("")
        ),
    )


def project_inspections(df: DataFrame) -> DataFrame:
    runs = F.nullif(F.size(F.filter("linked_sra", lambda r: r.startswith("SRR"))), F.lit(0))
    return evidence(
        df, **project_fields(df), organisms=tx.non_empty(F.col("organisms")), tissues=tx.non_empty(F.col("tissues")), run_count=runs,
        geo=column(df, "linked_geo", LIST), risks=tx.non_empty(F.col("risks")),
        data_availability=notes(
            linked_sra_count=F.size("linked_sra"), linked_biosample_count=F.size("linked_biosamples"), run_accessions_available=runs.isNotNull(),
            needs_manual_check=(F.col("title") == "") & (F.col("summary") == ""),
        ),
        local_notes=notes(
            provisional_local_assessment=F.col("fit.overall"), usable_for=as_json(F.col("fit.usable_for")),
            not_recommended_for=as_json(F.col("fit.not_recommended_for")), rationale=as_json(F.col("fit.rationale")), summary=column(df, "summary"),
        ),
    )


def bundle(candidates: DataFrame, inspected: DataFrame) -> DataFrame:
    """Inspected evidence when there is any, else the candidates.

    The inspected evidence is laid down once, and the candidates are worked out only where they are wanted.
    """
    found = cut_lineage(inspected)
    return candidates.select(*found.columns) if found.isEmpty() else found
