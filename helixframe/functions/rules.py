"""Suitability rules as column expressions: assay family, availability, design, risks, fit and verdict."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from helixframe.functions import text as tx


def none() -> Column:
    """Empty text list."""
    return F.array().cast("array<string>")


def flags(*pairs: tuple[Column, str]) -> Column:
    """Names whose condition holds, distinct, in the given order."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs])))


def any_of(text: Column, *words: str) -> Column:
    test = text.contains(words[0])
    for word in words[1:]:
        test = test | text.contains(word)
    return test


def assay_family(*texts: Column) -> Column:
    """First matching family over the joined lower-case texts."""
    hay = F.lower(tx.join_parts(*texts))
    return (
        F.when(any_of(hay, "single cell", "single-cell", "single nucleus"), "single_cell_rna_seq")
        .when(any_of(hay, "non-coding rna", "small rna", "mirna"), "non_coding_rna_seq")
        .when(any_of(hay, "high throughput sequencing", "rna-seq", "rnaseq"), "bulk_rna_seq")
        .when(any_of(hay, "array"), "microarray")
        .otherwise("unknown")
    )


def title_tissue(title: Column, summary: Column) -> Column:
    """Tissue named in title or summary, first in priority order; NULL when none."""
    hay = F.lower(F.concat_ws(" ", title, summary))
    result = None
    for word in ("abdominal fat", "adipose", "cartilage", "islet"):
        result = F.when(hay.contains(word), F.lit(word)) if result is None else result.when(hay.contains(word), F.lit(word))
    return result


def data_availability(formats: Column, text: Column, family: Column) -> Column:
    """Clues about the data on offer and a guess at the kind of matrix."""
    def listed(*names):
        return F.arrays_overlap(formats, F.array(*map(F.lit, names)))

    rna = family.isin("bulk_rna_seq", "single_cell_rna_seq")
    processed = listed("TXT", "TSV", "CSV", "TAB", "XLSX", "MTX", "H5")
    cel = listed("CEL")
    raw_counts = rna & (tx.has(text, r"\b(?:raw counts?|counts? matrix|gene counts?)\b") | listed("MTX"))
    guess = (
        F.when((family == "microarray") & cel, "microarray_raw_plus_processed_possible")
        .when((family == "microarray") & processed, "processed_microarray_matrix_likely")
        .when(rna & raw_counts, "raw_counts_likely")
        .when(rna & processed, "processed_matrix_likely")
        .when((family == "non_coding_rna_seq") & processed, "processed_non_coding_matrix_likely")
        .otherwise("unknown")
    )
    return F.struct(
        formats.alias("supplementary_formats"), processed.alias("processed_matrix_clues"), cel.alias("microarray_raw_clues"),
        (listed("FASTQ", "SRA") | tx.has(text, r"\b(?:sra|fastq|srx\d+|srr\d+)\b")).alias("sequencing_raw_clues"),
        raw_counts.alias("likely_raw_counts"),
        tx.has(text, r"\b(?:normalized|fpkm|tpm|rpkm|log2|expression matrix)\b").alias("normalized_expression_clues"),
        guess.alias("matrix_guess"),
    )


def design_clarity(columns: Column) -> Column:
    """high when a grouping column names the design, partial when there are other ones, else low."""
    named = F.exists(columns, lambda c: F.lower(c).rlike("treatment|condition|group|phenotype|disease|genotype"))
    return F.when(F.size(F.coalesce(columns, none())) == 0, "low").when(named, "high").otherwise("partial")


def run_design_clarity(keys: Column, clear: tuple[str, ...]) -> Column:
    """The same over run-metadata keys, which must match exactly."""
    return F.when(F.size(F.coalesce(keys, none())) == 0, "low").when(F.arrays_overlap(keys, F.array(*map(F.lit, clear))), "high").otherwise("partial")


def series_risks(title: Column, summary: Column, organisms: Column, tissues: Column, group_columns: Column) -> Column:
    """`organisms`, `tissues` and `group_columns` are counts."""
    hay = F.lower(F.concat_ws(" ", title, summary))
    return flags(
        (any_of(hay, "across species", "bodymap"), "multi_species_series"),
        (any_of(hay, "multiomic", "multi-omic"), "multiomic_series"),
        (hay.contains("jointly profiled"), "mixed_assay_design"),
        (hay.contains("superseries"), "superseries"),
        (organisms > 1, "multiple_organisms"),
        (tissues > 2, "multiple_tissues"),
        (group_columns > 8, "many_grouping_dimensions"),
    )


def study_risks(organisms: Column, strategies: Column, layouts: Column, platforms: Column, runs: Column, titles: Column) -> Column:
    """Arguments are counts of distinct values over the records of a study."""
    return flags(
        (organisms > 1, "multiple_organisms"),
        (strategies > 1, "mixed_library_strategies"),
        (layouts > 1, "mixed_library_layouts"),
        (platforms > 1, "mixed_platforms"),
        (runs == 0, "run_accessions_unclear"),
        (organisms == 0, "organism_metadata_sparse"),
        (titles == 0, "title_metadata_sparse"),
    )


def project_risks(records: Column, linked_sra: Column, linked_samples: Column) -> Column:
    return flags(
        (records > 1, "multiple_project_records"),
        (linked_sra > 20, "broad_project_scope"),
        (linked_sra == 0, "linked_sra_unclear"),
        (linked_samples == 0, "linked_biosamples_unclear"),
    )


def series_fit(goal: Column, family: Column, samples: Column, clarity: Column, risks: Column) -> Column:
    """usable_for / not_recommended_for / rationale of a series.  An unknown sample count stays unknown."""
    def risk(name):
        return F.array_contains(risks, name)

    at_least = lambda n: F.coalesce(samples >= n, F.lit(False))
    bulk, array = family == "bulk_rna_seq", family == "microarray"
    single, coding = family == "single_cell_rna_seq", family == "non_coding_rna_seq"
    high, partial = clarity == "high", clarity == "partial"
    low = ~(high | partial)
    species = risk("multiple_organisms") | risk("multi_species_series")
    network = at_least(15) & ~low & ~risk("multiple_tissues")
    validation = at_least(6) & (clarity != "low")
    learning = at_least(30) & high
    return F.struct(
        flags(
            (bulk | array, "differential_expression"), (array, "validation"), (network, "wgcna"), (validation, "validation"),
            (learning, "machine_learning_exploration"),
        ).alias("usable_for"),
        flags(
            (single, "bulk_differential_expression"), (single, "wgcna"), (coding, "bulk_mrna_workflows"),
            (low, "differential_expression"), (low, "validation"),
            (risk("multiple_tissues"), "simple_case_control"), (risk("multiple_tissues"), "whole_series_wgcna"),
            (species, "validation"), (species, "simple_case_control"),
            (risk("superseries"), "whole_series_interpretation"), (~network, "wgcna"), (~learning, "machine_learning"),
        ).alias("not_recommended_for"),
        flags(
            (samples.isNull(), "sample_count_unverified"), (samples < 3, "extremely_small_sample_count"),
            ((samples >= 3) & (samples < 6), "small_sample_count"), (single, "single_cell_data"), (coding, "non_coding_assay_family"),
            (high, "clear_group_structure"), (partial, "partially_clear_group_structure"), (low, "unclear_group_structure"),
            (risk("multiple_tissues"), "mixed_tissue_risk"), (species, "multi_species_risk"),
            (risk("superseries"), "superseries_requires_subseries_check"),
            (~validation & (goal == "validation"), "weak_validation_candidate"),
            ((goal == "differential_expression") & ~(bulk | array), "requested_deg_but_design_is_weak"),
            ((goal == "wgcna") & ~network, "requested_wgcna_but_sample_size_or_design_is_weak"),
        ).alias("rationale"),
    )


def study_fit(goal: Column, family: Column, samples: Column, risks: Column) -> Column:
    """Fit and verdict of a sequencing study."""
    at_least = lambda n: F.coalesce(samples >= n, F.lit(False))
    deg, network = goal == "differential_expression", goal == "wgcna"
    mixed = F.arrays_overlap(risks, F.array(F.lit("multiple_organisms"), F.lit("mixed_library_strategies")))
    rna = F.lower(family) == "rna-seq"
    return F.struct(
        flags(
            (rna, "raw_rnaseq_follow_up"), (deg & at_least(6), "differential_expression"), (network & at_least(15), "wgcna"),
            (goal == "validation", "raw_data_validation_candidate"),
        ).alias("usable_for"),
        flags((deg & ~at_least(6), "differential_expression"), (network & ~at_least(15), "wgcna")).alias("not_recommended_for"),
        flags(
            (~rna, "assay_family_not_rnaseq"), (deg & ~at_least(6), "sample_support_small_for_deg"),
            (network & ~at_least(15), "sample_support_small_for_wgcna"), (mixed, "cross_sample_heterogeneity_detected"),
        ).alias("rationale"),
        F.when(mixed | (network & ~at_least(15)), "low").when(deg & at_least(6), "high").otherwise("medium").alias("overall"),
    )


def project_fit(goal: Column, linked_sra: Column, risks: Column) -> Column:
    """Fit and verdict of a project; `linked_sra` is a count."""
    broad = F.array_contains(risks, "broad_project_scope")
    return F.struct(
        flags((F.lit(True), "project_context"), (linked_sra > 0, "sra_follow_up")).alias("usable_for"),
        flags((goal == "wgcna", "wgcna_direct_use")).alias("not_recommended_for"),
        flags(
            (broad, "project_may_be_too_broad_for_direct_shortlist_use"), (goal == "wgcna", "bioproject_is_context_not_expression_matrix"),
        ).alias("rationale"),
        F.when(broad | (linked_sra == 0), "low").otherwise("medium").alias("overall"),
    )


def usability(fit: Column, risks: Column, clarity: Column, goal: Column) -> Column:
    """high / medium / low from the fit of a series."""
    wanted = F.when(goal == "machine_learning", "machine_learning_exploration").when(
        goal.isin("differential_expression", "wgcna", "validation"), goal
    )
    missed = wanted.isNotNull() & ~F.array_contains(fit["usable_for"], wanted)
    return (
        F.when(F.size(fit["usable_for"]) == 0, "low")
        .when(missed, F.when(clarity != "low", "medium").otherwise("low"))
        .when((clarity == "high") & (F.size(risks) <= 1), "high")
        .when((F.size(fit["not_recommended_for"]) >= 3) | F.array_contains(risks, "multiple_organisms"), "low")
        .otherwise("medium")
    )
