"""Catalogue summaries: one JSON payload per row to one record per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixframe.functions import text as tx
from helixframe.functions.text import strip


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Saved summary documents, one per line; malformed lines become NULL payloads."""
    return spark.read.text(path).where(strip("value") != "").select(F.try_parse_json("value").alias("payload"))


def raw(payload: Column, name: str) -> Column:
    return F.try_variant_get(payload, f"$.{name}", "string")


def first_text(payload: Column, *names: str) -> Column:
    """First non-empty spelling of a field."""
    return F.coalesce(*[F.nullif(strip(raw(payload, n)), F.lit("")) for n in names], F.lit(""))


def kind(payload: Column, name: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(payload, f"$.{name}", "variant")), F.lit("VOID"))


KEYS = ("accession", "name", "title", "value", "label")


def named_value(item: Column, keys=KEYS[:4]) -> Column:
    """Text of a list or object member: the first of its naming keys, or the value itself."""
    is_object = F.schema_of_variant(item).startswith("OBJECT")
    named = F.coalesce(*[F.nullif(strip(F.try_variant_get(item, f"$.{k}", "string")), F.lit("")) for k in keys], F.lit(""))
    return F.when(is_object, named).otherwise(strip(F.coalesce(F.try_variant_get(item, "$", "string"), F.lit(""))))


def flat_text(payload: Column, name: str, keys=KEYS[:4]) -> Column:
    """Text of a field that may be text, a list or an object; list members are joined by '; '."""
    k = kind(payload, name)
    items = F.coalesce(F.try_variant_get(payload, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))
    joined = F.array_join(F.filter(F.transform(items, lambda i: named_value(i, keys)), lambda t: F.coalesce(t, F.lit("")) != ""), "; ")
    member = named_value(F.try_variant_get(payload, f"$.{name}", "variant"), keys)
    return F.when(k.startswith("ARRAY"), joined).when(k.startswith("OBJECT"), member).otherwise(strip(F.coalesce(raw(payload, name), F.lit(""))))


def digits(payload: Column, name: str) -> Column:
    value = raw(payload, name)
    return F.when(value.rlike("^[0-9]+$"), value.cast("long"))


def series_records(payloads: DataFrame) -> DataFrame:
    """Expression-series records; the sample count is the first numeric field, else the length of the sample list."""
    p = F.col("payload")
    list_size = lambda n: F.size(F.try_variant_get(p, f"$.{n}", "array<variant>"))
    taxa = F.try_variant_get(p, "$.taxon", "array<string>")
    taxon = F.when(kind(p, "taxon").startswith("ARRAY"), F.array_join(F.filter(F.transform(taxa, lambda t: strip(t)), lambda t: t != ""), ", ")).otherwise(first_text(p, "taxon"))
    platform = F.coalesce(*[F.nullif(tx.platform(flat_text(p, n)), F.lit("")) for n in ("GPL", "gpl", "platform", "Platform")], F.lit(""))
    projects = F.coalesce(F.nullif(first_text(p, "bioproject"), F.lit("")), F.nullif(flat_text(p, "Projects"), F.lit("")), flat_text(p, "projects"))
    samples = F.coalesce(
        *[F.when(~kind(p, n).startswith("ARRAY"), digits(p, n)) for n in ("n_samples", "nSamples", "samples", "Samples", "sample_count")],
        *[F.when(kind(p, n).startswith("ARRAY") & (list_size(n) > 0), list_size(n).cast("long")) for n in ("samples", "Samples")],
    )
    return payloads.select(
        first_text(p, "uid", "Id").alias("uid"), first_text(p, "accession", "Accession").alias("accession"), first_text(p, "title").alias("title"), first_text(p, "summary").alias("summary"),
        taxon.alias("taxon"), first_text(p, "entryType", "entrytype").alias("entry_type"), first_text(p, "gdsType", "gdstype").alias("gds_type"), platform.alias("platform"), samples.alias("samples"),
        first_text(p, "PDAT", "pdat").alias("publication_date"), first_text(p, "suppfile", "suppFile").alias("supplemental_files"), first_text(p, "ftplink", "FTPLink").alias("ftp_link"), projects.alias("bioproject"),
    )


def study_records(payloads: DataFrame) -> DataFrame:
    """Sequencing-archive records: accessions of five levels from the embedded XML, study first."""
    p = F.col("payload")
    rows = payloads.select("payload", F.coalesce(F.nullif(flat_text(p, "ExpXml", KEYS), F.lit("")), flat_text(p, "expxml", KEYS)).alias("_x"), F.coalesce(F.nullif(flat_text(p, "Runs", KEYS), F.lit("")), flat_text(p, "runs", KEYS)).alias("_r"))
    x, r = F.col("_x"), F.col("_r")
    either = lambda names, pattern: F.coalesce(F.nullif(first_text(p, *names), F.lit("")), tx.capture(x, pattern))
    level = lambda tag: tx.capture(x, f'<{tag} acc="([^"]+)"')
    rows = rows.select(
        first_text(p, "uid", "Id").alias("uid"), level("Study").alias("study_accession"), level("Experiment").alias("experiment_accession"), level("Sample").alias("sample_accession"),
        F.regexp_extract_all(r, F.lit(r'(?i)acc="(SRR\d+)"'), 1).alias("_runs"), either(("accession", "Accession"), '<Submitter acc="([^"]+)"').alias("submitter_accession"),
        either(("title", "Title"), "<Title>([^<]+)</Title>").alias("title"), first_text(p, "summary", "Summary").alias("summary"), either(("organism", "Organism"), 'ScientificName="([^"]+)"').alias("organism"),
        either(("library_strategy", "LibraryStrategy"), "LIBRARY_STRATEGY>([^<]+)<").alias("library_strategy"), either(("library_layout", "LibraryLayout"), r"LIBRARY_LAYOUT>\s*<([^ >/]+)").alias("library_layout"),
        either(("platform", "Platform"), r'Platform[^>]*instrument_model="([^"]+)"').alias("platform"), either(("bioproject", "Bioproject"), r"\b(PRJ[EDN][A-Z]?\d+)\b").alias("bioproject"),
        either(("biosample", "Biosample"), r"\b(SAM[END][A-Z]?\d+)\b").alias("biosample"), digits(p, "sample_count").alias("_sc"), digits(p, "run_count").alias("_rc"), r.alias("_r"),
    )
    first_run = F.coalesce(F.get("_runs", F.lit(0)), F.lit(""))
    pick = lambda *cols: F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))
    source = (
        F.when(F.col("study_accession") != "", "study").when(F.col("experiment_accession") != "", "experiment").when(first_run != "", "run").when(F.col("sample_accession") != "", "sample").otherwise("study")
    )
    rows = rows.withColumn("source_type", source)
    return rows.select(
        "uid", pick(F.col("study_accession"), F.col("experiment_accession"), first_run, F.col("sample_accession"), F.col("submitter_accession")).alias("accession"), "source_type", "study_accession",
        "experiment_accession", "sample_accession", F.transform("_runs", lambda v: F.upper(v)).alias("run_accessions"), "submitter_accession", "title", "summary", "organism", "library_strategy", "library_layout", "platform",
        F.coalesce("_sc", F.when((F.col("biosample") != "") & (F.col("source_type") != "study"), 1)).cast("long").alias("sample_count"), F.coalesce(F.col("_rc"), tx.count_runs(F.col("_r"))).alias("run_count"), "bioproject", "biosample",
    )


# Organisms recognised in free text.
ORGANISMS = r"(Homo sapiens|Gallus gallus|Mus musculus|Sus scrofa|Bos taurus)"


def project_records(payloads: DataFrame) -> DataFrame:
    """Project records; linked accessions are mined from all values of the payload."""
    p = F.col("payload")
    # Values only: key names and escapes are blanked so that they cannot touch an accession.
    blob = F.regexp_replace(F.regexp_replace(F.to_json(p), r'"(?:[^"\\]|\\.)*"\s*:', " "), r"\\[nrtbf\\/\"]", " ")
    rows = payloads.select(
        "payload", blob.alias("_b"), first_text(p, "uid", "Id").alias("uid"), first_text(p, "Project_Acc", "project_acc", "accession", "Accession").alias("accession"),
        first_text(p, "Project_Title", "project_title", "Project_Name", "title", "Title").alias("title"), first_text(p, "Project_Description", "project_descr", "description", "Description").alias("summary"),
        first_text(p, "Organism", "Organism_Name", "Organism_Label").alias("_o"),
    )
    found = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("_b", F.lit("(?i)" + ORGANISMS), 1))), "; ")
    return rows.select(
        "uid", "accession", "title", "summary", F.when(F.col("_o") != "", F.col("_o")).otherwise(found).alias("organism"), tx.mine_sorted(F.col("_b"), tx.SRA_PATTERN).alias("linked_sra"),
        tx.mine_sorted(F.col("_b"), tx.SAMPLE_PATTERN).alias("linked_biosamples"),
    )
