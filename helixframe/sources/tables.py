"""Delimited and JSON sources.  Every reader is a distributed scan; only the first lines are looked at to choose a format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from helixframe.functions.rules import flags
from helixframe.functions.text import strip


def sniff_separator(spark: SparkSession, path: str, candidates: str = "\t,;|", lines: int = 20) -> str:
    """Separator that splits the first lines into the most columns, evenly; tab when nothing does."""
    head = [r.value for r in spark.read.text(path).where(F.length("value") > 0).head(lines)]
    best, width = "\t", 1
    for sep in candidates:
        counts = {line.count(sep) for line in head}
        if len(counts) == 1 and (columns := counts.pop() + 1) > width:
            best, width = sep, columns
    return best


def has_header(spark: SparkSession, path: str, sep: str) -> bool:
    """A first line without any number is taken as a header."""
    first = next((r.value for r in spark.read.text(path).head(1)), "")

    def number(text: str) -> bool:
        try:
            float(text)
            return True
        except ValueError:
            return False

    return bool(first) and not any(number(x.strip().strip('"')) for x in first.split(sep))


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, header: bool | None = None, infer: bool = True) -> DataFrame:
    """Delimited table with separator and header found from its first lines."""
    sep = sep or sniff_separator(spark, path)
    header = has_header(spark, path, sep) if header is None else header
    return spark.read.option("sep", sep).option("header", header).option("inferSchema", infer).csv(path)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct identifiers of a one-column file without header."""
    rows = spark.read.option("header", False).csv(path).select(F.col("_c0").alias("gene"))
    return rows.where(F.col("gene").isNotNull() & (F.col("gene") != "NA")).distinct()


def read_run_table(spark: SparkSession, path: str, sep: str | None = ",") -> DataFrame:
    """Run metadata with trimmed names and values; `sep=None` finds tab or comma, tab when unclear."""
    sep = sep or sniff_separator(spark, path, "\t,")
    rows = spark.read.option("sep", sep).option("header", True).csv(path)
    return rows.select(*[strip(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c.strip()) for c in rows.columns if c and c.strip()])


BLAST_TABLE = "qseqid string, sseqid string, pident double, length int, qstart int, qend int, sstart int, send int, evalue double"


def read_blast_table(spark: SparkSession, path: str) -> DataFrame:
    """Nine-column alignment hits with strand and ascending target coordinates."""
    rows = spark.read.schema(BLAST_TABLE).option("sep", "\t").csv(path)
    return rows.select(
        F.col("qseqid").alias("gene"), F.col("sseqid").alias("target"), F.when(F.col("sstart") < F.col("send"), "+").otherwise("-").alias("strand"), "qstart", "qend",
        F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end"), F.col("pident").alias("identity"), "evalue", F.col("length").alias("aln_len"),
    )


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    """Alignment blocks: query and target intervals (half-open) and strand."""
    rows = spark.read.option("sep", "\t").csv(path)
    names = {"_c0": "query", "_c2": "start", "_c3": "end", "_c4": "strand", "_c5": "target", "_c7": "target_start", "_c8": "target_end"}
    numbers = {"start", "end", "target_start", "target_end"}
    return rows.select(*[(F.col(c).cast("long") if n in numbers else F.col(c)).alias(n) for c, n in names.items()])


COVERAGE_TABLE = "rname string, startpos long, endpos long, numreads long, covbases long, coverage double, meandepth double, meanbaseq double, meanmapq double"


def read_coverage_table(spark: SparkSession, path: str) -> DataFrame:
    """Per-target coverage; rows with fewer than nine columns are left out."""
    rows = spark.read.schema(COVERAGE_TABLE).option("sep", "\t").option("comment", "#").csv(path)
    return rows.where(F.col("meanmapq").isNotNull()).select(
        "rname", F.col("startpos").alias("start"), F.col("endpos").alias("end"), F.col("numreads").alias("reads"), F.col("covbases").alias("covered_bases"),
        F.col("coverage").alias("breadth_percent"), F.col("meandepth").alias("mean_depth"), F.col("meanbaseq").alias("mean_baseq"), F.col("meanmapq").alias("mean_mapq"),
    )


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """Annotation rows with their attributes as a map; `problem` names what is wrong with a row."""
    text = spark.read.text(path).where((strip("value") != "") & ~F.col("value").startswith("#"))
    cells = text.select(F.split("value", "\t").alias("c"))
    attributes = F.str_to_map(F.rtrim(F.get("c", F.lit(8)), F.lit(";")), F.lit(";"), F.lit("="))
    rows = cells.select(
        F.get("c", F.lit(0)).alias("record_id"), F.get("c", F.lit(2)).alias("type"), F.expr("try_cast(get(c, 3) AS BIGINT)").alias("start"),
        F.expr("try_cast(get(c, 4) AS BIGINT)").alias("end"), F.get("c", F.lit(6)).alias("strand"), F.get("c", F.lit(7)).alias("phase"), attributes.alias("attributes"), F.size("c").alias("_n"),
    )
    problem = F.when(F.col("_n") != 9, "columns").when(F.col("start").isNull() | F.col("end").isNull(), "coordinates").when((F.col("start") < 1) | (F.col("end") < F.col("start")), "interval")
    return rows.select("record_id", "type", F.try_element_at("attributes", F.lit("Name")).alias("name"), "start", "end", "strand", "phase", "attributes", problem.alias("problem"))


def read_json_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects): one JSON document per file; duplicate keys, NaN and malformed text are rejected."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = files.withColumn("_v", F.try_parse_json("value"))
    rejects = parsed.where(F.col("_v").isNull()).select("path", F.lit("malformed_json").alias("problem"))
    good = parsed.where(F.col("_v").isNotNull()).select("path", F.from_json("value", schema).alias("d"))
    return good.select("path", "d.*"), rejects


EDIT_FILE = "changes array<struct<sequence_id:string,position:bigint,old:string,new:string,evidence:string,rationale:string>>"


def read_edits(spark: SparkSession, path: str, schema: str = EDIT_FILE) -> tuple[DataFrame, DataFrame]:
    """(edits, rejects): one row per change; a file without changes is rejected."""
    documents, rejects = read_json_documents(spark, path, schema)
    empty = documents.where(F.coalesce(F.size("changes"), F.lit(0)) <= 0).select("path", F.lit("no_changes").alias("problem"))
    return documents.select("path", F.posexplode("changes").alias("ord", "c")).select("path", "ord", "c.*"), rejects.unionByName(empty)


EXCEPTION_FILE = "exceptions array<struct<gene:string,codon:string,amino_acid:string,codon_index:bigint,pos:string,scope:string,transl_table:bigint,taxon:string,source:string,rationale:string>>"


def read_exceptions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of audited exceptions; check them with `registry_findings`."""
    documents, rejects = read_json_documents(spark, path, EXCEPTION_FILE)
    return documents.select("path", F.posexplode("exceptions").alias("ord", "e")).select("path", "ord", "e.*"), rejects


PROFILE_FILE = "format string, profiles array<struct<scientific_name:string,ncbi_taxon_id:bigint,lineage:array<string>,mitochondrial_code:struct<table:int,status:string,auto_select:boolean>>>"


def read_taxon_profiles(spark: SparkSession, path: str) -> DataFrame:
    documents, _ = read_json_documents(spark, path, PROFILE_FILE)
    rows = documents.select(F.explode("profiles").alias("p"))
    return rows.select(F.col("p.scientific_name").alias("name"), "p.ncbi_taxon_id", "p.lineage", F.col("p.mitochondrial_code.table").alias("genetic_code"), F.col("p.mitochondrial_code.status").alias("code_status"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of every file."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


# -- line ordinals ---------------------------------------------------------------------------------


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their 0-based number inside each file, without sorting a file in one task.

    Rows of one file block are consecutive, so a line's place in its block is its row number minus the first
    one of the block; blocks are then offset by the sizes of the earlier blocks of the file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), "value"
    )
    blocks = lines.groupBy("path", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    offsets = blocks.select("path", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return lines.join(offsets, ["path", "_block"]).select("path", (F.col("_before") + F.col("_row") - F.col("_first")).alias("line"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Four-line records in file order with what is wrong with them (`findings`); a bad record refuses its file."""
    lines = numbered_lines(spark, path)
    at = lambda i: F.max(F.when(F.col("line") % 4 == i, F.rtrim("value"))).alias(f"_l{i}")
    records = lines.groupBy("path", F.floor(F.col("line") / 4).alias("ord")).agg(F.count("*").alias("_n"), *[at(i) for i in range(4)])
    records = records.where(~((F.col("_n") == 1) & (F.col("_l0") == "")))
    name = F.regexp_extract("_l0", r"^@(\S+)", 1)
    seq, qual = F.upper("_l1"), F.col("_l3")
    found = flags(
        (F.col("_n") < 4, "truncated"), (name == "", "header"), (~F.coalesce(F.col("_l2").startswith("+"), F.lit(False)), "separator"),
        (F.length("_l1") != F.length("_l3"), "length"), (~seq.rlike("^[ACGTRYSWKMBDHVN]+$"), "sequence"), (~qual.rlike("^[!-~]+$"), "quality"),
    )
    return records.select("path", "ord", name.alias("id"), seq.alias("seq"), qual.alias("qual"), found.alias("findings"))
