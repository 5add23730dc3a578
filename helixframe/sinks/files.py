"""File sinks.  Spark's commit protocol makes a write all or nothing; existing output is never replaced silently."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_results(results: DataFrame, path: str, partition_by: list[str] | None = None, form: str = "csv", mode: str = "errorifexists") -> None:
    """Result table per collection; array columns are joined by '/' for CSV."""
    if form == "csv":
        arrays = {name for name, kind in results.dtypes if kind.startswith("array")}
        results = results.select(*[F.array_join(c, "/").alias(c) if c in arrays else F.col(c) for c in results.columns])
    writer = results.write.mode(mode).partitionBy(*(partition_by or []))
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def write_payload(records: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Records as JSON lines; returns the one-row count summary."""
    records.write.mode(mode).json(path)
    return records.agg(F.count("*").alias("records"))


def write_located_genes(hits: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Located genes as TSV in order of their start (a range sort over all tasks)."""
    hits.orderBy("target", "start", "gene").write.mode(mode).option("sep", "\t").option("header", False).csv(path)


def fasta_lines(records: DataFrame, width: int = 60) -> DataFrame:
    """FASTA text per record, sequence wrapped at `width`."""
    wrapped = F.regexp_replace("seq", "(.{%d})(?=.)" % width, "$1\n")
    return records.select(F.concat(F.lit(">"), F.col("id"), F.lit("\n"), wrapped).alias("value"))


def write_fasta(records: DataFrame, path: str, width: int = 60, mode: str = "errorifexists") -> None:
    fasta_lines(records, width).write.mode(mode).text(path)


def write_fastq(reads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """FASTQ text, one directory per mate; both mates keep the order of their names."""
    lines = reads.select("mate", "name", F.concat(F.lit("@"), F.col("name"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual")).alias("value"))
    placed = lines.repartitionByRange("mate", "name").sortWithinPartitions("mate", "name")
    placed.select("mate", "value").write.mode(mode).partitionBy("mate").text(path)


def write_features(features: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Features as GFF rows: 1-based closed coordinates, one row per segment."""
    rows = features.select("record_id", "type", "gene", "strand", F.explode("segments").alias("s"))
    text = F.concat_ws(
        "\t", "record_id", F.lit("."), "type", (F.col("s.start") + 1).cast("string"), F.col("s.end").cast("string"), F.lit("."),
        F.when(F.col("strand") < 0, "-").otherwise("+"), F.lit("."), F.concat(F.lit("Name="), F.coalesce("gene", F.lit(""))),
    )
    rows.select(text.alias("value")).write.mode(mode).text(path)
