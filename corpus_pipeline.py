"""A training corpus from raw documents: quality rules, near-dedup, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from helixframe.llm import minhash_dedup, mixture, packing, quality_bands, secret_ownership
from helixframe.llm.common import dropped, noted, numbered, unused, written

#: Intermediate tables of each stage's latest call, by the folder that it worked for.
_tables: dict[tuple[str, str], list[str]] = {}


def _after(before: str | None):
    """A stage that first deletes the intermediate tables of the stage before, if that one's result has been written and read again.

    `docs` that still read one of those tables keep them.
    """

    def wrap(stage):
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            earlier = _tables.pop((sf_dir, before), [])
            read = docs.inputFiles() if earlier else []
            if not any(path.rsplit("/", 1)[-1] in file for path in earlier for file in read):
                dropped(spark, earlier)
            with noted() as paths:
                result = stage(spark, docs, sf_dir)
            _tables[sf_dir, stage.__name__] = paths
            return result

        run_stage.__doc__ = stage.__doc__
        return run_stage

    return wrap


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column of unique numbers under a name of its own."""
    (name,) = unused(docs, "pipeline_row")
    return numbered(docs, name), name


def _as_before(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`; n_chars, where there is one, follows the text."""
    return df.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


@_after(None)
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep; labels calibrate the bands where the folder has them."""
    try:
        labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        labels = None
    return quality_bands.keep_good(docs, labels=labels)


@_after("quality")
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    rows, row = _numbered(docs)
    result = minhash_dedup.Deduplicator(rows, row_col=row).result()
    kept = result.where("kept").select(F.col("row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


@_after("near_dedup")
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live-looking secrets of few owners are masked, widely copied examples stay."""
    rows, row = _numbered(docs)
    return _as_before(secret_ownership.mask_live(rows, secret_ownership.scan_secrets(rows, row_col=row), row), docs)


@_after("secrets")
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for each pass over a document, with the words that the pass takes."""
    rows, row = _numbered(docs)
    return _as_before(mixture.Mixture(rows, row_col=row).texts(rows, row), docs)


@_after("mixing")
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("packing", packed)]

#: Compression, MinHash classes and tokenisation have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
