"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixframe.session import shared_dir


#: Lists that note the tables being written, innermost last.
_noting: list[list[str]] = []


@contextmanager
def noted():
    """The list of all tables that `written` writes meanwhile, for `dropped` when nothing reads them any more."""
    _noting.append([])
    try:
        yield _noting[-1]
    finally:
        _noting.pop()


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that `written` has written, wherever the shared folder is."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _noting:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo `modulus`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % modulus


def texts(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, body) of every row, further columns after them; body is the UTF-8 text, null stays null."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("body"), *more)


def per_text(make: Callable[[], Callable[..., tuple]], schema: pa.Schema, inputs: tuple[str, ...] = ("id", "body")) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies one function to each row's inputs.

    `make` builds the function once in each task.  Rows are handed over in slices, so that no more
    than one slice of results is held beside the batch that Spark sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                rows = [one(*row) for row in zip(*(piece.column(name).to_pylist() for name in inputs), strict=True)]
                columns = list(zip(*rows, strict=True)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """`docs` written to the shared folder with a column of unique numbers, which later reads see alike."""
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of `df` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
