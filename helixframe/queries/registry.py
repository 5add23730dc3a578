"""Registered queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy access to the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run SQL that names tables as {table}."""
        text = text.replace("{G}", "")
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def duck(text: str) -> str:
    """The same SQL with plain table names; {G} is the replace-all flag that only DuckDB needs."""
    text = text.replace("{G}", ", 'g'")
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def query(name: str, sql: str | None = None):
    """Register a function of (Tables) under `name`, with its oracle SQL if there is one."""

    def wrap(fn):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return fn(Tables(spark, directory))

        run.__name__ = fn.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = duck(sql)
        return fn

    return wrap
