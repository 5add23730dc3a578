"""Session helpers: one place for configuration and for cutting lineage."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def get_session(app: str = "helixframe", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; `master` is only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the session names in `spark.checkpoint.dir`.

    Only a local session (tests, one machine) may leave the setting out and gets a temporary folder; on a
    cluster, where executors share no local disk, a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
    return spark.conf.get("spark.checkpoint.dir")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the reliable checkpoint directory (see `shared_dir`)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


ROWS_A_TASK = 250_000


def spread(df: DataFrame, keys: list[str], rows: int, rows_a_task: int | None = None) -> DataFrame:
    """`df` dealt by `keys` over a number of tasks that grows with `rows`, so that a task's rows stay bounded.

    Joins and groupings by the same keys keep that number; never fewer than the session's shuffle partitions.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(rows / (rows_a_task or ROWS_A_TASK))), *keys)


def global_rank(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """1-based position of every row inside its `keys` group, without one task per group.

    Rows are range-partitioned and sorted on (keys, order), so a hot group is spread over many tasks.
    The sorted rows are checkpointed with their partition number and offset; the position is then the
    offset plus the number of rows of the same group in earlier partitions (one small row per
    partition and group).  `order` must be a total order inside a group.
    """
    keyed = [F.col(k) for k in keys]
    laid = (
        df.repartitionByRange(*keyed, *order)
        .sortWithinPartitions(*keyed, *order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_off", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    laid = cut_lineage(laid)
    blocks = laid.groupBy(*keys, "_pid").agg(F.count("*").alias("_rows"), F.min("_off").alias("_first"))
    before = W.partitionBy(*keys).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_pid").alias("_bpid"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    match = F.col("_pid") == F.col("_bpid")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    drop = ["_pid", "_bpid", "_off", "_first", "_before", *[f"_k{i}" for i in range(len(keys))]]
    return laid.join(blocks, match).withColumn(name, F.col("_before") + F.col("_off") - F.col("_first") + 1).drop(*drop)
