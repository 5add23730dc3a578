"""Sequences as tiles: what needs a few letters of a long sequence meets the tiles that hold them, not the sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TILE = 10_000


def tiles(records: DataFrame, keys: list[str], seq: str = "seq", width: int = TILE, empty: bool = False) -> DataFrame:
    """(keys, tile, piece): upper-case sequences in pieces of `width` letters, cut in one pass; empty ones have none, or with `empty` an empty first one."""
    pieces = F.regexp_extract_all(F.upper(seq), F.lit("(?s).{1,%d}" % width), F.lit(0))
    if not empty:
        return records.select(*keys, F.posexplode(pieces).alias("tile", "piece"))
    cut = records.select(*keys, F.posexplode_outer(pieces).alias("tile", "piece"))
    return cut.select(*keys, F.coalesce("tile", F.lit(0)).alias("tile"), F.coalesce("piece", F.lit("")).alias("piece"))


def slices(places: DataFrame, records: DataFrame, keys: list[str], seq: str = "seq", width: int = TILE) -> DataFrame:
    """(keys, start, end, slice) of every distinct place (0-based, end exclusive) with a letter inside its sequence.

    A place meets as many tiles as it touches, and each tile is sent once, however many places lie on it.
    """
    wanted = places.select(*keys, "start", "end").where((F.col("end") > F.col("start")) & (F.col("end") > 0)).distinct()
    touched = F.sequence(F.floor(F.greatest("start", F.lit(0)) / width), F.floor((F.col("end") - 1) / width))
    wanted = wanted.withColumn("tile", F.explode(touched))
    held = tiles(records, keys, seq, width).withColumn("tile", F.col("tile").cast("bigint"))
    low = F.greatest(F.col("start") - F.col("tile") * width, F.lit(0))
    part = F.col("piece").substr((low + 1).cast("int"), (F.least(F.col("end") - F.col("tile") * width, F.lit(width)) - low).cast("int"))
    parts = wanted.join(held, [*keys, "tile"]).select(*keys, "start", "end", F.struct("tile", part.alias("part")).alias("_p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda p: p["part"]), "")
    return parts.groupBy(*keys, "start", "end").agg(joined.alias("slice"))
