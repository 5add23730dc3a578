"""Nearest neighbours by multi-index hashing over learned binary codes.

Codes are signs of a learned rotation of the vectors (principal axes, then the rotation that brings them closest to their own
signs).  A code is split into substrings, and each substring has an index: vectors grouped by the substring's value.  Two codes
within a Hamming radius agree within floor(radius / substrings) bits in at least one substring (pigeonhole), so looking up all values that
near in every index retrieves every code within the radius.  What is retrieved is ranked by the inner product of the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from helixframe.llm.common import written

BITS = 8  # of a substring


@dataclass(frozen=True)
class Training:
    """sample: most vectors that the rotation is learned from; recall: wanted on the sample when the radius is chosen."""

    sample: int = 10_000
    queries: int = 200
    recall: float = 0.97
    rounds: int = 30
    seed: int = 5


@dataclass
class Codes:
    """Codes of n substrings of 8 bits: sign(x @ rotation - shift)."""

    rotation: np.ndarray
    shift: np.ndarray
    radius: int

    @property
    def substrings(self) -> int:
        return self.rotation.shape[1] // BITS

    def of(self, x: np.ndarray) -> np.ndarray:
        """(rows, substrings) bytes."""
        return np.packbits(x @ self.rotation - self.shift > 0, axis=1)


COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all codes in `a` to all in `b`."""
    total = np.zeros((len(a), len(b)), np.uint8)
    for j in range(a.shape[1]):
        total += COUNT[a[:, j, None] ^ b[None, :, j]]
    return total


def learn(x: np.ndarray, k: int, how: Training) -> Codes:
    """The rotation from a sample, and the least radius that finds the sample's own k nearest often enough.

    Neighbours in the whole table are nearer than those in a sample of it, so the radius errs on the wide side.
    """
    width = max(BITS, x.shape[1] // BITS * BITS)
    if not len(x):
        return Codes(np.zeros((x.shape[1], width)), np.zeros(width), width)
    mean = x.mean(axis=0)
    rng = np.random.default_rng(how.seed)
    _, _, axes = np.linalg.svd((x - mean).T @ (x - mean))
    axes = np.vstack([axes, rng.normal(size=(max(0, width - len(axes)), x.shape[1]))])[:width].T
    v = (x - mean) @ axes
    turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
    for _ in range(how.rounds):
        u, _, w = np.linalg.svd(np.sign(v @ turn).T @ v)
        turn = w.T @ u.T
    codes = Codes(axes @ turn, mean @ axes @ turn, width)
    picked = rng.permutation(len(x))[: how.queries]
    scores = x[picked] @ x.T
    scores[np.arange(len(picked)), picked] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(k, len(x) - 1)]
    if near.size:
        found = np.take_along_axis(distances(codes.of(x[picked]), codes.of(x)), near, axis=1)
        codes.radius = int(np.sort(found.ravel())[min(found.size - 1, int(np.ceil(how.recall * found.size)) - 1)])
    return codes


def words_of(code: np.ndarray) -> np.ndarray:
    """Codes as 64-bit words, for counting differing bits eight substrings at a time."""
    pad = -code.shape[1] % 8
    return np.ascontiguousarray(np.pad(code, ((0, 0), (0, pad)))).view(np.uint64)


def search_group(members: tuple[np.ndarray, np.ndarray], queries: tuple[np.ndarray, np.ndarray, np.ndarray], codes: Codes, radius: int, k: int):
    """(query, class, score) of the k best classes of a block that the indexes retrieve, by probing their posting lists.

    Each substring's index marks what its near values hold; a class that several indexes retrieve is ranked once.
    """
    cids, x = members
    qids, own, qx = queries
    reach = radius // codes.substrings
    code, qcode = codes.of(x), codes.of(qx)
    whole, asked = words_of(code), words_of(qcode)
    lists = []
    for j in range(codes.substrings):
        order = np.argsort(code[:, j], kind="stable")
        values, begin = np.unique(code[order, j], return_index=True)
        lists.append([(value, order[start:end]) for value, start, end in zip(values, begin, np.r_[begin[1:], len(order)], strict=True)])
    for start in range(0, len(qids), 128):
        q, c, w = (v[start : start + 128] for v in (qx, qcode, asked))
        hit = np.zeros((len(q), len(x)), bool)
        for j, postings in enumerate(lists):
            for value, held in postings:
                probing = np.flatnonzero(COUNT[c[:, j] ^ value] <= reach)
                if len(probing):
                    hit[probing[:, None], held[None, :]] = True
        differing = np.zeros(hit.shape, np.uint16)
        for i in range(whole.shape[1]):
            differing += np.bitwise_count(w[:, i, None] ^ whole[None, :, i])
        hit &= differing <= radius
        hit &= own[start : start + 128, None] != cids[None, :]  # a query's own class is added later
        score = np.where(hit, q @ x.T, -np.inf)
        width = min(k, score.shape[1])
        best = np.argpartition(-score, width - 1, axis=1)[:, :width]
        row, col = np.nonzero(np.isfinite(np.take_along_axis(score, best, axis=1)))
        yield qids[start : start + 128][row], cids[best[row, col]], score[row, best[row, col]]


class Index:
    """The vectors of a table by class (equal vectors are one class) and the searches over them."""

    def __init__(self, vectors: DataFrame, k: int = 20, how: Training = Training(), group_rows: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding"):
        """Vectors that are null, zero or hold null or non-finite components take no part, nor do those of another length than the most frequent one.

        Rows of a repeated id are rows of their own; rows with a null id are left out; other columns are ignored; an empty table gives an empty result.
        """
        self.k, self.group_rows = k, group_rows
        v = F.col(vector_col).cast("array<double>")
        whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = vectors.where(F.col(id_col).isNotNull() & whole & F.exists(v, lambda x: x != 0)).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        rows = written(rows, "vectors")
        common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
        self.dimension = common["d"] if common else BITS
        rows = rows.where(F.size("v") == self.dimension)
        classes = rows.groupBy("v").agg(F.min("row").alias("cid"))
        self.classes = written(classes.select("cid", "v"), "classes")
        self.members = written(rows.join(self.classes, "v").select("row", "vec_id", "cid"), "members")
        sample = self.classes.orderBy(F.xxhash64("cid")).limit(how.sample).select("v").toPandas()["v"]
        self.codes = learn(np.array(sample.tolist(), float).reshape(-1, self.dimension), k, how)

    def search(self, queries: DataFrame, radius: int | None = None) -> DataFrame:
        """(query_id, cid, score): each query's k best classes among those that the radius retrieves.

        queries: query_id, own (its class), v.  Classes and queries are dealt by hash into blocks of about `group_rows`; a task
        holds one block of each, with an index of its classes for every substring, and returns k rows a query.
        """
        radius, codes, k = self.codes.radius if radius is None else radius, self.codes, self.k
        pieces = max(1, -(-self.classes.count() // self.group_rows))
        blocks = max(1, -(-queries.count() // self.group_rows))
        numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        index = self.classes.withColumn("piece", F.pmod(F.xxhash64("cid"), F.lit(pieces)).cast("int")).withColumn("block", numbers(blocks))
        asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("piece", numbers(pieces))

        def probe(key, own: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            members = own["cid"].to_numpy(), np.array(own["v"].tolist(), float).reshape(len(own), -1)
            wanted = theirs["query_id"].to_numpy(), theirs["own"].to_numpy(), np.array(theirs["v"].tolist(), float).reshape(len(theirs), -1)
            if not len(own) or not len(theirs):
                return pd.DataFrame({"query_id": [], "cid": [], "score": []})
            found = list(search_group(members, wanted, codes, radius, k))
            hits = pd.DataFrame({name: np.concatenate([f[i] for f in found]) for i, name in enumerate(("query_id", "cid", "score"))})
            return hits.sort_values(["query_id", "score", "cid"], ascending=[True, False, True]).groupby("query_id").head(k)

        by = ["piece", "block"]
        hits = index.select(*by, "cid", "v").groupBy(*by).cogroup(asked.select(*by, "query_id", "own", "v").groupBy(*by)).applyInPandas(probe, "query_id long, cid long, score double")
        best = W.partitionBy("query_id").orderBy(F.desc("score"), "cid")
        return hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")

    def neighbours(self, divisor: int = 20) -> DataFrame:
        """query_id, rank, vec_id, score for the rows whose id is divisible by `divisor`, against every other row.

        Ties go to the smaller vec_id.  Queries for which the radius retrieves fewer than k rows are searched once more without one.
        """
        k = self.k
        asking = self.members.where(F.col("vec_id") % divisor == 0)
        queries = asking.select(F.col("row").alias("query_id"), F.col("vec_id").alias("asked"), F.col("cid").alias("own"))
        queries = written(queries.join(self.classes, F.col("own") == F.col("cid")).select("query_id", "asked", "own", "v"), "queries")
        # Of a class, no query needs more than its k + 1 smallest ids.
        inside = W.partitionBy("cid").orderBy("vec_id", "row")
        first = written(self.members.withColumn("place", F.row_number().over(inside)).where(F.col("place") <= k + 1).select("cid", "vec_id", "row"), "first")
        dot = F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0), lambda a, x: a + x)
        same = queries.select("query_id", F.col("own").alias("cid"), dot.alias("score"))

        def ranked(hits: DataFrame) -> DataFrame:
            rows = hits.unionByName(same).join(first, "cid").where("row <> query_id")
            best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row")
            return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

        found = written(ranked(self.search(queries)), "found")
        others = self.members.count() - 1
        short = queries.join(found.groupBy("query_id").count().where(F.col("count") >= min(k, others)).select("query_id"), "query_id", "left_anti")
        short = written(short, "short")
        if short.limit(1).count():
            again = ranked(self.search(short, self.codes.rotation.shape[1])).join(short.select("query_id"), "query_id", "left_semi")
            found = found.join(short.select("query_id"), "query_id", "left_anti").unionByName(again)
        return found.join(queries.select("query_id", "asked"), "query_id").select(F.col("asked").alias("query_id"), "rank", "vec_id", "score")


def nearest(vectors: DataFrame, divisor: int = 20, **options) -> DataFrame:
    """See `Index` and `Index.neighbours`."""
    return Index(vectors, **options).neighbours(divisor)
