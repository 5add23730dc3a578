"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Nearness is the inner product of integer vectors.  A further coordinate lifts every vector to the same norm M, so that a score s of
an anchor a is the distance sqrt(|a|^2 + M^2 - 2 s) and a window of scores is an annulus around the anchor.

A node of the tree has several split points; every vector goes to the nearest one (the hyperplanes between them are the borders),
and for each pair of split points i, j the node keeps the least and the greatest distance from i to the vectors under j.  A vector
at distance t from i can lie in an annulus with radii r <= R around an anchor at distance d from i only if max(d - R, r - d) <= t <= d + R; if
the range of (i, j) misses that interval for any i, the subtree of j is passed over.  Leaves compare exact integer scores.

The root is spread over the cluster: its split points come from a bounded sample, every vector is assigned to its region, and each
region is dealt by hash into pieces of bounded size that hold the rest of the tree.  An anchor first searches its own region; what it
finds there narrows the annulus, and only regions whose ranges meet it are searched then.  The results are exact.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from helixframe.llm.common import written

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
LEAST = -(2**63)
MOST = 2**63 - 1


@dataclass(frozen=True)
class Shape:
    """regions: split points of the root; sample: vectors they are chosen from, on average; arity, leaf: of the nodes below; rows of a piece; queries of a task."""

    regions: int = 32
    sample: int = 4096
    arity: int = 12
    leaf: int = 128
    piece_rows: int = 8192
    block_queries: int = 4096
    seed: int = 3


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in floating point where all sums stay below 2^53."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if bound < 2**53 else a @ b.T


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """x with the coordinate that brings its squared norm to `most`."""
    x = x.astype(float)
    return np.hstack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))[:, None]])


def gaps(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of lifted vectors to lifted split points."""
    return np.sqrt(np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * x @ points.T))


def far_apart(x: np.ndarray, rng: np.random.Generator, many: int) -> np.ndarray:
    """Indices of up to `many` different vectors: a random one, the one farthest from it, then candidates far from all before."""
    first = int(rng.integers(len(x)))
    near = gaps(x, x[[first]])[:, 0]
    chosen = [first]
    pool = rng.choice(len(x), min(len(x), 3 * many), replace=False)
    pool = np.unique(np.append(pool, int(near.argmax())))
    near = near[pool]
    while len(chosen) < many:
        at = int(near.argmax())
        # Equal vectors come out as distances of rounding error.
        if not (x[pool[at]] != x[chosen]).any(axis=1).all():
            break
        chosen.append(int(pool[at]))
        near = np.minimum(near, gaps(x[pool], x[pool[[at]]])[:, 0])
    return np.array(chosen)


def ranges(distance: np.ndarray, own: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """lo, hi of shape (split point, subtree): least and greatest distance from the point to the vectors under the subtree."""
    lo, hi = np.full((many, many), np.inf), np.full((many, many), -np.inf)
    for j in range(many):
        if (inside := distance[own == j]).size:
            lo[:, j], hi[:, j] = inside.min(axis=0), inside.max(axis=0)
    return lo, hi


def grown(x: np.ndarray, shape: Shape) -> tuple[tuple, np.ndarray]:
    """(root, order): nodes (points, lo, hi, children), leaves (start, end) over the rows in `order`."""
    rng, order = np.random.default_rng(shape.seed), []
    filled = 0

    def grow(at: np.ndarray) -> tuple:
        nonlocal filled
        points = x[at[far_apart(x[at], rng, shape.arity)]] if len(at) > shape.leaf else x[at[:1]]
        distance = gaps(x[at], points)
        own = distance.argmin(axis=1)
        if (own == own[0]).all():  # few vectors, or all equal but for rounding
            order.append(at)
            filled += len(at)
            return filled - len(at), filled
        return points, *ranges(distance, own, len(points)), [grow(at[own == j]) if (own == j).any() else None for j in range(len(points))]

    root = grow(np.arange(len(x)))
    return root, np.concatenate(order)


def meets(d: np.ndarray, lo: np.ndarray, hi: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """Whether vectors whose distances from the split points lie in [lo, hi] can be in the annuli; d: (queries, points)."""
    least = np.maximum(d - outer[:, None], inner[:, None] - d)
    return ((lo <= d + outer[:, None]) & (hi >= least)).all(axis=1)


class Asked:
    """Queries of one task: integer vectors, windows of scores, labels, and the k best rows found so far."""

    def __init__(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, label: np.ndarray, row: np.ndarray, same: bool, k: int, most: float):
        self.x, self.low, self.high, self.label, self.row, self.same, self.k = x, low, high, label, row, same, k
        self.squares = (x.astype(float) ** 2).sum(axis=1) + most
        self.slack = 1e-7 * np.sqrt(self.squares) + 1e-6
        self.score = np.full((len(x), k), LEAST)
        self.place = np.full((len(x), k), MOST)
        self.at = np.full((len(x), k), -1)
        self.compared = 0

    def from_points(self, who: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances to lifted split points."""
        return np.sqrt(np.maximum(0.0, self.squares[who, None] - 2 * self.x[who].astype(float) @ points[:, :-1].T))

    def annulus(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Radii within which a row can still be among the k best of the window."""
        wanted = np.maximum(self.low[who], self.score[who, -1]).astype(float)
        radius = lambda s: np.sqrt(np.maximum(0.0, self.squares[who] - 2 * s))
        return radius(self.high[who].astype(float)) - self.slack[who], radius(wanted) + self.slack[who]

    def compare(self, who: np.ndarray, piece: dict, start: int, end: int) -> None:
        """Exact scores against the rows of one leaf."""
        self.compared += len(who) * (end - start)
        score = products(self.x[who], piece["x"][start:end])
        fits = (piece["label"][start:end] == self.label[who, None]) == self.same
        fits &= (score >= np.maximum(self.low[who], self.score[who, -1])[:, None]) & (score <= self.high[who, None])
        fits &= piece["row"][start:end] != self.row[who, None]
        better = np.flatnonzero(fits.any(axis=1))
        if not len(better):
            return
        who = who[better]
        place = np.broadcast_to(piece["place"][start:end], (len(who), end - start))
        at = np.broadcast_to(np.arange(start, end), place.shape)
        score = np.hstack([self.score[who], np.where(fits[better], score[better], LEAST)])
        place = np.hstack([self.place[who], np.where(fits[better], place, MOST)])
        at = np.hstack([self.at[who], np.where(fits[better], at, -1)])
        best = np.lexsort((place, ~score), axis=1)[:, : self.k]  # ~ turns the order round without overflow
        self.score[who], self.place[who], self.at[who] = (np.take_along_axis(v, best, axis=1) for v in (score, place, at))

    def search(self, node: tuple | None, piece: dict, who: np.ndarray) -> None:
        if node is None or not len(who):
            return
        if len(node) == 2:
            self.compare(who, piece, *node)
            return
        points, lo, hi, children = node
        d = self.from_points(who, points)
        for j in np.argsort(d.mean(axis=0)):
            left = meets(d, lo[:, j], hi[:, j], *self.annulus(who))
            self.search(children[j], piece, who[left])


class Tree:
    """The tree over a table of (row, vec_id, label, v); see the module."""

    def __init__(self, rows: DataFrame, shape: Shape = Shape()):
        self.spark, self.shape = rows.sparkSession, shape
        square = F.aggregate(F.transform("v", lambda c: c.cast("double") * c), F.lit(0.0), lambda a, c: a + c)
        facts = rows.agg(F.count("*").alias("n"), F.max(square).alias("most"), F.max(F.size("v")).alias("width")).first()
        self.n, self.most, self.width = facts["n"], facts["most"] or 0.0, facts["width"] or 0
        if not self.n:
            return
        # About `sample` rows, whatever the table's size: their number follows from the share of hashes.
        share = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < min(1 << 30, math.ceil((1 << 30) * shape.sample / self.n))
        sample = self.matrix([r["v"] for r in rows.where(share).select("v").collect()] or [rows.select("v").first()["v"]])
        x = lifted(sample, self.most)
        self.points = x[far_apart(x, np.random.default_rng(shape.seed), shape.regions)]
        self.rows = written(self.assigned(rows), "regions")
        self.sizes = {r["region"]: r["count"] for r in self.rows.groupBy("region").count().collect()}
        self.pieces = written(self.planted(), "pieces")
        # The ranges of the root: one row a region, as many numbers as split points.
        many = len(self.points)
        self.lo, self.hi = np.full((many, many), np.inf), np.full((many, many), -np.inf)
        nearest, farthest = ([f(F.element_at(c, i + 1)).alias(f"{c}{i}") for i in range(many)] for f, c in ((F.min, "lo"), (F.max, "hi")))
        for r in self.pieces.groupBy("region").agg(*nearest, *farthest).collect():
            self.lo[:, r["region"]], self.hi[:, r["region"]] = r[1 : 1 + many], r[1 + many :]

    def matrix(self, vectors: list) -> np.ndarray:
        """Vectors of different lengths are compared over the components they share: the shorter ones get zeros."""
        return stacked(vectors, self.width)

    def assigned(self, rows: DataFrame) -> DataFrame:
        points, most, width = self.points, self.most, self.width

        def work(batches):
            for batch in batches:
                x = stacked(batch.column("v").to_pylist(), width)
                region = gaps(lifted(x, most), points).argmin(axis=1) if batch.num_rows else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region, pa.int32())], names=[*batch.schema.names, "region"])

        return rows.select("row", "vec_id", "label", "v").mapInArrow(work, "row bigint, vec_id bigint, label bigint, v array<bigint>, region int")

    def numbered_by(self, counts: dict[int, int], rows: int, *by: str) -> Column:
        """A number below ceil(count of the region / rows), by hash."""
        return F.pmod(F.xxhash64(*by), parts_of(counts, rows, 1)).cast("int")

    def planted(self) -> DataFrame:
        """One row for each piece: its tree with its vectors, and the distances of its rows from the root's split points."""
        points, most, width, shape = self.points, self.most, self.width, self.shape

        def build(key: tuple, table: pa.Table) -> pa.Table:
            x = stacked(table.column("v").to_pylist(), width)
            high = lifted(x, most)
            root, order = grown(high, shape)
            ids = table.column("vec_id")
            null = ids.is_null().to_numpy()
            ids, row = ids.fill_null(0).to_numpy(), table.column("row").to_numpy()
            place = np.empty(len(row), np.int64)
            place[np.lexsort((row, ids, null))] = np.arange(len(row))
            small = np.int32 if np.abs(x).max(initial=0) < 2**31 else np.int64
            piece = {"x": x.astype(small), "label": table.column("label").to_numpy(), "row": row, "place": place, "id": ids, "null": null}
            blob = pickle.dumps((root, {k: v[order] for k, v in piece.items()}))
            d = gaps(high, points)
            out = [[key[0].as_py()], [key[1].as_py()], [d.min(axis=0).tolist()], [d.max(axis=0).tolist()], [blob]]
            return pa.table([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["region", "salt", "lo", "hi", "tree"])

        types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
        dealt = self.rows.withColumn("salt", self.numbered_by(self.sizes, self.shape.piece_rows, "row"))
        return dealt.groupBy("region", "salt").applyInArrow(build, "region int, salt int, lo array<double>, hi array<double>, tree binary")

    def near_regions(self, queries: DataFrame) -> DataFrame:
        """queries with the regions, other than their own, that their annuli meet."""
        points, lo, hi, most, width = self.points, self.lo, self.hi, self.most, self.width

        def work(batches):
            for batch in batches:
                numbers = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "own")}
                asked = Asked(stacked(batch.column("v").to_pylist(), width), numbers["low"], numbers["high"], numbers["low"], numbers["low"], True, 1, most)
                who = np.arange(batch.num_rows)
                d, (inner, outer) = asked.from_points(who, points), asked.annulus(who)
                met = np.stack([meets(d, lo[:, j], hi[:, j], inner, outer) & (numbers["own"] != j) for j in range(len(points))], axis=1) if len(who) else np.zeros((0, 1), bool)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([np.flatnonzero(m).tolist() for m in met], pa.list_(pa.int32()))], names=[*batch.schema.names, "regions"])

        fields = "query bigint, row bigint, label bigint, v array<bigint>, own int, low bigint, high bigint"
        return queries.select("query", "row", "label", "v", "own", "low", "high").mapInArrow(work, f"{fields}, regions array<int>")

    def visit(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(query, vec_id, score, hit): of each query and piece of the regions in its column `regions`, the k best rows in the window."""
        asked = queries.withColumn("region", F.explode("regions")).drop("regions")
        loads = {r["region"]: r["count"] for r in asked.groupBy("region").count().collect()}
        salts, blocks = parts_of(self.sizes, self.shape.piece_rows, 1), parts_of(loads, self.shape.block_queries, 0)
        asked = asked.withColumn("block", self.numbered_by(loads, self.shape.block_queries, "query")).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        trees = self.pieces.select("region", "salt", "tree").where(blocks > 0).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        width, most = self.width, self.most
        schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("hit", pa.int64())])

        def probe(key: tuple, ours: pa.Table, theirs: pa.Table) -> pa.Table:
            if not len(ours) or not len(theirs):
                return schema.empty_table()
            root, piece = pickle.loads(ours.column("tree")[0].as_py())
            piece["x"] = piece["x"].astype(np.int64)
            n = {c: theirs.column(c).to_numpy() for c in ("query", "row", "label", "low", "high")}
            found = Asked(stacked(theirs.column("v").to_pylist(), width), n["low"], n["high"], n["label"], n["row"], same, k, most)
            found.search(root, piece, np.arange(len(theirs)))
            who, which = np.nonzero(found.at >= 0)
            at = found.at[who, which]
            ids = pa.array(piece["id"][at], pa.int64(), mask=piece["null"][at])
            return pa.table([pa.array(n["query"][who]), ids, pa.array(found.score[who, which]), pa.array(piece["row"][at])], schema=schema)

        return trees.groupBy("region", "salt", "block").cogroup(asked.groupBy("region", "salt", "block")).applyInArrow(probe, "query bigint, vec_id bigint, score bigint, hit bigint")

    def search(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(query, rank, vec_id, score): the k best rows of each query, of the anchor's label or of the others, with low <= score <= high.

        queries: query (unique), row and label (the anchor's), v, own (its region), low, high.  Higher scores come first, ties by
        smaller vec_id, null ids last.
        """
        order = W.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "hit")
        ranked = lambda hits: hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        home = written(ranked(self.visit(queries.withColumn("regions", F.array("own")), same, k)), "home")
        known = home.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
        narrowed = queries.join(known, "query", "left").withColumn("low", F.greatest("low", F.coalesce("kth", F.col("low")))).drop("kth")
        away = self.visit(written(self.near_regions(narrowed), "visits"), same, k)
        return ranked(home.drop("rank").unionByName(away)).drop("hit")


def stacked(vectors: list, width: int) -> np.ndarray:
    """Integer vectors as a matrix, shorter ones filled up with zeros."""
    if all(len(v) == width for v in vectors):
        return np.array(vectors, np.int64).reshape(len(vectors), width)
    return np.array([list(v) + [0] * (width - len(v)) for v in vectors], np.int64).reshape(len(vectors), width)


def parts_of(counts: dict[int, int], rows: int, otherwise: int) -> Column:
    """ceil(count of the row's region / rows)."""
    parts = F.lit(otherwise)
    for region, count in counts.items():
        parts = F.when(F.col("region") == region, -(-count // rows)).otherwise(parts)
    return parts


def hard_negatives(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    shape: Shape = Shape(), id_col: str = "vec_id", label_col: str = "label", vector_col: str = "v",
) -> DataFrame:
    """See RESULT: for each anchor and each of its first `positives` other rows of its label, the first `negatives` rows of other labels.

    vectors: integer vectors (array<bigint>); a negative's score is at least low and at most high percent of the positive's.
    Rows with a null label, a null vector or a null component take no part.  Rows of a repeated id are rows of their own: each is an
    anchor, and the others are among its candidates.  Null ids are no anchors and come last among ties.  Vectors of different
    lengths are compared over the components they share.  Scores are exact up to 2^62; components are held at what keeps them there
    (2^27 for 256 components or fewer).  Anchors without positives or without negatives give no rows, nor does an empty table.
    Other columns are ignored.
    """
    v = F.col(vector_col)
    rows = vectors.where(F.col(label_col).isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull()))
    bound = F.lit(2**27) if (widest := rows.agg(F.max(F.size(v))).first()[0] or 1) <= 256 else F.lit(math.isqrt(2**62 // widest))
    clipped = F.transform(v.cast("array<bigint>"), lambda c: F.greatest(F.least(c, bound), -bound))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), clipped.alias("v"))
    tree = Tree(written(rows, "vectors"), shape)
    if not tree.n:
        return vectors.sparkSession.createDataFrame([], RESULT)
    anchors = tree.rows.where(is_anchor(F.col("vec_id"))).select("row", F.col("vec_id").alias("anchor_id"), "label", "v", F.col("region").alias("own"))
    asked = anchors.select(F.col("row").alias("query"), "row", "label", "v", "own", F.lit(LEAST + 1).alias("low"), F.lit(MOST).alias("high"))
    near = written(tree.search(asked, True, positives).select(F.col("query").alias("row"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Positives of equal score share their window.
    windows = near.select("row", "positive_score").distinct().withColumn("query", F.monotonically_increasing_id())
    windows = written(windows, "windows")
    score = F.col("positive_score")
    rest = F.pmod(score, F.lit(100))
    whole = ((score - rest).cast("decimal(20,0)") / 100).cast("bigint")
    least, most = whole * low + F.ceil(rest * low / 100), whole * high + F.floor(rest * high / 100)
    asked = windows.join(anchors, "row").select("query", "row", "label", "v", "own", least.alias("low"), most.alias("high")).where("low <= high")
    hard = tree.search(asked, False, negatives).select("query", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = near.join(windows, ["row", "positive_score"]).join(hard, "query").join(anchors.select("row", "anchor_id"), "row")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def quantized(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, v): components floor(256 x); labels of ids divisible by 7 move on by one, modulo 10; null where a component is not finite."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    label = F.col(label_col).cast("bigint")
    label = F.when(F.col(id_col) % 7 == 0, (label % 10 + 1) % 10).otherwise(label)
    held = lambda c: F.floor(256 * F.greatest(F.least(c, F.lit(2.0**40)), F.lit(-(2.0**40)))).cast("bigint")
    return vectors.select(F.col(id_col).alias("vec_id"), label.alias("label"), F.when(finite, F.transform(x, held)).alias("v"))
