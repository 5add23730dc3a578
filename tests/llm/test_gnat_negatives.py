"""Hard negatives against brute force, and the share of rows that the tree compares."""

import math
import random

import duckdb
import numpy as np
import pytest
from helixframe.llm import gnat_negatives as gn
from helixframe.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row long, region int, v array<long>, score long, low long"


def brute(rows, positives=5, negatives=3):
    """Rows: (vec_id, embedding, label, ...)."""
    whole = [(i, v, y) for i, v, y, *_ in rows if y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, [math.floor(256 * float(np.float32(c))) for c in v], (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in whole]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda t: (-t[1], t[0] is None, t[0] or 0)
    out = []
    for n, (i, v, y) in enumerate(whole):
        if i is None or i % 50:
            continue
        scored = [(j, dot(v, w), z) for m, (j, w, z) in enumerate(whole) if m != n]
        for p, s, _ in sorted((t for t in scored if t[2] == y), key=order)[:positives]:
            fits = sorted((t for t in scored if t[2] != y and 50 * s <= 100 * t[1] <= 95 * s), key=order)[:negatives]
            out += [(i, p, r + 1, j, s, t) for r, (j, t, _) in enumerate(fits)]
    return sorted(out, key=repr)


def vectors(seed, n, clusters, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, 12))
    x = centres[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, 12))
    return [(i, [float(c) for c in x[i] / 4], int(rng.integers(4)), 7, 7, [7], 7, 7) for i in range(n)]


def awkward():
    rows = vectors(1, 700, 9, 0.3)
    rows += [rows[50], rows[50], rows[61], (1000, rows[100][1], None, 0, 0, [], 0, 0), (1050, None, 1, 0, 0, [], 0, 0), (1100, [0.5, None] * 6, 1, 0, 0, [], 0, 0), (1150, [float("nan")] * 12, 1, 0, 0, [], 0, 0)]
    rows += [(1200, [float("inf")] * 12, 2, 0, 0, [], 0, 0), (None, rows[50][1], rows[50][2], None, None, None, None, None), (None, rows[51][1], 3, None, None, None, None, None)]
    rows += [(1250, [0.0] * 12, 0, 0, 0, [], 0, 0), (1300, [], 1, 0, 0, [], 0, 0), (1350, [0.25, -0.5], 2, 0, 0, [], 0, 0), (-50, rows[0][1] + [1.0, -2.0], 1, 0, 0, [], 0, 0)]
    # One vector a third of all, so that ties go by id.
    return rows + [(2000 + i, rows[3][1], i % 3, 0, 0, [], 0, 0) for i in range(350)]


def test_query_equals_brute_force(spark, tmp_path):
    rows = awkward()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_gnat_negatives"](spark, str(tmp_path))
    assert got.columns[:6] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert len(want) > 100 and sorted(map(tuple, got.collect()), key=repr) == want
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(duck.execute(ORACLE["op11_gnat_negatives"]).fetchall(), key=repr) == want


def test_small_pieces_blocks_and_leaves(spark):
    rows = awkward()
    frame = gn.quantized(spark.createDataFrame(rows, SCHEMA))
    shape = gn.Shape(regions=5, sample=60, arity=3, leaf=4, piece_rows=40, block_queries=3)
    got = gn.hard_negatives(frame, lambda i: i % 50 == 0, 7, 2, shape=shape)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 7, 2)


def test_no_rows_and_no_pairs(spark):
    frame = gn.quantized(spark.createDataFrame(awkward()[:1], SCHEMA))
    assert gn.hard_negatives(frame.limit(0), lambda i: i % 50 == 0).count() == 0
    assert gn.hard_negatives(frame, lambda i: i % 50 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** rng.randrange(0, 17) for _ in range(3)], i % 2, 0, 0, [], 0, 0) for i in range(150)]
    got = gn.hard_negatives(gn.quantized(spark.createDataFrame(rows, SCHEMA)), lambda i: i % 50 == 0, shape=gn.Shape(regions=3, leaf=5))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("clusters, spread, most", [(60, 0.05, 0.15), (1, 1.0, 1.0)])
def test_ranges_spare_comparisons(clusters, spread, most):
    x = np.floor(256 * np.array([r[1] for r in vectors(5, 6000, clusters, spread)])).astype(np.int64)
    norm = float((x.astype(float) ** 2).sum(axis=1).max())
    root, order = gn.grown(gn.lifted(x, norm), gn.Shape(leaf=32))
    label = np.arange(len(x)) % 4
    piece = {"x": x[order], "label": label[order], "row": order, "place": order}
    who = np.arange(0, len(x), 50)
    asked = gn.Asked(x[who], np.full(len(who), gn.LEAST + 1), np.full(len(who), gn.MOST), label[who], who, True, 5, norm)
    for q in range(len(who)):
        asked.search(root, piece, np.array([q]))
    scores = x[who] @ x.T
    scores[(label[who, None] != label) | (who[:, None] == np.arange(len(x)))] = gn.LEAST
    assert (np.sort(scores, axis=1)[:, ::-1][:, :5] == asked.score).all()
    share = asked.compared / (len(who) * len(x))
    assert share <= most


def test_stacked_fills_with_zeros():
    assert gn.stacked([[1, 2], [3]], 3).tolist() == [[1, 2, 0], [3, 0, 0]] and gn.stacked([], 2).shape == (0, 2)
