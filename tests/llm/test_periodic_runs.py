"""Periodic runs against a quadratic search, and the query's digests."""

import hashlib
import random
import re
import zlib

from helixframe.llm import periodic_runs as pr
from helixframe.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, least=12):
    n, found = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            piece = w[i : j + q]
            if length >= max(least, 2 * q) and not any(all(piece[t] == piece[t + p] for t in range(length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(w, runs):
    out = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(x for k, x in enumerate(w) if k not in out)


def some_texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(150):
        letters = "abcdef"[: rng.choice([1, 2, 2, 3, 6])]
        w = [rng.choice(letters) for _ in range(rng.randrange(0, 70))]
        if rng.random() < 0.6 and w:
            a, p = rng.randrange(len(w)), rng.randrange(1, 12)
            w[a:] = [w[a + (i - a) % min(p, len(w) - a)] for i in range(a, len(w))]
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "z"
        if rng.random() < 0.3:
            w = w + w + w
        out.append(w)
    return out


def test_runs_equal_a_quadratic_search():
    for seed in range(12):
        for least in (12, 5, 2):
            texts = some_texts(seed)
            got = pr.runs_of([[x.encode() for x in w] for w in texts], least)
            for w, g in zip(texts, got, strict=True):
                assert [tuple(r) for r in g.tolist()] == brute(w, least), (w, least)
                assert pr.collapsed([x.encode() for x in w], g).decode() == dropped(w, brute(w, least))


def test_long_texts_stay_fast_and_whole():
    fib = ["a", "ab"]
    while len(fib[-1]) < 20_000:
        fib.append(fib[-1] + fib[-2])
    same, twice = [b"x"] * 30_000, [str(i).encode() for i in range(20_000)] * 2
    got = pr.runs_of([same, twice, [c.encode() for c in fib[-1][:3_000]]])
    assert got[0].tolist() == [[0, 30_000, 1]] and got[1].tolist() == [[0, 40_000, 20_000]]
    assert [tuple(r) for r in got[2].tolist()] == brute(list(fib[-1][:3_000]))
    assert pr.collapsed(twice, got[1]) == b" ".join(twice[:20_000])


def awkward(spark):
    rng = random.Random(9)
    rows = [(k, " \n".join(w), k, "clash", k) for k, w in enumerate(some_texts(4))]
    rows += [(None, "a b " * 20, 0, None, 0), (500, None, None, None, None), (501, "", 1, "", 1), (502, " \t\r\n ", 1, "", 1), (503, "  é " * 9, 1, "", 1), rows[3], rows[3]]
    rows += [(600 + k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 90))), 0, "", 0) for k in range(120)]
    rows += [(-7, "long words " * 30_000, 0, "", 0)]
    return rows, "doc_id long, text string, start long, collapsed string, n_runs long"


def expected(doc_id, text):
    w = words_of(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute(w) if len(w) < 5_000 else [(0, len(w), 2)]
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(dropped(w, runs).encode()).hexdigest())


def test_query_on_awkward_rows(spark, tmp_path):
    rows, schema = awkward(spark)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in (expected(r[0], r[1]) for r in rows)) > 20


def test_operator_keeps_spans_and_needs_no_rows(spark):
    rows, schema = awkward(spark)
    docs = spark.createDataFrame(rows, schema)
    for r in pr.find_runs(docs, batch_bytes=300).where("doc_id between 0 and 149").collect():
        w = words_of(rows[r.doc_id][1])
        assert [tuple(x) for x in r.runs] == brute(w) and r.n_words == len(w) and r.collapsed == dropped(w, brute(w))
    assert pr.report(pr.find_runs(pr.planted(docs.limit(0)))).count() == 0
