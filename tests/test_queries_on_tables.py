"""Registered queries against their SQL, on small tables that the given ones do not resemble."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from helixframe.operators import sequences


def both(spark, folder, name: str, **tables: pa.Table) -> tuple[list[tuple], list[tuple]]:
    """Sorted rows of a query and of its SQL over the given tables."""
    duck = duckdb.connect()
    for table, rows in tables.items():
        pq.write_table(rows, f"{folder}/{table}.parquet")
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    mine = entry.queries()[name](spark, str(folder))
    theirs = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in theirs.description]
    assert sorted(names) == sorted(mine.columns)
    return sorted((tuple(r[c] for c in names) for r in mine.collect()), key=repr), sorted(theirs.fetchall(), key=repr)


def documents(texts: list, lang: list | None = None, source: list | None = None, ids: list | None = None) -> pa.Table:
    n = len(texts)
    return pa.table({
        "doc_id": pa.array(ids or range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": lang or ["en"] * n, "source": source or ["src1"] * n,
        "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
    })


def order_lines(n: int, parts: int) -> pa.Table:
    return pa.table({
        "l_orderkey": pa.array([i // 3 for i in range(n)], pa.int64()), "l_partkey": pa.array([i % parts for i in range(n)], pa.int64()), "l_suppkey": pa.array([i % 5 for i in range(n)], pa.int64()),
        "l_linenumber": pa.array([i % 3 + 1 for i in range(n)], pa.int64()), "l_quantity": [float(i % 50 + 1) for i in range(n)], "l_discount": [i % 11 / 100 for i in range(n)],
        "l_returnflag": ["RNA"[i % 3] for i in range(n)], "l_linestatus": ["FO"[i % 2] for i in range(n)],
    })


def test_run_summary_of_contrasts_without_terms(spark, tmp_path):
    """Sets all out of bounds: no contrast has a term, so none has counts."""
    parts = pa.table({"p_partkey": pa.array(range(6), pa.int64()), "p_size": pa.array([1] * 6, pa.int64()), "p_type": ["PROMO"] * 6, "p_brand": ["a", "b"] * 3})
    mine, theirs = both(spark, tmp_path, "enrich_run_summary", part=parts, lineitem=order_lines(60, 6))
    assert mine == theirs and len(mine) == 2 and all(None in row for row in mine)


def test_annotation_matches_of_repeats_and_long_stretches(spark, tmp_path):
    """A line once or several times in many texts, whole copies, and stretches that end at either end of a text."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("aecgtns") for _ in range(n))
    line, passage, base = word(75), word(400), word(900)
    texts = [base, base[300:], base[:500] + word(60), passage + word(50), word(30) + passage, "x", ""]
    for i in range(40):
        texts.append(word(rng.randrange(200)) + (line + word(rng.randrange(9))) * (i % 12) + word(rng.randrange(200)) + rng.choice(["", passage[rng.randrange(200):], base[: rng.randrange(900)]]))
    tables = {"documents": documents(texts, lang=[["en", "fr"][i % 5 == 4] for i in range(len(texts))], ids=[i * (20 if i % 3 == 0 else 1) + (i % 3 > 0) * 1000 for i in range(len(texts))])}
    for name in ("sequence_annotation_matches", "sequence_segment_match_status"):
        mine, theirs = both(spark, tmp_path, name, **tables)
        assert mine == theirs and len(mine) > 20


def test_a_common_line_needs_no_whole_comparison(spark, monkeypatch):
    """Pairs that share one line only are told from the letters around it."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    line = word(80)
    rows = [("r", i, word(300) + line + word(300) + (line if i % 4 == 0 else "") + word(90)) for i in range(30)]
    monkeypatch.setattr(sequences, "longest_shared", lambda a, b, n: F.raise_error(F.lit("compared whole")).cast("bigint"))
    out = sequences.annotation_matches(spark.createDataFrame(rows[:20], "record string, segment_id int, seq string"), spark.createDataFrame(rows[20:], "record string, feature_id int, seq string"), 60).collect()
    assert len(out) == 200 and min(r["matched_bp"] for r in out) == 80


def longest(a, b):
    """Length of the longest common substring; a shorter one is common as well."""
    low, high = 0, min(len(a), len(b)) + 1
    while high - low > 1:
        n = (low + high) // 2
        low, high = (n, high) if {a[p : p + n] for p in range(len(a) - n + 1)} & {b[p : p + n] for p in range(len(b) - n + 1)} else (low, n)
    return low


def test_a_line_repeated_among_others_needs_no_whole_comparison(spark, monkeypatch):
    """Many places of one line, and passages of several hundred letters, are told from the letters beside their seeds."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    line, passage = word(70), word(700)
    rows = [("r", i, "".join(line + word(rng.randrange(20, 40)) for _ in range(i)) + (passage[rng.randrange(90) : 500 + rng.randrange(90)] if i % 3 == 0 else "")) for i in range(1, 25)]
    monkeypatch.setattr(sequences, "longest_shared", lambda a, b, n: F.raise_error(F.lit("compared whole")).cast("bigint"))
    monkeypatch.setattr(sequences, "whole_stretches", lambda n: lambda pairs, texts: 1 / (pairs.num_rows == 0) and pairs.append_column("matched_bp", pairs["segment_id"]), raising=False)
    out = sequences.annotation_matches(spark.createDataFrame(rows[:18], "record string, segment_id int, seq string"), spark.createDataFrame(rows[18:], "record string, feature_id int, seq string"), 60).collect()
    assert {(r["segment_id"], r["feature_id"]): r["matched_bp"] for r in out} == {(a[1], b[1]): longest(a[2], b[2]) for a in rows[:18] for b in rows[18:]}


def test_long_repeats_in_both_texts(spark):
    """Periodic stretches begin at many pairs of places; such pairs are searched whole, one hashing for each text."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rows = [("r", i, word(30) + "CA" * (20 + 17 * i) + word(50) + "CA" * (9 * i) + word(20)) for i in range(1, 19)]
    out = sequences.annotation_matches(spark.createDataFrame(rows[:12], "record string, segment_id int, seq string"), spark.createDataFrame(rows[12:], "record string, feature_id int, seq string"), 60).collect()
    assert {(r["segment_id"], r["feature_id"]): r["matched_bp"] for r in out} == {(a[1], b[1]): longest(a[2], b[2]) for a in rows[:12] for b in rows[12:]}


def test_findings_of_texts_without_letters(spark, tmp_path):
    """A text that has no letter, on either strand, is a coding feature without bases."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("aecgtnsjb ") for _ in range(n))
    texts = ["", "123", "4 5", ""] + [word(rng.randrange(90)) for _ in range(60)] + ["6"] * 12
    mine, theirs = both(spark, tmp_path, "annot_cds_finding_counts", documents=documents(texts))
    assert mine == theirs and len(mine) == 6
    rows = entry.queries()["annot_cds_findings"](spark, str(tmp_path)).collect()
    assert {r["record_id"] for r in rows if r["detail"] == "end="} >= {"1", "2", "3"}


def test_source_agreement_of_texts_without_letters(spark, tmp_path):
    """A feature of a record that has no genome is foreign, whatever its place."""
    texts = ["", "123", "a tree", "a", "the stone is in the ground"] * 24
    n = len(texts)
    lang, source = [["en", "de", "fr", "es"][i // 5 % 4] for i in range(n)], [["src11", "src5", "src1"][i % 3] for i in range(n)]
    mine, theirs = both(spark, tmp_path, "annot_source_agreement", documents=documents(texts, lang, source))
    assert mine == theirs and len(mine) == n
