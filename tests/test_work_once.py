"""Operators that read each input row once, and work held in bounded tasks."""

import random

from pyspark.sql import functions as F

from helixframe.operators import align as al, annot as an, edits as ed, hsp as hs
from helixframe.plans import evidence as ev
from test_scale import shuffled

EDIT = "set_id string, sequence_id string, position long, old string, new string, evidence string, rationale string"


def counted(spark, df, column):
    """`df` with a column passed through Python, and the counter of the rows that went through."""
    seen = spark.sparkContext.accumulator(0)

    def through(value):
        seen.add(1)
        return value

    kept = F.udf(through, df.schema[column].dataType).asNondeterministic()
    return df.withColumn(column, kept(column)), seen


def test_base_edits_are_read_once_and_judged_as_their_reasons(spark):
    rng = random.Random(5)
    records, rows = [], []
    for s in range(40):
        for q in range(3):
            letters = rng.choice([None, "", "".join(rng.choices("ACGTN", k=rng.choice([1, 7, 999, 1000, 1001, 2500])))])
            records.append((f"s{s}", f"q{q}", letters))
            text = letters or ""
            for at in rng.sample(range(1, len(text) + 1), min(len(text), 5)):
                old = text[at - 1]
                rows.append((f"s{s}", f"q{q}", at, old.lower(), "A" if old != "A" else "c", "e", "r"))
    odd = [
        ("s1", "q0", 0, "A", "C", "e", "r"), ("s2", "q0", 10**6, "A", "C", "e", "r"), ("s3", "nowhere", 1, "A", "C", "e", "r"), ("s4", "q1", None, "A", "C", "e", "r"),
        ("s5", "nowhere", None, "A", "C", "e", "r"), ("s6", "q1", None, "A", "A", "e", "r"), ("s7", "q2", None, "A", "C", " ", "r"), ("s8", "q1", None, "A", "C", None, "r"),
        (None, "q1", 1, "A", "C", "e", "r"), rows[0], (*rows[-1][:4], "T" if rows[-1][4] != "T" else "G", "e", "r"),
    ]
    edits, seen = counted(spark, spark.createDataFrame(rows + odd, EDIT), "old")
    held, read = counted(spark, spark.createDataFrame(records, "set_id string, sequence_id string, seq string"), "seq")
    got = {(r.set_id, r.sequence_id): (r.seq, r.edits) for r in ed.apply_base_edits(edits, held).collect()}
    assert (seen.value, read.value) == (len(rows + odd), len(records))

    plain = spark.createDataFrame(records, held.schema)
    refused = {r.set_id for r in ed.base_edit_reasons(spark.createDataFrame(rows + odd, EDIT), plain).where(F.size("reasons") > 0).collect()}
    assert 4 <= len(refused) <= 20
    wanted = {}
    for s, q, letters in records:
        if s not in refused:
            text = list(letters or "")
            mine = [e for e in rows if e[:2] == (s, q)]
            for e in mine:
                text[e[2] - 1] = e[4].upper()
            wanted[s, q] = (None if letters is None else "".join(text), len(mine))
    assert got == wanted


def test_coding_features_read_the_features_once(spark):
    schema = "record_id string, feature_id string, type string, gene string, product string, strand int, segments array<struct<start:long,end:long>>, partial5 boolean, partial3 boolean, qualifiers map<string,array<string>>"
    rows = [("r", "a", "CDS", "cox1", None, 1, [(0, 4), (6, 11)], False, False, {}), ("r", "b", "CDS", "nad1", None, -1, [(6, 11), (0, 4)], False, False, {}), ("lost", "c", "CDS", "nad2", None, 1, [(0, 3)], False, False, {})]
    features, seen = counted(spark, spark.createDataFrame(rows, schema), "gene")
    records = spark.createDataFrame([("r", "ATGAccTAGAAg\n")], "record_id string, sequence string")
    got = {r.feature_id: (r.gene, r.coding, r.protein, r.codons) for r in an.coding_features(features, records, 5).collect()}
    assert got == {"a": ("cox1", "ATGATAGAA", "MME", ["ATG", "ATA", "GAA"]), "b": ("nad1", "TTCTATCAT", "FYH", ["TTC", "TAT", "CAT"])}
    assert seen.value == len(rows)


HSP = "query string, hit string, accession string, query_from long, query_to long, hit_from long, hit_to long, align_len long, identity long, bitscore double, query_len long, hit_len long"


def test_hits_of_few_hsps_are_moved_once_and_summed_as_large_ones(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(30_000):
        a, b, n = rng.randrange(1, 25_000), rng.randrange(1, 25_000), rng.randrange(1, 60)
        q, h = (a, a + n)[:: rng.choice([1, 1, -1])], (b, b + n)[:: rng.choice([1, 1, -1])]
        rows.append((f"q{i % 900}", rng.choice("ab"), "x", *q, *h, n + 5, rng.choice([0, n]), float(n), 30_000, 30_000))
    rows += [("q0", "c", "x", 5, 1, None, 9, 5, 5, 1.0, 10, None), (None, "c", "x", 5, 1, 2, 9, 5, 5, 1.0, 10, 10)]
    hsps = spark.createDataFrame(rows, HSP)
    few, moved = shuffled(spark, lambda: hs.hit_summaries(hsps))
    for held in (0, 16):
        monkeypatch.setattr(hs, "HELD", held)
        some, _ = shuffled(spark, lambda: hs.hit_summaries(hsps))
        assert sorted(map(repr, some)) == sorted(map(repr, few))
    assert len(few) == 1801 and any(r["monotonic"] for r in few) and any(r["redundant_bases"] for r in few)
    assert moved < 70 * len(rows), moved / len(rows)


READ = "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, seq string, qual string, rg string"


def test_depth_packs_bases_in_rows_and_counts_them_where_they_are_dealt(spark, monkeypatch):
    rng = random.Random(9)
    marks = [chr(k) for k in range(30, 130)] + ["é", "I", "I", "I"] * 30
    rows = [("s", f"q{i % 4000}", 0, "r", rng.randrange(1, 3_000), 60, "40M5D90M3I2M", "=", 1, "A" * 135, "".join(rng.choices(marks, k=135)), rng.choice([None, "g"])) for i in range(6_000)]
    rows += [("s", "t1", 0, "r", 5, 60, "10M", "=", 1, "A" * 10, q, None) for q in ("III", "*", "", None, "I" * 10)]
    held = {}
    for s, q, _, r, pos, _, _, _, _, _, qual, rg in rows:
        blocks = [(0, 0, 40), (45, 40, 90), (135, 133, 2)] if q[0] == "q" else [(0, 0, 10)]
        for ref, at, n in blocks:
            for k in range(n):
                if qual not in (None, "*") and at + k < len(qual) and 53 <= ord(qual[at + k]) <= 126:
                    held.setdefault(pos + ref + k, set()).add((rg or "", q))
    reads = spark.createDataFrame(rows, READ).withColumn("sample", F.lit("s"))
    for hot in (64_000_000, 0):
        monkeypatch.setattr(al, "HOT_BASES", hot, raising=False)
        out, moved = shuffled(spark, lambda: al.depth(reads))
        assert {r["pos"]: r["depth"] for r in out} == {p: len(t) for p, t in held.items()}
        assert moved < 180 * len(rows) or not hot, moved / len(rows)


def test_base_support_finds_the_calls_once(spark):
    rows = [("s", f"q{i % 7}", 0 if i % 3 else 16, "r", 5, [60, 10, 255][i % 5 % 3], "10M", "=", 1, "ACGTACGTAC", "IIII!IIIII", None) for i in range(20)]
    calls, seen = counted(spark, al.site_calls(spark.createDataFrame(rows, READ), spark.createDataFrame([("s", "r", 6), ("s", "r", 9)], "sample string, rname string, pos long")), "qname")
    out = {r.site: r for r in al.base_support(calls, min_depth=3).collect()}
    assert (out[6].base, out[6].depth, out[6].read_depth, out[6].n_c) == ("C", 6, 8, 6)
    assert (out[6].excluded_low_mapq, out[9].excluded_low_baseq, out[9].depth, out[9].reasons) == (12, 8, 0, ["zero_depth"])
    assert seen.value == 40


def test_candidates_are_not_worked_out_where_something_was_inspected(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "accession string, sample_count long")
    candidates, seen = counted(spark, frame, "accession")
    inspected, read = counted(spark, frame.where("sample_count = 2"), "accession")
    assert [tuple(r) for r in ev.bundle(candidates, inspected).collect()] == [("b", 2)]
    assert (seen.value, read.value) == (0, 1)
    assert sorted(tuple(r) for r in ev.bundle(candidates, frame.where("sample_count = 3")).collect()) == [("a", 1), ("b", 2)]
