"""What a query moves or holds: figures that must not grow faster than the table."""

import random

from pyspark.sql import functions as F

from helixframe import session
from helixframe.functions import names as nm
from helixframe.operators import align as al, annot as an, hsp as hs, inspect as ins, ledger as lg, reads as rd, sequences as se
from helixframe.queries import load


def stages(spark):
    """(stage, attempt) of all stages so far, with the bytes that each wrote to shuffles."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark.sparkContext._jsc.sc().statusStore()
    rows = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return {(rows.apply(i).stageId(), rows.apply(i).attemptId()): rows.apply(i).shuffleWriteBytes() for i in range(rows.size())}


def shuffled(spark, df) -> tuple[list, int]:
    """Rows of `df` (or of what it makes, if it is a function) and the bytes shuffled for them; small tables are shuffled as large ones are."""
    before = stages(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = (df() if callable(df) else df).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return rows, sum(n for k, n in stages(spark).items() if k not in before)


def test_end_overlaps_shuffle_no_windows(spark):
    rng = random.Random(3)
    whole = "".join(rng.choices("ACGT", k=300_000))
    pieces = [(1, 1, whole[:100_030]), (1, 2, whole[100_000:200_030]), (1, 3, whole[200_000:])]
    rows, moved = shuffled(spark, se.end_overlaps(spark.createDataFrame(pieces, "case_id int, scaffold_id int, seq string").repartition(3)))
    assert {tuple(r) for r in rows} == {(1, 1, "+", 2, "+", 30), (1, 2, "+", 3, "+", 30)}
    assert 0 < moved < 6 * len(whole)


def test_end_overlaps_of_a_case_in_parts(spark, monkeypatch):
    monkeypatch.setattr(se, "ENDS", 5, raising=False)
    rng = random.Random(4)
    whole = "".join(rng.choices("ACGT", k=900))
    pieces = [(1, i, whole[i * 30 : i * 30 + 55 + i % 3]) for i in range(28)] + [(2, 1, whole[:40]), (2, 2, whole[15:60])]
    rows = se.end_overlaps(spark.createDataFrame(pieces, "case_id int, scaffold_id int, seq string")).collect()
    expected = set()
    for c, i, a in pieces:
        for d, j, b in pieces:
            if c == d and i < j:
                turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
                for sa, x in (("+", a), ("-", turned(a))):
                    for sb, y in (("+", b), ("-", turned(b))):
                        best = next((n for n in range(min(len(x), len(y)), 19, -1) if x[-n:] == y[:n]), 0)
                        if best:
                            expected.add((c, i, sa, j, sb, best))
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected) > 20


def test_consensus_columns_shuffle_letters_not_rows(spark):
    rng = random.Random(5)
    rows = [("a", f"t{i}", "".join(rng.choices("ACGT", k=3_000))) for i in range(200)]
    out, moved = shuffled(spark, rd.consensus_columns(spark.createDataFrame(rows, "alignment string, template string, seq string")))
    assert len(out) == 3_000 and {r["depth"] for r in out} == {200}
    assert 0 < moved < 4 * 200 * 3_000


def test_consensus_columns_of_mates_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(rd, "PIECE", 7, raising=False)
    rng = random.Random(6)
    rows = [(rng.choice("ab"), f"t{rng.randrange(30)}", "".join(rng.choices("ACGTacgN-", [9, 1, 1, 1, 3, 1, 1, 1, 1], k=rng.randrange(40)))) for _ in range(90)]
    rows += [("a", "t1", None), ("b", "t2", ""), ("c", "t1", "-" * 30)]
    held: dict = {}
    for a, t, seq in rows:
        for i, base in enumerate((seq or "").upper()):
            if base in "ACGT":
                held.setdefault((a, i), {}).setdefault(t, set()).add(base)
    expected = {}
    for key, templates in held.items():
        calls = [next(iter(b)) for b in templates.values() if len(b) == 1]
        if calls:
            (n, first), (m, _) = sorted(((-calls.count(b), b) for b in "ACGT"))[:2]
            expected[key] = (len(calls), first if len(calls) >= 5 and -n / len(calls) >= 0.9 else "N", -m >= 3 and -m / len(calls) >= 0.2)
    out = rd.consensus_columns(spark.createDataFrame(rows, "alignment string, template string, seq string")).collect()
    assert {(r["alignment"], r["site"]): (r["depth"], r["call"], r["mixed"]) for r in out} == expected and len(out) == len(expected) > 60


def test_coverage_windows_take_the_depth_once(spark):
    rng = random.Random(8)
    rows = [("s", f"q{i}", 0, "r", rng.randrange(1, 40_000), 60, "50M", "=", 1, "A" * 50, "I" * 50, None) for i in range(4_000)]
    reads = spark.createDataFrame(rows, "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, seq string, qual string, rg string")
    refs = spark.createDataFrame([("s", "r", 40_100)], "sample string, rname string, length long")
    depths, once = shuffled(spark, al.depth(reads))
    windows, moved = shuffled(spark, lambda: al.coverage_windows(al.depth(reads), refs))
    assert moved < 1.4 * once and len(windows) == 81
    assert round(sum(w["mean"] * (w["end"] - w["start"] + 1) for w in windows)) == sum(d["depth"] for d in depths) == 200_000


def test_missing_genes_need_no_row_a_gene_in_the_shuffle(spark):
    rows = [(f"r{i}", i, *[("tRNA", "trnl", None), ("rRNA", "rrna", "rrna"), ("CDS", "nd1", "nd1")][i % 3]) for i in range(6_000)]
    frame = spark.createDataFrame(rows, "record_id string, feature_id long, type string, name string, identity string")
    out, moved = shuffled(spark, lambda: an.gene_set_findings(frame).where("code = 'MISSING_GENE'"))
    every = len(nm.EXPECTED_CDS) + len(nm.EXPECTED_TRNA) + len(nm.EXPECTED_RRNA)
    assert len(out) == 2_000 * (3 * every - 5)
    assert not {(r["record_id"], r["detail"]) for r in out} & {("r0", "tRNA:trnl1"), ("r0", "tRNA:trnl2"), ("r1", "rRNA:rrnl"), ("r1", "rRNA:rrns"), ("r2", "CDS:nd1")}
    assert moved < 100 * len(rows), moved


HSP = "gene string, target string, strand string, qstart long, qend long, start long, end long, identity double, evalue double, aln_len long, query_len long"


def test_chains_shuffle_few_bytes_for_hsps_without_neighbours(spark):
    rng = random.Random(6)
    rows = [(f"gene{rng.random()}", f"target{rng.random()}", "+", 1, 20, i * 1000, i * 1000 + 19, 90.0, 0.0, 20, 50) for i in range(20_000)]
    out, moved = shuffled(spark, lambda: hs.locus_chains(spark.createDataFrame(rows, HSP)))
    assert len(out) == len(rows) and {r["hsps"] for r in out} == {1}
    assert 0 < moved < 600 * len(rows)


def test_chains_of_names_with_colons_stay_apart(spark):
    spots = [(1, 20, 1, 20, 90.0, 0.0, 20, 50), (31, 50, 31, 50, 90.0, 0.0, 20, 50)]
    rows = [(*names, "+", *s) for names in (("a:b", "c"), ("a", "b:c")) for s in spots]
    out = hs.locus_chains(spark.createDataFrame(rows, HSP)).collect()
    assert sorted((r["gene"], r["target"], r["hsps"], r["qstart"], r["qend"]) for r in out) == [("a", "b:c", 2, 1, 50), ("a:b", "c", 2, 1, 50)]


def test_candidate_states_count_checks_once(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 5, raising=False)
    cands = spark.createDataFrame([(i, "K") for i in range(100)] + [(1, "K"), (2, None), (None, "K")], "case_id long, id string")
    checks = [(i, "K", "pass" if i % 3 else "fail") for i in range(110)] + [(3, "K", "pass"), (2, None, "pass"), (None, "K", "fail")]
    out = lg.candidate_states(cands, spark.createDataFrame(checks, "case_id long, candidate_id string, result string"))
    tasks = out.select(F.spark_partition_id()).distinct().count()
    expected = [(i, "K", "inconclusive" if i == 3 else "verified" if i % 3 else "rejected", 2 if i == 3 else 1) for i in range(100)] + [(2, None, "proposed", 0), (None, "K", "proposed", 0)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_least_rows_in_tasks_that_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 5, raising=False)
    out = lg.least_rows(spark.createDataFrame([(i, f"e{i % 3}") for i in range(200)] * 2, "case_id long, v string"), ["case_id"])
    assert out.count() == 200
    assert out.select(F.spark_partition_id()).distinct().count() > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_project_inspection_moves_no_record_that_names_no_project(spark):
    rng = random.Random(8)
    requests = spark.createDataFrame([(f"P{i}", "general") for i in range(5)], "requested string, goal string")
    hits = spark.createDataFrame([(f"P{i}", i, f"P{i}", "t", "s", "o", [], []) for i in range(5)], "requested string, record_ord long, accession string, title string, summary string, organism string, linked_sra array<string>, linked_biosamples array<string>")
    rows = [(i, f"SRX{rng.random()}", "", "", "", [f"SRR{rng.random()}"], f"SAMN{rng.random()}", "o", "P1" if i < 3 else "") for i in range(20_000)]
    studies = spark.createDataFrame(rows, "record_ord long, accession string, study_accession string, experiment_accession string, sample_accession string, run_accessions array<string>, biosample string, organism string, bioproject string")
    out, moved = shuffled(spark, lambda: ins.project_inspection(requests, hits, studies))
    assert {(r["requested"], r["backfilled"], len(r["linked_biosamples"])) for r in out} == {(f"P{i}", 3 if i == 1 else 0, 3 if i == 1 else 0) for i in range(5)}
    assert 0 < moved < 20 * len(rows)


def test_study_fit_moves_a_row_once(spark):
    plan = load().QUERIES["discover_study_fit"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Expand" not in plan
