"""Segments, intervals, sequences, reads and taxonomy on small inputs."""

import hashlib
import random
import time

from pyspark.sql import functions as F

from helixframe.functions import seq as sq, windows as wn
from helixframe.operators import hsp as hs, intervals as iv, reads as rd, sequences as se, taxon as tn

HSP = "gene string, target string, strand string, qstart long, qend long, start long, end long, identity double, evalue double, aln_len long, query_len long"


def chains(spark, *spots, strand="+", identity=None):
    rows = [("g", "t", strand, a, b, c, d, (identity or [100.0] * 9)[i], 0.0, b - a + 1, 100) for i, (a, b, c, d) in enumerate(spots)]
    df = spark.createDataFrame(rows, HSP)
    found = hs.locus_chains(df)
    return found, hs.gene_hits(found, df).first()


def test_two_loci_stay_ambiguous(spark):
    found, hit = chains(spark, (1, 100, 1, 100), (1, 100, 1001, 1100))
    assert found.count() == 2 and hit.status == "multiple" and hit.start is None


def test_two_split_loci_make_two_chains(spark):
    found, _ = chains(spark, (1, 50, 1, 50), (51, 100, 51, 100), (1, 50, 1001, 1050), (51, 100, 1051, 1100))
    assert sorted(r.aln_len for r in found.collect()) == [100, 100]


def test_weighted_identity(spark):
    found, hit = chains(spark, (1, 10, 1, 10), (11, 100, 11, 100), identity=[100.0, 60.0])
    assert abs(found.first().identity - 64.0) < 1e-9 and hit.status == "none"


def test_target_reuse_is_not_merged(spark):
    found, _ = chains(spark, (1, 50, 1, 50), (51, 100, 1, 50))
    assert found.count() == 2


def test_reverse_collinear_is_merged(spark):
    found, hit = chains(spark, (1, 50, 151, 200), (51, 100, 101, 150), strand="-")
    assert found.first().aln_len == 100 and hit.status == "unique" and (hit.start, hit.end) == (101, 200)


def test_long_chain_and_branch(spark):
    spots = [(i * 10 + 1, i * 10 + 10, i * 10 + 1, i * 10 + 10) for i in range(9)]
    found, _ = chains(spark, *spots)
    # Gaps up to 20 let every HSP be followed by several others: the group stays apart.
    assert found.count() == 9 and all(r.ambiguous_chain for r in found.collect())


def brute(intervals):
    covered = set()
    for a, b in intervals:
        covered.update(range(a, b))
    starts = [p for p in sorted(covered) if p - 1 not in covered]
    ends = [p + 1 for p in sorted(covered) if p + 1 not in covered]
    return len(covered), list(zip(starts, ends))


def test_islands_and_union_against_brute_force(spark):
    rng = random.Random(3)
    data = {k: [(a, a + rng.randrange(0, 40)) for a in (rng.randrange(0, 400) for _ in range(n))] for k, n in (("a", 60), ("b", 3), ("hot", 900))}
    df = spark.createDataFrame([(k, a, b) for k, v in data.items() for a, b in v], "k string, start long, end long")
    for width in (16, 50, 10_000):
        lengths = {r.k: r.union_length for r in iv.union_length(df, ["k"], width).collect()}
        isles = {}
        for r in iv.islands(df, ["k"], width).orderBy("k", "island").collect():
            isles.setdefault(r.k, []).append((r.start, r.end))
        for k, v in data.items():
            size, expected = brute(v)
            assert lengths[k] == size and isles.get(k, []) == expected


def test_overlap_and_shared_stretch_against_brute_force(spark):
    rng = random.Random(9)
    pairs = []
    for i in range(60):
        core = "".join(rng.choice("AC") for _ in range(rng.randrange(0, 40)))
        pairs.append((i, "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 30))) + core, core + "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 30)))))
    pairs += [(90, "A" * 50, "A" * 30), (91, "", "ACGT"), (92, "ACGTACGTACGTACGTACGT", "ACGTACGTACGTACGTACGTTT")]

    def overlap(a, b, least=20):
        return next((n for n in range(min(len(a), len(b)), least - 1, -1) if a[-n:] == b[:n]), 0)

    def shared(a, b):
        return max((j - i for i in range(len(a)) for j in range(i + 1, len(a) + 1) if a[i:j] in b), default=0)

    df = spark.createDataFrame(pairs, "i int, a string, b string")
    for r in df.select("*", se.suffix_prefix_overlap(F.col("a"), F.col("b")).alias("o"), se.longest_shared(F.col("a"), F.col("b")).alias("m")).collect():
        assert r.o == overlap(r.a, r.b) and r.m == shared(r.a, r.b)


def test_long_and_repetitive_sequences(spark):
    rng = random.Random(12)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    core = dna(150_000)
    started = time.time()
    a, b = dna(400_000) + core + dna(450_000), dna(300_000) + core[:-1] + "N" + dna(550_000)
    assert wn.longest_common(a, b, 300) in (149_999, 150_000)
    assert time.time() - started < 60
    assert wn.longest_common("A" * 100_000, "A" * 70_000 + "C", 300) == 70_000 and wn.longest_common("AC" * 50_000, "CA" * 50_000) == 99_999
    assert wn.longest_common(dna(5_000), "N" * 5_000) == 0 and wn.longest_common("", "A", 5) == 4
    started = time.time()
    assert wn.end_overlap("A" * 100_000, "A" * 80_000) == 80_000
    assert wn.end_overlap("ACG" * 33_333 + "A", "CGA" * 30_000) == 90_000
    assert wn.end_overlap(dna(100_000) + core, core + dna(100_000)) == 150_000
    assert wn.end_overlap("A" * 19, "A" * 19) == 0 and wn.end_overlap("A" * 99_999 + "C", "A" * 100_000) == 0
    assert time.time() - started < 20
    for _ in range(400):
        x, y = ("".join(rng.choices("AC", k=rng.randrange(0, 25))) for _ in range(2))
        assert wn.end_overlap(x, y, 1) == next((n for n in range(min(len(x), len(y)), 0, -1) if x[-n:] == y[:n]), 0)
        best = max((j - i for i in range(len(x)) for j in range(i + 1, len(x) + 1) if x[i:j] in y), default=0)
        assert wn.longest_common(x, y) == best
        if best >= 6:
            assert set(wn.minimizers(x, 6)) & set(wn.minimizers(y, 6))


def test_matches_and_ends_find_what_brute_force_finds(spark):
    rng = random.Random(13)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    shared = [dna(rng.randrange(20, 90)) for _ in range(6)] + ["AT" * 30]
    rows = [(rng.choice(["r", "s", "hot", "hot", None]), k, dna(rng.randrange(0, 60)) + rng.choice(shared) + dna(rng.randrange(0, 60))) for k in range(160)] + [("r", 900, None), ("r", 901, ""), ("r", 902, "A" * 39)]
    frame = spark.createDataFrame(rows, "record string, segment_id long, seq string")
    segments, features = frame.where("segment_id % 4 <> 0"), frame.where("segment_id % 4 = 0").withColumnRenamed("segment_id", "feature_id")
    got = se.annotation_matches(segments, features, 40)
    want = set()
    for r, i, a in rows:
        for q, j, b in rows:
            if i % 4 and j % 4 == 0 and r is not None and r == q and a and b:
                best = max((k for k in range(40, min(len(a), len(b)) + 1) if any(a[p : p + k] in b for p in range(len(a) - k + 1))), default=0)
                if best:
                    want.add((r, i, j, best))
    assert {tuple(x) for x in got.collect()} == want and len(want) > 50
    status = {x.segment_id: x.status for x in se.segment_match_status(segments, got, 40).collect()}
    assert status[901] == status[902] == "insufficient" and len(status) == sum(r[1] % 4 > 0 for r in rows)
    assert {k for k, v in status.items() if v == "matched"} == {w[1] for w in want}

    def complement(s):
        return s[::-1].translate(str.maketrans("ACGT", "TGCA"))

    whole = [dna(120) for _ in range(8)]
    pieces = [(c, 1, w[:50]) for c, w in enumerate(whole)] + [(c, 2, complement(w[25:90]) if c % 2 else w[25:90]) for c, w in enumerate(whole)] + [(c, 3, w[60:]) for c, w in enumerate(whole)] + [(9, 1, "AC" * 30), (9, 2, "AC" * 25), (9, 3, "AC"), (9, 4, None)]
    found = {tuple(x) for x in se.end_overlaps(spark.createDataFrame(pieces, "case_id int, scaffold_id int, seq string")).collect()}
    expected = set()
    for c, i, a in pieces:
        for d, j, b in pieces:
            if c == d and i < j and a and b:
                for sa, x in (("+", a), ("-", complement(a))):
                    for sb, y in (("+", b), ("-", complement(b))):
                        best = next((n for n in range(min(len(x), len(y)), 19, -1) if x[-n:] == y[:n]), 0)
                        if best:
                            expected.add((c, i, sa, j, sb, best))
    assert found == expected and len(expected) >= 16
    joins = {(r.variant, r.status) for r in se.oriented_joins(spark.createDataFrame([(1, "ACGT", "ACGT" * 9), (2, "", "")], "case_id int, seq1 string, seq2 string")).collect()}
    assert {s for _, s in joins} == {"insufficient"}


def test_runs_codes_and_prefixes(spark):
    df = spark.createDataFrame([("NNACGTNRA",), ("ACGT",), ("N",)], "seq string")
    runs = [[(x.start, x.end) for x in r.r] for r in df.select(sq.runs_of(F.col("seq"), "N").alias("r")).collect()]
    assert runs == [[(1, 2), (7, 7)], [], [(1, 1)]]
    row = spark.createDataFrame([("ATGAGATAANNNAT",)], "s string").select(sq.translate(F.col("s"), 5).alias("a"), sq.translate(F.col("s"), 2).alias("b")).first()
    assert (row.a, row.b) == ("MS*X", "M**X")
    assert sq.stop_prefixes(5) == ["T", "TA"] and sq.stop_prefixes(2) == ["AG", "T", "TA"] and sq.stop_prefixes(6) == ["TG"]


def test_consensus(spark):
    def segments(rows):
        df = spark.createDataFrame([("a", t, s) for t, s in rows], "alignment string, template string, seq string")
        return [r.seq for r in rd.consensus_segments(df).collect()], rd.consensus_columns(df)

    got, columns = segments([("P1", "A" * 300), ("P1", "A" * 300)])
    assert got == [] and columns.agg(F.max("depth")).first()[0] == 1
    assert segments([(f"P{i}", "A" * 300) for i in range(5)])[0] == ["A" * 300]
    got, columns = segments([(f"P{i}", ("A" if i < 5 else "G") * 300) for i in range(10)])
    assert got == [] and columns.where("mixed").count() == 300
    assert segments([(f"P{i}", "A" * 200 + "~~~" + "T" * 200) for i in range(5)])[0] == []
    assert segments([("P1", "A"), ("P1", "G")])[1].count() == 0


def test_sampling_shares(spark):
    df = spark.createDataFrame([(lane, f"r{i}") for lane in ("x", "y") for i in range(20)], "lane string, id string")
    got = {r.lane: r.n for r in rd.sample_pairs(df, 6, "19").groupBy("lane").agg(F.count("*").alias("n")).collect()}
    assert got == {"x": 3, "y": 3}
    one = sorted(r.id for r in rd.sample_pairs(df, 6, "19").collect())
    assert one == sorted(r.id for r in rd.sample_pairs(df.orderBy(F.rand()), 6, "19").collect())


def test_intake_findings(spark):
    df = spark.createDataFrame([("f", "x", "ACGT"), ("f", "x", "ACN"), ("g", "y", "ACGT")], "path string, id string, seq string")
    got = {(r.path, r.code, r.level) for r in se.intake_findings(df).collect()}
    assert got == {("f", "MULTIPLE_RECORDS", "REVIEW"), ("f", "DUPLICATE_IDS", "BLOCK"), ("f", "AMBIGUOUS_BASES", "REVIEW"), ("g", "BASIC_INTAKE_CLEAR", "INFO")}


PATHS = {50557: [1, 2759, 33208, 6656, 50557], 7: [1, 2759, 33208, 6656, 50557, 7], 8: [1, 2759, 33208, 6656, 50557, 8], 9606: [1, 2759, 33208, 7711, 9606]}


def classify(spark, *hits, expected=50557):
    rows = [("m", i, h["taxids"], float(h.get("score", 500)), h.get("coverage", 1.0), h.get("identity", 99.0), h.get("blockers", [])) for i, h in enumerate(hits)]
    df = spark.createDataFrame(rows, "marker string, hit int, taxids array<bigint>, ranking_bitscore double, coverage double, identity double, blockers array<string>")
    taxa = spark.createDataFrame([(k, str(k), "r", [(x, str(x), "r") for x in v]) for k, v in PATHS.items()], "taxid long, name string, rank string, lineage array<struct<taxid:bigint,name:string,rank:string>>")
    want = spark.createDataFrame([("m", expected)], "marker string, expected_taxid long")
    return tn.classify_markers(df, taxa, want).first()


def test_taxonomy_screen(spark):
    row = classify(spark, dict(taxids=[7]), dict(taxids=[8], score=490))
    assert (row.status, row.lca_taxid) == ("compatible", 50557)
    assert classify(spark, dict(taxids=[7], score=700, blockers=["x"]), dict(taxids=[9606])).reason == "strong_blocked_hit"
    assert classify(spark, *[dict(taxids=[7])] * 30).reason == "saturated"
    row = classify(spark, dict(taxids=[7, 9606]))
    assert (row.status, row.lca_taxid) == ("insufficient", 33208)
    for hit in (dict(taxids=[]), dict(taxids=[None]), dict(taxids=[12345]), dict(taxids=[7], coverage=0.2)):
        assert classify(spark, hit).status == "insufficient"
    assert classify(spark, dict(taxids=[9606])).status == "discordant"


def test_sample_verdicts(spark):
    rows = [("a", "compatible"), ("a", "discordant"), ("a", "insufficient"), ("b", "discordant"), ("c", "compatible"), ("d", "compatible")]
    samples = spark.createDataFrame([(s, int(s == "d")) for s in "abcde"], "sample string, failures int")
    got = {r.sample: r.status for r in tn.sample_verdict(spark.createDataFrame(rows, "sample string, status string"), samples).collect()}
    assert got == {"a": "suspected_mixed", "b": "suspected_mismatch", "c": "compatible", "d": "insufficient", "e": "insufficient"}


def test_samples_are_refused_or_drawn_exactly(spark):
    lanes = [("a", "x", 1, 5), ("a", "y", 2, 1000), ("a", "z", 3, 40), ("b", "x", 1, 10), ("b", "y", 2, 10), ("c", "x", 1, 10), ("c", "y", 2, 0), ("d", "x", 1, 7)]
    records = [(s, lane, f"{s}{lane}{i}") for s, lane, _, n in lanes for i in range(n)]
    requests = [("a", 100), ("b", 1), ("c", 10), ("d", 50), ("e", 5)]
    plan = rd.sample_plan(spark.createDataFrame(lanes, "sample string, lane string, lane_ord int, pairs long"), spark.createDataFrame(requests, "sample string, budget long"))
    got = {(r.sample, r.lane): (r.amount, r.status) for r in plan.collect()}
    assert got == {
        ("a", "x"): (5, "ok"), ("a", "y"): (62, "ok"), ("a", "z"): (33, "ok"), ("b", "x"): (0, "budget_below_lanes"), ("b", "y"): (0, "budget_below_lanes"),
        ("c", "x"): (0, "empty_lane"), ("c", "y"): (0, "empty_lane"), ("d", "x"): (7, "ok"),
    }
    frame = spark.createDataFrame(records, "sample string, lane string, id string")
    drawn = rd.sample_lanes(frame, plan, "s").collect()
    for (s, lane), (amount, _) in got.items():
        ids = sorted((i for a, b, i in records if (a, b) == (s, lane)), key=lambda i: hashlib.md5(f"s#{i}".encode()).hexdigest())
        assert sorted(r.id for r in drawn if (r.sample, r.lane) == (s, lane)) == sorted(ids[:amount])
    assert sorted(r.id for r in drawn) == sorted(r.id for r in rd.sample_lanes(frame.orderBy(F.rand()), plan, "s").collect())
