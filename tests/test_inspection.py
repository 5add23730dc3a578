"""Inspection of studies and projects on recorded cases, and tiles against plain slicing."""

import random

from pyspark.sql import functions as F

from helixframe.operators import discover as di, inspect as ins, tiles as tl
from helixframe.plans import evidence as ev

RECORD = "requested string, record_ord int, accession string, study_accession string, experiment_accession string, sample_accession string, submitter_accession string, source_type string, title string, summary string, organism string, library_strategy string, library_layout string, platform string, biosample string, bioproject string, run_accessions array<string>"


def record(requested, n, accession, study="", runs=(), **more):
    row = dict(zip((c.split()[0] for c in RECORD.split(", ")), [requested, n, accession, study, "", "", None, "", "", "", "", "", "", "", "", "", list(runs)], strict=True))
    return tuple({**row, **more}.values())


def test_study_inspection_looks_at_the_right_records(spark):
    hits = [
        # A run names its study; the study has hits of its own, of which two name it.
        record("srr5 ", 2, "SRX9", "SRP1", ["SRR5"], title="by run"), record("srr5 ", 1, "SRX8", "SRP7", ["SRR1"], title="other"),
        record("SRP1", 1, "SRX1", "SRP1", ["SRR1", "SRR2"], title="  ", organism="Sus scrofa", library_strategy="RNA-Seq", biosample="SAMN1", summary="abdominal fat of pigs"),
        record("SRP1", 2, "SRX2", "srp1", ["SRR2", "SRR5"], title="Adipose", organism="Bos taurus", library_strategy="WGS", platform="ILLUMINA", biosample="SAMN1", bioproject="PRJNA1"),
        record("SRP1", 3, "SRX3", "SRP4", ["SRR9"], title="not of this study"),
        # No record names the request, so the first one gives the study; what searching that one finds does not name it: all own records count.
        record("PRJX", 1, "", "SRP8", title="first"), record("PRJX", 2, "SRX7", "", title="second", source_type="experiment"), record("SRP8", 1, "SRX99", "", title="stray"),
        # The same without hits of the study: only the record that names it counts.
        record("PRJY", 1, "", "SRP6", title="first"), record("PRJY", 2, "SRX7", "", title="second", source_type="experiment"),
        # No study, no accession: the request is its own anchor.
        record("SRP3", 1, "", "", title="bare"),
    ]
    requests = [("srr5 ", "wgcna"), ("SRP1", "differential_expression"), ("PRJX", "validation"), ("PRJY", "validation"), ("SRP3", "general"), ("nothing", "general")]
    meta = [("SRP1", "SRR1", None, " ", "b", "x"), ("SRP8", "SRR1", "", "\t", "s1", "x"), ("SRP8", "SRR2", None, "SAMN7", "s2", "y"), ("SRP8", "SRR2", None, None, "s2", "y"), ("SRP3", " ", "", "", "", None)]
    runs = spark.createDataFrame(meta, "accession string, Run string, BioSample string, BioSample_s string, sample_alias string, treatment string")
    out = ins.study_inspection(spark.createDataFrame(requests, "requested string, goal string"), spark.createDataFrame(hits, RECORD), runs)
    got = {r.requested: r for r in out.collect()}
    assert set(got) == {"srr5 ", "SRP1", "PRJX", "PRJY", "SRP3"} and (got["PRJY"].record_count, got["PRJY"].source_type, got["PRJY"].sample_count) == (1, "study", None)
    for name in ("srr5 ", "SRP1"):
        r = got[name]
        assert (r.accession, r.title, r.record_count, r.organisms, r.tissues) == ("SRP1", "Adipose", 2, ["Sus scrofa", "Bos taurus"], ["abdominal fat", "adipose"])
        assert (r.sample_count, r.run_count, r.assay_family, r.bioproject) == (1, 3, "RNA-Seq; WGS", "PRJNA1")
        assert r.linked_sra == ["SRX1", "SRX2", "SRP1", "srp1", "SRR1", "SRR2", "SRR5"] and set(r.risks) == {"multiple_organisms", "mixed_library_strategies"}
    assert got["srr5 "].fit.overall == "low" and got["SRP1"].fit.overall == "low"
    r = got["PRJX"]
    assert (r.accession, r.title, r.source_type, r.record_count, r.sample_count, r.run_count, r.design_clarity, r.metadata_rows) == ("SRP8", "first", "experiment", 2, 2, 2, "high", 3)
    assert [(s.column, s.counts) for s in r.group_signals] == [("treatment", {"x": 1, "y": 2})]
    r = got["SRP3"]
    assert (r.accession, r.sample_count, r.run_count, r.design_clarity, r.linked_sra) == ("SRP3", None, None, "low", [])
    assert {"run_accessions_unclear", "organism_metadata_sparse"} == set(r.risks)
    shown = {x.accession: x for x in ev.study_inspections(out).collect()}
    assert shown["SRP3"].data_availability["needs_manual_check"] == "true" and shown["SRP1"].linked_accessions.bioproject == ["PRJNA1"]


def test_project_inspection_fills_gaps_from_the_archive(spark):
    schema = "requested string, record_ord int, accession string, title string, summary string, organism string, linked_sra array<string>, linked_biosamples array<string>"
    rows = [
        ("PRJNA1", 1, "PRJNA2", "neighbour", "", "Gallus gallus", ["SRR8"], []), ("PRJNA1", 2, "prjna1", "", "islet cells", "Sus scrofa", [], ["SAMN1"]), ("PRJNA1", 3, "PRJNA1", "Own", "", "", None, None),
        ("PRJNA5", 1, "PRJNA6", "only this", "", "", ["SRR1", "SRX1", "SRR1"], []), ("PRJNA7", 1, "PRJNA7", "", "", "", [], []),
    ]
    studies = [record("x", 2, "SRX5", "SRP5", ["SRR5"], bioproject="PRJNA1", biosample="SAMN2", organism="Bos taurus"), record("x", 1, "SRX4", "SRP5", ["SRR4"], bioproject="PRJNA1", biosample="SAMN1"), record("x", 3, "SRX1", "SRP1", ["SRR0"], bioproject="PRJNA5")]
    requests = spark.createDataFrame([("PRJNA1", "wgcna"), ("PRJNA5", "general"), ("PRJNA7", "general"), ("PRJNA9", "general")], "requested string, goal string")
    out = ins.project_inspection(requests, spark.createDataFrame(rows, schema), spark.createDataFrame(studies, RECORD).drop("requested"))
    got = {r.requested: r for r in out.collect()}
    assert set(got) == {"PRJNA1", "PRJNA5", "PRJNA7"}
    r = got["PRJNA1"]
    assert (r.title, r.summary, r.tissues, r.record_count, r.backfilled, r.run_count) == ("Own", "islet cells", ["islet"], 2, 2, 2)
    assert (r.linked_sra, r.linked_biosamples, r.organisms) == (["SRX4", "SRX5", "SRP5", "SRR4", "SRR5"], ["SAMN1", "SAMN2"], ["Sus scrofa", "Bos taurus"])
    r = got["PRJNA5"]
    assert (r.linked_sra, r.backfilled, r.run_count, r.title) == (["SRR1", "SRX1"], 0, 1, "only this")
    assert got["PRJNA7"].fit.overall == "low" and set(got["PRJNA7"].risks) == {"linked_sra_unclear", "linked_biosamples_unclear"}
    assert ev.project_inspections(out).where("accession = 'PRJNA1'").first().data_availability["linked_sra_count"] == "5"


def test_backfill_and_union_take_every_level(spark):
    projects = spark.createDataFrame([("P1", []), ("P2", ["SRP0"])], "accession string, linked_sra array<string>")
    found = di.backfill_links(projects, spark.createDataFrame([record("x", 1, "SRX5", "SRP5", ["SRR5", ""], bioproject="P1", experiment_accession="SRX6", sample_accession="SRS1")], RECORD))
    assert {tuple(r) for r in found.collect()} == {("P2", "SRP0", False), *(("P1", x, True) for x in ("SRX5", "SRP5", "SRX6", "SRS1", "SRR5"))}
    a, b = spark.createDataFrame([("s", "r", "x")], "accession string, Run string, Sex string"), spark.createDataFrame([("t", "q", "m")], "accession string, run string, age string")
    both = di.metadata_union(a, b)
    assert both.columns == ["accession", "Run", "Sex", "age"] and sorted(map(tuple, both.collect()), key=repr) == [("s", "r", "x", None), ("t", "q", None, "m")]


def test_slices_equal_plain_slicing(spark):
    rng = random.Random(6)
    records = [(k, "".join(rng.choices("acgtN", k=rng.choice([0, 1, 9, 10, 11, 57])))) for k in range(12)] + [(99, None)]
    places = [(rng.randrange(13), rng.randrange(-5, 60), rng.randrange(-3, 70)) for _ in range(400)]
    text = dict(records)
    frame = spark.createDataFrame(places, "k int, start long, end long")
    got = {(r.k, r.start, r.end): r.slice for r in tl.slices(frame, spark.createDataFrame(records, "k int, seq string"), ["k"], width=10).collect()}
    want = {(k, a, b): text[k][max(a, 0) : b].upper() for k, a, b in places if text.get(k) and b > a and b > 0 and text[k][max(a, 0) : b]}
    assert {k: v for k, v in got.items() if v} == want
    again = tl.tiles(spark.createDataFrame(records, "k int, seq string"), ["k"], width=10).groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tile", "piece"))), lambda t: t["piece"]), "").alias("s"))
    assert {r.k: r.s for r in again.collect()} == {k: s.upper() for k, s in records if s}
