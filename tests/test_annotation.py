"""Coding-sequence checks, exceptions, gene orders and edits on small records."""

import pytest
from pyspark.sql import functions as F

from helixframe.functions import names as nm
from helixframe.operators import annot as an, circular as ci, edits as ed

FEATURE = "record_id string, feature_id string, type string, gene string, product string, strand int, segments array<struct<start:bigint,end:bigint>>, partial5 boolean, partial3 boolean, qualifiers map<string,array<string>>"
NOTE = "stop codon is completed by the addition of 3' A residues to the mRNA"


def findings(spark, sequence, table, quals=None, strand=1, registry=None, taxon=None, starts=None):
    feats = spark.createDataFrame([("r", "f", "CDS", "cox1", None, strand, [(0, len(sequence))], False, False, quals or {})], FEATURE)
    records = spark.createDataFrame([("r", sequence)], "record_id string, sequence string")
    cds = an.coding_features(an.named(feats), records, table)
    return {(r.level, r.code): r.detail for r in an.cds_findings(cds, table, registry, starts, taxon).collect()}


def test_poly_a_completion(spark):
    seq = "ATG" + "AAA" * 9 + "T"
    got = findings(spark, seq, 5, {"transl_except": ["(pos:31,aa:TERM)"], "note": [NOTE]})
    assert ("INFO", "PARTIAL_STOP_COMPLETION_VALIDATED") in got and not any(k[0] == "ERROR" for k in got)
    got = findings(spark, seq, 5, {"transl_except": ["(pos:28,aa:TERM)"], "note": [NOTE]})
    assert ("REVIEW", "TRANSL_EXCEPT_UNEXPLAINED") in got


def test_incomplete_stops_by_table(spark):
    assert findings(spark, "ATGAAATA", 2)[("REVIEW", "INCOMPLETE_STOP")] == "TA"
    assert ("ERROR", "INVALID_CDS") in findings(spark, "ATGAAATA", 6)
    for seq in ("ATGAAAT", "ATGAAATA"):
        got = findings(spark, seq, 5)
        assert ("REVIEW", "INCOMPLETE_STOP") in got and ("ERROR", "INVALID_CDS") not in got


def test_ambiguous_codon(spark):
    assert findings(spark, "ATGNNNTAA", 5)[("REVIEW", "AMBIGUOUS_CODON")] == "2:4,5,6"


REGISTRY = "gene string, codon string, amino_acid string, codon_index long, positions array<bigint>, gene_wide boolean, transl_table int, taxon string, source string, rationale string"


def test_internal_stop_needs_a_registered_exception(spark):
    seq, quals = "ATGTAGAAATAA", {"transl_except": ["(pos:4..6,aa:Trp)"]}
    assert ("ERROR", "INTERNAL_STOP") in findings(spark, seq, 5, quals)

    def with_record(taxon="Insecta", **change):
        row = {"gene": "cox1", "codon": "TAG", "amino_acid": "Trp", "codon_index": 2, "positions": None, "gene_wide": False, "transl_table": 5, "taxon": "Insecta", "source": "s", "rationale": "r", **change}
        return findings(spark, seq, 5, quals, registry=spark.createDataFrame([tuple(row.values())], REGISTRY), taxon=taxon)

    good = with_record()
    assert ("INFO", "TRANSL_EXCEPT_VALIDATED") in good and ("ERROR", "INTERNAL_STOP") not in good
    for change in (dict(codon_index=3), dict(transl_table=2), dict(taxon="Aves"), dict(source=" "), dict(codon="TAA")):
        sample = {"taxon": "Insecta"} if "taxon" not in change else {}
        got = with_record(**{k: v for k, v in change.items() if k != "taxon"}) if sample else with_record("Aves")
        assert ("ERROR", "INTERNAL_STOP") in got and ("REVIEW", "TRANSL_EXCEPT_DECLARED_UNVERIFIED") in got
    assert ("ERROR", "INTERNAL_STOP") in with_record(taxon=None)


@pytest.mark.parametrize(
    "text, positions, complement, mixed",
    [
        ("(pos:10,aa:TERM)", [10], False, False), ("(pos:10..12,aa:Trp)", [10, 11, 12], False, False), ("(pos:complement(10..12),aa:Trp)", [10, 11, 12], True, False),
        ("(pos:join(10..11,20),aa:Trp)", [10, 11, 20], False, False), ("(pos:complement(join(10..11,20)),aa:Trp)", [10, 11, 20], True, False),
        ("(pos:join(complement(10..11),12),aa:Trp)", [10, 11, 12], False, True),
    ],
)
def test_exception_grammar(spark, text, positions, complement, mixed):
    e = spark.createDataFrame([(text,)], "v string").select(nm.parse_exceptions(F.col("v")).alias("e")).first().e
    assert len(e) == 1 and (e[0].positions, e[0].complement, e[0].mixed) == (positions, complement, mixed)


def test_unreadable_exceptions_are_refused_whole(spark):
    bad = ["", "(pos:10..12,aa:Trp) x", "(pos:10..12,aa:Trp),", "(pos:12..10,aa:Trp)", "(pos:<10..12,aa:Trp)", "(pos:10^11,aa:Trp)", "(10..12,aa:Trp)", "(pos:10..12,aa:)"]
    df = spark.createDataFrame([(b,) for b in bad], "v string")
    assert not any(r.ok for r in df.select(nm.exceptions_readable(F.col("v")).alias("ok")).collect())
    two = spark.createDataFrame([("(pos:1..3,aa:Trp),(pos:4..6,aa:Met)",)], "v string").select(nm.parse_exceptions(F.col("v")).alias("e")).first().e
    assert [x.amino_acid for x in two] == ["Trp", "Met"]


def test_minus_strand_compound(spark):
    # The gene runs over the origin on the minus strand: segments in transcription order.
    feats = spark.createDataFrame([("r", "f", "CDS", "nad1", None, -1, [(0, 4), (7, 12)], False, False, {})], FEATURE)
    records = spark.createDataFrame([("r", "TCATGGGTTATT")], "record_id string, sequence string")
    row = an.coding_features(an.named(feats), records, 5).first()
    assert row.name == "nd1" and row.coding == "ATGAAATAA"[:4] + "AATAA" and row.positions == [4, 3, 2, 1, 12, 11, 10, 9, 8]


def test_findings_lay_down_nothing_for_every_base(spark, monkeypatch):
    """Codons of exceptions and of other letters are told from the segments, overlapping and on either strand, as the listed positions tell them."""
    sequence = "ATGNAATAGTCANNTTTAGGCATAACATGAAATTTAGCCATANNTAG" * 2
    shapes = [(1, [(0, 30), (29, 60)]), (-1, [(40, 70), (3, 41)]), (1, [(50, 90), (0, 20)]), (-1, [(0, 25), (60, 91)])]
    feats, wanted = [], {}
    for i, (strand, segments) in enumerate(shapes):
        for start in (1, 2, 3):
            listed = [p for s, e in segments for p in (range(s + 1, e + 1) if strand > 0 else range(e, s, -1))][start - 1 :]
            codons = [sorted(listed[k : k + 3]) for k in range(0, len(listed) - 2, 3)]
            where = lambda c: ("join(%s)" if len(set(c)) == 3 and c[2] - c[0] != 2 else "%s") % (f"{c[0]}..{c[2]}" if c[2] - c[0] == 2 else ",".join(map(str, c)))
            texts = [f"(pos:{'complement(%s)' % where(c) if strand < 0 else where(c)},aa:Trp)" for c in codons[::3]]
            feats.append(("r", f"{i}.{start}", "CDS", "cox1", None, strand, segments, True, True, {"transl_except": texts, "codon_start": [str(start)]}))
            wanted[f"{i}.{start}"] = listed, codons
    laid = []
    monkeypatch.setattr(an, "cut_lineage", lambda df: laid.append(df.columns) or df)
    cds = an.coding_features(an.named(spark.createDataFrame(feats, FEATURE)), spark.createDataFrame([("r", sequence)], "record_id string, sequence string"), 5)
    got = an.cds_findings(cds, 5).collect()
    assert not {"positions", "codons", "coding", "protein", "spliced"} & set(laid[-1])
    vague = [(r.feature_id, r.detail.split(":")) for r in got if r.code == "AMBIGUOUS_CODON"]
    assert vague and all(places == ",".join(str(p) for p in wanted[f][0][3 * (int(c) - 1) :][:3]) for f, (c, places) in vague)
    problems = [r.detail.rsplit(":", 1)[1] for r in got if r.code == "TRANSL_EXCEPT_UNEXPLAINED" and ":" in r.detail]
    assert "not_a_stop" in problems and "no_such_codon" not in problems and any(r.code == "TRANSL_EXCEPT_MATCHED" for r in got)


def test_protein_frames(spark):
    rows = [("r", "a", "ATGAGATAA", "MS"), ("r", "b", "ATTAAATAA", "MK*"), ("r", "c", "ATGAGATAA", ""), ("r", "d", "ATGAGATAA", "XX")]
    df = spark.createDataFrame(rows, "record_id string, name string, nt string, protein string")
    assert {r.name: r.offset for r in an.protein_frames(df, 5).collect()} == {"a": 0, "b": 0, "c": None, "d": None}
    assert {r.name: r.offset for r in an.protein_frames(df.where("name = 'a'"), 2).collect()} == {"a": None}


def test_bare_trna_is_undetermined(spark):
    rows = [("r", str(i), "tRNA", g, None, 1, [(0, 66)], False, False, q) for i, (g, q) in enumerate([("trnL", {}), ("trnL", {"anticodon": ["(pos:1..3,aa:Leu,seq:taa)"]}), ("trnS1", {})])]
    got = an.named(spark.createDataFrame(rows, FEATURE))
    assert [r.identity for r in got.orderBy("feature_id").collect()] == [None, "trnl2", "trns1"]
    missing = {r.detail for r in an.gene_set_findings(got).where("code = 'MISSING_GENE'").collect()}
    assert "tRNA:trnl1" not in missing and "tRNA:trns2" in missing and "CDS:cox1" in missing


def test_cycles(spark):
    def cycle(record, genes):
        return [(record, i, g.lstrip("-"), "-" if g.startswith("-") else "+") for i, g in enumerate(genes)]

    rows = cycle("a", ["x", "y", "-z"]) + cycle("rot", ["-z", "x", "y"]) + cycle("rev", ["z", "-y", "-x"]) + cycle("swap", ["y", "x", "-z"]) + cycle("sub", ["x", "y"]) + cycle("one", ["x"])
    cycles = spark.createDataFrame(rows, "record string, ord int, name string, strand string")
    comps = spark.createDataFrame([(k, "a", k) for k in ("rot", "rev", "swap", "sub", "one")], "comparison string, record_a string, record_b string")
    got = {r.comparison: r for r in ci.compare_orders(cycles, comps).collect()}
    assert got["rot"].equivalent and got["rev"].equivalent and not got["swap"].equivalent and got["swap"].different_pairs > 0
    assert not got["sub"].equivalent and got["sub"].different_pairs == 0 and got["sub"].missing_genes == 1
    assert got["one"].different_pairs == 0


def test_base_edits(spark):
    records = spark.createDataFrame([("s", "mt", "ACGTN"), ("s", "mt2", "TTAA"), ("bad", "mt", "ACGT")], "set_id string, sequence_id string, seq string")
    schema = "set_id string, sequence_id string, position long, old string, new string, evidence string, rationale string"
    rows = [("s", "mt", 4, "T", "C", "e", "r"), ("s", "mt2", 2, "T", "C", "e", "r"), ("bad", "mt", 1, "C", "G", "e", "r"), ("bad", "mt", 9, "A", "G", "", "r")]
    got = {(r.set_id, r.sequence_id): r.seq for r in ed.apply_base_edits(spark.createDataFrame(rows, schema), records).collect()}
    assert got == {("s", "mt"): "ACGCN", ("s", "mt2"): "TCAA"}
    why = {(r.position): r.reasons for r in ed.base_edit_reasons(spark.createDataFrame(rows, schema), records).where("set_id = 'bad'").collect()}
    assert why == {1: ["old_base_differs"], 9: ["outside_sequence", "no_evidence"]}


def test_boundary_edit(spark):
    feats = spark.createDataFrame([("r", "f", "CDS", "cox1", None, 1, [(0, 9)], False, False, {"gene": ["cox1"], "transl_except": ["x"], "translation": ["MK"]})], FEATURE)
    records = spark.createDataFrame([("r", "ATGAAATAA")], "record_id string, sequence string")
    schema = "edit_id string, record_id string, selector_qualifier string, selector_value string, old_start int, old_end int, old_strand int, new_start int, new_end int, new_strand int, old_codon_start int, new_codon_start int, evidence string, rationale string"
    edits = spark.createDataFrame([("e", "r", "gene", "cox1", 1, 9, 1, 1, 6, 1, 1, 1, "ev", "why")], schema)
    row = ed.boundary_edits(edits, feats, records).first()
    assert (row.reasons, row.translation_before, row.translation_after, row.drops_transl_except) == ([], "MK*", "MK", True)
    changed = ed.apply_boundary_edits(edits, feats, records).first()
    assert [(s.start, s.end) for s in changed.segments] == [(0, 6)] and "transl_except" not in changed.qualifiers and changed.qualifiers["codon_start"] == ["1"]


def test_registry_findings(spark):
    schema = "ord int, gene string, codon string, amino_acid string, codon_index long, pos string, scope string, transl_table long, taxon string"
    rows = [
        (0, "cox1", " tag ", "Trp", 2, None, None, 5, "Insecta"), (1, "(x)", "TAG", "Trp", 2, None, None, 5, "Insecta"), (2, "cox1", "TA", None, None, None, None, None, None),
        (3, "cox1", "TAG", "Xyz", 2, "4..6", None, 5, "A"), (4, "cox1", "TTG", None, None, None, None, None, None), (5, "COI", "ttg", None, None, None, None, None, None), (6, "nad1", "TAG", "Trp", None, None, None, 5, "A"),
    ]
    got = {r.ord: set(r.findings) for r in an.registry_findings(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: {"gene"}, 2: {"codon"}, 3: {"amino_acid", "site_binding"}, 4: {"duplicate"}, 5: {"duplicate"}, 6: {"site_binding"}}
