"""Readers and writers against small files."""

import json

import pytest
from pyspark.sql import functions as F

from helixframe.operators import hsp, reads as rd
from helixframe.sinks import files
from helixframe.sources import catalogue as ca, sequences as sx, tables as tb


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_delimited_finds_separator_and_header(spark, tmp_path):
    df = tb.read_delimited(spark, put(tmp_path, "de.tsv", "gene\tlog2FoldChange\tpadj\na\t1.5\t0.01\nb\t-2\tNA\n"))
    assert df.columns == ["gene", "log2FoldChange", "padj"] and df.count() == 2
    assert tb.sniff_separator(spark, put(tmp_path, "x.csv", "a,b\n1,2\n")) == ","
    assert not tb.has_header(spark, put(tmp_path, "y.csv", "1,2\n3,4\n"), ",")


def test_id_list_is_distinct_without_missing(spark, tmp_path):
    rows = tb.read_id_list(spark, put(tmp_path, "bg.txt", "a\nb\nNA\na\n")).collect()
    assert sorted(r.gene for r in rows) == ["a", "b"]


def test_run_table_trims(spark, tmp_path):
    row = tb.read_run_table(spark, put(tmp_path, "run.csv", "Run , BioSample\n SRR1 , SAMN2 \n")).first()
    assert row.asDict() == {"Run": "SRR1", "BioSample": "SAMN2"}


def test_fasta(spark, tmp_path):
    rows = sx.read_fasta(spark, put(tmp_path, "a.fa", ">one description\nacgt N\n>two\nTTAA\n")).collect()
    assert sorted((r.id, r.seq) for r in rows) == [("one", "ACGTN"), ("two", "TTAA")] and not any(r.findings for r in rows)
    bad = sx.read_fasta(spark, put(tmp_path, "b.fa", ">x\nAC1\n>x\n\n"))
    assert {f for r in bad.collect() for f in r.findings} == {"invalid_letters", "empty_sequence"}
    assert sx.repeated_records(bad).count() == 1


FASTQ = "".join(f"@r{i}/1 extra\nACGT\n+\nIII{'@' if i % 2 else 'I'}\n" for i in range(500))


def test_fastq_order_and_pairing(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        one = tb.read_fastq(spark, put(tmp_path, "r1.fq", FASTQ))
        two = tb.read_fastq(spark, put(tmp_path, "r2.fq", FASTQ.replace("/1", "/2").replace("@r7/2", "@rX/2")))
        rows = one.orderBy("ord").collect()
        assert [r.id for r in rows] == [f"r{i}/1" for i in range(500)] and not any(r.findings for r in rows)
        lane = lambda df: df.withColumn("lane", F.lit("L"))
        status = rd.lane_status(rd.pair_mates(lane(one), lane(two))).first()
        assert (status.pairs, status.problems, status.first_bad, status.status) == (500, 1, 7, "refused")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_truncated_fastq(spark, tmp_path):
    rows = tb.read_fastq(spark, put(tmp_path, "t.fq", "@a\nAC\n+\nII\n@b\nAC\n+\n")).orderBy("ord").collect()
    assert rows[0].findings == [] and "truncated" in rows[1].findings


def test_sam(spark, tmp_path):
    text = "@HD\tVN:1.6\n@SQ\tSN:mt\tLN:100\nr\t0\tmt\t1\t60\t4M\t=\t1\t0\tACGA\tIIII\tRG:Z:a\nshort\t0\n"
    reads, refs, rejects = sx.read_sam(spark, put(tmp_path, "a.sam", text))
    row = reads.first()
    assert (row.qname, row.flag, row.pos, row.rg) == ("r", 0, 1, "a") and rejects.count() == 1
    sample = refs.first().sample
    expected = spark.createDataFrame([(sample, "mt", 100), (sample, "other", 5)], "sample string, rname string, length long")
    assert {r.rname: r.matches for r in sx.check_reference(refs, expected).collect()} == {"mt": True, "other": False}


def test_gff_and_annotator_fasta(spark, tmp_path):
    row = tb.read_gff(spark, put(tmp_path, "r.gff", "##gff\nmt\tMITOS\tgene\t1\t9\t.\t+\t.\tName=cox1;x=y\nbad\trow\n")).where("problem IS NULL").first()
    assert (row.record_id, row.name, row.start, row.end, row.strand) == ("mt", "cox1", 1, 9, "+")
    rows = sx.read_annotator_fasta(spark, put(tmp_path, "r.fas", ">mt;1-9;+;cox1\nATGAAATAA\n>mt;x;y;2-4;-;nad1\nATG\n>broken\nA\n")).collect()
    assert {(r.name, r.start, r.end, r.strand) for r in rows if r.problem is None} == {("cox1", 1, 9, "+"), ("nad1", 2, 4, "-")}
    assert sum(r.problem == "header" for r in rows) == 1


def test_other_tables(spark, tmp_path):
    row = tb.read_blast_table(spark, put(tmp_path, "b.tsv", "q\tt\t99.5\t50\t1\t50\t150\t101\t1e-5\n")).first()
    assert (row.strand, row.start, row.end) == ("-", 101, 150)
    row = tb.read_paf(spark, put(tmp_path, "p.paf", "q\t100\t5\t95\t+\tt\t200\t10\t100\t80\t90\t60\n")).first()
    assert (row.start, row.end, row.target_start, row.target_end) == (5, 95, 10, 100)
    text = "#rname\tstartpos\tendpos\tnumreads\tcovbases\tcoverage\tmeandepth\tmeanbaseq\tmeanmapq\nt0001_001\t1\t1000\t42\t900\t90.00\t12.50\t35.00\t58.00\n"
    row = tb.read_coverage_table(spark, put(tmp_path, "c.tsv", text)).first()
    assert (row.rname, row.reads, row.mean_depth) == ("t0001_001", 42, 12.5)


XML2 = """<?xml version="1.0"?><BlastXML2 xmlns="http://www.ncbi.nlm.nih.gov"><BlastOutput2><report><Report><results><Results><search>
<Search><query-id>Q1</query-id><query-title>q1 title</query-title><query-len>800</query-len><hits>
<Hit><num>1</num><description><HitDescr><id>gb|A</id><accession>A.1</accession><taxid>7</taxid><title>first  hit</title></HitDescr><HitDescr><id>gb|B</id><accession>B.1</accession><taxid>9606</taxid><title>same</title></HitDescr></description><len>1000</len>
<hsps><Hsp><num>1</num><bit-score>250</bit-score><identity>400</identity><query-from>1</query-from><query-to>400</query-to><query-strand>Plus</query-strand><hit-from>1</hit-from><hit-to>400</hit-to><hit-strand>Plus</hit-strand><align-len>400</align-len></Hsp>
<Hsp><num>2</num><bit-score>250</bit-score><identity>400</identity><query-from>401</query-from><query-to>800</query-to><hit-from>401</hit-from><hit-to>800</hit-to><hit-strand>Minus</hit-strand><align-len>400</align-len></Hsp></hsps></Hit>
</hits></Search></search></Results></results></Report></report></BlastOutput2></BlastXML2>"""
LEGACY = """<?xml version="1.0"?><BlastOutput><BlastOutput_iterations><Iteration><Iteration_query-def>q9 x</Iteration_query-def><Iteration_query-len>100</Iteration_query-len><Iteration_hits>
<Hit><Hit_num>1</Hit_num><Hit_id>id1</Hit_id><Hit_def>a hit</Hit_def><Hit_accession>X1</Hit_accession><Hit_len>500</Hit_len><Hit_hsps><Hsp><Hsp_bit-score>90.5</Hsp_bit-score><Hsp_query-from>1</Hsp_query-from><Hsp_query-to>100</Hsp_query-to><Hsp_hit-from>200</Hsp_hit-from><Hsp_hit-to>101</Hsp_hit-to><Hsp_query-frame>1</Hsp_query-frame><Hsp_hit-frame>-1</Hsp_hit-frame><Hsp_identity>98</Hsp_identity><Hsp_align-len>100</Hsp_align-len></Hsp></Hit_hsps></Hit>
</Iteration_hits></Iteration></BlastOutput_iterations></BlastOutput>"""


def test_blast_xml_both_dialects(spark, tmp_path):
    rows = sx.read_blast_xml(spark, put(tmp_path, "x.xml", XML2))
    first = rows.orderBy("hsp_no").first()
    assert (first.query, first.query_len, first.hit, first.taxids, first.identity, first.bitscore) == ("q1", 800, "gb|A", [7, 9606], 400, 250.0)
    bad = hsp.findings(rows, strand_text=True).collect()
    assert [r.reasons for r in bad] == [["strand_contradiction"]]
    hit = hsp.hit_summaries(rows).first()
    assert (hit.identity, hit.coverage, hit.ranking_bitscore) == (100.0, 1.0, 500.0)
    old = sx.read_blast_xml(spark, put(tmp_path, "l.xml", LEGACY), "legacy").first()
    assert (old.query, old.hit, old.hit_from, old.hit_strand, old.bitscore) == ("q9", "X1", 200, "minus", 90.5)
    expected = spark.createDataFrame([("q1", 800), ("q2", 5)], "query string, length long")
    assert {r.query: r.state for r in sx.check_queries(rows, expected).collect()} == {"q1": "ok", "q2": "missing"}


def test_taxonomy_xml(spark, tmp_path):
    text = "<TaxaSet><Taxon><TaxId>7</TaxId><ScientificName>seven</ScientificName><Rank>species</Rank><LineageEx><Taxon><TaxId>1</TaxId><ScientificName>root</ScientificName><Rank>no rank</Rank></Taxon><Taxon><TaxId>50557</TaxId><ScientificName>Insecta</ScientificName><Rank>class</Rank></Taxon></LineageEx></Taxon></TaxaSet>"
    row = sx.read_taxonomy_xml(spark, put(tmp_path, "t.xml", text)).first()
    assert (row.taxid, [n.taxid for n in row.lineage]) == (7, [1, 50557, 7])


GENBANK = """LOCUS       mt                    40 bp    DNA     circular
VERSION     mt.1
FEATURES             Location/Qualifiers
     source          1..40
                     /organism="Some species"
     CDS             complement(join(<2..10,
                     20..31))
                     /gene="cox1"
                     /note="two
                     lines"
                     /codon_start=1
                     /translation="MK
                     LV"
     tRNA            join(35..40,1..>3)
                     /product="tRNA-Leu"
     rRNA            4^5
                     /product="16S"
ORIGIN
        1 acgtacgtac gtacgtacgt acgtacgtac gtacgtacgt
//
"""


def test_genbank(spark, tmp_path):
    records, features = sx.read_genbank(spark, put(tmp_path, "a.gb", GENBANK))
    rec = records.first()
    assert rec.record_id == "mt.1" and rec.sequence == "ACGT" * 10
    by = {r.type: r for r in features.collect()}
    cds = by["CDS"]
    assert [(s.start, s.end) for s in cds.segments] == [(19, 31), (1, 10)] and cds.strand == -1
    assert (cds.partial5, cds.partial3) == (False, True)
    assert cds.qualifiers["note"] == ["two lines"] and cds.qualifiers["translation"] == ["MKLV"] and cds.gene == "cox1"
    assert [(s.start, s.end) for s in by["tRNA"].segments] == [(34, 40), (0, 3)] and by["tRNA"].partial3
    assert sx.location_findings(features).first().detail == "4^5"


def test_json_documents_reject_duplicates_and_nan(spark, tmp_path):
    good = {"changes": [{"sequence_id": "mt", "position": 4, "old": "T", "new": "C", "evidence": "e", "rationale": "r"}]}
    put(tmp_path, "a.json", json.dumps(good, indent=1))
    put(tmp_path, "b.json", '{"changes": [], "changes": []}')
    put(tmp_path, "c.json", '{"changes": NaN}')
    put(tmp_path, "d.json", '{"changes": []}')
    edits, rejects = tb.read_edits(spark, str(tmp_path))
    assert edits.first().position == 4 and edits.count() == 1
    assert sorted(r.path[-6:] for r in rejects.collect()) == ["b.json", "c.json", "d.json"]


def test_hashes_and_drift(spark, tmp_path):
    import hashlib

    put(tmp_path, "f.txt", "hello")
    row = tb.file_hashes(spark, str(tmp_path / "f.txt")).first()
    assert (row.sha256, row.size) == (hashlib.sha256(b"hello").hexdigest(), 5)


def test_catalogue_records(spark, tmp_path):
    geo = {"Id": "1", "accession": "GSE1", "title": " t ", "taxon": ["Sus scrofa", " "], "gpl": "123;GPL5", "samples": [{"accession": "GSM1"}, {"accession": "GSM2"}], "pdat": "2020", "Projects": [{"name": "PRJNA9"}, "x"], "gdstype": "array"}
    row = ca.series_records(ca.read_payloads(spark, put(tmp_path, "g.json", json.dumps(geo)))).first()
    assert (row.uid, row.taxon, row.platform, row.samples, row.bioproject, row.publication_date) == ("1", "Sus scrofa", "GPL123; GPL5", 2, "PRJNA9; x", "2020")
    exp = '<Summary><Title>A title</Title><Platform instrument_model="X1">I</Platform></Summary><Submitter acc="SRA5"/><Experiment acc="SRX7"/><Organism ScientificName="Sus scrofa"/><Library_descriptor><LIBRARY_STRATEGY>RNA-Seq</LIBRARY_STRATEGY><LIBRARY_LAYOUT> <PAIRED/></LIBRARY_LAYOUT></Library_descriptor><Bioproject>PRJNA3</Bioproject><Biosample>SAMN4</Biosample>'
    sra = {"uid": 5, "expxml": exp, "runs": '<Run acc="SRR1"/><Run acc="srr1"/><Run acc="SRR2"/>'}
    row = ca.study_records(ca.read_payloads(spark, put(tmp_path, "s.json", json.dumps(sra)))).first()
    assert (row.accession, row.source_type, row.title, row.organism, row.library_strategy, row.library_layout, row.platform) == ("SRX7", "experiment", "A title", "Sus scrofa", "RNA-Seq", "PAIRED", "X1")
    assert (row.run_count, row.sample_count, row.bioproject, row.biosample, row.run_accessions) == (2, 1, "PRJNA3", "SAMN4", ["SRR1", "SRR1", "SRR2"])
    project = {"uid": "9", "Project_Acc": "PRJNA1", "Project_Title": "On gallus gallus", "Project_Description": "see\nsrr12 and SAMN1", "x": {"y": ["SRP2"]}}
    row = ca.project_records(ca.read_payloads(spark, put(tmp_path, "p.json", json.dumps(project)))).first()
    assert (row.accession, row.organism, row.linked_sra, row.linked_biosamples) == ("PRJNA1", "gallus gallus", ["SRP2", "SRR12"], ["SAMN1"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("KEGG", "t1", ["a", "b"])], "collection string, term_id string, gene_ids array<string>")
    files.write_results(df, str(tmp_path / "r"), ["collection"])
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).first().gene_ids == "a/b"
    with pytest.raises(Exception):
        files.write_results(df, str(tmp_path / "r"))
    seqs = spark.createDataFrame([("x", "A" * 130)], "id string, seq string")
    assert files.fasta_lines(seqs, 60).first().value.split("\n") == [">x", "A" * 60, "A" * 60, "A" * 10]
    files.write_fasta(seqs, str(tmp_path / "fa"))
    assert sx.read_fasta(spark, str(tmp_path / "fa")).first().seq == "A" * 130
    reads = spark.createDataFrame([(1, "b/1", "AC", "II"), (1, "a/1", "GT", "II"), (2, "a/2", "TT", "II")], "mate int, name string, seq string, qual string")
    files.write_fastq(reads, str(tmp_path / "fq"))
    back = tb.read_fastq(spark, str(tmp_path / "fq" / "mate=1")).orderBy("path", "ord").collect()
    assert [r.id for r in back] == ["a/1", "b/1"]
    assert files.write_payload(df, str(tmp_path / "j")).first().records == 1
    hits = spark.createDataFrame([("t", 5, "g")], "target string, start int, gene string")
    files.write_located_genes(hits, str(tmp_path / "loc"))
    assert spark.read.text(str(tmp_path / "loc")).first().value == "t\t5\tg"
