"""Very long texts: patterns that once recursed per repetition must neither crash the engine nor lose what comes late."""

from pyspark.sql import functions as F

from helixframe.functions import names as nm, seq as sq
from helixframe.sources import sequences as ss


def test_cigar_of_a_hundred_thousand_operations(spark):
    long = "1M1I" * 50_000
    frame = spark.createDataFrame([(1, long), (2, long + "0M"), (3, long[:-1]), (4, "*"), (5, "")], "id int, cigar string")
    got = {r.id: r.n for r in frame.select("id", F.size(sq.cigar_operations(F.col("cigar"))).alias("n")).collect()}
    assert got[1] == 100_000 and all(got[i] in (-1, None) for i in (2, 3, 4, 5))


def test_qualifier_of_a_hundred_thousand_letters(spark, tmp_path):
    protein = "MK" * 50_000
    note = 'a ""quoted"" word ' * 3000
    text = f"LOCUS       R1 10 bp\nVERSION     R1.1\nFEATURES             Location/Qualifiers\n     CDS             1..9\n                     /note=\"{note.strip()}\"\n                     /translation=\"{protein}\"\nORIGIN\n        1 acgtacgtac\n//\n"
    (tmp_path / "r.gb").write_text(text)
    _, features = ss.read_genbank(spark, str(tmp_path / "r.gb"))
    row = features.collect()[0]
    assert row.qualifiers["translation"] == [protein] and row.qualifiers["note"] == [note.strip().replace('""', '"')]


def test_location_and_exceptions_of_many_parts(spark):
    places = ",".join(f"{i * 10 + 1}..{i * 10 + 5}" for i in range(20_000))
    entries = ",".join(f"(pos:{i * 3 + 1}..{i * 3 + 3},aa:Trp)" for i in range(5000))
    frame = spark.createDataFrame([(f"join({places})", entries), (f"complement(join({places}))", entries + ","), (f"join({places},x)", "")], "place string, entries string").coalesce(1)
    got = frame.select(F.size(ss.parse_location(F.col("place"))["segments"]).alias("n"), nm.exceptions_readable(F.col("entries")).alias("ok")).collect()
    assert [r.n for r in got][:2] == [20_000, 20_000] and got[2].n in (-1, None) and [r.ok for r in got] == [True, False, False]


def test_read_group_behind_many_tags(spark, tmp_path):
    core = "r1\t0\tmt\t1\t60\t4M\t*\t0\t0\tACGT\tIIII"
    tags = "\t".join(f"X{i}:i:{i}" for i in range(1500))
    (tmp_path / "a.sam").write_text(f"@SQ\tSN:mt\tLN:10\n{core}\t{tags}\tRG:Z:late\n{core}\n{core}\t{tags}\tRG:Z:a\tRG:Z:b\n")
    reads, _, rejects = ss.read_sam(spark, str(tmp_path / "a.sam"))
    assert sorted(r.rg or "" for r in reads.collect()) == ["", "late"] and rejects.count() == 1


def test_gene_spellings(spark):
    names = {"COI": "cox1", "cox1": "cox1", "cytochrome c oxidase subunit II": "cox2", "cytochrome c oxidase subunit 3": "cox3", "nad4L": "nd4l", "NADH dehydrogenase subunit 6": "nd6", "nad7": "nad7",
             "ATP synthase F0 subunit 8": "atp8", "ATPase synthase subunit 6": "atp6", "tRNA-Leu": "trnl", "tRNA-Xxx": "trnaxxx", "16S ribosomal RNA": "rrnl", "s-rRNA": "rrns", "cob": "cytb", "rrna": "rrna", "other": "other", "": ""}
    frame = spark.createDataFrame(list(names.items()), "name string, want string")
    got = frame.select("name", "want", nm.canonical_gene(F.col("name")).alias("got")).collect()
    assert {r.name: r.got for r in got} == names


def test_paths_after_letters_of_any_script(spark):
    from helixframe.functions import text as tx

    texts = {"see /usr/bin/x": True, "é/usr/bin/x": False, "a/usr/bin": False, "http://a/b": False, "/only": False, "/a/b": True, "x:/a/b": False, "(/home/me/f)": True}
    frame = spark.createDataFrame(list(texts.items()), "t string, want boolean")
    assert {r.t: "path" in r.f for r in frame.select("t", tx.privacy_flags(F.col("t")).alias("f")).collect()} == texts
