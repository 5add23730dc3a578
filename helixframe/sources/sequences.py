"""Sequence, alignment and annotation sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixframe.functions import seq as sq
from helixframe.functions.rules import flags
from helixframe.functions.text import strip

PROTEIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ*"


def read_fasta(spark: SparkSession, path: str, alphabet: str = "ACGTRYSWKMBDHVN") -> DataFrame:
    """One row per record: identifier, upper-case sequence and findings; records are split at '>' by the scan."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r", "").alias("value"))
    # Only the first record of a file keeps its '>'; text before a first header has none.
    first = F.col("value").startswith(">")
    body = F.when(first, F.expr("substr(value, 2)")).otherwise(F.col("value"))
    rows = raw.where(strip("value") != "").select("path", body.alias("_b"), F.regexp_extract(body, r"^[ \t]*(\S+)", 1).alias("id"))
    rows = rows.withColumn("seq", F.upper(F.regexp_replace(F.regexp_replace("_b", r"^[^\n]*\n?", ""), r"\s+", "")))
    allowed = "^[" + alphabet.replace("-", "\\-").replace("*", "\\*") + "]*$"
    found = flags((F.col("id") == "", "missing_id"), (F.col("seq") == "", "empty_sequence"), (~F.col("seq").rlike(allowed), "invalid_letters"))
    return rows.select("path", "id", "seq", found.alias("findings"))


def repeated_records(records: DataFrame) -> DataFrame:
    """Identifiers used more than once in a file."""
    return records.groupBy("path", "id").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def read_annotator_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records headed `…;start-end;strand;name`; `problem` marks headers that do not follow this form."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "\r", "").alias("value")).where(strip("value") != "")
    head = F.regexp_replace(F.regexp_extract("value", r"^>?([^\n]*)", 1), r"\s+$", "")
    rows = raw.select(head.alias("_h"), F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "")).alias("seq"))
    rows = rows.withColumn("_p", F.transform(F.split("_h", ";"), lambda p: strip(p))).withColumn("_n", F.size("_p"))
    part = lambda k: F.get("_p", F.col("_n") - k)
    place = r"^([0-9]+)-([0-9]+)$"
    ok = (F.col("_n") >= 4) & part(3).rlike(place) & part(2).isin("+", "-") & (part(1) != "")
    number = lambda g: F.when(ok, F.regexp_extract(part(3), place, g).cast("long"))
    return rows.select(
        F.get("_p", F.lit(0)).alias("record_id"), F.when(ok, part(1)).alias("name"), number(1).alias("start"), number(2).alias("end"), F.when(ok, part(2)).alias("strand"), "seq",
        F.when(~ok, "header").alias("problem"),
    )


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reads, references, rejects) of alignment text; rows with fewer than 11 fields or bad numbers are rejects."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    body = lines.where(~F.col("value").startswith("@") & (F.col("value") != "")).withColumn("c", F.split("value", "\t"))
    num = lambda i, t="long": F.expr(f"try_cast(get(c, {i}) AS {t})")
    groups = F.filter(F.slice("c", F.lit(12), F.greatest(F.size("c") - 11, F.lit(0))), lambda t: t.startswith("RG:Z:"))
    reads = body.select(
        F.col("path").alias("sample"), F.get("c", F.lit(0)).alias("qname"), num(1, "int").alias("flag"), F.get("c", F.lit(2)).alias("rname"), num(3).alias("pos"), num(4, "int").alias("mapq"),
        F.get("c", F.lit(5)).alias("cigar"), F.get("c", F.lit(6)).alias("rnext"), num(7).alias("pnext"), num(8).alias("tlen"), F.get("c", F.lit(9)).alias("seq"), F.get("c", F.lit(10)).alias("qual"),
        F.substring(F.get(groups, F.lit(0)), 6, 2**31 - 1).alias("rg"), F.size("c").alias("_n"), F.size(groups).alias("_g"), "value",
    )
    bad = (F.col("_n") < 11) | F.col("flag").isNull() | F.col("pos").isNull() | F.col("mapq").isNull() | (F.col("_g") > 1)
    head = lines.where(F.col("value").startswith("@SQ\t"))
    tags = F.str_to_map(F.expr("substr(value, 5)"), F.lit("\t"), F.lit(":"))
    refs = head.select(F.col("path").alias("sample"), tags.alias("t")).select("sample", F.try_element_at("t", F.lit("SN")).alias("rname"), F.try_element_at("t", F.lit("LN")).cast("long").alias("length"))
    return reads.where(~bad).drop("_n", "_g", "value"), refs, reads.where(bad).select("sample", "value")


def check_reference(references: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected names and lengths against the header; anything but exactly one equal entry is refused."""
    seen = references.groupBy("sample", "rname").agg(F.count("*").alias("_n"), F.max("length").alias("_len"))
    joined = expected.join(seen, ["sample", "rname"], "left")
    return joined.select("sample", "rname", "length", ((F.coalesce("_n", F.lit(0)) == 1) & F.col("_len").eqNullSafe(F.col("length"))).alias("matches"))


# -- search results --------------------------------------------------------------------------------

_HSP = ("query-from", "query-to", "hit-from", "hit-to", "align-len", "identity", "bit-score", "query-strand", "hit-strand", "query-frame", "hit-frame")


def _hsp_type(prefix: str) -> str:
    return "array<struct<" + ",".join(f"`{prefix}{n}`:string" for n in _HSP) + ">>"


_DESCR = "array<struct<id:string,accession:string,taxid:string,title:string>>"
DIALECTS = {
    "xml2": ("Search", f"`query-id` string, `query-title` string, `query-len` string, hits struct<Hit:array<struct<num:string,description:struct<HitDescr:{_DESCR}>,len:string,hsps:struct<Hsp:{_hsp_type('')}>>>>"),
    "legacy": (
        "Iteration",
        f"`Iteration_query-def` string, `Iteration_query-len` string, Iteration_hits struct<Hit:array<struct<Hit_num:string,Hit_id:string,Hit_def:string,Hit_accession:string,Hit_len:string,Hit_hsps:struct<Hsp:{_hsp_type('Hsp_')}>>>>",
    ),
}


def read_blast_xml(spark: SparkSession, path: str, dialect: str = "xml2") -> DataFrame:
    """One row per HSP of a search report in either dialect; a search without hits keeps a row with NULL hit.

    Numbers that are missing or not numbers become NULL and are reported by `hsp.findings`.
    """
    tag, schema = DIALECTS[dialect]
    doc = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    if dialect == "xml2":
        title, length, hits, prefix = F.coalesce("query-title", "query-id"), F.col("query-len"), F.col("hits.Hit"), ""
    else:
        title, length, hits, prefix = F.col("Iteration_query-def"), F.col("Iteration_query-len"), F.col("Iteration_hits.Hit"), "Hsp_"
    base = doc.select(F.regexp_extract(title, r"^(\S+)", 1).alias("query"), length.try_cast("long").alias("query_len"), F.posexplode_outer(hits).alias("hit_no", "h"))
    if dialect == "xml2":
        descr = F.col("h.description.HitDescr")
        first = F.get(descr, F.lit(0))
        names = {"hit": F.coalesce(first["id"], first["accession"]), "accession": F.coalesce(first["accession"], first["id"]), "description": first["title"], "hit_len": F.col("h.len"), "hsps": F.col("h.hsps.Hsp")}
        taxids = F.array_distinct(F.transform(descr, lambda d: d["taxid"].try_cast("long")))
    else:
        accession = F.coalesce("h.Hit_accession", "h.Hit_id")
        names = {"hit": accession, "accession": accession, "description": F.col("h.Hit_def"), "hit_len": F.col("h.Hit_len"), "hsps": F.col("h.Hit_hsps.Hsp")}
        taxids = F.array(F.lit(None).cast("long"))
    flat = base.select("query", "query_len", "hit_no", *[v.alias(k) for k, v in names.items()], taxids.alias("taxids"))
    flat = flat.select("*", F.posexplode_outer("hsps").alias("hsp_no", "p")).drop("hsps")
    number = lambda n, t: F.col(f"p.`{prefix}{n}`").try_cast(t).alias(n.replace("-", "_"))
    strand = lambda side: F.coalesce(F.lower(f"p.`{prefix}{side}-strand`"), F.when(F.col(f"p.`{prefix}{side}-frame`") == "1", "plus").when(F.col(f"p.`{prefix}{side}-frame`") == "-1", "minus"))
    return flat.select(
        "query", "query_len", "hit_no", "hit", "accession", F.regexp_replace(strip("description"), r"\s+", " ").alias("description"), F.col("hit_len").try_cast("long").alias("hit_len"), "taxids", "hsp_no",
        *[number(n, "long") for n in ("query-from", "query-to", "hit-from", "hit-to", "align-len", "identity")], F.col(f"p.`{prefix}bit-score`").try_cast("double").alias("bitscore"),
        strand("query").alias("query_strand"), strand("hit").alias("hit_strand"),
    )


def check_queries(results: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected queries (query, length) against the searches returned: missing, unexpected, other length, repeated."""
    seen = results.select("query", "query_len", "hit_no", "hsp_no").distinct().groupBy("query").agg(
        F.max("query_len").alias("_len"), F.count_if((F.coalesce("hit_no", F.lit(0)) == 0) & (F.coalesce("hsp_no", F.lit(0)) == 0)).alias("_n")
    )
    joined = expected.join(seen, "query", "full_outer")
    state = F.when(F.col("_len").isNull(), "missing").when(F.col("length").isNull(), "unexpected").when(F.col("_len") != F.col("length"), "length_differs").otherwise("ok")
    return joined.select("query", state.alias("state"))


_TAXON = "TaxId:string,ScientificName:string,Rank:string"


def read_taxonomy_xml(spark: SparkSession, path: str) -> DataFrame:
    """Taxa with their lineage from the root down to themselves."""
    doc = spark.read.format("xml").option("rowTag", "TaxaSet").schema(f"Taxon array<struct<{_TAXON},LineageEx:struct<Taxon:array<struct<{_TAXON}>>>>>").load(path)
    taxa = doc.select(F.explode("Taxon").alias("t"))
    node = lambda n: F.struct(n["TaxId"].try_cast("long").alias("taxid"), n["ScientificName"].alias("name"), n["Rank"].alias("rank"))
    above = F.coalesce(F.transform("t.LineageEx.Taxon", node), F.array().cast("array<struct<taxid:bigint,name:string,rank:string>>"))
    me = node(F.col("t"))
    return taxa.select(me["taxid"].alias("taxid"), me["name"].alias("name"), me["rank"].alias("rank"), F.concat(above, F.array(me)).alias("lineage"))


# -- annotated records -----------------------------------------------------------------------------

_SPOT = r"<?\d+(?:\.\.>?\d+)?"
_PART = rf"(?:complement\({_SPOT}\)|{_SPOT})"
LOCATION = rf"^(?:complement\((?:join|order)\({_SPOT}(?:,{_SPOT})*+\)\)|(?:join|order)\({_PART}(?:,{_PART})*+\)|{_PART})$"


def parse_location(text: Column) -> Column:
    """Segments (half-open, transcription order), strand, fuzzy ends; NULL segments when the text is not understood."""
    clean = F.regexp_replace(text, r"\s+", "")
    ok = clean.rlike(LOCATION)
    outer = clean.rlike(r"^complement\((?:join|order)\(")
    leaves = F.regexp_extract_all(clean, F.lit(rf"((?:complement\()?{_SPOT})"), 1)
    turned = F.transform(leaves, lambda p: p.startswith("complement") | outer)

    def segment(p):
        low = F.regexp_extract(p, r"(\d+)", 1).cast("long")
        high = F.regexp_extract(p, r"(\d+)$", 1).cast("long")
        return F.struct((low - 1).alias("start"), high.alias("end"), p.rlike(r"<\d").alias("before"), p.rlike(r">\d").alias("after"))

    parts = F.transform(leaves, segment)
    # complement(join(…)) lists its parts along the sequence; transcription runs the other way.
    ordered = F.when(outer, F.reverse(parts)).otherwise(parts)
    minus, plus = F.forall(turned, lambda t: t), F.forall(turned, lambda t: ~t)
    first, last = F.get(ordered, F.lit(0)), F.element_at(ordered, -1)
    forward = F.exists(ordered, lambda s: s["end"] <= s["start"])
    good = ok & ~forward
    return F.struct(
        F.when(good, F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))).alias("segments"),
        F.when(good, F.when(minus, -1).when(plus, 1).otherwise(0)).alias("strand"),
        F.when(good, F.when(minus, first["after"]).otherwise(first["before"])).alias("partial5"),
        F.when(good, F.when(minus, last["before"]).otherwise(last["after"])).alias("partial3"),
    )


def read_genbank(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, features): one record per row of the scan, features with parsed locations and qualifiers.

    A location outside the supported grammar keeps NULL segments and is reported by `location_findings`.
    """
    raw = spark.read.option("lineSep", "\n//").text(path).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r", "").alias("v")).where(F.col("v").contains("LOCUS"))
    version = F.regexp_extract("v", r"(?m)^VERSION\s+(\S+)", 1)
    locus = F.regexp_extract("v", r"(?m)^LOCUS\s+(\S+)", 1)
    sequence = F.upper(F.regexp_replace(F.regexp_extract("v", r"(?s)\nORIGIN[^\n]*\n(.*)$", 1), r"[^A-Za-z]", ""))
    block = F.regexp_extract("v", r"(?s)\nFEATURES[^\n]*\n(.*?)(?:\nORIGIN|\nCONTIG|\z)", 1)
    rows = raw.select("path", F.when(version != "", version).otherwise(locus).alias("record_id"), sequence.alias("sequence"), block.alias("_f"))
    records = rows.select("path", "record_id", "sequence")
    pieces = F.filter(F.split(F.concat(F.lit("\n"), F.col("_f")), r"\n {5}(?=\S)"), lambda p: strip(p) != "")
    feats = rows.select("path", "record_id", F.posexplode(pieces).alias("ord", "_t"))
    kind = F.regexp_extract("_t", r"^(\S+)", 1)
    place = F.regexp_replace(F.regexp_extract("_t", r"(?s)^\S+\s+(.*?)(?:\n\s+/|\z)", 1), r"\s+", "")
    quals = F.regexp_extract_all("_t", F.lit(r'(?s)\n\s+(/[A-Za-z0-9_]+(?:="(?:[^"]++|"")*+"|=[^\n]*)?)'), 1)

    def pair(q):
        key = F.regexp_extract(q, r"^/([A-Za-z0-9_]+)", 1)
        value = F.regexp_replace(F.regexp_replace(F.regexp_extract(q, r'(?s)^/[A-Za-z0-9_]+="?(.*?)"?$', 1), r"\s*\n\s+", " "), '""', '"')
        return F.struct(key.alias("k"), value.alias("v"))

    feats = feats.withColumn("_q", F.transform(quals, pair)).withColumn("type", kind).withColumn("location", place)
    keys = F.array_distinct(F.transform("_q", lambda p: p["k"]))
    # Sequence qualifiers are wrapped without blanks.
    values = F.transform(keys, lambda k: F.transform(F.filter("_q", lambda p: p["k"] == k), lambda p: F.when(k == "translation", F.replace(p["v"], F.lit(" "), F.lit(""))).otherwise(p["v"])))
    feats = feats.withColumn("qualifiers", F.map_from_arrays(keys, values)).withColumn("_l", parse_location(F.col("location")))
    one = lambda k: F.try_element_at(F.try_element_at("qualifiers", F.lit(k)), F.lit(1))
    features = feats.select(
        "path", "record_id", F.col("ord").cast("long").alias("feature_id"), "type", one("gene").alias("gene"), one("product").alias("product"), F.col("_l.strand").alias("strand"), F.col("_l.segments").alias("segments"),
        F.col("_l.partial5").alias("partial5"), F.col("_l.partial3").alias("partial3"), "qualifiers", "location",
    )
    return records, features


def location_findings(features: DataFrame) -> DataFrame:
    return features.where(F.col("segments").isNull()).select("record_id", F.col("feature_id").cast("string").alias("feature_id"), F.lit("REVIEW").alias("level"), F.lit("LOCATION_UNREADABLE").alias("code"), F.col("location").alias("detail"))
