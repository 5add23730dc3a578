"""Annotation checks: order lines act as features of suppliers, events as gene orders of users."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import names as nm, seq as sq
from helixframe.operators import annot as an, circular as ci
from helixframe.queries.registry import query
from helixframe.queries.sequence import DNA

SPELLINGS = [
    "ATP6", "atp8", "COI", "cox2", "cox-3", "cob", "nad1", "NAD2", "nd3", "NADH dehydrogenase subunit 4", "NADH dehydrogenase subunit 4L", "nad5", "ND6", "16S rRNA", "12S ribosomal RNA", "l-rRNA",
    "tRNA-Leu", "trnL1(tag)", "tRNA-Ser", "trnS2", "tRNA-Ala", "cytochrome c oxidase subunit I", "cytochrome c oxidase subunit III", "ATP synthase F0 subunit 6", "cytochrome b", "trnM", "orf12", "ribosomal RNA",
    "ATPase synthase subunit 8", "cytb2",
]
CANON = [
    "atp6", "atp8", "cox1", "cox2", "cox3", "cytb", "nd1", "nd2", "nd3", "nd4", "nd4l", "nd5", "nd6", "rrnl", "rrns", "rrnl",
    "trnl", "trnl1", "trns", "trns2", "trna", "cox1", "cox3", "atp6", "cytb", "trnm", "orf12", "rrna",
    "atp8", "cytb",
]


def pick(values: list[str]) -> str:
    return "CASE l_partkey % 30 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def kind_of(name: str) -> str:
    return "tRNA" if name.startswith("trn") else "rRNA" if name.startswith("rrn") else "CDS"


# A record is an order; feature numbers follow the line, part and supplier.
FEATURES = f"""SELECT CAST(l_orderkey AS STRING) AS record_id, l_linenumber * 100000000000 + l_partkey * 100000 + l_suppkey AS feature_id, {pick([kind_of(c) for c in CANON])} AS type,
  {pick(SPELLINGS)} AS gene, {pick(CANON)} AS canon, CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END AS strand, l_linenumber * 40 AS s1, l_linenumber * 40 + CAST(l_quantity AS BIGINT) * 2 AS e1,
  CASE WHEN l_tax > 0.045 THEN l_linenumber * 40 + 150 END AS s2, CASE WHEN l_tax > 0.045 THEN l_linenumber * 40 + 150 + CAST(l_quantity AS BIGINT) END AS e2, CASE WHEN l_discount > 0.05 THEN 'seq:tag' END AS ac,
  CASE WHEN l_extendedprice > 50000 THEN 'x' END AS note FROM {{lineitem}}"""
UNIQ = f"SELECT * FROM ({FEATURES}) QUALIFY row_number() OVER (PARTITION BY record_id, feature_id ORDER BY s1, e1, strand, s2, ac, note) = 1"


def features(t):
    f = t.sql(FEATURES)
    seg = lambda a, b: F.struct(F.col(a).cast("long").alias("start"), F.col(b).cast("long").alias("end"))
    segments = F.when(F.col("s2").isNull(), F.array(seg("s1", "e1"))).otherwise(F.array(seg("s1", "e1"), seg("s2", "e2")))
    pairs = F.array(F.struct(F.lit("anticodon").alias("k"), F.col("ac").alias("v")), F.struct(F.lit("note").alias("k"), F.col("note").alias("v")))
    quals = F.map_from_entries(F.transform(F.filter(pairs, lambda p: p["v"].isNotNull()), lambda p: F.struct(p["k"], F.array(p["v"]))))
    f = f.select("record_id", "feature_id", "type", "gene", F.lit(None).cast("string").alias("product"), "strand", segments.alias("segments"), F.lit(False).alias("partial5"), F.lit(False).alias("partial3"), quals.alias("qualifiers"))
    return an.named(f)


@query("annot_canonical_names", f"SELECT gene, canon AS name, CASE WHEN canon IN {nm.EXPECTED_TRNA} THEN canon WHEN canon = 'trnl' AND ac IS NOT NULL THEN 'trnl1' END AS identity, COUNT(*) AS n FROM ({FEATURES}) GROUP BY ALL")
def canonical(t):
    return features(t).groupBy("gene", "name", "identity").agg(F.count("*").alias("n"))


EXPECTED = ", ".join(f"('{k}', '{g}')" for k, genes in (("CDS", nm.EXPECTED_CDS), ("tRNA", nm.EXPECTED_TRNA), ("rRNA", nm.EXPECTED_RRNA)) for g in genes)
SET = f"""rw AS (SELECT record_id, type AS kind, canon AS name, CASE WHEN type <> 'tRNA' THEN canon WHEN canon IN {nm.EXPECTED_TRNA} THEN canon WHEN canon = 'trnl' AND ac IS NOT NULL THEN 'trnl1' END AS gene FROM ({FEATURES})),
  ct AS (SELECT record_id, kind, gene, COUNT(*) AS n FROM rw WHERE gene IS NOT NULL GROUP BY ALL), ex(kind, gene) AS (VALUES {EXPECTED}), rc AS (SELECT DISTINCT record_id FROM rw),
  bare AS (SELECT record_id, name, COUNT(*) AS n FROM rw WHERE kind = 'tRNA' AND gene IS NULL AND name IN ('trnl', 'trns') GROUP BY ALL),
  ms AS (SELECT rc.record_id, ex.kind, ex.gene FROM rc CROSS JOIN ex ANTI JOIN ct ON ct.record_id = rc.record_id AND ct.kind = ex.kind AND ct.gene = ex.gene),
  ms2 AS (SELECT * FROM ms WHERE NOT EXISTS (SELECT 1 FROM bare b WHERE b.record_id = ms.record_id AND ms.kind = 'tRNA' AND ms.gene IN (b.name || '1', b.name || '2')) AND NOT EXISTS (SELECT 1 FROM ct WHERE ct.record_id = ms.record_id AND ct.gene = 'rrna' AND ms.kind = 'rRNA')),
  sf AS (SELECT record_id, 'ERROR' AS level, 'MISSING_GENE' AS code, kind || ':' || gene AS detail FROM ms2 UNION ALL SELECT record_id, 'ERROR', 'UNEXPECTED_GENE', kind || ':' || gene FROM ct ANTI JOIN ex USING (kind, gene) WHERE gene <> 'rrna'
    UNION ALL SELECT record_id, 'ERROR', 'DUPLICATE_GENE', kind || ':' || gene FROM ct WHERE n > 1 UNION ALL SELECT record_id, 'REVIEW', 'UNDETERMINED_TRNA', name FROM bare UNION ALL SELECT record_id, 'REVIEW', 'UNDETERMINED_RRNA', gene FROM ct WHERE gene = 'rrna')"""


@query("annot_gene_set_findings", f"WITH {SET} SELECT * FROM sf")
def gene_set(t):
    return an.gene_set_findings(features(t)).drop("feature_id")


STRANDS = f"""st AS (SELECT record_id, CASE WHEN mi = 2 THEN 'INFO' ELSE 'REVIEW' END AS level, CASE WHEN mi = 2 THEN 'ORIENTATION' ELSE 'STRAND_COUNT' END AS code, pl || '/' || mi AS detail
  FROM (SELECT record_id, count_if(strand > 0) AS pl, COUNT(*) - count_if(strand > 0) AS mi FROM ({FEATURES}) WHERE type = 'CDS' GROUP BY record_id) WHERE pl <> 2)"""


@query("annot_strand_findings", f"WITH {STRANDS} SELECT * FROM st")
def strands(t):
    return an.strand_findings(features(t), 2).drop("feature_id")


@query(
    "annot_rna_length_findings",
    f"""WITH f AS (SELECT record_id, type, canon, ac, note, e1 - s1 + coalesce(e2 - s2, 0) AS len, CASE WHEN canon IN {nm.EXPECTED_TRNA} THEN canon WHEN canon = 'trnl' AND ac IS NOT NULL THEN 'trnl1' END AS identity FROM ({FEATURES}) WHERE type <> 'CDS')
    SELECT record_id, CASE WHEN note IS NULL THEN 'ERROR' ELSE 'REVIEW' END AS level, 'TRNA_TOO_SHORT' AS code, canon || ':' || len AS detail FROM f WHERE type = 'tRNA' AND len < 50 UNION ALL SELECT record_id, 'REVIEW', 'TRNA_LENGTH', canon || ':' || len FROM f WHERE type = 'tRNA' AND len >= 50 AND NOT len BETWEEN 60 AND 75
    UNION ALL SELECT record_id, 'REVIEW', 'TRNA_NO_ANTICODON', canon FROM f WHERE type = 'tRNA' AND ac IS NULL UNION ALL SELECT record_id, 'REVIEW', 'UNDETERMINED_TRNA', canon FROM f WHERE type = 'tRNA' AND identity IS NULL
    UNION ALL SELECT record_id, 'REVIEW', 'RRNA_LENGTH', canon || ':' || len FROM f WHERE (canon = 'rrnl' AND NOT len BETWEEN 1100 AND 1500) OR (canon = 'rrns' AND NOT len BETWEEN 600 AND 850) UNION ALL SELECT record_id, 'INFO', 'UNDETERMINED_RRNA', canon FROM f WHERE canon = 'rrna'""",
)
def rna_lengths(t):
    return an.rna_length_findings(features(t)).drop("feature_id")


SEGS = f"(SELECT record_id, feature_id, canon AS name, type, s1 AS s, e1 AS e FROM ({FEATURES}) UNION ALL SELECT record_id, feature_id, canon, type, s2, e2 FROM ({FEATURES}) WHERE s2 IS NOT NULL)"
PAIRS = f"""(SELECT a.record_id, a.feature_id AS feature_id_a, b.feature_id AS feature_id_b, a.name AS name_a, b.name AS name_b, a.type AS type_a, b.type AS type_b, sum(least(a.e, b.e) - greatest(a.s, b.s))::BIGINT AS overlap
  FROM {SEGS} a JOIN {SEGS} b ON a.record_id = b.record_id AND a.feature_id < b.feature_id AND least(a.e, b.e) > greatest(a.s, b.s) GROUP BY ALL)"""


@query("annot_overlapping_pairs", f"SELECT * FROM {PAIRS}")
def pairs(t):
    return an.overlapping_pairs(features(t))


# Tolerated name pairs: names met together in one nation's first letters stay data, drawn from the parts.
TOLERATED = f"SELECT DISTINCT a AS first, b AS second FROM (SELECT {pick(CANON)} AS a, {pick(CANON[7:] + CANON[:7])} AS b FROM (SELECT p_partkey AS l_partkey FROM {{part}}))"
TOL_SQL = f"(SELECT DISTINCT least(first, second) AS low, greatest(first, second) AS high FROM ({TOLERATED}))"


@query(
    "annot_overlap_findings",
    f"""SELECT record_id, feature_id_a::VARCHAR AS feature_id, CASE WHEN overlap <= 8 THEN 'INFO' ELSE 'REVIEW' END AS level, CASE WHEN overlap <= 8 THEN 'OVERLAP_SHORT' WHEN low IS NOT NULL THEN 'OVERLAP_ACCEPTED' ELSE 'OVERLAP_LONG' END AS code,
      feature_id_a || '|' || feature_id_b || '|' || overlap AS detail FROM {PAIRS} p LEFT JOIN {TOL_SQL} ON low = least(name_a, name_b) AND high = greatest(name_a, name_b)""",
)
def overlap_findings(t):
    return an.overlap_findings(an.overlapping_pairs(features(t)), t.sql(TOLERATED))


@query("annot_unused_tolerances", f"SELECT low, high FROM {TOL_SQL} ANTI JOIN (SELECT least(name_a, name_b) AS low, greatest(name_a, name_b) AS high FROM {PAIRS} WHERE overlap > 95) USING (low, high)")
def unused(t):
    return an.unused_tolerances(an.overlapping_pairs(features(t)), t.sql(TOLERATED), 95)


@query(
    "annot_reference_lengths",
    f"""WITH f AS (SELECT *, e1 - s1 + coalesce(e2 - s2, 0) AS len FROM ({FEATURES}) WHERE type = 'CDS'), r AS (SELECT canon, arg_min(len, (s1, feature_id)) AS rl FROM f WHERE strand < 0 AND len > 0 GROUP BY canon)
    SELECT record_id, feature_id, f.canon AS name, len AS length, rl AS ref_length, round(abs(len - rl)::DOUBLE / rl * 100, 9) AS delta_pct, abs(len - rl)::DOUBLE / rl * 100 > 20 AS outside FROM f LEFT JOIN r USING (canon)""",
)
def reference_lengths(t):
    f = features(t)
    out = an.reference_lengths(f, f.where("strand < 0"))
    return out.withColumn("delta_pct", F.round("delta_pct", 9))


@query(
    "annot_set_differences",
    f"""WITH q AS (SELECT DISTINCT record_id, canon AS name FROM ({FEATURES})), r AS (SELECT DISTINCT canon AS name FROM ({FEATURES}) WHERE strand < 0 AND type = 'tRNA') SELECT record_id, name, 'missing' AS side FROM (SELECT DISTINCT record_id FROM q) CROSS JOIN r ANTI JOIN q USING (record_id, name)
    UNION ALL SELECT record_id, name, 'extra' FROM q ANTI JOIN r USING (name)""",
)
def set_differences(t):
    f = features(t)
    return an.set_differences(f, f.where("strand < 0 AND type = 'tRNA'"))


@query(
    "annot_roll_up",
    f"""WITH {SET}, {STRANDS}, al AS (SELECT * FROM sf UNION ALL SELECT * FROM st) SELECT record_id, COUNT(CASE WHEN level = 'ERROR' THEN 1 END) AS error, COUNT(CASE WHEN level = 'REVIEW' THEN 1 END) AS review, COUNT(CASE WHEN level = 'INFO' THEN 1 END) AS info,
      CASE WHEN error > 0 THEN 1 WHEN review > 0 THEN 2 ELSE 0 END AS status FROM rc LEFT JOIN al USING (record_id) GROUP BY record_id""",
)
def roll_up(t):
    f = features(t)
    return an.roll_up(an.gene_set_findings(f).unionByName(an.strand_findings(f, 2)), f)


@query(
    "annot_barcode_gene",
    """SELECT doc_id, lang, (g = 'cox1') OR (contains(p, 'cytochrome') AND regexp_matches(p, '(?:subunit|oxidase)\\s+(?:i|1)\\b')) AS barcode FROM (SELECT doc_id, lang, CASE WHEN source = 'src1' THEN 'cox1' ELSE source END AS g, lower(replace(text, 'the ', 'Cytochrome oxidase I ')) AS p FROM documents)""",
)
def barcode(t):
    gene = F.when(F.col("source") == "src1", "COX1").otherwise(F.col("source"))
    return t.documents.select("doc_id", "lang", nm.is_barcode_gene(F.lit("CDS"), gene, F.replace("text", F.lit("the "), F.lit("Cytochrome oxidase I "))).alias("barcode"))


@query(
    "annot_codon_functions",
    """SELECT doc_id, CASE WHEN regexp_full_match(w, '[ACGTURYKMSWBDHVN]{3}') THEN w END AS codon, COUNT(*) AS n FROM (SELECT doc_id, upper(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS w FROM documents) GROUP BY ALL""",
)
def codons(t):
    words = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).alias("w"))
    return words.groupBy("doc_id", nm.codon(F.col("w")).alias("codon")).agg(F.count("*").alias("n"))


# Coding features cut from the texts' letters: two pieces of every text, joined; the whole of texts of up to 30 letters.
CDS_SQL = f"SELECT CAST(doc_id AS STRING) AS record_id, {DNA} AS sequence, doc_id FROM {{documents}}"


def coding(t):
    records = t.sql(CDS_SQL)
    n = F.length("sequence").cast("long")
    seg = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    half = F.floor(n / 2)
    strand = F.when(F.col("doc_id") % 2 == 0, 1).otherwise(-1)
    whole = F.array(seg(F.lit(0), n))
    forward = F.when(n > 30, F.array(seg(F.lit(3), half), seg(half + 5, n))).otherwise(whole)
    backward = F.when(n > 30, F.array(seg(half + 5, n), seg(F.lit(3), half))).otherwise(whole)
    site = F.concat(F.lit("(pos:"), F.lit(4).cast("string"), F.lit(".."), F.lit(6).cast("string"), F.lit(",aa:Trp)"))
    quals = F.create_map(F.lit("transl_except"), F.array(site), F.lit("codon_start"), F.array((F.col("doc_id") % 3 + 1).cast("string")))
    feats = records.select(
        "record_id", F.col("record_id").alias("feature_id"), F.lit("CDS").alias("type"), F.lit("cox1").alias("gene"), F.lit(None).cast("string").alias("product"), strand.alias("strand"),
        F.when(strand > 0, forward).otherwise(backward).alias("segments"), (F.col("doc_id") % 5 == 0).alias("partial5"), (F.col("doc_id") % 7 == 0).alias("partial3"), quals.alias("qualifiers"),
    )
    return an.coding_features(an.named(feats), records, 5)


SPLICED = f"""sp AS (SELECT record_id, doc_id, substr(CASE WHEN doc_id % 2 = 0 THEN a || b ELSE reverse(translate(b, 'ACGTRYN', 'TGCAYRN')) || reverse(translate(a, 'ACGTRYN', 'TGCAYRN')) END, (doc_id % 3 + 1)::INT) AS coding
  FROM (SELECT *, CASE WHEN length(sequence) > 30 THEN substr(sequence, 4, h - 3) ELSE sequence END AS a, CASE WHEN length(sequence) > 30 THEN substr(sequence, h + 6) ELSE '' END AS b
    FROM (SELECT *, (length(sequence) // 2)::INT AS h FROM ({CDS_SQL}))))"""


def protein_sql() -> str:
    from helixframe.queries.sequence import translate_sql

    return translate_sql(5).replace("length(seq)", "length(coding)").replace("substr(seq,", "substr(coding,")


TERMINAL = "CASE WHEN length(coding) % 3 = 0 AND right(coding, 3) IN ('TAA', 'TAG') THEN 'complete' WHEN (length(coding) % 3 = 1 AND right(coding, 1) = 'T') OR (length(coding) % 3 = 2 AND right(coding, 2) = 'TA') THEN 'incomplete' ELSE 'nonstop' END"


@query(
    "annot_coding_features",
    f"""WITH {SPLICED}, pr AS (SELECT *, {protein_sql()} AS protein, {TERMINAL} AS terminal FROM sp) SELECT record_id, md5(coding) AS coding, md5(protein) AS protein, length(coding) % 3 AS remainder, terminal,
      length(protein) - length(replace(protein, '*', '')) - CASE WHEN terminal = 'complete' THEN 1 ELSE 0 END AS internal_stops FROM pr""",
)
def coding_features(t):
    return coding(t).select("record_id", F.md5("coding").alias("coding"), F.md5("protein").alias("protein"), F.col("remainder").cast("long").alias("remainder"), "terminal", F.size("stops").cast("long").alias("internal_stops"))


@query("annot_cds_findings")
def cds_findings(t):
    """Findings per coding feature; no SQL equivalent is given for the exception grammar."""
    return an.cds_findings(coding(t), 5)


@query(
    "annot_cds_finding_counts",
    f"""WITH {SPLICED}, pr AS (SELECT *, {protein_sql()} AS protein, {TERMINAL} AS terminal FROM sp), q AS (SELECT *, length(protein) - length(replace(protein, '*', '')) - CASE WHEN terminal = 'complete' THEN 1 ELSE 0 END AS st FROM pr)
    SELECT 'ERROR' AS level, 'INTERNAL_STOP' AS code, COUNT(*) AS n FROM q WHERE st > 0 UNION ALL SELECT 'REVIEW', 'INCOMPLETE_STOP', COUNT(*) FROM q WHERE doc_id % 7 <> 0 AND terminal = 'incomplete'
    UNION ALL SELECT 'INFO', 'PARTIAL_CDS_5P', COUNT(*) FROM q WHERE doc_id % 5 = 0 UNION ALL SELECT 'INFO', 'PARTIAL_CDS_3P', COUNT(*) FROM q WHERE doc_id % 7 = 0 UNION ALL SELECT 'REVIEW', 'CODON_START_CONFLICT', COUNT(*) FROM q WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0
    UNION ALL SELECT 'ERROR', 'INVALID_CDS', COUNT(CASE WHEN doc_id % 7 <> 0 AND terminal = 'nonstop' THEN 1 END) + COUNT(CASE WHEN doc_id % 5 <> 0 AND left(coding, 3) NOT IN ('TTG', 'ATT', 'ATC', 'ATA', 'ATG', 'GTG') THEN 1 END) FROM q""",
)
def cds_finding_counts(t):
    wanted = ("INTERNAL_STOP", "INCOMPLETE_STOP", "PARTIAL_CDS_5P", "PARTIAL_CDS_3P", "CODON_START_CONFLICT", "INVALID_CDS")
    return an.cds_findings(coding(t), 5).where(F.col("code").isin(*wanted)).groupBy("level", "code").agg(F.count("*").alias("n"))


# Annotator rows: order lines of a part on a supplier.
GFF = """SELECT CAST(l_suppkey AS STRING) AS record_id, CASE l_linenumber WHEN 1 THEN 'nad1' WHEN 2 THEN 'cox1_0' WHEN 3 THEN 'OH_1' WHEN 4 THEN 'trnL1(tag)' WHEN 5 THEN 'rrnL' WHEN 6 THEN 'strange' ELSE 'atp8' END AS name,
  l_partkey AS start, l_partkey + CAST(l_quantity AS BIGINT) AS "end", CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand, CASE l_linenumber WHEN 4 THEN 'tRNA' WHEN 5 THEN 'rRNA' WHEN 6 THEN 'gene' ELSE CASE WHEN l_linestatus = 'O' THEN 'gene' ELSE 'CDS' END END AS type FROM {lineitem}"""


@query(
    "annot_annotator_features",
    f"""WITH g AS ({GFF}), k AS (SELECT *, bool_or(type = 'CDS') OVER (PARTITION BY record_id, name, start, "end", strand) AS hc FROM g), f AS (SELECT *, CASE WHEN type IN ('gene', 'CDS') AND regexp_full_match(lower(name), '(nad\\d+l?|cox[123]|cob|cytb|atp[68])(_\\d+)?') THEN 'CDS' WHEN type IN ('tRNA', 'rRNA') THEN type END AS kind FROM k WHERE NOT (type = 'gene' AND hc)),
    d AS (SELECT *, COUNT(*) OVER (PARTITION BY record_id, name, start, "end", strand, kind) AS n FROM f) SELECT record_id, name, start, "end", strand, type, kind, CASE WHEN kind IS NULL AND name NOT LIKE 'OH%' THEN 'unknown_type' WHEN kind IS NOT NULL AND n > 1 THEN 'duplicate_feature' END AS problem FROM d WHERE kind IS NOT NULL OR name NOT LIKE 'OH%'""",
)
def annotator_features(t):
    return an.annotator_features(t.sql(GFF.replace('"end"', "`end`")))


@query(
    "annot_annotator_qualifiers",
    f"""SELECT DISTINCT name, type, CASE name WHEN 'nad1' THEN 'NADH dehydrogenase subunit 1' WHEN 'cox1_0' THEN 'cytochrome c oxidase subunit 1' WHEN 'trnL1(tag)' THEN 'tRNA-L' WHEN 'rrnL' THEN '16S ribosomal RNA' WHEN 'atp8' THEN 'ATP synthase F0 subunit 8' END AS product,
      CASE WHEN name = 'trnL1(tag)' THEN 'MITOS2 anticodon sequence: TAG; position not exported' END AS note FROM ({GFF}) WHERE type <> 'gene' AND name <> 'OH_1'""",
)
def annotator_qualifiers(t):
    rows = t.sql(GFF.replace('"end"', "`end`")).where("type <> 'gene' AND name <> 'OH_1'")
    q = nm.annotator_qualifiers(F.col("type"), F.col("name"), 5)
    return rows.select("name", "type", F.try_element_at(q, F.lit("product")).alias("product"), F.try_element_at(q, F.lit("note")).alias("note")).distinct()


@query(
    "annot_protein_frames",
    f"""WITH d AS (SELECT CAST(doc_id AS STRING) AS record_id, doc_id, {DNA} AS seq FROM documents), p AS (SELECT record_id, doc_id, seq AS nt, (SELECT 1) AS one, substr(seq, (doc_id % 3 + 1)::INT) AS coding FROM d), w AS (SELECT *, regexp_replace({protein_sql()}, '\\*$', '') AS want FROM p),
    fr AS (SELECT record_id, want, o, substr(nt, (o + 1)::INT) AS coding FROM w, range(3) r(o) WHERE regexp_full_match(want, '[ACDEFGHIKLMNPQRSTVWY]+')), tr AS (SELECT *, regexp_replace({protein_sql()}, '\\*$', '') AS aa FROM fr),
    hit AS (SELECT record_id, COUNT(*) AS n, min(o) AS o FROM tr WHERE aa = want OR (left(coding, 3) IN ('TTG', 'ATT', 'ATC', 'ATA', 'ATG', 'GTG') AND aa <> '' AND 'M' || substr(aa, 2) = want) GROUP BY record_id)
    SELECT record_id, CASE WHEN n = 1 THEN o END AS "offset" FROM d LEFT JOIN hit USING (record_id)""",
)
def protein_frames(t):
    d = t.sql(CDS_SQL).withColumn("nt", F.col("sequence")).withColumn("name", F.lit("x"))
    d = d.withColumn("protein", sq.translate(F.expr("substr(nt, CAST(doc_id % 3 + 1 AS INT))"), 5))
    return an.protein_frames(d.select("record_id", "name", "nt", "protein"), 5).select("record_id", F.col("offset").cast("long").alias("offset"))


@query(
    "annot_frame_state",
    """SELECT l_orderkey, l_linenumber, phase, CASE WHEN phase = '3' THEN 'invalid_phase' WHEN phase <> '.' AND prot AND coalesce(o <> phase, true) THEN 'phase_protein_conflict' WHEN phase <> '.' THEN 'phase' WHEN o IS NOT NULL THEN 'protein' ELSE 'uncertain' END AS state, COUNT(*) AS n
    FROM (SELECT *, CASE WHEN l_tax > 0.05 THEN '.' ELSE (l_suppkey % 4)::VARCHAR END AS phase, CASE WHEN l_discount < 0.07 THEN (l_partkey % 3)::VARCHAR END AS o, l_returnflag = 'A' AS prot FROM lineitem) GROUP BY ALL""",
)
def frame_state(t):
    li = t.lineitem.withColumn("phase", F.when(F.col("l_tax") > 0.05, ".").otherwise((F.col("l_suppkey") % 4).cast("string")))
    offset = F.when(F.col("l_discount") < 0.07, F.col("l_partkey") % 3)
    out = li.select("l_orderkey", "l_linenumber", "phase", an.frame_conflict(F.col("phase"), offset, F.col("l_returnflag") == "A").alias("state"))
    return out.groupBy("l_orderkey", "l_linenumber", "phase", "state").agg(F.count("*").alias("n"))


# Annotator rows against files and genome: genome and files come from one text, the feature is the whole of it.
AGREE = f"SELECT CAST(doc_id AS STRING) AS record_id, {DNA} AS seq, lang, source, doc_id % 11 = 0 AS beyond FROM {{documents}}"


@query(
    "annot_source_agreement",
    f"""SELECT record_id, lang = 'es' AS from_genome_only, array_to_string(list_filter([CASE WHEN source = 'src11' THEN 'foreign_record' END, CASE WHEN source <> 'src11' AND (beyond OR seq = '') THEN 'outside_genome' END,
      CASE WHEN lang = 'fr' THEN 'place_conflict' END, CASE WHEN lang <> 'es' AND nuc = '' THEN 'empty_sequence' END, CASE WHEN source <> 'src11' AND lang <> 'es' AND nuc <> '' AND nuc <> seq THEN 'sequence_conflict' END,
      CASE WHEN source IN ('src5', 'src10') THEN 'protein_place_conflict' END], lambda x: x IS NOT NULL), ',') AS problems FROM (SELECT *, CASE WHEN lang = 'de' THEN substr(seq, 2) ELSE seq END AS nuc FROM ({AGREE}))""",
)
def source_agreement(t):
    base = t.sql(AGREE)
    end = (F.length("seq") + F.when(F.col("beyond"), 3).otherwise(0)).alias("end")
    gff = base.select("record_id", F.lit("g").alias("name"), F.lit(1).alias("start"), end, F.lit("+").alias("strand"))
    nuc = base.where("lang <> 'es'").select(
        "record_id", F.lit("g").alias("name"), F.when(F.col("lang") == "fr", 2).otherwise(1).alias("start"), end, F.lit("+").alias("strand"),
        F.when(F.col("lang") == "de", F.expr("substr(seq, 2)")).otherwise(F.col("seq")).alias("seq"),
    )
    prot = base.select("record_id", F.lit("g").alias("name"), F.lit(1).alias("start"), end, F.when(F.col("source").isin("src5", "src10"), "-").otherwise("+").alias("strand"))
    out = an.agreement(gff, nuc, prot, base.where("source <> 'src11'").select("record_id", "seq"))
    return out.select("record_id", "from_genome_only", F.array_join("problems", ",").alias("problems"))


@query(
    "annot_matching_records",
    """SELECT lang AS set_id, doc_id AS record_id, CASE WHEN source = 'src1' THEN 'not_annotated' WHEN source = 'src2' THEN 'unknown_record' WHEN source = 'src3' THEN 'sequence_differs' ELSE 'ok' END AS state FROM documents""",
)
def matching_records(t):
    d = t.documents.select(F.col("lang").alias("set_id"), F.col("doc_id").alias("record_id"), "source", F.col("text").alias("sequence"))
    changed = d.withColumn("sequence", F.when(F.col("source") == "src3", F.concat("sequence", F.lit("A"))).otherwise(F.col("sequence")))
    return an.matching_records(changed.where("source <> 'src1'"), d.where("source <> 'src2'"))


@query(
    "annot_candidate_eligibility",
    """SELECT l_orderkey AS case_id, l_linenumber, l_partkey, CASE WHEN NOT coalesce(ok, false) THEN 'no_successful_producer' WHEN l_tax > 0.075 THEN 'missing_file' WHEN l_discount > 0.085 THEN 'hash_mismatch' WHEN l_quantity > 25 THEN 'multiple_records' END AS skip_reason
    FROM lineitem LEFT JOIN (SELECT o_orderkey, o_orderstatus = 'F' AS ok FROM orders) ON o_orderkey = l_orderkey""",
)
def eligibility(t):
    c = t.lineitem.select(
        F.col("l_orderkey").alias("case_id"), "l_linenumber", "l_partkey", F.lit("p").alias("path"), F.lit("tool").alias("producer"), F.col("l_suppkey").cast("string").alias("sha256"),
        F.when(F.col("l_tax") > 0.075, None).when(F.col("l_discount") > 0.085, "x").otherwise(F.col("l_suppkey").cast("string")).alias("observed_sha256"), F.when(F.col("l_quantity") > 25, 2).otherwise(1).alias("records"),
    )
    runs = t.orders.select(F.col("o_orderkey").alias("case_id"), F.lit("tool").alias("tool"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("status"))
    return an.annotate_ok(c, runs).select("case_id", "l_linenumber", "l_partkey", "skip_reason")


# -- gene orders -----------------------------------------------------------------------------------

CYCLES = "SELECT o_custkey AS record, o_orderkey AS ord, o_orderpriority AS name, CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand FROM {orders}"
NEXT = f"""(SELECT record, name, strand, coalesce(lead(name) OVER w, first_value(name) OVER w) AS next_name, coalesce(lead(strand) OVER w, first_value(strand) OVER w) AS next_strand, COUNT(*) OVER (PARTITION BY record) AS n FROM ({CYCLES}) WINDOW w AS (PARTITION BY record ORDER BY ord, name, strand))"""


@query("circular_adjacent_pairs", f"SELECT record, name, strand, next_name, next_strand FROM {NEXT} WHERE n > 1")
def adjacent(t):
    return ci.adjacent_pairs(t.sql(CYCLES))


# Every customer against the next one.
COMPARE = "SELECT c_custkey AS comparison, c_custkey AS record_a, c_custkey + 1 AS record_b FROM {customer}"


def induced_sql(side: str) -> str:
    return f"SELECT comparison, ord, name, strand FROM ({COMPARE}) c JOIN ({CYCLES}) y ON y.record = c.{side}"


def pairs_sql(src: str) -> str:
    return f"""(SELECT DISTINCT comparison, name, strand, next_name, next_strand FROM (SELECT comparison, name, strand, coalesce(lead(name) OVER w, first_value(name) OVER w) AS next_name, coalesce(lead(strand) OVER w, first_value(strand) OVER w) AS next_strand,
      COUNT(*) OVER (PARTITION BY comparison) AS n FROM {src} SEMI JOIN sh USING (comparison, name) WINDOW w AS (PARTITION BY comparison ORDER BY ord, name, strand)) WHERE n > 1)"""


ORDERS_CTE = f"""a AS ({induced_sql('record_a')}), b AS ({induced_sql('record_b')}), na AS (SELECT DISTINCT comparison, name FROM a), nb AS (SELECT DISTINCT comparison, name FROM b), sh AS (SELECT * FROM na JOIN nb USING (comparison, name)),
  pa AS {pairs_sql('a')}, pb AS {pairs_sql('b')}, rb AS (SELECT comparison, next_name AS name, CASE next_strand WHEN '+' THEN '-' ELSE '+' END AS strand, name AS next_name, CASE strand WHEN '+' THEN '-' ELSE '+' END AS next_strand FROM pb),
  n AS (SELECT c.comparison, (SELECT COUNT(*) FROM na WHERE na.comparison = c.comparison) AS xa, (SELECT COUNT(*) FROM nb WHERE nb.comparison = c.comparison) AS xb, (SELECT COUNT(*) FROM sh WHERE sh.comparison = c.comparison) AS xs,
    (SELECT COUNT(*) FROM a WHERE a.comparison = c.comparison) AS la, (SELECT COUNT(*) FROM b WHERE b.comparison = c.comparison) AS lb, (SELECT COUNT(*) FROM pa WHERE pa.comparison = c.comparison) AS ya, (SELECT COUNT(*) FROM pb WHERE pb.comparison = c.comparison) AS yb FROM ({COMPARE}) c),
  f AS (SELECT comparison, COUNT(*) AS fw FROM pa SEMI JOIN pb USING (comparison, name, strand, next_name, next_strand) GROUP BY ALL), r AS (SELECT comparison, COUNT(*) AS rv FROM pa SEMI JOIN rb USING (comparison, name, strand, next_name, next_strand) GROUP BY ALL),
  v AS (SELECT n.*, coalesce(fw, 0) AS fw, ya = yb AND (coalesce(fw, 0) = ya OR coalesce(rv, 0) = ya) AS same FROM n LEFT JOIN f USING (comparison) LEFT JOIN r USING (comparison))"""


@query(
    "circular_compare_orders",
    f"WITH {ORDERS_CTE} SELECT comparison, xs AS shared_genes, xa - xs AS missing_genes, xb - xs AS extra_genes, xa = xs AND xb = xs AND la = lb AND same AS equivalent, CASE WHEN same THEN 0 ELSE ya + yb - 2 * fw END AS different_pairs FROM v",
)
def compare_orders(t):
    return ci.compare_orders(t.sql(CYCLES), t.sql(COMPARE))


@query(
    "circular_differing_pairs",
    f"""WITH {ORDERS_CTE}, d AS (SELECT *, 'a' AS side FROM pa ANTI JOIN pb USING (comparison, name, strand, next_name, next_strand) UNION ALL SELECT *, 'b' FROM pb ANTI JOIN pa USING (comparison, name, strand, next_name, next_strand)) SELECT d.* FROM d SEMI JOIN (SELECT comparison FROM v WHERE NOT same AND ya + yb - 2 * fw > 0) USING (comparison)""",
)
def differing(t):
    return ci.differing_pairs(t.sql(CYCLES), t.sql(COMPARE))
