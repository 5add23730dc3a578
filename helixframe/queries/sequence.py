"""Sequence records and reads: the letters of every text, mapped to nucleotide letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import seq as sq
from helixframe.operators import reads as rd, sequences as se
from helixframe.queries.registry import query

DNA = "regexp_replace(translate(lower(text), 'aetoinshrdlucmfwygpbvkjxqz', 'AAATTTTCCCCGGGGAACCTTGRRYN'), '[^ACGTRYN]', ''{G})"
RECORDS = f"SELECT source AS path, CASE WHEN n_chars < 400 THEN lang ELSE CAST(doc_id AS STRING) END AS id, {DNA} AS seq, doc_id FROM {{documents}}"
COUNTS = ", ".join(f"length(seq) - length(replace(seq, '{b}', '')) AS {b.lower()}" for b in "ACGT")


@query(
    "sequence_composition",
    f"""SELECT path, id, doc_id, length(seq) AS length, a, c, g, t, length(seq) - a - c - g - t AS ambiguous, round((g + c)::DOUBLE / nullif(a + c + g + t, 0) * 100, 9) AS gc_percent FROM (SELECT *, {COUNTS} FROM ({RECORDS}))""",
)
def composition(t):
    out = se.composition(t.sql(RECORDS).withColumn("id", F.struct("id", "doc_id")))
    return out.select("path", "id.id", "id.doc_id", "length", "a", "c", "g", "t", "ambiguous", F.round("gc_percent", 9).alias("gc_percent"))


@query(
    "sequence_totals",
    f"""SELECT path, COUNT(*) AS records, sum(length(seq))::BIGINT AS length, sum(a)::BIGINT AS a, sum(c)::BIGINT AS c, sum(g)::BIGINT AS g, sum(t)::BIGINT AS t, sum(length(seq) - a - c - g - t)::BIGINT AS ambiguous,
      round(sum(g + c)::DOUBLE / sum(a + c + g + t) * 100, 9) AS gc_percent, round(sum(a + t)::DOUBLE / sum(a + c + g + t) * 100, 9) AS at_percent FROM (SELECT *, {COUNTS} FROM ({RECORDS})) GROUP BY path""",
)
def totals(t):
    return se.totals(t.sql(RECORDS)).withColumn("gc_percent", F.round("gc_percent", 9)).withColumn("at_percent", F.round("at_percent", 9))


@query(
    "sequence_gc_windows",
    f"""SELECT path, id, w + 1 AS start, w + length(p) AS "end", round(gc, 9) AS gc_percent, gc < 33 AS low_gc, COUNT(*) AS n FROM (SELECT path, id, w, p, coalesce((length(p) - length(translate(p, 'GC', '')))::DOUBLE / nullif(length(p) - length(translate(p, 'ACGT', '')), 0) * 100, 0.0) AS gc
      FROM (SELECT path, id, w, substr(seq, w + 1, 500) AS p FROM (SELECT *, unnest(range(0, length(seq), 500)) AS w FROM ({RECORDS})))) GROUP BY ALL""",
)
def gc_windows(t):
    out = se.gc_windows(t.sql(RECORDS), low=33.0).withColumn("gc_percent", F.round("gc_percent", 9))
    return out.groupBy("path", "id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "gc_percent", "low_gc").agg(F.count("*").alias("n"))


@query(
    "sequence_symbol_runs",
    f"""WITH c AS (SELECT path, doc_id AS id, i FROM (SELECT path, doc_id, seq, unnest(range(1, length(seq) + 1)) AS i FROM ({RECORDS})) WHERE contains('RYN', substr(seq, i, 1))),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY id ORDER BY i) AS k FROM c) SELECT path, id, min(i) AS start, max(i) AS "end" FROM g GROUP BY path, id, k""",
)
def symbol_runs(t):
    return se.symbol_runs(t.sql(RECORDS).withColumn("id", F.col("doc_id")), "RYSWKMBDHVN").select("path", "id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query(
    "sequence_position_runs",
    """WITH p AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), g AS (SELECT *, l_partkey - row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS k FROM p),
    r AS (SELECT l_suppkey, min(l_partkey) AS start, max(l_partkey) + 1 AS "end" FROM g GROUP BY l_suppkey, k) SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY start) AS island FROM r""",
)
def position_runs(t):
    return se.position_runs(t.lineitem, ["l_suppkey"], "l_partkey", width=256)


@query(
    "sequence_intake_findings",
    f"""WITH i AS (SELECT path, id, COUNT(*) AS n, sum(length(translate(seq, 'ACGT', ''))) AS amb FROM ({RECORDS}) GROUP BY ALL), f AS (SELECT path, sum(n)::BIGINT AS records, count_if(n > 1) AS d, sum(amb) AS amb FROM i GROUP BY path)
    SELECT path, records, unnest(CASE WHEN records < 2 AND d = 0 AND amb = 0 THEN ['BASIC_INTAKE_CLEAR'] ELSE list_filter([CASE WHEN records > 1 THEN 'MULTIPLE_RECORDS' END, CASE WHEN d > 0 THEN 'DUPLICATE_IDS' END, CASE WHEN amb > 0 THEN 'AMBIGUOUS_BASES' END], lambda x: x IS NOT NULL) END) AS code,
      CASE code WHEN 'DUPLICATE_IDS' THEN 'BLOCK' WHEN 'BASIC_INTAKE_CLEAR' THEN 'INFO' ELSE 'REVIEW' END AS level FROM f""",
)
def intake(t):
    return se.intake_findings(t.sql(RECORDS))


@query("sequence_reverse_complement", f"SELECT doc_id, md5(reverse(translate(seq, 'ACGTRYN', 'TGCAYRN'))) AS digest FROM ({RECORDS})")
def revcomp(t):
    return t.sql(RECORDS).select("doc_id", F.md5(sq.reverse_complement(F.col("seq"))).alias("digest"))


def translate_sql(table: int) -> str:
    pairs = ", ".join(f"'{c}': '{a}'" for c, a in sq.codons(table).items())
    return f"array_to_string(list_transform(range(0, length(seq) // 3), lambda i: coalesce(MAP {{{{{pairs}}}}}[substr(seq, (i * 3 + 1)::INT, 3)], 'X')), '')".replace("{{", "{").replace("}}", "}")


@query(
    "sequence_translate",
    f"SELECT doc_id, md5({translate_sql(5)}) AS table5, md5({translate_sql(2)}) AS table2 FROM ({RECORDS})",
)
def translate(t):
    return t.sql(RECORDS).select("doc_id", F.md5(sq.translate(F.col("seq"), 5)).alias("table5"), F.md5(sq.translate(F.col("seq"), 2)).alias("table2"))


@query(
    "sequence_ambiguous_codons",
    f"""SELECT doc_id, i + 1 AS codon, i * 3 + 1 AS start, substr(seq, (i * 3 + 1)::INT, 3) AS "text" FROM (SELECT *, unnest(range(0, length(seq) // 3)) AS i FROM ({RECORDS})) WHERE NOT regexp_full_match(substr(seq, (i * 3 + 1)::INT, 3), '[ACGT]{{3}}')""".replace("{{3}}", "{3}"),
)
def ambiguous(t):
    out = t.sql(RECORDS).select("doc_id", F.explode(sq.ambiguous_codons(F.col("seq"))).alias("c"))
    return out.select("doc_id", F.col("c.codon").cast("long").alias("codon"), F.col("c.start").cast("long").alias("start"), "c.text")


# Scaffold pairs: a text cut in the middle with 30 shared letters, every other part turned around.
PAIRS = f"""SELECT doc_id AS case_id, CASE WHEN doc_id % 2 = 0 THEN l ELSE reverse(translate(l, 'ACGTRYN', 'TGCAYRN')) END AS seq1, CASE WHEN doc_id % 3 = 0 THEN reverse(translate(r, 'ACGTRYN', 'TGCAYRN')) ELSE r END AS seq2
FROM (SELECT doc_id, substr(seq, 1, CAST(CEIL(length(seq) / 2e0) AS INT) + 15) AS l, substr(seq, greatest(1, CAST(CEIL(length(seq) / 2e0) AS INT) - 14)) AS r FROM ({RECORDS}))"""
JOINS = f"""j0 AS (SELECT case_id, unnest([{{'v': 's1+s2', 'l': seq1, 'r': seq2}}, {{'v': 's1+rc(s2)', 'l': seq1, 'r': r2}}, {{'v': 'rc(s1)+s2', 'l': r1, 'r': seq2}}, {{'v': 'rc(s1)+rc(s2)', 'l': r1, 'r': r2}}]) AS w
    FROM (SELECT *, reverse(translate(seq1, 'ACGTRYN', 'TGCAYRN')) AS r1, reverse(translate(seq2, 'ACGTRYN', 'TGCAYRN')) AS r2 FROM ({PAIRS}))),
  j1 AS (SELECT case_id, variant, l, r, coalesce(list_max(list_filter(list_transform(range(1, length(r) - 18), lambda p: CASE WHEN substr(r, p, 20) = tl THEN p + 19 END), lambda k: k IS NOT NULL AND k <= length(l) AND right(l, k) = left(r, k))), 0) AS overlap FROM (SELECT case_id, w.v AS variant, w.l AS l, w.r AS r, right(w.l, 20) AS tl FROM j0)),
  j2 AS (SELECT case_id, variant, overlap, length(l) AS ll, l || substr(r, overlap + 1) AS joined,
    CASE WHEN least(length(l), length(r)) < 20 THEN 'insufficient' WHEN overlap > 0 THEN 'overlap' ELSE 'no_overlap' END AS status FROM j1)"""


@query(
    "sequence_oriented_joins",
    f"""WITH {JOINS} SELECT case_id, variant, overlap, md5(joined) AS joined, CASE WHEN ll - overlap - 9 >= 1 AND ll + 10 <= length(joined) THEN ll - overlap - 9 END AS anchor_low, CASE WHEN ll - overlap - 9 >= 1 AND ll + 10 <= length(joined) THEN ll + 10 END AS anchor_high, status FROM j2""",
)
def joins(t):
    out = se.oriented_joins(t.sql(PAIRS)).withColumn("joined", F.md5("joined"))
    return out.select("case_id", "variant", F.col("overlap").cast("long").alias("overlap"), "joined", F.col("anchor_low").cast("long").alias("anchor_low"), F.col("anchor_high").cast("long").alias("anchor_high"), "status")


# Three scaffolds a text, neighbours sharing 30 letters, the middle one turned around in every other text.
SCAFFOLDS = f"""SELECT doc_id AS case_id, k AS scaffold_id, CASE WHEN k = 2 AND doc_id % 2 = 0 THEN reverse(translate(p, 'ACGTRYN', 'TGCAYRN')) ELSE p END AS seq
FROM (SELECT doc_id, k, substr(seq, greatest(1, (k - 1) * CAST(CEIL(length(seq) / 3e0) AS INT) - 14), CAST(CEIL(length(seq) / 3e0) AS INT) + 30) AS p
  FROM ({RECORDS}) CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3))"""


@query(
    "sequence_end_overlaps",
    f"""WITH b AS (SELECT case_id, scaffold_id, '+' AS strand, seq FROM ({SCAFFOLDS}) UNION ALL SELECT case_id, scaffold_id, '-', reverse(translate(seq, 'ACGTRYN', 'TGCAYRN')) FROM ({SCAFFOLDS})),
    p AS (SELECT x.case_id, x.scaffold_id AS left_id, x.strand AS left_strand, y.scaffold_id AS right_id, y.strand AS right_strand, x.seq AS l, y.seq AS r FROM b x JOIN b y ON x.case_id = y.case_id AND x.scaffold_id < y.scaffold_id),
    o AS (SELECT * EXCLUDE (l, r), coalesce(list_max(list_filter(range(20, least(length(l), length(r)) + 1), lambda k: right(l, k) = left(r, k))), 0) AS overlap FROM p)
    SELECT * FROM o WHERE overlap > 0""",
)
def scaffold_ends(t):
    return se.end_overlaps(t.sql(SCAFFOLDS)).withColumn("overlap", F.col("overlap").cast("long"))


# Alignment blocks of a join: order lines, a case is an order.
BLOCKS = """SELECT l_orderkey AS case_id, CASE WHEN l_linenumber <= 2 THEN 's1+s2' WHEN l_linenumber <= 4 THEN 's1+rc(s2)' ELSE 'rc(s1)+s2' END AS variant,
  l_partkey AS start, l_partkey + CAST(l_quantity AS BIGINT) * 10 AS "end", CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand FROM {lineitem}"""
VARIANTS = "SELECT DISTINCT case_id, variant FROM (SELECT o_orderkey AS case_id, 's1+s2' AS variant FROM {orders} UNION ALL SELECT o_orderkey, 's1+rc(s2)' FROM {orders} UNION ALL SELECT o_orderkey, 'rc(s1)+s2' FROM {orders} UNION ALL SELECT o_orderkey, 'rc(s1)+rc(s2)' FROM {orders})"
SCORES = f"""WITH b AS ({BLOCKS}), r AS (SELECT *, max("end") OVER (PARTITION BY case_id, variant ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
  u AS (SELECT case_id, variant, sum(greatest("end", coalesce(reach, start)) - greatest(start, coalesce(reach, start)))::BIGINT AS un, COUNT(*) AS blocks, bool_and(strand = '+') AS fw FROM r GROUP BY ALL),
  sc AS (SELECT v.case_id, v.variant, coalesce(blocks, 0) AS blocks, coalesce(un, 0) * CASE WHEN coalesce(fw, false) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score FROM ({VARIANTS}) v LEFT JOIN u USING (case_id, variant))"""


def blocks(t):
    return t.sql(BLOCKS.replace('"end"', "`end`"))


@query("sequence_variant_scores", SCORES + " SELECT * FROM sc")
def scores(t):
    return se.score_variants(blocks(t), t.sql(VARIANTS))


@query(
    "sequence_best_variant",
    SCORES + """, tp AS (SELECT case_id, max(score) AS top FROM sc GROUP BY case_id), bt AS (SELECT case_id, min(variant) AS variant, COUNT(*) AS n FROM sc JOIN tp USING (case_id) WHERE score = top GROUP BY case_id)
    SELECT case_id, CASE WHEN top > 0 AND n = 1 THEN variant END AS variant, top AS score, CASE WHEN top = 0 THEN 'no_match' WHEN n > 1 THEN 'ambiguous' ELSE 'selected' END AS status FROM tp JOIN bt USING (case_id)""",
)
def best(t):
    return se.best_variant(se.score_variants(blocks(t), t.sql(VARIANTS)))


# A record is a language; every twentieth text is an annotated feature, the others are the segments.
SEGMENTS = f"SELECT lang AS record, doc_id AS segment_id, {DNA} AS seq FROM {{documents}} WHERE doc_id % 20 <> 0"
FEATURES = f"SELECT lang AS record, doc_id AS feature_id, {DNA} AS seq FROM {{documents}} WHERE doc_id % 20 = 0"
MATCHES = f"""s AS MATERIALIZED ({SEGMENTS}), f AS MATERIALIZED ({FEATURES}),
    fw AS (SELECT DISTINCT record, feature_id, substr(seq, p::INT, 60) AS w FROM (SELECT *, unnest(range(1, length(seq) - 58)) AS p FROM f)),
    sw AS (SELECT DISTINCT record, segment_id, substr(seq, p::INT, 60) AS w FROM (SELECT *, unnest(range(1, length(seq) - 58)) AS p FROM s)),
    pr AS (SELECT DISTINCT record, segment_id, feature_id FROM sw JOIN fw USING (record, w)),
    mt AS (SELECT record, segment_id, feature_id, list_reduce(list_concat([59], range(1, length(s.seq) + 1)::INT[]),
      lambda best, j: CASE WHEN j > best AND contains(f.seq, substr(s.seq, j - best, best + 1)) THEN best + 1 ELSE best END)::BIGINT AS matched_bp
      FROM pr JOIN s USING (record, segment_id) JOIN f USING (record, feature_id))"""


@query("sequence_annotation_matches", f"WITH {MATCHES} SELECT * FROM mt")
def annotation_matches(t):
    return se.annotation_matches(t.sql(SEGMENTS), t.sql(FEATURES), 60)


@query(
    "sequence_segment_match_status",
    f"""WITH {MATCHES}, g AS (SELECT segment_id, COUNT(*) AS features, max(matched_bp) AS matched_bp FROM mt GROUP BY ALL)
    SELECT s.record, segment_id, length(seq)::INT AS length, coalesce(features, 0) AS features, matched_bp,
      CASE WHEN coalesce(length(seq), 0) < 60 THEN 'insufficient' WHEN features > 0 THEN 'matched' ELSE 'unmatched' END AS status FROM s LEFT JOIN g USING (segment_id)""",
)
def segment_match_status(t):
    return se.segment_match_status(t.sql(SEGMENTS), se.annotation_matches(t.sql(SEGMENTS), t.sql(FEATURES), 60), 60)


MARKED = f"SELECT lang AS marker, CASE WHEN doc_id % 2 = 0 THEN seq ELSE reverse(translate(seq, 'ACGTRYN', 'TGCAYRN')) END AS seq, d.doc_id AS source_id FROM ({RECORDS}) r JOIN {{documents}} d USING (doc_id)".replace("d.doc_id AS", "doc_id AS")


@query(
    "sequence_unique_by_strand",
    f"""WITH k AS (SELECT *, least(seq, reverse(translate(seq, 'ACGTRYN', 'TGCAYRN'))) AS c FROM ({MARKED})) SELECT marker, min(source_id) AS source_id, COUNT(*) AS sources, md5(arg_min(seq, source_id)) AS digest FROM k GROUP BY marker, c""",
)
def unique_by_strand(t):
    return se.unique_sequences(t.sql(MARKED)).select("marker", "source_id", "sources", F.md5("seq").alias("digest"))


@query(
    "sequence_strand_provenance",
    f"""WITH k AS (SELECT *, least(seq, reverse(translate(seq, 'ACGTRYN', 'TGCAYRN'))) AS c FROM ({MARKED})) SELECT marker, sha256(c) AS "key", source_id FROM k""",
)
def provenance(t):
    return se.strand_groups(t.sql(MARKED))


FILES = "SELECT source AS tool, lang AS run, md5(text) AS sha256, doc_id AS ord, 'f' || CAST(doc_id AS STRING) AS path FROM {documents}"


@query("sequence_first_by_content", f"SELECT tool, sha256, min(ord) AS ord, COUNT(*) AS copies FROM ({FILES}) GROUP BY ALL")
def first_by_content(t):
    return se.first_by_content(t.sql(FILES), ["tool"]).select("tool", "sha256", "ord", "copies")


@query("sequence_copied_files", f"SELECT run, sha256, COUNT(DISTINCT path) AS names, min(path) AS first_path FROM ({FILES}) GROUP BY ALL HAVING COUNT(DISTINCT path) > 1")
def copied(t):
    return se.copied_files(t.sql(FILES))


@query("sequence_distinct_producers", "SELECT l_orderkey AS case_id, COUNT(DISTINCT l_returnflag) AS producers, COUNT(DISTINCT l_returnflag) >= 2 AS comparison_complete FROM lineitem GROUP BY ALL")
def producers(t):
    return se.distinct_producers(t.lineitem.select(F.col("l_orderkey").alias("case_id"), F.col("l_returnflag").alias("producer")))


# -- reads -----------------------------------------------------------------------------------------

MATE1 = """SELECT role AS lane, conv_id * 100 + turn AS ord, 'r' || CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING) || '/1' AS id, text AS seq, md5(text) AS qual FROM {conversations}"""
MATE2 = """SELECT role AS lane, conv_id * 100 + turn AS ord, 'r' || CAST(conv_id AS STRING) || '_' || CAST(CASE WHEN turn = 3 THEN 4 ELSE turn END AS STRING) || '/2' AS id, text AS seq, md5(text) AS qual FROM {conversations} WHERE role <> 'system' OR length(text) > 100"""
PAIRED = f"""(SELECT coalesce(a.lane, b.lane) AS lane, coalesce(a.ord, b.ord) AS ord, a.id AS id1, b.id AS id2, CASE WHEN a.id IS NULL OR b.id IS NULL THEN 'missing_mate' WHEN regexp_replace(a.id, '/[12]$', '') <> regexp_replace(b.id, '/[12]$', '') THEN 'id_mismatch' END AS problem
  FROM ({MATE1}) a FULL OUTER JOIN ({MATE2}) b ON a.lane = b.lane AND a.ord = b.ord)"""


@query("reads_pair_mates", f"SELECT * FROM {PAIRED}")
def pair_mates(t):
    return rd.pair_mates(t.sql(MATE1), t.sql(MATE2)).select("lane", "ord", "id1", "id2", "problem")


@query("reads_lane_status", f"SELECT lane, COUNT(*) AS pairs, COUNT(problem) AS problems, min(CASE WHEN problem IS NOT NULL THEN ord END) AS first_bad, CASE WHEN COUNT(problem) > 0 THEN 'refused' ELSE 'ok' END AS status FROM {PAIRED} GROUP BY lane")
def lane_status(t):
    return rd.lane_status(rd.pair_mates(t.sql(MATE1), t.sql(MATE2)))


BUDGET = 300
ALLOCATION = f"""al AS (SELECT lane, pairs, base + greatest(0, least(pairs - base, extra - coalesce(sum(pairs - base) OVER (ORDER BY lane ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS amount
  FROM (SELECT *, least({BUDGET}, sum(pairs) OVER ()) - sum(base) OVER () AS extra FROM (SELECT lane, pairs, least(pairs, {BUDGET} // COUNT(*) OVER ()) AS base FROM (SELECT role AS lane, COUNT(*) AS pairs FROM conversations GROUP BY role))))"""


@query("reads_lane_allocation", f"WITH {ALLOCATION} SELECT lane, pairs, amount::BIGINT AS amount FROM al")
def allocation(t):
    return rd.lane_allocation(t.conversations.groupBy(F.col("role").alias("lane")).agg(F.count("*").alias("pairs")), BUDGET)


@query(
    "reads_sample_pairs",
    f"""WITH {ALLOCATION}, h AS (SELECT role AS lane, conv_id || '_' || turn AS id, row_number() OVER (PARTITION BY role ORDER BY md5('19#' || conv_id || '_' || turn), conv_id || '_' || turn) AS position FROM conversations)
    SELECT h.lane, id, position FROM h JOIN al USING (lane) WHERE position <= amount""",
)
def sample(t):
    records = t.conversations.select(F.col("role").alias("lane"), F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"))
    return rd.sample_pairs(records, BUDGET, "19")


@query(
    "reads_keep_templates",
    f"""WITH {ALLOCATION}, h AS (SELECT role AS lane, conv_id AS template, row_number() OVER (PARTITION BY role ORDER BY md5('7#' || conv_id || '_' || turn), conv_id || '_' || turn) AS position FROM conversations),
    s AS (SELECT DISTINCT h.lane, template FROM h JOIN al USING (lane) WHERE position <= amount) SELECT role AS lane, conv_id AS template, turn, 'L' || length(role) || '_P' || sha256('x' || conv_id) || '/' || (turn % 2 + 1) AS name FROM conversations SEMI JOIN s ON s.lane = role AND s.template = conv_id""",
)
def keep(t):
    c = t.conversations.select(F.col("role").alias("lane"), F.col("conv_id").alias("template"), "turn", F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"))
    kept = rd.keep_templates(c, rd.sample_pairs(c, BUDGET, "7"))
    name = rd.template_name(F.length("lane"), F.concat(F.lit("x"), F.col("template").cast("string"), F.lit("/1")), F.col("turn") % 2 + 1)
    return kept.select("lane", "template", "turn", name.alias("name"))


# Samples are conversations by number, lanes their roles; one sample has an empty lane, one a budget below its lanes.
SAMPLED = "SELECT conv_id % 6 AS sample, role AS lane, CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING) AS id FROM {conversations}"
LANES = f"""SELECT sample, lane, CASE lane WHEN 'user' THEN 1 ELSE 2 END AS lane_ord, COUNT(*) AS pairs FROM ({SAMPLED}) GROUP BY sample, lane
UNION ALL SELECT 5 AS sample, 'none' AS lane, 3 AS lane_ord, 0 AS pairs"""
SAMPLE_REQUESTS = "SELECT DISTINCT conv_id % 6 AS sample, CASE conv_id % 6 WHEN 4 THEN 1 WHEN 3 THEN 1000000 ELSE 101 + conv_id % 6 END AS budget FROM {conversations}"
PLAN = f"""pl AS (SELECT sample, lane, pairs, status, CASE WHEN status = 'ok' THEN base + greatest(0, least(pairs - base, least(budget, total) - bases - before)) ELSE 0 END::BIGINT AS amount FROM (
    SELECT *, sum(pairs) OVER w AS total, sum(base) OVER w AS bases, coalesce(sum(pairs - base) OVER (PARTITION BY sample ORDER BY lane_ord, lane ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
      SELECT *, least(pairs, budget // COUNT(*) OVER s) AS base, CASE WHEN budget < COUNT(*) OVER s THEN 'budget_below_lanes' WHEN min(pairs) OVER s < 1 THEN 'empty_lane' ELSE 'ok' END AS status
      FROM ({LANES}) JOIN ({SAMPLE_REQUESTS}) USING (sample) WINDOW s AS (PARTITION BY sample)) WINDOW w AS (PARTITION BY sample)))"""


def sampling_plan(t):
    return rd.sample_plan(t.sql(LANES), t.sql(SAMPLE_REQUESTS))


@query("reads_sample_plan", f"WITH {PLAN} SELECT sample, lane, pairs, amount, status FROM pl")
def sample_plan(t):
    return sampling_plan(t)


@query(
    "reads_sample_lanes",
    f"""WITH {PLAN}, h AS (SELECT *, row_number() OVER (PARTITION BY sample, lane ORDER BY md5('3#' || id), id) AS p FROM ({SAMPLED})) SELECT h.sample, h.lane, id FROM h JOIN pl USING (sample, lane) WHERE p <= amount""",
)
def sample_lanes(t):
    return rd.sample_lanes(t.sql(SAMPLED), sampling_plan(t), "3").select("sample", "lane", "id")


QC = f"SELECT source AS lane, {DNA} AS seq, translate(text, ' aeiounst', '!5?IIII04') AS qual FROM {{documents}}"


@query(
    "reads_quality_summary",
    f"""SELECT lane, COUNT(*) AS reads, sum(length(seq))::BIGINT AS bases, sum(length(regexp_replace(qual, '[!-4]', '', 'g')))::BIGINT AS q20_bases, sum(length(regexp_replace(qual, '[!->]', '', 'g')))::BIGINT AS q30_bases, sum(length(seq) - length(translate(seq, 'GC', '')))::BIGINT AS gc_bases,
      round(sum(length(regexp_replace(qual, '[!-4]', '', 'g')))::DOUBLE / sum(length(seq)), 9) AS q20_rate, round(sum(length(regexp_replace(qual, '[!->]', '', 'g')))::DOUBLE / sum(length(seq)), 9) AS q30_rate,
      round(sum(length(seq) - length(translate(seq, 'GC', '')))::DOUBLE / sum(length(seq)), 9) AS gc_rate FROM ({QC}) GROUP BY lane""",
)
def quality(t):
    out = rd.quality_summary(t.sql(QC), ["lane"])
    for c in ("q20_rate", "q30_rate", "gc_rate"):
        out = out.withColumn(c, F.round(c, 9))
    return out


@query(
    "reads_count_status",
    """SELECT lane, pairs, reads, CASE WHEN reads IS NULL THEN 'failed_no_report' WHEN reads <> pairs THEN 'failed_read_count_mismatch' ELSE 'ok' END AS status FROM (SELECT l_suppkey AS lane, COUNT(*) AS pairs FROM lineitem GROUP BY ALL) LEFT JOIN
    (SELECT l_suppkey AS lane, COUNT(*) AS reads FROM lineitem WHERE l_suppkey < 90 AND (l_suppkey > 50 OR l_returnflag <> 'A') GROUP BY ALL) USING (lane)""",
)
def count_status(t):
    expected = t.lineitem.groupBy(F.col("l_suppkey").alias("lane")).agg(F.count("*").alias("pairs"))
    seen = t.lineitem.where("l_suppkey < 90 AND (l_suppkey > 50 OR l_returnflag <> 'A')").groupBy(F.col("l_suppkey").alias("lane")).agg(F.count("*").alias("reads"))
    return rd.read_count_status(seen, expected, ["lane"])


# Alignment rows: every text of a source, letters mapped so that most columns agree.
ROWS = "SELECT source AS alignment, 'L0_P' || CAST(CAST(FLOOR(doc_id / 2) AS BIGINT) AS STRING) AS template, doc_id, regexp_replace(translate(lower(text), 'bcdfghijklmnopqrstuvwxyzae', 'AAAAAAAAAAAAAAAAACGTAAGCAA'), '[^ACGT]', '~'{G}) AS seq FROM {documents}"
COLUMNS = f"""lt AS (SELECT alignment, template, generate_subscripts(string_split(seq, ''), 1) - 1 AS site, unnest(string_split(seq, '')) AS base FROM ({ROWS})),
  ca AS (SELECT alignment, site, template, min(base) AS base FROM lt WHERE base IN ('A', 'C', 'G', 'T') GROUP BY ALL HAVING min(base) = max(base)),
  ct AS (SELECT alignment, site, base, COUNT(*) AS n FROM ca GROUP BY ALL), rk AS (SELECT *, row_number() OVER (PARTITION BY alignment, site ORDER BY n DESC, base) AS p, sum(n) OVER (PARTITION BY alignment, site) AS depth FROM ct),
  cs AS (SELECT alignment, site, any_value(depth)::BIGINT AS depth, CASE WHEN any_value(depth) >= 5 AND max(CASE WHEN p = 1 THEN n END) / any_value(depth)::DOUBLE >= 0.8 THEN max(CASE WHEN p = 1 THEN base END) ELSE 'N' END AS call,
    coalesce(max(CASE WHEN p = 2 THEN n END) >= 3 AND max(CASE WHEN p = 2 THEN n END) / any_value(depth)::DOUBLE >= 0.2, false) AS mixed FROM rk GROUP BY alignment, site)"""


@query("reads_consensus_columns", f"WITH {COLUMNS} SELECT * FROM cs")
def consensus_columns(t):
    return rd.consensus_columns(t.sql(ROWS), fraction=0.8)


# The same text with the disagreeing letters left out, so that alignments without mixed columns exist.
QUIET = ROWS.replace("'AAAAAAAAAAAAAAAAACGTAAGCAA'", "'AAAAAAAAAAAAAAAAAAAAAAAAAA'")


@query(
    "reads_consensus_segments",
    f"""WITH {COLUMNS.replace(ROWS, QUIET)}, mx AS (SELECT alignment, count_if(mixed) AS m FROM cs GROUP BY alignment),
    g AS (SELECT alignment, site, call, site - row_number() OVER (PARTITION BY alignment ORDER BY site) AS k FROM cs WHERE call <> 'N' AND alignment IN (SELECT alignment FROM mx WHERE m = 0)),
    s AS (SELECT alignment, min(site) AS a, string_agg(call, '' ORDER BY site) AS seq FROM g GROUP BY alignment, k HAVING COUNT(*) >= 60)
    SELECT alignment, row_number() OVER (PARTITION BY alignment ORDER BY a) - 1 AS segment, seq FROM s""",
)
def consensus_segments(t):
    return rd.consensus_segments(t.sql(QUIET), min_length=60, fraction=0.8).withColumn("segment", F.col("segment").cast("long"))


@query(
    "reads_record_segments",
    f"""SELECT id, unnest(range(0, len(x))) AS segment, unnest(x) AS seq FROM (SELECT doc_id AS id, regexp_extract_all(seq, '[ACGT]{{40,}}') AS x FROM ({RECORDS}))""".replace("{{40,}}", "{40,}"),
)
def record_segments(t):
    return rd.single_record_segments(t.sql(RECORDS).withColumn("id", F.col("doc_id")), 40).withColumn("segment", F.col("segment").cast("long"))


@query(
    "reads_alignment_findings",
    """SELECT lang AS alignment, concat_ws(',', CASE WHEN min(length(text)) <> max(length(text)) THEN 'unequal_lengths' END, CASE WHEN count_if(source = 'src3') > 0 THEN 'unbound_rows' END) AS findings FROM documents GROUP BY lang""",
)
def alignment_findings(t):
    rows = t.documents.select(F.col("lang").alias("alignment"), F.when(F.col("source") == "src3", "x").otherwise(F.concat(F.lit("L1_P"), F.col("doc_id").cast("string"))).alias("name"), F.col("text").alias("seq"))
    return rd.alignment_findings(rows).withColumn("findings", F.array_join("findings", ","))
