"""Intervals over events, alignment segments over order lines, taxonomy over suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import hsp as hs, intervals as iv, taxon as tn
from helixframe.queries.registry import query

SPANS = """SELECT user_id, CAST(FLOOR(EPOCH_S) AS BIGINT) AS start, CAST(FLOOR(EPOCH_S) AS BIGINT) + CAST(FLOOR(value * 60) AS BIGINT) AS "end" FROM (SELECT user_id, value, EPOCH_OF AS EPOCH_S FROM {events})"""
SPANS_SQL = SPANS.replace("EPOCH_OF", "epoch(ts)")


def spans(t):
    start = F.col("ts").cast("timestamp").cast("double")
    return t.events.select("user_id", F.floor(start).alias("start"), (F.floor(start) + F.floor(F.col("value") * 60)).alias("end"))


ISLANDS = f"""(WITH s AS (SELECT * FROM ({SPANS_SQL}) WHERE "end" > start), r AS (SELECT *, max("end") OVER (PARTITION BY user_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
  g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM r)
  SELECT user_id, island::BIGINT AS island, min(start) AS start, max("end") AS "end" FROM g GROUP BY ALL)"""


@query("interval_islands", f"SELECT * FROM {ISLANDS}")
def islands(t):
    return iv.islands(spans(t), ["user_id"], width=86_400)


@query(
    "interval_union_length",
    f"""SELECT user_id, intervals, spanned, coalesce(u, 0) AS union_length, spanned - coalesce(u, 0) AS redundant FROM (SELECT user_id, COUNT(*) AS intervals, sum("end" - start)::BIGINT AS spanned FROM ({SPANS_SQL}) GROUP BY ALL)
    LEFT JOIN (SELECT user_id, sum("end" - start)::BIGINT AS u FROM {ISLANDS} GROUP BY user_id) USING (user_id)""",
)
def union_length(t):
    return iv.union_length(spans(t), ["user_id"], width=86_400)


@query(
    "interval_union_closed",
    f"""SELECT user_id, sum("end" - start)::BIGINT AS union_length FROM (WITH c AS (SELECT user_id, start, "end" + 1 AS "end" FROM ({SPANS_SQL})),
      r AS (SELECT *, max("end") OVER (PARTITION BY user_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c)
      SELECT user_id, greatest(start, coalesce(reach, start)) AS start, greatest("end", coalesce(reach, start)) AS "end" FROM r) GROUP BY user_id""",
)
def union_closed(t):
    # End and start swapped: closed intervals may come in either order.
    swapped = spans(t).select("user_id", F.col("end").alias("start"), F.col("start").alias("end"))
    return iv.union_length(iv.from_closed(swapped), ["user_id"], width=86_400).select("user_id", "union_length")


# -- alignment segments ----------------------------------------------------------------------------

HSPS = """
SELECT l_orderkey AS query, l_returnflag AS hit, CASE l_returnflag WHEN 'R' THEN 'A' ELSE l_returnflag END || CAST(CASE WHEN l_orderkey > 0 THEN 1 ELSE 0 END AS STRING) AS accession,
  CAST((l_linenumber - 1) * 50 + 1 AS BIGINT) AS query_from, CAST((l_linenumber - 1) * 50 + l_quantity + CASE WHEN l_discount > 0.09 THEN 20 ELSE 0 END AS BIGINT) AS query_to,
  CAST(CASE WHEN (l_returnflag = 'A') <> (l_tax > 0.075) THEN (8 - l_linenumber) * 60 + l_quantity ELSE (l_linenumber - 1) * 60 + 1 + CASE WHEN l_extendedprice > 60000 THEN 150 ELSE 0 END END AS BIGINT) AS hit_from,
  CAST(CASE WHEN (l_returnflag = 'A') <> (l_tax > 0.075) THEN (8 - l_linenumber) * 60 + 1 ELSE (l_linenumber - 1) * 60 + l_quantity + CASE WHEN l_extendedprice > 60000 THEN 150 ELSE 0 END END AS BIGINT) AS hit_to,
  CAST(l_quantity + 20 AS BIGINT) AS align_len, CAST(CASE WHEN l_quantity < 2 THEN 0 ELSE l_quantity + 20 - ROUND(l_tax * 100) END AS BIGINT) AS identity, CAST(l_quantity * 2 + ROUND(l_discount * 100) AS DOUBLE) AS bitscore,
  CAST(370 AS BIGINT) AS query_len, CAST(620 AS BIGINT) AS hit_len, CASE WHEN l_linestatus = 'O' THEN 'Plus' ELSE 'minus' END AS hit_strand
FROM {lineitem}"""


@query(
    "hsp_validity",
    f"""SELECT query, hit, query_from, query_to, reasons, COUNT(*) AS n FROM (SELECT *, concat_ws(',', CASE WHEN align_len - 45 <= 0 THEN 'empty_alignment' END, CASE WHEN identity < 0 OR identity > align_len - 45 THEN 'identity_out_of_range' END,
      CASE WHEN abs(query_to - query_from) + 1 > align_len - 45 THEN 'span_exceeds_alignment' END, CASE WHEN greatest(query_from, query_to) > 340 THEN 'outside_query' END, CASE WHEN greatest(hit_from, hit_to) > 450 THEN 'outside_hit' END,
      CASE WHEN (hit_strand = 'Plus') <> (hit_to >= hit_from) THEN 'strand_contradiction' END) AS reasons FROM ({HSPS})) WHERE reasons <> '' GROUP BY ALL""",
)
def validity(t):
    broken = t.sql(HSPS).withColumn("align_len", F.col("align_len") - 45).withColumn("query_len", F.lit(340)).withColumn("hit_len", F.lit(450))
    out = hs.findings(broken, strand_text=True).withColumn("reasons", F.array_join("reasons", ","))
    return out.groupBy("query", "hit", "query_from", "query_to", "reasons").agg(F.count("*").alias("n"))


def cover(side: str) -> str:
    return f"""(WITH c AS (SELECT query, hit, least({side}_from, {side}_to) AS s, greatest({side}_from, {side}_to) + 1 AS e FROM hsp),
      r AS (SELECT *, max(e) OVER (PARTITION BY query, hit ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c)
      SELECT query, hit, sum(greatest(e, coalesce(reach, s)) - greatest(s, coalesce(reach, s)))::BIGINT AS u, sum(e - s)::BIGINT AS sp FROM r GROUP BY ALL)"""


HITS = f"""WITH hsp AS ({HSPS}), mono AS (SELECT query, hit, bool_and(ok) AS monotonic FROM (SELECT query, hit, coalesce(h >= lag(h) OVER (PARTITION BY query, hit ORDER BY query_from, h), true) AS ok
    FROM (SELECT query, hit, query_from, CASE WHEN hit_to >= hit_from THEN hit_from ELSE -hit_from END AS h FROM hsp)) GROUP BY ALL),
  base AS (SELECT query, hit, min(accession) AS accession, COUNT(*) AS n, sum(identity) AS i, sum(align_len) AS a, min(identity::DOUBLE / align_len * 100) AS lo_pct, max(identity::DOUBLE / align_len * 100) AS hi_pct, max(bitscore) AS bitscore, sum(bitscore) AS rank_bits,
    COUNT(DISTINCT hit_to >= hit_from) AS sig, bool_and(hit_to >= hit_from) AS plus, min(least(hit_from, hit_to)) AS lo, max(greatest(hit_from, hit_to)) AS hi, bool_or(identity = 0) AS zero FROM hsp GROUP BY ALL),
  j AS (SELECT base.*, q.u AS aligned, q.sp AS spanned, q.sp - q.u AS redundant, s.sp - s.u AS reuse, monotonic FROM base JOIN {cover('query')} q USING (query, hit) JOIN {cover('hit')} s USING (query, hit) JOIN mono USING (query, hit)),
  k AS (SELECT *, CASE WHEN n < 2 THEN 1.0 WHEN sig = 1 THEN (hi - lo + 1)::DOUBLE / spanned ELSE 0.0 END AS ratio, n < 2 OR (sig = 1 AND monotonic) AS mono2 FROM j),
  l AS (SELECT *, n < 2 OR (mono2 AND ratio <= 3.0) AS collinear FROM k),
  m AS (SELECT *, concat_ws(',', CASE WHEN zero THEN 'zero_identity' END, CASE WHEN redundant > 0 THEN 'overlapping_hsps' END, CASE WHEN reuse > 0 THEN 'subject_overlap' END, CASE WHEN NOT collinear THEN 'non_collinear_hsps' END) AS blockers FROM l),
  hits AS (SELECT *, CASE WHEN blockers = '' THEN i::DOUBLE / a * 100 END AS identity, aligned::DOUBLE / 370 AS coverage FROM m)"""


def hits(t):
    return hs.hit_summaries(t.sql(HSPS))


@query(
    "hsp_hit_summaries",
    HITS + """ SELECT query, hit, accession, n AS hsp_count, aligned AS aligned_bases, spanned AS spanned_bases, redundant AS redundant_bases, reuse AS subject_overlap_bases, round(identity, 9) AS identity, round(lo_pct, 9) AS identity_low,
    round(hi_pct, 9) AS identity_high, bitscore, rank_bits AS ranking_bitscore, CASE WHEN sig <> 1 THEN 'mixed' WHEN plus THEN '+' ELSE '-' END AS subject_strand, mono2 AS monotonic, round(ratio, 9) AS span_ratio, collinear,
    sig = 1 AND NOT mono2 AND lo <= 200 AND hi >= 420 AS cross_origin_candidate, blockers, round(coverage, 9) AS coverage FROM hits""",
)
def summaries(t):
    out = hits(t).drop("query_len", "hit_len").withColumn("blockers", F.array_join("blockers", ","))
    for c in ("identity", "identity_low", "identity_high", "span_ratio", "coverage"):
        out = out.withColumn(c, F.round(c, 9))
    return out


@query(
    "hsp_best_per_accession",
    HITS + """ SELECT query, accession, hit, round(identity, 9) AS identity, bitscore FROM hits QUALIFY row_number() OVER (PARTITION BY query, accession ORDER BY coalesce(identity, 0) DESC, bitscore DESC, hit) = 1""",
)
def best_per_accession(t):
    return hs.best_per_accession(hits(t)).select("query", "accession", "hit", F.round("identity", 9).alias("identity"), "bitscore")


@query("hsp_hit_order", HITS + " SELECT query, hit, row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, coalesce(identity, 0) DESC, hit) AS position FROM hits")
def hit_order(t):
    return hs.hit_order(hits(t).select("query", "hit", "bitscore", "identity")).select("query", "hit", "position")


@query(
    "hsp_supported_hit",
    HITS + """, s AS (SELECT * FROM hits WHERE coalesce(identity, 0) >= 85 AND coverage >= 0.05), tp AS (SELECT query, max(identity) AS top FROM s GROUP BY query),
    nx AS (SELECT query, count_if(identity = top) AS n, max(CASE WHEN identity < top THEN identity END) AS nxt FROM s JOIN tp USING (query) GROUP BY query)
    SELECT query, hit, round(identity, 9) AS identity, round(coverage, 9) AS coverage FROM s JOIN tp USING (query) JOIN nx USING (query) WHERE identity = top AND nx.n = 1 AND (nxt IS NULL OR top - nxt >= 1.0)""",
)
def supported(t):
    return hs.supported_hit(hits(t), min_coverage=0.05).select("query", "hit", F.round("identity", 9).alias("identity"), F.round("coverage", 9).alias("coverage"))


@query(
    "hsp_barcode_verdict",
    HITS + " SELECT query, hit, CASE WHEN identity IS NULL OR coverage < 0.1 THEN 'insufficient' WHEN identity < 92 THEN 'ambiguous' ELSE 'provisional_candidate' END AS status FROM hits",
)
def verdict(t):
    return hits(t).select("query", "hit", hs.barcode_verdict(F.col("identity"), F.col("coverage"), 92, 0.1).alias("status"))


GENE_HSPS = """
SELECT 'g' || CAST(l_suppkey AS STRING) || '_' || CAST(CAST(FLOOR(l_partkey / 500) AS BIGINT) AS STRING) AS gene, 't' || l_returnflag AS target, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
  CAST((l_linenumber - 1) * 30 + 1 AS BIGINT) AS qstart, CAST((l_linenumber - 1) * 30 + 20 AS BIGINT) AS qend,
  CASE WHEN l_linestatus = 'O' THEN l1 + (l_linenumber - 1) * 30 ELSE l1 + (9 - l_linenumber) * 30 END + CASE WHEN l_discount > 0.095 AND l_tax > 0.075 THEN 3 ELSE 0 END AS start,
  CASE WHEN l_linestatus = 'O' THEN l1 + (l_linenumber - 1) * 30 ELSE l1 + (9 - l_linenumber) * 30 END + CASE WHEN l_discount > 0.095 AND l_tax > 0.075 THEN 3 ELSE 0 END + 19 AS "end",
  100 - ROUND(l_tax * 200) AS identity, ROUND(l_discount * 100) AS evalue, CAST(20 + ROUND(l_discount * 100) AS BIGINT) AS aln_len, CAST(50 AS BIGINT) AS query_len
FROM (SELECT *, CAST(FLOOR(l_partkey / 20) AS BIGINT) * 1000 + 1 AS l1 FROM {lineitem})"""
CHAINS = f"""WITH RECURSIVE raw AS ({GENE_HSPS}), u AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY gene, target, strand, qstart, qend, start, "end" ORDER BY evalue, identity DESC, aln_len) = 1),
  n AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY gene, target, strand, qstart, qend, start, "end") AS id, CASE WHEN strand = '+' THEN start ELSE -"end" END AS f, CASE WHEN strand = '+' THEN "end" ELSE -start END AS t FROM u),
  lk AS MATERIALIZED (SELECT a.gene, a.target, a.strand, a.id AS x, b.id AS y FROM n a JOIN n b ON a.gene = b.gene AND a.target = b.target AND a.strand = b.strand
    AND b.qstart - a.qend - 1 BETWEEN 0 AND 20 AND b.f - a.t - 1 BETWEEN 0 AND 20 AND abs((b.qstart - a.qend) - (b.f - a.t)) <= 20),
  br AS MATERIALIZED (SELECT DISTINCT gene, target, strand FROM (SELECT gene, target, strand, x FROM lk GROUP BY ALL HAVING COUNT(*) > 1 UNION ALL SELECT gene, target, strand, y FROM lk GROUP BY ALL HAVING COUNT(*) > 1)),
  cl AS MATERIALIZED (SELECT * FROM lk ANTI JOIN br USING (gene, target, strand)),
  ch AS (SELECT id, id AS root FROM n WHERE id NOT IN (SELECT y FROM cl) UNION ALL SELECT cl.y, ch.root FROM ch JOIN cl ON cl.x = ch.id),
  chains AS (SELECT n.gene, n.target, n.strand, root, bool_or(br.gene IS NOT NULL) AS ambiguous_chain, COUNT(*) AS hsps, sum(qend - qstart + 1)::BIGINT AS aln_len, sum(aln_len)::BIGINT AS alignment_columns, sum(identity * aln_len) / sum(aln_len) AS identity,
    max(evalue) AS evalue, min(qstart) AS qstart, max(qend) AS qend, min(start) AS start, max("end") AS "end" FROM ch JOIN n USING (id) LEFT JOIN br ON br.gene = n.gene AND br.target = n.target AND br.strand = n.strand GROUP BY n.gene, n.target, n.strand, root)"""


@query("hsp_distinct", f'SELECT gene, target, strand, qstart, qend, start, "end", evalue, identity FROM ({GENE_HSPS}) QUALIFY row_number() OVER (PARTITION BY gene, target, strand, qstart, qend, start, "end" ORDER BY evalue, identity DESC, aln_len) = 1')
def distinct(t):
    return hs.distinct_hsps(t.sql(GENE_HSPS.replace('"end"', "`end`"))).select("gene", "target", "strand", "qstart", "qend", "start", "end", "evalue", "identity")


def gene_hsps(t):
    return t.sql(GENE_HSPS.replace('"end"', "`end`"))


@query("hsp_locus_chains", CHAINS + ' SELECT gene, target, strand, ambiguous_chain, hsps, aln_len, alignment_columns, round(identity, 9) AS identity, evalue, qstart, qend, start, "end" FROM chains')
def chains(t):
    return hs.locus_chains(gene_hsps(t)).drop("query_len").withColumn("identity", F.round("identity", 9))


@query(
    "hsp_gene_hits",
    CHAINS + """, st AS (SELECT gene, bool_or(ambiguous_chain) AS b, count_if(identity >= 80 AND aln_len / 50.0 >= 0.8) AS k FROM chains GROUP BY gene),
    ok AS (SELECT * FROM chains WHERE identity >= 80 AND aln_len / 50.0 >= 0.8)
    SELECT st.gene, CASE WHEN b THEN 'branched' WHEN k = 0 THEN 'none' WHEN k > 1 THEN 'multiple' ELSE 'unique' END AS status, CASE WHEN NOT b AND k = 1 THEN target END AS target, CASE WHEN NOT b AND k = 1 THEN strand END AS strand,
      CASE WHEN NOT b AND k = 1 THEN start END AS start, CASE WHEN NOT b AND k = 1 THEN "end" END AS "end", CASE WHEN NOT b AND k = 1 THEN round(identity, 9) END AS identity FROM st LEFT JOIN ok ON ok.gene = st.gene AND NOT b AND k = 1""",
)
def gene_hits(t):
    h = gene_hsps(t)
    return hs.gene_hits(hs.locus_chains(h), h).withColumn("identity", F.round("identity", 9))


# -- taxonomy --------------------------------------------------------------------------------------

TAXA = """SELECT 1000 + s_suppkey AS taxid, s_name AS name, 'species' AS rank, r_regionkey, n_nationkey, r_name, n_name
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey WHERE s_acctbal > -500"""
MARKER_HITS = """SELECT l_orderkey AS marker, l_linenumber AS hit, 1000 + l_suppkey AS t1, CASE WHEN l_tax > 0.065 THEN 1000 + l_linenumber ELSE 0 END AS t2, CAST(500 + l_quantity * 5 AS DOUBLE) AS ranking_bitscore,
  0.7 + l_discount * 3 AS coverage, CASE WHEN l_returnflag = 'R' AND l_tax < 0.015 THEN NULL ELSE 60 + ROUND(l_tax * 100) * 5 END AS identity, CASE WHEN l_discount < 0.005 THEN 'x' ELSE '' END AS blocker FROM {lineitem}"""
EXPECTED = """SELECT o_orderkey AS marker, CASE o_orderstatus WHEN 'F' THEN CAST(1 AS BIGINT) WHEN 'O' THEN 1000 + CAST(o_custkey / 100 AS BIGINT) ELSE 1000 + CAST(FLOOR(o_custkey / 15) AS BIGINT) END AS expected_taxid FROM {orders}""".replace("CAST(o_custkey / 100 AS BIGINT)", "CAST(FLOOR(o_custkey / 100) AS BIGINT)")


def taxa(t):
    """Taxa of every level: root, regions, nations and suppliers, each with its lineage down to itself."""
    node = lambda i, n, r: F.struct(i.cast("long").alias("taxid"), n.alias("name"), F.lit(r).alias("rank"))
    full = t.sql(TAXA)
    root = node(F.lit(1), F.lit("root"), "root")
    path = F.array(
        root, node(F.col("r_regionkey") + 10, F.col("r_name"), "region"), node(F.col("n_nationkey") + 100, F.col("n_name"), "nation"), node(F.col("taxid"), F.col("name"), "species")
    )
    species = full.select("taxid", "name", "rank", path.alias("lineage"))
    top = t.region.agg(F.count("*").alias("regions")).select(F.lit(1).cast("long").alias("taxid"), F.lit("root").alias("name"), F.lit("root").alias("rank"), F.array(root).alias("lineage"))
    return species.unionByName(top)


def marker_hits(t):
    h = t.sql(MARKER_HITS)
    ids = F.filter(F.array("t1", "t2"), lambda x: x > 0).cast("array<bigint>")
    return h.withColumn("taxids", ids).withColumn("blockers", F.filter(F.array("blocker"), lambda b: b != "")).drop("t1", "t2", "blocker")


MARKERS = f"""WITH tx AS (SELECT taxid, [1, 10 + r_regionkey, 100 + n_nationkey, taxid]::BIGINT[] AS lin, name AS nm, n_name, r_name FROM ({TAXA}) UNION ALL SELECT 1, [1]::BIGINT[], 'root', NULL, NULL),
  h AS ({MARKER_HITS}), b AS (SELECT marker, max(CASE WHEN blocker = '' AND identity >= 75 AND coverage >= 0.8 THEN ranking_bitscore END) AS best, max(CASE WHEN blocker <> '' THEN ranking_bitscore END) AS bl FROM h GROUP BY marker),
  c AS (SELECT h.* FROM h JOIN b USING (marker) WHERE blocker = '' AND identity >= 75 AND coverage >= 0.8 AND ranking_bitscore >= best * 0.95),
  s AS (SELECT b.*, coalesce(k, 0) AS near_best, coalesce(bl >= best * 0.95, false) AS comp FROM b LEFT JOIN (SELECT marker, COUNT(*) AS k FROM c GROUP BY marker) USING (marker)),
  ids AS (SELECT DISTINCT marker, unnest(list_filter([t1, t2], lambda x: x > 0)) AS taxid FROM c WHERE marker IN (SELECT marker FROM s WHERE near_best BETWEEN 1 AND 3 AND NOT comp)),
  kn AS (SELECT ids.*, lin FROM ids LEFT JOIN tx USING (taxid)), cp AS (SELECT marker, COUNT(*) AS nt, bool_or(lin IS NULL) AS miss FROM kn GROUP BY marker),
  nd AS (SELECT marker, unnest(lin) AS node, unnest(range(len(lin))) AS depth FROM kn), sh AS (SELECT marker, node, COUNT(*) AS k, max(depth) AS depth FROM nd GROUP BY ALL),
  cm AS (SELECT sh.* FROM sh JOIN cp USING (marker) WHERE k = nt AND NOT miss), e AS (SELECT x.*, tx.lin AS elin FROM ({EXPECTED}) x LEFT JOIN tx ON tx.taxid = expected_taxid),
  lc AS (SELECT marker, arg_max(node, (depth, node)) AS lca, bool_or(node = expected_taxid) AS inside FROM cm JOIN e USING (marker) GROUP BY marker),
  f AS (SELECT e.marker, e.elin, near_best, lca, inside, CASE WHEN coalesce(near_best, 0) = 0 THEN 'no_qualified_hit' WHEN comp THEN 'strong_blocked_hit' WHEN near_best >= 4 THEN 'saturated' WHEN coalesce(miss, true) THEN 'taxonomy_incomplete'
    WHEN lca IS NULL THEN 'no_common_lineage' END AS reason FROM e LEFT JOIN s USING (marker) LEFT JOIN cp USING (marker) LEFT JOIN lc USING (marker)),
  cls AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'insufficient' WHEN inside THEN 'compatible' WHEN coalesce(list_contains(elin, lca), false) THEN 'insufficient' ELSE 'discordant' END AS status FROM f)"""


def classified(t):
    return tn.classify_markers(marker_hits(t), taxa(t), t.sql(EXPECTED), saturation=4)


@query("taxon_classify_markers", MARKERS + " SELECT marker, status, reason, coalesce(near_best, 0) AS near_best, lca AS lca_taxid FROM cls")
def classify(t):
    return classified(t).select("marker", "status", "reason", "near_best", "lca_taxid")


@query(
    "taxon_sample_verdict",
    MARKERS + """, g AS (SELECT o_custkey AS sample, bool_or(status = 'compatible') AS c, bool_or(status = 'discordant') AS d, bool_or(status = 'insufficient') AS i, COUNT(*) AS markers FROM cls JOIN orders ON o_orderkey = marker GROUP BY ALL)
    SELECT c_custkey AS sample, coalesce(markers, 0) AS markers, CASE WHEN c AND d THEN 'suspected_mixed' WHEN c_acctbal < 0 OR markers IS NULL OR i THEN 'insufficient' WHEN d THEN 'suspected_mismatch' WHEN c THEN 'compatible' ELSE 'insufficient' END AS status
    FROM customer LEFT JOIN g ON sample = c_custkey""",
)
def sample_verdict(t):
    markers = classified(t).join(t.orders.select(F.col("o_orderkey").alias("marker"), F.col("o_custkey").alias("sample")), "marker")
    samples = t.customer.select(F.col("c_custkey").alias("sample"), (F.col("c_acctbal") < 0).cast("int").alias("failures"))
    return tn.sample_verdict(markers, samples)


@query(
    "taxon_alias",
    """SELECT c_custkey, CASE lower(trim(v)) WHEN 'insect' THEN 'Insecta' WHEN 'insects' THEN 'Insecta' ELSE trim(v) END AS expected FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN ' Insect' WHEN 'MACHINERY' THEN 'insects ' ELSE c_mktsegment || ' ' END AS v FROM customer)""",
)
def alias(t):
    named = F.when(F.col("c_mktsegment") == "BUILDING", " Insect").when(F.col("c_mktsegment") == "MACHINERY", "insects ").otherwise(F.concat("c_mktsegment", F.lit(" ")))
    return tn.alias_taxon(t.customer.select("c_custkey", named.alias("expected")))


@query(
    "taxon_exact_profile",
    """SELECT s_name || CASE WHEN s_acctbal > 5000 THEN ' ' ELSE '' END AS requested, CASE WHEN s_nationkey < 20 THEN s_suppkey END AS genetic_code, s_nationkey < 20 AS found FROM supplier""",
)
def profile(t):
    requests = t.supplier.select(F.concat("s_name", F.when(F.col("s_acctbal") > 5000, " ").otherwise("")).alias("name"))
    profiles = t.supplier.where("s_nationkey < 20").select(F.upper("s_name").alias("name"), F.col("s_suppkey").alias("genetic_code"))
    return tn.exact_profile(requests, profiles).select("requested", "genetic_code", "found")
