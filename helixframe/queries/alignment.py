"""Alignment evidence: lines of orders act as reads on suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import seq as sq
from helixframe.operators import align as al
from helixframe.queries.registry import query

READS = """
SELECT 'all' AS sample, 'q' || CAST(l_orderkey AS STRING) AS qname,
  CAST(CASE WHEN l_linenumber IN (1, 3, 5) THEN 65 WHEN l_linenumber = 7 THEN 0 ELSE 129 END + CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END
    + CASE WHEN l_quantity < 40 AND l_linenumber <> 7 THEN 2 ELSE 0 END + CASE WHEN l_discount > 0.095 THEN 1024 ELSE 0 END + CASE WHEN l_discount < 0.005 THEN 256 ELSE 0 END
    + CASE WHEN l_extendedprice > 90000 THEN 512 ELSE 0 END + CASE WHEN l_extendedprice < 1500 AND l_linenumber <> 7 THEN 8 ELSE 0 END AS INT) AS flag,
  'S' || CAST(l_suppkey AS STRING) AS rname, l_partkey + 1 AS pos, CAST(CASE WHEN l_quantity >= 50 THEN 255 ELSE l_quantity END AS INT) AS mapq,
  CASE CAST(ROUND(l_tax * 100) AS INT) WHEN 1 THEN '3S7M' WHEN 2 THEN '4M1I5M' WHEN 3 THEN '4M2D6M' WHEN 4 THEN '5=1X4=' WHEN 5 THEN '2M100N8M' WHEN 6 THEN '8M2S' WHEN 8 THEN '1H10M' ELSE '10M' END AS cigar,
  CASE WHEN l_linenumber = 2 THEN 'S1' ELSE '=' END AS rnext, l_partkey + 1 + CASE WHEN l_returnflag = 'R' THEN 700 WHEN l_returnflag = 'A' THEN -700 ELSE 1 END AS pnext,
  translate(substr(md5(CAST(l_orderkey AS STRING) || '/' || CAST(l_partkey AS STRING)), 1, 10), '0123456789abcdef', 'AAAAAAACCCCGGGTN') AS seq,
  CASE WHEN l_extendedprice BETWEEN 20000 AND 21000 THEN '*' ELSE translate(substr(md5(CAST(l_partkey AS STRING)), 11, 10), '0123456789abcdef', '!+5?I5+5?I5?IIII') END AS qual,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS rg
FROM {lineitem}"""
REFS = "SELECT 'all' AS sample, 'S' || CAST(s_suppkey AS STRING) AS rname, (SELECT MAX(p_partkey) + 251 FROM {part}) AS length FROM {supplier}"
SITES = "SELECT DISTINCT 'all' AS sample, 'S' || CAST(l_suppkey AS STRING) AS rname, l_partkey + 4 AS pos FROM {lineitem} WHERE l_returnflag = 'R'"

# The oracle lays CIGAR operations out as rows.
OPS = f"""ops AS (SELECT r.*, i, n, op, pos + list_sum([0::BIGINT] || list_transform(range(1, i), lambda j: CASE WHEN contains('M=XDN', ol[j]) THEN nl[j] ELSE 0 END)) AS rs,
  list_sum([0::BIGINT] || list_transform(range(1, i), lambda j: CASE WHEN contains('M=XIS', ol[j]) THEN nl[j] ELSE 0 END)) AS qs,
  list_sum([0::BIGINT] || list_transform(range(1, i), lambda j: CASE WHEN contains('M=X', ol[j]) THEN 0 ELSE 1 END)) AS island
  FROM (SELECT *, nl[i] AS n, ol[i] AS op FROM (SELECT *, unnest(range(1, len(ol) + 1)) AS i FROM
    (SELECT *, row_number() OVER () AS rid, list_transform(regexp_extract_all(cigar, '(\\d+)[MIDNSHP=X]', 1), lambda x: x::BIGINT) AS nl, regexp_extract_all(cigar, '\\d+([MIDNSHP=X])', 1) AS ol FROM ({READS})))) r)"""
BASES = f"""{OPS}, cells AS (SELECT *, rs + k AS bpos, qs + k AS q FROM (SELECT *, unnest(range(0, n)) AS k FROM ops WHERE contains('M=X', op))),
  good AS (SELECT *, ascii(substr(qual, (q + 1)::INT, 1)) - 33 AS bq FROM cells WHERE (flag & 3844) = 0 AND mapq <> 255 AND mapq >= 20 AND qual <> '*'),
  ok AS (SELECT * FROM good WHERE bq >= 20),
  dep AS (SELECT rname, bpos AS pos, COUNT(DISTINCT coalesce(rg, '') || '/' || qname) AS depth FROM ok GROUP BY ALL)"""
TOTALS = f"""tot AS (SELECT r.rname, r.length, coalesce(sum(depth), 0)::DOUBLE / r.length AS global_mean, r.length - COUNT(d.pos) AS zero_bases FROM ({REFS}) r LEFT JOIN dep d USING (rname) GROUP BY r.rname, r.length)"""
WINDOWS = """win AS (SELECT g.rname, w * 500 + 1 AS start, least((w + 1) * 500, length) AS "end", coalesce(s, 0)::DOUBLE / (least((w + 1) * 500, length) - w * 500) AS mean,
  CASE WHEN coalesce(c, 0) < least((w + 1) * 500, length) - w * 500 THEN 0 ELSE mn END AS minimum, coalesce(mx, 0) AS maximum, global_mean
  FROM (SELECT *, unnest(range(0, (length - 1) // 500 + 1)) AS w FROM tot) g LEFT JOIN (SELECT rname, (pos - 1) // 500 AS w, sum(depth) AS s, min(depth) AS mn, max(depth) AS mx, COUNT(*) AS c FROM dep GROUP BY ALL) USING (rname, w)),
  lw AS (SELECT *, mean < 0.15 OR mean < 0.5 * global_mean AS low FROM win)"""
MIN_DEPTH = 0.15


def reads(t):
    return t.sql(READS)


@query(
    "align_cigar_blocks",
    f"""WITH {OPS}, bl AS (SELECT rid, island, min(rs) AS s, max(rs + n) AS e FROM ops WHERE contains('M=X', op) GROUP BY ALL)
    SELECT qname, pos, cigar, span, blocks, COUNT(*) AS n FROM (SELECT rid, any_value(qname) AS qname, any_value(pos) AS pos, any_value(cigar) AS cigar,
      sum(CASE WHEN contains('M=XDN', op) THEN n ELSE 0 END)::BIGINT AS span FROM ops GROUP BY rid)
    JOIN (SELECT rid, string_agg(s || '-' || e, ',' ORDER BY s) AS blocks FROM bl GROUP BY rid) USING (rid) GROUP BY ALL""",
)
def blocks(t):
    shown = F.transform(sq.aligned_blocks(F.col("pos"), F.col("cigar")), lambda b: F.concat_ws("-", b["start"].cast("string"), b["end"].cast("string")))
    out = reads(t).select("qname", "pos", "cigar", sq.reference_span(F.col("cigar")).alias("span"), F.array_join(shown, ",").alias("blocks"))
    return out.groupBy("qname", "pos", "cigar", "span", "blocks").agg(F.count("*").alias("n"))


@query(
    "align_read_name_functions",
    f"""SELECT regexp_replace(qname || '/' || (flag & 3), '/[12]$', '') AS name, coalesce(rg, '') AS rg, reverse(translate(seq, 'ACGTN', 'TGCAN')) AS rc,
      CASE WHEN qual = '*' THEN NULL ELSE ascii(substr(qual, 3, 1)) - 33 END AS third, COUNT(*) AS n FROM ({READS}) GROUP BY ALL""",
)
def names(t):
    from helixframe.functions import text as tx

    key = sq.template_key(F.col("rg"), F.col("qname"))
    out = reads(t).select(
        tx.read_name(F.concat_ws("/", "qname", F.col("flag").bitwiseAND(3).cast("string"))).alias("name"), key["rg"].alias("rg"),
        sq.reverse_complement(F.col("seq")).alias("rc"), sq.phred(F.col("qual"), F.lit(2)).alias("third"),
    )
    return out.groupBy("name", "rg", "rc", "third").agg(F.count("*").alias("n"))


@query("align_depth", f"WITH {BASES} SELECT 'all' AS sample, rname, pos, depth FROM dep")
def depth(t):
    return al.depth(reads(t))


@query("align_coverage_totals", f"WITH {BASES}, {TOTALS} SELECT 'all' AS sample, rname, length, round(global_mean, 9) AS global_mean, zero_bases FROM tot")
def totals(t):
    return al.coverage_totals(al.depth(reads(t)), t.sql(REFS)).withColumn("global_mean", F.round("global_mean", 9))


@query(
    "align_coverage_windows",
    f"""WITH {BASES}, {TOTALS}, {WINDOWS} SELECT 'all' AS sample, rname, start, "end", round(mean, 9) AS mean, minimum, maximum, low FROM lw""",
)
def windows(t):
    return al.coverage_windows(al.depth(reads(t)), t.sql(REFS), min_depth=MIN_DEPTH).withColumn("mean", F.round("mean", 9))


@query(
    "align_coverage_status",
    f"""WITH {BASES}, {TOTALS}, {WINDOWS} SELECT 'all' AS sample, rname, round(any_value(tot.global_mean), 9) AS global_mean, any_value(zero_bases) AS zero_bases, count_if(low)::BIGINT AS low_windows,
      CASE WHEN count_if(low) > 0 OR any_value(zero_bases) > 0 THEN 'REVIEW' ELSE 'NO_COVERAGE_WARNING' END AS status FROM lw JOIN tot USING (rname) GROUP BY rname""",
)
def status(t):
    tally, refs = al.window_tally(al.depth(reads(t))), t.sql(REFS)
    out = al.coverage_status(al.tally_windows(tally, refs, min_depth=MIN_DEPTH), al.tally_totals(tally, refs))
    return out.withColumn("global_mean", F.round("global_mean", 9))


READ_ENDS = """ends AS (SELECT rid, any_value(qname) AS qname, any_value(rg) AS rg, any_value(flag) AS flag, any_value(mapq) AS mapq, any_value(rname) AS rname, any_value(pos) AS pos,
  any_value(cigar) AS cigar, any_value(rnext) AS rnext, any_value(pnext) AS pnext, any_value(seq) AS seq, any_value(qual) AS qual,
  any_value(pos) + sum(CASE WHEN contains('M=XDN', op) THEN n ELSE 0 END) - 1 AS e FROM ops GROUP BY rid)"""
CALLS = f"""{OPS}, {READ_ENDS}, sites AS ({SITES}),
  pr AS (SELECT s.rname, s.pos AS site, e.* EXCLUDE (rname) FROM sites s JOIN ends e ON e.rname = s.rname AND e.pos <= s.pos AND e.e >= s.pos),
  cl AS (SELECT pr.*, upper(substr(pr.seq, (o.qs + site - o.rs + 1)::INT, 1)) AS base, CASE WHEN pr.qual = '*' OR o.rid IS NULL THEN NULL ELSE ascii(substr(pr.qual, (o.qs + site - o.rs + 1)::INT, 1)) - 33 END AS bq
    FROM pr LEFT JOIN ops o ON o.rid = pr.rid AND contains('M=X', o.op) AND o.rs <= site AND site < o.rs + o.n),
  ex AS (SELECT *, CASE WHEN (flag & 1024) <> 0 THEN 'duplicate' WHEN (flag & 2308) <> 0 THEN 'secondary' WHEN (flag & 512) <> 0 THEN 'qc_fail' WHEN mapq = 255 OR mapq < 20 THEN 'low_mapq'
    WHEN NOT coalesce(base IN ('A', 'C', 'G', 'T'), false) THEN 'no_base' WHEN bq IS NULL THEN 'missing_baseq' WHEN bq < 20 THEN 'low_baseq' END AS exclusion FROM cl)"""


@query("align_site_exclusions", f"WITH {CALLS} SELECT coalesce(exclusion, 'kept') AS exclusion, base, bq AS quality, COUNT(*) AS n FROM ex GROUP BY ALL")
def exclusions(t):
    calls = al.site_calls(reads(t), t.sql(SITES))
    return calls.groupBy(F.coalesce("exclusion", F.lit("kept")).alias("exclusion"), "base", "quality").agg(F.count("*").alias("n"))


EXCLUDED = ", ".join(f"COUNT(CASE WHEN exclusion = '{r}' THEN 1 END) AS excluded_{r}" for r in al.REASONS)


@query(
    "align_base_support",
    f"""WITH {CALLS}, tp AS (SELECT rname, site, coalesce(rg, '') AS g, qname, min(base) AS base, min(base) <> max(base) AS conflict, COUNT(*) AS nr,
      arg_min(flag, (CASE WHEN (flag & 64) <> 0 THEN 0 ELSE 1 END, -bq, flag)) AS flag FROM ex WHERE exclusion IS NULL GROUP BY ALL),
    pb AS (SELECT rname, site, base, count_if(NOT conflict)::BIGINT AS n, count_if(NOT conflict AND (flag & 16) <> 0)::BIGINT AS minus, count_if(conflict)::BIGINT AS mc, sum(nr)::BIGINT AS rd FROM tp GROUP BY ALL),
    dm AS (SELECT rname, site, base AS db, n AS dn, minus AS dm FROM pb WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY rname, site ORDER BY n DESC, base) = 1),
    st AS (SELECT rname, site, sum(n)::BIGINT AS depth, sum(mc)::BIGINT AS mate_conflict, sum(rd)::BIGINT AS read_depth, sum(CASE WHEN base = 'A' THEN n ELSE 0 END)::BIGINT AS n_a, sum(CASE WHEN base = 'C' THEN n ELSE 0 END)::BIGINT AS n_c,
      sum(CASE WHEN base = 'G' THEN n ELSE 0 END)::BIGINT AS n_g, sum(CASE WHEN base = 'T' THEN n ELSE 0 END)::BIGINT AS n_t FROM pb GROUP BY ALL),
    ec AS (SELECT rname, site, {EXCLUDED} FROM ex GROUP BY ALL),
    j AS (SELECT ec.*, db, dn, dm, coalesce(depth, 0) AS depth, coalesce(mate_conflict, 0) AS mate_conflict, coalesce(read_depth, 0) AS read_depth, coalesce(n_a, 0) AS n_a, coalesce(n_c, 0) AS n_c, coalesce(n_g, 0) AS n_g, coalesce(n_t, 0) AS n_t,
      coalesce(dn::DOUBLE / nullif(depth, 0), 0.0) AS support FROM ec LEFT JOIN st USING (rname, site) LEFT JOIN dm USING (rname, site)),
    k AS (SELECT *, concat_ws(',', CASE WHEN depth = 0 THEN 'zero_depth' END, CASE WHEN depth BETWEEN 1 AND 2 THEN 'low_depth' END, CASE WHEN greatest(dm, dn - dm)::DOUBLE / dn > 0.9 THEN 'strand_bias' END) AS reasons FROM j)
    SELECT 'all' AS sample, rname, site, db AS base, depth, round(support, 9) AS support, read_depth, n_a, n_c, n_g, n_t, mate_conflict, {', '.join('excluded_' + r for r in al.REASONS)},
      reasons, reasons = '' AS callable, CASE WHEN reasons = '' AND support > 0.95 THEN db END AS candidate_base FROM k""",
)
def base_support(t):
    out = al.base_support(al.site_calls(reads(t), t.sql(SITES)), min_depth=3)
    return out.withColumn("reasons", F.array_join("reasons", ",")).withColumn("support", F.round("support", 9))


@query(
    "align_region_observations",
    f"""WITH {BASES}, {TOTALS}, {WINDOWS}, {READ_ENDS}, l3 AS (SELECT rname, start AS lo, "end" AS hi FROM lw WHERE low QUALIFY row_number() OVER (PARTITION BY rname ORDER BY start) <= 3),
    pr AS (SELECT l3.rname, lo, hi, e.* EXCLUDE (rname), CASE WHEN (flag & 1) = 0 OR (flag & 8) <> 0 THEN 'none' WHEN NOT (rnext = '=' OR rnext = l3.rname) THEN 'other' WHEN pnext < lo THEN 'left' WHEN pnext > hi THEN 'right' ELSE 'inside' END AS mate
      FROM l3 LEFT JOIN ends e ON e.rname = l3.rname AND e.pos <= hi AND e.e >= lo AND (flag & 3844) = 0 AND mapq <> 255 AND mapq >= 20)
    SELECT 'all' AS sample, rname, lo, hi, COUNT(rid) AS reads, COUNT(CASE WHEN contains(cigar, 'S') THEN 1 END) AS soft_clipped, {', '.join(f"count_if(rid IS NOT NULL AND mate = '{m}')::BIGINT AS mate_{m}" for m in ('left', 'right', 'inside', 'other', 'none'))} FROM pr GROUP BY rname, lo, hi""",
)
def observations(t):
    r = reads(t)
    return al.region_observations(r, al.first_low_windows(al.window_tally(al.depth(r)), t.sql(REFS), min_depth=MIN_DEPTH))


TARGETS = f"""{BASES}, tc AS (SELECT r.rname, r.length, coalesce(nr, 0) AS reads, coalesce(cb, 0) AS covered_bases, coalesce(cb, 0)::DOUBLE / length * 100 AS breadth_percent,
  coalesce(nb, 0)::DOUBLE / length AS mean_depth, mq AS mean_baseq, mm AS mean_mapq FROM ({REFS}) r
  LEFT JOIN (SELECT rname, COUNT(*) AS nr, avg(mapq) AS mm FROM ({READS}) WHERE (flag & 3844) = 0 AND mapq <> 255 AND mapq >= 20 GROUP BY rname) USING (rname)
  LEFT JOIN (SELECT rname, COUNT(DISTINCT bpos) AS cb, COUNT(*) AS nb, avg(bq) AS mq FROM ok GROUP BY rname) USING (rname))"""


@query(
    "align_target_coverage",
    f"""WITH {TARGETS} SELECT 'all' AS sample, rname, length, reads, covered_bases, round(breadth_percent, 7) AS breadth_percent, round(mean_depth, 7) AS mean_depth, round(mean_baseq, 7) AS mean_baseq, round(mean_mapq, 7) AS mean_mapq FROM tc""",
)
def target_coverage(t):
    out = al.target_coverage(reads(t), t.sql(REFS))
    return out.select("sample", "rname", "length", "reads", "covered_bases", *[F.round(c, 7).alias(c) for c in ("breadth_percent", "mean_depth", "mean_baseq", "mean_mapq")])


# A candidate is a nation: its records are its suppliers.
CANDIDATES = f"SELECT 'N' || CAST(s_nationkey AS STRING) AS candidate, r.sample, r.rname, r.length FROM {{supplier}} JOIN ({REFS}) r ON r.rname = 'S' || CAST(s_suppkey AS STRING)"


@query(
    "align_candidate_coverage",
    f"""WITH {TARGETS} SELECT candidate, COUNT(*) AS records, sum(c.length)::BIGINT AS total_bases, sum(covered_bases)::BIGINT AS covered_bases, round(sum(covered_bases)::DOUBLE * 100 / sum(c.length), 4) AS weighted_breadth_percent,
      round(sum(mean_depth * c.length) / sum(c.length), 4) AS weighted_mean_depth FROM ({CANDIDATES}) c LEFT JOIN tc USING (rname) GROUP BY candidate""",
)
def candidate_coverage(t):
    return al.candidate_coverage(al.target_coverage(reads(t), t.sql(REFS)), t.sql(CANDIDATES))


MATES = f"""mt AS (SELECT qname, CASE WHEN (flag & 64) <> 0 THEN 1 WHEN (flag & 128) <> 0 THEN 2 ELSE 0 END AS mate, candidate, (flag & 2) <> 0 AS proper
  FROM ({READS}) r JOIN ({CANDIDATES}) c USING (rname) WHERE (flag & 3840) = 0 AND mapq >= 20 AND (flag & 4) = 0)"""


@query("align_duplicate_mates", f"WITH {MATES} SELECT 'all' AS sample, qname, mate, COUNT(*) AS n FROM mt GROUP BY ALL HAVING COUNT(*) > 1")
def duplicate_mates(t):
    return al.duplicate_mates(al.primary_mates(reads(t), t.sql(CANDIDATES).select("rname", "candidate")))


@query(
    "align_fragment_counts",
    f"""WITH {MATES}, sl AS (SELECT qname, mate, COUNT(*) AS n, min(candidate) AS lo, max(candidate) AS hi, bool_and(proper) AS proper FROM mt GROUP BY ALL),
    fr AS (SELECT qname, min(lo) AS candidate, max(hi) AS hi, max(n) AS n, COUNT(*) AS mates, bool_and(proper) AS proper, count_if(mate = 1) AS m1, count_if(mate = 2) AS m2 FROM sl GROUP BY qname)
    SELECT c.candidate, COUNT(f.qname) AS fragments, count_if(mates >= 2 AND proper)::BIGINT AS proper_pairs, count_if(m1 > 0 AND m2 > 0)::BIGINT AS both_mates
    FROM (SELECT DISTINCT candidate FROM ({CANDIDATES})) c LEFT JOIN (SELECT * FROM fr WHERE n = 1 AND candidate = hi) f USING (candidate) GROUP BY c.candidate""",
)
def fragments(t):
    targets = t.sql(CANDIDATES).select("rname", "candidate")
    return al.fragment_counts(al.primary_mates(reads(t), targets), targets)


# One junction per (supplier, part) sold with return flag N.
REGIONS = "SELECT DISTINCT 'S' || CAST(l_suppkey AS STRING) || ':' || CAST(l_partkey AS STRING) AS region, 'all' AS sample, 'S' || CAST(l_suppkey AS STRING) AS rname, l_partkey + 3 AS lo, l_partkey + 5 AS hi FROM {lineitem} WHERE l_returnflag = 'N'"
JUNCTION = f"""{OPS}, {READ_ENDS}, rg0 AS ({REGIONS}), bl AS (SELECT rid, island, min(rs) AS s, max(rs + n) AS e FROM ops WHERE contains('M=X', op) GROUP BY ALL),
  pr AS (SELECT g.region, g.lo, g.hi, e.* FROM rg0 g JOIN ends e ON e.rname = g.rname AND e.pos <= g.hi AND e.e >= g.lo),
  du AS (SELECT region, count_if((flag & 1024) <> 0)::BIGINT AS duplicates_excluded FROM pr GROUP BY region),
  gd AS (SELECT * FROM pr WHERE (flag & 1024) = 0 AND (flag & 2820) = 0 AND mapq <> 255 AND mapq >= 20 AND EXISTS (SELECT 1 FROM bl WHERE bl.rid = pr.rid AND bl.s <= pr.lo AND bl.e > pr.hi)),
  tm AS (SELECT region, coalesce(rg, '') AS g, qname, arg_min(flag, (CASE WHEN (flag & 64) <> 0 THEN 0 ELSE 1 END, -mapq, flag)) AS flag, arg_min(mapq, (CASE WHEN (flag & 64) <> 0 THEN 0 ELSE 1 END, -mapq, flag)) AS mapq,
    count_if((flag & 16) = 0) AS rp, count_if((flag & 16) <> 0) AS rm FROM gd GROUP BY ALL),
  sm AS (SELECT region, COUNT(*) AS support, count_if((flag & 16) = 0)::BIGINT AS plus, count_if((flag & 16) <> 0)::BIGINT AS minus, sum(rp)::BIGINT AS reads_plus, sum(rm)::BIGINT AS reads_minus, min(mapq) AS mapq_min,
    list_sort(list(mapq))[len(list(mapq)) // 2 + 1] AS mapq_median FROM tm GROUP BY region),
  jn AS (SELECT g.region, coalesce(support, 0) AS support, coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus, coalesce(reads_plus, 0) AS reads_plus, coalesce(reads_minus, 0) AS reads_minus,
    coalesce(duplicates_excluded, 0) AS duplicates_excluded, mapq_min, mapq_median FROM rg0 g LEFT JOIN sm USING (region) LEFT JOIN du USING (region))"""


@query("align_junction_evidence", f"WITH {JUNCTION} SELECT * FROM jn")
def junction(t):
    return al.junction_evidence(reads(t), t.sql(REGIONS))


@query(
    "align_junction_verdict",
    f"""WITH {JUNCTION} SELECT region, support, CASE WHEN NOT duplicates_excluded = 0 THEN 'UNRESOLVED' WHEN support < 1 THEN 'INSUFFICIENT' WHEN plus > 0 AND minus > 0 THEN 'CANDIDATE_ACCEPTED' ELSE 'PUTATIVE_CIRCULAR' END AS status FROM jn""",
)
def verdict(t):
    found = al.junction_evidence(reads(t), t.sql(REGIONS)).select(
        "region", "support", (F.col("duplicates_excluded") == 0).alias("reads_validated"), (F.col("plus") > 0).alias("accept"), (F.col("minus") > 0).alias("order_matches")
    )
    return al.junction_verdict(found, 1).select("region", "support", "status")


MANIFESTS = """SELECT o_orderkey AS case_id, CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE 'mito-junction-bam-1' END AS format, 'c' || CAST(o_custkey AS STRING) AS candidate_path,
  md5(c_name) AS candidate_sha256, 'a' || CAST(o_custkey AS STRING) AS alignment_path, md5(CASE WHEN o_totalprice > 250000 THEN 'x' ELSE c_name END) AS alignment_sha256,
  c_mktsegment AS reference_name, CAST(c_nationkey AS BIGINT) + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS reference_length,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'map' END AS command FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
FILES = """SELECT 'c' || CAST(c_custkey AS STRING) AS path, md5(c_name) AS sha256, c_mktsegment AS record_id, CAST(c_nationkey AS BIGINT) AS length FROM {customer} WHERE c_acctbal > 0
  UNION ALL SELECT 'a' || CAST(c_custkey AS STRING), md5(c_name), NULL, NULL FROM {customer}"""
HEADERS = "SELECT 'a' || CAST(c_custkey AS STRING) AS path, c_mktsegment AS sn, CAST(c_nationkey AS BIGINT) AS ln FROM {customer} WHERE c_nationkey > 3"


@query(
    "align_provenance_findings",
    """SELECT o_orderkey AS case_id, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'format' END, CASE WHEN NOT c_acctbal > 0 THEN 'candidate_hash' END, CASE WHEN o_totalprice > 250000 THEN 'alignment_hash' END,
      CASE WHEN NOT c_acctbal > 0 THEN 'reference_name' END, CASE WHEN NOT c_acctbal > 0 OR o_orderpriority = '5-LOW' THEN 'reference_length' END,
      CASE WHEN (c_nationkey > 3) <> (c_acctbal > 0) THEN 'header_length' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'mapping_command' END) AS reasons FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def provenance(t):
    manifests = t.sql(MANIFESTS).withColumn("mapping_command", F.array("command"))
    return al.provenance_findings(manifests, t.sql(FILES), t.sql(HEADERS)).withColumn("reasons", F.array_join("reasons", ","))


@query(
    "align_read_findings",
    f"""SELECT qname, pos, cigar, findings, COUNT(*) AS n FROM (SELECT qname, pos, cigar, CASE WHEN contains(cigar, 'N') THEN 'bad_cigar' WHEN contains(cigar, 'I') THEN 'cigar_length' END AS findings FROM ({READS})) WHERE findings IS NOT NULL GROUP BY ALL""",
)
def findings(t):
    broken = reads(t).withColumn("seq", F.when(F.col("cigar").contains("I"), F.concat("seq", F.lit("A"))).otherwise(F.col("seq")))
    broken = broken.withColumn("qual", F.when(F.col("cigar").contains("I") & (F.col("qual") != "*"), F.concat("qual", F.lit("I"))).otherwise(F.col("qual")))
    bad = F.when(F.col("cigar").contains("N"), F.concat("cigar", F.lit("0"))).otherwise(F.col("cigar"))
    out = al.read_findings(broken.withColumn("cigar", bad)).withColumn("cigar", F.regexp_replace("cigar", "0$", "")).withColumn("findings", F.array_join("findings", ","))
    return out.groupBy("qname", "pos", "cigar", "findings").agg(F.count("*").alias("n"))
