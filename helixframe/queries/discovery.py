"""Discovery over documents (records), orders (sample tables) and pages (links)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from helixframe.functions import rules, text as tx
from helixframe.operators import discover as di
from helixframe.plans import evidence as ev
from helixframe.queries.registry import query

RECORDS = """
SELECT CAST(doc_id AS STRING) AS uid, doc_id AS record_ord,
  CASE WHEN source IN ('src1', 'src2') THEN 'GDS' ELSE 'GSE' END || CAST(doc_id AS STRING) AS accession,
  regexp_extract(text, '^[^.]*', 0) AS title,
  text || ' srr' || CAST(doc_id AS STRING) || ', SRX' || CAST(n_chars AS STRING) || ' (SAMN' || CAST(n_chars AS STRING) || ') PRJEB' || CAST(n_chars AS STRING) || '.' AS summary,
  CASE lang WHEN 'en' THEN 'Homo sapiens' WHEN 'fr' THEN 'Mus musculus; Homo sapiens' WHEN 'de' THEN 'Sus scrofa' ELSE 'Bos taurus, Gallus gallus' END AS taxon,
  CASE WHEN n_chars < 800 THEN 'Non-coding RNA profiling' WHEN n_chars < 1500 THEN 'Expression profiling by array'
       WHEN n_chars < 2500 THEN 'Expression profiling by high throughput sequencing' WHEN n_chars < 4000 THEN 'Single cell atlas' ELSE 'Other' END AS gds_type,
  replace(source, 'src', '') || ' ;;GPL' || CAST(n_chars AS STRING) || '; ' || source AS platform,
  CASE WHEN n_chars < 300 THEN NULL ELSE CAST(n_chars % 41 AS BIGINT) END AS samples,
  CASE lang WHEN 'en' THEN 'TXT, csv' WHEN 'fr' THEN 'CEL; txt' WHEN 'de' THEN 'mtx;MTX' ELSE '' END AS supplemental_files,
  CASE lang WHEN 'en' THEN 'PRJNA' || CAST(doc_id AS STRING) || '; none' ELSE '' END AS bioproject,
  '' AS ftp_link
FROM {documents}"""
HITS = f"""
SELECT q.query_ord, q.query, r.* FROM ({RECORDS}) r JOIN (
  SELECT 1 AS query_ord, 'the   first query' AS query, ' the ' AS word UNION ALL SELECT 2, ' der second', ' que ' UNION ALL SELECT 3, 'third', 'ren'
  UNION ALL SELECT 4, 'the first  query', 'ion'
) q ON contains(lower(r.summary), q.word)"""


def hits(t):
    return t.sql(HITS)


def ordered_distinct(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def sorted_flags(*pairs: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in pairs)
    return f"array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',')"


def joined(column, sort=False):
    return F.array_join(F.array_sort(column) if sort else column, ",")


MERGED = f"""(WITH h AS ({HITS}), lab AS (SELECT uid, trim(regexp_replace(query, '\\s+', ' ', 'g')) AS label, min((query_ord, record_ord)) AS o FROM h GROUP BY ALL),
  mq AS (SELECT uid, list(label ORDER BY o) AS matched_queries, min(o) AS first_seen FROM lab GROUP BY uid),
  f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY uid ORDER BY query_ord, record_ord) = 1)
  SELECT f.* EXCLUDE (query, query_ord), matched_queries, first_seen FROM f JOIN mq USING (uid))"""


@query(
    "discover_merge_first_wins",
    f"SELECT uid, accession, title, taxon, samples, array_to_string(matched_queries, '|') AS matched_queries FROM {MERGED}",
)
def merge(t):
    out = di.merge_first_wins(hits(t).drop("summary"))
    return out.select("uid", "accession", "title", "taxon", "samples", F.array_join("matched_queries", "|").alias("matched_queries"))


@query(
    "discover_search_limit",
    f"""SELECT query_ord, uid FROM (SELECT query_ord, uid, row_number() OVER (PARTITION BY query_ord, query ORDER BY record_ord, uid) AS n FROM ({HITS})) WHERE n <= 10""",
)
def limit(t):
    return di.within_limit(hits(t)).select("query_ord", "uid")


@query(
    "discover_filter_records",
    f"""SELECT uid FROM ({RECORDS}) WHERE NOT regexp_matches(taxon, '[;,]') AND (contains(lower(taxon), 'sapiens') OR contains(lower(taxon), 'sus '))
    AND (contains(lower(gds_type), 'array') OR contains(lower(gds_type), 'sequencing'))
    AND contains(lower(concat_ws(' ', nullif(accession, ''), nullif(title, ''), nullif(summary, ''), nullif(taxon, ''), nullif(gds_type, ''), nullif(platform, ''), nullif(supplemental_files, ''), nullif(bioproject, ''))), 'gpl')
    AND NOT contains(lower(concat_ws(' ', accession, title, summary, taxon, gds_type, platform, supplemental_files, bioproject)), 'src7')""",
)
def filtered(t):
    out = di.filter_records(
        t.sql(RECORDS), "taxon", "gds_type",
        ["accession", "title", "summary", "taxon", "gds_type", "platform", "supplemental_files", "bioproject"],
        taxa=["Sapiens", "SUS "], assays=["Array", "sequencing"], include=["GPL"], exclude=["SRC7"], single_species=True,
    )
    return out.select("uid")


@query(
    "discover_inspectable_top",
    f"SELECT uid, accession FROM {MERGED} WHERE upper(accession) LIKE 'GSE%' ORDER BY first_seen, accession LIMIT 3",
)
def top_inspectable(t):
    return di.inspectable(di.merge_first_wins(hits(t).select("uid", "accession", "query", "query_ord", "record_ord"))).select("uid", "accession")


# Sequencing-archive hits: several records share a study; gaps are filled from later ones.
STUDIES = f"""
SELECT h.query_ord, h.query, h.record_ord, h.uid,
  CASE WHEN h.samples > 35 THEN '' ELSE 'SRP' || CAST(CAST(FLOOR(h.record_ord / 3) AS BIGINT) AS STRING) END AS accession,
  'study' AS source_type, '' AS summary, CASE WHEN h.samples % 3 = 0 THEN '' ELSE h.taxon END AS organism,
  CASE WHEN h.samples % 2 = 0 THEN '' ELSE h.title END AS title, 'RNA-Seq' AS library_strategy, 'PAIRED' AS library_layout, h.platform AS platform,
  h.bioproject AS bioproject, CASE WHEN h.samples % 5 = 0 THEN 'SAMN' || h.uid ELSE '' END AS biosample,
  h.samples AS sample_count, CAST(h.samples AS BIGINT) AS run_count, h.samples % 4 AS nruns
FROM ({HITS}) h"""
RUNS = {
    "spark": "CASE WHEN nruns = 3 THEN array('SRR' || uid, 'SRR' || CAST(CAST(FLOOR(record_ord / 6) AS BIGINT) AS STRING)) WHEN nruns = 1 THEN array('SRR' || uid) ELSE CAST(array() AS ARRAY<STRING>) END",
    "duck": "CASE WHEN nruns = 3 THEN ['SRR' || uid, 'SRR' || CAST(CAST(FLOOR(record_ord / 6) AS BIGINT) AS STRING)] WHEN nruns = 1 THEN ['SRR' || uid] ELSE []::VARCHAR[] END",
}


def studies(t):
    return t.sql(STUDIES).withColumn("run_accessions", F.expr(RUNS["spark"])).drop("nruns")


@query(
    "discover_merge_studies",
    f"""WITH s AS (SELECT *, {RUNS['duck']} AS runs, CASE WHEN accession <> '' THEN accession ELSE uid END AS k, (query_ord, record_ord) AS o FROM ({STUDIES})),
    a AS (SELECT k, arg_min(library_strategy, o) AS library_strategy, arg_min(platform, o) AS platform,
      coalesce(arg_min(organism, o) FILTER (organism <> ''), '') AS organism, coalesce(arg_min(title, o) FILTER (title <> ''), '') AS title,
      coalesce(arg_min(bioproject, o) FILTER (bioproject <> ''), '') AS bioproject, coalesce(arg_min(biosample, o) FILTER (biosample <> ''), '') AS biosample,
      coalesce(arg_min(sample_count, o) FILTER (sample_count <> 0), list(sample_count ORDER BY o DESC)[1]) AS sample_count,
      max(run_count) AS mx, COUNT(*) AS n, arg_min(runs, o) AS r1, list_sort(list_distinct(flatten(list(runs)))) AS ru FROM s GROUP BY k),
    lab AS (SELECT k, trim(regexp_replace(query, '\\s+', ' ', 'g')) AS label, min(o) AS lo FROM s GROUP BY ALL),
    mq AS (SELECT k, string_agg(label, '|' ORDER BY lo) AS matched_queries FROM lab GROUP BY k)
    SELECT k AS record_key, platform, organism, title, bioproject, biosample, sample_count,
      array_to_string(CASE WHEN n = 1 THEN r1 ELSE ru END, ',') AS runs,
      CASE WHEN len(CASE WHEN n = 1 THEN r1 ELSE ru END) > 0 THEN len(list_distinct(CASE WHEN n = 1 THEN r1 ELSE ru END)) WHEN n = 1 THEN mx ELSE nullif(mx, 0) END AS run_count,
      matched_queries FROM a JOIN mq USING (k)""",
)
def merge_studies(t):
    return di.merge_studies(studies(t)).select(
        "record_key", "platform", "organism", "title", "bioproject", "biosample", "sample_count", joined("run_accessions").alias("runs"),
        "run_count", F.array_join("matched_queries", "|").alias("matched_queries"),
    )


PROJECTS = f"""
SELECT h.query_ord, h.query, h.record_ord, h.uid,
  CASE WHEN h.samples > 37 THEN '' ELSE 'PRJNA' || CAST(CAST(FLOOR(h.record_ord / 4) AS BIGINT) AS STRING) END AS accession,
  CASE WHEN h.samples % 2 = 0 THEN '' ELSE h.title END AS title, CASE WHEN h.samples % 3 = 0 THEN '' ELSE h.accession END AS summary,
  CASE WHEN h.samples % 5 = 0 THEN '' ELSE h.taxon END AS organism, h.summary AS blob
FROM ({HITS}) h"""


def projects(t):
    return t.sql(PROJECTS).select(
        "*", tx.mine_sorted(F.col("blob"), tx.SRA_PATTERN).alias("linked_sra"), tx.mine_sorted(F.col("blob"), tx.SAMPLE_PATTERN).alias("linked_biosamples")
    ).drop("blob")


@query(
    "discover_merge_projects",
    f"""WITH s AS (SELECT *, CASE WHEN accession <> '' THEN accession ELSE uid END AS k, (query_ord, record_ord) AS o,
      list_transform(regexp_extract_all(blob, '(?i)\\bSR[APXRS]\\d+\\b'), lambda x: upper(x)) AS ls,
      list_transform(regexp_extract_all(blob, '(?i)\\bSAM[END][A-Z]?\\d+\\b'), lambda x: upper(x)) AS lb FROM ({PROJECTS}))
    SELECT k AS record_key, coalesce(arg_min(title, o) FILTER (title <> ''), '') AS title, coalesce(arg_min(summary, o) FILTER (summary <> ''), '') AS summary,
      coalesce(arg_min(organism, o) FILTER (organism <> ''), '') AS organism,
      array_to_string(list_sort(list_distinct(flatten(list(ls)))), ',') AS linked_sra, array_to_string(list_sort(list_distinct(flatten(list(lb)))), ',') AS linked_biosamples
    FROM s GROUP BY k""",
)
def merge_projects(t):
    return di.merge_projects(projects(t)).select(
        "record_key", "title", "summary", "organism", joined("linked_sra").alias("linked_sra"), joined("linked_biosamples").alias("linked_biosamples")
    )


@query(
    "discover_scalar_functions",
    f"""SELECT uid, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS label,
      array_to_string(list_transform(list_filter(list_transform(string_split(platform, ';'), lambda p: trim(p)), lambda p: p <> ''),
        lambda p: CASE WHEN regexp_full_match(p, '[0-9]+') THEN 'GPL' || p ELSE p END), '; ') AS platform,
      array_to_string({ordered_distinct("regexp_extract_all(summary, '(?i)\\bSR[APXRS]\\d+\\b')")}, ',') AS mined,
      array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(summary, '(?i)\\bSR[APXRS]\\d+\\b'), lambda x: upper(x)))), ',') AS mined_sorted,
      array_to_string(list_filter(list_transform(regexp_split_to_array(bioproject, '[;,]'), lambda p: trim(p)), lambda p: starts_with(upper(p), 'PRJ')), ',') AS split_project,
      nullif(len(list_distinct(list_transform(regexp_extract_all(summary, '(?i)\\bSRR\\d+\\b'), lambda x: upper(x)))), 0) AS runs,
      trim(regexp_extract(summary, '(?i)\\b(PRJ[EDN][A-Z]?\\d+)\\b', 1)) AS captured,
      'https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=' || accession AS link,
      array_to_string({ordered_distinct("list_filter(list_transform(regexp_split_to_array(supplemental_files, '[;,]'), lambda p: upper(trim(p))), lambda p: p <> '')")}, ',') AS formats,
      regexp_matches(summary, '(?i)\\b(?:sra|fastq|srx\\d+|srr\\d+)\\b') AS has_sra
    FROM ({RECORDS})""",
)
def scalars(t):
    return t.sql(RECORDS).select(
        "uid", tx.squeeze(F.col("title")).alias("label"), tx.platform(F.col("platform")).alias("platform"),
        joined(tx.mine(F.col("summary"), tx.SRA_PATTERN)).alias("mined"), joined(tx.mine_sorted(F.col("summary"), tx.SRA_PATTERN)).alias("mined_sorted"),
        joined(tx.split_accessions(F.col("bioproject"), ("PRJ",))).alias("split_project"), tx.count_runs(F.col("summary")).alias("runs"),
        tx.capture(F.col("summary"), r"\b(PRJ[EDN][A-Z]?\d+)\b").alias("captured"), tx.link(ev.GEO_LINK, F.col("accession")).alias("link"),
        joined(tx.file_formats(F.col("supplemental_files"))).alias("formats"), tx.has(F.col("summary"), r"\b(?:sra|fastq|srx\d+|srr\d+)\b").alias("has_sra"),
    )


@query(
    "discover_page_links",
    f"""SELECT page_id, array_to_string({ordered_distinct("regexp_extract_all(html, '(?i)\\bhref=.[a-z/]+')")}, ' ') AS links,
      lower(trim(regexp_extract(html, '(?i)<title>([^<]+)</title>', 1))) AS title FROM pages""",
)
def page_links(t):
    return t.pages.select(
        "page_id", F.array_join(tx.mine(F.col("html"), r"\bhref=.[a-z/]+"), " ").alias("links"),
        F.lower(tx.capture(F.col("html"), "<title>([^<]+)</title>")).alias("title"),
    )


@query(
    "discover_goal_keyword",
    f"""SELECT doc_id, i, CASE WHEN t = '' THEN 'general' WHEN contains(t, 'wgcna') THEN 'wgcna' WHEN contains(t, 'validation') THEN 'validation'
      WHEN contains(t, 'machine') OR contains(t, 'ml') THEN 'machine_learning' WHEN contains(t, 'deg') OR contains(t, 'differential') THEN 'differential_expression'
      ELSE replace(t, ' ', '_') END AS goal FROM (SELECT doc_id, i, lower(trim(s[i], '{tx.BLANKS}')) AS t FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, '.') AS s FROM documents)))""",
)
def goals(t):
    sentences = t.documents.select("doc_id", F.posexplode(F.split("text", r"\.")).alias("i", "s"))
    return sentences.select("doc_id", (F.col("i") + 1).cast("long").alias("i"), tx.goal(F.col("s")).alias("goal"))


@query(
    "discover_exact_accession",
    f"SELECT 'gse' || doc_id AS requested, uid FROM documents JOIN ({RECORDS}) ON lower(accession) = 'gse' || doc_id",
)
def exact(t):
    requests = t.documents.select(F.concat(F.lit("gse"), F.col("doc_id").cast("string")).alias("requested"))
    return di.exact_accession(requests, t.sql(RECORDS).select("uid", "accession")).select("requested", "uid")


# Requests ask for an order; hits are its lines, of which some name it as their experiment or run.
ANCHOR_HITS = """
SELECT 'SRX' || CAST(l_orderkey AS STRING) AS requested, l_linenumber * 1000000 + l_partkey AS record_ord,
  CASE WHEN l_returnflag = 'A' THEN '' ELSE 'SRP' || CAST(l_suppkey AS STRING) END AS study_accession, 'SRA' || CAST(l_partkey AS STRING) AS accession,
  CASE WHEN l_quantity > 40 THEN 'srx' || CAST(l_orderkey AS STRING) ELSE 'SRX0' END AS experiment_accession, CAST(NULL AS STRING) AS sample_accession,
  '' AS submitter_accession, CASE WHEN l_quantity < 5 THEN 'SRX' || CAST(l_orderkey AS STRING) ELSE 'SRR1' END AS run
FROM {lineitem}"""


@query(
    "discover_resolve_anchor",
    f"""WITH h AS (SELECT *, upper(experiment_accession) = requested OR run = requested AS m FROM ({ANCHOR_HITS})),
    b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY requested ORDER BY CASE WHEN m THEN 0 ELSE 1 END, record_ord, study_accession, accession) = 1)
    SELECT 'SRX' || o_orderkey AS requested, coalesce(nullif(study_accession, ''), nullif(accession, ''), 'SRX' || o_orderkey) AS anchor, coalesce(m, false) AS exact
    FROM orders LEFT JOIN b ON b.requested = 'SRX' || o_orderkey""",
)
def anchor(t):
    found = t.sql(ANCHOR_HITS).withColumn("run_accessions", F.array("run"))
    requests = t.orders.select(F.concat(F.lit("SRX"), F.col("o_orderkey").cast("string")).alias("requested"))
    # Equal ordinals of one request are told apart by the accessions themselves.
    ranked = found.groupBy("requested", "record_ord", "study_accession", "accession", "experiment_accession", "sample_accession", "submitter_accession", "run_accessions").count()
    keyed = ranked.withColumn("record_ord", F.struct("record_ord", "study_accession", "accession"))
    return di.resolve_anchor(requests, keyed)


BACKFILL_P = """SELECT 'PRJ' || CAST(o_orderkey AS STRING) AS accession, o_orderstatus AS st, o_custkey AS ck FROM {orders}"""
BACKFILL_S = """SELECT 'PRJ' || CAST(l_orderkey AS STRING) AS bioproject, 'SRP' || CAST(l_suppkey AS STRING) AS study_accession,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE 'SRR' || CAST(l_partkey AS STRING) END AS run FROM {lineitem}"""


@query(
    "discover_backfill_links",
    f"""SELECT accession, 'SRP' || ck AS linked, false AS backfilled FROM ({BACKFILL_P}) WHERE st = 'F'
    UNION ALL SELECT DISTINCT accession, x, true FROM (SELECT accession, unnest([study_accession, run]) AS x FROM ({BACKFILL_P}) JOIN ({BACKFILL_S}) ON bioproject = accession WHERE st <> 'F') WHERE x <> ''""",
)
def backfill(t):
    own = t.sql(BACKFILL_P).select(
        "accession", F.when(F.col("st") == "F", F.array(F.concat(F.lit("SRP"), F.col("ck").cast("string")))).otherwise(ev.empty_list()).alias("linked_sra")
    )
    return di.backfill_links(own, t.sql(BACKFILL_S).withColumn("run_accessions", F.array("run")))


# -- sample tables ---------------------------------------------------------------------------------

SAMPLES = """
SELECT 'GSE' || CAST(o_custkey AS STRING) AS accession, 'GSM' || CAST(o_orderkey AS STRING) AS sample, o_orderkey AS ord,
  o_orderstatus AS treatment, o_orderpriority AS tissue, CAST(YEAR(o_orderdate) AS STRING) AS batch, o_orderpriority AS contact_name,
  CASE WHEN o_totalprice > 400000 THEN ' ' WHEN o_totalprice > 200000 THEN 'fat' ELSE 'liver ' END AS source_name_ch1,
  CAST(o_totalprice AS STRING) AS weight, 'Sus scrofa' AS organism_ch1
FROM {orders}"""
# The price column is left out of the SQL comparison text: both engines print doubles in their own way.
SAMPLE_SQL = SAMPLES.replace("CAST(o_totalprice AS STRING) AS weight, ", "CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS STRING) AS weight, ")
LONG = f"(SELECT * FROM (UNPIVOT ({SAMPLE_SQL}) ON treatment, tissue, batch, contact_name, source_name_ch1, weight, organism_ch1 INTO NAME \"column\" VALUE \"value\"))"


def long(t):
    return di.long_samples(t.sql(SAMPLE_SQL))


@query("discover_unpivot_samples", f'SELECT accession, sample, ord, "column", "value" FROM {LONG}')
def unpivot(t):
    return long(t)


GROUPS = f"""(WITH c AS (SELECT accession, "column" AS col, trim("value") AS v, COUNT(*) AS n, min(ord) AS fo FROM {LONG}
  WHERE trim("value") <> '' AND NOT regexp_matches(lower("column"), '^(contact_|status|description|relation)') GROUP BY ALL)
  SELECT accession, col, COUNT(*) AS distinct_values, string_agg(v, '|' ORDER BY fo, v) AS vs, string_agg(n::VARCHAR, '|' ORDER BY fo, v) AS ns
  FROM c GROUP BY accession, col HAVING COUNT(*) > 1 AND COUNT(*) <= least(12, greatest(3, sum(n) - 1)))"""


@query("discover_grouping_columns", f'SELECT accession, col AS "column", distinct_values, vs AS unique_values, ns AS counts FROM {GROUPS}')
def grouping(t):
    out = di.grouping_columns(long(t))
    return out.select(
        "accession", "column", "distinct_values", F.array_join("unique_values", "|").alias("unique_values"),
        F.array_join(F.transform("unique_values", lambda v: F.element_at("counts", v).cast("string")), "|").alias("counts"),
    )


RUN_META = """
SELECT 'SRP' || CAST(o_custkey AS STRING) AS accession, 'SRR' || CAST(o_orderkey AS STRING) AS run,
  CASE WHEN o_totalprice > 300000 THEN '' ELSE o_orderstatus END AS treatment, CAST(YEAR(o_orderdate) AS STRING) AS source,
  'tissue: ' || o_orderpriority || ' || Treatment = attr ' || o_orderstatus || ' ||; age: ' || CAST(MONTH(o_orderdate) AS STRING) || ';|| sex || age:' || CAST(MONTH(o_orderdate) + 1 AS STRING) AS sample_attribute,
  CASE WHEN o_totalprice > 100000 THEN 'SAMN' || CAST(o_custkey AS STRING) || o_orderstatus ELSE ' ' END AS biosample
FROM {orders}"""
SIGNALS = f"""(WITH v AS (SELECT accession, unnest([{{'k': 'treatment', 'v': coalesce(nullif(treatment, ''), 'attr ' || o_orderstatus)}}, {{'k': 'source_name', 'v': nullif(source, '')}},
    {{'k': 'tissue', 'v': o_orderpriority}}, {{'k': 'age', 'v': mon}}]) AS e FROM (SELECT 'SRP' || o_custkey AS accession, CASE WHEN o_totalprice > 300000 THEN '' ELSE o_orderstatus END AS treatment,
    year(o_orderdate)::VARCHAR AS source, o_orderstatus, o_orderpriority, (month(o_orderdate) + 1)::VARCHAR AS mon FROM orders)),
  c AS (SELECT accession, e.k AS col, e.v AS v, COUNT(*) AS n FROM v WHERE e.v IS NOT NULL GROUP BY ALL),
  w AS (SELECT accession, col, COUNT(*) AS distinct_values FROM c GROUP BY ALL HAVING COUNT(*) >= 2),
  t AS (SELECT *, row_number() OVER (PARTITION BY accession, col ORDER BY n DESC, v) AS p FROM c QUALIFY p <= 8),
  s AS (SELECT accession, col, distinct_values, string_agg(v || '=' || n, '|' ORDER BY p) AS vals FROM t JOIN w USING (accession, col) GROUP BY ALL)
  SELECT *, row_number() OVER (PARTITION BY accession ORDER BY CASE col WHEN 'treatment' THEN 3 WHEN 'source_name' THEN 8 WHEN 'tissue' THEN 11 WHEN 'age' THEN 14 END, col) AS pos FROM s)"""


@query("discover_design_signals", f'SELECT accession, col AS "column", distinct_values, vals AS "values", pos AS position FROM {SIGNALS}')
def signals(t):
    out = di.design_signals(t.sql(RUN_META))
    shown = F.array_join(F.transform("values", lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), "|")
    return out.select("accession", "column", "distinct_values", shown.alias("values"), "position")


@query(
    "discover_sample_attributes",
    """SELECT 'SRR' || o_orderkey AS run, o_orderpriority AS tissue, 'attr ' || o_orderstatus AS treatment, (month(o_orderdate) + 1)::VARCHAR AS age, 3::BIGINT AS n FROM orders""",
)
def attributes(t):
    m = tx.sample_attributes(F.col("sample_attribute"))
    return t.sql(RUN_META).select("run", *[F.element_at(m, k).alias(k) for k in ("tissue", "treatment", "age")], F.size(m).cast("long").alias("n"))


@query(
    "discover_sample_counts",
    f"""SELECT r.accession, coalesce(n, samples)::BIGINT AS sample_count, CASE WHEN n IS NOT NULL THEN 'verified_from_gsms' WHEN samples IS NOT NULL THEN 'series_summary_only' ELSE 'unavailable' END AS sample_count_status
    FROM ({RECORDS}) r LEFT JOIN (SELECT 'GSE' || o_custkey AS accession, COUNT(DISTINCT o_orderkey) AS n FROM orders GROUP BY o_custkey) USING (accession)""",
)
def counts(t):
    return di.sample_counts(t.sql(RECORDS), t.sql(SAMPLES))


@query(
    "discover_run_counts",
    """SELECT 'SRP' || o_custkey AS accession, COUNT(*) AS run_count, nullif(COUNT(DISTINCT CASE WHEN o_totalprice > 100000 THEN o_orderstatus END), 0) AS sample_count FROM orders GROUP BY o_custkey""",
)
def run_counts(t):
    return di.run_counts(t.sql(RUN_META)).select("accession", "run_count", "sample_count")


@query(
    "discover_tissue_summary",
    f"""WITH c AS (SELECT accession, trim("value") AS v, min(ord) AS fo FROM {LONG} WHERE "column" = 'tissue' AND trim("value") <> '' GROUP BY ALL)
    SELECT accession, string_agg(v, '|' ORDER BY fo, v) AS "values" FROM c GROUP BY accession""",
)
def tissues(t):
    return di.tissue_summary(long(t)).select("accession", F.array_join("values", "|").alias("values"))


@query(
    "discover_tissue_fallback",
    f"""WITH c AS (SELECT accession, trim("value") AS v, min(ord) AS fo FROM {LONG} WHERE "column" = 'source_name_ch1' AND trim("value") <> '' GROUP BY ALL)
    SELECT accession, string_agg(v, '|' ORDER BY fo, v) AS "values" FROM c GROUP BY accession""",
)
def tissue_fallback(t):
    return di.tissue_summary(di.long_samples(t.sql(SAMPLE_SQL).drop("tissue"))).select("accession", F.array_join("values", "|").alias("values"))


@query(
    "discover_first_usable",
    f"""SELECT accession, coalesce(arg_min(title, o) FILTER (trim(title) <> ''), '') AS title, coalesce(arg_min(bioproject, o) FILTER (bioproject <> ''), '') AS bioproject
    FROM (SELECT *, (query_ord, record_ord) AS o FROM ({STUDIES})) GROUP BY accession""",
)
def first_usable(t):
    return di.first_usable(t.sql(STUDIES).withColumn("record_ord", F.struct("query_ord", "record_ord")), "accession", ["title", "bioproject"])


@query("discover_distinct_runs", f"SELECT DISTINCT accession, unnest({RUNS['duck']}) AS run FROM ({STUDIES})")
def distinct_runs(t):
    return di.distinct_runs(studies(t))


@query(
    "discover_metadata_union",
    """SELECT 'SRP' || o_custkey AS accession, 'SRR' || o_orderkey AS run, o_orderstatus AS treatment, NULL::VARCHAR AS platform FROM orders
    UNION ALL SELECT 'SRP' || l_suppkey, 'SRR' || l_partkey, NULL, l_returnflag FROM lineitem""",
)
def metadata_union(t):
    first = t.sql("SELECT 'SRP' || CAST(o_custkey AS STRING) AS accession, 'SRR' || CAST(o_orderkey AS STRING) AS run, o_orderstatus AS treatment FROM {orders}")
    second = t.sql("SELECT 'SRP' || CAST(l_suppkey AS STRING) AS accession, 'SRR' || CAST(l_partkey AS STRING) AS run, l_returnflag AS platform FROM {lineitem}")
    return di.metadata_union(first, second)


# -- rules -----------------------------------------------------------------------------------------

RULE_BASE = f"""(SELECT r.*, coalesce(g.cols, []) AS cols, coalesce(o.tis, 0) AS tis, coalesce(n, samples) AS sc,
  lower(concat_ws(' ', gds_type, title, summary)) AS hay FROM ({RECORDS}) r
  LEFT JOIN (SELECT accession, list(col) AS cols FROM {GROUPS} GROUP BY accession) g USING (accession)
  LEFT JOIN (SELECT 'GSE' || o_custkey AS accession, COUNT(DISTINCT o_orderpriority) AS tis, COUNT(DISTINCT o_orderkey) AS n FROM orders GROUP BY o_custkey) o USING (accession))"""
FAMILY = """CASE WHEN regexp_matches(hay, 'single cell|single-cell|single nucleus') THEN 'single_cell_rna_seq' WHEN regexp_matches(hay, 'non-coding rna|small rna|mirna') THEN 'non_coding_rna_seq'
  WHEN regexp_matches(hay, 'high throughput sequencing|rna-seq|rnaseq') THEN 'bulk_rna_seq' WHEN contains(hay, 'array') THEN 'microarray' ELSE 'unknown' END"""
CLARITY = """CASE WHEN len(cols) = 0 THEN 'low' WHEN len(list_filter(cols, lambda c: regexp_matches(lower(c), 'treatment|condition|group|phenotype|disease|genotype'))) > 0 THEN 'high' ELSE 'partial' END"""
GOAL = "CASE WHEN lang_taxon = 'Homo sapiens' THEN 'wgcna' WHEN lang_taxon = 'Sus scrofa' THEN 'validation' WHEN contains(lang_taxon, 'Mus') THEN 'differential_expression' ELSE 'machine_learning' END"
RISKS = sorted_flags(
    ("contains(ts, 'across species') OR contains(ts, 'bodymap')", "multi_species_series"), ("contains(ts, 'multiomic')", "multiomic_series"),
    ("contains(ts, 'superseries')", "superseries"), ("regexp_matches(taxon, '[;,]')", "multiple_organisms"), ("tis > 2", "multiple_tissues"), ("len(cols) > 8", "many_grouping_dimensions"),
)
RULED = f"""(SELECT *, {FAMILY} AS family, {CLARITY} AS clarity, {RISKS} AS risks, {GOAL.replace('lang_taxon', 'taxon')} AS goal
  FROM (SELECT *, lower(concat_ws(' ', title, summary)) AS ts FROM {RULE_BASE}))"""


def inspected(t):
    """All series inspected in one pass: record, sample-table signals, availability, fit and verdict."""
    records = t.sql(RECORDS)
    samples = long(t)
    groups = di.grouping_columns(samples)
    signals = groups.groupBy("accession").agg(
        F.array_sort(F.collect_list(F.struct("distinct_values", "column", F.map_entries("counts").alias("counts")))).alias("_g")
    )
    tissue = di.tissue_summary(samples).select("accession", F.col("values").alias("tissues"))
    out = records.join(signals, "accession", "left").join(tissue, "accession", "left").join(di.sample_counts(records, samples.select("accession", "sample")), "accession")
    out = out.withColumn("organisms", tx.non_empty(F.split("taxon", "[;,]"))).withColumn("tissues", F.coalesce("tissues", ev.empty_list()))
    cols = F.coalesce(F.transform("_g", lambda g: g["column"]), ev.empty_list())
    out = out.withColumn("group_columns", cols).withColumn(
        "group_signals", F.slice(F.transform("_g", lambda g: F.struct(g["column"].alias("column"), F.map_from_entries(g["counts"]).alias("counts"))), 1, 8)
    )
    goal = (
        F.when(F.col("taxon") == "Homo sapiens", "wgcna").when(F.col("taxon") == "Sus scrofa", "validation")
        .when(F.col("taxon").contains("Mus"), "differential_expression").otherwise("machine_learning")
    )
    out = out.withColumn("goal", goal).withColumn("assay_family", rules.assay_family(F.col("gds_type"), F.col("title"), F.col("summary")))
    out = out.withColumn("design_clarity", rules.design_clarity(F.col("group_columns"))).withColumn(
        "risks", rules.series_risks(F.col("title"), F.col("summary"), F.size("organisms"), F.size("tissues"), F.size("group_columns"))
    )
    text = F.lower(tx.join_parts(F.col("summary"), F.col("title")))
    out = out.withColumn("availability", rules.data_availability(tx.file_formats(F.col("supplemental_files")), text, F.col("assay_family")))
    out = out.withColumn("fit", rules.series_fit(F.col("goal"), F.col("assay_family"), F.col("sample_count"), F.col("design_clarity"), F.col("risks")))
    return out.withColumn("overall_usability", rules.usability(F.col("fit"), F.col("risks"), F.col("design_clarity"), F.col("goal")))


@query("discover_series_rules", f"SELECT uid, family AS assay_family, clarity AS design_clarity, risks, goal FROM {RULED}")
def series_rules(t):
    return inspected(t).select("uid", "assay_family", "design_clarity", joined("risks", True).alias("risks"), "goal")


FIT = f"""(SELECT *, coalesce(sc >= 15, false) AND clarity <> 'low' AND NOT contains(risks, 'multiple_tissues') AS net, coalesce(sc >= 6, false) AND clarity <> 'low' AS val,
  coalesce(sc >= 30, false) AND clarity = 'high' AS ml, contains(risks, 'multiple_organisms') OR contains(risks, 'multi_species') AS sp FROM {RULED})"""
USABLE = sorted_flags(("family IN ('bulk_rna_seq', 'microarray')", "differential_expression"), ("family = 'microarray' OR val", "validation"), ("net", "wgcna"), ("ml", "machine_learning_exploration"))
NOT_REC = sorted_flags(
    ("family = 'single_cell_rna_seq'", "bulk_differential_expression"), ("family = 'non_coding_rna_seq'", "bulk_mrna_workflows"), ("clarity = 'low'", "differential_expression"),
    ("clarity = 'low' OR sp", "validation"), ("contains(risks, 'multiple_tissues') OR sp", "simple_case_control"), ("contains(risks, 'multiple_tissues')", "whole_series_wgcna"),
    ("contains(risks, 'superseries')", "whole_series_interpretation"), ("NOT net OR family = 'single_cell_rna_seq'", "wgcna"), ("NOT ml", "machine_learning"),
)
WHY = sorted_flags(
    ("sc IS NULL", "sample_count_unverified"), ("sc < 3", "extremely_small_sample_count"), ("sc >= 3 AND sc < 6", "small_sample_count"), ("family = 'single_cell_rna_seq'", "single_cell_data"),
    ("family = 'non_coding_rna_seq'", "non_coding_assay_family"), ("clarity = 'high'", "clear_group_structure"), ("clarity = 'partial'", "partially_clear_group_structure"),
    ("clarity = 'low'", "unclear_group_structure"), ("contains(risks, 'multiple_tissues')", "mixed_tissue_risk"), ("sp", "multi_species_risk"), ("contains(risks, 'superseries')", "superseries_requires_subseries_check"),
    ("NOT val AND goal = 'validation'", "weak_validation_candidate"), ("goal = 'differential_expression' AND family NOT IN ('bulk_rna_seq', 'microarray')", "requested_deg_but_design_is_weak"),
    ("goal = 'wgcna' AND NOT net", "requested_wgcna_but_sample_size_or_design_is_weak"),
)


@query(
    "discover_series_fit",
    f"""WITH f AS (SELECT *, {USABLE} AS us, {NOT_REC} AS nr, {WHY} AS why FROM {FIT}),
    g AS (SELECT *, CASE WHEN goal = 'machine_learning' THEN 'machine_learning_exploration' ELSE goal END AS want FROM f)
    SELECT uid, sc AS sample_count, us AS usable_for, nr AS not_recommended_for, why AS rationale, CASE WHEN us = '' THEN 'low'
      WHEN NOT list_contains(string_split(us, ','), want) THEN CASE WHEN clarity <> 'low' THEN 'medium' ELSE 'low' END
      WHEN clarity = 'high' AND (CASE WHEN risks = '' THEN 0 ELSE len(string_split(risks, ',')) END) <= 1 THEN 'high'
      WHEN len(string_split(nr, ',')) >= 3 OR contains(risks, 'multiple_organisms') THEN 'low' ELSE 'medium' END AS verdict FROM g""",
)
def series_fit(t):
    return inspected(t).select(
        "uid", "sample_count", joined("fit.usable_for", True).alias("usable_for"), joined("fit.not_recommended_for", True).alias("not_recommended_for"),
        joined("fit.rationale", True).alias("rationale"), F.col("overall_usability").alias("verdict"),
    )


@query(
    "discover_data_availability",
    f"""WITH r AS (SELECT *, {FAMILY} AS family, lower(concat_ws(' ', summary, title)) AS ct, list_transform(regexp_split_to_array(supplemental_files, '[;,]'), lambda p: upper(trim(p))) AS fm FROM (SELECT *, lower(concat_ws(' ', gds_type, title, summary)) AS hay FROM ({RECORDS}))),
    c AS (SELECT *, list_has_any(fm, ['TXT', 'TSV', 'CSV', 'TAB', 'XLSX', 'MTX', 'H5']) AS pm, list_has_any(fm, ['CEL']) AS cel,
      family IN ('bulk_rna_seq', 'single_cell_rna_seq') AND (regexp_matches(ct, '\\b(?:raw counts?|counts? matrix|gene counts?)\\b') OR list_has_any(fm, ['MTX'])) AS rc FROM r)
    SELECT uid, family AS assay_family, pm AS processed, cel AS microarray_raw, regexp_matches(ct, '\\b(?:sra|fastq|srx\\d+|srr\\d+)\\b') AS sequencing_raw, rc AS raw_counts,
      regexp_matches(ct, '\\b(?:normalized|fpkm|tpm|rpkm|log2|expression matrix)\\b') AS normalized,
      CASE WHEN family = 'microarray' AND cel THEN 'microarray_raw_plus_processed_possible' WHEN family = 'microarray' AND pm THEN 'processed_microarray_matrix_likely'
        WHEN rc THEN 'raw_counts_likely' WHEN family IN ('bulk_rna_seq', 'single_cell_rna_seq') AND pm THEN 'processed_matrix_likely'
        WHEN family = 'non_coding_rna_seq' AND pm THEN 'processed_non_coding_matrix_likely' ELSE 'unknown' END AS matrix_guess FROM c""",
)
def availability(t):
    out = t.sql(RECORDS).withColumn("assay_family", rules.assay_family(F.col("gds_type"), F.col("title"), F.col("summary")))
    a = rules.data_availability(tx.file_formats(F.col("supplemental_files")), F.lower(tx.join_parts(F.col("summary"), F.col("title"))), F.col("assay_family"))
    return out.withColumn("a", a).select(
        "uid", "assay_family", F.col("a.processed_matrix_clues").alias("processed"), F.col("a.microarray_raw_clues").alias("microarray_raw"),
        F.col("a.sequencing_raw_clues").alias("sequencing_raw"), F.col("a.likely_raw_counts").alias("raw_counts"),
        F.col("a.normalized_expression_clues").alias("normalized"), F.col("a.matrix_guess").alias("matrix_guess"),
    )


@query(
    "discover_title_tissue",
    """SELECT doc_id, CASE WHEN contains(h, 'abdominal fat') THEN 'abdominal fat' WHEN contains(h, 'adipose') THEN 'adipose' WHEN contains(h, 'cartilage') THEN 'cartilage' WHEN contains(h, 'islet') THEN 'islet' END AS tissue
    FROM (SELECT doc_id, lower(replace(replace(text, 'the ', 'Islet '), 'der ', 'ADIPOSE ') || ' ' || lang) AS h FROM documents)""",
)
def title_tissue(t):
    text = F.replace(F.replace("text", F.lit("the "), F.lit("Islet ")), F.lit("der "), F.lit("ADIPOSE "))
    return t.documents.select("doc_id", rules.title_tissue(text, F.col("lang")).alias("tissue"))


# A study is an order, its records are the lines.
STUDY_STATS = """
SELECT l_orderkey, COUNT(DISTINCT l_returnflag) AS organisms, COUNT(DISTINCT l_linestatus) AS strategies, COUNT(DISTINCT CASE WHEN l_tax > 0.04 THEN 'a' ELSE 'b' END) AS layouts,
  COUNT(DISTINCT l_linenumber) AS platforms, SUM(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS runs, SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS titles,
  COUNT(*) AS samples, CASE WHEN MIN(l_suppkey) < 30 THEN 'wgcna' WHEN MIN(l_suppkey) < 60 THEN 'differential_expression' ELSE 'validation' END AS goal,
  CASE WHEN MAX(l_suppkey) > 80 THEN 'RNA-Seq' ELSE 'WGS' END AS family FROM {lineitem} GROUP BY l_orderkey"""
STUDY_RISK = sorted_flags(
    ("organisms > 1", "multiple_organisms"), ("strategies > 1", "mixed_library_strategies"), ("layouts > 1", "mixed_library_layouts"), ("platforms > 1", "mixed_platforms"),
    ("runs = 0", "run_accessions_unclear"), ("organisms = 0", "organism_metadata_sparse"), ("titles = 0", "title_metadata_sparse"),
)


@query(
    "discover_study_fit",
    f"""SELECT l_orderkey, {STUDY_RISK} AS risks,
      {sorted_flags(("family = 'RNA-Seq'", 'raw_rnaseq_follow_up'), ("goal = 'differential_expression' AND samples >= 6", 'differential_expression'), ("goal = 'wgcna' AND samples >= 15", 'wgcna'), ("goal = 'validation'", 'raw_data_validation_candidate'))} AS usable_for,
      {sorted_flags(("goal = 'differential_expression' AND samples < 6", 'differential_expression'), ("goal = 'wgcna' AND samples < 15", 'wgcna'))} AS not_recommended_for,
      {sorted_flags(("family <> 'RNA-Seq'", 'assay_family_not_rnaseq'), ("goal = 'differential_expression' AND samples < 6", 'sample_support_small_for_deg'), ("goal = 'wgcna' AND samples < 15", 'sample_support_small_for_wgcna'), ("organisms > 1 OR strategies > 1", 'cross_sample_heterogeneity_detected'))} AS rationale,
      CASE WHEN organisms > 1 OR strategies > 1 OR (goal = 'wgcna' AND samples < 15) THEN 'low' WHEN goal = 'differential_expression' AND samples >= 6 THEN 'high' ELSE 'medium' END AS overall
    FROM ({STUDY_STATS})""",
)
def study_fit(t):
    # Sets of a study's few values; counts of distinct values would move every row once for each of them.
    s = t.sql(re.sub(r"COUNT\(DISTINCT (.+?)\) AS", r"CAST(size(collect_set(\1)) AS BIGINT) AS", STUDY_STATS)).withColumn("risks", rules.study_risks(*[F.col(c) for c in ("organisms", "strategies", "layouts", "platforms", "runs", "titles")]))
    s = s.withColumn("fit", rules.study_fit(F.col("goal"), F.col("family"), F.col("samples"), F.col("risks")))
    return s.select(
        "l_orderkey", joined("risks", True).alias("risks"), *[joined(f"fit.{c}", True).alias(c) for c in ("usable_for", "not_recommended_for", "rationale")], F.col("fit.overall").alias("overall")
    )


PROJECT_STATS = """SELECT c_custkey, COUNT(o_orderkey) AS linked, COUNT(DISTINCT CASE WHEN o_totalprice > 300000 THEN o_orderkey END) AS bios, 1 AS records,
  CASE WHEN MIN(c_nationkey) < 10 THEN 'wgcna' ELSE 'general' END AS goal FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey"""


@query(
    "discover_project_fit",
    f"""SELECT c_custkey, {sorted_flags(('linked > 20', 'broad_project_scope'), ('linked = 0', 'linked_sra_unclear'), ('bios = 0', 'linked_biosamples_unclear'))} AS risks,
      {sorted_flags(('true', 'project_context'), ('linked > 0', 'sra_follow_up'))} AS usable_for, CASE WHEN goal = 'wgcna' THEN 'wgcna_direct_use' ELSE '' END AS not_recommended_for,
      {sorted_flags(('linked > 20', 'project_may_be_too_broad_for_direct_shortlist_use'), ("goal = 'wgcna'", 'bioproject_is_context_not_expression_matrix'))} AS rationale,
      CASE WHEN linked = 0 OR linked > 20 THEN 'low' ELSE 'medium' END AS overall FROM ({PROJECT_STATS})""",
)
def project_fit(t):
    s = t.sql(PROJECT_STATS).withColumn("risks", rules.project_risks(F.col("records"), F.col("linked"), F.col("bios")))
    s = s.withColumn("fit", rules.project_fit(F.col("goal"), F.col("linked"), F.col("risks")))
    return s.select(
        "c_custkey", joined("risks", True).alias("risks"), *[joined(f"fit.{c}", True).alias(c) for c in ("usable_for", "not_recommended_for", "rationale")], F.col("fit.overall").alias("overall")
    )


# -- evidence --------------------------------------------------------------------------------------


def flat(df):
    """Evidence as plain columns for comparison."""
    return df.select(
        "source", "accession", "source_type", "title", joined("organisms").alias("organisms"), "assay_family", "sample_count", "run_count",
        joined("linked_accessions.geo").alias("geo"), joined("linked_accessions.sra").alias("sra"), joined("linked_accessions.bioproject").alias("bioproject"),
        joined("linked_accessions.biosample").alias("biosample"), joined("risks", True).alias("risks"),
    )


CTX = "concat_ws(' ', nullif(bioproject, ''), nullif(supplemental_files, ''), nullif(summary, ''), nullif(title, ''))"
PRJ = ordered_distinct(
    "list_concat(list_filter(list_transform(regexp_split_to_array(bioproject, '[;,]'), lambda p: trim(p)), lambda p: starts_with(upper(p), 'PRJ')), regexp_extract_all(ctx, '(?i)\\bPRJ[EDN][A-Z]?\\d+\\b'))"
)
SERIES_SQL = f"""SELECT 'GEO' AS source, accession, CASE WHEN accession LIKE 'GSE%' THEN 'series' ELSE 'record' END AS source_type, title, taxon AS organisms, '' AS assay_family, samples AS sample_count,
  NULL::BIGINT AS run_count, accession AS geo, array_to_string({ordered_distinct("regexp_extract_all(ctx, '(?i)\\bSR[APXRS]\\d+\\b')")}, ',') AS sra, array_to_string({PRJ}, ',') AS bioproject,
  array_to_string({ordered_distinct("regexp_extract_all(ctx, '(?i)\\bSAM[END][A-Z]?\\d+\\b')")}, ',') AS biosample, '' AS risks FROM (SELECT *, {CTX} AS ctx FROM ({RECORDS}))"""
STUDY_CAND = """SELECT 'SRP' || CAST(o_orderkey AS STRING) AS accession, 'study' AS source_type, 'Study of GSE' || CAST(o_custkey AS STRING) AS title, o_orderstatus AS organism, 'RNA-Seq' AS library_strategy,
  'PAIRED' AS library_layout, 'X' AS platform, CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_custkey END AS sample_count, CASE WHEN o_totalprice > 200000 THEN o_custkey END AS run_count,
  'PRJNA' || CAST(o_custkey AS STRING) AS bioproject, CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'SAMN' || CAST(o_custkey AS STRING) END AS biosample, 'SRX' || CAST(o_custkey AS STRING) AS experiment_accession FROM {orders}"""
STUDY_SQL = f"""SELECT 'SRA' AS source, accession, source_type, title, organism AS organisms, library_strategy AS assay_family, sample_count, run_count,
  regexp_extract(title, 'GSE\\d+') AS geo, accession || ',' || experiment_accession AS sra, bioproject, biosample, '' AS risks FROM ({STUDY_CAND})"""
PROJECT_CAND = """SELECT 'PRJNA' || CAST(c_custkey AS STRING) AS accession, c_name AS title, c_mktsegment AS summary, c_mktsegment AS organism, c_nationkey AS k FROM {customer}"""
PROJECT_SQL = f"""SELECT 'BioProject' AS source, accession, 'project' AS source_type, title, organism AS organisms, '' AS assay_family, NULL::BIGINT AS sample_count, NULL::BIGINT AS run_count, '' AS geo,
  'SRP' || k AS sra, accession AS bioproject, '' AS biosample, '' AS risks FROM ({PROJECT_CAND})"""


@query("discover_candidate_evidence", f"{SERIES_SQL} UNION ALL {STUDY_SQL} UNION ALL {PROJECT_SQL}")
def candidates(t):
    projects = t.sql(PROJECT_CAND).withColumn("linked_sra", F.array(F.concat(F.lit("SRP"), F.col("k").cast("string")))).withColumn("linked_biosamples", ev.empty_list())
    return flat(ev.series_candidates(t.sql(RECORDS)).unionByName(ev.study_candidates(t.sql(STUDY_CAND))).unionByName(ev.project_candidates(projects)))


@query(
    "discover_inspection_evidence",
    f"""SELECT 'GEO' AS source, r.accession, CASE WHEN r.accession LIKE 'GSE%' THEN 'series' ELSE 'record' END AS source_type, title, replace(replace(taxon, '; ', ','), ', ', ',') AS organisms,
      family AS assay_family, sc AS sample_count, NULL::BIGINT AS run_count, s.geo, s.sra, s.bioproject, s.biosample, r.risks FROM {RULED} r JOIN (SELECT accession, geo, sra, bioproject, biosample FROM ({SERIES_SQL})) s USING (accession)""",
)
def inspections(t):
    found = flat(ev.series_inspections(inspected(t)))
    return ev.bundle(flat(ev.series_candidates(t.sql(RECORDS))), found)
