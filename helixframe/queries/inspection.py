"""Inspection of studies and projects: a customer is a request, its orders are the hits."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import inspect as ins
from helixframe.plans import evidence as ev
from helixframe.queries.discovery import RUN_META, SIGNALS, flat, joined, ordered_distinct, sorted_flags
from helixframe.queries.registry import query

GOAL = "CASE c_nationkey % 4 WHEN 0 THEN 'differential_expression' WHEN 1 THEN 'wgcna' WHEN 2 THEN 'validation' ELSE 'general' END AS goal"
STUDY_REQUESTS = f"SELECT 'SRP' || CAST(c_custkey AS STRING) AS requested, {GOAL} FROM {{customer}}"
# Some hits name the next customer's study, some none; every fourth customer has no samples, every fifth no runs.
STUDY_HITS = """
SELECT 'SRP' || CAST(o_custkey AS STRING) AS requested, o_orderkey AS record_ord, 'SRX' || CAST(o_orderkey AS STRING) AS accession,
  CASE WHEN o_orderpriority LIKE '1%' OR o_custkey % 7 = 0 THEN 'SRP' || CAST(o_custkey + 1 AS STRING) WHEN o_orderpriority LIKE '2%' THEN '' ELSE 'SRP' || CAST(o_custkey AS STRING) END AS study_accession,
  '' AS experiment_accession, 'SRS' || CAST(o_orderkey % 7 AS STRING) AS sample_accession, CAST(NULL AS STRING) AS submitter_accession, '' AS source_type,
  CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE 'Adipose ' || o_orderpriority END AS title, CASE WHEN o_totalprice > 200000 THEN 'Abdominal fat' ELSE '' END AS summary,
  CASE o_orderstatus WHEN 'F' THEN 'Sus scrofa' WHEN 'O' THEN 'Bos taurus ' ELSE '' END AS organism,
  CASE WHEN o_totalprice > 300000 THEN 'WGS' ELSE 'RNA-Seq' END AS library_strategy, 'PAIRED' AS library_layout, CASE WHEN o_orderkey % 2 = 0 THEN 'ILLUMINA' ELSE '' END AS platform,
  CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'SAMN' || CAST(o_orderkey % 50 AS STRING) END AS biosample,
  CASE WHEN o_orderpriority LIKE '3%' THEN 'PRJNA' || CAST(o_custkey AS STRING) ELSE '' END AS bioproject,
  CASE WHEN o_custkey % 5 = 0 THEN '' ELSE 'SRR' || CAST(o_orderkey AS STRING) END AS run_name
FROM {orders}"""
PROJECT_REQUESTS = f"SELECT 'PRJNA' || CAST(c_custkey AS STRING) AS requested, {GOAL} FROM {{customer}}"
PROJECT_HITS = """
SELECT 'PRJNA' || CAST(o_custkey AS STRING) AS requested, o_orderkey AS record_ord,
  CASE WHEN o_orderpriority LIKE '1%' OR o_custkey % 7 = 0 THEN 'PRJNA' || CAST(o_custkey + 1 AS STRING) ELSE 'prjna' || CAST(o_custkey AS STRING) END AS accession,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Islet ' || o_orderpriority END AS title, CASE WHEN o_totalprice > 200000 THEN 'Cartilage' ELSE '' END AS summary,
  CASE o_orderstatus WHEN 'F' THEN 'Sus scrofa' ELSE '' END AS organism,
  CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'SRR' || CAST(o_orderkey AS STRING) END AS sra, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'SAMN' || CAST(o_orderkey AS STRING) END AS sample_name
FROM {orders}"""


def listed(value: str) -> str:
    return f"coalesce(list(trim({value}) ORDER BY record_ord) FILTER (trim({value}) <> ''), []::VARCHAR[])"


def lists(names: dict[str, str]) -> tuple[str, str]:
    """SQL of the raw lists (inner) and of their distinct values in order (outer), by name."""
    return ", ".join(f"{listed(v)} AS {n}" for n, v in names.items()), ", ".join(f"{ordered_distinct(n)} AS {n}" for n in names)


TISSUE = "CASE " + " ".join(f"WHEN contains(lower(title || ' ' || summary), '{w}') THEN '{w}'" for w in ("abdominal fat", "adipose", "cartilage", "islet")) + " ELSE '' END"
NAMES = ("title", "organism", "library_strategy", "library_layout", "platform", "biosample", "bioproject", "summary", "run_name", "accession", "study_accession", "sample_accession")


def study_sql() -> str:
    raw, distinct = lists({f"{c}_l": c for c in NAMES} | {"tissues": TISSUE})
    return f"""rq AS ({STUDY_REQUESTS}), h AS (SELECT *, [accession, study_accession, sample_accession, run_name] AS ids FROM ({STUDY_HITS})),
    best AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY requested ORDER BY CASE WHEN list_contains(ids, requested) THEN 0 ELSE 1 END, record_ord) = 1),
    an AS (SELECT rq.requested, goal, coalesce(nullif(study_accession, ''), nullif(accession, ''), rq.requested) AS anchor FROM rq LEFT JOIN best USING (requested)),
    po AS (SELECT an.requested, goal, anchor, 0 AS pool, h.* EXCLUDE (requested) FROM an JOIN h USING (requested)
      UNION ALL SELECT an.requested, goal, anchor, 1 AS pool, h.* EXCLUDE (requested) FROM an JOIN h ON h.requested = an.anchor WHERE an.anchor <> an.requested),
    st AS (SELECT requested, max(pool) AS b, max(pool) FILTER (list_contains(ids, anchor)) AS f FROM po GROUP BY ALL),
    kp AS (SELECT po.* FROM po JOIN st USING (requested) WHERE CASE WHEN coalesce(f = b, false) THEN pool = b AND list_contains(ids, anchor) ELSE pool = 0 END),
    g0 AS (SELECT requested, anchor, goal, COUNT(*) AS record_count, {raw} FROM kp GROUP BY requested, anchor, goal),
    g AS (SELECT requested, anchor, goal, record_count, {distinct} FROM g0),
    md AS (SELECT accession AS anchor, COUNT(*) AS metadata_rows, nullif(COUNT(DISTINCT nullif(trim(biosample), '')), 0) AS ms, nullif(COUNT(DISTINCT run), 0) AS mr FROM ({RUN_META}) GROUP BY ALL),
    sg AS (SELECT accession AS anchor, list(col) AS keys FROM {SIGNALS} GROUP BY ALL),
    v AS (SELECT *, coalesce(nullif(len(biosample_l), 0), ms) AS sample_count, coalesce(nullif(len(run_name_l), 0), mr) AS run_count, array_to_string(library_strategy_l, '; ') AS family,
      len(organism_l) > 1 OR len(library_strategy_l) > 1 AS mixed,
      CASE WHEN keys IS NULL THEN 'low' WHEN list_contains(keys, 'treatment') THEN 'high' ELSE 'partial' END AS design_clarity,
      {ordered_distinct("(accession_l || study_accession_l || sample_accession_l || run_name_l)")} AS sra
      FROM g LEFT JOIN md USING (anchor) LEFT JOIN sg USING (anchor)),
    w AS (SELECT *, coalesce(title_l[1], '') AS title, coalesce(bioproject_l[1], '') AS bioproject, coalesce(sample_count >= 6, false) AS six, coalesce(sample_count >= 15, false) AS fifteen,
      {sorted_flags(("len(organism_l) > 1", 'multiple_organisms'), ("len(library_strategy_l) > 1", 'mixed_library_strategies'), ("len(library_layout_l) > 1", 'mixed_library_layouts'), ("len(platform_l) > 1", 'mixed_platforms'),
      ("len(run_name_l) = 0", 'run_accessions_unclear'), ("len(organism_l) = 0", 'organism_metadata_sparse'), ("len(title_l) = 0", 'title_metadata_sparse'))} AS risks FROM v)"""


def study(t):
    hits = t.sql(STUDY_HITS)
    hits = hits.withColumn("run_accessions", F.when(F.col("run_name") != "", F.array("run_name")).otherwise(ev.empty_list())).drop("run_name")
    return ins.study_inspection(t.sql(STUDY_REQUESTS), hits, t.sql(RUN_META))


@query(
    "discover_study_inspection",
    f"""WITH {study_sql()} SELECT requested, anchor AS accession, title, array_to_string(organism_l, ',') AS organisms, array_to_string(tissues, ',') AS tissues, family AS assay_family,
      sample_count, run_count, bioproject, array_to_string(sra, ',') AS linked_sra, risks, design_clarity, record_count, coalesce(metadata_rows, 0) AS metadata_rows, coalesce(len(keys), 0)::INT AS signals,
      {sorted_flags(("family = 'RNA-Seq'", 'raw_rnaseq_follow_up'), ("goal = 'differential_expression' AND six", 'differential_expression'), ("goal = 'wgcna' AND fifteen", 'wgcna'), ("goal = 'validation'", 'raw_data_validation_candidate'))} AS usable_for,
      {sorted_flags(("goal = 'differential_expression' AND NOT six", 'differential_expression'), ("goal = 'wgcna' AND NOT fifteen", 'wgcna'))} AS not_recommended_for,
      CASE WHEN mixed OR (goal = 'wgcna' AND NOT fifteen) THEN 'low' WHEN goal = 'differential_expression' AND six THEN 'high' ELSE 'medium' END AS overall FROM w""",
)
def study_inspection(t):
    return study(t).select(
        "requested", "accession", "title", joined("organisms").alias("organisms"), joined("tissues").alias("tissues"), "assay_family", "sample_count", "run_count", "bioproject",
        joined("linked_sra").alias("linked_sra"), joined("risks", True).alias("risks"), "design_clarity", "record_count", "metadata_rows", F.size("group_signals").alias("signals"),
        joined("fit.usable_for", True).alias("usable_for"), joined("fit.not_recommended_for", True).alias("not_recommended_for"), F.col("fit.overall").alias("overall"),
    )


PROJECT_LISTS = lists({f"{c}_l": c for c in ("title", "summary", "organism", "sra", "sample_name")} | {"tissues": TISSUE})
FILL_LISTS = lists({f"f_{c}": c for c in ("accession", "study_accession", "sample_accession", "run_name", "biosample", "organism")})


def project_sql() -> str:
    return f"""rq AS ({PROJECT_REQUESTS}), h AS (SELECT *, upper(accession) = upper(requested) AS ex FROM ({PROJECT_HITS})),
    kp AS (SELECT * FROM h QUALIFY ex OR NOT bool_or(ex) OVER (PARTITION BY requested)),
    g AS (SELECT requested, goal, record_count, {PROJECT_LISTS[1]} FROM (SELECT requested, goal, COUNT(*) AS record_count, {PROJECT_LISTS[0]} FROM kp JOIN rq USING (requested) GROUP BY requested, goal)),
    fl AS (SELECT requested, n, {FILL_LISTS[1]} FROM (SELECT bioproject AS requested, COUNT(*) AS n, {FILL_LISTS[0]} FROM ({STUDY_HITS}) GROUP BY bioproject)),
    v AS (SELECT g.*, CASE WHEN len(sra_l) = 0 THEN coalesce(n, 0) ELSE 0 END AS backfilled,
      CASE WHEN len(sra_l) > 0 OR n IS NULL THEN sra_l ELSE {ordered_distinct("(f_accession || f_study_accession || f_sample_accession || f_run_name)")} END AS ls,
      CASE WHEN len(sra_l) > 0 OR n IS NULL THEN sample_name_l ELSE {ordered_distinct("(sample_name_l || f_biosample)")} END AS lb,
      CASE WHEN len(sra_l) > 0 OR n IS NULL THEN organism_l ELSE {ordered_distinct("(organism_l || f_organism)")} END AS orgs FROM g LEFT JOIN fl USING (requested)),
    w AS (SELECT *, coalesce(title_l[1], '') AS title, nullif(len(list_filter(ls, lambda x: starts_with(x, 'SRR'))), 0) AS run_count,
      {sorted_flags(("record_count > 1", 'multiple_project_records'), ("len(ls) > 20", 'broad_project_scope'), ("len(ls) = 0", 'linked_sra_unclear'), ("len(lb) = 0", 'linked_biosamples_unclear'))} AS risks FROM v)"""


def project(t):
    one = lambda c: F.when(F.col(c) != "", F.array(c)).otherwise(ev.empty_list())
    hits = t.sql(PROJECT_HITS).withColumns({"linked_sra": one("sra"), "linked_biosamples": one("sample_name")})
    studies = t.sql(STUDY_HITS).drop("requested").withColumn("run_accessions", one("run_name"))
    return ins.project_inspection(t.sql(PROJECT_REQUESTS), hits, studies)


@query(
    "discover_project_inspection",
    f"""WITH {project_sql()} SELECT requested, title, array_to_string(orgs, ',') AS organisms, array_to_string(tissues, ',') AS tissues, array_to_string(ls, ',') AS linked_sra,
      array_to_string(lb, ',') AS linked_biosamples, run_count, record_count, backfilled, risks, CASE WHEN len(ls) = 0 OR len(ls) > 20 THEN 'low' ELSE 'medium' END AS overall FROM w""",
)
def project_inspection(t):
    return project(t).select(
        "requested", "title", joined("organisms").alias("organisms"), joined("tissues").alias("tissues"), joined("linked_sra").alias("linked_sra"), joined("linked_biosamples").alias("linked_biosamples"),
        "run_count", "record_count", "backfilled", joined("risks", True).alias("risks"), F.col("fit.overall").alias("overall"),
    )


@query(
    "discover_study_evidence",
    f"""WITH {study_sql()} SELECT 'SRA' AS source, anchor AS accession, 'study' AS source_type, title, array_to_string(organism_l, ',') AS organisms, family AS assay_family, sample_count, run_count,
      '' AS geo, array_to_string(sra, ',') AS sra, bioproject, array_to_string(biosample_l, ',') AS biosample, risks FROM w""",
)
def study_evidence(t):
    return flat(ev.study_inspections(study(t)))


@query(
    "discover_project_evidence",
    f"""WITH {project_sql()} SELECT 'BioProject' AS source, requested AS accession, 'project' AS source_type, title, array_to_string(orgs, ',') AS organisms, '' AS assay_family, NULL::BIGINT AS sample_count, run_count,
      '' AS geo, array_to_string(ls, ',') AS sra, requested AS bioproject, array_to_string(lb, ',') AS biosample, risks FROM w""",
)
def project_evidence(t):
    return flat(ev.project_inspections(project(t)))
