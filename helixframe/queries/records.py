"""Ledger, lessons, registry, edits and search: orders are cases, their lines events."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import text as tx
from helixframe.operators import edits as ed, ledger as lg, search as sr
from helixframe.queries.registry import query
from helixframe.queries.sequence import DNA

INPUTS = """SELECT o_orderkey AS case_id, 'I1' AS id, CASE WHEN o_orderstatus = 'F' THEN 'reads' WHEN o_orderstatus = 'O' THEN 'bam' ELSE 'reference' END AS role, 'p' || CAST(o_custkey AS STRING) AS path, 'h' || CAST(o_custkey AS STRING) AS sha256, 10 AS size FROM {orders}
  UNION ALL SELECT o_orderkey, 'I2', CASE WHEN o_totalprice > 200000 THEN 'candidate' ELSE 'competitive_reference' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'p' || CAST(o_custkey AS STRING) ELSE 'art' END, 'hx', 10 FROM {orders} WHERE o_orderpriority <> '1-URGENT'"""
EVENTS = """SELECT l_orderkey AS case_id, 'E' || CAST(l_linenumber AS STRING) AS id, CASE WHEN l_tax > 0.065 THEN 'not_run' WHEN l_discount > 0.085 THEN 'failed' ELSE 'completed' END AS execution_status,
  CASE WHEN l_tax > 0.075 OR l_discount < 0.005 THEN NULL ELSE CAST(l_linenumber % 2 AS INT) END AS exit_code, CASE WHEN l_quantity > 47 THEN ' ' ELSE 'run' END AS cmd,
  CASE WHEN l_returnflag = 'A' THEN 'I1' WHEN l_returnflag = 'N' THEN 'I1,I2' WHEN l_quantity < 3 THEN '' ELSE 'I2,I9' END AS ins, CASE WHEN l_quantity > 8 THEN 'art' END AS art FROM {lineitem}"""
CONCLUSIONS = """SELECT o_orderkey AS case_id, 'C1' AS id, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'tool_execution' ELSE 'structure' END AS conclusion_type, CASE o_orderstatus WHEN 'F' THEN 'RESOLVED' WHEN 'O' THEN 'NO_CHANGE' ELSE 'UNRESOLVED' END AS status,
  CASE WHEN o_totalprice > 350000 THEN 'high' WHEN o_totalprice < 50000 THEN 'not_assessable' ELSE 'medium' END AS confidence, CASE WHEN o_totalprice > 250000 THEN 'READS_DISCRIMINATING' WHEN o_totalprice > 150000 THEN 'READS_CONSISTENT' ELSE 'NOT_ASSESSED' END AS reads_support,
  CASE WHEN o_orderpriority = '2-HIGH' THEN '' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'E2' ELSE 'E1' END AS ev, CASE WHEN o_totalprice > 450000 THEN '' WHEN o_totalprice > 300000 THEN 'I2' WHEN o_totalprice > 275000 THEN 'I1' ELSE 'I8' END AS comp,
  CASE WHEN o_totalprice < 100000 THEN 'reviewed' ELSE 'pending' END AS review_status, CASE WHEN o_orderstatus = 'P' THEN 'r' END AS reviewer, CASE WHEN o_custkey < 700 THEN 'normal_validation_case' ELSE 'abnormal_case' END AS case_type FROM {orders}"""


def split(c):
    return F.filter(F.split(c, ","), lambda x: x != "")


def inputs(t):
    return t.sql(INPUTS)


def events(t):
    art = F.when(F.col("art").isNotNull(), F.array(F.struct(F.lit("A1").alias("id"), F.col("art").alias("path"), F.lit("hx").alias("sha256")))).otherwise(F.array().cast("array<struct<id:string,path:string,sha256:string>>"))
    return t.sql(EVENTS).select("case_id", "id", "execution_status", "exit_code", F.array("cmd").alias("command"), split("ins").alias("input_ids"), art.alias("artifacts"))


def conclusions(t):
    c = t.sql(CONCLUSIONS)
    ev = F.when(F.col("ev") == "", F.array().cast("array<struct<event_id:string,artifact_id:string>>")).otherwise(F.array(F.struct(F.col("ev").alias("event_id"), F.lit("A1").alias("artifact_id"))))
    return c.select("case_id", "id", "conclusion_type", "status", "confidence", "reads_support", ev.alias("evidence_for"), F.slice(ev, 1, 0).alias("evidence_against"), split("comp").alias("competitive_reference_ids"), "review_status", "reviewer")


# all events, and the least one of each id for what cites it
EV_SQL = f"""every AS (SELECT *, list_filter(string_split(ins, ','), lambda x: x <> '') AS il FROM ({EVENTS})), ev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, id ORDER BY execution_status, exit_code NULLS FIRST, cmd, il, art NULLS FIRST) AS rk FROM every) WHERE rk = 1), inp AS ({INPUTS})"""


@query(
    "ledger_event_violations",
    f"""WITH {EV_SQL}, un AS (SELECT DISTINCT case_id, id FROM (SELECT case_id, id, unnest(il) AS i FROM every) u ANTI JOIN inp ON inp.case_id = u.case_id AND inp.id = u.i)
    SELECT case_id, 'event' AS entity, id, 'unknown_input' AS rule FROM un UNION ALL SELECT case_id, 'event', id, 'exit_code_without_run' FROM every WHERE execution_status = 'not_run' AND exit_code IS NOT NULL UNION ALL SELECT case_id, 'event', id, 'missing_exit_code' FROM every WHERE execution_status <> 'not_run' AND exit_code IS NULL
    UNION ALL SELECT case_id, 'event', id, 'completed_without_product' FROM every WHERE execution_status = 'completed' AND (art IS NULL OR len(il) = 0) UNION ALL SELECT case_id, 'event', id, 'empty_command' FROM every WHERE trim(cmd) = ''
    UNION ALL SELECT case_id, 'event', id, 'duplicate_id' FROM every GROUP BY case_id, id HAVING COUNT(*) > 1""",
)
def event_violations(t):
    return lg.event_violations(events(t), inputs(t))


@query(
    "ledger_conclusion_violations",
    f"""WITH {EV_SQL}, c AS (SELECT *, list_filter(string_split(comp, ','), lambda x: x <> '') AS cl FROM ({CONCLUSIONS})), j AS (SELECT c.*, ev.execution_status AS st, ev.art, coalesce(ev.il, []) AS il, ev.id AS eid FROM c LEFT JOIN ev ON ev.case_id = c.case_id AND ev.id = c.ev),
    k AS (SELECT j.*, EXISTS (SELECT 1 FROM inp WHERE inp.case_id = j.case_id AND list_contains(j.il, inp.id) AND inp.role IN ('reads', 'bam')) AS hr, (SELECT any_value(role) FROM inp WHERE inp.case_id = j.case_id AND list_contains(j.cl, inp.id)) AS crole FROM j)
    SELECT case_id, 'conclusion' AS entity, 'C1' AS id, unnest(list_filter([CASE WHEN case_type = 'normal_validation_case' AND status = 'UNRESOLVED' THEN 'unresolved_in_normal_case' END, CASE WHEN status = 'RESOLVED' AND ev = '' THEN 'resolved_without_support' END, CASE WHEN confidence = 'high' AND ev = '' THEN 'high_confidence_without_support' END,
      CASE WHEN status = 'RESOLVED' AND confidence = 'not_assessable' THEN 'resolved_not_assessable' END, CASE WHEN reads_support = 'READS_DISCRIMINATING' AND len(cl) = 0 THEN 'discriminating_without_competitor' END, CASE WHEN review_status = 'reviewed' AND reviewer IS NULL THEN 'review_without_reviewer' END,
      CASE WHEN ev <> '' AND eid IS NULL THEN 'unknown_event' END, CASE WHEN eid IS NOT NULL AND art IS NULL THEN 'unknown_artifact' END, CASE WHEN eid IS NOT NULL AND st <> 'completed' AND conclusion_type <> 'tool_execution' THEN 'unfinished_event_as_evidence' END,
      CASE WHEN reads_support <> 'NOT_ASSESSED' AND NOT hr THEN 'reads_claim_without_reads' END, CASE WHEN len(cl) > 0 AND crole IS NULL THEN 'unknown_competitor' END, CASE WHEN reads_support = 'READS_DISCRIMINATING' AND crole <> 'competitive_reference' THEN 'competitor_role' END,
      CASE WHEN reads_support = 'READS_DISCRIMINATING' AND len(cl) > 0 AND NOT list_contains(il, cl[1]) THEN 'competitor_not_used' END], lambda x: x IS NOT NULL)) AS rule FROM k""",
)
def conclusion_violations(t):
    return lg.conclusion_violations(conclusions(t), events(t), inputs(t), t.sql(CONCLUSIONS).select("case_id", "case_type"))


CHECKS = """SELECT l_orderkey AS case_id, 'K' || CAST(l_suppkey AS STRING) AS candidate_id, 'E' || CAST(l_linenumber AS STRING) AS event_id, CASE WHEN l_returnflag = 'A' THEN 'fail' ELSE 'pass' END AS result FROM {lineitem} WHERE l_quantity > 10"""
CANDS = """SELECT DISTINCT l_orderkey AS case_id, 'K' || CAST(l_suppkey AS STRING) AS id FROM {lineitem}"""


@query(
    "ledger_candidate_states",
    f"""SELECT k.case_id, k.id AS candidate_id, CASE WHEN COUNT(result) = 0 THEN 'proposed' WHEN COUNT(CASE WHEN result = 'pass' THEN 1 END) = COUNT(result) THEN 'verified' WHEN COUNT(CASE WHEN result = 'fail' THEN 1 END) = COUNT(result) THEN 'rejected' ELSE 'inconclusive' END AS status, COUNT(result) AS checks
    FROM ({CANDS}) k LEFT JOIN ({CHECKS}) c ON c.case_id = k.case_id AND c.candidate_id = k.id GROUP BY ALL""",
)
def candidate_states(t):
    return lg.candidate_states(t.sql(CANDS.replace("DISTINCT ", "")), t.sql(CHECKS))  # the operator lists each once


CANDIDATES = """SELECT o_orderkey AS case_id, 'K1' AS id, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'annotation' ELSE 'sequence' END AS change_type, 'I1' AS base_input_id, 'I2' AS candidate_input_id, CASE WHEN o_orderstatus = 'P' THEN 'E7' ELSE 'E1' END AS producer_event_id, 'A1' AS artifact_id,
  CASE WHEN o_totalprice > 200000 THEN 'verified' ELSE 'proposed' END AS status FROM {orders}"""
CAND_CHECKS = """SELECT o_orderkey AS case_id, 'K1' AS candidate_id, 'E2' AS event_id, 'pass' AS result FROM {orders} WHERE o_totalprice > 100000 UNION ALL SELECT o_orderkey, 'K1', CASE WHEN o_custkey < 500 THEN 'E2' ELSE 'E3' END, 'fail' FROM {orders} WHERE o_totalprice > 300000"""


@query(
    "ledger_candidate_violations",
    f"""WITH {EV_SQL}, k AS ({CANDIDATES}), b AS (SELECT * FROM inp WHERE id = 'I1'), d AS (SELECT * FROM inp WHERE id = 'I2'), j AS (SELECT k.*, b.role AS br, d.role AS dr, b.path AS bp, d.path AS dp, b.sha256 AS bs, d.sha256 AS ds, ev.execution_status AS st, ev.art, ev.il FROM k LEFT JOIN b USING (case_id) LEFT JOIN d ON d.case_id = k.case_id LEFT JOIN ev ON ev.case_id = k.case_id AND ev.id = k.producer_event_id),
    ch AS (SELECT c.*, k.change_type, ev.execution_status AS st, ev.exit_code, ev.il, EXISTS (SELECT 1 FROM inp WHERE inp.case_id = c.case_id AND list_contains(ev.il, inp.id) AND inp.role IN ('reads', 'bam')) AS hr FROM ({CAND_CHECKS}) c JOIN k USING (case_id) LEFT JOIN ev ON ev.case_id = c.case_id AND ev.id = c.event_id),
    s AS (SELECT k.case_id, k.status, CASE WHEN COUNT(result) = 0 THEN 'proposed' WHEN COUNT(CASE WHEN result = 'pass' THEN 1 END) = COUNT(result) THEN 'verified' WHEN COUNT(CASE WHEN result = 'fail' THEN 1 END) = COUNT(result) THEN 'rejected' ELSE 'inconclusive' END AS ex FROM k LEFT JOIN ({CAND_CHECKS}) c USING (case_id) GROUP BY ALL),
    r AS (SELECT case_id, unnest(list_filter([CASE WHEN br IS NULL OR dr IS NULL OR dr <> 'candidate' THEN 'unregistered_input' END, CASE WHEN st IS NULL OR st <> 'completed' THEN 'producer_not_completed' END, CASE WHEN st IS NOT NULL AND NOT coalesce(art = dp AND 'hx' = ds, false) THEN 'product_differs' END, CASE WHEN st IS NOT NULL AND NOT list_contains(il, 'I1') THEN 'base_not_used' END,
      CASE WHEN bp = dp OR bs = ds THEN 'same_as_base' END], lambda x: x IS NOT NULL)) AS rule FROM j UNION ALL SELECT DISTINCT case_id, unnest(list_filter([CASE WHEN st IS NULL OR st <> 'completed' THEN 'check_not_completed' END, CASE WHEN st IS NOT NULL AND NOT list_contains(il, 'I2') THEN 'candidate_not_checked' END, CASE WHEN result = 'pass' AND exit_code <> 0 THEN 'pass_with_exit_code' END,
      CASE WHEN result = 'pass' AND change_type = 'sequence' AND NOT hr THEN 'pass_without_reads' END], lambda x: x IS NOT NULL)) FROM ch UNION ALL SELECT DISTINCT case_id, 'event_checked_twice' FROM (SELECT case_id, event_id FROM ch GROUP BY ALL HAVING COUNT(*) > 1) UNION ALL SELECT case_id, 'status_mismatch' FROM s WHERE status <> ex)
    SELECT case_id, 'candidate' AS entity, 'K1' AS id, rule FROM r""",
)
def candidate_violations(t):
    return lg.candidate_violations(t.sql(CANDIDATES), t.sql(CAND_CHECKS), events(t), inputs(t))


PROPOSALS = """SELECT l_suppkey AS case_id, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS proposal_id, CASE WHEN l_tax < 0.005 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS expected_revision, l_shipdate AS submitted FROM {lineitem}"""
CURRENT = "SELECT s_suppkey AS case_id, CAST(s_nationkey % 7 AS BIGINT) + 1 AS revision FROM {supplier} WHERE s_acctbal > 0"


@query(
    "ledger_apply_batch",
    f"""WITH j AS (SELECT p.*, revision, revision IS NOT NULL AND coalesce(expected_revision = revision, expected_revision IS NULL) AS fresh FROM ({PROPOSALS}) p LEFT JOIN ({CURRENT}) USING (case_id)), w AS (SELECT case_id, min((submitted, proposal_id)) AS m FROM j WHERE fresh GROUP BY case_id)
    SELECT case_id, proposal_id, state, CASE WHEN state = 'applied' THEN revision + 1 END AS new_revision FROM (SELECT j.*, CASE WHEN revision IS NULL THEN 'unknown_case' WHEN NOT fresh THEN 'stale_revision' WHEN (submitted, proposal_id) = m THEN 'applied' ELSE 'retry' END AS state FROM j LEFT JOIN w USING (case_id))""",
)
def apply_batch(t):
    return lg.apply_batch(t.sql(CURRENT), t.sql(PROPOSALS))


@query("ledger_conclusion_history", """SELECT o_custkey AS case_id, o_orderpriority AS id, o_orderkey AS revision, lead(o_orderkey) OVER w AS replaced_at, row_number() OVER w AS version, lead(o_orderkey) OVER w IS NULL AS is_current FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey)""")
def history(t):
    return lg.conclusion_history(t.orders.select(F.col("o_custkey").alias("case_id"), F.col("o_orderpriority").alias("id"), F.col("o_orderkey").alias("revision")))


@query("ledger_file_drift", "SELECT doc_id, CASE WHEN lang = 'es' THEN 'missing' WHEN source = 'src4' OR n_chars < 500 THEN 'changed' ELSE 'ok' END AS state FROM documents")
def drift(t):
    d = t.documents.select("doc_id", F.concat(F.lit("/d/"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"), F.col("n_chars").alias("size"), "lang", "source")
    now = d.where("lang <> 'es'").select("path", F.when(F.col("source") == "src4", "x").otherwise(F.col("sha256")).alias("sha256"), F.when(F.col("size") < 500, 0).otherwise(F.col("size")).alias("size"))
    return lg.file_drift(d, now).select("doc_id", "state")


REVS = """SELECT o_custkey AS lesson_id, rn + CASE WHEN o_custkey % 17 = 0 AND rn > 2 THEN 1 ELSE 0 END AS revision, CASE WHEN rn = 1 AND o_orderpriority = '5-LOW' THEN 9 WHEN rn > 1 AND o_orderstatus = 'P' THEN NULL WHEN rn > 1 THEN rn - 1 END AS supersedes,
  CASE WHEN o_totalprice > 150000 THEN 'superseded' ELSE 'verified' END AS validation_status, n AS current_revision FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, COUNT(*) OVER (PARTITION BY o_custkey) AS n FROM {orders})"""


@query(
    "lesson_revision_violations",
    f"""WITH r AS (SELECT *, row_number() OVER w AS k, lead(revision) OVER w AS nx FROM ({REVS}) WINDOW w AS (PARTITION BY lesson_id ORDER BY revision)) SELECT lesson_id, revision, unnest(list_filter([CASE WHEN revision <> k THEN 'not_contiguous' END, CASE WHEN revision = 1 AND supersedes IS NOT NULL THEN 'first_supersedes' END,
      CASE WHEN revision > 1 AND supersedes IS DISTINCT FROM revision - 1 THEN 'broken_link' END, CASE WHEN nx IS NOT NULL AND validation_status <> 'superseded' THEN 'history_not_superseded' END, CASE WHEN nx IS NULL AND validation_status = 'superseded' THEN 'current_superseded' END, CASE WHEN nx IS NULL AND current_revision <> k THEN 'wrong_current' END], lambda x: x IS NOT NULL)) AS rule FROM r""",
)
def revisions(t):
    return lg.revision_violations(t.sql(REVS))


LESSONS = """SELECT doc_id AS lesson_id, CAST(n_chars % 5 + 1 AS BIGINT) AS revision, CASE lang WHEN 'en' THEN 'candidate' WHEN 'fr' THEN 'verified' WHEN 'de' THEN 'rejected' ELSE 'deprecated' END AS validation_status, source AS source_path, md5(text) AS content_hash FROM {documents}"""


@query(
    "lesson_reviews",
    f"""SELECT doc_id AS lesson_id, CASE WHEN lang IS NULL THEN 'unknown_lesson' WHEN toxic = 1 THEN 'incomplete_review' WHEN (lang = 'en' AND quality = 1) OR (lang = 'fr' AND quality = 0) THEN 'accepted' ELSE 'transition_refused' END AS state FROM labels LEFT JOIN documents USING (doc_id)""",
)
def reviews(t):
    r = t.labels.select(F.col("doc_id").alias("lesson_id"), F.when(F.col("quality") == 1, "verified").otherwise("withdrawn").alias("to_status"), F.lit("r").alias("reviewer"), F.when(F.col("toxic") == 1, " ").otherwise("because").alias("reason"))
    return lg.review_lessons(t.sql(LESSONS), r).select("lesson_id", "state")


# A batch: an order is a lesson, its lines are the reviews in the order submitted.
BATCH_LESSONS = "SELECT o_orderkey AS lesson_id, CASE o_orderstatus WHEN 'P' THEN 'verified' ELSE 'candidate' END AS validation_status FROM {orders} WHERE o_orderkey % 50 > 0"
BATCH_SOURCES = "SELECT o_orderkey AS lesson_id, CASE WHEN o_orderpriority LIKE '1%' THEN 'changed' WHEN o_orderpriority LIKE '2%' THEN 'unresolved' ELSE 'ok' END AS source_state FROM {orders} WHERE o_orderkey % 3 > 0"
BATCH_REVIEWS = """SELECT l_orderkey AS lesson_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord,
  CASE l_suppkey % 5 WHEN 0 THEN 'deprecated' WHEN 1 THEN 'rejected' WHEN 2 THEN 'withdrawn' ELSE 'verified' END AS to_status, CASE WHEN l_quantity > 45 THEN '  ' ELSE 'me' END AS reviewer, 'because' AS reason FROM {lineitem}"""
# The same by folding the reviews one after the other.
FOLD = f"""WITH RECURSIVE rv AS MATERIALIZED ({BATCH_REVIEWS}), so AS ({BATCH_SOURCES}), st AS (
    SELECT lesson_id, 0::BIGINT AS ord, validation_status AS status, NULL::VARCHAR AS state, NULL::VARCHAR AS old_status, NULL::VARCHAR AS to_status FROM (SELECT DISTINCT lesson_id FROM rv) LEFT JOIN ({BATCH_LESSONS}) USING (lesson_id)
    UNION ALL SELECT lesson_id, ord, CASE WHEN state = 'accepted' THEN to_status ELSE status END, state, status, to_status FROM (
      SELECT st.lesson_id, rv.ord, st.status, rv.to_status, CASE WHEN st.status IS NULL THEN 'unknown_lesson' WHEN trim(reviewer) = '' THEN 'incomplete_review'
        WHEN NOT ((st.status = 'candidate' AND rv.to_status IN ('verified', 'rejected')) OR (st.status = 'verified' AND rv.to_status IN ('deprecated', 'withdrawn'))) THEN 'transition_refused'
        WHEN rv.to_status = 'verified' AND source_state <> 'ok' THEN 'source_' || source_state ELSE 'accepted' END AS state
      FROM st JOIN rv ON rv.lesson_id = st.lesson_id AND rv.ord = st.ord + 1 LEFT JOIN so ON so.lesson_id = st.lesson_id))"""


def batch(t):
    return lg.review_batch(t.sql(BATCH_LESSONS), t.sql(BATCH_REVIEWS), t.sql(BATCH_SOURCES))


@query("lesson_review_batch", FOLD + " SELECT lesson_id, ord, to_status, old_status, state, status AS new_status FROM st WHERE ord > 0")
def review_batch(t):
    return batch(t).select("lesson_id", F.col("ord").cast("long").alias("ord"), "to_status", "old_status", "state", "new_status")


@query(
    "lesson_review_table",
    FOLD + f""" SELECT lesson_id, coalesce(s, validation_status) AS validation_status, coalesce(n, 0) AS reviews_accepted FROM ({BATCH_LESSONS})
    LEFT JOIN (SELECT lesson_id, arg_max(status, ord) AS s, count_if(state = 'accepted')::BIGINT AS n FROM st WHERE ord > 0 GROUP BY lesson_id) USING (lesson_id)""",
)
def review_table(t):
    return lg.reviewed_table(t.sql(BATCH_LESSONS), batch(t))


@query("lesson_duplicates", f"SELECT lesson_id, f AS first_id FROM ({LESSONS}) JOIN (SELECT content_hash, min(lesson_id) AS f FROM ({LESSONS}) GROUP BY content_hash HAVING COUNT(*) > 1) USING (content_hash) WHERE lesson_id <> f")
def duplicates(t):
    return lg.duplicate_lessons(t.sql(LESSONS))


DRAFTS = "SELECT doc_id AS lesson_id, CASE WHEN n_chars < 500 THEN 'moved' ELSE source END AS source_path, CASE WHEN lang = 'fr' THEN md5(text) WHEN lang = 'de' THEN md5(text || '!') ELSE md5(lang || source) END AS content_hash FROM {documents}"
SUPER = f"""(SELECT lesson_id, content_hash, state, CASE WHEN state = 'accepted' THEN rev + 1 END AS revision FROM (SELECT d.lesson_id, d.content_hash, o.revision AS rev, CASE WHEN o.revision IS NULL THEN 'unknown_lesson' WHEN d.source_path <> o.source_path THEN 'other_source' WHEN d.content_hash = o.content_hash THEN 'same_content'
  WHEN EXISTS (SELECT 1 FROM ({LESSONS}) x WHERE x.content_hash = d.content_hash AND x.lesson_id <> d.lesson_id) THEN 'duplicate_content' ELSE 'accepted' END AS state FROM ({DRAFTS}) d LEFT JOIN ({LESSONS}) o USING (lesson_id)))"""


@query("lesson_supersede", f"SELECT * FROM {SUPER}")
def supersede(t):
    return lg.supersede(t.sql(LESSONS), t.sql(DRAFTS))


@query("lesson_superseded_table", f"SELECT lesson_id, l.revision, CASE WHEN s.state = 'accepted' THEN 'superseded' ELSE validation_status END AS validation_status, l.content_hash FROM ({LESSONS}) l LEFT JOIN {SUPER} s USING (lesson_id) UNION ALL SELECT lesson_id, revision, 'candidate', content_hash FROM {SUPER} WHERE state = 'accepted'")
def superseded_table(t):
    return lg.superseded_table(t.sql(LESSONS), t.sql(DRAFTS))


@query(
    "lesson_show_revision",
    """WITH r AS (SELECT o_custkey AS lesson_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS revision, o_orderkey AS body FROM orders), m AS (SELECT lesson_id, max(revision) AS top FROM r GROUP BY lesson_id), q AS (SELECT c_custkey AS lesson_id, coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey::BIGINT END, top) AS revision FROM customer LEFT JOIN m ON lesson_id = c_custkey)
    SELECT q.lesson_id, q.revision, body, body IS NOT NULL AS found FROM q LEFT JOIN r ON r.lesson_id = q.lesson_id AND r.revision = q.revision""",
)
def show(t):
    r = t.sql("SELECT o_custkey AS lesson_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS revision, o_orderkey AS body FROM {orders}")
    q = t.customer.select(F.col("c_custkey").alias("lesson_id"), F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("long")).alias("revision"))
    return lg.show_revision(r, q)


@query("lesson_privacy_flags", """SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}\\b') THEN 'email' END, CASE WHEN regexp_matches(text, '(?i)\\b(?:api[_-]?key|token|password|secret)\\s*[:=]\\s*\\S+') THEN 'credential' END,
  CASE WHEN regexp_matches(text, '(?:^|[^:\\p{L}\\p{N}_/])/[^/\\s]+/[^/\\s]+') THEN 'path' END, CASE WHEN regexp_matches(text, '(?m)^\\s*>[^\\n]+\\n\\s*[ACGTRYSWKMBDHVNacgtryswkmbdhvn\\s]{20,}') THEN 'fasta' END, CASE WHEN regexp_full_match(text, '[ACGTNacgtn\\s]{40,}') THEN 'sequence' END) AS flags FROM documents""")
def privacy(t):
    return t.documents.select("doc_id", F.array_join(tx.privacy_flags(F.col("text")), ",").alias("flags"))


@query("lesson_content_hash", """SELECT doc_id, sha256('{"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}') AS digest FROM documents""")
def content_hash(t):
    return t.documents.select("doc_id", tx.content_hash(source=F.col("source"), lang=F.col("lang"), n_chars=F.col("n_chars")).alias("digest"))


@query("lesson_next_ids", """SELECT s_suppkey, 'L' || lpad((row_number() OVER (ORDER BY s_suppkey) + m)::VARCHAR, 6, '0') AS id FROM supplier, (SELECT max(c_custkey) AS m FROM customer WHERE c_acctbal > 0)""")
def next_ids(t):
    existing = t.customer.select(F.when(F.col("c_acctbal") > 0, F.format_string("L%06d", "c_custkey")).otherwise(F.concat(F.lit("X"), F.col("c_custkey").cast("string"))).alias("id"))
    return lg.assign_ids(t.supplier.select("s_suppkey"), existing, ["s_suppkey"], "^L([0-9]{6})$", "L%06d")


REFERENCES = """SELECT p_partkey AS id, CASE WHEN p_size < 30 THEN 'sequence' WHEN p_size < 48 THEN 'database' ELSE 'other' END AS kind, CASE WHEN p_type = 'PROMO' THEN ' ' ELSE p_type END AS source, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'd' END AS retrieved,
  CASE WHEN p_size % 3 = 0 THEN 'NC_' || CAST(p_partkey AS STRING) ELSE 'NC_' || CAST(p_partkey AS STRING) || '.1' END AS accession, CASE WHEN p_size % 7 = 0 THEN 'abc' ELSE md5(p_name) || md5(p_brand) END AS file_sha256, md5(p_name) || md5(p_brand) AS sequence_sha256,
  CAST(p_size % 4 AS BIGINT) AS length_bp, 'L' || CAST(p_size % 6 AS STRING) AS level, p_name AS name, CASE WHEN p_size % 2 = 0 THEN p_brand END AS path, CAST(NULL AS STRING) AS version, CASE WHEN p_type = 'SMALL' THEN '' WHEN p_type = 'LARGE' THEN 'taxon_screen,boundary_validation' WHEN p_type = 'MEDIUM' THEN 'guess' ELSE 'taxon_screen' END AS pp FROM {part}"""


@query(
    "registry_violations",
    f"""WITH r AS (SELECT *, list_filter(string_split(pp, ','), lambda x: x <> '') AS pl, kind = 'sequence' AS sq, kind = 'database' AS db FROM ({REFERENCES})) SELECT id, unnest(list_filter([CASE WHEN NOT (sq OR db) THEN 'kind' END, CASE WHEN (sq OR db) AND trim(source) = '' THEN 'source' END, CASE WHEN (sq OR db) AND len(pl) = 0 THEN 'purposes' END,
      CASE WHEN (sq OR db) AND pp = 'guess' THEN 'unknown_purpose' END, CASE WHEN (sq OR db) AND retrieved = '' THEN 'retrieved' END, CASE WHEN sq AND NOT contains(accession, '.') THEN 'accession_version' END, CASE WHEN (sq OR db) AND file_sha256 = 'abc' THEN 'file_sha256' END, CASE WHEN sq AND length_bp = 0 THEN 'length_bp' END,
      CASE WHEN sq AND level = 'L0' THEN 'level' END, CASE WHEN sq AND level <> 'L0' AND (pp = 'guess' OR (contains(pp, 'boundary') AND level IN ('L3', 'L4', 'L5'))) THEN 'purpose_not_allowed' END, CASE WHEN db AND path IS NULL THEN 'path' END, CASE WHEN db THEN 'version' END], lambda x: x IS NOT NULL)) AS rule FROM r""",
)
def registry(t):
    return lg.registry_violations(t.sql(REFERENCES).withColumn("purposes", split("pp")))


@query("registry_register", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_partkey IS NULL THEN 'new' WHEN l_suppkey % 25 = p_size % 25 THEN 'identical' ELSE 'drift' END AS state FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON p_partkey = l_partkey")
def register(t):
    known = t.part.where("p_size < 40").select(F.col("p_partkey").cast("string").alias("accession"), (F.col("p_size") % 25).cast("string").alias("file_sha256"))
    new = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").cast("string").alias("accession"), (F.col("l_suppkey") % 25).cast("string").alias("file_sha256"))
    return lg.register(known, new).select("l_orderkey", "l_linenumber", "l_partkey", "state")


KNOWN = "SELECT CAST(p_partkey AS STRING) AS accession, CAST(p_size % 3 AS STRING) AS file_sha256 FROM {part} WHERE p_size < 20"
EACH_PROPOSED = "SELECT l_orderkey * 10 + l_linenumber AS ord, CASE WHEN l_tax > 0.07 THEN NULL ELSE CAST(l_partkey AS STRING) END AS accession, CAST(l_suppkey % 3 AS STRING) AS file_sha256 FROM {lineitem}"
PROPOSED = f"SELECT min(ord) AS ord, accession, file_sha256 FROM ({EACH_PROPOSED}) GROUP BY ord, accession, file_sha256"
REGISTERED = f"""WITH pr AS ({PROPOSED}), k AS (SELECT accession, list(DISTINCT file_sha256) AS hs FROM ({KNOWN}) GROUP BY ALL), f AS (SELECT accession, min(ord) AS fo, arg_min(file_sha256, (ord, file_sha256)) AS fh FROM pr WHERE accession IS NOT NULL GROUP BY ALL),
  st AS (SELECT ord, accession, file_sha256, CASE WHEN accession IS NULL THEN 'new' WHEN hs IS NULL AND ord = fo AND file_sha256 = fh THEN 'new' WHEN list_contains(coalesce(hs, [fh]), file_sha256) THEN 'identical' ELSE 'drift' END AS state FROM pr LEFT JOIN k USING (accession) LEFT JOIN f USING (accession))"""


def proposals(t):
    return lg.register_batch(t.sql(KNOWN), t.sql(PROPOSED))


@query("registry_register_batch", REGISTERED + " SELECT * FROM st")
def register_batch(t):
    return proposals(t).select("ord", "accession", "file_sha256", "state")


@query("registry_table", REGISTERED + f" SELECT * FROM ({KNOWN}) UNION ALL SELECT accession, file_sha256 FROM st WHERE state = 'new'")
def registry_table(t):
    return lg.registry_table(t.sql(KNOWN), proposals(t))


@query("registry_verify", "SELECT p_partkey AS id, CASE WHEN p_size = 1 THEN 'no_path' WHEN p_size > 40 THEN 'missing' WHEN p_size > 30 THEN 'changed' ELSE 'ok' END AS state FROM part")
def verify(t):
    r = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") == 1, "").otherwise(F.col("p_partkey").cast("string")).alias("path"), F.lit("h").alias("file_sha256"), "p_size")
    now = r.where("p_size <= 40 AND path <> ''").select("path", F.when(F.col("p_size") > 30, "g").otherwise("h").alias("sha256"))
    return lg.verify_registry(r, now).select("id", "state")


# -- edits -----------------------------------------------------------------------------------------

# Every 97th letter of every text is edited; some edits expect another letter, give no evidence or lie behind the end.
SEQS = f"SELECT source || '/' || CAST(doc_id % 40 AS STRING) AS set_id, CAST(doc_id AS STRING) AS sequence_id, {DNA} AS seq, doc_id FROM {{documents}}"
PLACES = {
    "spark": "explode(CASE WHEN length(seq) >= 97 THEN sequence(97, length(seq), 97) ELSE CAST(array() AS ARRAY<INT>) END)",
    "duck": "unnest(range(97, length(seq) + 1, 97))::INT",
}


def edits_sql(engine: str) -> str:
    return f"""SELECT set_id, sequence_id, CAST(p AS BIGINT) AS position, CASE WHEN doc_id % 97 = 0 THEN 'C' WHEN p > length(seq) THEN 'T' ELSE substr(seq, p, 1) END AS old, CASE WHEN substr(seq, p, 1) = 'G' THEN 'A' ELSE 'G' END AS new,
      CASE WHEN doc_id % 89 = 1 THEN ' ' ELSE 'e' END AS evidence, 'r' AS rationale
      FROM (SELECT *, {PLACES[engine]} AS p FROM ({SEQS}) UNION ALL SELECT *, CAST(length(seq) + 1 AS INT) AS p FROM ({SEQS}) WHERE doc_id % 131 = 7)"""


EDITS = edits_sql("duck")


@query(
    "edit_base_reasons",
    f"""SELECT e.set_id, e.sequence_id, position, concat_ws(',', CASE WHEN position > length(seq) THEN 'outside_sequence' END, CASE WHEN old = new THEN 'bad_base' END, CASE WHEN position <= length(seq) AND substr(seq, position::INT, 1) <> old THEN 'old_base_differs' END, CASE WHEN evidence = ' ' THEN 'no_evidence' END) AS reasons FROM ({EDITS}) e JOIN ({SEQS}) s USING (set_id, sequence_id)""",
)
def base_reasons(t):
    return ed.base_edit_reasons(t.sql(edits_sql("spark")), t.sql(SEQS)).select("set_id", "sequence_id", "position", F.array_join("reasons", ",").alias("reasons"))


@query(
    "edit_apply_bases",
    f"""WITH e AS ({EDITS}), bad AS (SELECT DISTINCT e.set_id FROM e JOIN ({SEQS}) s USING (set_id, sequence_id) WHERE old = new OR position > length(seq) OR substr(seq, position::INT, 1) <> old OR evidence = ' ')
    SELECT set_id, sequence_id, md5(array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN i % 97 > 0 THEN substr(seq, i::INT, 1) WHEN substr(seq, i::INT, 1) = 'G' THEN 'A' ELSE 'G' END), '')) AS digest, (length(seq) // 97)::INT AS edits FROM ({SEQS}) ANTI JOIN bad USING (set_id)""",
)
def apply_bases(t):
    return ed.apply_base_edits(t.sql(edits_sql("spark")), t.sql(SEQS)).select("set_id", "sequence_id", F.md5("seq").alias("digest"), "edits")


# Features with one qualifier each: lines on an order; selectors name a part.
FEATS = "SELECT CAST(l_orderkey AS STRING) AS record_id, CAST(l_linenumber * 1000000 + l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS feature_id, 'CDS' AS type, 'g' || CAST(l_linenumber AS STRING) AS gene, l_returnflag AS flag FROM {lineitem}"
QEDITS = "SELECT CAST(o_orderkey AS STRING) AS record_id, CAST(o_orderkey AS STRING) AS edit_id, 'CDS' AS selector_type, 'gene' AS selector_qualifier, CASE o_orderstatus WHEN 'F' THEN 'g1' WHEN 'O' THEN 'g2' ELSE 'g3' END AS selector_value, 'note' AS qualifier, 'e' AS evidence, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'r' END AS rationale FROM {orders}"
QUAL = f"""WITH f AS ({FEATS}), q AS ({QEDITS}), m AS (SELECT edit_id, COUNT(DISTINCT feature_id) AS k, min(feature_id) AS fid FROM q JOIN f ON f.record_id = q.record_id AND f.gene = q.selector_value GROUP BY edit_id),
  j AS (SELECT q.*, coalesce(k, 0) AS k, fid, (SELECT min(flag) FROM f WHERE f.record_id = q.record_id AND f.feature_id = m.fid) AS flag FROM q LEFT JOIN m USING (edit_id)),
  r AS (SELECT *, concat_ws(',', CASE WHEN k <> 1 THEN 'not_unique' END, CASE WHEN k = 1 AND flag <> 'A' THEN 'old_value_differs' END, CASE WHEN rationale = '' THEN 'no_rationale' END) AS reasons FROM j)"""


def quals(t):
    f = t.sql(FEATS).groupBy("record_id", "feature_id", "type", "gene").agg(F.min("flag").alias("flag"))
    return f.select("record_id", "feature_id", "type", F.create_map(F.lit("gene"), F.array("gene"), F.lit("note"), F.array("flag")).alias("qualifiers"))


def qedits(t):
    return t.sql(QEDITS).withColumn("old", F.array(F.lit("A"))).withColumn("new", F.array(F.lit("B"), F.lit("C")))


@query("edit_qualifier_reasons", QUAL + " SELECT edit_id, k AS matches, reasons FROM r")
def qualifier_reasons(t):
    return ed.qualifier_edits(qedits(t), quals(t)).select("edit_id", "matches", F.array_join("reasons", ",").alias("reasons"))


@query("edit_apply_qualifiers", QUAL + " SELECT DISTINCT f.record_id, f.feature_id, CASE WHEN r.edit_id IS NOT NULL THEN 'B,C' ELSE flag0 END AS note FROM (SELECT record_id, feature_id, min(flag) AS flag0 FROM f GROUP BY ALL) f LEFT JOIN r ON r.record_id = f.record_id AND r.fid = f.feature_id AND r.reasons = ''")
def apply_qualifiers(t):
    return ed.apply_qualifier_edits(qedits(t), quals(t)).select("record_id", "feature_id", F.array_join(F.try_element_at("qualifiers", F.lit("note")), ",").alias("note"))


@query(
    "edit_boundary_reasons",
    f"""SELECT doc_id, reasons, CASE WHEN reasons = '' THEN (length(seq) - 3) // 3 END AS before, CASE WHEN reasons = '' THEN (length(seq) - 9) // 3 END AS after FROM (SELECT *, concat_ws(',', CASE WHEN doc_id % 13 = 0 THEN 'old_boundary_differs' END, CASE WHEN length(seq) < 15 THEN 'outside_sequence' END, CASE WHEN doc_id % 7 = 0 THEN 'codon_start_differs' END) AS reasons FROM ({SEQS}))""",
)
def boundary(t):
    s = t.sql(SEQS).select(F.col("sequence_id").alias("record_id"), F.col("seq").alias("sequence"), "doc_id")
    n = F.length("sequence")
    seg = F.array(F.struct(F.lit(3).cast("long").alias("start"), n.cast("long").alias("end")))
    quals_ = F.create_map(F.lit("gene"), F.array(F.lit("cox1")), F.lit("codon_start"), F.array(F.when(F.col("doc_id") % 7 == 0, "2").otherwise("1")))
    feats = s.select("record_id", F.col("record_id").alias("feature_id"), F.lit("CDS").alias("type"), F.lit(1).alias("strand"), seg.alias("segments"), F.lit(False).alias("partial5"), F.lit(False).alias("partial3"), quals_.alias("qualifiers"))
    edits = s.select(
        "record_id", F.col("record_id").alias("edit_id"), F.lit("gene").alias("selector_qualifier"), F.lit("cox1").alias("selector_value"), F.when(F.col("doc_id") % 13 == 0, 5).otherwise(4).alias("old_start"), n.alias("old_end"), F.lit(1).alias("old_strand"),
        F.when(n < 15, 0).otherwise(10).alias("new_start"), n.alias("new_end"), F.lit(1).alias("new_strand"), F.lit(1).alias("old_codon_start"), F.lit(1).alias("new_codon_start"), F.lit("e").alias("evidence"), F.lit("r").alias("rationale"),
    )
    out = ed.boundary_edits(edits, feats, s)
    return out.select(F.col("record_id").cast("long").alias("doc_id"), F.array_join("reasons", ",").alias("reasons"), F.length("translation_before").cast("long").alias("before"), F.length("translation_after").cast("long").alias("after"))


# -- search ----------------------------------------------------------------------------------------

ASCII = "regexp_replace(lower(text), '[^a-z0-9 ]', ' '{G})"
LIBRARY = f"SELECT doc_id, {ASCII} AS body, source AS title, CASE WHEN quality = 1 THEN 'verified' ELSE 'candidate' END AS status, lang AS domain, source AS taxon FROM {{documents}} LEFT JOIN {{labels}} USING (doc_id)"
TOK = f"tk AS (SELECT doc_id, status, domain, taxon, regexp_extract_all(title || ' ' || body, '\\w+') AS w FROM ({LIBRARY}))"


def bm25(words: list[str]) -> str:
    parts = []
    for i, w in enumerate(words):
        idf = f"(CASE WHEN ln((n - d{i} + 0.5) / (d{i} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - d{i} + 0.5) / (d{i} + 0.5)) END)"
        parts.append(f"{idf} * (f{i}::DOUBLE * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * len / av)))")
    freq = ", ".join(f"len(list_filter(w, lambda x: x = '{w}')) AS f{i}" for i, w in enumerate(words))
    df = ", ".join(f"count_if(f{i} > 0)::DOUBLE AS d{i}" for i in range(len(words)))
    every = " AND ".join(f"f{i} > 0" for i in range(len(words)))
    return f"""WITH {TOK}, ct AS (SELECT doc_id, status, domain, taxon, len(w) AS len, {freq} FROM tk), st AS (SELECT COUNT(*)::DOUBLE AS n, avg(len) AS av, {df} FROM ct), sc AS (SELECT doc_id, status, domain, taxon, -({' + '.join(parts)}) AS score FROM ct, st WHERE {every})"""


def library(t):
    return t.sql(LIBRARY).withColumn("taxa", F.array("taxon")).withColumn("data_types", F.array(F.lit("Text")))


@query("search_tokens", f"WITH {TOK} SELECT token, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(w) AS token FROM tk) GROUP BY token")
def search_tokens(t):
    return sr.tokens(library(t), ["title", "body"]).groupBy("token").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@query("search_bm25", bm25(["the", "and", "ther"]) + " SELECT doc_id, round(score, 9) AS score FROM sc")
def search_bm25(t):
    return sr.matching(library(t), "The AND ther!", ["title", "body"]).withColumn("score", F.round("score", 9))


@query("search_ranked", bm25(["the", "and"]) + " SELECT doc_id, round(score, 9) AS score FROM sc WHERE status = 'verified' AND domain = 'en' AND lower(taxon) IN ('src7') ORDER BY sc.score, doc_id LIMIT 5")
def search_ranked(t):
    out = sr.search(library(t), "the and", ["title", "body"], domain="en", taxon="SRC7", data_type="text")
    return out.select("doc_id", F.round("score", 9).alias("score"))


# -- set operations --------------------------------------------------------------------------------

BRANDS = "SELECT l_returnflag, p_size, p_brand FROM {lineitem} JOIN {part} ON p_partkey = l_partkey"


@query("set_shared_and_different", f"WITH a AS (SELECT DISTINCT p_brand FROM ({BRANDS}) WHERE l_returnflag = 'A' AND p_size = 1), b AS (SELECT DISTINCT p_brand FROM ({BRANDS}) WHERE l_returnflag = 'R' AND p_size = 2) SELECT 'both' AS side, p_brand FROM a INTERSECT SELECT 'both', p_brand FROM b UNION ALL (SELECT 'first', p_brand FROM a EXCEPT SELECT 'first', p_brand FROM b) UNION ALL (SELECT 'second', p_brand FROM b EXCEPT SELECT 'second', p_brand FROM a)")
def sets(t):
    rows = t.sql(BRANDS)
    a, b = (rows.where((F.col("l_returnflag") == f) & (F.col("p_size") == n)).select("p_brand") for f, n in (("A", 1), ("R", 2)))
    named = lambda df, side: df.select(F.lit(side).alias("side"), "p_brand")
    return named(a.intersect(b), "both").union(named(a.exceptAll(b).distinct().join(b, "p_brand", "left_anti"), "first")).union(named(b.join(a, "p_brand", "left_anti").distinct(), "second"))
