"""Provenance ledger: cases, lessons and reference registry as normalised tables.

Rules return violations (case_id, entity, id, rule); an empty result means the ledger is consistent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from helixframe.functions import text as tx
from helixframe.functions.rules import flags, none
from helixframe.functions.text import strip
from helixframe.session import global_rank, spread


def violation(df: DataFrame, entity: str, rule: str, id_col: str = "id") -> DataFrame:
    return df.select("case_id", F.lit(entity).alias("entity"), F.col(id_col).cast("string").alias("id"), F.lit(rule).alias("rule"))


def row_rules(df: DataFrame, entity: str, *rules: tuple[Column, str]) -> DataFrame:
    """Violations of rules that need one row only, in one pass."""
    return df.select("case_id", F.lit(entity).alias("entity"), F.col("id").cast("string").alias("id"), F.explode(flags(*rules)).alias("rule"))


def repeated_ids(df: DataFrame, entity: str) -> DataFrame:
    return violation(df.groupBy("case_id", "id").agg(F.count("*").alias("_n")).where(F.col("_n") > 1), entity, "duplicate_id")


def least_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key, the least by its other columns in their order: repeated ids give the same verdict in every run.

    Dealt over a number of tasks that grows with the rows, which joins by the same keys keep.
    """
    rest = [c for c in df.columns if c not in keys]
    return spread(df, keys, df.count()).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_least")).select(*keys, *[F.col(f"_least.{c}").alias(c) for c in rest])


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def event_violations(events: DataFrame, inputs: DataFrame) -> DataFrame:
    """Events: unknown inputs, exit codes that contradict the execution status, completed runs without products."""
    used = events.select("case_id", "id", F.explode(F.coalesce("input_ids", none())).alias("input_id")).distinct()
    known = inputs.select("case_id", F.col("id").alias("input_id")).distinct()
    unknown = used.join(known, ["case_id", "input_id"], "left_anti").select("case_id", "id").distinct()
    status, code = F.col("execution_status"), F.col("exit_code")
    nothing = (F.size(F.coalesce("artifacts", F.array().cast("array<struct<id:string,path:string,sha256:string>>"))) == 0) | (F.size(F.coalesce("input_ids", none())) == 0)
    return union([
        repeated_ids(events, "event"), violation(unknown, "event", "unknown_input"),
        row_rules(
            events, "event", ((status == "not_run") & code.isNotNull(), "exit_code_without_run"), ((status != "not_run") & code.isNull(), "missing_exit_code"),
            ((status == "completed") & nothing, "completed_without_product"), (strip(F.coalesce(F.try_element_at("command", F.lit(1)), F.lit(""))) == "", "empty_command"),
        ),
    ])


def conclusion_violations(conclusions: DataFrame, events: DataFrame, inputs: DataFrame, cases: DataFrame) -> DataFrame:
    """Conclusions: support, reads, competitors, review and evidence rules."""
    kind = cases.select("case_id", "case_type").distinct()
    c = conclusions.join(kind, "case_id", "left")
    status, reads = F.col("status"), F.col("reads_support")
    bare = F.size("evidence_for") == 0
    competitors = F.coalesce("competitive_reference_ids", none())
    simple = row_rules(
        c, "conclusion", ((F.col("case_type") == "normal_validation_case") & (status == "UNRESOLVED"), "unresolved_in_normal_case"), ((status == "RESOLVED") & bare, "resolved_without_support"),
        ((F.col("confidence") == "high") & bare, "high_confidence_without_support"), ((status == "RESOLVED") & (F.col("confidence") == "not_assessable"), "resolved_not_assessable"),
        ((reads == "READS_DISCRIMINATING") & (F.size(competitors) == 0), "discriminating_without_competitor"),
        (F.col("review_status").isin("reviewed", "disputed") & (F.coalesce("reviewer", F.lit("")) == ""), "review_without_reviewer"),
    )
    keyed = least_rows(events, ["case_id", "id"]).select("case_id", F.col("id").alias("event_id"), "execution_status", F.coalesce("input_ids", none()).alias("input_ids"), F.transform("artifacts", lambda a: a["id"]).alias("_arts"))
    cited = conclusions.select("case_id", "id", "conclusion_type", F.explode(F.concat("evidence_for", "evidence_against")).alias("e")).select("case_id", "id", "conclusion_type", "e.event_id", "e.artifact_id").distinct()
    checked = cited.join(keyed, ["case_id", "event_id"], "left")
    evidence = row_rules(
        checked, "conclusion", (F.col("execution_status").isNull(), "unknown_event"),
        (F.col("execution_status").isNotNull() & ~F.array_contains("_arts", F.col("artifact_id")), "unknown_artifact"),
        (F.col("execution_status").isNotNull() & (F.col("execution_status") != "completed") & (F.col("conclusion_type") != "tool_execution"), "unfinished_event_as_evidence"),
    ).distinct()
    role = least_rows(inputs, ["case_id", "id"]).select("case_id", F.col("id").alias("input_id"), "role")
    support = conclusions.select("case_id", "id", F.explode("evidence_for").alias("e")).select("case_id", "id", "e.event_id").distinct()
    used = support.join(keyed, ["case_id", "event_id"]).select("case_id", "id", F.explode("input_ids").alias("input_id")).distinct()
    with_reads = used.join(role.where(F.col("role").isin("reads", "bam")), ["case_id", "input_id"]).select("case_id", "id").distinct()
    claims = conclusions.where(reads != "NOT_ASSESSED").join(with_reads, ["case_id", "id"], "left_anti")
    rivals = conclusions.select("case_id", "id", "reads_support", F.explode(competitors).alias("input_id")).distinct()
    placed = rivals.join(role, ["case_id", "input_id"], "left")
    unknown = placed.where(F.col("role").isNull())
    discriminating = placed.where(F.col("reads_support") == "READS_DISCRIMINATING")
    wrong = discriminating.where(F.col("role") != "competitive_reference")
    idle = discriminating.join(used, ["case_id", "id", "input_id"], "left_anti")
    return union([
        repeated_ids(conclusions, "conclusion"), simple, evidence, violation(claims, "conclusion", "reads_claim_without_reads"),
        violation(unknown.select("case_id", "id").distinct(), "conclusion", "unknown_competitor"), violation(wrong.select("case_id", "id").distinct(), "conclusion", "competitor_role"),
        violation(idle.select("case_id", "id").distinct(), "conclusion", "competitor_not_used"),
    ])


def candidate_status(results: str = "result") -> Column:
    """Aggregate: all pass, all fail, mixed, or no check at all."""
    n = F.count(results)
    return (
        F.when(n == 0, "proposed").when(F.count_if(F.col(results) == "pass") == n, "verified").when(F.count_if(F.col(results) == "fail") == n, "rejected").otherwise("inconclusive")
    )


def candidate_states(candidates: DataFrame, checks: DataFrame) -> DataFrame:
    """Status of every candidate from its registered checks; a candidate that is listed twice has one row.

    Candidates and checks meet in one grouping over a number of tasks that grows with them, not in a join.
    """
    keys = ["case_id", "candidate_id"]
    known = candidates.select("case_id", F.col("id").alias("candidate_id"), F.lit(None).cast("string").alias("result"), F.lit(True).alias("_known"))
    rows = known.unionByName(checks.where(F.col("case_id").isNotNull() & F.col("candidate_id").isNotNull()).select(*keys, "result", F.lit(False).alias("_known")))
    states = spread(rows, keys, candidates.count() + checks.count()).groupBy(*keys).agg(candidate_status().alias("status"), F.count("result").alias("checks"), F.bool_or("_known").alias("_known"))
    return states.where("_known").drop("_known")


def candidate_violations(candidates: DataFrame, checks: DataFrame, events: DataFrame, inputs: DataFrame) -> DataFrame:
    """Candidates: registered base and product, completed producer, separate content, valid checks, matching status."""
    ins = least_rows(inputs, ["case_id", "id"])
    side = lambda p: ins.select("case_id", F.col("id").alias(f"{p}_input_id"), *[F.col(c).alias(f"_{p}_{c}") for c in ("role", "path", "sha256", "size")])
    ev = least_rows(events, ["case_id", "id"]).select("case_id", F.col("id").alias("producer_event_id"), F.col("execution_status").alias("_st"), F.col("artifacts").alias("_arts"), F.coalesce("input_ids", none()).alias("_ins"))
    j = candidates.join(side("base"), ["case_id", "base_input_id"], "left").join(side("candidate"), ["case_id", "candidate_input_id"], "left").join(ev, ["case_id", "producer_event_id"], "left")
    art = F.try_element_at(F.filter("_arts", lambda a: a["id"] == F.col("artifact_id")), F.lit(1))
    same_product = (art["path"] == F.col("_candidate_path")) & (art["sha256"] == F.col("_candidate_sha256"))
    copied = (F.col("_base_path") == F.col("_candidate_path")) | ((F.col("_base_sha256") == F.col("_candidate_sha256")) & (F.col("_base_size") == F.col("_candidate_size")))
    rows = row_rules(
        j, "candidate", (F.col("_base_role").isNull() | F.col("_candidate_role").isNull() | (F.col("_candidate_role") != "candidate"), "unregistered_input"),
        (F.col("_st").isNull() | (F.col("_st") != "completed"), "producer_not_completed"), (F.col("_st").isNotNull() & ~F.coalesce(same_product, F.lit(False)), "product_differs"),
        (F.col("_st").isNotNull() & ~F.array_contains("_ins", F.col("base_input_id")), "base_not_used"), (copied, "same_as_base"),
    )
    cev = least_rows(events, ["case_id", "id"]).select("case_id", F.col("id").alias("event_id"), F.col("execution_status").alias("_cst"), F.col("exit_code").alias("_code"), F.coalesce("input_ids", none()).alias("_cins"))
    k = checks.join(candidates.select("case_id", F.col("id").alias("candidate_id"), "candidate_input_id", "change_type"), ["case_id", "candidate_id"], "left").join(cev, ["case_id", "event_id"], "left").withColumn("id", F.col("candidate_id"))
    reads = ins.where(F.col("role").isin("reads", "bam")).select("case_id", F.col("id").alias("_rid"))
    event_reads = cev.select("case_id", "event_id", F.explode("_cins").alias("_rid")).join(reads, ["case_id", "_rid"]).select("case_id", "event_id").distinct().withColumn("_reads", F.lit(True))
    k = k.join(event_reads, ["case_id", "event_id"], "left")
    passed = F.col("result") == "pass"
    tested = row_rules(
        k, "candidate", (F.col("_cst").isNull() | (F.col("_cst") != "completed"), "check_not_completed"), (F.col("_cst").isNotNull() & ~F.array_contains("_cins", F.col("candidate_input_id")), "candidate_not_checked"),
        (passed & F.col("_code").isNotNull() & (F.col("_code") != 0), "pass_with_exit_code"), (passed & F.col("change_type").isin("sequence", "structure") & F.col("_reads").isNull(), "pass_without_reads"),
    ).distinct()
    twice = violation(checks.groupBy("case_id", "candidate_id", "event_id").agg(F.count("*").alias("_n")).where(F.col("_n") > 1), "candidate", "event_checked_twice", "candidate_id").distinct()
    states = candidate_states(candidates, checks).withColumnRenamed("candidate_id", "id").withColumnRenamed("status", "_expected")
    drift = violation(candidates.join(states, ["case_id", "id"]).where(F.col("status") != F.col("_expected")), "candidate", "status_mismatch")
    return union([repeated_ids(candidates, "candidate"), rows, tested, twice, drift])


def apply_batch(current: DataFrame, proposals: DataFrame) -> DataFrame:
    """Optimistic revision check: of the proposals made against the current revision the first one wins per case.

    `current(case_id, revision)`, `proposals(case_id, proposal_id, expected_revision, submitted)`.
    """
    joined = proposals.join(current, "case_id", "left")
    fresh = F.col("revision").isNotNull() & (F.col("expected_revision").isNull() | (F.col("expected_revision") == F.col("revision")))
    first = joined.where(fresh).groupBy("case_id").agg(F.min(F.struct("submitted", "proposal_id")).alias("_w")).select("case_id", F.col("_w.proposal_id").alias("_winner"))
    out = joined.join(first, "case_id", "left")
    state = F.when(F.col("revision").isNull(), "unknown_case").when(~fresh, "stale_revision").when(F.col("proposal_id") == F.col("_winner"), "applied").otherwise("retry")
    return out.select("case_id", "proposal_id", state.alias("state"), F.when(state == "applied", F.col("revision") + 1).alias("new_revision"))


def conclusion_history(versions: DataFrame) -> DataFrame:
    """All versions of a conclusion with validity and a current flag: `versions(case_id, id, revision, …)`."""
    order = W.partitionBy("case_id", "id").orderBy("revision")
    return versions.withColumn("replaced_at", F.lead("revision").over(order)).withColumn("version", F.row_number().over(order)).withColumn("is_current", F.col("replaced_at").isNull())


def file_drift(registered: DataFrame, current: DataFrame) -> DataFrame:
    """Registered files that are missing or changed now; `current(path, sha256, size)` from the file reader."""
    now = current.select("path", F.col("sha256").alias("_sha"), F.col("size").alias("_size"))
    state = F.when(F.col("_sha").isNull(), "missing").when((F.col("_sha") != F.col("sha256")) | (F.col("_size") != F.col("size")), "changed").otherwise("ok")
    return registered.join(now, "path", "left").withColumn("state", state).drop("_sha", "_size")


# -- lessons ---------------------------------------------------------------------------------------

# Allowed review transitions.
TRANSITIONS = {"candidate": ("verified", "rejected"), "verified": ("deprecated", "withdrawn")}


def revision_violations(revisions: DataFrame) -> DataFrame:
    """Chains must run 1..n, point to the previous revision, and only the last one may be current.

    `revisions(lesson_id, revision, supersedes, validation_status, current_revision)`.
    """
    order = W.partitionBy("lesson_id").orderBy("revision")
    rows = revisions.withColumn("_rn", F.row_number().over(order)).withColumn("_next", F.lead("revision").over(order))
    last = F.col("_next").isNull()
    found = flags(
        (F.col("revision") != F.col("_rn"), "not_contiguous"), ((F.col("revision") == 1) & F.col("supersedes").isNotNull(), "first_supersedes"),
        ((F.col("revision") > 1) & ~F.col("supersedes").eqNullSafe(F.col("revision") - 1), "broken_link"), (~last & (F.col("validation_status") != "superseded"), "history_not_superseded"),
        (last & (F.col("validation_status") == "superseded"), "current_superseded"), (last & (F.col("current_revision") != F.col("_rn")), "wrong_current"),
    )
    return rows.select("lesson_id", "revision", F.explode(found).alias("rule"))


def review_lessons(lessons: DataFrame, reviews: DataFrame) -> DataFrame:
    """Apply one review per lesson where the transition is allowed and reviewer and reason are given."""
    allowed = reduce(lambda a, b: a | b, [(F.col("validation_status") == k) & F.col("to_status").isin(*v) for k, v in TRANSITIONS.items()])
    joined = reviews.join(lessons.select("lesson_id", "validation_status"), "lesson_id", "left")
    state = (
        F.when(F.col("validation_status").isNull(), "unknown_lesson").when((tx.clean(F.col("reviewer")) == "") | (tx.clean(F.col("reason")) == ""), "incomplete_review")
        .when(~allowed, "transition_refused").otherwise("accepted")
    )
    return joined.withColumn("state", state).withColumn("new_status", F.when(F.col("state") == "accepted", F.col("to_status")).otherwise(F.col("validation_status")))


def review_batch(lessons: DataFrame, reviews: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """State of every review of a batch, in the order submitted: the first one that is allowed takes effect and later ones see it.

    reviews(lesson_id, ord, to_status, reviewer, reason), `ord` unique in a lesson; sources(lesson_id, source_state) tells
    whether a lesson's source case is `ok`, `changed` since or `unresolved`; a lesson is not verified unless it is ok (a lesson
    without such a row has no source to check).  Result: the reviews with old_status, state and new_status.  A chain of reviews is as
    long as the transitions allow, so that many aggregations decide it, whatever the number of reviews of a lesson.
    """
    state_of = F.lit(None).cast("string") if sources is None else F.col("source_state")
    rows = reviews.select("lesson_id", "ord", "to_status", "reviewer", "reason").join(lessons.select("lesson_id", F.col("validation_status").alias("_start")), "lesson_id", "left")
    if sources is not None:
        rows = rows.join(sources.select("lesson_id", "source_state"), "lesson_id", "left")
    blank = (tx.clean(F.col("reviewer")) == "") | (tx.clean(F.col("reason")) == "")
    unsure = (F.col("to_status") == "verified") & F.coalesce(state_of != "ok", F.lit(False))

    def verdict(status: Column) -> Column:
        allowed = reduce(lambda a, b: a | b, [(status == k) & F.col("to_status").isin(*v) for k, v in TRANSITIONS.items()])
        return (
            F.when(F.col("_start").isNull(), "unknown_lesson").when(blank, "incomplete_review").when(~F.coalesce(allowed, F.lit(False)), "transition_refused")
            .when(unsure, F.concat(F.lit("source_"), state_of)).otherwise("accepted")
        )

    rows = rows.withColumn("old_status", F.col("_start"))
    reached, longest = set(TRANSITIONS), 0
    while reached:
        longest += 1
        reached = {t for k in reached for t in TRANSITIONS.get(k, ())} & set(TRANSITIONS)
    rows = rows.withColumn("_last", F.lit(None).cast(rows.schema["ord"].dataType))
    for _ in range(longest):
        pending = F.col("_last").isNull() | (F.col("ord") > F.col("_last"))
        won = rows.where(pending & (verdict(F.col("old_status")) == "accepted")).groupBy("lesson_id").agg(F.min(F.struct("ord", "to_status")).alias("_won"))
        rows = rows.join(won, "lesson_id", "left")
        after = F.coalesce(F.col("ord") > F.col("_won.ord"), F.lit(False))
        rows = rows.withColumns({"old_status": F.when(after, F.col("_won.to_status")).otherwise(F.col("old_status")), "_last": F.coalesce("_won.ord", "_last")}).drop("_won")
    out = rows.withColumn("state", verdict(F.col("old_status")))
    kept = [c for c in ("lesson_id", "ord", "to_status", "reviewer", "reason", "old_status", "state") if c in out.columns]
    return out.select(*kept, F.when(F.col("state") == "accepted", F.col("to_status")).otherwise(F.col("old_status")).alias("new_status"))


def reviewed_table(lessons: DataFrame, reviewed: DataFrame) -> DataFrame:
    """The lessons after a batch of reviews: the status that the last accepted one gives, and how many were accepted."""
    last = reviewed.where(F.col("state") == "accepted").groupBy("lesson_id").agg(F.max_by("to_status", "ord").alias("_status"), F.count("*").alias("_n"))
    joined = lessons.join(last, "lesson_id", "left")
    return joined.withColumn("validation_status", F.coalesce("_status", "validation_status")).withColumn("reviews_accepted", F.coalesce("_n", F.lit(0))).drop("_status", "_n")


def duplicate_lessons(lessons: DataFrame) -> DataFrame:
    """Current lessons with equal content: all but the first identifier are refused."""
    first = lessons.groupBy("content_hash").agg(F.min("lesson_id").alias("first_id"), F.count("*").alias("copies")).where(F.col("copies") > 1)
    return lessons.select("lesson_id", "content_hash").join(first, "content_hash").where(F.col("lesson_id") != F.col("first_id")).select("lesson_id", "first_id")


def supersede(current: DataFrame, drafts: DataFrame) -> DataFrame:
    """New revisions of current lessons; the source must stay the same and the content must differ.

    Returns the state of every draft and the revision it would get.
    """
    old = current.select("lesson_id", F.col("revision").alias("_rev"), F.col("source_path").alias("_src"), F.col("content_hash").alias("_hash"))
    other = current.select(F.col("content_hash"), F.col("lesson_id").alias("_other")).groupBy("content_hash").agg(F.min("_other").alias("_lo"), F.max("_other").alias("_hi"))
    joined = drafts.join(old, "lesson_id", "left").join(other, "content_hash", "left")
    taken = F.col("_lo").isNotNull() & ((F.col("_lo") != F.col("lesson_id")) | (F.col("_hi") != F.col("lesson_id")))
    state = (
        F.when(F.col("_rev").isNull(), "unknown_lesson").when(F.col("source_path") != F.col("_src"), "other_source").when(F.col("content_hash") == F.col("_hash"), "same_content")
        .when(taken, "duplicate_content").otherwise("accepted")
    )
    return joined.select("lesson_id", "content_hash", state.alias("state"), F.when(state == "accepted", F.col("_rev") + 1).alias("revision"))


def superseded_table(current: DataFrame, drafts: DataFrame) -> DataFrame:
    """Closed old rows and open new rows after the accepted drafts."""
    accepted = supersede(current, drafts).where(F.col("state") == "accepted")
    old = current.join(accepted.select("lesson_id", F.lit(True).alias("_closed")), "lesson_id", "left")
    old = old.withColumn("validation_status", F.when(F.col("_closed"), "superseded").otherwise(F.col("validation_status"))).select("lesson_id", "revision", "validation_status", "content_hash")
    new = accepted.select("lesson_id", F.col("revision").cast("long").alias("revision"), F.lit("candidate").alias("validation_status"), "content_hash")
    return old.unionByName(new)


def show_revision(revisions: DataFrame, requests: DataFrame) -> DataFrame:
    """The requested revision, the current one by default; out of range is reported, not guessed."""
    top = revisions.groupBy("lesson_id").agg(F.max("revision").alias("_top"))
    wanted = requests.join(top, "lesson_id", "left").withColumn("revision", F.coalesce("revision", "_top"))
    joined = wanted.join(revisions.withColumn("_hit", F.lit(True)), ["lesson_id", "revision"], "left")
    return joined.withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit", "_top")


def assign_ids(items: DataFrame, existing: DataFrame, order: list[str], pattern: str, template: str) -> DataFrame:
    """Next free numbers for new items in the given total order; positions come from a sort over all tasks."""
    start = existing.agg(tx.next_number(F.col("id"), pattern).alias("_start"))
    numbered = global_rank(items.withColumn("_all", F.lit(1)), ["_all"], [F.col(c).asc() for c in order], "_n")
    return numbered.join(start).withColumn("id", F.format_string(template, F.col("_start") + F.col("_n") - 1)).drop("_n", "_start", "_all")


# -- reference registry ----------------------------------------------------------------------------

# Purposes and the purposes each reference level allows.
PURPOSES = (
    "gene_order_comparison", "annotation_comparison", "boundary_validation", "identity_check", "taxon_screen", "contamination_screen", "structure_check",
)
LEVEL_PURPOSES = {
    "L1": PURPOSES,
    "L2": PURPOSES,
    "L3": ("gene_order_comparison", "annotation_comparison", "identity_check", "taxon_screen", "contamination_screen"),
    "L4": ("identity_check", "taxon_screen", "contamination_screen"),
    "L5": ("taxon_screen",),
}
HEX64 = "^[0-9a-f]{64}$"


def registry_violations(records: DataFrame) -> DataFrame:
    """Reasons why a reference record is not valid.

    `records(id, kind, source, purposes, retrieved, accession, file_sha256, sequence_sha256, length_bp, level, name, path, version)`.
    """
    blank = lambda c: tx.clean(F.col(c)) == ""
    hexed = lambda c: F.coalesce(F.col(c).rlike(HEX64), F.lit(False))
    purposes = F.coalesce("purposes", none())
    allowed = F.create_map(*[x for k, v in LEVEL_PURPOSES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    level = F.try_element_at(allowed, F.coalesce("level", F.lit("")))
    seq, db = F.col("kind") == "sequence", F.col("kind") == "database"
    either = seq | db
    found = flags(
        (~F.coalesce(either, F.lit(False)), "kind"), (either & blank("source"), "source"), (either & (F.size(purposes) == 0), "purposes"),
        (either & (F.size(F.array_except(purposes, F.array(*map(F.lit, PURPOSES)))) > 0), "unknown_purpose"), (either & blank("retrieved"), "retrieved"),
        (seq & ~F.coalesce(F.col("accession").rlike(r"^[A-Za-z0-9][A-Za-z0-9_.-]*\.[0-9]+$"), F.lit(False)), "accession_version"), (either & ~hexed("file_sha256"), "file_sha256"),
        (seq & ~hexed("sequence_sha256"), "sequence_sha256"), (seq & (F.coalesce("length_bp", F.lit(0)) <= 0), "length_bp"), (seq & level.isNull(), "level"),
        (seq & level.isNotNull() & (F.size(F.array_except(purposes, level)) > 0), "purpose_not_allowed"),
        (db & blank("name"), "name"), (db & blank("path"), "path"), (db & blank("version"), "version"),
    )
    return records.select("id", F.explode(found).alias("rule"))


def register(existing: DataFrame, proposals: DataFrame) -> DataFrame:
    """New, identical (idempotent) or drifted against the registered accession."""
    known = existing.where(F.col("accession").isNotNull()).groupBy("accession").agg(F.collect_set("file_sha256").alias("_h"))
    state = F.when(F.col("_h").isNull(), "new").when(F.array_contains("_h", F.col("file_sha256")), "identical").otherwise("drift")
    return proposals.join(known, "accession", "left").withColumn("state", state).drop("_h")


def register_batch(existing: DataFrame, proposals: DataFrame) -> DataFrame:
    """State of every proposal of a batch, in the order submitted (`ord`, unique in an accession): the first proposal of an unknown
    accession is new, and later ones are held against it as against a registered record: identical or drift.

    Proposals without an accession (databases) are new each.  Only (accession, hash) pairs are compared; nothing is gathered.
    """
    known = existing.where(F.col("accession").isNotNull()).select("accession").distinct().withColumn("_known", F.lit(True))
    same = existing.where(F.col("accession").isNotNull()).select("accession", "file_sha256").distinct().withColumn("_same", F.lit(True))
    first = proposals.where(F.col("accession").isNotNull()).groupBy("accession").agg(F.min(F.struct("ord", "file_sha256")).alias("_first"))
    rows = proposals.join(known, "accession", "left").join(same, ["accession", "file_sha256"], "left").join(first, "accession", "left")
    match = F.when(F.col("_known"), F.coalesce("_same", F.lit(False))).otherwise(F.coalesce(F.col("file_sha256") == F.col("_first.file_sha256"), F.lit(False)))
    is_new = F.col("accession").isNull() | (F.col("_known").isNull() & (F.col("ord") == F.col("_first.ord")))
    return rows.withColumn("state", F.when(is_new, "new").when(match, "identical").otherwise("drift")).drop("_known", "_same", "_first")


def registry_table(existing: DataFrame, registered: DataFrame) -> DataFrame:
    """The registry after a batch: the rows that were there and the new ones."""
    return existing.unionByName(registered.where(F.col("state") == "new").select(*existing.columns))


def verify_registry(records: DataFrame, current: DataFrame) -> DataFrame:
    """Registered files that have no path, are missing or changed."""
    now = current.select("path", F.col("sha256").alias("_sha"))
    state = (
        F.when(tx.clean(F.col("path")) == "", "no_path").when(F.col("_sha").isNull(), "missing")
        .when((tx.clean(F.col("file_sha256")) != "") & (F.col("_sha") != F.col("file_sha256")), "changed").otherwise("ok")
    )
    return records.join(now, "path", "left").withColumn("state", state).drop("_sha")
