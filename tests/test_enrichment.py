"""Enrichment numbers against direct computation, and discovery rules against recorded cases."""

import random
from math import comb

from pyspark.sql import functions as F

from helixframe.functions import rules, stats, text as tx
from helixframe.operators import discover as di, enrich as en, ledger as lg, search as sr
from helixframe.session import global_rank


def test_tail_against_exact_sums(spark):
    cases = [(k, n, m, t) for t in (20, 57) for m in (1, 7, 19) for n in (1, 5, 20) for k in range(0, min(n, m) + 1)] + [(0, 500, 400, 1000), (260, 500, 400, 1000), (500, 500, 500, 1000)]
    df = spark.createDataFrame(cases, "k int, n int, m int, t int")
    rows = df.select("*", stats.hypergeometric_upper_tail(*[F.col(c) for c in "knmt"]).alias("p")).collect()
    for r in rows:
        exact = sum(comb(r.m, i) * comb(r.t - r.m, r.n - i) for i in range(r.k, min(r.n, r.m) + 1) if r.n - i <= r.t - r.m) / comb(r.t, r.n)
        assert abs(r.p - exact) <= 1e-9 * max(exact, 1e-300) + 1e-12


def test_adjustment_is_monotone_and_bounded(spark):
    ps = [0.01, 0.04, 0.03, 0.2, 0.9, 0.9]
    df = spark.createDataFrame([("c", f"t{i}", p) for i, p in enumerate(ps)], "contrast string, term_id string, p_value double")
    got = {r.term_id: r.p_adjust for r in en.adjust_p(df, ["contrast"], F.lit("BH")).collect()}
    assert [round(got[f"t{i}"], 6) for i in range(6)] == [0.06, 0.08, 0.08, 0.3, 0.9, 0.9]


def test_lists_duplicates_missing_and_small(spark):
    schema = "contrast string, gene string, metric double, padj string, ord long"
    rows = [("c", "a", 1.0, "0.01", 0), ("c", "a", -3.0, "0.01", 1), ("c", "b", 2.0, "NA", 2), ("c", "", 9.0, "0.01", 3), ("c", None, 9.0, "0.01", 4), ("c", "d", 2.0, "0.05", 5), ("e", "x", None, None, 6)]
    de = spark.createDataFrame(rows, schema)
    assert [r.gene for r in en.significant_genes(de).collect()] == ["a"]
    assert {r.contrast: (r.genes, r.status) for r in en.gene_list_status(en.significant_genes(de), de).collect()} == {"c": (1, "insufficient"), "e": (0, "insufficient")}
    assert en.significant_rows(de, "absent").count() == 5
    best = {r.gene: r.metric for r in en.strongest_per_gene(de).collect()}
    assert best == {"a": -3.0, "b": 2.0, "d": 2.0}
    assert en.guess_gene_column(["x", "Gene_Symbol"]) == "Gene_Symbol" and en.resolve_mode("auto", None) == "ora" and en.resolve_mode("auto", "lfc") == "gsea"


def test_id_types(spark):
    rows = [("n", "123", 0), ("e", "ENSSSCG0001.2", 0), ("s", "TP53", 0), ("s", "12", 1), ("none", None, 0)]
    got = {r.contrast: r.id_type for r in en.detect_id_type(spark.createDataFrame(rows, "contrast string, gene string, ord int")).collect()}
    assert got == {"n": "ENTREZID", "e": "ENSEMBL", "s": "SYMBOL", "none": "ENTREZID"}


def test_score_against_stepwise_sum(spark):
    genes = [("c", f"g{i}", float(10 - i)) for i in range(20)]
    metrics = spark.createDataFrame(genes, "contrast string, gene string, metric double")
    ranked = en.rank_genes(metrics)
    members = ["g0", "g1", "g3", "g15"]
    sets = spark.createDataFrame([("GO", "BP", "t", m) for m in members], "collection string, ontology string, term_id string, gene string")
    row = en.enrichment_scores(en.running_sum(en.ranked_members(ranked, sets, 1, 500))).first()
    total, run, best, at = sum(abs(10 - int(m[1:])) for m in members), 0.0, 0.0, 0
    for i in range(20):
        run += abs(10 - i) / total if f"g{i}" in members else -1 / 16
        if abs(run) > abs(best):
            best, at = run, i + 1
    assert abs(row.es - best) < 1e-12 and row.peak_rank == at


def test_global_rank_with_one_hot_group(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), F.lit(1).alias("same"), "id")
    ranked = global_rank(df, ["k"], [F.col("same").desc(), F.col("id").asc()], "rank")
    bad = ranked.groupBy("k").agg(F.count("*").alias("n"), F.max("rank").alias("m"), F.countDistinct("rank").alias("d")).where("n <> m OR n <> d")
    assert bad.count() == 0
    assert [r.id for r in ranked.where("k = 'hot' AND rank <= 3").orderBy("rank").collect()] == [0, 3, 6]


def test_attributes_last_value_wins(spark):
    row = spark.createDataFrame([("Source Name: a b || sex = F ||; age: 1 || x || age:2;",)], "t string").select(tx.sample_attributes(F.col("t")).alias("m")).first()
    assert row.m == {"source_name": "a b", "sex": "F", "age": "2"}


def fit(spark, family, samples, clarity, risks, goal):
    df = spark.createDataFrame([(family, samples, clarity, risks, goal)], "f string, s long, c string, r array<string>, g string")
    f = rules.series_fit(F.col("g"), F.col("f"), F.col("s"), F.col("c"), F.col("r"))
    df = df.withColumn("fit", f)
    return df.select("fit.*", rules.usability(F.col("fit"), F.col("r"), F.col("c"), F.col("g")).alias("verdict")).first()


def test_recorded_series(spark):
    row = fit(spark, "bulk_rna_seq", 6, "high", [], "wgcna")
    assert row.verdict == "medium" and {"differential_expression", "validation"} <= set(row.usable_for) and {"wgcna", "machine_learning"} <= set(row.not_recommended_for)
    row = fit(spark, "microarray", 178, "partial", ["superseries", "multiple_tissues"], "wgcna")
    assert "wgcna" in row.not_recommended_for and "whole_series_interpretation" in row.not_recommended_for
    row = fit(spark, "bulk_rna_seq", None, "low", [], "general")
    assert "sample_count_unverified" in row.rationale


def test_recorded_study(spark):
    df = spark.createDataFrame([("differential_expression", "RNA-Seq", 6, [])], "g string, f string, s long, r array<string>")
    assert df.select(rules.study_fit(F.col("g"), F.col("f"), F.col("s"), F.col("r")).alias("x")).first().x.overall == "high"


def test_merge_fills_gaps_and_keeps_zero_apart(spark):
    schema = "query_ord int, query string, record_ord int, uid string, accession string, source_type string, summary string, organism string, title string, library_strategy string, library_layout string, platform string, bioproject string, biosample string, sample_count long, run_count long, run_accessions array<string>"
    rows = [(1, "a  b", 0, "1", "SRP1", "study", "", "", "t", "", "", "", "", "", 0, 5, ["SRR2"]), (2, "c", 0, "2", "SRP1", "study", "", "pig", "u", "", "", "", "P", "", 4, 1, ["SRR1", "SRR2"]), (1, "a b", 1, "3", "", "run", "", "", "", "", "", "", "", "", None, 0, [])]
    got = {r.record_key: r for r in di.merge_studies(spark.createDataFrame(rows, schema)).collect()}
    one = got["SRP1"]
    assert (one.title, one.organism, one.bioproject, one.sample_count, one.run_count, one.run_accessions, one.matched_queries) == ("t", "pig", "P", 4, 2, ["SRR1", "SRR2"], ["a b", "c"])
    assert (got["3"].sample_count, got["3"].run_count) == (None, 0)


def test_search_and_lessons(spark):
    docs = spark.createDataFrame(
        [("L1", "Nad6 lost", "x", "verified", "annotation", ["Insecta"], ["Reads"]), ("L2", "nad6 nad6", "y", "candidate", "annotation", ["Insecta"], ["reads"]), ("L3", "other", "nad6 é", "verified", "tool", ["Aves"], [])],
        "lesson_id string, title string, claim string, status string, domain string, taxa array<string>, data_types array<string>",
    )
    ids = lambda q, **k: [r.lesson_id for r in sr.search(docs, q, ["title", "claim"], key="lesson_id", **k).collect()]
    assert ids("nad6", taxon="insecta", data_type="reads") == ["L1"] and ids("!!!") == [] and ids("nad6", taxon="Mammalia") == []
    assert set(ids("nad6", status="all")) == {"L1", "L2", "L3"} and ids("é nad6") == ["L3"]
    reviews = spark.createDataFrame([("L2", "verified", "me", "ok"), ("L1", "verified", "me", "ok"), ("L9", "verified", "me", "ok")], "lesson_id string, to_status string, reviewer string, reason string")
    got = {r.lesson_id: r.state for r in lg.review_lessons(docs.withColumnRenamed("status", "validation_status"), reviews).collect()}
    assert got == {"L2": "accepted", "L1": "transition_refused", "L9": "unknown_lesson"}


def test_candidate_flow(spark):
    art = [("A1", "/c.fa", "h3")]
    inputs = spark.createDataFrame([("c", "I1", "assembly", "/a.fa", "h1", 5), ("c", "I2", "reads", "/r.fq", "h2", 9), ("c", "I3", "candidate", "/c.fa", "h3", 5)], "case_id string, id string, role string, path string, sha256 string, size long")
    events = spark.createDataFrame([("c", "E2", "completed", 0, ["run"], ["I1"], art), ("c", "E3", "completed", 0, ["run"], ["I2", "I3"], art)], "case_id string, id string, execution_status string, exit_code int, command array<string>, input_ids array<string>, artifacts array<struct<id:string,path:string,sha256:string>>")
    cands = spark.createDataFrame([("c", "R1", "sequence", "I1", "I3", "E2", "A1", "verified")], "case_id string, id string, change_type string, base_input_id string, candidate_input_id string, producer_event_id string, artifact_id string, status string")
    checks = spark.createDataFrame([("c", "R1", "E3", "pass")], "case_id string, candidate_id string, event_id string, result string")
    assert lg.candidate_violations(cands, checks, events, inputs).count() == 0 and lg.event_violations(events, inputs).count() == 0
    wrong = checks.withColumn("event_id", F.lit("E2"))
    assert {r.rule for r in lg.candidate_violations(cands, wrong, events, inputs).collect()} == {"candidate_not_checked", "pass_without_reads"}


def test_permuted_places_are_a_bijection_and_look_random(spark):
    draws = spark.range(1, 201).select(F.col("id").alias("perm"), F.explode(F.sequence(F.lit(0), F.lit(96))).alias("place")).withColumn("steps", en.permutation_steps(F.col("perm")))
    rows = draws.select("perm", "place", en.permuted_place(F.col("place"), F.lit(97), F.col("steps")).alias("x"))
    per = rows.groupBy("perm").agg(F.countDistinct("x").alias("d"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count_if(F.col("x") == F.col("place")).alias("fixed"))
    got = per.agg(F.min("d"), F.min("lo"), F.max("hi"), F.avg("fixed")).first()
    assert got[:3] == (97, 0, 96) and 0.6 < got[3] < 1.5
    spread = rows.groupBy("place").agg(F.avg("x").alias("m")).agg(F.min("m"), F.max("m")).first()
    assert 34 < spread[0] < spread[1] < 62  # 48 +- 4 standard errors
    one = spark.range(1).select(en.permuted_place(F.lit(0), F.lit(1), en.permutation_steps(F.lit(5))).alias("x")).first()
    assert one.x == 0


def test_permutation_p_values_of_signal_and_noise(spark):
    rng = random.Random(7)
    genes = [(c, f"g{i}", 3.0 - 6.0 * i / 399) for c in ("a", "b") for i in range(400)]
    ranked = en.rank_genes(spark.createDataFrame(genes, "contrast string, gene string, metric double"))
    sets = [("K", "K", "top", f"g{i}") for i in range(0, 60, 3)] + [("K", "K", "bottom", f"g{399 - i}") for i in range(0, 60, 3)]
    sets += [("K", "K", f"noise{k}", f"g{i}") for k in range(12) for i in rng.sample(range(400), 20)] + [("K", "K", "all", f"g{i}") for i in range(400)]
    frame = spark.createDataFrame(sets, "collection string, ontology string, term_id string, gene string")
    scores = en.enrichment_scores(en.running_sum(en.ranked_members(ranked, frame)))
    got = {(r.contrast, r.term_id): r for r in en.significance(scores, ranked, 400, looks=(50, 100)).collect()}
    assert set(t for _, t in got) == {"top", "bottom"} | {f"noise{k}" for k in range(12)}
    for c in "ab":
        top, bottom = got[c, "top"], got[c, "bottom"]
        assert top.draws == bottom.draws == 400 and top.null_beyond == bottom.null_beyond == 0 and top.nes > 2 > -2 > bottom.nes
        assert top.p_value == 1 / (top.null_n + 1) < 0.01
    noise = [r for (_, t), r in got.items() if t.startswith("noise")]
    assert min(r.p_value for r in noise) > 0.004 and any(r.draws < 400 and r.null_beyond >= 25 for r in noise) and all(r.draws == 400 or r.null_beyond >= 25 for r in noise)
    kept = en.significant_terms(spark.createDataFrame(list(got.values())), 0.05).select("term_id").distinct().collect()
    assert {r.term_id for r in kept} >= {"top", "bottom"} and len(kept) <= 5


def test_null_scores_equal_a_plain_walk(spark):
    genes = [("a", f"g{i:02}", float(30 - i) if i != 40 else -7.5) for i in range(60)]
    ranked = en.rank_genes(spark.createDataFrame(genes, "contrast string, gene string, metric double"))
    metric = {r["rank"]: r.metric for r in ranked.collect()}
    sizes = spark.createDataFrame([("a", 3), ("a", 11)], "contrast string, set_size long")
    got = {r.set_size: sorted(r.null_es) for r in en.null_scores(ranked, sizes, 1, 30).collect()}
    draws = spark.range(1, 31).select(F.col("id").alias("perm"), F.explode(F.sequence(F.lit(0), F.lit(10))).alias("place")).withColumn("steps", en.permutation_steps(F.col("perm")))
    places = {(r.perm, r.place): r.x + 1 for r in draws.select("perm", "place", en.permuted_place(F.col("place"), F.lit(60), F.col("steps")).alias("x")).collect()}
    for k in (3, 11):
        want = []
        for perm in range(1, 31):
            ranks = sorted(places[perm, j] for j in range(k))
            total, gained, values = sum(abs(metric[r]) for r in ranks), 0.0, []
            for i, r in enumerate(ranks):
                fall = (r - i - 1) / (60 - k)
                values.append(gained / total - fall)
                gained += abs(metric[r])
                values.append(gained / total - fall)
            want.append(max(values) if max(values[1::2]) > -min(values[::2]) else min(values))
        assert [round(x, 9) for x in got[k]] == [round(x, 9) for x in sorted(want)]


def test_batches_of_reviews_and_proposals_take_effect_in_order(spark):
    rng = random.Random(5)
    lessons = [(k, rng.choice(["candidate", "verified", "rejected", "superseded"])) for k in range(60)]
    sources = [(k, rng.choice(["ok", "ok", "changed", "unresolved"])) for k in range(50)]
    reviews = [(rng.randrange(64), o, rng.choice(["verified", "rejected", "deprecated", "withdrawn", "nonsense"]), rng.choice(["me", "me", "me", "\t "]), "why") for o in range(400)]
    status, state_of, want = dict(lessons), dict(sources), []
    for k, o, to, who, why in reviews:
        old = status.get(k)
        if old is None:
            state = "unknown_lesson"
        elif not who.strip():
            state = "incomplete_review"
        elif to not in lg.TRANSITIONS.get(old, ()):
            state = "transition_refused"
        elif to == "verified" and state_of.get(k, "ok") != "ok":
            state = "source_" + state_of[k]
        else:
            state, status[k] = "accepted", to
        want.append((k, o, state, status.get(k)))
    frames = spark.createDataFrame(lessons, "lesson_id int, validation_status string"), spark.createDataFrame(reviews, "lesson_id int, ord int, to_status string, reviewer string, reason string"), spark.createDataFrame(sources, "lesson_id int, source_state string")
    got = lg.review_batch(*frames)
    assert sorted((r.lesson_id, r.ord, r.state, r.new_status) for r in got.collect()) == sorted(want, key=lambda w: w[:2])
    assert {r.lesson_id: r.validation_status for r in lg.reviewed_table(frames[0], got).collect()} == status
    assert sum(w[2] == "accepted" for w in want) > 20

    existing = [(f"A{k}", f"h{k % 3}") for k in range(10)]
    proposals = [(o, rng.choice([None, *(f"A{k}" for k in range(20))]), f"h{rng.randrange(3)}") for o in range(200)]
    known, expected = dict(existing), []
    for o, a, h in proposals:
        expected.append((o, "new" if a is None or a not in known else "identical" if known[a] == h else "drift"))
        if a is not None:
            known.setdefault(a, h)
    base = spark.createDataFrame(existing, "accession string, file_sha256 string")
    done = lg.register_batch(base, spark.createDataFrame(proposals, "ord int, accession string, file_sha256 string"))
    assert sorted((r.ord, r.state) for r in done.collect()) == expected
    assert lg.registry_table(base, done).count() == 10 + sum(s == "new" for _, s in expected)


def test_white_space_of_any_kind_is_blank(spark):
    row = spark.createDataFrame([("\t x y\u00a0\r\n", "\u2003\t")], "a string, b string").select(tx.clean(F.col("a")).alias("a"), tx.clean(F.col("b")).alias("b"), tx.non_empty(F.array("a", "b")).alias("c")).first()
    assert (row.a, row.b, row.c) == ("x y", "", ["x y"])
