"""Gene-set enrichment: gene lists, identifier mapping, over-representation, rank-based enrichment.

Every operator works on many contrasts at once; `contrast` is always part of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from helixframe.functions.stats import hypergeometric_upper_tail, neg_log10
from helixframe.session import cut_lineage, global_rank

SET_KEYS = ["collection", "ontology", "term_id"]

# Adjustment method, p cut-off and q cut-off of each kind of collection.
COLLECTION_RULES = {"KEGG": ("none", 0.05, 1.0), "GO": ("BH", 0.05, 0.2)}


# -- gene lists ------------------------------------------------------------------------------------


def guess_gene_column(columns: list[str]) -> str:
    """First column whose name mentions gene or symbol, else the first column."""
    return next((c for c in columns if "gene" in c.lower() or "symbol" in c.lower()), columns[0])


def resolve_mode(mode: str, metric_col: str | None) -> str:
    """auto becomes gsea when a ranking metric is named, else ora; gsea without a metric is refused."""
    mode = mode.lower()
    if mode == "auto":
        return "gsea" if metric_col else "ora"
    if mode == "gsea" and not metric_col:
        raise ValueError("rank-based enrichment needs a metric column")
    return "gsea" if mode == "gsea" else "ora"


def present(gene: Column) -> Column:
    return gene.isNotNull() & (gene != "")


def significant_rows(de: DataFrame, p_col: str | None = "padj", cutoff: float = 0.05, gene_col: str = "gene") -> DataFrame:
    """Rows with p strictly below the cut-off and a usable gene; an absent p column keeps all rows."""
    if p_col and p_col in de.columns:
        de = de.where(F.expr(f"try_cast(`{p_col}` as double)") < cutoff)
    return de.where(present(F.col(gene_col)))


def significant_genes(de: DataFrame, p_col: str | None = "padj", cutoff: float = 0.05) -> DataFrame:
    return significant_rows(de, p_col, cutoff).select("contrast", "gene").distinct()


def gene_list_status(genes: DataFrame, contrasts: DataFrame, minimum: int = 5) -> DataFrame:
    """Number of genes per contrast and whether there are enough; a contrast without genes keeps its row."""
    counts = genes.groupBy("contrast").agg(F.countDistinct("gene").alias("genes"))
    return (
        contrasts.select("contrast").distinct().join(counts, "contrast", "left")
        .select("contrast", F.coalesce("genes", F.lit(0)).alias("genes"))
        .withColumn("status", F.when(F.col("genes") < minimum, "insufficient").otherwise("ok"))
    )


def detect_id_type(ids: DataFrame, sample: int = 30) -> DataFrame:
    """Identifier type per contrast from its first identifiers in `ord` order."""
    first = (
        ids.where(F.col("gene").isNotNull())
        .withColumn("_n", F.row_number().over(W.partitionBy("contrast").orderBy("ord", "gene")))
        .where(F.col("_n") <= sample)
    )
    checks = first.groupBy("contrast").agg(
        F.bool_and(F.col("gene").rlike("^[0-9]+$")).alias("digits"),
        F.bool_and(F.col("gene").rlike(r"^ENS[A-Z]*G[0-9]+(\.[0-9]+)?$")).alias("ensembl"),
    )
    # A contrast with no identifier at all passes the first test vacuously.
    return (
        ids.select("contrast").distinct().join(checks, "contrast", "left")
        .select(
            "contrast",
            F.when(F.coalesce("digits", F.lit(True)), "ENTREZID").when(F.col("ensembl"), "ENSEMBL").otherwise("SYMBOL").alias("id_type"),
        )
    )


def map_ids(genes: DataFrame, id_map: DataFrame, id_types: DataFrame) -> DataFrame:
    """Attach `entrez`: identity for ENTREZID contrasts, inner join otherwise (many-to-many kept)."""
    typed = genes.join(id_types, "contrast")
    same = typed.where(F.col("id_type") == "ENTREZID").withColumn("entrez", F.col("gene"))
    lookup = id_map.select(F.col("input").alias("gene"), "id_type", "entrez").distinct()
    mapped = typed.where(F.col("id_type") != "ENTREZID").join(lookup, ["gene", "id_type"])
    return same.unionByName(mapped).drop("id_type")


def mapping_rate(genes: DataFrame, mapped: DataFrame) -> DataFrame:
    """Distinct mapped identifiers over distinct inputs, in percent."""
    total = genes.groupBy("contrast").agg(F.countDistinct("gene").alias("inputs"))
    found = mapped.groupBy("contrast").agg(F.countDistinct("entrez").alias("mapped"))
    return total.join(found, "contrast", "left").select(
        "contrast", "inputs", F.coalesce("mapped", F.lit(0)).alias("mapped"),
        (F.coalesce("mapped", F.lit(0)) / F.col("inputs") * 100).alias("rate_pct"),
    )


def strongest_per_gene(de: DataFrame) -> DataFrame:
    """One row per (contrast, gene): the largest |metric|, first in `ord` order on ties."""
    usable = de.where(F.col("metric").isNotNull() & present(F.col("gene")))
    best = usable.groupBy("contrast", "gene").agg(
        F.min_by(F.struct("metric", "ord"), F.struct(-F.abs("metric"), F.col("ord"))).alias("b")
    )
    return best.select("contrast", "gene", "b.metric", "b.ord")


def metric_per_entrez(ranked: DataFrame, id_map: DataFrame, id_types: DataFrame) -> DataFrame:
    """Map symbols and keep the first occurrence per identifier in descending metric order."""
    mapped = map_ids(ranked, id_map, id_types)
    best = mapped.groupBy("contrast", "entrez").agg(
        F.min_by(F.struct("metric", "gene"), F.struct(-F.col("metric"), F.col("ord"))).alias("b")
    )
    return best.select("contrast", F.col("entrez").alias("gene"), "b.metric", F.col("b.gene").alias("symbol"))


def rank_genes(metrics: DataFrame) -> DataFrame:
    """1-based rank by descending metric, ties by gene."""
    return global_rank(metrics, ["contrast"], [F.col("metric").desc(), F.col("gene").asc()], "rank")


# -- over-representation ---------------------------------------------------------------------------


def set_members(sets: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """Distinct set memberships, restricted to the background genes when there are any."""
    members = sets.select(*SET_KEYS, "gene").distinct()
    return members if background is None else members.join(background.select("gene").distinct(), "gene", "left_semi")


def over_representation(
    genes: DataFrame,
    sets: DataFrame,
    background: DataFrame | None = None,
    min_size: int | None = 10,
    max_size: int | None = 500,
) -> DataFrame:
    """Raw over-representation per (contrast, term) with at least one gene of the list.

    `genes(contrast, gene)`; sizes are those inside the universe.  Terms outside the size bounds are left
    out before any adjustment, as the published method does.
    """
    members = set_members(sets, background)
    universe = members.groupBy("collection", "ontology").agg(F.countDistinct("gene").alias("universe_size"))
    sizes = members.groupBy(*SET_KEYS).agg(F.count("*").alias("set_size"))
    if min_size is not None:
        sizes = sizes.where(F.col("set_size") >= min_size)
    if max_size is not None:
        sizes = sizes.where(F.col("set_size") <= max_size)
    hits = genes.select("contrast", "gene").distinct().join(members, "gene")
    drawn = hits.groupBy("contrast", "collection", "ontology").agg(F.countDistinct("gene").alias("list_size"))
    # The gene list of a term is bounded by max_size: filter the terms before collecting.
    found = hits.join(sizes, SET_KEYS).groupBy("contrast", *SET_KEYS).agg(
        F.count("*").alias("count"), F.first("set_size").alias("set_size"), F.array_sort(F.collect_list("gene")).alias("gene_ids")
    )
    joined = found.join(drawn, ["contrast", "collection", "ontology"]).join(universe, ["collection", "ontology"])
    return joined.select(
        "contrast", *SET_KEYS, "count", "list_size", "set_size", "universe_size", "gene_ids",
        ((F.col("count") / F.col("list_size")) / (F.col("set_size") / F.col("universe_size"))).alias("fold_enrichment"),
        hypergeometric_upper_tail(F.col("count"), F.col("list_size"), F.col("set_size"), F.col("universe_size")).alias("p_value"),
    )


def adjust_p(terms: DataFrame, keys: list[str], method: Column, p: str = "p_value", lam: float = 0.05) -> DataFrame:
    """Add `p_adjust` (BH or none) and `q_value` within `keys`; rows are terms, already aggregated.

    The q value scales the BH value by the estimated share of true nulls (Storey, single lambda).
    """
    group = W.partitionBy(*keys)
    up = group.orderBy(F.col(p), F.col("term_id"))
    down = group.orderBy(F.col("_rn").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = terms.withColumn("_rn", F.row_number().over(up)).withColumn("_m", F.count("*").over(group))
    ranked = ranked.withColumn(
        "_pi0", F.least(F.lit(1.0), F.avg((F.col(p) >= lam).cast("double")).over(group) / (1 - lam))
    ).withColumn("_bh", F.min(F.col(p) * F.col("_m") / F.col("_rn")).over(down))
    return (
        ranked.withColumn("p_adjust", F.when(method == "BH", F.least(F.lit(1.0), F.col("_bh"))).otherwise(F.col(p)))
        .withColumn("q_value", F.least(F.lit(1.0), F.col("_pi0") * F.col("_bh")))
        .drop("_rn", "_m", "_pi0", "_bh")
    )


def by_collection(position: int, rules: dict | None = None) -> Column:
    """The rule value of a row's collection as a column."""
    rules = rules or COLLECTION_RULES
    value = None
    for name, rule in rules.items():
        test = F.col("collection") == name
        value = F.when(test, F.lit(rule[position])) if value is None else value.when(test, F.lit(rule[position]))
    return value


def enriched_terms(raw: DataFrame, rules: dict | None = None) -> DataFrame:
    """Adjust within (contrast, collection, ontology) and keep the terms inside every cut-off."""
    adjusted = adjust_p(raw, ["contrast", "collection", "ontology"], by_collection(0, rules))
    cut = by_collection(1, rules)
    kept = adjusted.where((F.col("p_value") <= cut) & (F.col("p_adjust") <= cut) & (F.col("q_value") <= by_collection(2, rules)))
    return kept.withColumn("log_p", neg_log10(F.col("p_adjust")))


def readable(terms: DataFrame, names: DataFrame) -> DataFrame:
    """Replace identifiers by symbols in `gene_ids`; unknown identifiers stay."""
    keys = ["contrast", *SET_KEYS]
    symbol = names.groupBy(F.col("entrez").alias("gene")).agg(F.min("input").alias("symbol"))
    listed = terms.select(*keys, F.explode("gene_ids").alias("gene")).join(symbol, "gene", "left")
    listed = listed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.coalesce("symbol", "gene"))).alias("gene_ids"))
    return terms.drop("gene_ids").join(listed, keys)


# -- tables behind the figures ---------------------------------------------------------------------


def top_terms(terms: DataFrame, n: int = 15, per_ontology: bool = True) -> DataFrame:
    """Best terms by adjusted p per ontology (or per collection)."""
    keys = ["contrast", "collection"] + (["ontology"] if per_ontology else [])
    order = W.partitionBy(*keys).orderBy("p_adjust", "term_id")
    return terms.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def plot_order(terms: DataFrame, keys: list[str] = ["contrast", "collection"]) -> DataFrame:
    """Vertical position: MF, CC, BP, then ascending fold enrichment."""
    level = F.when(F.col("ontology") == "MF", 1).when(F.col("ontology") == "CC", 2).when(F.col("ontology") == "BP", 3).otherwise(4)
    return terms.withColumn("y_num", F.row_number().over(W.partitionBy(*keys).orderBy(level, "fold_enrichment", "term_id")))


def fold_changes(terms: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per (term, gene with a metric); a term without any keeps one row with 0."""
    keys = ["contrast", *SET_KEYS]
    values = metrics.where(F.col("metric").isNotNull()).select("contrast", "gene", "metric")
    listed = terms.select(*keys, "log_p", F.explode("gene_ids").alias("gene")).join(values, ["contrast", "gene"], "left")
    found = listed.where(F.col("metric").isNotNull()).select(*keys, "log_p", "gene", F.col("metric").alias("gene_ratio"))
    empty = (
        listed.groupBy(*keys, "log_p").agg(F.count("metric").alias("_n")).where(F.col("_n") == 0)
        .select(*keys, "log_p", F.lit(None).cast("string").alias("gene"), F.lit(0.0).alias("gene_ratio"))
    )
    return found.unionByName(empty)


def group_extents(plotted: DataFrame) -> DataFrame:
    """Extent of each ontology block on the vertical axis."""
    return plotted.groupBy("contrast", "collection", "ontology").agg(
        F.min("y_num").alias("y_min"), F.max("y_num").alias("y_max"), F.avg("y_num").alias("y_mean")
    )


def barcode_rows(terms: DataFrame, per_category: int = 5, shown_genes: int = 10, show_n: int = 15) -> DataFrame:
    """Best terms per category over both collections with a shortened gene list."""
    shown = top_terms(terms.where(F.col("collection") == "KEGG"), show_n, per_ontology=False).unionByName(
        top_terms(terms.where((F.col("collection") == "GO") & F.col("ontology").isin("BP", "CC", "MF")), show_n)
    )
    shown = shown.withColumn("category", F.when(F.col("collection") == "KEGG", "KEGG").otherwise(F.col("ontology")))
    best = W.partitionBy("contrast", "category").orderBy(F.desc("log_p"), "term_id")
    kept = shown.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= per_category)
    level = F.array_position(F.array(*map(F.lit, ("BP", "CC", "MF", "KEGG"))), F.col("category"))
    down = W.partitionBy("contrast").orderBy(level.desc(), "log_p", "term_id")
    total = F.count("*").over(W.partitionBy("contrast"))
    return kept.select(
        "contrast", "category", "term_id", "log_p", F.col("count").alias("count_num"),
        F.array_join(F.slice("gene_ids", 1, shown_genes), "/").alias("genes_clean"),
        (total - F.row_number().over(down) + 1).alias("y_num"),
    )


def run_summary(terms: DataFrame, contrasts: DataFrame, mode: str) -> DataFrame:
    """One row per contrast with the number of terms found; contrasts without terms show zeros."""
    counts = terms.groupBy("contrast").agg(
        F.count_if(F.col("collection") == "KEGG").alias("kegg_terms"),
        F.count_if(F.col("collection") == "GO").alias("go_terms"),
        *[F.count_if((F.col("collection") == "GO") & (F.col("ontology") == o)).alias(f"count_{o.lower()}") for o in ("BP", "CC", "MF")],
    )
    names = ["kegg_terms", "go_terms", "count_bp", "count_cc", "count_mf"]
    return contrasts.select("contrast").distinct().join(counts, "contrast", "left").select(
        "contrast", F.lit(mode).alias("mode"), *[F.coalesce(n, F.lit(0)).alias(n) for n in names]
    )


# -- rank-based enrichment -------------------------------------------------------------------------


def ranked_members(ranked: DataFrame, sets: DataFrame, min_size: int = 10, max_size: int = 500) -> DataFrame:
    """Ranked genes of each set whose size inside the ranked list is within bounds."""
    members = ranked.select("contrast", "gene", "metric", "rank").join(sets.select(*SET_KEYS, "gene").distinct(), "gene")
    sizes = members.groupBy("contrast", *SET_KEYS).agg(F.count("*").alias("set_size"), F.sum(F.abs("metric")).alias("weight"))
    # The list's length joins the sets' sizes, not their members: a contrast may be most of the table.
    totals = ranked.groupBy("contrast").agg(F.count("*").alias("list_size"))
    sizes = sizes.where(F.col("set_size").between(min_size, max_size)).join(totals, "contrast")
    return members.join(sizes, ["contrast", *SET_KEYS])


def running_sum(hits: DataFrame, extra: list[str] = []) -> DataFrame:
    """Running sum just before and after every hit; between hits it only falls.

    A set as large as its list never falls; one without weight never rises.
    """
    order = W.partitionBy(*extra, "contrast", *SET_KEYS).orderBy("rank")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    weight = F.abs("metric")
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    fall = share(F.col("rank") - F.row_number().over(order), F.col("list_size") - F.col("set_size"))
    gained = F.sum(weight).over(upto)
    return hits.withColumn("after", share(gained, F.col("weight")) - fall).withColumn("before", share(gained - weight, F.col("weight")) - fall)


def enrichment_scores(curve: DataFrame, extra: list[str] = []) -> DataFrame:
    """Extreme of the running sum by absolute value, and the rank where it is reached."""
    peaks = curve.groupBy(*extra, "contrast", *SET_KEYS).agg(
        F.first("set_size").alias("set_size"),
        F.max("after").alias("_top"), F.min("before").alias("_low"),
        F.max_by("rank", F.struct("after", -F.col("rank"))).alias("_top_rank"),
        F.min_by("rank", F.struct("before", "rank")).alias("_low_rank"),
    )
    positive = F.col("_top") > -F.col("_low")
    return peaks.select(
        *extra, "contrast", *SET_KEYS, "set_size",
        F.when(positive, F.col("_top")).otherwise(F.col("_low")).alias("es"),
        F.when(positive, F.col("_top_rank")).otherwise(F.col("_low_rank")).alias("peak_rank"),
    )


# Fixed values of the seeded draws: a Mersenne prime, multipliers and increments below it.
PRIME, HALF, TIMES, PLUS, SQUARE = 2147483647, 1073741824, 1103515245, 12345, 69069
#: Mixing rounds of one permutation; a rank keeps its place with a probability of about 2^-SWAPS beyond chance.
SWAPS = 16


def mixed(u: Column | int) -> Column:
    """A pseudo-random number below PRIME for a number below PRIME, by integer arithmetic that stays below 2^63."""
    a = (u * TIMES + PLUS) % PRIME
    return (a * a + u * SQUARE + 1) % PRIME


def permutation_steps(perm: Column) -> Column:
    """Keys of the steps of permutation `perm`."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(SWAPS - 1)),
        lambda r: F.struct(*[mixed((perm * SWAPS + r).cast("bigint") * 3 + i).alias(name) for i, name in enumerate("kab")]),
    )


def permuted_place(place: Column, n: Column, steps: Column) -> Column:
    """Place (0 to n - 1) that a permutation gives to `place`, computed in the row from its `permutation_steps`.

    A chain of swap-or-not steps: each step pairs x with key - x (modulo n) and swaps the pair by a bit of the larger
    one, so the chain is a bijection of 0..n-1 for every n, without sorting or storing a permutation.
    """

    def step(x: Column, r: Column) -> Column:
        other = (r["k"] % n - x + n) % n
        return F.when((r["a"] * F.greatest(x, other) + r["b"]) % PRIME >= HALF, other).otherwise(x)

    return F.coalesce(F.aggregate(steps, place.cast("bigint"), step), F.lit(0))


def null_scores(ranked: DataFrame, sizes: DataFrame, first: int, last: int) -> DataFrame:
    """(contrast, set_size, null_es): scores of random sets of each size, one for each permutation from `first` to `last`.

    The null of a set depends on its size alone, so sets of one size share it: in a permutation, the random set of size k holds the
    genes at the first k permuted places.  Only as many places as the largest set has are drawn, whatever the length of the
    list, and each is looked up by (contrast, rank).  Arrays hold at most that many places, or one score for each permutation.
    """
    lists = ranked.groupBy("contrast").agg(F.count("*").alias("list_size"))
    wanted = sizes.groupBy("contrast").agg(F.collect_set("set_size").alias("sizes"), F.max("set_size").alias("most")).join(lists, "contrast")
    # Work grows with permutations, not with bytes: they are dealt to as many tasks as there are cores, at least.
    tasks = max(ranked.sparkSession.sparkContext.defaultParallelism, 8)
    draws = wanted.select("contrast", "list_size", "most", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("perm")).repartition(tasks, "contrast", "perm")
    draws = draws.withColumn("steps", permutation_steps(F.col("perm")))
    places = draws.select("contrast", "perm", "list_size", "steps", F.explode(F.sequence(F.lit(1), F.col("most").cast("int"))).alias("place"))
    rank = permuted_place(F.col("place") - 1, F.col("list_size"), F.col("steps")) + 1
    places = places.select("contrast", "perm", "place", rank.alias("rank"))
    found = places.join(ranked.select("contrast", F.col("rank").cast("bigint").alias("rank"), F.abs("metric").alias("w")), ["contrast", "rank"])
    listed = found.repartition(tasks, "contrast", "perm").groupBy("contrast", "perm").agg(F.sort_array(F.collect_list(F.struct("rank", "place", "w"))).alias("drawn"))
    each = listed.join(wanted.select("contrast", "list_size", "sizes"), "contrast").withColumn("set_size", F.explode("sizes"))
    inside = each.select("contrast", "perm", "set_size", "list_size", F.filter("drawn", lambda d: d["place"] <= F.col("set_size")).alias("hits"))
    inside = inside.withColumn("weight", F.aggregate("hits", F.lit(0.0), lambda a, d: a + d["w"]))
    start = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("gained"), F.lit(float("-inf")).alias("top"), F.lit(float("inf")).alias("low"))

    share = lambda part: F.coalesce(F.try_divide(part, F.col("weight")), F.lit(0.0))

    def walk(a: Column, d: Column) -> Column:
        fall = (d["rank"] - a["i"] - 1) / (F.col("list_size") - F.col("set_size"))
        gained = a["gained"] + d["w"]
        return F.struct(
            (a["i"] + 1).alias("i"), gained.alias("gained"),
            F.greatest(a["top"], share(gained) - fall).alias("top"),
            F.least(a["low"], share(a["gained"]) - fall).alias("low"),
        )

    peaks = inside.withColumn("peak", F.aggregate("hits", start, walk))
    es = F.when(F.col("peak.top") > -F.col("peak.low"), F.col("peak.top")).otherwise(F.col("peak.low"))
    return peaks.groupBy("contrast", "set_size").agg(F.collect_list(es).alias("null_es"))


def significance(scores: DataFrame, ranked: DataFrame, permutations: int = 1000, stop: int = 25, looks: tuple[int, ...] = (100, 300), method: str = "BH") -> DataFrame:
    """Normalised score, permutation p and adjusted p of each term.

    p = (b + 1) / (s + 1), where s of the null scores drawn have the term's sign and b of them are at least as extreme.
    Drawing is sequential: after the permutations named in `looks`, terms with b >= stop are done (their p is far from
    small and known well enough), and only the sizes of the others are drawn on, up to `permutations`.  `draws` tells how many a
    term saw.  Sets as large as their list have no score beyond chance and are left out.
    """
    keys = ["contrast", *SET_KEYS]
    lists = ranked.groupBy("contrast").agg(F.count("*").alias("list_size"))
    zero = {"null_n": F.lit(0).cast("bigint"), "null_beyond": F.lit(0).cast("bigint"), "null_sum": F.lit(0.0), "draws": F.lit(0)}
    tied = lambda x: F.abs(F.round(x, 10))  # noqa: E731  equal scores may differ by the order of their sums
    open_terms = cut_lineage(scores.join(lists, "contrast").where("set_size < list_size").drop("list_size").withColumns(zero))
    done, first = None, 1
    for last in [*[look for look in looks if look < permutations], permutations]:
        null = null_scores(ranked, open_terms.select("contrast", "set_size").distinct(), first, last)
        same = F.filter("null_es", lambda x: F.signum(x) == F.signum("es"))
        seen = open_terms.join(null, ["contrast", "set_size"]).withColumn("_same", same)
        seen = seen.withColumns({
            "null_n": F.col("null_n") + F.size("_same"),
            "null_beyond": F.col("null_beyond") + F.size(F.filter("_same", lambda x: tied(x) >= tied(F.col("es")))),
            "null_sum": F.col("null_sum") + F.aggregate("_same", F.lit(0.0), lambda a, x: a + F.abs(x)),
            "draws": F.lit(last),
        })
        seen = seen.drop("null_es", "_same")
        if last < permutations:
            seen = cut_lineage(seen)
            finished = seen.where(F.col("null_beyond") >= stop)
            open_terms = seen.where(F.col("null_beyond") < stop)
        else:
            finished = seen
        done = finished if done is None else done.unionByName(finished)
        first = last + 1
    stats = done.withColumn("nes", F.col("es") / F.expr("try_divide(null_sum, null_n)")).withColumn("p_value", (F.col("null_beyond") + 1) / (F.col("null_n") + 1))
    return adjust_p(stats.drop("null_sum"), ["contrast", "collection", "ontology"], F.lit(method)).select(*keys, "set_size", "es", "peak_rank", "nes", "p_value", "p_adjust", "q_value", "null_n", "null_beyond", "draws")


def significant_terms(results: DataFrame, cutoff: float = 0.05) -> DataFrame:
    """Terms whose p and adjusted p are both within the cut-off (inclusive); terms without p never are."""
    return results.where((F.col("p_value") <= cutoff) & (F.col("p_adjust") <= cutoff))


def best_terms(results: DataFrame, n: int) -> DataFrame:
    """The n best terms of each contrast and collection with their position: by adjusted p, then the larger normalised score, then id."""
    order = W.partitionBy("contrast", "collection").orderBy("p_adjust", F.abs("nes").desc_nulls_last(), "term_id")
    return results.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def ridge_input(best: DataFrame, hits: DataFrame) -> DataFrame:
    """Leading-edge genes of the best terms with their metric."""
    keys = ["contrast", *SET_KEYS]
    return leading_edge(best, hits.join(best.select(*keys), keys, "left_semi")).join(best.select(*keys, "position"), keys)


def score_curves(best: DataFrame, hits: DataFrame) -> DataFrame:
    """Running sum before and after every hit of the best terms, `hits` being `ranked_members`."""
    keys = ["contrast", *SET_KEYS]
    return running_sum(hits.join(best.select(*keys), keys, "left_semi")).join(best.select(*keys, "position"), keys)


def top_by_sign(results: DataFrame, n: int = 15) -> DataFrame:
    """Best terms among the activated and among the suppressed ones; pass `significant_terms` to rank only those."""
    signed = results.withColumn("sign", F.when(F.col("nes") > 0, "activated").otherwise("suppressed"))
    order = W.partitionBy("contrast", "collection", "sign").orderBy("p_adjust", "term_id")
    return signed.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def leading_edge(scores: DataFrame, hits: DataFrame) -> DataFrame:
    """Genes up to the peak (positive score) or from the trough on (negative score), with their metric."""
    keys = ["contrast", *SET_KEYS]
    joined = hits.select(*keys, "gene", "metric", "rank").join(scores.select(*keys, "es", "peak_rank"), keys)
    inside = F.when(F.col("es") > 0, F.col("rank") <= F.col("peak_rank")).otherwise(F.col("rank") >= F.col("peak_rank"))
    return joined.where(inside).drop("peak_rank")


