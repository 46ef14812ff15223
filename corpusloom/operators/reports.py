"""Distribution, run and pool reports.  Every report is one or two map-side-combined groupings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T
from corpusloom.operators.ranking import profile_by_value, top_k
from corpusloom.sources.storage import materialized


def _label(c: str, blank: str | None) -> Column:
    """Null (or, with ``blank``, also '') becomes the replacement."""
    col = F.col(c).cast("string")
    if blank is None:
        return F.coalesce(col, F.lit("unknown"))
    return F.when(T.or_empty(col) == "", F.lit(blank)).otherwise(col)


def grouping_counts(df: DataFrame, dims: dict[str, Column], extra: list[Column] | None = None, inputs: tuple[str, ...] = ()) -> DataFrame:
    """(dim, value, n, ...): counts of several dimensions and of all rows in one pass.

    GROUPING SETS over narrow dimension columns: partial counts combine before
    the single shuffle.  ``extra`` aggregates read the columns named in ``inputs``.
    """
    names = list(dims)
    flat = df.select(*[c.alias(f"d_{i}") for i, c in enumerate(dims.values())], *[F.col(c) for c in inputs])
    cols = [f"d_{i}" for i in range(len(names))]
    sets = [[F.col(c)] for c in cols] + [[]]
    which = F.lit("total")
    value = F.lit("all")
    for i, n in enumerate(names):
        hit = F.grouping(cols[i]) == 0
        which = F.when(hit, n).otherwise(which)
        value = F.when(hit, F.col(cols[i])).otherwise(value)
    return flat.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        which.alias("dim"), value.alias("value"), F.count("*").alias("n"), *(extra or [])
    ).drop(*cols)


SUMMARY_DIMS = {
    "l1_scene": None, "l2_scene_label": None, "application_type": None, "product_type": None,
    "target_complexity": None, "complexity_level": "unknown", "design_style": "unspecified",
    "persona_source": "unspecified",
}


def corpus_summary(df: DataFrame, dims: dict[str, str | None] = SUMMARY_DIMS, score: str = "quality_score") -> DataFrame:
    """Counts per dimension, total, and mean score (a null score counts as 0)."""
    mean = T.round_to(F.avg(F.coalesce(F.col(score), F.lit(0.0))), 2).alias("mean_score")
    return grouping_counts(df, {d: _label(d, b) for d, b in dims.items()}, [mean], (score,))


def confusion(df: DataFrame, target: str, actual: str) -> DataFrame:
    pair = F.concat(_label(target, "unknown"), F.lit(" -> "), _label(actual, "unknown"))
    return df.groupBy(pair.alias("pair")).agg(F.count("*").alias("n"))


def complexity_stats(df: DataFrame, target: str, text: str, score: str, passed: str) -> DataFrame:
    """Pass / fail, pass %, mean score and min / max / upper-median words per complexity."""
    ok = F.coalesce(F.col(passed).cast("boolean"), F.lit(False))
    rows = df.select(
        _label(target, "unknown").alias("complexity"), T.word_count(F.col(text)).alias("words"),
        F.coalesce(F.col(score), F.lit(0.0)).alias("score"), ok.alias("ok"),
    )
    folded = rows.groupBy("complexity", "words").agg(
        F.count("*").alias("w"), F.count_if("ok").alias("p"), F.sum("score").alias("s")
    )
    aggs = [
        F.sum("p").alias("passed"), (F.sum("w") - F.sum("p")).alias("failed"), F.sum("w").alias("total"),
        T.round_to(F.sum("s") / F.sum("w"), 2).alias("avg_score"), F.min("words").alias("wc_min"), F.max("words").alias("wc_max"),
        T.round_to(F.sum("p") * 100 / F.sum("w"), 1).alias("pass_pct"),
    ]
    return profile_by_value(folded, ["complexity"], "words", "w", {"wc_p50": 0.5}, aggs)


def pass_by_dimension(df: DataFrame, style: str, l1: str, passed: str, persona_source: str) -> DataFrame:
    """Pass / fail per style and per L1, and persona fallbacks, in one pass."""
    ok = F.coalesce(F.col(passed).cast("boolean"), F.lit(False))
    rows = df.select(
        _label(style, "none").alias("style"), _label(l1, "unknown").alias("l1"), ok.alias("ok"),
        F.coalesce(F.col(persona_source).isin("fallback", "persona-fallback"), F.lit(False)).alias("fb"),
    )
    return grouping_counts(
        rows, {"design_style": F.col("style"), "l1_scene": F.col("l1")},
        [F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"), F.count_if("fb").alias("fallbacks")], ("ok", "fb"),
    )


def score_histogram(df: DataFrame, score: str, low: float = 1.0, high: float = 5.0, step: float = 0.5) -> DataFrame:
    """Buckets of ``step`` on [low, high] with clamped ends; empty buckets are listed."""
    n = round((high - low) / step)
    value = F.when(F.coalesce(F.col(score), F.lit(0.0)) == 0, F.lit(low)).otherwise(F.col(score))
    bucket = F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((value - low) / step))).cast("long")
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(n).select(F.col("id").alias("bucket"))
    return frame.join(counts, "bucket", "left").select(
        "bucket", T.round_to(F.lit(low) + F.col("bucket") * step, 2).alias("lo"),
        T.round_to(F.lit(low) + (F.col("bucket") + 1) * step, 2).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def word_histogram(df: DataFrame, text: str, passed: str, width: int = 25) -> DataFrame:
    ok = F.coalesce(F.col(passed).cast("boolean"), F.lit(False))
    bucket = F.floor(T.word_count(F.col(text)) / width).cast("long")
    return df.groupBy(bucket.alias("bucket")).agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"))


# fixed values: names and upper bounds of the word-count ranges
WORD_RANGES = [
    ("<40", 40), ("40-49", 50), ("50-59", 60), ("60-69", 70), ("70-79", 80), ("80-89", 90), ("90-99", 100), ("100+", None),
]


def named_ranges(words: Column, ranges=WORD_RANGES) -> Column:
    chain = None
    for name, upper in ranges:
        if upper is None:
            return chain.otherwise(name)
        chain = F.when(words < upper, name) if chain is None else chain.when(words < upper, name)
    return chain


def range_histogram(df: DataFrame, group: str, text: str, ranges=WORD_RANGES) -> DataFrame:
    rows = df.select(group, T.word_count(F.col(text)).alias("_words"))  # a column: every range asks for it
    return rows.groupBy(group, named_ranges(F.col("_words"), ranges).alias("word_range")).agg(F.count("*").alias("n"))


def batch_stats(df: DataFrame, level: str, words: Column, persona_source: str, ms: str) -> DataFrame:
    """Per complexity: rows, words avg / min / max, persona status counts, mean seconds."""
    src = F.col(persona_source)
    return df.groupBy(F.col(level).alias("complexity")).agg(
        F.count("*").alias("n"), T.round_to(F.avg(words), 1).alias("avg_words"), F.min(words).alias("min_words"),
        F.max(words).alias("max_words"), F.count_if(src == "llm_persona_synthesis").alias("persona_ok"),
        F.count_if(src == "llm_persona_synthesis_parse_failed").alias("persona_parse_failed"),
        F.count_if(src == "deterministic_persona_fallback").alias("persona_fallback"),
        T.round_to(F.sum(F.coalesce(F.col(ms), F.lit(0.0))) / F.count("*") / 1000, 4).alias("avg_seconds"),
    )


def run_summary(df: DataFrame, l1: str, words: str, score: str, passed: str, error: str) -> DataFrame:
    """Successes, failures, mean words of successes, pass rate of scored rows; per L1 and total."""
    ok = F.col(error).isNull()
    scored = ok & F.col(score).isNotNull()
    measures = [
        F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"),
        T.round_half_up(F.coalesce(F.avg(F.when(ok, F.col(words))), F.lit(0.0))).alias("avg_words"),
        F.count_if(scored).alias("scored"),
        F.count_if(scored & F.col(passed)).alias("pass_count"),
        T.round_to(F.count_if(scored & F.col(passed)) / F.count_if(scored), 6).alias("pass_rate"),
        T.round_to(F.avg(F.when(scored, F.col(score))), 2).alias("avg_score"),
    ]
    return df.groupingSets([[F.col(l1)], []], F.col(l1)).agg(
        F.when(F.grouping(l1) == 1, "all").otherwise(F.col(l1)).alias("scope"), *measures
    ).drop(l1)


def method_stats(df: DataFrame, method: str, value: str, passed: Column, valid: Column) -> DataFrame:
    """Mean, population standard deviation, min, max and pass count of valid rows."""
    return df.filter(valid).groupBy(F.col(method).alias("method")).agg(
        F.count("*").alias("n"), T.round_to(F.avg(value), 2).alias("mean"), T.round_to(F.stddev_pop(value), 2).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.count_if(passed).alias("pass_count"),
    )


def run_comparison(df: DataFrame, run: str, level: str, text: str) -> DataFrame:
    """Words per complexity, unique first sentences and separation score per run; best run flagged."""
    rows = df.select(
        F.col(run).alias("run"), F.col(level).alias("level"), T.word_count(F.col(text)).alias("w"),
        T.lead_fingerprint(F.col(text)).alias("fp"),
    )
    rows = materialized(rows, "runs")  # narrow; the texts are parsed once
    leads = rows.groupBy("run", "fp").agg(F.count("*").alias("c")).groupBy("run").agg(
        F.count("*").alias("unique_leads"), F.sum("c").alias("total")
    )
    avgs = rows.groupBy("run").agg(
        *[F.coalesce(F.avg(F.when(F.col("level") == c, F.col("w"))), F.lit(0.0)).alias(f"_{c}") for c in fv.COMPLEXITY_LEVELS]
    )
    score = F.when(F.col("_medium") > 0, T.round_to((F.col("_complex") - F.col("_vague")) / F.col("_medium"), 2)).otherwise(0.0)
    out = avgs.select("run", *[T.round_to(F.col(f"_{c}"), 4).alias(f"avg_{c}") for c in fv.COMPLEXITY_LEVELS], score.alias("separation"))
    best = out.select(F.min_by("run", F.struct(-F.col("separation"), "run"))).scalar()
    return out.join(leads, "run").withColumn("is_best", F.col("run") == best)


def uniqueness_summary(df: DataFrame, text: str, app_type: str, source: str) -> DataFrame:
    """Per source and total: rows, unique texts, unique ratio, distinct application types."""
    rows = df.select(F.col(source).alias("s"), F.xxhash64(text).alias("h1"), F.md5(text).alias("h2"), F.col(app_type).alias("a"))
    rows = materialized(rows, "texts")  # narrow; the texts are hashed once
    texts = rows.groupBy("s", "h1", "h2").agg(F.count("*").alias("c"))
    # a text may occur under several sources: the total folds across them
    whole = texts.groupBy("h1", "h2").agg(F.sum("c").alias("c"))
    per = texts.groupBy(F.col("s").alias("scope")).agg(F.sum("c").alias("rows"), F.count("*").alias("unique_texts"))
    total = whole.agg(F.sum("c").alias("rows"), F.count("*").alias("unique_texts")).select(F.lit("all").alias("scope"), "*")
    apps = rows.select("s", "a").distinct()
    apps_per = apps.groupBy(F.col("s").alias("scope")).agg(F.count("a").alias("app_types"))
    apps_all = apps.agg(F.count_distinct("a").alias("app_types")).select(F.lit("all").alias("scope"), "*")
    return per.unionByName(total).join(apps_per.unionByName(apps_all), "scope").withColumn(
        "unique_ratio", T.ratio(F.col("unique_texts"), F.col("rows"), 4)
    )


def prompt_summary(records: DataFrame, scenes: DataFrame, text: str, app_type: str, target: str) -> DataFrame:
    """One row: prompts, unique prompts and their ratio, the sum of scene targets, distinct application types."""
    rows = records.select(F.xxhash64(text).alias("h1"), F.md5(text).alias("h2"), F.col(app_type).alias("a"))
    texts = rows.groupBy("h1", "h2").agg(F.count("*").alias("c")).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_prompts"), F.count("*").alias("unique_prompts")
    )
    apps = rows.select("a").distinct().agg(F.count("a").alias("application_types"))
    wanted = scenes.agg(F.coalesce(F.sum(F.coalesce(F.col(target).cast("double"), F.lit(0.0))), F.lit(0.0)).alias("target_sum"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    joined = one(texts).join(one(apps), "_one").join(one(wanted), "_one").drop("_one")
    return joined.withColumn("unique_ratio", T.ratio(F.col("unique_prompts"), F.col("total_prompts"), 4))


def pair_counts(df: DataFrame, first: str, second: str, missing: str = "(none)") -> DataFrame:
    """Rows per (first, second), missing values by name."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in (first, second)]
    return df.select(*named).groupBy(first, second).agg(F.count("*").alias("n"))


def counts_by(df: DataFrame, group: str, columns: dict[str, str], missing: str = "(none)") -> DataFrame:
    """(group, dimension, value, n): value counts of several columns per group, in one pass."""
    cells = F.array(*[F.struct(F.lit(k).alias("dimension"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("value")) for k, c in columns.items()])
    rows = df.select(F.coalesce(F.col(group).cast("string"), F.lit(missing)).alias(group), F.explode(cells).alias("c"))
    return rows.groupBy(group, "c.dimension", "c.value").agg(F.count("*").alias("n"))


# --- topic pools -------------------------------------------------------------------


def _usage(records: DataFrame, l2: str, topic: str, extra: list[str]) -> DataFrame:
    return records.groupBy(*extra, F.col(l2).alias("l2"), F.col(topic).alias("topic")).agg(F.count("*").alias("uses"))


def pool_capacity(pool: DataFrame, records: DataFrame, target: int, l2: str = "l2", topic: str = "topic", by: tuple[str, ...] = ()) -> DataFrame:
    """Per L2 (and the columns ``by`` of both sides, such as the platform): pool size, cumulative queries, distinct in-pool topics used, mean reuse, gap.

    Mean reuse divides all queries of the L2 (off-pool ones too) by the distinct
    in-pool topics.
    """
    keys = [*by, "l2"]
    distinct_pool = pool.select(*keys, "topic").distinct()
    sizes = distinct_pool.groupBy(*keys).agg(F.count("topic").alias("pool_size"))
    used = _usage(records, l2, topic, list(by)).join(distinct_pool.withColumn("inp", F.lit(1)), [*keys, "topic"], "left")
    agg = used.groupBy(*keys).agg(F.sum("uses").alias("cum"), F.count("inp").alias("dis"))
    return sizes.join(agg, keys, "left").select(
        *keys, "pool_size", F.coalesce("cum", F.lit(0)).alias("cum_queries"), F.coalesce("dis", F.lit(0)).alias("distinct_used"),
        T.ratio(F.coalesce("cum", F.lit(0)), F.coalesce("dis", F.lit(0)), 2).alias("reuse_avg"),
        F.greatest(F.lit(0).cast("long"), F.lit(target) - F.col("pool_size")).alias("gap"),
    ).orderBy(F.desc("reuse_avg"), "l2")


def pool_capacity_totals(capacity: DataFrame, target: int, by: tuple[str, ...] = ()) -> DataFrame:
    return capacity.groupBy(*by).agg(
        F.count("*").alias("l2_count"), F.sum("pool_size").alias("current_topics"),
        (F.count("*") * target).alias("target_topics"), F.sum("gap").alias("total_gap"),
        F.count_if(F.col("cum_queries") > F.col("pool_size")).alias("over_subscribed"),
    )


def pool_consumption(pool: DataFrame, records: DataFrame, platform: str, topic: str) -> DataFrame:
    """Per platform: in/off-pool topics and uses, coverage, reuse histogram, mean in-pool reuse."""
    topics = pool.select(F.col("topic")).filter("topic IS NOT NULL").distinct()
    size = topics.agg(F.count("*")).scalar()
    used = records.groupBy(F.col(platform).alias("platform"), F.col(topic).alias("topic")).agg(F.count("*").alias("uses"))
    used = used.join(topics.withColumn("inp", F.lit(True)), "topic", "left").withColumn("inp", F.coalesce("inp", F.lit(False)))
    inp, uses = F.col("inp"), F.col("uses")
    reuse = [F.count_if(inp & (uses == k)).alias(f"reuse_{k}") for k in range(1, 5)]
    return used.groupBy("platform").agg(
        F.count_if(inp).alias("in_pool_distinct"), F.count_if(~inp).alias("off_pool_distinct"),
        F.sum(F.when(inp, uses).otherwise(0)).alias("in_pool_uses"), F.sum(F.when(inp, 0).otherwise(uses)).alias("off_pool_uses"),
        *reuse, F.count_if(inp & (uses >= 5)).alias("reuse_5_plus"),
    ).select(
        "*", size.alias("pool_size"), T.ratio(F.col("in_pool_distinct"), size).alias("coverage"),
        T.ratio(F.col("in_pool_uses"), F.col("in_pool_distinct")).alias("avg_reuse"),
    )


def pool_depletion(pool: DataFrame, records: DataFrame, l2: str, topic: str) -> DataFrame:
    """Per L2: distinct in-pool topics used, their uses, coverage."""
    cells = pool.select("l2", "topic").distinct()  # a null topic marks an empty cell
    joined = cells.join(_usage(records, l2, topic, []), ["l2", "topic"], "left")
    return joined.groupBy("l2").agg(
        F.count("topic").alias("pool_size"), F.count("uses").alias("distinct_used"), F.coalesce(F.sum("uses"), F.lit(0)).alias("uses")
    ).withColumn("coverage", T.ratio(F.col("distinct_used"), F.col("pool_size")))


def top_reused(pool: DataFrame, records: DataFrame, platform: str, topic: str, k: int = 20) -> DataFrame:
    """The k most used in-pool topics of each platform."""
    counts = records.groupBy(F.col(platform).alias("platform"), F.col(topic).alias("topic")).agg(F.count("*").alias("uses"))
    inside = counts.join(pool.select("topic").distinct(), "topic", "left_semi")
    return top_k(inside, ["platform"], [F.desc("uses"), F.asc("topic")], k)


def pool_size_stats(pool: DataFrame) -> DataFrame:
    per = pool.groupBy("l2").agg(F.count("topic").alias("c"))
    return per.agg(
        F.count("*").alias("l2_count"), F.sum("c").alias("total_topics"), F.min("c").alias("min_topics"),
        F.max("c").alias("max_topics"), T.round_to(F.avg("c"), 4).alias("avg_topics"),
    )


def update_usage(state: DataFrame, records: DataFrame, l2: str, topic: str) -> DataFrame:
    """Add the counts of finished records to the usage state (l2, topic, uses)."""
    fresh = _usage(records.filter(T.or_empty(F.col(topic).cast("string")) != ""), l2, topic, [])
    return state.select("l2", "topic", "uses").unionByName(fresh).groupBy("l2", "topic").agg(F.sum("uses").alias("uses"))


def crosstab(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    wide = df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1)))
    return wide.select(row, *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


# --- rank fusion, bands, partitions, coverage ----------------------------------------


def borda_fusion(ranked: DataFrame, voter: str, item: str, rank: str, k: int = 50) -> DataFrame:
    """Sum of (list length - rank) over lists; best k re-ranked."""
    sizes = ranked.groupBy(voter).agg(F.count("*").alias("_n"))
    points = ranked.join(sizes, voter).groupBy(F.col(item).alias("item")).agg(F.sum(F.col("_n") - F.col(rank)).alias("borda_score"))
    best = points.orderBy(F.desc("borda_score"), "item").limit(k)
    # at most k rows from here on
    return best.withColumn("borda_rank", F.row_number().over(Window.orderBy(F.desc("borda_score"), "item")).cast("long"))


def quality_band(score: Column) -> Column:
    return (
        F.when(score >= 4.0, "excellent").when(score >= 3.0, "good").when(score >= fv.QUARANTINE_SCORE, "acceptable").otherwise("quarantine")
    )


def quality_report(df: DataFrame, score: str) -> DataFrame:
    """Bands, mean and pass rate over scored rows (a score of 0 or null is unscored)."""
    s = F.col(score)
    scored = F.coalesce(s, F.lit(0.0)) != 0
    band = quality_band(s)
    names = ("excellent", "good", "acceptable", "quarantine")
    return df.agg(
        F.count("*").alias("total"), F.count_if(scored).alias("scored"),
        *[F.count_if(scored & (band == b)).alias(b) for b in names],
        T.round_to(F.avg(F.when(scored, s)), 6).alias("avg_score"),
        T.ratio(F.count_if(scored & (s >= fv.QUARANTINE_SCORE)), F.count_if(scored)).alias("pass_rate"),
    )


def split_by_quality(df: DataFrame, score: str, threshold: float = fv.QUARANTINE_SCORE) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined); a missing score counts as 0."""
    s = F.coalesce(F.col(score), F.lit(0.0))
    return df.filter(s >= threshold), df.filter(s < threshold)


def coverage_matrix(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    return crosstab(df.withColumn(col, _label(col, "none")), row, col, values)


def partition_index(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), T.round_to(F.avg(score), 6).alias("avg_score"))


def taxonomy_violations(df: DataFrame, l1: str, l2: str, l3: str, min_l1: int = 15, min_l2: int = 4, min_l3: int = 3) -> DataFrame:
    """Coverage rules that fail: too few L1, L2 per L1, or L3 per L2."""
    leaves = df.select(F.col(l1).alias("a"), F.col(l2).alias("b"), F.col(l3).alias("c")).distinct()
    per_l2 = leaves.groupBy("a", "b").agg(F.count("*").alias("n"))
    per_l1 = per_l2.groupBy("a").agg(F.count("*").alias("n"))
    rules = [
        per_l2.filter(F.col("n") < min_l3).select(F.lit("l3_per_l2").alias("rule"), F.concat_ws("/", "a", "b").alias("node"), "n"),
        per_l1.filter(F.col("n") < min_l2).select(F.lit("l2_per_l1").alias("rule"), F.col("a").alias("node"), "n"),
        per_l1.agg(F.count("*").alias("n")).filter(F.col("n") < min_l1).select(F.lit("l1_total").alias("rule"), F.lit("all").alias("node"), "n"),
    ]
    return reduce(DataFrame.unionByName, rules)
