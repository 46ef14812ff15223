"""AG: distributions, run reports, pool reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import bindings as B
from corpusloom.catalog.base import query, s_clean, s_count, s_ratio, s_round, s_words
from corpusloom.catalog.score_queries import _ACTUAL, BASE, s_quantile
from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T
from corpusloom.operators import lexical as L
from corpusloom.operators import reports as A
from corpusloom.operators import scoring as Q


def records_with_level(spark, sf):
    rows = Q.with_clean(B.records(spark, sf), "text")
    return rows.withColumn("complexity_level", Q.actual_complexity(F.col("clean"), F.col("words")))


DIMS = {
    "l1": None, "scene": None, "application_type": None, "product_type": None, "target_complexity": None,
    "complexity_level": "unknown", "design_style": "unspecified", "persona_source": "unspecified",
}
_MEAN = s_round("avg(coalesce(quality_score, 0e0))", 2)


def s_dim(c: str, blank: str | None) -> str:
    src = "actual" if c == "complexity_level" else c
    value = f"coalesce({src}, 'unknown')" if blank is None else f"coalesce(nullif({src}, ''), '{blank}')"
    return f"SELECT '{c}' AS dim, {value} AS value, count(*) AS n, {_MEAN} AS mean_score FROM ca GROUP BY 2"


@query("ag01_corpus_summary", f"WITH {BASE} {' UNION ALL '.join(s_dim(c, b) for c, b in DIMS.items())} UNION ALL SELECT 'total', 'all', count(*), {_MEAN} FROM ca")
def ag01(spark, sf):
    return A.corpus_summary(records_with_level(spark, sf), DIMS)


@query("ag02_target_vs_actual", f"WITH {BASE} SELECT target_complexity || ' -> ' || actual AS pair, count(*) AS n FROM ca GROUP BY 1")
def ag02(spark, sf):
    return A.confusion(records_with_level(spark, sf), "target_complexity", "complexity_level")


_OK = "coalesce(quality_pass, false)"


@query("ag03_complexity_stats", f"""WITH {BASE} SELECT target_complexity AS complexity, count(*) FILTER (WHERE {_OK}) AS passed, count(*) FILTER (WHERE NOT {_OK}) AS failed, count(*) AS total, {_MEAN.replace('mean', 'avg')} AS avg_score,
  min(w) AS wc_min, max(w) AS wc_max, {s_round(f"count(*) FILTER (WHERE {_OK}) * 100 / count(*)::DOUBLE", 1)} AS pass_pct, {s_quantile('w', '0.5e0')} AS wc_p50 FROM cw GROUP BY 1""")
def ag03(spark, sf):
    return A.complexity_stats(B.records(spark, sf), "target_complexity", "text", "quality_score", "quality_pass")


def s_pass(dim: str, value: str) -> str:
    fb = "coalesce(persona_source IN ('fallback', 'persona-fallback'), false)"
    return f"SELECT '{dim}' AS dim, {value} AS value, count(*) AS n, count(*) FILTER (WHERE {_OK}) AS passed, count(*) FILTER (WHERE NOT {_OK}) AS failed, count(*) FILTER (WHERE {fb}) AS fallbacks FROM rec"


@query("ag04_pass_by_style_and_l1", f"WITH {B.REC} {s_pass('design_style', 'coalesce(design_style, ' + chr(39) + 'none' + chr(39) + ')')} GROUP BY 2 UNION ALL {s_pass('l1_scene', 'l1')} GROUP BY 2 UNION ALL {s_pass('total', chr(39) + 'all' + chr(39))}")
def ag04(spark, sf):
    return A.pass_by_dimension(B.records(spark, sf), "design_style", "l1", "quality_pass", "persona_source")


@query("ag05_score_histogram", f"""WITH {B.REC}, c AS (SELECT least(7, greatest(0, floor((CASE WHEN coalesce(quality_score, 0) = 0 THEN 1e0 ELSE quality_score END - 1) / 0.5e0)))::BIGINT AS bucket, count(*) AS n FROM rec GROUP BY 1)
SELECT r.range AS bucket, 1 + r.range * 0.5e0 AS lo, 1.5e0 + r.range * 0.5e0 AS hi, coalesce(n, 0) AS n FROM range(8) r LEFT JOIN c ON c.bucket = r.range""")
def ag05(spark, sf):
    return A.score_histogram(B.records(spark, sf), "quality_score")


@query("ag06_word_histogram", f"WITH {BASE} SELECT w // 25 AS bucket, count(*) FILTER (WHERE {_OK}) AS passed, count(*) FILTER (WHERE NOT {_OK}) AS failed FROM cw GROUP BY 1")
def ag06(spark, sf):
    return A.word_histogram(B.records(spark, sf), "text", "quality_pass")


@query("ag07_word_ranges", f"""WITH {BASE} SELECT scene, CASE WHEN w < 40 THEN '<40' WHEN w < 50 THEN '40-49' WHEN w < 60 THEN '50-59' WHEN w < 70 THEN '60-69' WHEN w < 80 THEN '70-79' WHEN w < 90 THEN '80-89' WHEN w < 100 THEN '90-99' ELSE '100+' END AS word_range, count(*) AS n FROM cw GROUP BY 1, 2""")
def ag07(spark, sf):
    return A.range_histogram(B.records(spark, sf), "scene", "text")


SRC = ["llm_persona_synthesis", "llm_persona_synthesis_parse_failed", "deterministic_persona_fallback"]


@query("ag08_batch_stats", f"""WITH b AS (SELECT (['vague', 'medium', 'complex'])[1 + event_id % 3] AS complexity, user_id * 3 % 211 + event_id % 50 AS w, ({SRC})[1 + user_id % 3] AS p, value AS ms FROM events)
SELECT complexity, count(*) AS n, {s_round('avg(w)', 1)} AS avg_words, min(w) AS min_words, max(w) AS max_words, count(*) FILTER (WHERE p = '{SRC[0]}') AS persona_ok, count(*) FILTER (WHERE p = '{SRC[1]}') AS persona_parse_failed,
  count(*) FILTER (WHERE p = '{SRC[2]}') AS persona_fallback, {s_round('sum(ms) / count(*) / 1000', 4)} AS avg_seconds FROM b GROUP BY 1""")
def ag08(spark, sf):
    e = B.table(spark, sf, "events").select(
        B.nth(fv.COMPLEXITY_LEVELS, F.col("event_id") % 3).alias("level"), (F.col("user_id") * 3 % 211 + F.col("event_id") % 50).alias("w"),
        B.nth(SRC, F.col("user_id") % 3).alias("p"), F.col("value").alias("ms"),
    )
    return A.batch_stats(e, "level", F.col("w"), "p", "ms")


def s_run(scope: str) -> str:
    ok, scored = "error IS NULL", "error IS NULL AND s IS NOT NULL"
    return f"""SELECT {scope} AS scope, count(*) FILTER (WHERE {ok}) AS successes, count(*) FILTER (WHERE error IS NOT NULL) AS failures, floor(coalesce(avg(w) FILTER (WHERE {ok}), 0) + 0.5)::BIGINT AS avg_words,
  count(*) FILTER (WHERE {scored}) AS scored, count(*) FILTER (WHERE {scored} AND pass) AS pass_count, {s_round(f"count(*) FILTER (WHERE {scored} AND pass) / (count(*) FILTER (WHERE {scored}))::DOUBLE", 6)} AS pass_rate,
  {s_round(f"avg(s) FILTER (WHERE {scored})", 2)} AS avg_score FROM r"""


@query("ag09_run_summary", f"""WITH {B.EREC}, r AS (SELECT *, user_id % 97 AS w, CASE WHEN id % 4 <> 0 THEN 1 + id % 5 END::DOUBLE AS s, id % 5 >= 2 AS pass, 'u' || user_id % 10 AS l1 FROM (SELECT *, CASE WHEN platform = 'error' THEN 'x' END AS e2 FROM erec))
{s_run('l1')} GROUP BY l1 UNION ALL {s_run("'all'")}""")
def ag09(spark, sf):
    r = B.run_records(spark, sf).select(
        F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias("l1"), (F.col("user_id") % 97).alias("w"),
        F.when(F.col("id") % 4 != 0, 1 + F.col("id") % 5).cast("double").alias("s"), (F.col("id") % 5 >= 2).alias("pass"), "error",
    )
    return A.run_summary(r, "l1", "w", "s", "pass", "error")


@query("ag10_method_stats", f"""SELECT l_returnflag AS method, count(*) AS n, {s_round('avg(l_extendedprice)', 2)} AS mean, {s_round('stddev_pop(l_extendedprice)', 2)} AS std, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
  count(*) FILTER (WHERE l_quantity >= 25) AS pass_count FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1""")
def ag10(spark, sf):
    return A.method_stats(B.table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", F.col("l_quantity") >= 25, F.col("l_linestatus") == "F")


@query("ag11_run_comparison", rf"""WITH {BASE}, f AS (SELECT l1 AS run, target_complexity AS lv, w, lower(substr(regexp_extract(regexp_replace(text, '^\s+|\s+$', '', 'g'), '^[^.!?\n]*'), 1, 60)) AS fp FROM cw),
a AS (SELECT run, count(DISTINCT fp) AS unique_leads, count(*) AS total, avg(w) FILTER (WHERE lv = 'vague') AS v, avg(w) FILTER (WHERE lv = 'medium') AS m, avg(w) FILTER (WHERE lv = 'complex') AS x FROM f GROUP BY 1),
s AS (SELECT *, {s_round('(x - v) / m', 2)} AS separation FROM a)
SELECT run, {s_round('v', 4)} AS avg_vague, {s_round('m', 4)} AS avg_medium, {s_round('x', 4)} AS avg_complex, separation, unique_leads, total, run = (SELECT run FROM s ORDER BY separation DESC, run LIMIT 1) AS is_best FROM s""")
def ag11(spark, sf):
    return A.run_comparison(B.records(spark, sf), "l1", "target_complexity", "text")


@query("ag12_uniqueness_summary", f"""WITH {B.REC}, u AS (SELECT scene AS scope, count(*) AS rows, count(DISTINCT text) AS unique_texts, count(DISTINCT application_type) AS app_types FROM rec GROUP BY 1
  UNION ALL SELECT 'all', count(*), count(DISTINCT text), count(DISTINCT application_type) FROM rec) SELECT *, {s_ratio('unique_texts', 'rows', 4)} AS unique_ratio FROM u""")
def ag12(spark, sf):
    return A.uniqueness_summary(B.records(spark, sf), "text", "application_type", "scene")


@query("ag12_run_summary", f"""WITH {B.REC}, {B.SCN} SELECT count(*) AS total_prompts, count(DISTINCT text) AS unique_prompts, count(DISTINCT application_type) AS application_types,
  (SELECT sum(target_count)::DOUBLE FROM scn) AS target_sum, {s_ratio('count(DISTINCT text)', 'count(*)', 4)} AS unique_ratio FROM rec""")
def ag12_run(spark, sf):
    return A.prompt_summary(B.records(spark, sf), B.scenes(spark, sf), "text", "application_type", "target_count")


CAP = f"""{B.POOL}, {B.USAGE}, ps AS (SELECT l2, count(*) AS pool_size FROM pool GROUP BY 1),
pu AS (SELECT usg.l2, sum(uses)::BIGINT AS cum, count(pool.topic) AS dis FROM usg LEFT JOIN pool ON pool.l2 = usg.l2 AND pool.topic = usg.topic GROUP BY 1),
cap AS (SELECT ps.l2, pool_size, coalesce(cum, 0) AS cum_queries, coalesce(dis, 0) AS distinct_used, {s_ratio('coalesce(cum, 0)', 'coalesce(dis, 0)', 2)} AS reuse_avg, greatest(0, 45 - pool_size) AS gap FROM ps LEFT JOIN pu USING (l2))"""


@query("ag13_pool_capacity", f"WITH {CAP} SELECT * FROM cap")
def ag13(spark, sf):
    return A.pool_capacity(B.pool(spark, sf), B.topic_records(spark, sf), 45)


@query("ag13_pool_capacity_totals", f"WITH {CAP} SELECT count(*) AS l2_count, sum(pool_size)::BIGINT AS current_topics, count(*) * 45 AS target_topics, sum(gap)::BIGINT AS total_gap, count(*) FILTER (WHERE cum_queries > pool_size) AS over_subscribed FROM cap")
def ag13_totals(spark, sf):
    return A.pool_capacity_totals(A.pool_capacity(B.pool(spark, sf), B.topic_records(spark, sf), 45), 45)


# two platforms, each with its own pool: parts of even and of odd size
BOTH = f"""{B.POOL}, pf AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'web' ELSE 'mobile' END AS platform, p_brand AS l2, p_partkey::VARCHAR AS topic FROM part WHERE p_size <= 25),
uf AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'web' ELSE 'mobile' END AS platform, p_brand AS l2, l_partkey::VARCHAR AS topic, count(*) AS uses FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
ps AS (SELECT platform, l2, count(*) AS pool_size FROM pf GROUP BY ALL), pu AS (SELECT uf.platform, uf.l2, sum(uses) AS cum FROM uf GROUP BY ALL),
cp AS (SELECT platform, l2, pool_size, coalesce(cum, 0) AS cum, greatest(0, 45 - pool_size) AS gap FROM ps LEFT JOIN pu USING (platform, l2))"""


@query("ag13_capacity_by_platform", f"""WITH {BOTH} SELECT platform, count(*) AS l2_count, sum(pool_size)::BIGINT AS current_topics, count(*) * 45 AS target_topics, sum(gap)::BIGINT AS total_gap,
  count(*) FILTER (WHERE cum > pool_size) AS over_subscribed FROM cp GROUP BY 1""")
def ag13_platforms(spark, sf):
    part = B.table(spark, sf, "part")
    side = lambda c: F.when(c % 2 == 0, "web").otherwise("mobile").alias("platform")
    pool = part.filter("p_size <= 25").select(side(F.col("p_size")), F.col("p_brand").alias("l2"), F.col("p_partkey").cast("string").alias("topic"))
    used = B.table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    used = used.select(side(F.col("l_linenumber")), F.col("p_brand").alias("l2"), F.col("p_partkey").cast("string").alias("topic"))
    return A.pool_capacity_totals(A.pool_capacity(pool, used, 45, by=("platform",)), 45, ("platform",))


@query("ag14_pool_consumption", f"""WITH {B.POOL}, {B.TREC}, u AS (SELECT platform, topic, count(*) AS uses FROM trec GROUP BY 1, 2), p AS (SELECT DISTINCT topic FROM pool),
f AS (SELECT u.*, p.topic IS NOT NULL AS inp, (SELECT count(*) FROM p) AS ps FROM u LEFT JOIN p USING (topic))
SELECT platform, count(*) FILTER (WHERE inp) AS in_pool_distinct, count(*) FILTER (WHERE NOT inp) AS off_pool_distinct, (sum(uses) FILTER (WHERE inp))::BIGINT AS in_pool_uses, (sum(uses) FILTER (WHERE NOT inp))::BIGINT AS off_pool_uses,
  {", ".join(f"count(*) FILTER (WHERE inp AND uses = {k}) AS reuse_{k}" for k in range(1, 5))}, count(*) FILTER (WHERE inp AND uses >= 5) AS reuse_5_plus, max(ps) AS pool_size,
  {s_ratio('count(*) FILTER (WHERE inp)', 'max(ps)')} AS coverage, {s_ratio('sum(uses) FILTER (WHERE inp)', 'count(*) FILTER (WHERE inp)')} AS avg_reuse FROM f GROUP BY 1""")
def ag14(spark, sf):
    return A.pool_consumption(B.pool(spark, sf), B.topic_records(spark, sf), "platform", "topic")


@query("ag15_pool_depletion", f"""WITH {B.POOL}, {B.USAGE} SELECT pool.l2, count(*) AS pool_size, count(uses) AS distinct_used, coalesce(sum(uses), 0)::BIGINT AS uses, {s_ratio('count(uses)', 'count(*)')} AS coverage
FROM pool LEFT JOIN usg ON usg.l2 = pool.l2 AND usg.topic = pool.topic GROUP BY 1""")
def ag15(spark, sf):
    return A.pool_depletion(B.pool(spark, sf), B.topic_records(spark, sf), "l2", "topic")


@query("ag16_top_reused_topics", f"""WITH {B.POOL}, {B.TREC}, u AS (SELECT platform, topic, count(*) AS uses FROM trec WHERE topic IN (SELECT topic FROM pool) GROUP BY 1, 2)
SELECT * FROM (SELECT topic, platform, uses, row_number() OVER (PARTITION BY platform ORDER BY uses DESC, topic) AS rank FROM u) WHERE rank <= 20""")
def ag16(spark, sf):
    return A.top_reused(B.pool(spark, sf), B.topic_records(spark, sf), "platform", "topic")


PLATFORMS = ["click", "error", "purchase", "signup", "view"]


@query("ag17_version_platform_crosstab", f"WITH {B.EREC} SELECT version, {', '.join(f'''count(*) FILTER (WHERE platform = '{p}') AS {p}''' for p in PLATFORMS)} FROM erec GROUP BY 1")
def ag17(spark, sf):
    return A.crosstab(B.run_records(spark, sf), "version", "platform", PLATFORMS)


@query("ag17_persona_by_l1", f"WITH {B.REC} SELECT coalesce(persona_title, '(none)') AS persona_title, l1, count(*) AS n FROM rec GROUP BY 1, 2")
def ag17_persona(spark, sf):
    return A.pair_counts(B.records(spark, sf), "persona_title", "l1")


@query("ag17_counts_by_platform", f"""WITH {B.REC}, c AS (SELECT product_type, 'l1' AS dimension, l1 AS value FROM rec UNION ALL SELECT product_type, 'complexity', target_complexity FROM rec
  UNION ALL SELECT product_type, 'persona', coalesce(persona_title, '(none)') FROM rec) SELECT product_type, dimension, value, count(*) AS n FROM c GROUP BY ALL""")
def ag17_platforms(spark, sf):
    return A.counts_by(B.records(spark, sf), "product_type", {"l1": "l1", "complexity": "target_complexity", "persona": "persona_title"})


@query("ag18_pool_size_stats", f"WITH {B.POOL}, c AS (SELECT count(*) AS c FROM pool GROUP BY l2) SELECT count(*) AS l2_count, sum(c)::BIGINT AS total_topics, min(c) AS min_topics, max(c) AS max_topics, {s_round('avg(c)', 4)} AS avg_topics FROM c")
def ag18(spark, sf):
    return A.pool_size_stats(B.pool(spark, sf))


_STOP = ", ".join(f"'{w}'" for w in fv.STOP_WORDS)


@query("ag19_word_frequency", rf"""WITH p AS (SELECT unnest(regexp_split_to_array(text, '[\s\-/&,.()+]+')) AS piece FROM documents), w AS (SELECT regexp_replace(lower(piece), '[^a-z]', '', 'g') AS word FROM p)
SELECT word, count(*) AS n FROM w WHERE len(word) > 3 AND word NOT IN ({_STOP}) GROUP BY 1 ORDER BY n DESC, word LIMIT 40""")
def ag19(spark, sf):
    return L.word_frequency(B.table(spark, sf, "documents"), "text", fv.STOP_WORDS)


@query("ag20_usage_update", f"""WITH {B.USAGE}, o AS (SELECT p_brand AS l2, p_partkey::VARCHAR AS topic, p_size::BIGINT AS uses FROM part WHERE p_size <= 25)
SELECT l2, topic, sum(uses)::BIGINT AS uses FROM (SELECT * FROM usg UNION ALL SELECT * FROM o) GROUP BY 1, 2""")
def ag20(spark, sf):
    state = B.table(spark, sf, "part").filter("p_size <= 25").select(F.col("p_brand").alias("l2"), F.col("p_partkey").cast("string").alias("topic"), F.col("p_size").cast("long").alias("uses"))
    return A.update_usage(state, B.topic_records(spark, sf), "l2", "topic")


RANKED_SQL = """rk AS (SELECT c_mktsegment AS voter, c_nationkey AS item, row_number() OVER (PARTITION BY c_mktsegment ORDER BY count(*) DESC, c_nationkey) AS rank FROM customer GROUP BY 1, 2)"""


@query("ag21_borda_fusion", f"""WITH {RANKED_SQL}, n AS (SELECT voter, count(*) AS n FROM rk GROUP BY 1), s AS (SELECT item::BIGINT AS item, sum(n - rank)::BIGINT AS borda_score FROM rk JOIN n USING (voter) GROUP BY 1)
SELECT item, borda_score, row_number() OVER (ORDER BY borda_score DESC, item) AS borda_rank FROM s ORDER BY borda_rank LIMIT 20""")
def ag21(spark, sf):
    """Market segments vote on nations."""
    from pyspark.sql import Window

    c = B.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("voter"), F.col("c_nationkey").cast("long").alias("item")).agg(F.count("*").alias("n"))
    ranked = c.withColumn("rank", F.row_number().over(Window.partitionBy("voter").orderBy(F.desc("n"), "item")))
    return A.borda_fusion(ranked, "voter", "item", "rank", 20)


@query("ag22_quality_report", f"""WITH {B.REC} SELECT count(*) AS total, count(quality_score) AS scored, count(*) FILTER (WHERE quality_score >= 4) AS excellent, count(*) FILTER (WHERE quality_score >= 3 AND quality_score < 4) AS good,
  count(*) FILTER (WHERE quality_score >= 2.5e0 AND quality_score < 3) AS acceptable, count(*) FILTER (WHERE quality_score < 2.5e0) AS quarantine, {s_round('avg(quality_score)', 6)} AS avg_score,
  {s_ratio('count(*) FILTER (WHERE quality_score >= 2.5e0)', 'count(quality_score)')} AS pass_rate FROM rec""")
def ag22(spark, sf):
    return A.quality_report(B.records(spark, sf), "quality_score")


@query("ag22_quality_split", f"WITH {B.REC} SELECT id, CASE WHEN coalesce(quality_score, 0) >= 2.5e0 THEN 'passed' ELSE 'quarantine' END AS part FROM rec")
def ag22_split(spark, sf):
    ok, bad = A.split_by_quality(B.records(spark, sf), "quality_score")
    return ok.select("id", F.lit("passed").alias("part")).unionByName(bad.select("id", F.lit("quarantine").alias("part")))


MATRIX = ["Minimalism", "Dark", "Luxury", "none"]


@query("ag23_coverage_matrix", f"WITH {B.REC} SELECT scene, {', '.join(f'''count(*) FILTER (WHERE coalesce(design_style, 'none') = '{s}') AS {chr(34)}{s}{chr(34)}''' for s in MATRIX)} FROM rec GROUP BY 1")
def ag23(spark, sf):
    return A.coverage_matrix(B.records(spark, sf), "scene", "design_style", MATRIX)


@query("ag23_distribution_report", f"""WITH {B.REC}, b AS (SELECT *, CASE WHEN quality_score >= 4 THEN 'excellent' WHEN quality_score >= 3 THEN 'good' WHEN quality_score >= 2.5e0 THEN 'acceptable' ELSE 'quarantine' END AS band FROM rec)
{" UNION ALL ".join(f"SELECT '{d}' AS dim, {d} AS value, count(*) AS n, {s_round('avg(len(text))', 4)} AS avg_length, {s_ratio('count(design_style)', 'count(*)')} AS styled_ratio FROM b GROUP BY 2" for d in ("l1", "product_type", "band"))}
UNION ALL SELECT 'total', 'all', count(*), {s_round('avg(len(text))', 4)}, {s_ratio('count(design_style)', 'count(*)')} FROM b""")
def ag23_report(spark, sf):
    r = B.records(spark, sf).withColumn("band", A.quality_band(F.col("quality_score"))).withColumn("text_len", F.length("text"))
    extra = [T.round_to(F.avg("text_len"), 4).alias("avg_length"), T.ratio(F.count("design_style"), F.count("*")).alias("styled_ratio")]
    return A.grouping_counts(r, {d: F.col(d) for d in ("l1", "product_type", "band")}, extra, ("text_len", "design_style"))


@query("ag24_partition_index", f"WITH {B.REC} SELECT l1, product_type, count(*) AS rows, {s_round('avg(quality_score)', 6)} AS avg_score FROM rec GROUP BY 1, 2")
def ag24(spark, sf):
    return A.partition_index(B.records(spark, sf), ["l1", "product_type"], "quality_score")


@query("ag25_taxonomy_violations", """WITH l AS (SELECT DISTINCT p_type AS a, p_brand AS b, p_name AS c FROM part), x AS (SELECT a, b, count(*) AS n FROM l GROUP BY 1, 2), y AS (SELECT a, count(*) AS n FROM x GROUP BY 1)
SELECT 'l3_per_l2' AS rule, a || '/' || b AS node, n FROM x WHERE n < 12 UNION ALL SELECT 'l2_per_l1', a, n FROM y WHERE n < 30 UNION ALL SELECT 'l1_total', 'all', count(*) FROM y HAVING count(*) < 15""")
def ag25(spark, sf):
    return A.taxonomy_violations(B.table(spark, sf, "part"), "p_type", "p_brand", "p_name", 15, 30, 12)
