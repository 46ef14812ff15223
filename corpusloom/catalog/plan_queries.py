"""PL: quotas, generation plans, topic pools, samples and draws."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.catalog import bindings as B
from corpusloom.catalog.base import query, s_distinct, s_hash, s_list, s_round, s_tags
from corpusloom.catalog.text_queries import CAND_SQL, extra_ctes, s_lens_text
from corpusloom.catalog.wording import LETTER
from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T
from corpusloom.plans import sampling as S
from corpusloom.plans import tasks as P
from corpusloom.plans import topics as O

LEVELS = s_list(fv.COMPLEXITY_LEVELS)


def s_pad(n: str, width: int) -> str:
    return f"lpad(({n})::VARCHAR, greatest({width}, len(({n})::VARCHAR))::INTEGER, '0')"


def s_dress(source: str, style_group: str, seed_group: str) -> str:
    """CTEs that add product type, keyword style and persona seed to rows with application_type and grp."""
    return f"""d1 AS (SELECT *, l1_scene || ' ' || l2_scene_label || ' ' || application_type AS x FROM {source}),
d2 AS (SELECT *, {s_tags('x', fv.PRODUCT_RULES)} AS p, {s_tags('x', fv.STYLE_RULES)} AS s FROM d1),
d3 AS (SELECT *, CASE WHEN len(p) = 0 THEN {s_list(fv.DEFAULT_PRODUCT_TYPES)} ELSE {s_distinct('p')} END AS pts, [NULL] || {s_distinct('s')} AS sts FROM d2),
dressed AS (SELECT *, pts[1 + grp % len(pts)] AS product_type, coalesce(sts[1 + {style_group} % len(sts)], 'free') AS design_style,
  substr(sha1(scene_id || ':' || application_type || ':' || {seed_group}), 1, 10) AS persona_seed FROM d3)"""


SEED_N = "CASE WHEN target_count = 0 THEN 3 ELSE greatest(3, least(9, floor(target_count * 0.15e0 + 0.5)::BIGINT)) END"
TASK = ["query_id", "scene_id", "application_type", "product_type", "target_complexity", "design_style", "persona_seed"]


def shown(plan, *extra):
    return plan.withColumn("design_style", F.coalesce("design_style", F.lit("free"))).select(*TASK, *extra)


@query("pl01_seed_quota", f"WITH {B.SCN} SELECT id, ({SEED_N})::BIGINT AS n FROM scn")
def pl01(spark, sf):
    return B.scenes(spark, sf).select("id", P.seed_count(F.col("target_count")).alias("n"))


SEED = f"""sp AS (SELECT *, unnest(range(({SEED_N})::BIGINT)) AS i FROM scn), sg AS (SELECT *, i // 3 AS grp FROM sp),
st AS (SELECT 'q_' || id || '_' || {s_pad('i + 1', 3)} AS query_id, id AS scene_id, l1_scene, l2_scene_label, candidates[1 + (idx + grp) % len(candidates)] AS application_type,
  ({LEVELS})[1 + (idx + i) % 3] AS target_complexity, grp FROM sg)"""


@query("pl02_seed_plan", f"WITH {B.SCN}, {SEED}, {s_dress('st', 'grp', 'grp')} SELECT {', '.join(TASK)}, 'seed' AS plan_type FROM dressed")
def pl02(spark, sf):
    return shown(P.seed_plan(B.scenes(spark, sf), "auto"), "plan_type")


BACK = f"""hv AS (SELECT c_nationkey AS idx, count(*) AS have FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1),
bs AS (SELECT scn.*, coalesce(have, 0) AS have, greatest(0, CASE WHEN target_count = 0 THEN 6 ELSE target_count END - coalesce(have, 0)) AS gap FROM scn LEFT JOIN hv USING (idx)),
bp AS (SELECT *, unnest(range(gap)) AS i FROM bs),
bt AS (SELECT 'q_' || id || '_' || {s_pad('have + i + 1', 3)} AS query_id, id AS scene_id, l1_scene, l2_scene_label, candidates[1 + (have + idx + i // 3) % len(candidates)] AS application_type,
  ({LEVELS})[1 + (have + idx + i) % 3] AS target_complexity, i // 3 AS grp, have // 3 + i // 3 AS later, gap FROM bp)"""


@query("pl03_backfill_plan", f"WITH {B.SCN}, {BACK}, {s_dress('bt', 'later', 'later')} SELECT {', '.join(TASK)}, gap AS gap_after_snapshot FROM dressed")
def pl03(spark, sf):
    c = B.table(spark, sf, "customer").filter("c_custkey % 3 <> 0")
    have = c.select(F.concat(F.lit("scene_"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 3, "0")).alias("scene_id"))
    return shown(P.backfill_plan(B.scenes(spark, sf), have, style="auto"), "gap_after_snapshot")


def s_allocate(weight: str, total: str, source: str = "scn") -> str:
    return f"""aw AS (SELECT *, {weight} AS wt, {total} AS goal FROM {source}), ar AS (SELECT *, {s_round('wt / sum(wt) OVER () * goal', 9)} AS raw FROM aw),
af AS (SELECT *, floor(raw) AS fl, row_number() OVER (ORDER BY raw - floor(raw) DESC, idx) AS rk FROM ar),
al AS (SELECT *, (fl + CASE WHEN rk <= goal - sum(fl) OVER () THEN 1 ELSE 0 END)::BIGINT AS allocated FROM af)"""


# totals follow the tables: two tasks per three customers
TOTAL_SQL = "(sum(target_count) OVER ())::BIGINT * 2 // 3"


def total_of():
    return F.floor(F.sum("target_count").over(Window.partitionBy()) * 2 / 3)


@query("pl04_allocate_flat", f"WITH {B.SCN}, {s_allocate('target_count::DOUBLE', TOTAL_SQL)} SELECT id, allocated FROM al")
def pl04(spark, sf):
    return P.allocate(B.scenes(spark, sf), total_of()).select("id", "allocated")


@query("pl04_allocate_l1_shares", f"WITH {B.SCN}, {s_allocate('target_count::DOUBLE / count(*) OVER (PARTITION BY l1_scene)', TOTAL_SQL)} SELECT id, allocated FROM al")
def pl04_l1(spark, sf):
    return P.allocate(B.scenes(spark, sf), total_of(), flat=False).select("id", "allocated")


# wanted picks per brand: more than the pool for some brands, fewer for others
WANT = """wt AS (SELECT l2, min(l2_pos) AS lp, count(*) AS size FROM pool GROUP BY 1), want AS (SELECT l2, CASE WHEN lp % 3 = 0 THEN size * 2 + 3 ELSE size // 2 + 1 END AS k, size FROM wt)"""


def wanted(pool):
    w = pool.groupBy("l2").agg(F.min("l2_pos").alias("lp"), F.count("*").alias("size"))
    return w.select("l2", F.when(F.col("lp") % 3 == 0, F.col("size") * 2 + 3).otherwise(F.floor(F.col("size") / 2) + 1).alias("k"))


RANKED = "rkd AS (SELECT pool.l2, pool.topic, coalesce(uses, 0) AS uses, row_number() OVER (PARTITION BY pool.l2 ORDER BY coalesce(uses, 0), pos) AS rank, count(*) OVER (PARTITION BY pool.l2) AS size FROM pool LEFT JOIN usg ON usg.l2 = pool.l2 AND usg.topic = pool.topic)"


@query("pl05_pick_least_used", f"""WITH {B.POOL}, {B.USAGE}, {WANT}, {RANKED}, pk AS (SELECT l2, unnest(range(k)) AS i, size FROM want)
SELECT pk.l2, pk.i, topic, uses FROM pk JOIN rkd ON rkd.l2 = pk.l2 AND rkd.rank = pk.i % pk.size + 1""")
def pl05(spark, sf):
    pool = B.pool(spark, sf)
    return O.pick_least_used(pool, B.usage(spark, sf), wanted(pool))


def brand_scenes(spark, sf):
    """Scenes named after brands: exact, inside a longer label, or without a pool."""
    s = B.scenes(spark, sf)
    name = F.concat(F.lit("Brand#"), F.col("idx").cast("string"))
    label = F.when(F.col("idx") % 3 == 0, name).when(F.col("idx") % 3 == 1, F.concat(F.lit("all "), name, F.lit(" x"))).otherwise(F.col("l2_scene_label"))
    return s.withColumn("l2_scene_label", label).withColumn("l2_scene_raw", F.lit("raw"))


CORPUS = f"""bsn AS (SELECT * REPLACE (CASE idx % 3 WHEN 0 THEN 'Brand#' || idx WHEN 1 THEN 'all Brand#' || idx || ' x' ELSE l2_scene_label END AS l2_scene_label) FROM scn WHERE NOT contains(l1_scene, '新闻')),
kept AS (SELECT * REPLACE (row_number() OVER (ORDER BY idx) - 1 AS idx) FROM bsn),
{s_allocate('target_count::DOUBLE', TOTAL_SQL, 'kept')},
{B.POOL}, {B.USAGE}, {RANKED}, pk AS (SELECT l2, min(l2_pos) AS pos, count(*) AS size FROM pool GROUP BY 1),
mt AS (SELECT al.id, arg_min(l2, [CASE WHEN l2 = l2_scene_label THEN 0 ELSE 1 END, pos]) AS l2 FROM al JOIN pk ON contains(l2, l2_scene_label) OR contains(l2_scene_label, l2) GROUP BY 1),
cp AS (SELECT al.*, mt.l2, pk.size, unnest(range(allocated)) AS i FROM al LEFT JOIN mt USING (id) LEFT JOIN pk ON pk.l2 = mt.l2),
ct AS (SELECT 'q_' || id || '_' || {s_pad('i + 1', 3)} AS query_id, id AS scene_id, l1_scene, l2_scene_label, coalesce(rkd.topic, candidates[1 + (idx + i // 2) % len(candidates)]) AS application_type,
  (['medium', 'complex'])[1 + i % 2] AS target_complexity, i // 2 AS grp, coalesce(rkd.topic, '') AS corpus_topic, coalesce(cp.l2, '') AS corpus_l2_key
  FROM cp LEFT JOIN rkd ON rkd.l2 = cp.l2 AND rkd.rank = i % cp.size + 1)"""


@query("pl06_corpus_plan", f"WITH {B.SCN}, {CORPUS}, {s_dress('ct', 'grp', 'grp')} SELECT {', '.join(TASK)}, corpus_topic, corpus_l2_key FROM dressed")
def pl06(spark, sf):
    plan = O.corpus_plan(
        brand_scenes(spark, sf), B.pool(spark, sf), B.usage(spark, sf), total_of(), ["新闻"], ("medium", "complex"), "auto", flat=True
    )
    return shown(plan, F.coalesce("corpus_topic", F.lit("")).alias("corpus_topic"), F.coalesce("corpus_l2_key", F.lit("")).alias("corpus_l2_key"))


PTS = ["form_flow", "dashboard", "admin_panel", "social_feed"]


def quota_scenes(spark, sf):
    """Customers as scenes of three kinds (scene position counts within the kind)."""
    c = B.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("scene_"), P.pad(k, 6)).alias("id"), F.floor(k / 3).alias("idx"), (k % 3).alias("kind"), F.when(k % 4 == 1, "健康管理").when(k % 4 == 3, F.col("c_mktsegment")).alias("l1_scene"),
        F.col("c_name").alias("l2_scene_label"), F.array(F.lit("app a"), F.lit("app b"), F.lit("app c")).alias("candidates"),
        F.when(k % 2 == 0, F.array(*[F.lit(p) for p in PTS])).alias("products"), F.lit(0).alias("target_count"),
    )


FOUR_STYLES = "['Dark', 'Luxury', 'Vibrant', 'Material']"
ALL_STYLES = "['Dark', 'Glassmorphism', 'Vibrant', 'Minimalism', 'Material', 'Neumorphism', 'Luxury', 'Cyberpunk']"


def s_quota(kind: int, steps, plan: str, rotate: bool, styles: str = FOUR_STYLES) -> str:
    parts = []
    for n, (seq, lv, ap, pt) in enumerate(steps):
        off = "idx + " if rotate else ""
        parts.append(
            f"SELECT 'q_' || id || '_' || '{seq:03d}' AS query_id, id AS scene_id, (['app a', 'app b', 'app c'])[{1 + ap % 3}] AS application_type, pts[1 + ({off}{pt}) % len(pts)] AS product_type, ({LEVELS})[1 + ({off}{lv}) % 3] AS target_complexity, ({styles})[1 + (idx * {len(steps)} + {n}) % len({styles})] AS design_style, substr(sha1(id || ':{seq}:{plan}'), 1, 10) AS persona_seed, '{plan}' AS plan_type FROM qs WHERE kind = {kind}"
        )
    return " UNION ALL ".join(parts)


QS = f"qs AS (SELECT 'scene_' || {s_pad('c_custkey', 6)} AS id, c_custkey // 3 AS idx, c_custkey % 3 AS kind, CASE WHEN c_custkey % 2 = 0 THEN {s_list(PTS)} WHEN c_custkey % 4 = 1 THEN ['dashboard', 'content_blog', 'form_flow'] ELSE ['portfolio', 'dashboard', 'form_flow'] END AS pts FROM customer)"


def s_quota_plan(styles: str) -> str:
    parts = [(0, P.SECOND_ROUND, "expand_r2", True), (1, P.LOW_COVERAGE, "expand_b", False), (2, P.NEW_DOMAIN, "expand_new", False)]
    bonus = f"""SELECT 'q_' || id || '_004', id, 'app a', 'dashboard', 'complex', ({styles})[1], substr(sha1(id || ':4:expand_new'), 1, 10), 'expand_new'
  FROM qs WHERE kind = 2 AND idx = 0"""
    return f"WITH {QS} " + " UNION ALL ".join([*(s_quota(*part, styles) for part in parts), bonus])


def quota_rows(spark, sf, styles):
    q = quota_scenes(spark, sf)
    plan = P.quota_plan(*[q.filter(F.col("kind") == k) for k in range(3)], styles=styles)
    return plan.select("query_id", "scene_id", "application_type", "product_type", "target_complexity", "design_style", "persona_seed", "plan_type")


@query("pl07_quota_plan", s_quota_plan(FOUR_STYLES))
def pl07(spark, sf):
    return quota_rows(spark, sf, ["Dark", "Luxury", "Vibrant", "Material"])


@query("pl07_automatic_styles", s_quota_plan(ALL_STYLES))
def pl07_auto(spark, sf):
    return quota_rows(spark, sf, "auto")


@query("pl07_duplicate_ids", "SELECT 'q_' || (o_custkey % 100) AS query_id, count(*) AS copies FROM orders GROUP BY 1 HAVING count(*) > 1")
def pl07_dup(spark, sf):
    plan = B.table(spark, sf, "orders").select(F.concat(F.lit("q_"), (F.col("o_custkey") % 100).cast("string")).alias("query_id"))
    return P.duplicate_ids(plan)


RR = f"""rr AS (SELECT id, l2_scene_label, candidates[1] AS app, unnest(['form_flow', 'dashboard', 'portfolio'] || CASE WHEN idx % 2 = 0 THEN ['game_hud'] ELSE [] END) AS product_type, idx FROM scn),
rs AS (SELECT *, row_number() OVER (ORDER BY idx, array_position(['form_flow', 'dashboard', 'portfolio', 'game_hud'], product_type)) AS seq FROM rr)"""


@query("pl08_round_robin_plan", f"WITH {B.SCN}, {RR} SELECT 'q_' || id || '_' || {s_pad('seq', 3)} AS query_id, app AS application_type, product_type, CASE WHEN (seq - 1) % 3 = 0 THEN 'vague' ELSE 'medium' END AS target_complexity, substr(md5('free_' || id), 1, 10) AS persona_seed FROM rs")
def pl08(spark, sf):
    base = F.array(F.lit("form_flow"), F.lit("dashboard"), F.lit("portfolio"))
    s = B.scenes(spark, sf).withColumn("products", F.when(F.col("idx") % 2 == 0, F.concat(base, F.array(F.lit("game_hud")))).otherwise(base))
    return P.round_robin_plan(s).select("query_id", "application_type", "product_type", "target_complexity", "persona_seed")


@query("pl09_first_scene_per_l1", f"WITH {B.SCN}, f AS (SELECT *, row_number() OVER (PARTITION BY l1_scene ORDER BY idx) AS r FROM scn WHERE l1_scene <> '新闻资讯') SELECT id, l1_scene, idx FROM f WHERE r = 1 ORDER BY idx LIMIT 3")
def pl09(spark, sf):
    return P.first_scene_per_l1(B.scenes(spark, sf), ["新闻资讯"], 3).select("id", "l1_scene", "idx")


FIVE_K = f"""{CAND_SQL}, cl AS (SELECT id, list(name ORDER BY pos) AS names, list(source ORDER BY pos) AS sources FROM cands GROUP BY 1),
{s_allocate('CASE WHEN target_count = 0 THEN 1e0 ELSE target_count::DOUBLE END', TOTAL_SQL)},
fk AS (SELECT al.id AS scene_id, l1_scene, l2_scene_label, source_row_id, unnest(range(allocated)) AS i, names, sources FROM al JOIN cl ON cl.id = al.id),
fa AS (SELECT *, names[1 + i % len(names)] AS application_type, sources[1 + i % len(names)] AS application_type_source FROM fk),
{extra_ctes("l1_scene || ' ' || l2_scene_label || ' ' || application_type", 'fa')},
ft AS (SELECT 'q5k_' || scene_id || '_' || {s_pad('i + 1', 4)} AS id, *, pts[1 + i % len(pts)] AS product_type, coalesce(sts[1 + i % len(sts)], 'free') AS design_style, ({LEVELS})[1 + (i + source_row_id) % 3] AS target_complexity FROM x3)"""


@query("pl10_candidate_plan", f"WITH {B.SCN}, {FIVE_K} SELECT id, application_type, application_type_source, product_type, target_complexity, design_style, substr(sha1(scene_id || ':' || application_type || ':' || product_type || ':' || target_complexity || ':' || i), 1, 10) AS persona_seed FROM ft")
def pl10(spark, sf):
    s = P.allocate(B.scenes(spark, sf), total_of(), missing_weight=1.0)
    plan = P.candidate_plan(s, "allocated").withColumn("design_style", F.coalesce("design_style", F.lit("free")))
    return plan.select("id", "application_type", "application_type_source", "product_type", "target_complexity", "design_style", "persona_seed")


@query("pl10_candidate_records", f"""WITH {B.SCN}, {FIVE_K}, {s_lens_text("(SELECT id, target_complexity AS lv, application_type AS app, product_type AS pt, NULLIF(design_style, 'free') AS st, l1_scene || ' ' || l2_scene_label || ' ' || application_type AS x, scene_id, i, target_complexity FROM ft)")}
SELECT id, lens.name AS lens, 'persona_' || substr(sha1(id || ':' || substr(sha1(scene_id || ':' || app || ':' || pt || ':' || lv || ':' || i), 1, 10)), 1, 10) AS persona_id,
  'User of ' || regexp_replace(app, '应用$', '') AS persona_title, query_text, length(query_text) AS query_length FROM lt""")
def pl10_records(spark, sf):
    s = P.allocate(B.scenes(spark, sf), total_of(), missing_weight=1.0)
    return P.candidate_records(P.candidate_plan(s, "allocated"), LETTER).select("id", "lens", "persona_id", "persona_title", "query_text", "query_length")


# small parts are the pool (topic = name), larger parts are offered; names repeat a lot
NAMED_POOL = "np AS (SELECT p_brand AS l2, p_name AS topic, p_partkey AS pos FROM part WHERE p_size <= 10 AND p_brand NOT IN ('Brand#7', 'Brand#9'))"
OFFER = "fr AS (SELECT p_brand AS l2, '  ' || upper(p_name) || '!' AS topic, p_partkey AS pos FROM part WHERE p_size > 10)"
MERGE = f"""{NAMED_POOL}, {OFFER}, fk AS (SELECT l2, trim(topic) AS topic, pos, trim(regexp_replace(lower(topic), '[^a-z0-9一-鿿]+', ' ', 'g')) AS nk FROM fr WHERE l2 = 'Brand#9' OR l2 IN (SELECT l2 FROM np)),
f1 AS (SELECT *, row_number() OVER (PARTITION BY l2, nk ORDER BY pos) AS r FROM fk), f2 AS (SELECT * FROM f1 WHERE r = 1 AND (l2, nk) NOT IN (SELECT (l2, trim(regexp_replace(lower(topic), '[^a-z0-9一-鿿]+', ' ', 'g'))) FROM np)),
f3 AS (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY pos) AS rk FROM f2), rm AS (SELECT l2, greatest(0, 40 - count(*)) AS room FROM np GROUP BY 1 UNION ALL SELECT 'Brand#9', 40),
mg AS (SELECT l2, topic, pos, 'pool' AS origin FROM np UNION ALL SELECT f3.l2, topic, pos + 1099511627776, 'new' FROM f3 JOIN rm USING (l2) WHERE rk <= room)"""


def named_pool(spark, sf):
    p = B.table(spark, sf, "part")
    pool = p.filter("p_size <= 10 and p_brand not in ('Brand#7', 'Brand#9')").select(F.col("p_brand").alias("l2"), F.col("p_name").alias("topic"), F.col("p_partkey").alias("pos"))
    pool = pool.unionByName(pool.select(F.lit("Brand#9").alias("l2"), F.lit(None).cast("string").alias("topic"), F.lit(None).cast("long").alias("pos")).limit(1))
    fresh = p.filter("p_size > 10").select(F.col("p_brand").alias("l2"), F.concat(F.lit("  "), F.upper("p_name"), F.lit("!")).alias("topic"), F.col("p_partkey").alias("pos"))
    return pool, fresh


@query("pl11_merge_topics", f"WITH {MERGE} SELECT * FROM mg")
def pl11(spark, sf):
    return O.merge_topics(*named_pool(spark, sf), 40)


# every offered topic in order: added if its key is new, dropped if not, unread once the cell is full
@query("pl11_merge_counts", f"""WITH RECURSIVE {MERGE}, cell AS (SELECT l2, count(*) AS own FROM np GROUP BY 1 UNION ALL SELECT 'Brand#9', 0),
o AS (SELECT fk.l2, pos, nk, own, (l2, nk) IN (SELECT (l2, trim(regexp_replace(lower(topic), '[^a-z0-9一-鿿]+', ' ', 'g'))) FROM np)
    OR row_number() OVER (PARTITION BY l2, nk ORDER BY pos) > 1 AS dup FROM fk JOIN cell USING (l2)),
r AS (SELECT *, own + coalesce(sum(CASE WHEN dup THEN 0 ELSE 1 END) OVER (PARTITION BY l2 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o),
a AS (SELECT l2, count(*) AS offered, count(*) FILTER (WHERE before < 40 AND NOT dup) AS added, count(*) FILTER (WHERE before < 40 AND dup) AS dropped,
    count(*) FILTER (WHERE before >= 40) AS beyond_cap FROM r GROUP BY 1)
SELECT l2, coalesce(offered, 0) AS offered, coalesce(added, 0) AS added, own + coalesce(added, 0) AS pool_now, coalesce(dropped, 0) AS dropped, coalesce(beyond_cap, 0) AS beyond_cap FROM cell LEFT JOIN a USING (l2)""")
def pl11_counts(spark, sf):
    pool, fresh = named_pool(spark, sf)
    return O.merge_counts(pool, fresh, O.merge_topics(pool, fresh, 40), 40)


@query("pl11_fill_to_target", f"""WITH {NAMED_POOL}, {OFFER}, bt2 AS (SELECT l2, topic, pos, 'pool' AS origin FROM np
  UNION ALL SELECT l2, trim(topic), pos + 1099511627776, 'new' FROM fr WHERE (l2 = 'Brand#9' OR l2 IN (SELECT l2 FROM np)) AND (l2, lower(trim(topic))) NOT IN (SELECT (l2, lower(topic)) FROM np)),
n AS (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY pos) AS rank FROM bt2) SELECT l2, topic, pos, origin, rank FROM n WHERE rank <= 40""")
def pl11_fill(spark, sf):
    return O.fill_to_target(*named_pool(spark, sf), 40)


def topic_arrays(df):
    return df.filter("topic is not null").groupBy("l2").agg(F.array_sort(F.collect_set("topic")).alias("topics"))


@query("pl12_extend_topic_arrays", f"WITH {NAMED_POOL}, {OFFER}, a AS (SELECT l2, list_sort(list_distinct(list(topic))) AS t FROM np GROUP BY 1), b AS (SELECT l2, list_sort(list_distinct(list(topic))) AS t FROM fr WHERE l2 <> 'Brand#3' GROUP BY 1) SELECT l2, array_to_string(a.t || coalesce(b.t, []), '|') AS topics FROM a LEFT JOIN b USING (l2)")
def pl12(spark, sf):
    pool, fresh = named_pool(spark, sf)
    out = O.extend_arrays(topic_arrays(pool), topic_arrays(fresh.filter("l2 <> 'Brand#3'")), "l2", "topics")
    return out.select("l2", F.array_join("topics", "|").alias("topics"))


def with_empty_cells(spark, sf):
    """The pool, and regions as cells without topics."""
    pool = B.pool(spark, sf).select("l2", "topic", "pos")
    return pool.unionByName(B.table(spark, sf, "region").select(F.col("r_name").alias("l2"), F.lit(None).cast("string").alias("topic"), F.lit(None).cast("long").alias("pos")))


CELLS = f"{B.POOL}, c AS (SELECT l2, count(*) AS current, list(topic ORDER BY pos) AS t FROM pool GROUP BY 1 UNION ALL SELECT r_name, 0, [] FROM region)"


@query("pl13_gap_worklist", f"WITH {CELLS} SELECT l2, current, 40 - current AS need FROM c WHERE current < 40")
def pl13(spark, sf):
    return O.gap_worklist(with_empty_cells(spark, sf), 40)


@query("pl13_expansion_prompts", f"""WITH {CELLS}
SELECT l2, 'web' AS platform, current, 40 - current AS need, md5('Add ' || (40 - current) || ' new web topics to the scene ' || l2 || '.' || chr(10) || 'Topics that exist already:' || chr(10) || CASE WHEN current = 0 THEN '(none yet)' ELSE array_to_string(list_transform(t, lambda x, i: i || '. ' || x), chr(10)) END || chr(10)
  || 'Answer with a JSON array of ' || (40 - current) || ' strings.') AS prompt_md5 FROM c WHERE current < 40""")
def pl13_prompts(spark, sf):
    return O.expansion_prompts(with_empty_cells(spark, sf), 40, "web").select("l2", "platform", "current", "need", F.md5("prompt").alias("prompt_md5"))


@query("pl14_seeded_sample", "SELECT doc_id, source FROM documents ORDER BY sha1('s1:' || doc_id), doc_id LIMIT 100")
def pl14(spark, sf):
    return S.seeded_sample(B.table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 100, "s1")


@query("pl15_head_per_dataset", "SELECT * FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row FROM documents) WHERE row <= 10")
def pl15(spark, sf):
    return S.head_per_dataset(B.table(spark, sf, "documents").select("source", "doc_id"), "source", "doc_id", 10)


@query("pl16_review_sample", f"WITH {B.REC} SELECT * FROM (SELECT id, scene, design_style, quality_score, row_number() OVER (PARTITION BY scene, design_style ORDER BY sha1('review:' || id), id) AS rank FROM rec WHERE quality_score BETWEEN 2.5e0 AND 3.5e0) WHERE rank <= 2")
def pl16(spark, sf):
    r = B.records(spark, sf).select("id", "scene", "design_style", "quality_score")
    return S.review_sample(r, "id", ["scene", "design_style"], "quality_score", 2)


# joint weights: brand share x type share-like factors, one row per brand, type and return flag
JOINT = """f AS (SELECT p_brand AS g, p_type || '/' || p_size AS o, count(*) AS w1, 1 + p_size % 4 AS w2, len(p_type) AS w3 FROM part GROUP BY p_brand, p_type, p_size),
j AS (SELECT g, o, (w1 * w2 * w3)::DOUBLE / (SELECT sum(w1 * w2 * w3)::DOUBLE FROM f) AS weight FROM f)"""


def joint(spark, sf):
    p = B.table(spark, sf, "part").groupBy("p_brand", "p_type", "p_size").agg(F.count("*").alias("w1"))
    rows = p.select(
        F.col("p_brand").alias("g"), F.concat("p_type", F.lit("/"), F.col("p_size").cast("string")).alias("o"), "w1",
        (1 + F.col("p_size") % 4).alias("w2"), F.length("p_type").alias("w3"),
    )
    return S.joint_weights(rows, ["w1", "w2", "w3"]).select("g", "o", "weight")


@query("pl17_joint_weights", f"WITH {JOINT} SELECT g, o, {s_round('weight', 9)} AS weight FROM j")
def pl17(spark, sf):
    return joint(spark, sf).select("g", "o", T.round_to(F.col("weight"), 9).alias("weight"))


@query("pl17_weighted_draws", f"""WITH {JOINT}, c AS (SELECT g, o, sum(w) OVER (ORDER BY g, o)::DOUBLE / sum(w) OVER ()::DOUBLE AS hi, sum(w) OVER (ORDER BY g, o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::DOUBLE / sum(w) OVER ()::DOUBLE AS lo FROM (SELECT g, o, w1 * w2 * w3 AS w FROM f)),
b AS (SELECT g, o, coalesce(lo, 0e0) AS lo, hi FROM c),
d AS (SELECT o_orderkey AS draw, {s_hash("'d1:' || o_orderkey")} / 4294967296e0 AS u FROM orders) SELECT draw, g, o FROM d JOIN b ON u >= lo AND u < hi""")
def pl17_draws(spark, sf):
    draws = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("draw"))
    return S.weighted_draws(joint(spark, sf), "g", "o", "weight", draws, "d1").select("draw", "g", "o")


@query("pl18_style_probabilities", f"""WITH a AS (SELECT c_nationkey AS grp, c_mktsegment AS style, (count(*) % 6)::BIGINT AS weight FROM customer GROUP BY 1, 2), e AS (SELECT *, exp(weight / 0.5e0) AS x FROM a WHERE weight > 0)
SELECT grp::BIGINT AS grp, style, weight, {s_round('x / sum(x) OVER (PARTITION BY grp)', 6)} AS prob FROM e""")
def pl18(spark, sf):
    a = B.table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("grp"), F.col("c_mktsegment").alias("style")).agg((F.count("*") % 6).alias("weight"))
    return S.style_probabilities(a, "grp", "weight").withColumn("prob", T.round_to(F.col("prob"), 6))


@query("pl19_follow_up_turns", f"""WITH t AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_index FROM conversations WHERE {s_hash("'mt:' || conv_id")} / 4294967296e0 < 0.1e0) SELECT * FROM t WHERE turn_index <= 2""")
def pl19(spark, sf):
    return S.follow_ups(B.table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", 0.1, "mt")


@query("pl20_drop_style_share", f"""WITH {B.REC} SELECT id, CASE WHEN {s_hash("'st:' || id")} / 4294967296e0 >= 0.3e0 THEN coalesce(design_style, 'unset') ELSE 'dropped' END AS style FROM rec""")
def pl20(spark, sf):
    kept = S.drop_value_for_share(F.coalesce("design_style", F.lit("unset")), F.col("id"), 0.3, "st")
    return B.records(spark, sf).select("id", F.coalesce(kept, F.lit("dropped")).alias("style"))


NEW_SQL = """nw AS (SELECT row_number() OVER (ORDER BY p_brand) AS n, p_brand FROM part GROUP BY p_brand), nx AS (SELECT 'scene_' || lpad((n + 25)::VARCHAR, 3, '0') AS id, n - 1 AS idx, p_brand AS l2_scene_label, '多媒体处理' AS l1_scene,
  [p_brand || '应用', p_brand || '工具'] AS candidates FROM nw)"""


@query("pl21_number_new_scenes", f"""WITH {NEW_SQL}, t AS (SELECT 'q_' || id || '_' || {s_pad('i + 1', 3)} AS query_id, id AS scene_id, l1_scene, l2_scene_label, candidates[1 + idx % 2] AS application_type, ({LEVELS})[1 + (idx + i) % 3] AS target_complexity, 0::BIGINT AS grp
  FROM nx, range(3) r(i)), {s_dress('t', 'grp', 'grp')} SELECT query_id, scene_id, application_type, product_type, target_complexity, persona_seed, 10::BIGINT AS target_count_hint FROM dressed""")
def pl21(spark, sf):
    brands = B.table(spark, sf, "part").select("p_brand").distinct()
    fresh = brands.select(
        F.col("p_brand").alias("l2_scene_label"), F.col("p_brand").alias("l2_scene_raw"), F.lit("多媒体处理").alias("l1_scene"),
        F.array().cast("array<string>").alias("l2_scene_examples"),
        F.array(F.concat("p_brand", F.lit("应用")), F.concat("p_brand", F.lit("工具"))).alias("candidates"),
    )
    numbered = P.number_new_scenes(fresh, B.scenes(spark, sf), "l2_scene_label")
    plan = P.seed_plan(numbered, minimum=3, maximum=3, fraction=0.01)
    return plan.select("query_id", "scene_id", "application_type", "product_type", "target_complexity", "persona_seed", "target_count_hint")
