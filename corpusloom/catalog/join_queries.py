"""JN: lookups, selections and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import bindings as B
from corpusloom.catalog.placing import placed
from corpusloom.catalog.base import query, s_hash, s_strip_ordinal, s_words
from corpusloom.functions import text as T
from corpusloom.operators import merging as M


def label_scenes(spark, sf):
    """supplier as scenes whose labels match pool keys exactly, by containment or not at all."""
    k = F.col("s_suppkey")
    name = F.concat(F.lit("Brand#"), (k % 27).cast("string"))
    label = (
        F.when(k % 4 == 0, F.concat(F.lit("① "), name)).when(k % 4 == 1, F.concat(F.lit("all of "), name, F.lit(" goods")))
        .when(k % 4 == 2, F.concat(F.lit("rand#"), (k % 3).cast("string"))).otherwise("no match")
    )
    return B.table(spark, sf, "supplier").select(k.alias("id"), label.alias("l2_scene_label"), F.when(k % 8 == 3, name).otherwise("x").alias("l2_scene_raw"))


MATCH = f"""sl AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN '① Brand#' || s_suppkey % 27 WHEN 1 THEN 'all of Brand#' || s_suppkey % 27 || ' goods' WHEN 2 THEN 'rand#' || s_suppkey % 3 ELSE 'no match' END AS label,
  CASE WHEN s_suppkey % 8 = 3 THEN 'Brand#' || s_suppkey % 27 ELSE 'x' END AS raw FROM supplier),
{B.POOL}, pk AS (SELECT l2, min(l2_pos) AS pos FROM pool GROUP BY 1),
hit AS (SELECT sl.id, arg_min(l2, [CASE WHEN l2 = {s_strip_ordinal('label')} OR l2 = raw THEN 0 ELSE 1 END, pos]) AS l2 FROM sl JOIN pk
  ON l2 = {s_strip_ordinal('label')} OR l2 = raw OR contains(l2, {s_strip_ordinal('label')}) OR contains({s_strip_ordinal('label')}, l2) GROUP BY 1)"""


@query("jn01_match_pool_key", f"WITH {MATCH} SELECT sl.id, coalesce(hit.l2, 'none') AS l2 FROM sl LEFT JOIN hit USING (id)")
def jn01(spark, sf):
    keys = B.pool(spark, sf).groupBy("l2").agg(F.min("l2_pos").alias("l2_pos"))
    out = M.match_pool_key(label_scenes(spark, sf), keys, "id", "l2_scene_label", "l2_scene_raw", "l2", "l2_pos")
    return out.select("id", F.coalesce("l2", F.lit("none")).alias("l2"))


@query("jn02_two_key_lookup", """WITH m AS (SELECT n_name AS k, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'p' || n_nationkey END AS v FROM nation WHERE n_nationkey < 18 UNION ALL SELECT r_name, 'r' || r_regionkey FROM region WHERE r_regionkey < 3),
c AS (SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, coalesce(nullif(a.v, ''), nullif(b.v, ''), 'maker') AS persona FROM c LEFT JOIN m a ON a.k = n_name LEFT JOIN m b ON b.k = r_name""")
def jn02(spark, sf):
    n, r = B.table(spark, sf, "nation"), B.table(spark, sf, "region")
    table = n.filter("n_nationkey < 18").select(
        F.col("n_name").alias("k"), F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.concat(F.lit("p"), F.col("n_nationkey").cast("string"))).alias("v")
    ).unionByName(r.filter("r_regionkey < 3").select(F.col("r_name").alias("k"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("v")))
    c = B.table(spark, sf, "customer")
    tasks = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "n_name", "r_name")
    return M.lookup_with_default(tasks, table, "n_name", "r_name", "k", "v", "maker", "persona").select("c_custkey", "persona")


@query("jn03_infer_scene", f"""WITH {B.SCN}, q AS (SELECT c_custkey AS id, l1_scene, l2_scene_label, candidates[1 + c_custkey % 9] AS app FROM customer JOIN scn ON idx = c_nationkey)
SELECT q.id, coalesce((SELECT arg_min(s.id, s.idx) FROM scn s WHERE s.l1_scene = q.l1_scene AND s.l2_scene_label = q.l2_scene_label AND list_contains(s.candidates, q.app)), 'none') AS scene_id FROM q""")
def jn03(spark, sf):
    s = B.scenes(spark, sf)
    c = B.table(spark, sf, "customer")
    q = c.join(s.select("idx", "l1_scene", "l2_scene_label", "candidates"), c.c_nationkey == F.col("idx")).select(
        F.col("c_custkey").alias("id"), "l1_scene", "l2_scene_label", F.get("candidates", (F.col("c_custkey") % 9).cast("int")).alias("app")
    )
    return M.infer_scene(q, s, "id", "app").select("id", F.coalesce("scene_id", F.lit("none")).alias("scene_id"))


def orders(spark, sf):
    return B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), "o_custkey")


@query("jn04_failed_rows_with_plan", """SELECT o_orderkey AS id, CASE WHEN o_custkey % 10 = 0 THEN 'unrecoverable' ELSE 'retry' END AS state FROM orders WHERE o_orderstatus = 'P'""")
def jn04(spark, sf):
    o = orders(spark, sf)
    plan = o.filter("o_custkey % 10 <> 0")
    failed = F.col("status") == "P"
    return M.failed_with_plan(o, plan, "id", failed).select("id", F.lit("retry").alias("state")).unionByName(
        M.failed_without_plan(o, plan, "id", failed).select("id", F.lit("unrecoverable").alias("state"))
    )


@query("jn05_pending_tasks", "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'")
def jn05(spark, sf):
    o = orders(spark, sf)
    return M.pending_tasks(o, o.filter("status = 'F'"), "id").select("id")


MERGED = f"""{B.EREC}, {B.OUTS}, j AS (SELECT erec.*, nullif(outs.query_text, '') AS fresh FROM erec LEFT JOIN outs USING (id)), k AS (SELECT *, error IS NOT NULL AND fresh IS NOT NULL AS hit FROM j)"""


@query("jn06_merge_results", f"""WITH {MERGED} SELECT id, CASE WHEN hit THEN fresh ELSE query_text END AS query_text, CASE WHEN hit THEN {s_words('fresh')} ELSE word_count END AS word_count,
  CASE WHEN hit THEN 0e0 ELSE duration_ms END AS duration_ms, CASE WHEN NOT hit THEN generator_mode WHEN error = 'PREP_ONLY_PENDING' THEN 'subagent-prep-only' ELSE 'subagent-retry' END AS generator_mode,
  CASE WHEN hit THEN '' ELSE coalesce(error, '') END AS error, CASE WHEN hit THEN 'recovered' WHEN error IS NOT NULL THEN 'still_failed' ELSE 'unchanged' END AS merge_status FROM k""")
def jn06(spark, sf):
    out = M.merge_results(B.run_records(spark, sf), B.batch_outputs(spark, sf))
    return out.withColumn("error", F.coalesce("error", F.lit("")))


@query("jn06_merge_counts", f"WITH {MERGED} SELECT CASE WHEN hit THEN 'recovered' WHEN error IS NOT NULL THEN 'still_failed' ELSE 'unchanged' END AS merge_status, count(*) AS n FROM k GROUP BY 1")
def jn06_counts(spark, sf):
    return M.merge_results(B.run_records(spark, sf), B.batch_outputs(spark, sf)).groupBy("merge_status").agg(F.count("*").alias("n"))


@query("jn07_merge_translations", f"""WITH {B.EREC}, t AS (SELECT id, 'zh ' || id AS zh FROM erec WHERE user_id % 2 = 0 AND id % 7 <> 0)
SELECT erec.id, CASE WHEN error IS NOT NULL THEN old ELSE coalesce(zh, old) END AS query_text_zh, CASE WHEN error IS NOT NULL THEN 'skipped' WHEN zh IS NULL THEN 'missing' ELSE 'merged' END AS merge_status
FROM (SELECT *, CASE WHEN id % 5 = 0 THEN 'kept' ELSE '' END AS old FROM erec) erec LEFT JOIN t USING (id)""")
def jn07(spark, sf):
    r = B.run_records(spark, sf).withColumn("old", F.when(F.col("id") % 5 == 0, "kept").otherwise(""))
    t = r.filter("user_id % 2 = 0").select("id", F.when(F.col("id") % 7 == 0, "").otherwise(F.concat(F.lit("zh "), F.col("id").cast("string"))).alias("query_text_zh"))
    return M.merge_translations(r.select("id", "error", "old"), t, "id", "old")


@query("jn08_share_persona_by_seed", f"""WITH {B.REC}, f AS (SELECT scene, arg_min(l1, id) AS l, min(id) AS i FROM rec GROUP BY 1) SELECT id, rec.scene, l AS shared_l1, i AS shared_id FROM rec JOIN f USING (scene)""")
def jn08(spark, sf):
    r = B.records(spark, sf).select("id", "scene", "l1")
    return M.share_first_per_seed(r, "scene", "id", ["l1", "id"]).select("id", "scene", "shared_l1", "shared_id")


XC = """xc AS (SELECT rec.id || '__xc__' || v.l AS id, v.l AS target_complexity, rec.id::VARCHAR AS anchor_id, rec.target_complexity AS anchor_level, persona_title FROM rec JOIN (VALUES ('vague'), ('medium'), ('complex')) v(l) ON v.l <> rec.target_complexity)"""


@query("jn09_complement_levels", f"WITH {B.REC}, {XC} SELECT id, target_complexity, anchor_id, anchor_level, coalesce(persona_title, '') AS persona_title FROM xc")
def jn09(spark, sf):
    r = B.records(spark, sf).select("id", "target_complexity", "persona_title")
    return M.complement_levels(r, "id", "target_complexity").select("id", "target_complexity", "anchor_id", "anchor_level", F.coalesce("persona_title", F.lit("")).alias("persona_title"))


@query("jn10_anchors_and_supplements", f"WITH {B.REC}, {XC} SELECT id::VARCHAR AS id, target_complexity, 'anchor' AS variant FROM rec UNION ALL SELECT id, target_complexity, 'anchored_persona_xc_supplement' FROM xc")
def jn10(spark, sf):
    r = B.records(spark, sf).select("id", "target_complexity")
    sup = M.complement_levels(r, "id", "target_complexity")
    both = M.union_all(r.withColumn("id", F.col("id").cast("string")), sup)
    return both.select("id", "target_complexity", F.coalesce("query_variant", F.lit("anchor")).alias("variant"))


@query("jn11_side_by_side_runs", """SELECT user_id, coalesce(max(event_id::VARCHAR) FILTER (WHERE event_type = 'click'), '(missing)') AS click,
  coalesce(max(event_id::VARCHAR) FILTER (WHERE event_type = 'error'), '(missing)') AS error, coalesce(max(event_id::VARCHAR) FILTER (WHERE event_type = 'purchase'), '(missing)') AS purchase,
  coalesce(max(event_id::VARCHAR) FILTER (WHERE event_type = 'signup'), '(missing)') AS signup, coalesce(max(event_id::VARCHAR) FILTER (WHERE event_type = 'view'), '(missing)') AS view FROM events GROUP BY 1""")
def jn11(spark, sf):
    return M.side_by_side(B.table(spark, sf, "events"), "user_id", "event_type", "event_id")


@query("jn12_matrix_cells", """WITH c AS (SELECT c_nationkey AS u, c_mktsegment AS t, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT u, t, n, CASE WHEN u % 4 = 0 AND t IN ('BUILDING', 'MACHINERY') THEN 'curator' WHEN t = 'BUILDING' THEN 'planner' WHEN t = 'HOUSEHOLD' THEN 'operator' ELSE 'maker' END AS persona,
  row_number() OVER (ORDER BY u, t) AS cell_no FROM (SELECT u::BIGINT AS u, t, n FROM c WHERE n % 3 <> 0)""")
def jn12(spark, sf):
    c = B.table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("u"), F.col("c_mktsegment").alias("t")).agg(F.count("*").alias("n"))
    cells = c.withColumn("topics", F.when(F.col("n") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("t"))))
    n = B.table(spark, sf, "nation").filter("n_nationkey % 4 = 0")
    overrides = n.select(F.col("n_nationkey").cast("long").alias("u"), F.explode(F.array(F.lit("BUILDING"), F.lit("MACHINERY"))).alias("t"), F.lit("curator").alias("persona"))
    defaults = c.select("t").distinct().filter(F.col("t").isin("BUILDING", "HOUSEHOLD")).withColumn("persona", F.when(F.col("t") == "BUILDING", "planner").otherwise("operator"))
    from pyspark.sql import Window

    out = M.matrix_cells(cells, "u", "t", "topics", overrides, defaults, "maker")
    # at most users x uses cells: taxonomy-sized
    return out.withColumn("cell_no", F.row_number().over(Window.orderBy("u", "t")).cast("long")).select("u", "t", "n", "persona", "cell_no")


@query("jn13_ablation_grid", f"WITH {B.SCN} SELECT id, m.method, s.sample::BIGINT AS sample FROM scn, (VALUES ('a'), ('b'), ('c'), ('d')) m(method), range(1, 4) s(sample)")
def jn13(spark, sf):
    return M.ablation_grid(B.scenes(spark, sf).select("id"), ["a", "b", "c", "d"], 3)


@query("jn14_rewrite_in_plan_order", """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' OR o_orderstatus = 'P' THEN 1 ELSE 0 END AS src, CASE WHEN o_orderstatus = 'P' THEN 'fresh' ELSE 'old' END AS origin,
  CASE WHEN o_orderstatus = 'O' THEN -1 ELSE o_orderkey * 7 % 1000 END AS plan_idx,
  row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'O' THEN -1 ELSE o_orderkey * 7 % 1000 END, o_orderkey) AS place FROM orders""")
def jn14(spark, sf):
    o = orders(spark, sf)
    plan = o.filter("status in ('F', 'P')").select("id", (F.col("id") * 7 % 1000).alias("plan_idx"))
    existing = o.filter("status <> 'P'").select("id", F.lit("old").alias("origin"))
    fresh = o.filter("status = 'P'").select("id", F.lit("fresh").alias("origin"))
    out = M.rewrite_in_plan_order(existing, fresh, plan, "id", "plan_idx")
    out = out.select("id", F.col("src").cast("long").alias("src"), "origin", F.coalesce("_ord", F.lit(-1)).alias("plan_idx"))
    return placed(out)
