"""How the given tables play the roles of the engine's inputs.

Each binding exists twice: as a DataFrame for the queries and as a common table
expression for the oracles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog.base import s_distinct, s_tags
from corpusloom.functions import fixed_values as fv
from corpusloom.functions import render as R
from corpusloom.functions import text as T
from corpusloom.sources.storage import spread_small_input

STYLES = ["Minimalism", "Dark", "Luxury"]
PRODUCTS = ["form_flow", "dashboard", "portfolio", "landing_page"]
PERSONA_SOURCES = ["deterministic_persona_fallback", "llm_persona_synthesis", "fallback"]
SEGMENTS = {
    "AUTOMOBILE": "旅行相册", "BUILDING": "数据报表", "FURNITURE": "商品订单", "HOUSEHOLD": "成长打卡", "MACHINERY": "任务待办",
}
SCENE_WORDS = ["旅行行程", "任务管理", "资讯阅读", "数据仪表盘", "音视频播放"]
REGIONS = {
    "AFRICA": "出行助手", "AMERICA": "办公效率", "ASIA": "健康管理", "EUROPE": "新闻资讯", "MIDDLE EAST": "购物消费",
}


TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread_small_input(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


def nth(items: list[str], i: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in items]), i.cast("int"))


def mapped(c: Column, table_: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: acc.when(c == kv[0], kv[1]), list(table_.items())[1:], F.when(c == list(table_)[0], list(table_.values())[0]))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """documents with labels as scored prompt records."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    i = F.col("doc_id")
    rows = d.join(lab, "doc_id", "left")
    return rows.select(
        i.alias("id"), F.col("source").alias("scene"), F.col("lang").alias("l1"), "text", "n_chars",
        nth(fv.COMPLEXITY_LEVELS, i % 3).alias("target_complexity"),
        F.when(i % 4 != 0, nth(STYLES, F.floor(i / 4) % 3)).alias("design_style"),
        nth(PRODUCTS, F.floor(i / 3) % 4).alias("product_type"),
        F.when(i % 7 == 0, None).when(i % 5 == 0, fv.GENERIC_APP).otherwise(F.concat("source", F.lit("应用"))).alias("application_type"),
        F.when(i % 6 != 0, F.concat(F.lit("persona "), (i % 5).cast("string"))).alias("persona_title"),
        nth(PERSONA_SOURCES, F.floor(i / 2) % 3).alias("persona_source"),
        F.when(F.col("quality").isNotNull(), F.lit(1) + (F.col("n_chars") % 41) / F.lit(10.0)).alias("quality_score"),
        (F.col("quality") == 1).alias("quality_pass"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (i % 28).cast("int")), "yyyy-MM-dd").alias("created_at"),
    )


REC = """rec AS (
  SELECT d.doc_id AS id, d.source AS scene, d.lang AS l1, d.text, d.n_chars,
    (['vague', 'medium', 'complex'])[1 + d.doc_id % 3] AS target_complexity,
    CASE WHEN d.doc_id % 4 <> 0 THEN (['Minimalism', 'Dark', 'Luxury'])[1 + (d.doc_id // 4) % 3] END AS design_style,
    (['form_flow', 'dashboard', 'portfolio', 'landing_page'])[1 + (d.doc_id // 3) % 4] AS product_type,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.doc_id % 5 = 0 THEN '通用内容应用' ELSE d.source || '应用' END AS application_type,
    CASE WHEN d.doc_id % 6 <> 0 THEN 'persona ' || (d.doc_id % 5) END AS persona_title,
    (['deterministic_persona_fallback', 'llm_persona_synthesis', 'fallback'])[1 + (d.doc_id // 2) % 3] AS persona_source,
    CASE WHEN l.quality IS NOT NULL THEN 1 + (d.n_chars % 41) / 10e0 END AS quality_score,
    l.quality = 1 AS quality_pass,
    strftime(DATE '2024-01-01' + (d.doc_id % 28)::INTEGER, '%Y-%m-%d') AS created_at
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    """region / nation as a two-level taxonomy; targets count customers, examples are strong segments."""
    seg = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("c"))
    per = seg.groupBy("c_nationkey").agg(
        F.sum("c").alias("t"), F.collect_list(F.struct("c", mapped(F.col("c_mktsegment"), SEGMENTS).alias("zh"))).alias("s")
    )
    strong = F.transform(F.filter("s", lambda x: x["c"] * 5 >= F.col("t")), lambda x: x["zh"])
    per = per.select(F.col("c_nationkey").alias("n_nationkey"), "t", F.array_sort(strong).alias("exs"))
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    k = F.col("n_nationkey").cast("long")
    name = F.concat(nth(SCENE_WORDS, F.floor(k / 5) % 5), F.col("n_name"))
    shown = F.when(F.size("exs") > 0, F.concat(F.lit("（"), F.array_join("exs", "、"), F.lit("）"))).otherwise("")
    raw = F.concat(F.when(k % 3 == 0, "①").otherwise(""), name, F.coalesce(shown, F.lit("")))
    base = (
        n.join(r, n.n_regionkey == r.r_regionkey).join(per, "n_nationkey", "left")
        .select(
            F.concat(F.lit("scene_"), F.lpad((k + 1).cast("string"), 3, "0")).alias("id"), k.alias("idx"),
            (k + 1).alias("source_row_id"), mapped(F.col("r_name"), REGIONS).alias("l1_scene"), raw.alias("l2_scene_raw"),
            F.coalesce("t", F.lit(0)).cast("long").alias("target_count"), F.col("n_name"), F.col("r_name"),
        )
    )
    label, examples = T.split_label(F.col("l2_scene_raw"))
    base = base.withColumn("l2_scene_label", label).withColumn("l2_scene_examples", examples)
    return base.withColumn(
        "candidates", R.application_candidates(F.col("l1_scene"), F.col("l2_scene_label"), F.col("l2_scene_examples"))
    )


def _values(d: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in d.items())


SCN = f"""seg AS (SELECT c_nationkey AS nk, c_mktsegment AS s, count(*) AS c FROM customer GROUP BY 1, 2),
tot AS (SELECT nk, sum(c)::BIGINT AS t FROM seg GROUP BY 1),
exs AS (SELECT nk, list(zh ORDER BY zh) AS exs FROM seg JOIN tot USING (nk) JOIN (VALUES {_values(SEGMENTS)}) z(s, zh) USING (s)
  WHERE c * 5 >= t GROUP BY 1),
base AS (SELECT 'scene_' || lpad((n_nationkey + 1)::VARCHAR, 3, '0') AS id, n_nationkey::BIGINT AS idx,
    (n_nationkey + 1)::BIGINT AS source_row_id, zr AS l1_scene,
    (['{"', '".join(SCENE_WORDS)}'])[1 + (n_nationkey // 5) % 5] || n_name AS l2_scene_label,
    coalesce(exs, []) AS l2_scene_examples, coalesce(t, 0) AS target_count, n_name, r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey JOIN (VALUES {_values(REGIONS)}) zz(r_name, zr) USING (r_name)
  LEFT JOIN exs ON exs.nk = n_nationkey LEFT JOIN tot ON tot.nk = n_nationkey),
cand AS (SELECT *, list_transform(l2_scene_examples, lambda e: e || '应用')
    || {s_tags("(l1_scene || ' ' || l2_scene_label || ' ' || array_to_string(l2_scene_examples, ' '))", fv.APPLICATION_RULES)} AS c0
  FROM base),
scn AS (SELECT * EXCLUDE (c0), (CASE WHEN idx % 3 = 0 THEN '①' ELSE '' END) || l2_scene_label
    || CASE WHEN len(l2_scene_examples) > 0 THEN '（' || array_to_string(l2_scene_examples, '、') || '）' ELSE '' END AS l2_scene_raw,
    CASE WHEN len(c0) = 0 THEN [l2_scene_label || '应用'] ELSE {s_distinct('c0')} END AS candidates
  FROM cand)"""


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """part as a topic pool: brand -> part keys of small parts."""
    p = table(spark, sf, "part").filter(F.col("p_size") <= 25)
    return p.select(
        F.col("p_brand").alias("l2"), F.col("p_partkey").cast("string").alias("topic"), F.col("p_partkey").alias("pos"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long").alias("l2_pos"),
    )


POOL = r"""pool AS (SELECT p_brand AS l2, p_partkey::VARCHAR AS topic, p_partkey AS pos,
    regexp_extract(p_brand, '(\d+)$', 1)::BIGINT AS l2_pos FROM part WHERE p_size <= 25)"""


def topic_records(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as finished records: topic = part, l2 = its brand, platform = return flag."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_brand").alias("l2"), F.col("l_partkey").cast("string").alias("topic"), F.col("l_returnflag").alias("platform")
    )


TREC = """trec AS (SELECT p_brand AS l2, l_partkey::VARCHAR AS topic, l_returnflag AS platform
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def usage(spark: SparkSession, sf: str) -> DataFrame:
    return topic_records(spark, sf).groupBy("l2", "topic").agg(F.count("*").alias("uses"))


USAGE = TREC + """,
usg AS (SELECT l2, topic, count(*) AS uses FROM trec GROUP BY 1, 2)"""


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """events as run records: failed when the type is error."""
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("text of "), F.col("event_id").cast("string")).alias("query_text"),
        F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "PREP_ONLY_PENDING").otherwise("TIMEOUT")).alias("error"),
        F.lit(3).cast("long").alias("word_count"), F.col("value").alias("duration_ms"), F.lit("direct").alias("generator_mode"),
        F.col("event_type").alias("platform"), F.concat(F.lit("v"), F.date_format("ts", "dd")).alias("version"), "user_id", "ts", "props",
    )


EREC = """erec AS (SELECT event_id AS id, 'text of ' || event_id AS query_text,
    CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'PREP_ONLY_PENDING' ELSE 'TIMEOUT' END END AS error,
    3::BIGINT AS word_count, value AS duration_ms, 'direct' AS generator_mode, event_type AS platform,
    'v' || strftime(ts, '%d') AS version, user_id, ts, props FROM events)"""


def batch_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs for records of even users; some are blank."""
    e = run_records(spark, sf).filter(F.col("user_id") % 2 == 0)
    text = F.when(F.col("id") % 10 == 0, "  ").otherwise(F.concat(F.lit("  new text for record "), F.col("id").cast("string"), F.lit(" \n")))
    return e.select("id", text.alias("query_text"))


OUTS = r"""outs AS (SELECT id, CASE WHEN id % 10 = 0 THEN '' ELSE 'new text for record ' || id END AS query_text
  FROM erec WHERE user_id % 2 = 0)"""
