"""EM and ST: embeddings and incremental operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import bindings as B
from corpusloom.catalog.base import query, s_ratio, s_round
from corpusloom.functions import text as T
from corpusloom.operators import vectors as V
from corpusloom.plans.topics import pick_least_used
from corpusloom.sources.storage import new_folder
from corpusloom.streaming import incremental as I


def emb(spark, sf):
    return B.table(spark, sf, "embeddings").withColumn("label", F.col("label").cast("long"))


def rounded(vec, digits=6):
    return F.array_join(F.transform(vec, lambda x: F.format_number(T.round_to(x, digits), digits)), "|")


UNIT = """un AS (SELECT vec_id, label::BIGINT AS label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS u FROM embeddings)"""


@query("em01_l2_normalize", f"WITH {UNIT}, c AS (SELECT vec_id, generate_subscripts(u, 1) AS pos, unnest(u) AS v FROM un) SELECT vec_id, pos, {s_round('v', 6)} AS v FROM c")
def em01(spark, sf):
    cells = emb(spark, sf).select("vec_id", F.posexplode(V.l2_normalize(F.col("embedding"))).alias("p", "v"))
    return cells.select("vec_id", (F.col("p") + 1).cast("long").alias("pos"), T.round_to(F.col("v"), 6).alias("v"))


@query("em02_mean_pool", f"""WITH c AS (SELECT label::BIGINT AS label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE vec_id % 5 <> 0)
SELECT label, pos, {s_round('avg(v)', 6)} AS m, count(*) AS rows FROM c GROUP BY 1, 2""")
def em02(spark, sf):
    pooled = V.mean_pool(emb(spark, sf), "label", "embedding", F.col("vec_id") % 5 != 0)
    cells = pooled.select("label", "rows", F.posexplode("mean").alias("p", "m"))
    return cells.select("label", (F.col("p") + 1).cast("long").alias("pos"), T.round_to(F.col("m"), 6).alias("m"), "rows")


@query("em03_pca")
def em03(spark, sf):
    pcs = V.project(emb(spark, sf), "vec_id", "embedding", 3)
    return pcs.select("vec_id", *[F.abs(F.get("pcs", F.lit(i))).alias(f"pc{i + 1}") for i in range(3)])


@query("em03_pca_laws", """WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT 'trace' AS law, floor((SELECT sum(s) FROM (SELECT var_samp(v) AS s FROM c GROUP BY pos)) * 1e6 + 0.5) / 1e6 AS value
UNION ALL SELECT 'largest_mean', 0e0 UNION ALL SELECT 'largest_correlation', 0e0 UNION ALL SELECT 'out_of_order', 0e0 UNION ALL SELECT 'first_three_differ', 0e0""")
def em03_laws(spark, sf):
    """What defines the scores: variances sum to the trace and fall, scores are centred and uncorrelated, k = 3 is a prefix."""
    e = emb(spark, sf).select("vec_id", "embedding")
    d = len(e.first().embedding)
    cells = V.project(e, "vec_id", "embedding", d).select("vec_id", F.posexplode("pcs").alias("p", "v"))
    three = V.project(e, "vec_id", "embedding", 3).select("vec_id", F.posexplode("pcs").alias("p", "w"))
    per = cells.groupBy("p").agg(F.var_samp("v").alias("s"), F.avg("v").alias("m"))
    zero = lambda c: T.round_to(c, 6)
    law = lambda df, name, c: df.agg(c.alias("value")).select(F.lit(name).alias("law"), "value")
    nearby = cells.join(cells.filter("p < 8").select("vec_id", F.col("p").alias("q"), F.col("v").alias("w")), "vec_id").filter("p < q")
    corr = nearby.groupBy("p", "q").agg(F.corr("v", "w").alias("r"))
    steps = per.join(per.select((F.col("p") - 1).alias("p"), F.col("s").alias("next")), "p")
    same = cells.join(three, ["vec_id", "p"])
    return (
        law(per, "trace", zero(F.sum("s"))).unionByName(law(per, "largest_mean", zero(F.max(F.abs("m")))))
        .unionByName(law(corr, "largest_correlation", zero(F.max(F.abs("r")))))
        .unionByName(law(steps, "out_of_order", F.sum(F.when(F.col("next") > F.col("s") + 1e-12, 1.0).otherwise(0.0))))
        .unionByName(law(same, "first_three_differ", zero(F.max(F.abs(F.abs("v") - F.abs("w"))))))
    )


@query("em04_min_max_rescale", f"""WITH v AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, 5e0 AS flat FROM embeddings), b AS (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM v)
SELECT vec_id, {s_round('2 * (x - lx) / (hx - lx) - 1', 4)} AS x, {s_round('2 * (y - ly) / (hy - ly) - 1', 4)} AS y, -1e0 AS flat FROM v, b""")
def em04(spark, sf):
    v = emb(spark, sf).select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"), F.lit(5.0).alias("flat"))
    return V.min_max_rescale(v, ["x", "y", "flat"])


STRUCT = f"""{UNIT}, uc AS (SELECT label, generate_subscripts(u, 1) AS pos, unnest(u) AS v FROM un), mc AS (SELECT label, pos, avg(v) AS m FROM uc GROUP BY 1, 2), ml AS (SELECT label, list(m ORDER BY pos) AS m FROM mc GROUP BY 1),
ce AS (SELECT label, list_transform(m, lambda x: x / sqrt(list_sum(list_transform(m, lambda y: y * y)))) AS c FROM ml),
si AS (SELECT un.vec_id, un.label, ce.label AS cl, list_sum(list_transform(range(1, len(u) + 1), lambda i: u[i] * c[i])) AS sim FROM un, ce),
st AS (SELECT vec_id, label, max(sim) FILTER (WHERE cl = label) AS own_sim, max(sim) FILTER (WHERE cl <> label) AS other_sim, arg_max(cl, sim) FILTER (WHERE cl <> label) AS other_label FROM si GROUP BY 1, 2)"""


@query("em05_label_structure", f"WITH {STRUCT} SELECT vec_id, label, {s_round('own_sim', 5)} AS own_sim, {s_round('other_sim', 5)} AS other_sim, other_label FROM st")
def em05(spark, sf):
    s = V.label_structure(emb(spark, sf), "vec_id", "label", "embedding")
    return s.select("vec_id", "label", T.round_to(F.col("own_sim"), 5).alias("own_sim"), T.round_to(F.col("other_sim"), 5).alias("other_sim"), "other_label")


@query("em05_label_purity", f"WITH {STRUCT} SELECT label, count(*) AS rows, {s_round('avg(own_sim)', 5)} AS mean_own, {s_round('avg(other_sim)', 5)} AS mean_other, {s_ratio('count(*) FILTER (WHERE own_sim > other_sim)', 'count(*)')} AS share_own_nearest FROM st GROUP BY 1")
def em05_purity(spark, sf):
    return V.label_purity(emb(spark, sf), "vec_id", "label", "embedding")


@query("em06_label_distribution", "SELECT CASE WHEN label % 4 = 0 THEN '—' ELSE label::VARCHAR END AS label, count(*) AS n FROM embeddings GROUP BY 1")
def em06(spark, sf):
    label = F.when(F.col("label") % 4 != 0, F.col("label").cast("string"))
    return emb(spark, sf).groupBy(F.coalesce(label, F.lit("—")).alias("label")).agg(F.count("*").alias("n"))


def stream_of(spark, sf, name):
    """A given table as a file stream."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query("st01_append_once", "SELECT event_id AS id, event_type AS platform, value FROM events")
def st01(spark, sf):
    """Events come in two runs, the later ones first; every third is replayed in both.  Each id is stored once."""
    e = B.table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("platform"), "value", F.col("ts").cast("timestamp").alias("ts"))
    early, replayed = F.dayofmonth("ts") <= 15, F.col("id") % 3 == 0
    root = new_folder(spark, "stream")
    for part in (e.filter(~early).unionByName(e.filter(~early & replayed)), e.filter(early | replayed)):
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(e.schema).parquet(f"{root}/in")
        I.append_finished(stream, "id", "ts", f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("id", "platform", "value")


@query("st02_running_usage", f"WITH {B.USAGE} SELECT * FROM usg")
def st02(spark, sf):
    li = stream_of(spark, sf, "lineitem").select("l_partkey")
    p = B.table(spark, sf, "part").select("p_partkey", "p_brand")
    used = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("l2"), F.col("l_partkey").cast("string").alias("topic"))
    root = new_folder(spark, "usage")
    I.track_usage(used, "l2", "topic", f"{root}/out", f"{root}/checkpoint")
    return I.current_usage(spark, f"{root}/out")


def usage_runs(spark, sf):
    """Usage in three runs of the stream, each a restart, folded into a version after every one: (folder of batches, folder of versions)."""
    p = B.table(spark, sf, "part").select("p_partkey", "p_brand")
    li = B.table(spark, sf, "lineitem").select("l_partkey", "l_linenumber")
    root = new_folder(spark, "usage")
    for part in (li.filter("l_linenumber <= 2"), li.filter("l_linenumber between 3 and 4"), li.filter("l_linenumber > 4")):
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(li.schema).parquet(f"{root}/in").join(p, F.col("l_partkey") == F.col("p_partkey"))
        used = stream.select(F.col("p_brand").alias("l2"), F.col("l_partkey").cast("string").alias("topic"))
        I.track_usage(used, "l2", "topic", f"{root}/out", f"{root}/checkpoint")
        I.fold_usage(spark, f"{root}/out", f"{root}/versions", buckets=8)
    return f"{root}/out", f"{root}/versions"


@query("st02_usage_snapshot", f"WITH {B.USAGE} SELECT * FROM usg")
def st02_snapshot(spark, sf):
    out, versions = usage_runs(spark, sf)
    return I.current_usage(spark, out, versions)


@query("st02_plan_from_snapshot", f"""WITH {B.POOL}, {B.USAGE}, early AS (SELECT p_brand AS l2, p_partkey::VARCHAR AS topic, count(*) AS uses FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 2 GROUP BY ALL),
sized AS (SELECT *, count(*) OVER (PARTITION BY l2) AS size FROM pool),
counted AS (SELECT 2 AS version, l2, topic, pos, size, coalesce(uses, 0) AS uses FROM sized LEFT JOIN usg USING (l2, topic)
  UNION ALL SELECT 0, l2, topic, pos, size, coalesce(uses, 0) FROM sized LEFT JOIN early USING (l2, topic)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY version, l2 ORDER BY uses, pos) - 1 AS i FROM counted)
SELECT version, l2, i, topic, uses FROM numbered WHERE i < size // 2 + 1""")
def st02_plan(spark, sf):
    """The next topics of every brand by the first version of the usage and by the newest."""
    _, versions = usage_runs(spark, sf)
    pool = B.pool(spark, sf)
    want = pool.groupBy("l2").agg((F.floor(F.count("*") / 2) + 1).alias("k"))
    plans = [pick_least_used(pool, I.usage_at(spark, versions, v), want).withColumn("version", F.lit(v)) for v in (0, 2)]
    return plans[0].unionByName(plans[1]).select("version", "l2", "i", "topic", "uses")
