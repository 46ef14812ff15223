"""Generation plans: seed, backfill, quota, round-robin and candidate-cycling plans.

A plan starts from scenes (taxonomy rows) and fans each one out to numbered
tasks.  Window functions without a partition key only ever see taxonomy rows.

Scene columns: id, idx (0-based position), source_row_id, l1_scene,
l2_scene_raw, l2_scene_label, l2_scene_examples, candidates, target_count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fv
from corpusloom.functions import render as R
from corpusloom.functions import text as T
from corpusloom.sources.storage import materialized

CHUNK = 50_000
LEVELS = fv.COMPLEXITY_LEVELS


def pad(n: Column, width: int) -> Column:
    """Left-pad with zeros without ever cutting digits."""
    s = n.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def fan_out(scenes: DataFrame, count: str, i: str = "i", chunk: int = CHUNK) -> DataFrame:
    """One row per scene and i in 0..count-1.

    Large counts are cut into chunks and spread before the second step, so one
    scene with most of the tasks does not become one task's array.
    """
    n = F.col(count).cast("long")
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk))
    parts = scenes.filter(n > 0).withColumn("_part", F.explode(chunks)).repartition("id", "_part")
    last = F.least(n, (F.col("_part") + 1) * chunk) - 1
    return parts.withColumn(i, F.explode(F.sequence(F.col("_part") * chunk, last))).drop("_part")


def levels_at(i: Column, levels: list[str] = LEVELS) -> Column:
    return T.cyclic(F.array(*[F.lit(x) for x in levels]), i)


def seed_count(target: Column, minimum: int = 3, maximum: int = 9, fraction: float = 0.15) -> Column:
    t = F.coalesce(target.cast("double"), F.lit(0.0))
    n = F.greatest(F.lit(minimum), F.least(F.lit(maximum), T.round_half_up(t * F.lit(fraction))))
    return F.when(t == 0, F.lit(minimum)).otherwise(n).cast("long")


def _ruled(sources: DataFrame, expand: bool = False) -> DataFrame:
    """(_src, pts, sty): products and styles of each distinct source text.

    The keyword rules are long expressions.  They run once per text over a small
    written table, so that they are not repeated inside other expressions.
    """
    src = F.col("_src")
    texts = materialized(sources, "sources")
    pts = materialized(texts.select("_src", R.infer_products(src).alias("p0"), R.infer_styles(src).alias("s0")), "rules")
    if not expand:
        return pts.select("_src", F.col("p0").alias("pts"), F.col("s0").alias("sty"))
    return materialized(
        pts.select("_src", R.expand_products(src, F.col("p0")).alias("pts"), R.expand_styles(src, F.col("s0")).alias("sty")), "rules"
    )


def _dress(tasks: DataFrame, style, style_group: str, seed_group: str, plan_type: str) -> DataFrame:
    """Product type, style and persona seed of tasks that have application_type and ``group``."""
    tasks = tasks.withColumn("_src", F.concat_ws(" ", "l1_scene", "l2_scene_label", "application_type"))
    tasks = tasks.join(_ruled(tasks.select("_src").distinct()), "_src")
    look = T.cyclic(F.col("sty"), F.col(style_group)) if style == "auto" else R.resolve_style(style, F.col(style_group), F.col("_src"))
    return tasks.select(
        "*",
        T.cyclic(F.col("pts"), F.col("group")).alias("product_type"),
        look.alias("design_style"),
        T.short_hash(F.concat_ws(":", "scene_id", "application_type", F.col(seed_group).cast("string"))).alias("persona_seed"),
        F.lit(False).alias("constrained"),
        F.lit(plan_type).alias("plan_type"),
    )


TASK_COLUMNS = [
    "query_id", "scene_id", "l1_scene", "l2_scene_label", "l2_scene_raw", "l2_scene_examples", "application_type",
    "product_type", "constrained", "target_complexity", "design_style", "persona_seed", "plan_type", "target_count_hint",
]


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("id", "scene_id").withColumnRenamed("target_count", "target_count_hint")


def seed_plan(scenes: DataFrame, style=None, minimum: int = 3, maximum: int = 9, fraction: float = 0.15) -> DataFrame:
    """n tasks per scene; application, product and style rotate by groups of three, complexity by task."""
    counted = scenes.withColumn("_n", seed_count(F.col("target_count"), minimum, maximum, fraction))
    rows = _named(fan_out(counted, "_n")).withColumn("group", F.floor(F.col("i") / len(LEVELS)))
    rows = rows.select(
        "*",
        F.concat(F.lit("q_"), "scene_id", F.lit("_"), pad(F.col("i") + 1, 3)).alias("query_id"),
        T.cyclic(F.col("candidates"), F.col("idx") + F.col("group")).alias("application_type"),
        levels_at(F.col("idx") + F.col("i")).alias("target_complexity"),
    )
    return _dress(rows, style, "group", "group", "seed").select(*TASK_COLUMNS)


def backfill_plan(scenes: DataFrame, existing: DataFrame, scene_col: str = "scene_id", style=None, min_per_scene: int = 6) -> DataFrame:
    """Tasks that close the gap between target and existing rows; numbering and rotation continue."""
    have = existing.groupBy(F.col(scene_col).alias("id")).agg(F.count("*").alias("have"))
    rows = scenes.join(have, "id", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    wanted = F.coalesce(F.nullif(F.col("target_count").cast("long"), F.lit(0)), F.lit(min_per_scene))
    rows = rows.withColumn("gap", F.greatest(F.lit(0), wanted - F.col("have")))
    rows = _named(fan_out(rows, "gap"))
    rows = rows.withColumn("group", F.floor(F.col("i") / len(LEVELS))).withColumn(
        "later", F.floor(F.col("have") / len(LEVELS)) + F.col("group")
    )
    rows = rows.select(
        "*",
        F.concat(F.lit("q_"), "scene_id", F.lit("_"), pad(F.col("have") + F.col("i") + 1, 3)).alias("query_id"),
        T.cyclic(F.col("candidates"), F.col("have") + F.col("idx") + F.col("group")).alias("application_type"),
        levels_at(F.col("have") + F.col("idx") + F.col("i")).alias("target_complexity"),
    )
    return _dress(rows, style, "later", "later", "backfill").select(*TASK_COLUMNS, F.col("gap").alias("gap_after_snapshot"))


def allocate(scenes: DataFrame, total: Column | int, flat: bool = True, missing_weight: float = 0.0, name: str = "allocated") -> DataFrame:
    """Largest-remainder split of ``total``; ties go to the earlier scene.

    Default weight is the scene's target; with ``flat=False`` an L1 target that
    is repeated on every L2 row is shared among its rows.
    """
    everything = Window.partitionBy()
    weight = F.coalesce(F.nullif(F.col("target_count").cast("double"), F.lit(0.0)), F.lit(missing_weight))
    if not flat:
        weight = weight / F.count("*").over(Window.partitionBy("l1_scene"))
    goal = F.lit(total) if isinstance(total, int) else total
    rows = scenes.withColumn("_w", weight).withColumn("_goal", goal)
    rows = rows.withColumn("_sum", F.sum("_w").over(everything))
    share = F.col("_w") / F.when(F.col("_sum") == 0, 1.0).otherwise(F.col("_sum")) * F.col("_goal")
    # nine digits: equal shares stay ties whatever the order of the sum was
    rows = rows.withColumn("_raw", T.round_to(share, 9))
    rows = rows.withColumn("_floor", F.floor("_raw"))
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("_raw") - F.col("_floor")), "idx"))
    left = F.col("_goal") - F.sum("_floor").over(everything)
    given = F.col("_floor") + F.when(rank <= left, 1).otherwise(0)
    out = rows.withColumn(name, F.when(F.col("_goal") > 0, given).otherwise(0).cast("long"))
    return out.drop("_w", "_goal", "_sum", "_raw", "_floor")


QuotaStep = tuple[int, int, int, int]


def domain_products(l1: Column, table: dict[str, list[str]] = fv.DOMAIN_PRODUCTS) -> Column:
    """The products of a scene's domain, else the default ones."""
    found = F.array(*[F.lit(p) for p in fv.DEFAULT_PRODUCT_TYPES])
    for name, products in table.items():
        found = F.when(l1 == name, F.array(*[F.lit(p) for p in products])).otherwise(found)
    return found


def quota_part(
    scenes: DataFrame, steps: list[QuotaStep], plan_type: str, rotate_level: bool, rotate_product: bool,
    styles: list[str] | str | None = None,
) -> DataFrame:
    """Tasks per scene from (sequence number, level, application, product) offsets.

    With ``rotate_*`` the scene position is added to the offset.  Products are the
    scene's own (``products``) or those of its domain.  ``styles`` rotate by the
    task's number in the part, (position x steps + step); ``"auto"`` rotates
    ``fixed_values.QUOTA_STYLES``; without styles it is null.
    """
    if isinstance(styles, str):
        if styles != "auto":
            raise ValueError(f"styles are a list, 'auto' or None, not {styles!r}")
        styles = fv.QUOTA_STYLES
    fields = ("seq", "lv", "ap", "pt")
    offsets = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, s, strict=True)]) for s in steps])
    rows = _named(scenes).select("*", F.posexplode(offsets).alias("_k", "_s"))
    turn = F.col("idx") * len(steps) + F.col("_k")
    style = T.cyclic(F.array(*[F.lit(s) for s in styles]), turn) if styles else F.lit(None).cast("string")
    lv = F.col("_s.lv") + (F.col("idx") if rotate_level else F.lit(0))
    pt = F.col("_s.pt") + (F.col("idx") if rotate_product else F.lit(0))
    return rows.select(
        F.concat(F.lit("q_"), "scene_id", F.lit("_"), pad(F.col("_s.seq"), 3)).alias("query_id"), "scene_id", "l1_scene",
        "l2_scene_label", T.cyclic(F.col("candidates"), F.col("_s.ap")).alias("application_type"),
        T.cyclic(F.coalesce("products", domain_products(F.col("l1_scene"))), pt).alias("product_type"),
        levels_at(lv).alias("target_complexity"), style.alias("design_style"),
        T.short_hash(F.concat_ws(":", "scene_id", F.col("_s.seq").cast("string"), F.lit(plan_type))).alias("persona_seed"),
        F.lit(plan_type).alias("plan_type"),
    )


SECOND_ROUND = [(4, 1, 0, 1), (5, 2, 1, 2)]
LOW_COVERAGE = [(10, 0, 0, 3), (11, 1, 1, 4), (12, 2, 2, 5)]
NEW_DOMAIN = [(1, 0, 0, 0), (2, 1, 1, 1), (3, 2, 2, 2)]
BONUS, BONUS_PRODUCT = [(4, 2, 0, 0)], "dashboard"


def quota_plan(first: DataFrame, second: DataFrame, third: DataFrame, styles: list[str] | str | None = None) -> DataFrame:
    """Three offset parts in one plan; the first new scene (``idx`` 0 of ``third``) gets a fourth, complex task for a dashboard."""
    bonus = third.filter("idx = 0").withColumn("products", F.array(F.lit(BONUS_PRODUCT)))
    return (
        quota_part(first, SECOND_ROUND, "expand_r2", True, True, styles)
        .unionByName(quota_part(second, LOW_COVERAGE, "expand_b", False, False, styles))
        .unionByName(quota_part(third, NEW_DOMAIN, "expand_new", False, False, styles))
        .unionByName(quota_part(bonus, BONUS, "expand_new", False, False, styles))
    )


def duplicate_ids(plan: DataFrame, id_col: str = "query_id") -> DataFrame:
    return plan.groupBy(id_col).agg(F.count("*").alias("copies")).filter("copies > 1")


def round_robin_plan(scenes: DataFrame, scope: str = "scene") -> DataFrame:
    """One task per scene and product; a running number gives vague, medium, medium, ...

    ``scope`` 'scene' shares one persona seed per scene, 'task' gives each task its own.
    """
    sizes = scenes.select("id", "idx", F.size("products").alias("_n"))
    before = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("id", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rows = scenes.join(offset, "id").select("*", F.posexplode("products").alias("_p", "product_type"))
    rows = _named(rows).withColumn("seq", F.col("_off") + F.col("_p") + 1)
    seed = F.concat(F.lit("free_"), "scene_id") if scope == "scene" else F.concat(F.lit("free_"), "scene_id", F.lit("_"), F.col("seq").cast("string"))
    return rows.select(
        F.concat(F.lit("q_"), "scene_id", F.lit("_"), pad(F.col("seq"), 3)).alias("query_id"), "scene_id", "l1_scene",
        "l2_scene_label", F.get("candidates", F.lit(0)).alias("application_type"), "product_type",
        F.when((F.col("seq") - 1) % 3 == 0, "vague").otherwise("medium").alias("target_complexity"),
        F.substring(F.md5(seed), 1, 10).alias("persona_seed"), F.lit("free").alias("plan_type"),
    )


def first_scene_per_l1(scenes: DataFrame, exclude: list[str], k: int) -> DataFrame:
    """First scene of each L1 in input order, the first k of them; fails when there are fewer."""
    kept = scenes.filter(~F.col("l1_scene").isin(exclude)) if exclude else scenes
    first = kept.groupBy("l1_scene").agg(F.min("idx").alias("idx"))
    picked = kept.join(first, ["l1_scene", "idx"]).orderBy("idx").limit(k)
    found = first.agg(F.count("*")).scalar()
    enough = F.when(found >= k, True).otherwise(F.raise_error(F.concat(F.lit("too few L1 scenes: "), found.cast("string"))))
    return picked.filter(enough)


def candidate_plan(scenes: DataFrame, count: str) -> DataFrame:
    """Cycle expanded candidates, products and styles; complexity by (i + source row).

    Products and styles depend on scene and candidate only, so the rules run once
    for each of those, not once for each task.
    """
    names = R.candidate_names(F.col("l1_scene"), F.col("l2_scene_label"), F.col("l2_scene_examples"), F.col("candidates"))
    cands = materialized(scenes.select("id", "l1_scene", "l2_scene_label", names.alias("cands")), "candidates")
    per = cands.select("id", "l1_scene", "l2_scene_label", F.posexplode("cands").alias("k", "cand"))
    per = per.select("id", "k", "cand", F.concat_ws(" ", "l1_scene", "l2_scene_label", "cand.name").alias("_src"))
    ruled = _ruled(per.select("_src").distinct(), expand=True)
    per = per.join(ruled, "_src").select("id", "k", F.struct("cand.name", "cand.source", "pts", "sty").alias("c"))
    listed = per.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", "c"))).alias("dressed"))
    rows = scenes.join(listed, "id", "left")
    rows = _named(fan_out(rows, count)).withColumn("cand", F.get("dressed", F.pmod(F.col("i"), F.size("dressed")).cast("int"))["c"]).drop("dressed")
    rows = rows.withColumn("application_type", F.col("cand.name")).withColumn("application_type_source", F.col("cand.source"))
    rows = rows.withColumn("_pts", F.col("cand.pts")).withColumn("_sty", F.col("cand.sty"))
    rows = rows.select(
        "*",
        F.concat(F.lit("q5k_"), "scene_id", F.lit("_"), pad(F.col("i") + 1, 4)).alias("id"),
        T.cyclic(F.col("_pts"), F.col("i")).alias("product_type"),
        T.cyclic(F.col("_sty"), F.col("i")).alias("design_style"),
        levels_at(F.col("i") + F.col("source_row_id")).alias("target_complexity"),
    )
    seed = F.concat_ws(":", "scene_id", "application_type", "product_type", "target_complexity", F.col("i").cast("string"))
    return rows.select(
        "id", "scene_id", "l1_scene", "l2_scene_label", "l2_scene_examples", "application_type", "application_type_source",
        "product_type", "target_complexity", "design_style", T.short_hash(seed).alias("persona_seed"), "target_count_hint",
    )


def candidate_records(tasks: DataFrame, wording: R.Wording) -> DataFrame:
    """Persona and deterministic text for each task of a candidate plan."""
    rows = tasks.withColumn(
        "p", R.persona_struct(F.col("id"), F.col("persona_seed"), F.col("target_complexity"), F.col("application_type"), F.col("l2_scene_label"))
    )
    source = F.concat_ws(" ", "l1_scene", "l2_scene_label", "application_type")
    rows = rows.withColumn("_lens", R.scene_lens(source, wording))
    fields = {"app": F.col("application_type"), "product": F.col("product_type"), "style": F.col("design_style")}
    seed = R.record_seed(F.col("id"), *fields.values())
    rows = rows.withColumn("query_text", R.text_by_level(F.col("target_complexity"), fields, wording, seed, F.col("_lens")))
    return rows.select(*tasks.columns, F.col("_lens.name").alias("lens"), "p.persona_id", "p.persona_title", "p.persona_source", "query_text",
                       F.length("query_text").cast("long").alias("query_length"))


def number_new_scenes(fresh: DataFrame, existing: DataFrame, order: str, target: int = 10) -> DataFrame:
    """Give new scenes ids after the current maximum and a fixed target."""
    top = existing.select(F.coalesce(F.max(F.regexp_extract("id", r"(\d+)$", 1).cast("long")), F.lit(0))).scalar()
    n = F.row_number().over(Window.orderBy(order)).cast("long")
    rows = fresh.withColumn("_n", n)
    return rows.select(
        F.concat(F.lit("scene_"), pad(F.col("_n") + top, 3)).alias("id"), (F.col("_n") - 1).alias("idx"),
        (F.col("_n") + top).alias("source_row_id"), "l1_scene", "l2_scene_raw", "l2_scene_label", "l2_scene_examples",
        "candidates", F.lit(target).cast("long").alias("target_count"),
    )
