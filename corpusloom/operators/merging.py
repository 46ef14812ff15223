"""Joins that merge plans, results, retries and lookups.

Lookup tables are joined without hints: Spark broadcasts them when its size
check allows, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T


def _substrings(c: Column, lengths: list[int]) -> Column:
    """The distinct substrings of a label that have one of the given lengths."""
    n = F.length(c)
    last = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(c, i, F.lit(k))))
    of = [F.coalesce(last(k), F.array().cast("array<string>")) for k in lengths]
    return F.array_distinct(F.concat(*of)) if of else F.array().cast("array<string>")


def _lengths(df: DataFrame, c: str) -> list[int]:
    """Distinct lengths of a label column: as many as the longest label has characters at most."""
    return sorted(r[0] for r in df.select(F.length(c)).filter(F.col(c).isNotNull()).distinct().collect())


def match_pool_key(scenes: DataFrame, pool_keys: DataFrame, id_col: str, label: str, raw: str, key: str, order: str) -> DataFrame:
    """(id, pool key): exact match first, else containment either way; first key in pool order.

    Containment is an equi join on substrings of the labels and keys that have a
    length found on the other side, so there is no pairwise comparison of scenes
    with keys.
    """
    keys = pool_keys.select(F.col(key).alias("k"), F.col(order).cast("long").alias("pos"), T.strip_ordinal(F.col(key)).alias("kn"))
    names = scenes.select(T.strip_ordinal(F.col(label)).alias("ln"), T.strip_ordinal(F.col(raw)).alias("rn")).distinct()
    pick = F.struct("pos", "k")

    exact = (
        names.select("ln", "rn", F.explode(F.array_distinct(F.array("ln", "rn"))).alias("kn"))
        .join(keys, "kn")
        .select("ln", "rn", F.lit(0).alias("tier"), pick.alias("hit"))
    )
    labels = names.select("ln").distinct()
    inside_label = labels.select("ln", F.explode(_substrings(F.col("ln"), _lengths(keys, "kn"))).alias("kn")).join(keys, "kn")
    inside_key = keys.select("k", "pos", F.explode(_substrings(F.col("kn"), _lengths(labels, "ln"))).alias("ln")).join(labels, "ln")
    near = (
        inside_label.select("ln", pick.alias("hit"))
        .unionByName(inside_key.select("ln", pick.alias("hit")))
        .groupBy("ln")
        .agg(F.min("hit").alias("hit"))
    )
    near = names.join(near, "ln").select("ln", "rn", F.lit(1).alias("tier"), "hit")
    best = exact.unionByName(near).groupBy("ln", "rn").agg(F.min(F.struct("tier", "hit")).alias("b"))
    best = best.select("ln", "rn", F.col("b.hit.k").alias(key))
    return (
        scenes.select(F.col(id_col), T.strip_ordinal(F.col(label)).alias("ln"), T.strip_ordinal(F.col(raw)).alias("rn"))
        .join(best, ["ln", "rn"], "left")
        .select(id_col, key)
    )


def lookup_with_default(
    df: DataFrame, table: DataFrame, key1: str, key2: str, map_key: str, map_value: str, default: str, name: str
) -> DataFrame:
    """First hit of two keys in a mapping table, else the default; of several values of a key the smallest."""
    table = table.filter(T.or_empty(F.col(map_value)) != "").groupBy(map_key).agg(F.min(map_value).alias(map_value))
    one = table.select(F.col(map_key).alias(key1), F.col(map_value).alias("_v1"))
    two = table.select(F.col(map_key).alias(key2), F.col(map_value).alias("_v2"))
    return (
        df.join(one, key1, "left").join(two, key2, "left")
        .withColumn(name, F.coalesce(T.blank_to_null(F.col("_v1")), T.blank_to_null(F.col("_v2")), F.lit(default)))
        .select(*df.columns, name)
    )


def infer_scene(records: DataFrame, scenes: DataFrame, id_col: str, app_type: str) -> DataFrame:
    """(id, scene_id): first scene with the same L1 and label that lists the application type."""
    flat = scenes.select(
        "l1_scene", "l2_scene_label", F.explode("candidates").alias(app_type), "idx", F.col("id").alias("scene_id")
    )
    first = flat.groupBy("l1_scene", "l2_scene_label", app_type).agg(F.min_by("scene_id", "idx").alias("scene_id"))
    return records.join(first, ["l1_scene", "l2_scene_label", app_type], "left").select(id_col, "scene_id")


def failed_with_plan(records: DataFrame, plan: DataFrame, id_col: str, failed: Column) -> DataFrame:
    """Plan rows whose record failed."""
    return plan.join(records.filter(failed).select(id_col), id_col, "left_semi")


def failed_without_plan(records: DataFrame, plan: DataFrame, id_col: str, failed: Column) -> DataFrame:
    return records.filter(failed).join(plan.select(id_col), id_col, "left_anti")


def pending_tasks(plan: DataFrame, done: DataFrame, id_col: str) -> DataFrame:
    """Resume: tasks that have no finished record."""
    return plan.join(done.select(id_col), id_col, "left_anti")


def _one_per_id(df: DataFrame, id_col: str, value: str, order: str | None) -> DataFrame:
    """The value of each id: the last by ``order``, without one the largest."""
    last = F.max(value) if order is None else F.max_by(value, F.struct(F.col("_order"), F.col(value)))
    return df.groupBy(id_col).agg(last.alias(value))


def merge_results(records: DataFrame, outputs: DataFrame, id_col: str = "id", order: str | None = None) -> DataFrame:
    """Fill failed records that have an output; all others stay as they are.

    ``records``: id, query_text, error, word_count, duration_ms, generator_mode.
    ``outputs``: id, query_text.  Blank outputs do not count; of several outputs of
    an id the last by ``order`` does.
    """
    rank = F.lit(0) if order is None else F.col(order)
    new = outputs.select(F.col(id_col), T.trim_ws(F.col("query_text")).alias("_new"), rank.alias("_order")).filter("_new <> ''")
    new = _one_per_id(new, id_col, "_new", order)
    joined = records.join(new, id_col, "left")
    hit = F.col("error").isNotNull() & F.col("_new").isNotNull()
    mode = F.when(F.col("error") == "PREP_ONLY_PENDING", "subagent-prep-only").otherwise("subagent-retry")
    return joined.select(
        id_col,
        F.when(hit, F.col("_new")).otherwise(F.col("query_text")).alias("query_text"),
        F.when(hit, T.word_count(F.col("_new"))).otherwise(F.col("word_count")).alias("word_count"),
        F.when(hit, F.lit(0).cast("double")).otherwise(F.col("duration_ms")).alias("duration_ms"),
        F.when(hit, mode).otherwise(F.col("generator_mode")).alias("generator_mode"),
        F.when(hit, None).otherwise(F.col("error")).alias("error"),
        F.when(hit, "recovered").when(F.col("error").isNotNull(), "still_failed").otherwise("unchanged").alias("merge_status"),
    )


def merge_translations(records: DataFrame, translations: DataFrame, id_col: str, old: str, order: str | None = None) -> DataFrame:
    """Take a new translation (the last by ``order``) for rows without error; an old one is never blanked."""
    rank = F.lit(0) if order is None else F.col(order)
    new = translations.select(F.col(id_col), F.col("query_text_zh").alias("_zh"), rank.alias("_order")).filter(T.or_empty(F.col("_zh")) != "")
    new = _one_per_id(new, id_col, "_zh", order)
    joined = records.join(new, id_col, "left")
    ok = F.col("error").isNull()
    return joined.select(
        id_col,
        F.when(ok, F.coalesce("_zh", old)).otherwise(F.col(old)).alias("query_text_zh"),
        F.when(~ok, "skipped").when(F.col("_zh").isNull(), "missing").otherwise("merged").alias("merge_status"),
    )


def share_first_per_seed(tasks: DataFrame, seed: str, order: str, carried: list[str]) -> DataFrame:
    """Give all tasks of one seed the values of the first task with that seed."""
    first = tasks.groupBy(seed).agg(F.min_by(F.struct(*carried), order).alias("_f"))
    return tasks.join(first, seed).select(
        *tasks.columns, *[F.col("_f")[c].alias(f"shared_{c}") for c in carried]
    )


def complement_levels(anchors: DataFrame, id_col: str, level: str, levels: list[str] = fv.COMPLEXITY_LEVELS) -> DataFrame:
    """One row per anchor and per level other than its own: a fixed fan-out, no join."""
    others = F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: x != F.coalesce(F.col(level), F.lit("")))
    rows = anchors.withColumn("_target", F.explode(others))
    anchor_id = F.col(id_col).cast("string")
    return (
        rows.withColumn("anchor_id", anchor_id)
        .withColumn("anchor_level", F.col(level))
        .withColumn(id_col, F.concat(anchor_id, F.lit("__xc__"), F.col("_target")))
        .withColumn(level, F.col("_target"))
        .withColumn("query_variant", F.lit("anchored_persona_xc_supplement"))
        .drop("_target")
    )


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def side_by_side(
    runs: DataFrame, id_col: str, run: str, value: str, run_names: list[str] | None = None, missing: str = "(missing)", most: int = 1000
) -> DataFrame:
    """One row per id, one column per run, by name; absent cells are explicit.

    The runs are those of the data (at most ``most``, an error beyond, since each is
    a column) or ``run_names``.  A row without a run fills no cell, its id stays.
    """
    names = run_names or sorted(r[0] for r in runs.select(run).distinct().filter(F.col(run).isNotNull()).limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"more than {most} runs: name the ones to compare")
    wide = runs.groupBy(id_col).pivot(run, names).agg(F.max(F.col(value).cast("string")))
    return wide.select(id_col, *[F.coalesce(F.col(f"`{r}`"), F.lit(missing)).alias(r) for r in names])


def matrix_cells(cells: DataFrame, rows: str, cols: str, topics: str, overrides: DataFrame, defaults: DataFrame, fallback: str) -> DataFrame:
    """Cells that hold topics, with persona override -> default -> fallback.

    Starting from the non-empty cells gives the matrix without building the
    empty part of the cross product.
    """
    kept = cells.filter(F.size(topics) > 0)
    return (
        kept.join(overrides.withColumnRenamed("persona", "_o"), [rows, cols], "left")
        .join(defaults.withColumnRenamed("persona", "_d"), cols, "left")
        .withColumn("persona", F.coalesce("_o", "_d", F.lit(fallback)))
        .drop("_o", "_d")
    )


def ablation_grid(scenes: DataFrame, methods: list[str], samples: int) -> DataFrame:
    """scene x method x sample as two fixed fan-outs."""
    grid = scenes.withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    return grid.withColumn("sample", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(samples).cast("long"))))


def rewrite_in_plan_order(existing: DataFrame, fresh: DataFrame, plan: DataFrame, id_col: str, order: str) -> DataFrame:
    """Rows of earlier plans first, then current rows in plan order; fresh rows win."""
    prior = existing.join(plan.select(id_col), id_col, "left_anti").withColumn("src", F.lit(0))
    old = existing.join(fresh.select(id_col), id_col, "left_anti")
    current = old.unionByName(fresh).join(plan.select(id_col, F.col(order).alias("_ord")), id_col).withColumn("src", F.lit(1))
    prior = prior.withColumn("_ord", F.lit(None).cast(current.schema["_ord"].dataType))
    return prior.unionByName(current).orderBy("src", "_ord", id_col)
