"""Topic pools and plans anchored to them.

Pool rows are (l2, topic, pos): ``pos`` is the position in the pool and breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import render as R
from corpusloom.functions import tagging as G
from corpusloom.functions import text as T
from corpusloom.operators.merging import match_pool_key
from corpusloom.operators.ranking import running_index, top_k
from corpusloom.plans import tasks as P


def usage_order(pool: DataFrame, usage: DataFrame) -> DataFrame:
    """(l2, topic, uses, rank, size): topics by least use, then pool position."""
    rows = pool.select("l2", "topic", F.col("pos").cast("long").alias("pos")).join(usage.select("l2", "topic", "uses"), ["l2", "topic"], "left")
    rows = rows.withColumn("uses", F.coalesce("uses", F.lit(0)).cast("long"))
    ranked = running_index(rows, ["l2"], "pos", name="rank", coarse=("uses",))
    sizes = pool.groupBy("l2").agg(F.count("*").alias("size"))
    return ranked.join(sizes, "l2")


def pick_least_used(pool: DataFrame, usage: DataFrame, wanted: DataFrame, chunk: int = P.CHUNK) -> DataFrame:
    """k topics per l2 in usage order, starting over when k exceeds the pool.

    ``wanted``: (l2, k).  Cycling is a fan-out of each topic to the picks it
    fills (rank, rank + size, ...), so no pick row has to look its topic up.
    """
    ranked = usage_order(pool, usage).join(wanted.select("l2", F.col("k").cast("long").alias("k")), "l2")
    rounds = F.when(F.col("rank") <= F.col("k"), F.floor((F.col("k") - F.col("rank")) / F.col("size")) + 1).otherwise(0)
    spread = P.fan_out(ranked.withColumn("_r", rounds).withColumn("id", F.concat_ws(":", "l2", "topic")), "_r", "round", chunk)
    return spread.select("l2", (F.col("rank") - 1 + F.col("round") * F.col("size")).alias("i"), "topic", "uses")


def corpus_plan(
    scenes: DataFrame, pool: DataFrame, usage: DataFrame, total: Column | int | None, exclude_l1: list[str] = (),
    levels: tuple[str, ...] = ("medium",), style=None, flat: bool = False,
) -> DataFrame:
    """Scenes -> quota -> pool key -> least-used topics -> tasks.

    A topic replaces the application type; scenes without a pool fall back to
    their own candidates.  Positions are computed after the exclusion.
    """
    kept = scenes.filter(~G.excluded(F.col("l1_scene"), list(exclude_l1)))
    kept = kept.withColumn("idx", (F.row_number().over(Window.orderBy("idx")) - 1).cast("long"))
    if total is None:
        counted = kept.withColumn("allocated", P.seed_count(F.col("target_count")))
    else:
        counted = P.allocate(kept, total, flat=flat)
    keys = pool.groupBy("l2").agg(F.min("l2_pos").alias("l2_pos"))
    match = match_pool_key(counted, keys, "id", "l2_scene_label", "l2_scene_raw", "l2", "l2_pos")
    counted = counted.join(match, "id").withColumnRenamed("l2", "corpus_l2_key")

    rows = P._named(P.fan_out(counted, "allocated"))
    rows = rows.withColumn("group", F.floor(F.col("i") / len(levels)))
    ranked = usage_order(pool, usage).select(F.col("l2").alias("corpus_l2_key"), F.col("topic").alias("corpus_topic"), "rank", "size")
    sizes = ranked.select("corpus_l2_key", "size").distinct()
    rows = rows.join(sizes, "corpus_l2_key", "left").withColumn("rank", F.pmod(F.col("i"), F.col("size")) + 1).drop("size")
    rows = rows.join(ranked.drop("size"), ["corpus_l2_key", "rank"], "left")
    rows = rows.select(
        "*",
        F.concat(F.lit("q_"), "scene_id", F.lit("_"), P.pad(F.col("i") + 1, 3)).alias("query_id"),
        F.coalesce("corpus_topic", T.cyclic(F.col("candidates"), F.col("idx") + F.col("group"))).alias("application_type"),
        P.levels_at(F.col("i"), list(levels)).alias("target_complexity"),
    )
    return P._dress(rows, style, "group", "group", "corpus_seed").select(*P.TASK_COLUMNS, "corpus_topic", "corpus_l2_key")


#: New topics are placed after all pool topics.
NEW_BASE = 1 << 40


def merge_topics(pool: DataFrame, fresh: DataFrame, cap: int) -> DataFrame:
    """Add new topics per L2: normalised de-duplication, order kept, at most ``cap`` topics.

    ``fresh``: (l2, topic, pos).  Only L2 keys of the pool are taken, those of
    empty cells (topic null) too.  Adds ``origin`` ('pool' or 'new').  Pool topics
    are never dropped; a cell that stays empty keeps its null row.
    """
    known = pool.select("l2").distinct()
    new = fresh.filter(T.or_empty(T.trim_ws(F.col("topic"))) != "").join(known, "l2", "left_semi")
    new = new.select("l2", T.trim_ws(F.col("topic")).alias("topic"), F.col("pos").cast("long").alias("pos"))
    new = new.withColumn("nk", T.dedup_key(F.col("topic")))
    once = new.groupBy("l2", "nk").agg(F.min_by(F.struct("topic", "pos"), "pos").alias("t"))
    taken = pool.select("l2", T.dedup_key(F.col("topic")).alias("nk")).distinct()
    once = once.join(taken, ["l2", "nk"], "left_anti").select("l2", "t.topic", "t.pos")
    room = pool.groupBy("l2").agg(F.greatest(F.lit(0).cast("long"), F.lit(cap) - F.count("topic")).alias("room"))
    # at most ``cap`` new topics can be taken, so the limit prunes before the shuffle
    ranked = top_k(once, ["l2"], [F.asc("pos")], cap, "rk").join(room, "l2").filter(F.col("rk") <= F.col("room"))
    filled = ranked.select("l2").distinct()
    empty = pool.filter("topic IS NULL").join(filled, "l2", "left_anti")
    kept = pool.filter("topic IS NOT NULL").unionByName(empty)
    return kept.select("l2", "topic", F.col("pos").cast("long").alias("pos"), F.lit("pool").alias("origin")).unionByName(
        ranked.select("l2", "topic", (F.col("pos") + F.lit(NEW_BASE)).alias("pos"), F.lit("new").alias("origin"))
    )


def merge_counts(pool: DataFrame, fresh: DataFrame, merged: DataFrame, cap: int) -> DataFrame:
    """Per L2: offered, added, duplicates dropped before the cap was reached, and rows beyond it.

    Offered topics are read in order until the cell is full: up to there a topic is
    added or, if its normalised form is known, dropped.  Blank topics are not offered.
    """
    given = fresh.filter(T.or_empty(T.trim_ws(F.col("topic"))) != "")
    offered = given.groupBy("l2").agg(F.count("*").alias("offered"))
    new_pos = F.when(F.col("origin") == "new", F.col("pos") - F.lit(NEW_BASE))
    cells = merged.groupBy("l2").agg(F.count_if(F.col("origin") == "new").alias("added"), F.count("topic").alias("pool_now"), F.max(new_pos).alias("last"))
    started = F.col("pool_now") - F.col("added") < cap
    full = cells.withColumn("last", F.when(~started, -1).when(F.col("pool_now") >= cap, F.col("last")))
    # a cell that never fills is read to its end
    read = given.join(full.select("l2", "last"), "l2").filter(F.col("last").isNull() | (F.col("pos") <= F.col("last")))
    seen = read.groupBy("l2").agg(F.count("*").alias("read"))
    none = F.lit(0).cast("long")
    return full.join(offered, "l2", "left").join(seen, "l2", "left").select(
        "l2", F.coalesce("offered", none).alias("offered"), "added", "pool_now", (F.coalesce("read", none) - F.col("added")).alias("dropped"),
        (F.coalesce("offered", none) - F.coalesce("read", none)).alias("beyond_cap"),
    )


def fill_to_target(pool: DataFrame, fresh: DataFrame, target: int) -> DataFrame:
    """Append offered topics that differ from the cell's in lower case, then cut the cell to ``target``.

    Unlike ``merge_topics`` repeats among the offered topics stay, and a cell over
    the target loses its last topics.
    """
    known = pool.select("l2").distinct()
    low = lambda c: F.lower(c)
    taken = pool.filter("topic IS NOT NULL").select("l2", low(F.col("topic")).alias("low")).distinct()
    new = fresh.filter(T.or_empty(T.trim_ws(F.col("topic"))) != "").join(known, "l2", "left_semi")
    new = new.select("l2", T.trim_ws(F.col("topic")).alias("topic"), (F.col("pos") + F.lit(NEW_BASE)).alias("pos")).withColumn("low", low(F.col("topic")))
    new = new.join(taken, ["l2", "low"], "left_anti").select("l2", "topic", "pos", F.lit("new").alias("origin"))
    own = pool.filter("topic IS NOT NULL").select("l2", "topic", F.col("pos").cast("long").alias("pos"), F.lit("pool").alias("origin"))
    return top_k(own.unionByName(new), ["l2"], [F.asc("pos")], target, "rank")


def extend_arrays(base: DataFrame, extra: DataFrame, key: str, topics: str) -> DataFrame:
    """Base topics followed by extra ones per key; keys only in ``extra`` are ignored."""
    more = extra.select(key, F.col(topics).alias("_more"))
    none = F.array().cast("array<string>")
    return base.join(more, key, "left").select(key, F.concat(topics, F.coalesce("_more", none)).alias(topics))


def gap_worklist(pool: DataFrame, target: int) -> DataFrame:
    """Cells below the target and how many topics they need."""
    sizes = pool.groupBy("l2").agg(F.count("topic").alias("current"))
    return sizes.filter(F.col("current") < target).withColumn("need", F.lit(target).cast("long") - F.col("current"))


def expansion_prompts(pool: DataFrame, target: int, platform: str) -> DataFrame:
    """Prompt per cell below the target, with its existing topics listed in pool order.

    A prompt holds the cell's topics, of which there are fewer than ``target``.
    """
    need = gap_worklist(pool, target)
    listed = pool.join(need.select("l2"), "l2", "left_semi").groupBy("l2").agg(F.sort_array(F.collect_list(F.when(F.col("topic").isNotNull(), F.struct("pos", "topic")))).alias("t"))
    rows = need.join(listed, "l2").select(
        "l2", "current", "need", F.lit(platform).alias("platform"), R.numbered(F.transform("t", lambda x: x["topic"])).alias("existing")
    )
    return rows.select("l2", "platform", "current", "need", R.render(R.EXPANSION_TEMPLATE).alias("prompt"))
