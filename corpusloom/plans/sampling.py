"""Seeded samples, strata, weighted draws.  All randomness is a hash of seed and key, so
results do not depend on partitioning and survive recomputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.ranking import top_k
from corpusloom.sources.storage import materialized


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: str) -> DataFrame:
    """n rows with the smallest hash: a distributed top-n, not a sort."""
    return df.orderBy(F.sha1(F.concat(F.lit(seed), F.lit(":"), F.col(id_col).cast("string"))), id_col).limit(n)


def head_per_dataset(df: DataFrame, dataset: str, order: str, n: int) -> DataFrame:
    return top_k(df, [dataset], [F.asc(order)], n, "row")


def review_sample(
    df: DataFrame, id_col: str, strata: list[str], score: str, k: int, low: float = 2.5, high: float = 3.5, seed: str = "review"
) -> DataFrame:
    """k borderline rows per stratum in hash order."""
    order = F.sha1(F.concat(F.lit(seed), F.lit(":"), F.col(id_col).cast("string")))
    return top_k(df.filter(F.col(score).between(low, high)), strata, [order, F.asc(id_col)], k)


def style_probabilities(affinity: DataFrame, group: str, weight: str, temperature: float = 0.5) -> DataFrame:
    """Softmax per group over positive affinities."""
    kept = affinity.filter(F.col(weight) > 0).withColumn("_e", F.exp(F.col(weight) / F.lit(temperature)))
    sums = kept.groupBy(group).agg(F.sum("_e").alias("_s"))
    return kept.join(sums, group).withColumn("prob", F.col("_e") / F.col("_s")).drop("_e", "_s")


def joint_weights(rows: DataFrame, factors: list[str], name: str = "weight") -> DataFrame:
    """Product of factor columns, normalised to sum to 1."""
    product = F.lit(1.0)
    for f in factors:
        product = product * F.col(f).cast("double")
    raw = rows.withColumn("_p", product)
    total = raw.agg(F.sum("_p")).scalar()
    return raw.withColumn(name, F.col("_p") / total).drop("_p")


def weighted_draws(combos: DataFrame, group: str, order: str, weight: str, draws: DataFrame, seed: str, chunk: int = 1024) -> DataFrame:
    """Draw with replacement: one combination per row of ``draws`` (draw id).

    Each combination owns an interval of [0, 1), from its cumulative weight to
    where the next one starts, in full double precision: no interval is rounded
    away or widened.  Combinations stand in the order of (``group``, ``order``) by one range
    sort, in chunks of ``chunk`` rows.  Weights are summed per chunk, chunks per
    partition, and partitions over all, so no sum runs over a whole group.  A draw
    meets its chunk on one of as many equal cells as there are chunks, and its
    combination on one of ``chunk`` cells of that chunk's interval: two equi joins.
    Null weights count as zero and are never drawn.
    """
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    ranged = combos.repartitionByRange(group, order).sortWithinPartitions(group, order)
    stored = materialized(ranged.withColumn("_at", F.monotonically_increasing_id()), "weights")
    rows = stored.withColumn("_chunk", F.floor(F.col("_at") / chunk)).withColumn("_w", w)
    chunks = rows.groupBy(F.shiftright("_at", 33).alias("_part"), "_chunk").agg(F.sum("_w").alias("_cw"))
    parts = chunks.groupBy("_part").agg(F.sum("_cw").alias("_pw"))  # one row per partition

    def ahead(over) -> Column:
        return over.rowsBetween(Window.unboundedPreceding, -1)

    line, inside = Window.orderBy("_part"), Window.partitionBy("_part").orderBy("_chunk")
    total = F.sum("_pw").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.select("_part", total.alias("_total"), F.coalesce(F.sum("_pw").over(ahead(line)), F.lit(0.0)).alias("_p0"))
    parts = parts.withColumn("_p1", F.coalesce(F.lead("_p0").over(line), F.col("_total")))
    spans = chunks.join(parts, "_part").withColumn("_c0", F.least(F.col("_p0") + F.coalesce(F.sum("_cw").over(ahead(inside)), F.lit(0.0)), F.col("_p1")))
    spans = spans.withColumn("_c1", F.coalesce(F.lead("_c0").over(inside), F.col("_p1"))).filter("_c1 > _c0")
    spans = materialized(spans.select("_chunk", "_c0", "_c1", "_total"), "weight-chunks")
    cells = max(1, spans.count())

    def upto(low: Column, high: Column, n: int) -> Column:
        last = F.lit(n - 1).cast("long")
        return F.explode(F.sequence(F.least(low, last), F.least(high, last)))

    from_, to = F.col("_c0") / F.col("_total"), F.col("_c1") / F.col("_total")
    marked = spans.withColumn("_cell", upto(F.floor(from_ * cells), F.floor(to * cells), cells))
    u = T.unit_hash(F.concat(F.lit(seed), F.lit(":"), F.col("draw").cast("string")))
    thrown = draws.select("draw", u.alias("u")).withColumn("_cell", F.floor(F.col("u") * cells))
    thrown = thrown.join(marked, "_cell").filter((F.col("u") >= from_) & (F.col("u") < to))

    def sub(x: Column) -> Column:
        return F.floor((x - from_) / (to - from_) * chunk)

    own = Window.partitionBy("_chunk").orderBy("_at")
    placed = rows.join(spans, "_chunk").withColumn("_lo", F.least(F.col("_c0") + F.coalesce(F.sum("_w").over(ahead(own)), F.lit(0.0)), F.col("_c1")))
    placed = placed.withColumn("_hi", F.coalesce(F.lead("_lo").over(own), F.col("_c1"))).filter("_hi > _lo")
    lo, hi = F.col("_lo") / F.col("_total"), F.col("_hi") / F.col("_total")
    placed = placed.withColumn("_sub", upto(sub(lo), sub(hi), chunk)).select("_chunk", "_sub", lo.alias("_lo"), hi.alias("_hi"), *combos.columns)
    thrown = thrown.select("draw", "u", "_chunk", F.least(sub(F.col("u")), F.lit(chunk - 1).cast("long")).alias("_sub"))
    hit = (F.col("u") >= F.col("_lo")) & (F.col("u") < F.col("_hi"))
    return thrown.join(placed, ["_chunk", "_sub"]).filter(hit).select("draw", "u", *combos.columns)


def follow_ups(turns: DataFrame, conv: str, turn: str, share: float, seed: str) -> DataFrame:
    """First and second turn of a hashed share of conversations, with a turn index."""
    chosen = T.unit_hash(F.concat(F.lit(seed), F.lit(":"), F.col(conv).cast("string"))) < share
    return top_k(turns.filter(chosen), [conv], [F.asc(turn)], 2, "turn_index")


def drop_value_for_share(c: Column, key: Column, share: float, seed: str) -> Column:
    """Null for a hashed share of rows, the value otherwise."""
    u = T.unit_hash(F.concat(F.lit(seed), F.lit(":"), key.cast("string")))
    return F.when(u >= share, c)
