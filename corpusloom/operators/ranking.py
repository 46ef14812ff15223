"""Ranks, quantiles and running numbers that never sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group.

    Spark pushes a ``row_number <= k`` filter below the shuffle
    (WindowGroupLimit), so a hot group sends k rows per task, not all of them.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("long"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; pruned before the shuffle like ``top_k``."""
    return top_k(df, keys, order, 1, "_first").drop("_first")


def range_of(df: DataFrame, order: str, ranges: int) -> Column:
    """The number of the range a value falls in; ranges hold about equally many rows.

    Borders are approximate quantiles of the column itself, so neither sparse ids
    nor one far value empties or fills a range; at most ``ranges`` borders reach the
    driver.  Equal values share a range.
    """
    shares = F.array(*[F.lit((i + 1) / ranges) for i in range(ranges - 1)])
    borders = df.agg(F.percentile_approx(order, shares, 10 * ranges).alias("b")).first()[0] if ranges > 1 else None
    if not borders:
        return F.lit(0)
    above = [(F.col(order) > F.lit(b)).cast("int") for b in sorted(set(borders))]
    while len(above) > 1:  # pairwise, so that the sum is not deep
        above = [a + b for a, b in zip(above[::2], above[1::2], strict=False)] + ([above[-1]] if len(above) % 2 else [])
    return F.coalesce(above[0], F.lit(0))


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null; the key columns of ``left`` stay."""
    named = right.withColumnsRenamed({k: f"_k_{i}" for i, k in enumerate(keys)})
    same = [left[k].eqNullSafe(named[f"_k_{i}"]) for i, k in enumerate(keys)]
    on = same[0]
    for cond in same[1:]:
        on = on & cond
    return left.join(named, on).drop(*[f"_k_{i}" for i in range(len(keys))])


def running_index(
    df: DataFrame, by: list[str], order: str, ranges: int | None = None, name: str = "idx", start: int = 1,
    coarse: tuple[str, ...] = (),
) -> DataFrame:
    """Number rows 1..n within ``by`` in the order of (``coarse``, ``order``); nulls come first, null groups count too.

    One range sort on (``by``, ``coarse``, ``order``) places the rows: Spark samples the
    splitters, so the partitions (``ranges`` of them, else as many as the session
    shuffles into) hold about equally many rows, whether a group holds most of the
    data or ``coarse`` has one value only.  The sorted rows are written with their
    place; a group's rows before a partition, summed over the partitions it spans,
    are the partition's offset.  No row is looked at by a window.
    """
    keys = [*by, *coarse, order]
    ranged = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    # the id holds the partition in its upper bits and the place in it in the lower 33
    sorted_rows = materialized(ranged.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    counts = sorted_rows.groupBy(*by, part).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    numbered = _meet(sorted_rows.withColumn("_part", part), offsets, [*by, "_part"])
    return numbered.withColumn(name, (F.col("_offset") + F.col("_at") + start).cast("long")).select(*df.columns, name)


def forward_fill(df: DataFrame, order: str, column: str, ranges: int = 64) -> DataFrame:
    """Fill nulls of ``column`` with the last value before them, range by range."""
    ranged = df.withColumn("_range", range_of(df, order, ranges))
    marks = ranged.groupBy("_range").agg(F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order))).alias("_last"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(column, ignorenulls=True).over(inside), F.col("_carry"))
    return ranged.join(carried, "_range").withColumn(column, filled).select(*df.columns)


def _index_of(n: Column, p: float) -> Column:
    return F.least(n - 1, F.floor(n * F.lit(float(p))))


def floor_quantiles(
    df: DataFrame, by: list[str], value: str, probs: dict[str, float], weight: str | None = None, buckets: int = 16,
    most: int = 1_000_000,
) -> DataFrame:
    """``sorted[min(n-1, floor(n*p))]`` per group and probability; nulls are the lowest values.

    Values are first folded to (value, count), so repeated values cost nothing.  Then
    by repeated counting: every group is cut into ``buckets`` by quantiles of its own
    values, counts per bucket tell which ones hold a wanted index, and only those go
    on.  A bucket of more than ``most`` values is cut again, so neither a group that
    holds most rows nor one that lies in a narrow range is ranked in one task.
    """
    w = F.lit(1) if weight is None else F.col(weight)
    levels = materialized(df.groupBy(*by, value).agg(F.sum(w).alias("_c")), "levels")
    totals = levels.groupBy(*by).agg(F.sum("_c").alias("_n"))
    open_ = _meet(levels, totals, by).withColumn("_low", F.lit(0).cast("long"))
    keys, largest = [*by, "_low"], None
    wanted = F.array(*[_index_of(F.col("_n"), p) for p in probs.values()])
    shares = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    while buckets > 1:
        # written once: approximate quantiles depend on the order partial results arrive in, and both passes below must see the same cuts
        cuts = materialized(open_.groupBy(*keys).agg(F.percentile_approx(value, shares, 10 * buckets).alias("_cuts")), "cuts")
        above = sum((F.coalesce((F.get("_cuts", F.lit(i)) < F.col(value)).cast("int"), F.lit(0)) for i in range(buckets - 1)), F.lit(0))
        placed = _meet(open_, cuts, keys).withColumn("_b", F.when(F.col(value).isNull(), -1).otherwise(above)).drop("_cuts")
        sums = placed.groupBy(*keys, "_n", "_b").agg(F.sum("_c").alias("_m"), F.count("*").alias("_levels"))
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_start", (F.col("_low") + F.coalesce(F.sum("_m").over(before), F.lit(0))).cast("long"))
        holds = F.exists(wanted, lambda i: (i >= F.col("_start")) & (i < F.col("_start") + F.col("_m")))
        sums = materialized(sums.filter(holds).select(*keys, "_b", "_start", "_levels"), "buckets")
        open_ = _meet(placed, sums, [*keys, "_b"]).withColumn("_low", F.col("_start")).drop("_b", "_start", "_levels")
        widest = sums.agg(F.max("_levels")).first()[0] or 0
        if widest <= most or widest == largest:
            break
        open_, largest = materialized(open_, "levels"), widest
    upto = F.col("_low") + F.sum("_c").over(Window.partitionBy(*keys).orderBy(value))
    picked = open_.withColumn("_want", wanted).withColumn("_upto", upto).withColumn("_lowr", F.col("_upto") - F.col("_c"))
    out = [
        F.min(
            F.when(
                (F.get("_want", F.lit(i)) >= F.col("_lowr")) & (F.get("_want", F.lit(i)) < F.col("_upto")), F.col(value)
            )
        ).alias(name)
        for i, name in enumerate(probs)
    ]
    return picked.groupBy(*by).agg(*out)


def profile_by_value(folded: DataFrame, by: list[str], value: str, weight: str, probs: dict[str, float], aggs: list[Column]) -> DataFrame:
    """Floor-index quantiles and other aggregates of (value, weight) rows in one pass.

    For values with few distinct levels (word counts): the window sees one row
    per level.
    """
    total = F.sum(weight).over(Window.partitionBy(*by))
    upto = F.sum(weight).over(Window.partitionBy(*by).orderBy(value))
    rows = folded.withColumn("_n", total).withColumn("_upto", upto)

    def at(p: float) -> Column:
        i = _index_of(F.col("_n"), p)
        return F.max(F.when((i < F.col("_upto")) & (i >= F.col("_upto") - F.col(weight)), F.col(value)))

    return rows.groupBy(*by).agg(*[at(p).alias(name) for name, p in probs.items()], *aggs)


def upper_median(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """``sorted[floor(n/2)]`` per group."""
    return floor_quantiles(df, by, value, {name: 0.5})
