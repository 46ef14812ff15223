"""Mix sources to target weights with Sainte-Lague quotas of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
#: A word with the white space after it, or white space that starts a text.
PIECE = f"(?<=[{SPACE}])(?=[^{SPACE}])"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sources: DataFrame, cap: float) -> DataFrame:
    """Add ``target``: shares of the whole size by ``weight``, none above ``cap`` times its size.

    Water filling in closed form: with sources sorted by cap / weight, the first k
    stop at their caps and the rest share what is left by weight; k is the first
    for which the next source stays under its cap.
    """
    ceiling = F.col("size") * F.lit(cap)
    by = [F.col("_ratio"), F.col("ordinal")]
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    all_rows = Window.partitionBy()
    levels = (
        sources.withColumn("_cap", ceiling).withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("size").over(all_rows).cast("double"))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.col("_weights"))
        .withColumn("_fits", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "ordinal", "_level"))).over(all_rows))
    )
    target = F.least(F.col("_cap"), F.coalesce(F.col("_fits._level") * F.col("weight"), F.col("_cap")))
    return levels.withColumn("target", target).select(*sources.columns, "target")


def shard_quotas(sources: DataFrame, block: int, shards: int) -> DataFrame:
    """One row per source and ``shard``: ``quota``, its blocks in that shard, and ``until``, its blocks up to and with it.

    With v = target / block there are round(sum v) seats, dealt by highest quotients
    v / (2 q + 1), ties to the earlier source.  Shard k gets the seats that come
    next in that order, so that all shards have one seat more or less than each
    other and, because a divisor method never takes a seat back when the house
    grows, every integer quota is at least 0 and every run of shards is itself
    apportioned.  For the house of shards 0 to k, rounding the shrunken v is the
    method at the divisor for that house; what it is over or short of the seats is
    settled on the quotients next to the cut.
    """
    house = Window.partitionBy("shard")
    base = (
        sources.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("_v", F.col("target") / F.lit(float(block)))
        .withColumn("_all", F.floor(F.sum("_v").over(house) + 0.5))
        .withColumn("_seats", F.call_function("div", F.col("_all") * (F.col("shard") + 1), F.lit(shards)))
        .withColumn("_q", F.when(F.col("_all") > 0, F.floor(F.col("_v") * (F.col("_seats") / F.col("_all")) + 0.5)).otherwise(0))
        .withColumn("_short", F.col("_seats") - F.sum("_q").over(house))
    )
    # candidates: the next |short| quotients of each source on the side that has to move
    steps = F.when(F.col("_short") > 0, F.sequence(F.lit(1).cast("long"), F.col("_short"))).when(
        F.col("_short") < 0, F.sequence(F.lit(1).cast("long"), F.least(-F.col("_short"), F.col("_q")))
    )
    step = base.filter("_short <> 0 AND (_short > 0 OR _q > 0)").select("shard", "ordinal", "_v", "_q", "_short", F.explode(steps).alias("_j"))
    up, seat = F.col("_short") > 0, F.col("_q") + F.col("_j")
    quotient = F.when(up, F.col("_v") / (2 * seat - 1)).otherwise(F.col("_v") / (2 * (F.col("_q") - F.col("_j")) + 1))
    order = F.when(up, -quotient).otherwise(quotient)
    side = F.when(up, F.col("ordinal")).otherwise(-F.col("ordinal"))
    ranked = step.withColumn("_rank", F.row_number().over(house.orderBy(order, side))).filter(F.col("_rank") <= F.abs("_short"))
    moved = ranked.groupBy("shard", "ordinal").agg(F.sum(F.signum("_short")).cast("long").alias("_moved"))
    before = F.lag("until", 1, 0).over(Window.partitionBy("ordinal").orderBy("shard"))
    return (
        base.join(moved, ["shard", "ordinal"], "left")
        .withColumn("until", (F.col("_q") + F.coalesce("_moved", F.lit(0))).cast("long"))
        .withColumn("quota", F.col("until") - before)
        .select(*sources.columns, "shard", "quota", "until")
    )


def sainte_lague(sources: DataFrame, block: int) -> DataFrame:
    """Add ``quota``: how many of all blocks each source gets by highest quotients."""
    return shard_quotas(sources, block, 1).select(*sources.columns, "quota")


def _plan(
    df: DataFrame, source: str, size: Column, key: list[Column], block: int = 16, cap: int = 3, seed: int = 5,
    weights: tuple[int, ...] = (1, 2, 3), shards: int = 1, rows_per_bucket: int = 20_000,
) -> DataFrame:
    """Rows of ``row`` (the input's columns) and the words taken; see ``mix_plan``."""
    spark = df.sparkSession
    h = F.xxhash64(F.lit(seed), *key)
    # read twice, for the totals and for the rows, and written nowhere: rows may carry whole texts
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(source).alias("source"), size.cast("long").alias("size"), h.alias("h"))
    n = df.count()
    buckets = max(-(-n // rows_per_bucket), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = rows.withColumn("bucket", F.call_function("div", F.shiftrightunsigned("h", 16), F.lit(max((1 << 48) // buckets, 1))))

    parts = materialized(spread.groupBy("source", "bucket").agg(F.sum("size").alias("part")), "parts")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("offset", F.coalesce(F.sum("part").over(before), F.lit(0)))

    totals = parts.groupBy("source").agg(F.sum("part").alias("size"))
    listed = totals.withColumn("ordinal", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.array(*[F.lit(w) for w in weights])
    listed = listed.withColumn("weight", F.element_at(turn, (F.pmod(F.col("ordinal") - 1, F.lit(len(weights))) + 1).cast("int")))
    dealt = materialized(shard_quotas(capped_targets(listed, float(cap)), block, shards), "quotas")
    # at most ``shards`` entries a source; ``until`` never falls, so its order is the shards'
    quotas = dealt.groupBy("source", "size", "target").agg(F.sum("quota").alias("quota"), F.sort_array(F.collect_list("until")).alias("until"))
    words = F.least(F.col("quota") * F.lit(block), F.col("size") * F.lit(cap))
    whole = F.when(F.col("size") > 0, F.call_function("div", F.col("words"), F.col("size"))).otherwise(0).cast("long")
    start = F.when(F.col("size") > 0, F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), "source"), F.col("size"))).otherwise(0)
    plan = (
        quotas.withColumn("words", words).withColumn("passes", whole)
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("size"))
        .withColumn("start", start - F.pmod(start, F.lit(block)))
        .withColumn("ends", F.transform("until", lambda u: F.least(u * F.lit(block), F.col("words"))))
        .select(F.col("source").alias("s"), F.col("size").alias("source_size"), "target", "passes", "rest", "start", "ends")
    )

    inside = Window.partitionBy("source", "bucket").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn("a", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    o = offsets.select(F.col("source").alias("os"), F.col("bucket").alias("ob"), "offset")
    placed = local.join(o, F.col("source").eqNullSafe(F.col("os")) & (F.col("bucket") == F.col("ob"))).withColumn("a", F.col("a") + F.col("offset"))
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("s")))

    def within(lo: Column, hi: Column) -> tuple[Column, Column]:
        low = F.greatest(lo - F.col("a"), F.lit(0))
        return low, F.greatest(F.least(hi - F.col("a"), F.col("size")), low)

    end = F.col("start") + F.col("rest")
    cut, wrap = within(F.col("start"), F.least(end, F.col("source_size"))), within(F.lit(0), end - F.col("source_size"))
    cuts = placed.select(
        "row", "h", "size", "source_size", "target", "passes", "a", "start", "ends",
        cut[0].alias("cut_from"), cut[1].alias("cut_to"), wrap[0].alias("wrap_from"), wrap[1].alias("wrap_to"),
    )

    # where a source's mix is laid end to end, its whole passes first: a span starts at ``t`` with word ``lo``
    def span(t: Column, lo: Column, hi: Column) -> Column:
        return F.struct(t.alias("t"), lo.alias("lo"), hi.alias("hi"))

    turn, zero = F.col("passes") * F.col("source_size"), F.lit(0).cast("long")
    whole = F.transform(F.array_repeat(zero, F.col("passes").cast("int")), lambda _, i: span(i * F.col("source_size") + F.col("a"), zero, F.col("size")))
    last = F.array(
        span(turn + F.col("a") + F.col("cut_from") - F.col("start"), F.col("cut_from"), F.col("cut_to")),
        span(turn + F.col("source_size") - F.col("start") + F.col("a") + F.col("wrap_from"), F.col("wrap_from"), F.col("wrap_to")),
    )
    return cuts.withColumn("spans", F.filter(F.concat(whole, last), lambda x: x["hi"] > x["lo"]))


def _in_shard(span: Column, end: Column, k: Column) -> tuple[Column, Column]:
    """The words [lo, hi) of a span that shard ``k``, which stops at ``end``, takes; empty if hi <= lo."""
    begin = F.coalesce(F.get("ends", k - 1), F.lit(0))
    return span["lo"] + F.greatest(begin - span["t"], F.lit(0)), F.least(span["lo"] + end - span["t"], span["hi"])


_ADDED = ("size", "source_size", "target", "passes", "cut_from", "cut_to", "wrap_from", "wrap_to", "shard_words", "taken")


def mix_plan(df: DataFrame, source: str, size: Column, key: list[Column], **options) -> DataFrame:
    """Which words of which row the mix takes.

    Sources in code point order (null last) weigh ``weights`` in turn and share all
    words; a target stops at ``cap`` times its source's size and the excess goes to
    the others by weight.  Each of ``shards`` shards has its integer quota of blocks
    of ``block`` words from every source, see ``shard_quotas``.

    The rows of a source stand in the order of a seeded hash of ``key``; its blocks
    are whole passes over that order and, for the rest, a run round it from a seeded
    start.  So every row is taken ``passes`` times in whole, and the words
    [``cut_from``, ``cut_to``) and [``wrap_from``, ``wrap_to``) of it once more; no
    row exceeds ``cap`` times its size.  The shards take their quotas from these
    blocks one after the other: ``shard_words`` holds the words of the row that
    each shard takes and ``taken`` is their sum.

    The order is cut into hash ranges: each range is sorted by itself and prefix
    sums over the ranges give its place, so a source that holds most rows is many
    tasks.  Input columns are kept, but for those that carry
    a result name.  Rows of size 0 take nothing; rows that agree in
    ``key`` are interchangeable; an empty table gives an empty result.
    """
    kept = [c for c in df.columns if c not in _ADDED]

    def words(end: Column, k: Column) -> Column:
        def add(n: Column, x: Column) -> Column:
            lo, hi = _in_shard(x, end, k)
            return n + F.greatest(hi - lo, F.lit(0))

        return F.aggregate("spans", F.lit(0).cast("long"), add)

    plan = _plan(df, source, size, key, **options).withColumn("shard_words", F.transform("ends", words))
    plan = plan.withColumn("taken", F.aggregate("shard_words", F.lit(0).cast("long"), lambda n, w: n + w))
    return plan.select(*[F.col("row")[c].alias(c) for c in kept], *_ADDED)


def word_slice(text: Column, first: Column, last: Column) -> Column:
    """Words [first, last) of a text with the white space between them as it stands."""
    pieces = F.split(F.regexp_replace(text, f"^[{SPACE}]+", ""), PIECE)
    return F.regexp_replace(F.array_join(F.slice(pieces, (first + 1).cast("int"), (last - first).cast("int")), ""), f"[{SPACE}]+$", "")


def mixed_documents(df: DataFrame, plan_key: list[str], shard_column: str | None = None, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, in part where a shard's blocks or the last ones end inside it.

    Returns the columns of ``df`` (``source``, ``text`` and ``n_chars`` among them)
    with ``text`` and ``n_chars`` of the part; ``shard_column`` names a further one
    for the shard (it replaces one of that name).  Per source at most three rows are
    cut, and one more per further shard.  Rows without words (null and empty texts
    too) are kept once, in a shard by hash: they have no tokens to weigh.  A null
    source is a source of its own; ties and repeated rows are rows like others; an
    empty table gives an empty result; names the plan uses clash with nothing.
    """
    plan = _plan(df, "source", word_count(F.col("text")), [F.col(c) for c in plan_key], **options)
    size = F.col("size")

    def part(shard: Column, lo: Column, hi: Column) -> Column:
        return F.struct(shard.cast("int").alias("shard"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))

    def cut(x: Column) -> Column:
        return F.filter(F.transform("ends", lambda end, k: part(k, *_in_shard(x, end, k))), lambda y: y["hi"] > y["lo"])

    nothing = part(F.pmod(F.col("h"), F.size("ends")), F.lit(0), F.lit(0))
    takes = F.when(size == 0, F.array(nothing)).otherwise(F.flatten(F.transform("spans", cut)))
    rows = plan.select("row", size, F.explode(takes).alias("take"))
    text = F.when((F.col("take.lo") == 0) & (F.col("take.hi") == size), F.col("row.text")).otherwise(
        word_slice(F.col("row.text"), F.col("take.lo"), F.col("take.hi"))
    )
    new = {"text": text} | ({"n_chars": F.length(text).cast(df.schema["n_chars"].dataType)} if "n_chars" in df.columns else {})
    kept = [new.get(c, F.col("row")[c]).alias(c) for c in df.columns if c != shard_column]
    return rows.select(*kept, *([F.col("take.shard").alias(shard_column)] if shard_column else []))
