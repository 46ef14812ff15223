"""Hard negatives by a vertical scan: one dimension after the other, candidates leaving as bounds close."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.integers import LONG, as_long, floored, usable
from corpusloom.operators.ranking import top_k
from corpusloom.sources.storage import materialized

Window = tuple[int, int, float]


class Columns:
    """A block of whole-number vectors, one array per dimension, with each dimension's smallest and largest entry."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.rows, self.labels = ids, rows, labels
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)


def _floor_of_best(values: np.ndarray, k: int):
    """The k-th largest value, or None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def scan(block: Columns, anchor: np.ndarray, alive: np.ndarray, windows: list[Window], k: int, step: int = 4) -> Iterator[tuple[Window, np.ndarray, np.ndarray]]:
    """For each window (low, high, least): (window, places, scores) of its k best scores, ties at the end included.

    ``alive`` is the bitmap of candidates.  Dimensions are read in the order of the
    anchor's falling magnitude, ``step`` at a time.  What those not read yet can add
    lies between two sums over the columns' smallest and largest entries, the same for all rows.
    A row leaves the bitmap as soon as, in every window, it is sure to score outside
    or k rows are sure to be inside with more than it can reach.  ``least`` is a
    score that k rows of the window reach elsewhere (or minus infinity).
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * block.low, anchor * block.high])[:, order]
    least_gain, most_gain = np.minimum(*ends), np.maximum(*ends)
    after_low = np.append(np.cumsum(least_gain[::-1])[::-1], 0)
    after_high = np.append(np.cumsum(most_gain[::-1])[::-1], 0)
    at = np.flatnonzero(alive)
    partial = np.zeros(len(at), block.columns.dtype)
    for first in range(0, len(order), step):
        if not len(at):
            break
        for d in order[first : first + step]:
            if anchor[d] != 0:
                partial = partial + anchor[d] * block.columns[d][at]
        done = min(first + step, len(order))
        low, high = partial + after_low[done], partial + after_high[done]
        open_ = np.zeros(len(at), bool)
        for start, end, least in windows:
            bar = max(start, least)
            sure = low[(low >= start) & (high <= end)]
            kth = _floor_of_best(sure, k)
            if kth is not None and kth > bar:
                bar = -np.inf if kth <= LONG[0] else min(kth, LONG[1])  # beyond a long, scores tie
            open_ |= (high >= bar) & (low <= end)
        if not open_.all():
            at, partial = at[open_], partial[open_]
    if partial.dtype == object:
        partial = np.minimum(np.maximum(partial, LONG[0]), LONG[1])
    for window in windows:
        start, end, least = window
        inside = np.flatnonzero((partial >= max(start, least)) & (partial <= end))
        kth = _floor_of_best(partial[inside], k)
        if kth is not None:
            inside = inside[partial[inside] >= kth]
        yield window, at[inside], partial[inside]


def _best(block: Columns, places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The first k of a scan's places: higher scores, then smaller ids, then earlier rows."""
    return np.lexsort((block.rows[places], block.ids[places], -scores))[:k]


def _dealt(rows: DataFrame, block_rows: int) -> DataFrame:
    """Add ``team`` and ``blk``: blocks of about ``block_rows`` rows with few labels in each.

    A label of that many rows is a team of its own, smaller ones share teams by a
    hash.  A team is cut into blocks by a hash of the row number, so no label, copy
    or id fills a block.
    """
    sizes = rows.groupBy("dim", "lab").agg(F.count("*").alias("m"))
    teams = F.greatest(F.ceil(F.sum("m") / block_rows), F.lit(1)).cast("long").alias("teams")
    shared = sizes.filter(F.col("m") < block_rows).groupBy("dim").agg(teams)
    team = F.when(F.col("m") >= block_rows, F.struct(F.lit(True).alias("own"), F.col("lab").alias("t")))
    common = F.struct(F.lit(False).alias("own"), F.pmod(F.xxhash64("lab"), "teams").alias("t"))
    named = sizes.join(shared, "dim", "left").withColumn("team", F.coalesce(team, common))
    blocks = named.groupBy("dim", "team").agg(F.ceil(F.sum("m") / block_rows).cast("long").alias("blocks"))
    return (
        rows.join(named.select("dim", "lab", "team"), ["dim", "lab"]).join(blocks, ["dim", "team"])
        .withColumn("blk", F.pmod(F.xxhash64("no"), "blocks")).drop("blocks")
    )


_SIDE = ["no", "id", "lab", "v"]


def _meetings(placed: DataFrame, asked: DataFrame, meets: DataFrame, one: Callable, names: list[str], scale: int) -> DataFrame:
    """Rows ``names`` that ``one(block, query, entries)`` yields for every anchor of every meeting (unit, dim, team, blk, group)."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        queries.columns = [c.removeprefix("q_") for c in queries.columns]
        if len(rows) and len(queries):
            x, q = floored(rows["v"], queries["v"], scale)
            block = Columns(*(rows[c].to_numpy(np.int64) for c in ("id", "no", "lab")), x)
            for query, entries in zip(queries.itertuples(), q, strict=True):
                out += one(block, query, entries)
        return pd.DataFrame(out or None, columns=names)

    left = placed.join(meets, ["dim", "team", "blk"]).select("unit", *_SIDE)
    sent = ["unit", *[c for c in asked.columns if c not in ("dim", "team", "group")]]
    right = asked.drop("team").join(meets, ["dim", "group"]).select(*[F.col(c).alias(f"q_{c}") for c in sent])
    return left.groupBy("unit").cogroup(right.groupBy("q_unit")).applyInPandas(run, ", ".join(f"{c} long" for c in names))


def hard_negatives(
    df: DataFrame, every: int = 100, positives: int = 5, k: int = 5, low: int = 80, high: int = 100, vec_id: str = "vec_id",
    vector: str = "embedding", label: str | Column = "label", scale: int = 256, block_rows: int = 16_384, anchor_rows: int = 2_048,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): up to ``k`` negatives of each anchor and positive.

    Labels are whole numbers.  Entries become floor(``scale`` * x); a score is the whole inner product.  Anchors
    are the rows whose id is divisible by ``every``; an anchor's positives are its
    first other rows of the same label, higher scores first, then smaller ids.  Negatives of
    a positive are the first rows of other labels whose score lies within ``low`` and
    ``high`` hundredths of the positive's, so a positive below zero has none.

    Rows lie in blocks of columns of about ``block_rows``, few labels to a block,
    anchors in groups of about ``anchor_rows``.  A group first meets the blocks of its
    own labels; the positives fix the windows of the negatives.  Then it meets one block
    of all, which gives each window a score that k negatives reach at least, and
    takes that to the others.  In a meeting every anchor scans the columns
    (``scan``).  A meeting is of bounded size and returns k rows a window; a label or a
    group of copies that holds most rows is many meetings.

    Rows whose label, vector or id is null, or whose vector is empty or holds null
    or non-finite entries, take no part.  Rows are told apart by their place, not by
    their ids: another row with the anchor's id is another row, and a repeated
    anchor or positive appears as often.  Vectors only meet those of their own
    length.  Fewer positives or negatives than asked for are all returned; scores
    beyond a long are held at its ends; an empty table gives an empty result; other
    columns are not looked at, whatever their names.
    """
    lab = F.col(label) if isinstance(label, str) else label
    entries = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = df.filter(F.col(vec_id).isNotNull() & lab.isNotNull() & usable(F.col(vector)))
    rows = sound.select(
        F.monotonically_increasing_id().alias("no"), F.col(vec_id).cast("long").alias("id"), lab.cast("long").alias("lab"),
        entries.alias("v"), F.size(vector).alias("dim"),
    )
    # written with its number, so the number is fixed from here on
    placed = materialized(_dealt(materialized(rows, "negatives"), block_rows), "negatives-blocks")
    anchors = placed.filter(F.col("id") % every == 0)
    groups = anchors.groupBy("dim", "team").agg(F.ceil(F.count("*") / anchor_rows).cast("long").alias("groups"))
    number = F.pmod(F.xxhash64(F.lit(1), "no"), "groups").alias("g")
    asked = anchors.join(groups, ["dim", "team"]).withColumn("group", F.struct("team", number))
    asked = materialized(asked.select("dim", "team", "group", *_SIDE), "negatives-anchors")
    blocks = placed.select("dim", "team", "blk").distinct()
    teams = asked.select("dim", "team", "group").distinct()

    def nearest(block: Columns, query, entries: np.ndarray) -> Iterator[tuple]:
        others = (block.labels == query.lab) & (block.rows != query.no)
        for _, at, scores in scan(block, entries, others, [(-np.inf, np.inf, -np.inf)], positives):
            for j in _best(block, at, scores, positives):
                yield query.no, query.id, block.ids[at[j]], block.rows[at[j]], as_long(scores[j])

    own = materialized(teams.join(blocks, ["dim", "team"]).withColumn("unit", F.monotonically_increasing_id()), "negatives-meetings")
    same = _meetings(placed, asked, own, nearest, ["no", "anchor_id", "positive_id", "positive_no", "positive_score"], scale)
    by_score = [F.desc("positive_score"), F.asc("positive_id"), F.asc("positive_no")]
    found = materialized(top_k(same, ["no"], by_score, positives), "negatives-positives")

    def between(block: Columns, query, entries: np.ndarray) -> Iterator[tuple]:
        windows = {}
        for w in query.windows:
            p = int(w["top"])
            start, end = -((-low * p) // 100), np.inf if p == LONG[1] else high * p // 100
            if start <= end:
                windows[p] = (start, end, -np.inf if w["least"] is None else int(w["least"]))
        for p, at, scores in zip(windows, *_split(scan(block, entries, block.labels != query.lab, list(windows.values()), k)), strict=True):
            for j in _best(block, at, scores, k):
                yield query.no, p, block.ids[at[j]], block.rows[at[j]], as_long(scores[j])

    # positives of one score share a window
    tops = found.select("no", F.col("positive_score").alias("top")).distinct()
    meets = materialized(teams.select("dim", "group").join(blocks, "dim").withColumn("unit", F.monotonically_increasing_id()), "negatives-meetings")
    start = meets.groupBy("dim", "group").agg(F.min_by("unit", F.xxhash64("unit")).alias("unit")).select("unit")
    names = ["no", "top", "negative_id", "negative_no", "negative_score"]

    def searched(least: DataFrame, of: DataFrame) -> DataFrame:
        """``least``: no, top, least."""
        windows = least.groupBy("no").agg(F.collect_list(F.struct("top", "least")).alias("windows"))  # at most ``positives`` of them
        return _meetings(placed, asked.join(windows, "no"), of, between, names, scale)

    none = F.lit(None).cast("long")
    home = materialized(searched(tops.withColumn("least", none), meets.join(start, "unit", "left_semi")), "negatives-home")
    reached = home.groupBy("no", "top").agg(F.min("negative_score").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k)
    rest = searched(tops.join(reached.drop("n"), ["no", "top"], "left"), meets.join(start, "unit", "left_anti"))
    best = top_k(home.unionByName(rest), ["no", "top"], [F.desc("negative_score"), F.asc("negative_id"), F.asc("negative_no")], k)
    return found.drop("rank").join(best, (found["no"] == best["no"]) & (F.col("positive_score") == F.col("top"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def _split(found: Iterator[tuple]) -> tuple[list, list]:
    each = list(found)
    return [x[1] for x in each], [x[2] for x in each]
