"""Exact top-k inner products with KD-trees per shard."""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ranking import top_k as first_k
from corpusloom.sources.storage import materialized

_EXACT = 2.0**53
LONG = (-(2**63), 2**63 - 1)


class Tree:
    """A KD-tree over integer vectors; rows are stored leaf by leaf.

    A node is cut at the median of its widest side.  ``lo`` and ``hi`` are tight
    boxes.  Node 0 is the root; ``left`` is -1 for a leaf.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int, rows: np.ndarray | None = None):
        self.lo, self.hi, self.left, self.right, self.first, self.last = [], [], [], [], [], []
        order = np.arange(len(ids))
        stack = [(0, len(ids), None, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            node = len(self.lo)
            if parent is not None:
                (self.left if side == 0 else self.right)[parent] = node
            part = vectors[order[a:b]]
            lo, hi = part.min(axis=0), part.max(axis=0)
            for box, x in ((self.lo, lo), (self.hi, hi), (self.left, -1), (self.right, -1), (self.first, a), (self.last, b)):
                box.append(x)
            widest = int(np.argmax(hi - lo))
            if b - a > leaf and hi[widest] > lo[widest]:
                m = (b - a) // 2
                order[a:b] = order[a:b][np.argsort(part[:, widest], kind="stable")]
                stack += [(a, a + m, node, 0), (a + m, b, node, 1)]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.ids, self.vectors = ids[order], vectors[order]
        self.rows = self.ids if rows is None else rows[order]


def _search(tree: Tree, q: np.ndarray, own: int, k: int, bound: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """The k best (score, -id, row) of one tree, best-first, without row ``own``; ``least``: a score that k rows reach elsewhere.

    A box is opened while its bound is at least the k-th score so far: an equal
    score may still win by a smaller id.
    """
    best: list[tuple[int, int, int]] = []
    heap = [(-bound[0], 0)]
    while heap:
        top, node = heapq.heappop(heap)
        if -top < least or (len(best) == k and -top < best[0][0]):
            break
        if tree.left[node] < 0:
            a, b = tree.first[node], tree.last[node]
            scores, ids, rows = tree.vectors[a:b] @ q, tree.ids[a:b], tree.rows[a:b]
            floor = max(least, best[0][0]) if len(best) == k else least
            near = np.flatnonzero((scores >= floor) & (rows != own))
            if len(near) > k:
                near = near[np.lexsort((ids[near], -scores[near]))[:k]]
            for n in near:
                item = (scores[n], -int(ids[n]), int(rows[n]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        else:
            for child in (tree.left[node], tree.right[node]):
                heapq.heappush(heap, (-bound[child], child))
    return best


def search_block(tree: Tree, qrows: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> pd.DataFrame:
    """Top-k rows (query, vec_id, score) of a block of queries, named by their rows, in one tree.

    Inner products over a box are at most q+ . hi + q- . lo.
    """
    bounds = np.maximum(queries, 0) @ tree.hi.T + np.minimum(queries, 0) @ tree.lo.T
    out: list[tuple[int, int, int]] = []
    for i in range(len(qrows)):
        found = _search(tree, queries[i], int(qrows[i]), k, bounds[i], least[i])
        out += [(int(qrows[i]), -n, min(max(int(s), LONG[0]), LONG[1])) for s, n, _ in found]
    return pd.DataFrame(out or None, columns=["query", "vec_id", "score"])


def _exact(left: pd.Series, right: pd.Series, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of both sides: doubles if they hold every sum exactly, else Python integers."""
    a, b = (np.stack(x.to_numpy()).astype(np.float64) for x in (left, right))
    if float(np.abs(a).max()) * float(np.abs(b).max()) < _EXACT / (a.shape[1] * (scale + 1) ** 2) and max(np.abs(a).max(), np.abs(b).max()) < _EXACT:
        return np.floor(scale * a), np.floor(scale * b)
    whole = np.frompyfunc(lambda x: math.floor(scale * Fraction(x)), 1, 1)
    return whole(a), whole(b)


def exact_top_k(
    df: DataFrame, every: int = 50, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256,
    shard_rows: int = 2048, block_rows: int = 2048, leaf: int = 64, seed: int = 1,
) -> DataFrame:
    """The k largest inner products of each query: query_id, rank (from 1), vec_id, score.

    Components become floor(``scale`` * x).  Queries are the rows whose id is
    divisible by ``every``; candidates are all other rows; equal scores go to the
    smaller id.

    Rows are dealt by a hash of their number into shards of about ``shard_rows``; a
    KD-tree is built in each.  First every block of queries searches one shard,
    which gives each query a k-th score; it goes with the query to all other
    shards, whose trees open only boxes that can still reach it.  A unit of work is
    one shard and one block, both of bounded size, and returns k rows per query.

    Vectors that are null, empty or hold null or non-finite components take no
    part, nor do rows without an id.  Rows are told apart by their place, not by
    their ids: a row with the query's id is a candidate like others, and each of
    several queries with one id has its own k rows.  Queries only meet vectors of their own
    length; a query with fewer than k candidates gets all of them; an empty table
    gives an empty result; other columns are not looked at, whatever their names.
    Scores beyond a long are held at its ends, where they tie.
    """
    spark = df.sparkSession
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = df.filter(F.col(vec_id).isNotNull() & (F.size(vector) > 0)).select(F.col(vec_id).cast("long").alias("id"), v.alias("v"), bad.alias("bad"))
    usable = sound.filter(~F.col("bad")).select("id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("no"))
    rows = materialized(usable, "topk")  # written with its number, so the number is fixed from here on
    candidates = rows.select("no", "id", "v", "dim")
    shards = max(-(-rows.count() // shard_rows), 1)
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "no"), F.lit(shards)).cast("int"))
    asked = rows.filter(F.col("id") % every == 0)
    blocks = max(-(-asked.count() // block_rows), 1)
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "no"), F.lit(blocks)).cast("int"))
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")

    def searched(queries: DataFrame) -> DataFrame:
        """``queries``: no, v, dim, block, shard, least."""

        def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query": [], "vec_id": [], "score": []})
            a, q = _exact(left["v"], right["q_v"], scale)
            tree = Tree(left["id"].to_numpy(np.int64), a, leaf, left["no"].to_numpy(np.int64))
            return search_block(tree, right["q_no"].to_numpy(np.int64), q, right["q_least"].to_numpy(float), k)

        unit = ["shard", "block", "dim"]
        right = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("no", "v", "least", *unit)])
        asked_of = right.select("q_shard", "q_block", "q_dim").distinct()
        met = dealt.join(asked_of, (F.col("shard") == F.col("q_shard")) & (F.col("dim") == F.col("q_dim")))
        left = met.select("no", "id", "v", "shard", F.col("q_block").alias("block"), "dim")
        return left.groupBy(*unit).cogroup(right.groupBy(*[f"q_{c}" for c in unit])).applyInPandas(run, "query long, vec_id long, score long")

    none = F.lit(float("-inf"))
    start = materialized(searched(asked.withColumn("shard", home).withColumn("least", none)), "topk-home")
    kth = start.groupBy("query").agg(F.min("score").cast("double").alias("worst"), F.count("*").alias("n")).filter(F.col("n") >= k)
    bound = asked.join(kth, F.col("no") == F.col("query"), "left").withColumn("least", F.coalesce("worst", none))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
    rest = searched(bound.select("no", "v", "dim", "block", "least", F.explode(others).alias("shard")))
    best = first_k(start.unionByName(rest), ["query"], [F.desc("score"), F.asc("vec_id")], k)
    named = best.join(rows.select(F.col("no").alias("query"), F.col("id").alias("query_id")), "query")
    return named.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
