"""Near-duplicate vectors by counting collisions in sorted one-dimensional projections."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.similarity import connected_components
from corpusloom.sources.storage import materialized


def calibrate(threshold: float, projections: int, reach: float, miss: float) -> tuple[float, int]:
    """(half window, required count) for directions of unit length per root of dimension.

    Two unit vectors of cosine >= t lie at most r = sqrt(2 - 2t) apart, so along a
    Gaussian direction their difference is at most normal with deviation r.  A
    window of ``reach`` deviations catches it with p = erf(reach / sqrt 2); of
    ``projections`` independent directions the count is binomial, and the required
    count is the largest that such a pair misses with probability ``miss`` at most.
    """
    p = math.erf(reach / math.sqrt(2))
    tail, need = 0.0, 0
    for k in range(projections + 1):
        tail += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail > miss:
            break
        need = k + 1
    return reach * math.sqrt(max(2 - 2 * threshold, 0.0)) + 1e-6, need


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _directions(dim: int, projections: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((projections, dim))


def collision_counts(a: np.ndarray, b: np.ndarray, window: float) -> np.ndarray:
    """How often b's row falls into the window centred on a's row, over all projections.

    Rows are vectors, columns projections.  Every projection of b is sorted; the
    window of a query is a range of that order, found by bisection, and counted.
    """
    counts = np.zeros((len(a), len(b)), np.uint8)
    kind = np.uint16 if len(b) < 1 << 16 else np.uint64
    place = np.arange(len(b), dtype=kind)
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        line = b[order, j]
        lo, hi = np.searchsorted(line, a[:, j] - window, "left"), np.searchsorted(line, a[:, j] + window, "right")
        rank = np.empty(len(b), kind)
        rank[order] = place
        # unsigned: below lo wraps round to a large number
        counts += rank[None, :] - lo.astype(kind)[:, None] < (hi - lo).astype(kind)[:, None]
    return counts


def block_links(
    left: np.ndarray, right: np.ndarray | None, threshold: float, window: float, need: int, seed: int, projections: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of pairs whose count passes and whose cosine reaches the threshold.

    ``right`` None: pairs within ``left``, i < j.
    """
    directions = _directions(left.shape[1], projections, seed)
    a = _unit(left)
    b = a if right is None else _unit(right)
    counts = collision_counts(a @ directions.T, b @ directions.T, window)
    i, j = np.nonzero(np.triu(counts >= need, 1) if right is None else counts >= need)
    near = np.zeros(len(i), bool)
    for s in range(0, len(i), 1 << 15):
        e = s + (1 << 15)
        near[s:e] = np.einsum("nd,nd->n", a[i[s:e]], b[j[s:e]]) >= threshold
    return i[near], j[near]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (row, root) of the links among n rows: the root is the smallest row."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while not np.array_equal(jump := root[root], root):
            root = jump
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    rows = np.flatnonzero(root != np.arange(n))
    return rows, root[rows]


def near_vectors(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", group: str = "label", threshold: float = 0.98,
    projections: int = 24, reach: float = 1.6, miss: float = 1e-6, block_rows: int = 2048, seed: int = 3,
) -> DataFrame:
    """Add ``n_links``, ``component_id`` and ``kept`` to every row.

    Two rows are linked if their groups are equal and not null and the cosine, in
    double precision, is at least ``threshold``.  Equal vectors of a group are one
    class and compared once.  A group's classes are dealt into blocks by a hash;
    each pair of blocks is one unit of work, so a group that
    holds most rows is many tasks.  In a unit the projections are sorted, a query's
    windows are counted per partner, and partners that pass the calibrated count
    are verified.  A unit returns links per row and a spanning forest, never its
    pairs.  A pair at the threshold is missed with probability ``miss`` at most,
    a closer one more rarely; no pair below the threshold is linked.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without a group, have no links and are their own component; vectors of
    different lengths never link.  Repeated rows link with each other like other
    equal vectors.  A row without an id has no place in the order of ids: it takes
    its component's smallest id, null if it links with nothing.  An empty table
    gives an empty result; columns that carry a result name are replaced.
    """
    out = ("n_links", "component_id", "kept")
    kept = [c for c in df.columns if c not in out]
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = F.coalesce(
        (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    usable = sound & F.col(group).isNotNull()
    named = df.select(F.struct(*kept).alias("row"), F.col(vec_id).alias("id"), F.when(usable, F.col(group)).alias("g"), F.when(usable, v).alias("v"))
    keyed = named.withColumn("cls", F.when(F.col("v").isNotNull(), F.struct(F.xxhash64("g", "v").alias("h"), F.xxhash64(F.lit(seed), "v", "g").alias("k"))))
    rows = materialized(keyed, "vectors")
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.first("g").alias("g"), F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("id")
    )
    # written with its number, so the number is fixed from here on
    classes = materialized(classes.withColumn("key", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vector-classes")

    sizes = classes.groupBy("g", "dim").agg(F.count("*").alias("m"))
    blocks = F.ceil(F.col("m") / F.lit(block_rows)).cast("int")
    homes = classes.join(sizes.select("g", "dim", blocks.alias("blocks")), ["g", "dim"])
    homes = homes.withColumn("home", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    partners = F.expr("transform(sequence(0, blocks - 1), o -> struct(least(o, home) as lo, greatest(o, home) as hi))")
    units = homes.select("g", "dim", "key", "n", "v", "home", F.explode(partners).alias("u")).select(
        "g", "dim", "u.lo", "u.hi", "key", "n", "v", "home"
    )
    window, need = calibrate(threshold, projections, reach, miss)

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["home", "key"], kind="stable")
        low, high = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        vectors, weight, keys = np.stack(pdf["v"].to_numpy()).astype(np.float64), pdf["n"].to_numpy(np.int64), pdf["key"].to_numpy(np.int64)
        if low == high:
            i, j = block_links(vectors, None, threshold, window, need, seed, projections)
        else:
            cut = int((pdf["home"].to_numpy() == low).sum())
            if cut in (0, len(pdf)):
                return pd.DataFrame({"key": [], "links": [], "root": []})
            i, j = block_links(vectors[:cut], vectors[cut:], threshold, window, need, seed, projections)
            j = j + cut
        count = np.bincount(i, weight[j], len(pdf)) + np.bincount(j, weight[i], len(pdf))
        row, top = _forest(len(pdf), i, j)
        root = np.arange(len(pdf))
        root[row] = top
        some = np.flatnonzero(count)
        return pd.DataFrame({"key": keys[some], "links": count[some].astype(np.int64), "root": keys[root[some]]})

    found = units.groupBy("g", "dim", "lo", "hi").applyInPandas(links, "key long, links long, root long")
    found = materialized(found, "vector-links")
    comps = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    joined = (
        classes.select("cls", "key", "n", "id").join(counts, "key", "left")
        .join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    )
    lowest = joined.groupBy("comp").agg(F.min("id").alias("component_id"))
    per_class = joined.join(lowest, "comp").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    done = rows.join(per_class, "cls", "left")
    component = F.coalesce(F.col("component_id"), F.col("id"))
    return done.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
