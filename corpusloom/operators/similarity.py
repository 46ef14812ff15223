"""Exact set similarity inside groups, and near-duplicate groups.

Nothing here emits the pairs of a group.  Two building blocks:

* an inverted index over *rare* shingles (document frequency up to a bound), so
  the pairs it makes are bounded by the number of shingle occurrences;
* blocks: a group is hashed into blocks of bounded size and each pair of blocks
  is one small task that returns one partial result per row.

Rows with the same shingle set are folded into one class first, so a group of
copies of any size is one row in all the work that follows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T
from corpusloom.sources.storage import drop_scratch, materialized

_MATCH_CHUNK = 4_000_000
_DENSE_FROM = 500_000
_DENSE_COLUMNS = 4096


# --- shingle sets ----------------------------------------------------------------


def word_shingles(df: DataFrame, id_col: str, group: str, text: str, tokens: str = "space", n: int = 3) -> DataFrame:
    """(id, grp, sh, n): sorted distinct n-gram hashes of each row."""
    toks = T.space_tokens(T.normalize_key(F.col(text))) if tokens == "space" else T.alnum_tokens(F.col(text))
    rows = df.select(F.col(id_col).alias("id"), F.col(group).alias("grp"), T.item_hashes(toks).alias("h"))
    rows = rows.select("id", "grp", F.sort_array(F.array_distinct(T.hash_windows(F.col("h"), n))).alias("sh"))
    return rows.select("id", "grp", "sh", F.size("sh").alias("n"))


def char_shingles(df: DataFrame, id_col: str, text: str, n: int = 3) -> DataFrame:
    """(id, grp, sh, n): the distinct n-grams (up to three characters) of each row as sorted numbers, packed (``pack_set``).

    An n-gram is the number its code points make, so sets are exact; neighbours differ
    little, so a packed set takes a fifth of its numbers wherever it is carried.
    """
    if not 1 <= n <= 3:
        raise ValueError("code points of up to three characters fit in a number")

    @F.pandas_udf("struct<sh: binary, n: int>")
    def run(texts: pd.Series) -> pd.DataFrame:
        sets = [_char_ngrams(t, n) for t in texts]
        return pd.DataFrame({"sh": [pack_set(s) for s in sets], "n": np.fromiter(map(len, sets), np.int32, len(sets))})

    rows = df.select(F.col(id_col).alias("id"), run(T.normalize_key(F.col(text))).alias("s"))
    return rows.select("id", F.lit(0).alias("grp"), "s.sh", "s.n")


def _char_ngrams(text: str, n: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    m = max(len(points) - n + 1, 0)
    found = np.zeros(m, np.int64)
    for k in range(n):
        found = (found << 21) | points[k : k + m]
    return np.unique(found)


def pack_set(numbers: np.ndarray) -> bytes:
    """Sorted numbers as the bytes of their differences, like bytes together, deflated."""
    steps = np.diff(numbers, prepend=0).astype("<i8")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_set(sh) -> np.ndarray:
    """The numbers of a set, packed or not."""
    if not isinstance(sh, bytes):
        return np.asarray(sh, dtype=np.int64)
    steps = np.frombuffer(zlib.decompress(sh), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<i8").ravel())


def shared_numbers(a: str, b: str) -> Column:
    """How many numbers two columns of packed sets have in common."""

    @F.pandas_udf("long")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        sizes = [len(np.intersect1d(unpack_set(x), unpack_set(y), assume_unique=True)) for x, y in zip(left, right, strict=True)]
        return pd.Series(sizes, dtype="int64")

    return run(F.col(a), F.col(b))


def fold_copies(sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Fold rows with the same set in the same group.

    Returns (members: id, grp, key, n; heads: grp, key, n, copies; classes: key, grp,
    sh, n; and the written table that ``classes`` reads, for ``drop_scratch``).  The sets
    are written once with a number per row, and a class has the number of its first row, so
    later steps on ``key`` cannot take one class for another.  Two hashes and the size
    tell sets apart, on narrow rows.  Only the numbers of rows that are copies go
    back to the sets: where they are few, no set is shuffled.
    """
    two = [F.xxhash64("grp", "sh").alias("h1"), F.xxhash64(F.lit(1), "sh", "grp").alias("h2")]
    keyed = materialized(sets.select("*", *two, F.monotonically_increasing_id().alias("own")), "shingles")
    same = ["grp", "h1", "h2", "n"]
    counted = materialized(keyed.groupBy(*same).agg(F.min("own").alias("key"), F.count("*").alias("copies")), "classes")
    names = counted.select(*[F.col(c).alias(f"c_{c}") for c in same], "key")
    of = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in same]
    members = keyed.select("id", *same, "own").join(names, of[0] & of[1] & of[2] & of[3])
    members = materialized(members.select("id", "grp", "key", "n", "own"), "members")
    copies = materialized(members.filter("own <> key").select("own"), "copies")
    classes = keyed.join(copies, "own", "left_anti").select(F.col("own").alias("key"), "grp", "sh", "n")
    return members.drop("own"), counted.select("grp", "key", "n", "copies"), classes, keyed


# --- block kernel ----------------------------------------------------------------


def map_groups(df: DataFrame, keys: list[str], kernel: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """Run ``kernel`` on each run of equal keys.

    Groups are many and small, so they are streamed in sorted partitions
    instead of being handed to Python one by one.  Held in memory: one Arrow
    batch and the group that is still open.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        held_key = None
        for pdf in batches:
            if not len(pdf):
                continue
            cols = [pdf[k].to_numpy() for k in keys]
            new = np.ones(len(pdf), dtype=bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            starts = np.append(np.flatnonzero(new), len(pdf))
            out = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                key = tuple(c[a] for c in cols)
                if held and key != held_key:
                    out.append(kernel(pd.concat(held) if len(held) > 1 else held[0]))
                    held = []
                held_key = key
                held.append(pdf.iloc[a:b])
            yield from _stacked(out)
        if held:
            yield from _stacked([kernel(pd.concat(held) if len(held) > 1 else held[0])])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _stacked(parts: list[dict]) -> Iterator[pd.DataFrame]:
    full = [p for p in parts if p]
    if full:
        yield pd.DataFrame({k: np.concatenate([p[k] for p in full]) for k in full[0]})


def block_pairs(classes: DataFrame, block_rows: int, deal: bool = False) -> DataFrame:
    """Replicate each class to the block pairs it takes part in.

    A group of m classes has B = ceil(m / block_rows) blocks and B(B+1)/2 block
    pairs; each row is sent to B of them.  ``deal``: narrow rows are dealt out before
    they are replicated, so that a large group is no single task.
    """
    return _in_block_pairs(classes, classes.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks")), deal)


def _in_block_pairs(classes: DataFrame, sizes: DataFrame, deal: bool = False) -> DataFrame:
    """``block_pairs`` for given numbers of blocks (grp, blocks)."""
    placed = classes.join(sizes, "grp").withColumn("blk", F.pmod(F.xxhash64("key"), F.col("blocks")))
    placed = placed.repartition("grp", "key") if deal else placed
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("oth")
    return placed.select("*", other).select(
        *classes.columns, "blk", F.least("blk", "oth").alias("lo"), F.greatest("blk", "oth").alias("hi")
    )


def _flat(sets: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    arrays = [unpack_set(s) for s in sets]
    sizes = np.fromiter((len(a) for a in arrays), dtype=np.int64, count=len(arrays))
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return values, np.repeat(np.arange(len(arrays)), sizes)


def overlap_matrix(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set."""
    lv, li = _flat(left)
    rv, ri = _flat(right)
    order = np.argsort(rv, kind="stable")
    rv, ri = rv[order], ri[order]
    lo, hi = np.searchsorted(rv, lv, "left"), np.searchsorted(rv, lv, "right")
    hit = hi > lo
    li, lo, cnt = li[hit], lo[hit], (hi - lo)[hit]
    width = len(right)
    if cnt.sum() > _DENSE_FROM:
        return _dense_overlap(lv[hit], li, rv, ri, len(left), width)
    out = np.zeros(len(left) * width, dtype=np.int64)
    ends = np.cumsum(cnt)
    start = 0
    while start < len(cnt):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _MATCH_CHUNK, "right")))
        c = cnt[start:stop]
        within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        cols = ri[np.repeat(lo[start:stop], c) + within]
        out += np.bincount(np.repeat(li[start:stop], c) * width + cols, minlength=len(out))
        start = stop
    return out.reshape(len(left), width)


def _dense_overlap(lv: np.ndarray, li: np.ndarray, rv: np.ndarray, ri: np.ndarray, height: int, width: int) -> np.ndarray:
    """Many matches: products of 0/1 matrices over slices of the shared values (counts stay exact in float32)."""
    order = np.argsort(lv, kind="stable")
    lv, li = lv[order], li[order]
    shared = np.unique(lv)
    out = np.zeros((height, width), dtype=np.float64)
    for at in range(0, len(shared), _DENSE_COLUMNS):
        part = shared[at : at + _DENSE_COLUMNS]
        sides = []
        for values, rows, n in ((lv, li, height), (rv, ri, width)):
            a, b = np.searchsorted(values, part[0], "left"), np.searchsorted(values, part[-1], "right")
            col = np.searchsorted(part, values[a:b])
            known = part[col] == values[a:b]
            m = np.zeros((n, len(part)), dtype=np.float32)
            m[rows[a:b][known], col[known]] = 1.0
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def jaccard_matrix(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    inter = overlap_matrix(a["sh"], b["sh"]).astype(np.float64)
    union = a["n"].to_numpy()[:, None] + b["n"].to_numpy()[None, :] - inter
    return inter / np.maximum(union, 1.0)


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    lo, hi = pdf["lo"].iat[0], pdf["hi"].iat[0]
    if lo == hi:
        return pdf, pdf, True
    first = (pdf["blk"] == lo).to_numpy()
    return pdf[first], pdf[~first], False


def _best_of_visit(pdf: pd.DataFrame) -> dict:
    """Per visiting row the largest similarity to the rows at home."""
    visits = pdf["visits"].to_numpy()
    asked, home = pdf[visits], pdf[~visits]
    if not len(asked) or not len(home):
        return {}
    sim = jaccard_matrix(asked, home)
    sim[asked["key"].to_numpy()[:, None] == home["key"].to_numpy()[None, :]] = 0.0
    return {"key": asked["key"].to_numpy(), "best": sim.max(axis=1)}


# --- open probes and the cells they can gain from -------------------------------------


_CELL_RATIO = 1.25
_CELL = ["grp", "c_f", "c_n"]


def with_cells(side: DataFrame) -> DataFrame:
    """Rows that have frequent shingles, with their cell: size classes of ``nf`` (frequent ones) and ``n`` (all).

    Classes grow by a quarter, so the cells of a group are bounded by the logarithms of
    the largest set, whatever the number of rows.
    """
    step = lambda c: F.floor(F.log(F.col(c).cast("double")) / F.lit(math.log(_CELL_RATIO))).cast("int")
    return side.filter("nf > 0").withColumn("c_f", step("nf")).withColumn("c_n", step("n"))


def open_visits(homes: DataFrame, probes: DataFrame, block_rows: int) -> DataFrame:
    """Cells in which a probe can still gain: (probe columns, cell, blocks, bound).

    ``probes``: (grp, key, n, nf, best), ``homes``: rows of ``with_cells``.  A partner that is
    not known yet shares frequent shingles only: with m = least(nf of the probe, largest nf of the cell)
    the similarity to a row of the cell is at most m / (n + greatest(smallest n of the cell, m) - m).  Cells that
    cannot exceed the probe's best are left out.
    """
    cells = homes.groupBy(*_CELL).agg(
        F.min("n").alias("low_n"), F.max("nf").alias("top_f"), F.ceil(F.count("*") / F.lit(block_rows)).cast("long").alias("blocks")
    )
    m = F.least("nf", "top_f")
    bound = m / (F.col("n") + F.greatest("low_n", m) - m)
    return probes.join(cells, "grp").withColumn("bound", bound).filter("bound > best").drop("low_n", "top_f")


def _visit_scan(classes: DataFrame, shared: DataFrame, side: DataFrame, probes: DataFrame, block_rows: int) -> DataFrame:
    """(key, scan): largest similarity of each probe to a row it shares frequent shingles only with.

    Best first: a probe visits the cell with its highest bound, and then those
    whose bound exceeds what it has found by then.  Groups whose open cells would carry
    more than a scan does are scanned.
    """
    homes = with_cells(side)
    opened = open_visits(homes, probes, block_rows)
    cell = F.struct("bound", "c_f", "c_n", "blocks", "nf")
    counts = shared.groupBy("key").agg(F.count("*").alias("c"))
    limit = materialized(classes.join(counts, "key").groupBy("grp").agg((_SCAN_BLOCKS * F.sum("c")).alias("most")), "limits")

    def beyond(visits: DataFrame) -> DataFrame:
        """(grp): groups whose ``visits`` (grp, v: what is carried) are more than a scan."""
        v = visits.groupBy("grp").agg(F.sum("v").alias("v"))
        return materialized(v.join(limit, "grp").filter("v > most").select("grp"), "wide")

    per_probe = opened.groupBy("grp", "key").agg(F.count("*").alias("cells"), F.max(cell).alias("f"))
    wide = beyond(per_probe.select("grp", (F.col("cells") + F.col("f.nf") * F.col("f.blocks")).alias("v")))
    gains = materialized(opened.join(wide, "grp", "left_anti"), "gains")
    first = gains.groupBy("grp", "key").agg(F.max(cell).alias("f")).select("grp", "key", "f.c_f", "f.c_n", "f.blocks")
    early = materialized(_visit(side, homes, first, block_rows), "first-visits")
    seen = first.select("key", F.col("c_f").alias("f_f"), F.col("c_n").alias("f_n")).join(early, "key", "left")
    rest = gains.join(seen, "key").filter("bound > coalesce(scan, 0d) and not (c_f = f_f and c_n = f_n)")
    wide = wide.unionByName(beyond(rest.select("grp", (F.col("nf") * F.col("blocks")).alias("v"))))
    late = _visit(side, homes, rest.join(wide, "grp", "left_anti").select("grp", "key", "c_f", "c_n", "blocks"), block_rows)
    found = early.unionByName(late)
    if not wide.isEmpty():
        whole = classes.join(wide, "grp", "left_semi")
        scan = _shared_scan(whole, shared.join(whole.select("key"), "key", "left_semi"))
        found = found.unionByName(scan.select("key", F.col("best").alias("scan")))
    return found.groupBy("key").agg(F.max("scan").alias("scan"))


def _visit(side: DataFrame, homes: DataFrame, visits: DataFrame, block_rows: int) -> DataFrame:
    """(key, scan) of ``visits`` (grp, key, cell, blocks): largest similarity of each probe to the rows of its cells.

    A cell's rows are dealt into blocks by hash, its visitors into slices.  A block
    and a slice are one unit of about ``block_rows`` rows of either side.
    """
    visits = materialized(visits, "visits")
    guests = visits.groupBy(*_CELL).agg(
        F.max("blocks").alias("blocks"), F.ceil(F.count("*") / F.lit(block_rows)).cast("long").alias("slices")
    )
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    unit = [*_CELL, "at", "part"]
    coming = (
        visits.drop("blocks").join(guests, _CELL).withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.col("slices")))
        .join(side.select("grp", "key", "n", "fs"), ["grp", "key"])
        .withColumn("at", upto("blocks")).select(*unit, "key", "n", F.col("fs").alias("sh"), F.lit(True).alias("visits"))
    )
    staying = (
        homes.join(guests, _CELL).withColumn("at", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .withColumn("part", upto("slices")).select(*unit, "key", "n", F.col("fs").alias("sh"), F.lit(False).alias("visits"))
    )
    found = map_groups(coming.unionByName(staying), unit, _best_of_visit, "key long, best double")
    return found.groupBy("key").agg(F.max("best").alias("scan"))


# --- largest peer similarity --------------------------------------------------------

#: Classes a block of a scan aims at and may hold at most, and blocks a group is cut into before blocks grow.
_SCAN_ROWS, _SCAN_MOST, _SCAN_BLOCKS = 8192, 65_536, 16
#: Cells of one slice of a comparison, and shared shingles looked up at once.
_SLICE_CELLS = 2_000_000


def _best_in_blocks(pdf: pd.DataFrame) -> dict:
    """Per class the largest similarity to, and copy-weighted sum over, other classes of the unit; slices bound the memory, whatever the blocks hold."""
    a, b, same = _sides(pdf)
    if not len(a) or not len(b):
        return {}
    lv, li = _flat(a["sh"])
    rv, ri = _flat(b["sh"])
    order = np.argsort(rv, kind="stable")
    rv, ri = rv[order], ri[order]
    lo, hi = np.searchsorted(rv, lv, "left"), np.searchsorted(rv, lv, "right")
    na, nb = a["n"].to_numpy(np.float64), b["n"].to_numpy(np.float64)
    best_a, best_b, width = np.zeros(len(a)), np.zeros(len(b)), len(b)
    wa, wb = a["copies"].to_numpy(np.float64), b["copies"].to_numpy(np.float64)
    total_a, total_b = np.zeros(len(a)), np.zeros(len(b))
    cnt = hi - lo
    first = np.searchsorted(li, np.arange(len(a) + 1))  # the occurrences of a row
    before = np.concatenate(([0], np.cumsum(cnt)))[first]  # matches before a row
    row = 0
    while row < len(a):
        stop = min(row + max(_SLICE_CELLS // width, 1), max(row + 1, int(np.searchsorted(before, before[row] + _MATCH_CHUNK, "right")) - 1))
        at = slice(first[row], first[stop])
        c = cnt[at]
        if c.sum():
            cols = ri[np.repeat(lo[at], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)]
            cells = np.repeat(li[at] - row, c) * width + cols
            if c.sum() * 8 < (stop - row) * width:  # few matches: only the cells that have one
                cells, inter = np.unique(cells, return_counts=True)
                r, k = cells // width, cells % width
                if same:
                    other = r + row != k
                    r, k, inter = r[other], k[other], inter[other]
                sim = inter / (na[r + row] + nb[k] - inter)
                np.maximum.at(best_a, r + row, sim)
                np.maximum.at(best_b, k, sim)
                total_a += np.bincount(r + row, sim * wb[k], len(a))
                total_b += np.bincount(k, sim * wa[r + row], width)
            else:
                inter = np.bincount(cells, minlength=(stop - row) * width).reshape(stop - row, width)
                sim = inter / np.maximum(na[row:stop, None] + nb[None, :] - inter, 1.0)
                if same:
                    sim[np.arange(stop - row), np.arange(row, stop)] = 0.0
                best_a[row:stop] = sim.max(axis=1)
                np.maximum(best_b, sim.max(axis=0), out=best_b)
                total_a[row:stop] += sim @ wb
                total_b += wa[row:stop] @ sim
        row = stop
    sides = ((a, best_a, total_a),) if same else ((a, best_a, total_a), (b, best_b, total_b))
    return {
        "key": np.concatenate([x["key"].to_numpy() for x, _, _ in sides]), "best": np.concatenate([x for _, x, _ in sides]),
        "total": np.concatenate([x for _, _, x in sides]),
    }


def _shared_scan(heads: DataFrame, shared: DataFrame, block_rows: int | None = None) -> DataFrame:
    """(key, best, total) of each class against all other classes of its group, on the shingles it shares with any.

    Most shingles of a text are its own, and those are not carried.  A group is cut
    into up to ``_SCAN_BLOCKS`` blocks, so a row is carried that often at most, and
    into more only when a block would hold more than ``_SCAN_MOST`` rows.
    """
    lists = heads.select("grp", "key", "n", "copies").join(shared.groupBy("key").agg(F.collect_list("s").alias("sh")), "key")
    m = F.count("*")
    blocks = F.greatest(F.least(F.ceil(m / F.lit(block_rows or _SCAN_ROWS)), F.lit(_SCAN_BLOCKS)), F.ceil(m / F.lit(_SCAN_MOST)))
    lists = materialized(lists, "scan")
    units = _in_block_pairs(lists, lists.groupBy("grp").agg(blocks.cast("long").alias("blocks")))
    found = map_groups(units, ["grp", "lo", "hi"], _best_in_blocks, "key long, best double, total double")
    return found.groupBy("key").agg(F.max("best").alias("best"), F.sum("total").alias("total"))


def _shared_shingles(classes: DataFrame) -> DataFrame:
    """(key, s, df): the shingles that more than one class of a group has; only those can meet."""
    occ = classes.select("key", F.explode(F.transform("sh", lambda s: F.xxhash64("grp", s))).alias("s"))
    return materialized(occ.withColumn("df", F.count("*").over(Window.partitionBy("s"))).filter("df > 1"), "shared")


def max_peer_similarity(
    df: DataFrame, id_col: str, group: str, text: str, tokens: str = "space", n: int = 3,
    rare: int = 64, block_rows: int = 512, direct_rows: int = 2048,
) -> DataFrame:
    """(id, sim): largest n-gram Jaccard of each row to another row of its group.

    Exact.  Copies score 1.  Shingles that only one class of a group has cannot
    meet; one shuffle of (shingle, class) finds the others, and nothing else is
    carried from there.  Groups of more than ``direct_rows`` classes go through an
    inverted index if it makes few pairs (``_few_pairs``); rows it cannot settle
    visit only the cells whose sizes leave room for a better partner.  In all other
    groups blocks of shared shingles are compared with each other.
    """
    members, heads, classes, keyed = fold_copies(word_shingles(df, id_col, group, text, tokens, n))
    shared = _shared_shingles(classes)
    drop_scratch(keyed)
    large = materialized(_few_pairs(heads, shared, rare, direct_rows), "indexed")
    of = heads.select("grp", "key").join(large, "grp", "left_semi").select("key")
    if large.isEmpty():
        found = _shared_scan(heads, shared).drop("total")
    else:
        found = _shared_scan(heads.join(large, "grp", "left_anti"), shared.join(of, "key", "left_anti")).drop("total")
        indexed = _indexed_best(heads.join(large, "grp", "left_semi"), shared.join(of, "key", "left_semi"), rare, block_rows)
        found = found.unionByName(indexed.withColumnRenamed("sim", "best"))
    copied = (F.col("copies") > 1) & (F.col("n") > 0)
    final = heads.join(found, "key", "left").select(
        "grp", "key", F.when(copied, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("sim")
    )
    return members.join(final, ["grp", "key"], "left").select("id", F.coalesce("sim", F.lit(0.0)).alias("sim"))


def _few_pairs(heads: DataFrame, shared: DataFrame, rare: int, direct_rows: int) -> DataFrame:
    """(grp): groups of more than ``direct_rows`` classes in which the inverted index carries no more than a scan would.

    A pair of the index carries the frequent shingles of both sides, a scan carries
    every shared shingle up to ``_SCAN_BLOCKS`` times.
    """
    few = F.col("df") <= rare
    per_key = shared.groupBy("key").agg(
        F.count("*").alias("c"), F.count_if(~few).alias("nf"), F.sum(F.when(few, (F.col("df") - 1) / 2)).alias("pairs")
    )
    sums = heads.join(per_key, "key", "left").groupBy("grp").agg(
        F.count("*").alias("m"), F.sum("c").alias("c"), F.avg("nf").alias("nf"), F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs")
    )
    carried = F.col("pairs") * (2 + F.coalesce("nf", F.lit(0.0)))
    return sums.filter((F.col("m") > direct_rows) & (carried <= _SCAN_BLOCKS * F.col("c"))).select("grp")


def _indexed_best(classes: DataFrame, shared: DataFrame, rare: int, block_rows: int) -> DataFrame:
    """(key, sim): largest similarity of each class to another class of its group.  ``shared``: key, s, df.

    1. Shingles that occur in at most ``rare`` classes of the group find
    partners through an inverted index: bounded lists, so at most rare / 2
    pairs per occurrence.  2. A partner the index cannot see shares frequent
    shingles only, so its similarity is at most (frequent shingles) / n.  For rows
    whose best partner reaches that bound the index answer is the maximum.  3. The
    others carry their frequent shingles to the cells that can exceed their best;
    in a group where that is more than a scan carries, they are scanned instead.
    """
    lists = shared.filter(F.col("df") <= rare).groupBy("s").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    partners = (
        lists.select("keys", F.posexplode("keys").alias("i", "a"))
        .select("a", F.explode(F.expr("slice(keys, i + 2, size(keys))")).alias("b"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("inter"))
    )
    frequent = shared.filter(F.col("df") > rare).groupBy("key").agg(F.collect_list("s").alias("fs"))
    side = classes.select("grp", "key", "n").join(frequent, "key", "left")
    side = materialized(side.withColumn("nf", F.when(F.col("fs").isNull(), 0).otherwise(F.size("fs"))), "frequent")

    def as_side(x: str) -> DataFrame:
        return side.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("fs").alias(f"f{x}"))

    both = F.coalesce(F.size(F.array_intersect("fa", "fb")), F.lit(0))
    inter = F.col("inter") + F.when(F.col("fa").isNull() | F.col("fb").isNull(), F.lit(0)).otherwise(both)
    scored = (
        partners.join(as_side("a"), "a")
        .join(as_side("b"), "b")
        .select("a", "b", (inter / (F.col("na") + F.col("nb") - inter)).alias("sim"))
    )
    by_index = (
        scored.select(F.explode(F.array("a", "b")).alias("key"), "sim").groupBy("key").agg(F.max("sim").alias("best"))
    )
    status = materialized(
        side.select("grp", "key", "n", "nf").join(classes.select("grp", "key", "copies"), ["grp", "key"]).join(by_index, "key", "left")
        .withColumn("best", F.coalesce("best", F.lit(0.0))),
        "index-best",
    )
    bound = F.col("nf") / F.greatest(F.col("n"), F.lit(1))
    unsettled = status.filter((F.col("copies") == 1) & (F.col("best") < bound)).drop("copies")
    scanned = _visit_scan(classes, shared, side, unsettled, block_rows)
    return status.join(scanned, "key", "left").select("key", F.greatest("best", F.coalesce("scan", F.lit(0.0))).alias("sim"))


# --- peer profile ---------------------------------------------------------------------


def peer_profile(
    df: DataFrame, id_col: str, group: str, text: str, tokens: str = "alnum", n: int = 3, block_rows: int | None = None
) -> DataFrame:
    """Per group: pairs, and statistics of the largest and the mean peer similarity.

    The mean runs over all n-1 peers, so every pair counts.  Pairs without a common
    shingle add nothing: only shingles that another class of the group has are
    carried, at most ``_SCAN_BLOCKS`` times in groups of up to ``_SCAN_BLOCKS`` *
    ``_SCAN_MOST`` classes, and only per-row maxima and sums leave the blocks.
    """
    from corpusloom.operators.ranking import floor_quantiles

    members, heads, classes, keyed = fold_copies(word_shingles(df, id_col, group, text, tokens, n))
    shared = _shared_shingles(classes)
    drop_scratch(keyed)
    scan = _shared_scan(heads, shared, block_rows)
    per_class = materialized(heads.join(scan, "key", "left"), "peers")
    sizes = members.groupBy("grp").agg(F.count("*").alias("rows"))
    full = F.col("n") > 0  # rows without a shingle have similarity 0 to everything
    weighted = per_class.select(
        "grp", F.col("copies").alias("w"),
        F.when(full & (F.col("copies") > 1), F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("mx"),
        F.when(full, F.coalesce("total", F.lit(0.0)) + F.col("copies") - 1).otherwise(F.lit(0.0)).alias("sm"),
    )
    weighted = weighted.join(sizes, "grp").select(
        "grp", "w", "rows", T.round_to(F.col("mx"), 9).alias("mx"),
        T.round_to(F.when(F.col("rows") > 1, F.col("sm") / (F.col("rows") - 1)).otherwise(0.0), 9).alias("mn"),
    )
    means = weighted.groupBy("grp").agg(
        (F.max("rows") * (F.max("rows") - 1) / 2).cast("long").alias("n_pairs"),
        (F.sum(F.col("mx") * F.col("w")) / F.max("rows")).alias("max_peer_mean"),
        F.max("mx").alias("max_peer_max"),
        (F.sum(F.col("mn") * F.col("w")) / F.max("rows")).alias("mean_peer_mean"),
    )
    qmax = floor_quantiles(weighted, ["grp"], "mx", {"max_peer_p50": 0.5, "max_peer_p90": 0.9}, "w")
    qmean = floor_quantiles(weighted, ["grp"], "mn", {"mean_peer_p50": 0.5}, "w")
    joined = means.join(qmax, "grp").join(qmean, "grp")
    return joined.select(
        F.col("grp").alias(group), "n_pairs", "max_peer_mean", "max_peer_p50", "max_peer_p90", "max_peer_max",
        "mean_peer_mean", "mean_peer_p50",
    )


def _min_hashes(hashes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(grp, m) of rows (grp, sh) whose sets are not empty: the smallest value of each of ``hashes`` hashes."""

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                pdf = whole.iloc[at : at + 256]
                sizes = np.fromiter((len(s) for s in pdf["sh"]), np.int64, len(pdf))
                values = np.concatenate([np.asarray(s, np.int64) for s in pdf["sh"]]).view(np.uint64)
                starts = np.cumsum(sizes) - sizes
                low = np.stack([np.minimum.reduceat(_mixed(values, 1000 + i), starts) for i in range(hashes)], axis=1)
                yield pd.DataFrame({"grp": pdf["grp"].to_numpy(), "m": list(low.view(np.int64))})

    return kernel


def peer_mean_estimate(
    df: DataFrame, id_col: str, group: str, text: str, tokens: str = "alnum", n: int = 3, hashes: int = 64
) -> DataFrame:
    """Per group: rows, an estimate of the mean similarity over all pairs, and its standard error.  Linear in the rows.

    Two sets agree in a min-hash with a probability that is their Jaccard
    similarity.  So the pairs of rows that share a value, c (c - 1) summed over the
    values of a hash, estimate the sum over all pairs without bias; ``hashes``
    independent ones give the mean and its error.  Rows without a shingle agree
    with nothing.  ``peer_profile`` has the exact figures at quadratic cost.
    """
    sets = materialized(word_shingles(df, id_col, group, text, tokens, n).select("grp", "sh", "n"), "shingles")
    kind = sets.schema["grp"].dataType.simpleString()
    marks = sets.filter("n > 0").select("grp", "sh").mapInPandas(_min_hashes(hashes), f"grp {kind}, m array<long>")
    shared = marks.select("grp", F.posexplode("m").alias("i", "h")).groupBy("grp", "i", "h").agg(F.count("*").alias("c"))
    per_hash = shared.groupBy("grp", "i").agg(F.sum(F.col("c") * (F.col("c") - 1)).cast("double").alias("pairs"))
    sizes = sets.groupBy("grp").agg(F.count("*").alias("rows"))
    share = F.when(F.col("rows") > 1, F.col("pairs") / (F.col("rows") * (F.col("rows") - 1))).otherwise(0.0)
    rows = sizes.join(per_hash, "grp", "left").groupBy("grp", "rows").agg(
        F.coalesce(F.avg(share), F.lit(0.0)).alias("mean"), (F.coalesce(F.stddev_samp(share), F.lit(0.0)) / math.sqrt(hashes)).alias("error")
    )
    return rows.select(F.col("grp").alias(group), "rows", F.col("mean").alias("mean_similarity"), F.col("error").alias("standard_error"))


# --- near-duplicate groups -----------------------------------------------------------


def forest_edges(threshold: float) -> Callable[[pd.DataFrame], dict]:
    def kernel(pdf: pd.DataFrame) -> dict:
        """Edges of a spanning forest of the verified pairs of one block pair."""
        a, b, _ = _sides(pdf)
        if not len(a) or not len(b) or len(pdf) < 2:
            return {}
        near = jaccard_matrix(a, b) >= threshold
        if "comp" in pdf:  # rows that are connected already need no edge
            near &= a["comp"].to_numpy()[:, None] != b["comp"].to_numpy()[None, :]
        ii, jj = np.nonzero(near)
        ka, kb = a["key"].to_numpy(), b["key"].to_numpy()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for x, y in zip(ka[ii].tolist(), kb[jj].tolist(), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                edges.append((min(x, y), max(x, y)))
        if not edges:
            return {}
        found = np.array(edges, dtype=np.int64)
        return {"a": found[:, 0], "b": found[:, 1]}

    return kernel


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each number (two multiply-and-shift rounds); wraps round on purpose."""
    with np.errstate(over="ignore"):
        x = values + np.uint64(2 * seed + 1) * np.uint64(0x9E3779B97F4A7C15)
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(29))) * np.uint64(factor)
        return x ^ (x >> np.uint64(32))


def one_permutation_sketches(sets: pd.Series, bins: int, seed: int) -> np.ndarray:
    """``bins`` min-hashes of each set from one hash per element.

    The hash deals the elements over the bins, and a bin keeps its smallest.  An
    empty bin takes the content of another one, tried in an order that depends on
    the bin alone; so two sets agree in a bin with a probability that is their
    Jaccard similarity, whether it was filled or not.  Sets are not empty.
    """
    arrays = [unpack_set(s) for s in sets]
    sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
    values = np.concatenate(arrays).view(np.uint64)
    mixed = _mixed(values, seed)
    empty = np.iinfo(np.uint64).max
    sketch = np.full(len(sets) * bins, empty, np.uint64)
    place = np.repeat(np.arange(len(sets), dtype=np.int64) * bins, sizes) + (mixed % np.uint64(bins)).astype(np.int64)
    np.minimum.at(sketch, place, mixed)
    sketch = sketch.reshape(len(sets), bins)
    own = sketch.copy()
    row, col = np.nonzero(own == empty)
    turn = 0
    while len(row):
        turn += 1
        tried = own[row, (_mixed(col.astype(np.uint64) + np.uint64(turn * bins), seed + 1) % np.uint64(bins)).astype(np.int64)]
        full = tried != empty
        sketch[row[full], col[full]] = tried[full]
        row, col = row[~full], col[~full]
    return sketch


def minhash_sketches(classes: DataFrame, permutations: int = 128, bands: int = 16, seed: int = 7) -> DataFrame:
    """(key, n, buckets, sk): ``bands`` hashes of ``permutations / bands`` min-hashes each, and four bits of every min-hash."""
    rows = permutations // bands

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 256):  # a few hundred sets at a time stay in the cache
                pdf = whole.iloc[at : at + 256]
                sketch = one_permutation_sketches(pdf["sh"], permutations, seed).reshape(len(pdf), bands, rows)
                bucket = np.zeros((len(pdf), bands), np.uint64)
                for r in range(rows):
                    bucket = _mixed(bucket ^ sketch[:, :, r], seed + 2 + r)
                low = (sketch.reshape(len(pdf), permutations) >> np.uint64(7)).astype(np.uint8) & 15
                packed = np.zeros((len(pdf), -(-permutations // 16) * 8), np.uint8)  # whole words, the rest is zero
                packed[:, : (permutations + 1) // 2] = low[:, ::2]
                packed[:, : permutations // 2] |= low[:, 1::2] << 4
                yield pd.DataFrame({
                    "key": pdf["key"].to_numpy(), "n": pdf["n"].to_numpy(), "buckets": list(bucket.view(np.int64)),
                    "sk": [row.tobytes() for row in packed],
                })

    return classes.filter("n > 0").select("key", "n", "sh").mapInPandas(kernel, "key long, n int, buckets array<long>, sk binary")


def duplicate_cells(marks: DataFrame, threshold: float) -> DataFrame:
    """(key, grp): cells of rows with ``minhash_sketches`` whose members may be near-duplicates.

    A cell is a min-hash bucket cut by logarithmic size class.  Jaccard >= t
    needs sizes within a factor t, so each row joins its own class and the
    next: no qualifying pair of a bucket is lost, most false company is.
    """
    width = -math.log(threshold - 1e-9)
    size_class = F.floor(F.log(F.col("n").cast("double")) / width)
    banded = marks.select("key", F.explode(F.array(size_class, size_class + 1)).alias("cls"), F.posexplode("buckets").alias("band", "bucket"))
    return banded.select("key", F.xxhash64("band", "bucket", "cls").alias("grp"))


#: Sets below this size are always compared whole; rows of a block of sketches, and of a cell that is compared by sketches.
_SKETCHED_FROM, _SKETCH_ROWS, _SKETCH_MOST = 256, 4096, 65_536


def least_agreeing(threshold: float, permutations: int) -> int:
    """Equal min-hashes, of ``permutations``, below which a pair is not at ``threshold``: four standard deviations less.

    Chance agreement of the four bits that are kept adds another half deviation; the bands miss far more pairs.
    """
    return math.floor(permutations * threshold - 4 * math.sqrt(permutations * threshold * (1 - threshold)))


def _sketched_groups(threshold: float, permutations: int):
    """(key, grp): rows of a unit with another row there that may be near by size and sketch.

    A cell of one block is parted into its components over such pairs; a part is
    named by its members, so the same part of several cells has one name.
    """
    least, words = least_agreeing(threshold, permutations), -(-permutations // 16)
    ones = np.uint64(0x1111111111111111)

    def kernel(pdf: pd.DataFrame) -> dict:
        a, b, same = _sides(pdf)
        if not len(a) or not len(b) or len(pdf) < 2:
            return {}
        left, right = (np.frombuffer(b"".join(x["sk"]), np.uint64).reshape(len(x), words) for x in (a, b))
        na, nb = a["n"].to_numpy(np.float64), b["n"].to_numpy(np.float64)
        some_a, some_b, part_of = np.zeros(len(a), bool), np.zeros(len(b), bool), np.arange(len(a))
        step = max(200_000 // len(b), 1)
        for at in range(0, len(a), step):
            part = slice(at, at + step)
            i, j = np.nonzero(np.minimum(na[part, None], nb[None, :]) >= threshold * np.maximum(na[part, None], nb[None, :]))
            i += at
            if same:
                i, j = i[i < j], j[i < j]
            apart = np.zeros(len(i), np.int64)
            for w in range(words):
                x = left[i, w] ^ right[j, w]
                x |= x >> np.uint64(2)
                apart += np.bitwise_count((x | (x >> np.uint64(1))) & ones)
            near = (permutations - apart >= least) | (na[i] < _SKETCHED_FROM) | (nb[j] < _SKETCHED_FROM)
            i, j = i[near], j[near]
            some_a[i] = True
            some_b[j] = True
            while same:
                low, high = np.minimum(part_of[i], part_of[j]), np.maximum(part_of[i], part_of[j])
                if (low == high).all():
                    break
                np.minimum.at(part_of, high, low)
                part_of = part_of[part_of]
        if same:
            some = some_a | some_b
            while (part_of != part_of[part_of]).any():
                part_of = part_of[part_of]
            names = np.zeros(len(a), np.uint64)
            np.bitwise_xor.at(names, part_of, _mixed(a["key"].to_numpy().view(np.uint64), 3))
            one = pdf["blocks"].iat[0] == 1
            key, grp = a["key"].to_numpy()[some], (names[part_of].view(np.int64) if one else a["grp"].to_numpy())[some]
        else:
            key, grp = (np.concatenate([a[c].to_numpy()[some_a], b[c].to_numpy()[some_b]]) for c in ("key", "grp"))
        return {"key": key, "grp": grp} if len(key) else {}

    return kernel


def near_cells(marks: DataFrame, threshold: float, permutations: int) -> DataFrame:
    """(key, grp): cells of ``duplicate_cells`` parted into rows that may be near, equal cells once.

    Whole sets are large, most company in a cell is false, and near rows meet in
    many cells.  So blocks of narrow sketches are compared first: a row stays only
    with partners that may be near, and the same company in several cells is one.
    Cells of more than ``_SKETCH_MOST`` rows stay as they are, so a row is carried a bounded number of times.
    """
    cells = materialized(duplicate_cells(marks, threshold).distinct(), "cells")

    def once(rows: DataFrame) -> DataFrame:
        """(grp, m): cells of several rows; of those with the same members the first."""
        seen = rows.groupBy("grp").agg(F.count("*").alias("m"), F.min("key").alias("pivot"), F.bit_xor(F.xxhash64("key")).alias("sig"))
        return seen.filter("m > 1").groupBy("m", "pivot", "sig").agg(F.min("grp").alias("grp")).select("grp", "m")

    crowded = materialized(cells.join(once(cells), "grp"), "crowded")
    small = crowded.filter(F.col("m") <= _SKETCH_MOST).select("key", "grp", F.ceil(F.col("m") / F.lit(_SKETCH_ROWS)).alias("blocks"))
    blk = small.withColumn("blk", F.pmod(F.xxhash64("key"), F.col("blocks"))).repartition("grp", "key")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("oth")
    units = blk.select("*", other).withColumn("lo", F.least("blk", "oth")).withColumn("hi", F.greatest("blk", "oth")).join(marks.select("key", "n", "sk"), "key")
    found = map_groups(units, ["grp", "lo", "hi"], _sketched_groups(threshold, permutations), "key long, grp long").distinct()
    found = materialized(found.unionByName(crowded.filter(F.col("m") > _SKETCH_MOST).select("key", "grp")), "partners")
    return materialized(found.join(once(found).select("grp"), "grp", "left_semi").select("key", "grp"), "cells")


def near_duplicate_components(
    classes: DataFrame, threshold: float, permutations: int = 128, bands: int = 16, block_rows: int = 256
) -> DataFrame:
    """(key, comp): components of classes connected by verified Jaccard >= threshold.

    Cells are those of ``near_cells``.  1. Each cell is split into blocks of bounded size; its pivot (smallest key)
    joins every block, and all pairs inside a block are verified on whole sets.
    This is linear in the cell, and complete for cells of one block.
    2. A larger cell whose members are one component by now can add nothing: a
    crowd of near-copies ends here.  Only cells that still hold several
    components compare their blocks with each other, and only across components.
    A block returns a spanning forest, never its pairs.
    """
    marks = materialized(minhash_sketches(classes, permutations, bands), "sketches")
    cells = near_cells(marks, threshold, permutations)
    crowded = cells.groupBy("grp").agg(F.count("*").alias("m"), F.min("key").alias("pivot"))
    sets = classes.select("key", "sh", "n")
    blocks = F.ceil(F.col("m") / F.lit(block_rows))
    home = F.pmod(F.xxhash64("key"), blocks)
    joins = F.when(F.col("key") == F.col("pivot"), F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(home))
    placed = cells.join(crowded, "grp").select("key", "grp", F.explode(joins).alias("blk"))
    work = placed.join(sets, "key").withColumn("lo", F.col("blk")).withColumn("hi", F.col("blk"))
    kernel, group = forest_edges(threshold), ["grp", "lo", "hi"]
    edges = materialized(map_groups(work, group, kernel, "a long, b long").distinct(), "edges")
    comps = connected_components(edges)

    large = crowded.filter(F.col("m") > block_rows).select("grp")
    if large.isEmpty():
        return comps
    members = cells.join(large, "grp").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = members.groupBy("grp").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1")
    rest = members.join(mixed.select("grp"), "grp", "left_semi")
    rest = materialized(rest, "mixed")
    visits = block_pairs(rest, block_rows, deal=True).filter("lo <> hi").join(sets_of(sets, rest).hint("merge"), "key")
    across = materialized(map_groups(visits, group, kernel, "a long, b long").distinct(), "edges")
    return comps if across.isEmpty() else connected_components(edges.unionByName(across))


def sets_of(classes: DataFrame, keys: DataFrame) -> DataFrame:
    """The classes of ``keys`` (key).

    Keys are written first, so Spark knows how few they are: a small number is sent
    to the sets, and those of all other classes are not shuffled.
    """
    return classes.join(materialized(keys.select("key").distinct(), "wanted"), "key", "left_semi")


def near_pairs(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (key, n, other, other_n) those whose sets are near, with ``similarity``; sizes are compared before sets are fetched."""
    fit = materialized(pairs.filter(F.least("n", "other_n") >= threshold * F.greatest("n", "other_n")), "pairs")
    left = sets_of(classes.select("key", "sh"), fit)
    right = sets_of(classes.select("key", "sh"), fit.select(F.col("other").alias("key"))).select(F.col("key").alias("other"), F.col("sh").alias("other_sh"))
    shared = shared_numbers("sh", "other_sh")
    # a pair is a few bytes and much work: partitions sized by bytes would be far too few
    parts = max(fit.count() // 4_000, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = fit.repartition(parts, "key").join(left, "key").join(right, "other")
    measured = both.select(*pairs.columns, (shared / (F.col("n") + F.col("other_n") - shared)).alias("similarity"))
    return measured.filter(F.col("similarity") >= threshold)


def connected_components(edges: DataFrame) -> DataFrame:
    """(key, comp): smallest key reachable over undirected edges.

    Alternates large-star and small-star steps; the number of rounds grows with
    the logarithm of the longest path.  A step joins edges with one narrow
    (node, minimum) row per node, so the neighbours of a hub are never gathered
    in one place and a skewed join side can be split.
    """
    cur = materialized(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    if cur.isEmpty():
        return cur.select(F.col("a").alias("key"), F.col("b").alias("comp"))

    def low(nodes: DataFrame) -> DataFrame:
        return nodes.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def fingerprint(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()

    state = fingerprint(cur)
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = (
            both.join(low(both), "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        m = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(m, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a <> b").distinct()
        )
        nxt = materialized(small, "edges")
        before, state = state, fingerprint(nxt)
        cur = nxt
        if state == before:
            break
    comps = cur.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("comp"))
    roots = comps.select(F.col("comp").alias("key"), "comp").distinct()
    return comps.unionByName(roots)


def near_duplicates(
    df: DataFrame, id_col: str, text: str, score: str, threshold: float = fv.NEAR_DUPLICATE_JACCARD,
    permutations: int = 128, bands: int = 16, block_rows: int = 256,
) -> DataFrame:
    """(id, keep_id, members, similarity): members of each near-duplicate group and the row it keeps.

    Groups are closed over chains, so a member may be further from the row that is
    kept than the threshold; ``similarity`` is its Jaccard similarity to that row.
    Kept is the best score, then the smallest id.  Texts too short for a shingle
    have equal (empty) sets, so they form one group.
    """
    members, _, classes, keyed = fold_copies(char_shingles(df, id_col, text))
    classes = materialized(classes.select("key", "sh", "n"), "sets")  # read several times
    drop_scratch(keyed)
    comps = near_duplicate_components(classes, threshold, permutations, bands, block_rows)
    scores = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score"))
    grouped = (
        members.join(comps, "key", "left")
        .withColumn("comp", F.coalesce("comp", "key"))
        .join(scores, "id")
        .select("id", "key", "comp", "score")
    )
    best = grouped.groupBy("comp").agg(
        F.min_by(F.struct("id", "key"), F.struct((-F.col("score")).alias("s"), F.col("id").alias("i"))).alias("keep"),
        F.count("*").alias("members"),
    )
    placed = materialized(grouped.join(best, "comp").select("id", "key", F.col("keep.id").alias("keep_id"), F.col("keep.key").alias("keep_key"), "members"), "groups")
    # measured once per pair of classes, not per row
    sets = classes.select("key", "sh", "n")
    apart = materialized(placed.filter("key <> keep_key").select("key", "keep_key").distinct(), "apart")
    pairs = apart.join(sets_of(sets, apart), "key")
    kept = sets_of(sets, apart.select(F.col("keep_key").alias("key")))
    kept = kept.select(F.col("key").alias("keep_key"), F.col("sh").alias("keep_sh"), F.col("n").alias("keep_n"))
    shared = shared_numbers("sh", "keep_sh")
    close = pairs.join(kept, "keep_key").select("key", "keep_key", (shared / (F.col("n") + F.col("keep_n") - shared)).alias("similarity"))
    return placed.join(close, ["key", "keep_key"], "left").select("id", "keep_id", "members", F.coalesce("similarity", F.lit(1.0)).alias("similarity"))


def drop_duplicate_keys(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """Keep the smallest id of each key: (key, id, copies)."""
    return df.groupBy(key.alias("key")).agg(F.min(id_col).alias(id_col), F.count("*").alias("copies"))
