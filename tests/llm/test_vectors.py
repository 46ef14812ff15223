import math
import random

import numpy as np

from corpusloom.llm import embed_dedup as E
from corpusloom.llm import topk as T

VEC = "vec_id long, embedding array<float>, label int"


def vectors(seed=2, groups=6, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        for _ in range(12):
            base = rng.standard_normal(dim)
            for noise in (0.0, 0.0, 0.03, 0.08, 0.12, 0.2, 1.0):
                rows.append((len(rows) * 5, [float(np.float32(x)) for x in base + noise * rng.standard_normal(dim)], g % 4))
    crowd = rng.standard_normal(dim)
    rows += [(len(rows) * 5 + i, [float(np.float32(x)) for x in crowd + 0.05 * rng.standard_normal(dim)], 1) for i in range(1, 80)]
    return rows


def naive_links(rows, t=0.98):
    ok = {i: (np.array(v, float), g) for i, v, g in rows if v and g is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = {i: set() for i, _, _ in rows}
    for a in ok:
        for b in ok:
            if a < b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]):
                x, y = ok[a][0], ok[b][0]
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= t:
                    links[a].add(b)
                    links[b].add(a)
    return links


def lowest(links):
    low = {i: i for i in links}
    for _ in links:
        new = {i: min([low[i], *(low[j] for j in links[i])]) for i in links}
        if new == low:
            break
        low = new
    return low


BAD = [(90_001, None, 1), (90_002, [], 1), (90_003, [0.0, 0.0], 1), (90_004, [1.0, None], 1), (90_005, [float("nan"), 1.0], 1),
       (90_006, [1.0, float("inf")], 1), (90_007, [1.0, 2.0], None), (90_008, [1.0, 2.0], 1), (90_009, [2.0, 4.0], 1), (90_010, [1.0], 1)]


def test_links_and_components(spark):
    rows = vectors() + BAD
    df = spark.createDataFrame(rows, VEC)
    links = naive_links(rows)
    low = lowest(links)
    for blocks in (2048, 60):
        got = E.near_vectors(df, block_rows=blocks).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (len(links[i]), low[i], low[i] == i) for i in links}
        assert len(got) == len(rows)


def test_repeats_missing_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0], 3), (1, [1.0, 0.0], 3), (None, [1.0, 0.001], 3), (None, [0.0, 1.0], 3), (0, [1.0, 0.0], 4)]
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in E.near_vectors(spark.createDataFrame(rows, VEC)).collect()), key=str)
    assert got == sorted([(False, 1, 2, 1, True), (False, 1, 2, 1, True), (True, 0, 2, 1, False), (True, 0, 0, None, True), (False, 0, 0, 0, True)], key=str)
    assert E.near_vectors(spark.createDataFrame([], VEC)).count() == 0


def test_calibration_keeps_its_promise():
    window, need = E.calibrate(0.98, 24, 1.6, 1e-6)
    rng = np.random.default_rng(0)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * side
    d = E._directions(64, 24, 3)
    counts = (np.abs((a - b) @ d.T) <= window).sum(1)
    assert counts.min() >= need > 8


def test_collision_counts_are_window_counts():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((40, 5)), rng.standard_normal((30, 5))
    want = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.4).sum(2)
    assert (E.collision_counts(a, b, 0.4) == want).all()


def naive_top(rows, every, k):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(2**63)), 2**63 - 1)
    out = []
    for n, (q, w) in enumerate(ints):
        if q % every == 0:
            scored = sorted((-dot(w, v), i) for m, (i, v) in enumerate(ints) if m != n and len(v) == len(w))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_rows_that_share_an_id_all_count(spark):
    """Of two rows with id 1 the better one is the answer; a row with the query's id is another row; clashing names do not matter."""
    rows = [(0, [10.0, 1.0], 1), (1, [23.0, 0.0], 1), (1, [5.0, 1.0], 1), (0, [1.0, 1.0], 2), (50, [2.0, 2.0], 2), (50, [2.0, 2.0], 3)]
    df = spark.createDataFrame([(*r, 7, "x", 1.0) for r in rows], VEC + ", no int, shard string, score double")
    for shard in (2048, 2):
        got = T.exact_top_k(df, shard_rows=shard, block_rows=2).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == naive_top(rows, 50, 5)


def test_top_k(spark):
    rows = vectors(groups=4) + BAD + [(None, [1.0] * 24, 1)]
    rows += [(100_000 + i, rows[3][1], 0) for i in range(0, 90)]  # equal vectors: ties go to the smaller id
    rows += [(100_000, [0.5] * 24, 0), (100_000, rows[3][1], 0)]  # one id twice
    df = spark.createDataFrame(rows, VEC).repartition(5)
    want = naive_top(rows, 50, 5)
    for shard, block in ((2048, 2048), (50, 7)):
        got = T.exact_top_k(df, shard_rows=shard, block_rows=block, leaf=8).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_top_k_edges(spark):
    few = [(0, [1.0, -2.0], 1), (3, [0.5, 0.5], 1), (50, [1e30, 1.0], 1), (7, [1e30, -1e30], 1), (100, [3.0], 0)]
    got = T.exact_top_k(spark.createDataFrame(few, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == naive_top(few, 50, 5)
    assert T.exact_top_k(spark.createDataFrame([], VEC)).count() == 0


def test_tree_boxes_are_tight():
    rng = random.Random(0)
    v = np.array([[rng.randint(-9, 9) for _ in range(3)] for _ in range(300)], float)
    tree = T.Tree(np.arange(300), v, 16)
    for n in range(len(tree.lo)):
        part = tree.vectors[tree.first[n] : tree.last[n]]
        assert (part.min(0) == tree.lo[n]).all() and (part.max(0) == tree.hi[n]).all()
        assert tree.left[n] >= 0 or len(part) <= 16 or (part == part[0]).all()
