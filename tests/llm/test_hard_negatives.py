import math

import duckdb
import numpy as np

from corpusloom.llm import hard_negatives as H
from corpusloom.llm.queries import ORACLES, QUERIES

VEC = "vec_id long, embedding array<float>, label int"


def naive(rows, every=100, positives=5, k=5):
    ok = [(i, g, [math.floor(256 * x) for x in v]) for i, v, g in rows if i is not None and g is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(2**63)), 2**63 - 1)
    out = []
    for n, (i, g, v) in enumerate(ok):
        if i % every == 0:
            others = [(-dot(v, w), j, h) for m, (j, h, w) in enumerate(ok) if m != n and len(w) == len(v)]
            for s, j, _ in sorted(o for o in others if o[2] == g)[:positives]:
                fit = sorted((t, m) for t, m, h in others if h != g and 80 * -s <= 100 * -t <= 100 * -s)[:k]
                out += [(i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(fit)]
    return sorted(out)


def answer(df, **options):
    return sorted(tuple(r) for r in H.hard_negatives(df, **options).collect())


def crowd(seed=3, dim=12):
    """Labels of very different sizes round common directions, with copies and ties."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((3, dim))
    rows = []
    for n in range(900):
        label = 0 if n % 3 == 0 else int(rng.integers(1, 40))
        v = base[n % 3] + 0.4 * rng.standard_normal(dim)
        rows.append((n * 25, [float(np.float32(x)) for x in v], label))
    rows += [(50_000 + n, rows[0][1], n % 2) for n in range(150)]  # one vector, two labels
    return rows


def test_against_brute_force_in_blocks(spark):
    rows = crowd()
    df = spark.createDataFrame(rows, VEC).repartition(4)
    want = naive(rows)
    assert len(want) > 500
    for block, group in ((16_384, 2_048), (100, 7)):
        assert answer(df, block_rows=block, anchor_rows=group) == want


def test_query(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute(ORACLES["op12_hard_negatives"]).fetchall())
    got = QUERIES["op12_hard_negatives"](spark, sf)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_edges(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (100, [1.0, 0.5], 2), (2, [0.9, 0.4], 2), (3, [0.8, 0.5], None), (None, [1.0, 0.5], 2),
        (4, None, 2), (5, [], 2), (6, [1.0, None], 2), (7, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2), (9, [1.0], 2), (200, [1.0], 1),
        (10, [-1.0], 1), (11, [0.0, 0.0], 3), (300, [0.0, 0.0], 3), (12, [0.0, 0.0], 4), (400, [-1.0, -1.0], 5), (13, [1.0, 1.0], 5),
    ]
    assert answer(spark.createDataFrame(rows, VEC)) == naive(rows)
    far = [(0, [1e30, 1.0], 1), (1, [1e30, -1e30], 1), (2, [1e30, 2.0], 2), (100, [3.5, 1e20], 2), (3, [0.1, 1e19], 2)]
    assert answer(spark.createDataFrame(far, "vec_id long, embedding array<double>, label int")) == naive(far)
    assert answer(spark.createDataFrame([], VEC)) == []


def test_clashing_names(spark):
    rows = crowd()[:300]
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], VEC + ", no int, team string, unit double")
    assert answer(df) == naive(rows)


def test_scan_drops_most_rows_early_and_loses_none():
    rng = np.random.default_rng(0)
    v = np.floor(256 * rng.standard_normal((4_000, 32)) * (0.7 ** np.arange(32)))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            read.append(len(at) if isinstance(at, np.ndarray) else 0)
            return np.asarray(self).__getitem__(at)

    block = H.Columns(np.arange(4_000), np.arange(4_000), np.zeros(4_000, int), v)
    block.columns = np.asarray(block.columns)
    anchor = v[7]
    columns, block.columns = block.columns, [c.view(Counted) for c in block.columns]
    block.columns = type("C", (list,), {"dtype": columns.dtype})(block.columns)
    scores = v @ anchor
    for window in ((-np.inf, np.inf, -np.inf), (int(scores.max() * 0.5), int(scores.max() * 0.8), -np.inf)):
        read.clear()
        ((_, at, found),) = H.scan(block, anchor, np.ones(4_000, bool), [window], 5)
        inside = np.sort(scores[(scores >= window[0]) & (scores <= window[1])])[::-1][:5]
        assert sorted(found, reverse=True)[:5] == inside.tolist() and (scores[at] == found).all()
        assert sum(read) < 0.6 * v.size
