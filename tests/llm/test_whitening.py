import math

import numpy as np
import pytest

from corpusloom.llm import whitening as W
from corpusloom.llm.queries import QUERIES

VEC = "vec_id long, embedding array<float>, label int"


def reference(vectors, count=32):
    """Sums in whole numbers, eigenvectors by another method."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    z = d.astype(float) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    return n, (d * d).sum(axis=1), z @ vectors / np.sqrt(values), values / np.trace(z.T @ z / n)


def test_query(spark, sf):
    rows = QUERIES["op13_whitening"](spark, sf).collect()
    data = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    n, deviation, whitened, explained = reference([r.embedding for r in data])
    place = {r.vec_id: k for k, r in enumerate(data)}
    assert len(rows) == 32 * n and {r.component for r in rows} == set(range(1, 33))
    got = np.zeros((n, 32))
    for r in rows:
        k = place[r.vec_id]
        assert r.n == n and r.deviation == deviation[k]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        got[k, r.component - 1] = r.whitened
    signs = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * signs - whitened).max() < 1e-8


def matrices():
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 7, 64):
        a = rng.standard_normal((d, 2 * d))
        yield a @ a.T
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    yield np.eye(40) * 3
    yield np.diag(np.arange(20.0))
    yield q @ np.diag([5.0] * 10 + [4 + 1e-9 * i for i in range(10)] + [1.0] * 20) @ q.T  # clusters
    yield q @ np.diag(10.0 ** -np.arange(40)) @ q.T
    yield np.ones((30, 30))
    yield np.diag(np.abs(np.arange(-10.0, 11))) + np.diag([1.0] * 20, 1) + np.diag([1.0] * 20, -1)  # pairs that agree to many digits


def test_components_of_small_matrices():
    for m in matrices():
        k = min(32, len(m))
        values, vectors = W.leading_components(m, k)
        norm = np.abs(m).sum(axis=1).max()
        assert np.abs(values - np.linalg.eigvalsh(m)[::-1][:k]).max() < 1e-13 * norm
        assert np.abs(m @ vectors.T - vectors.T * values).max() < 1e-13 * norm
        assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-14


def test_sturm_counts():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal(30), rng.standard_normal(29)
    b[12] = 0.0  # two matrices side by side
    full = np.diag(a) + np.diag(b, 1) + np.diag(b, -1)
    values = np.linalg.eigvalsh(full)
    at = rng.uniform(-3, 3, 200)
    assert W.count_below(a, b, at).tolist() == [(values < x).sum() for x in at]
    q, r, v = W.tridiagonal(np.cov(rng.standard_normal((9, 50))))
    assert len(q) == 9 and len(r) == 8 and np.allclose((v * v).sum(axis=1), 1)


def test_exact_deviations_and_overflow():
    x = np.array([[1_000_000, 1_000_003], [1_000_001, 1_000_000], [1_000_007, 999_999]])
    c = W.Centre.of(3, [int(v) for v in x.sum(axis=0)])
    assert c.deviations(x) == [int(v) for v in ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1)]
    far = W.Centre(10**9, np.array([0]), np.array([5]))
    assert far.deviations(np.array([[3], [4]])) == [(3 * 10**9 - 5) ** 2, None]


def one(df, **options):
    return [r.asDict() for r in W.whiten(df, **options).collect()]


def test_edges(spark):
    rng = np.random.default_rng(4)
    rows = [(i if i % 7 else None, [float(np.float32(x)) for x in rng.standard_normal(6)], i % 3) for i in range(60)]
    rows += rows[:5]  # repeats count
    bad = [(90, None, 1), (91, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (92, [float("nan")] * 6, 1), (93, [float("inf")] * 6, 1)]
    other = [(80, [1.0, 2.0], 0), (81, [1.0, 2.0], 0), (82, [], 0), (83, [0.5, 0.25, 0.125], 0)]
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows + bad + other], VEC + ", whitened double, n string").repartition(3)
    got = one(df, count=4)
    assert len(got) == len(rows) + len(other)
    n, deviation, whitened, explained = reference([r[1] for r in rows], 4)
    six = [g for g in got if len(g["row"]["embedding"]) == 6]
    assert all(g["n"] == 65 and len(g["whitened"]) == 4 and g["identity_error"] < 1e-9 and g["row"]["n"] == "x" for g in six)
    assert sorted(g["deviation"] for g in six) == sorted(deviation.tolist())
    assert np.allclose(sorted(abs(g["whitened"][0]) for g in six), sorted(np.abs(whitened[:, 0])))
    assert all(np.allclose(g["explained"], explained) for g in six)
    rest = {g["row"]["vec_id"]: g for g in got if g["row"]["vec_id"] in (80, 81, 82, 83)}
    assert all(g["whitened"] == [] and g["identity_error"] is None and g["deviation"] == 0 for g in rest.values())
    assert [rest[i]["n"] for i in (80, 81, 82, 83)] == [2, 2, None, 1]
    assert W.long_form(W.whiten(df, count=4)).count() == 4 * len(rows)
    assert one(spark.createDataFrame([], VEC)) == []


def test_directions_that_rows_do_not_span_and_huge_entries(spark):
    rng = np.random.default_rng(5)
    flat = rng.integers(-500, 500, (80, 2))
    rows = [(i, [a / 64, b / 64, (a + b) / 64, 0.0], 0) for i, (a, b) in enumerate(flat.tolist())]
    got = one(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert all(len(g["whitened"]) == 2 and g["identity_error"] < 1e-9 for g in got)
    assert sum(got[0]["explained"]) == pytest.approx(1)
    huge = [(i, [float(x), 1e300 * (-1) ** i], 0) for i, x in enumerate(rng.standard_normal(20))]
    got = one(spark.createDataFrame(huge, "vec_id long, embedding array<double>, label int"))
    assert len(got) == 20 and all(g["deviation"] is None for g in got)
