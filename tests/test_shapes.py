"""Sparse keys, far values, dominant groups, many labels, late and repeated rows."""

import json
import random

import pandas as pd
from pyspark.sql import functions as F

from corpusloom.operators import ranking as K
from corpusloom.operators import vectors as V
from corpusloom.plans import sampling as S
from corpusloom.plans import topics as O
from corpusloom.sources import files, pools
from corpusloom.sources.storage import new_folder
from corpusloom.sources.versions import VersionedTable
from corpusloom.streaming import incremental as I


def test_running_index_on_hash_ids_and_a_dominant_group(spark):
    rng = random.Random(1)
    rows = [("a" if i % 10 else "b", rng.getrandbits(62)) for i in range(2000)] + [("a", 2**62)]
    df = spark.createDataFrame(rows, "g string, k long")
    want = {}
    for g in "ab":
        want |= {(g, k): i + 1 for i, k in enumerate(sorted(k for h, k in rows if h == g))}
    assert {(r.g, r.k): r.idx for r in K.running_index(df, ["g"], "k", ranges=16).collect()} == want


def test_ranges_hold_about_equally_many_rows(spark):
    df = spark.createDataFrame([(i * i * i,) for i in range(1000)] + [(10**15,)], "k long")
    sizes = [r["count"] for r in df.groupBy(K.range_of(df, "k", 10)).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    assert K.range_of(df.limit(0), "k", 10) is not None


def test_quantiles_with_an_outlier(spark):
    values = [float(i) for i in range(500)] + [1e12]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = K.floor_quantiles(df, ["g"], "v", {"p50": 0.5, "p100": 1.0}, buckets=32).first()
    assert (got.p50, got.p100) == (values[250], 1e12)


def test_quantiles_of_a_dominant_narrow_group(spark, monkeypatch):
    """Nine rows of ten lie between the values of the other group; repeated counting leaves few of them to rank."""
    rows = [("hot", 500.0 + i / 1e6) for i in range(9000)] + [("wide", float(i)) for i in range(1000)] + [("none", None), ("none", 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    ranked, write = [], K.materialized

    def seen(part, label):
        stored = write(part, label)
        if label == "levels" and "_low" in part.columns:
            ranked.append(max(r["count"] for r in stored.groupBy("g", "_low").count().collect()))
        return stored

    monkeypatch.setattr(K, "materialized", seen)
    got = {r.g: (r.p10, r.p50) for r in K.floor_quantiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5}, buckets=16, most=20).collect()}
    assert got == {"hot": (500.0 + 900 / 1e6, 500.0 + 4500 / 1e6), "wide": (100.0, 500.0), "none": (None, 1.0), None: (4.0, 4.0)}
    assert ranked and ranked[0] <= 2 * 9000 / 16 and all(b < a for a, b in zip(ranked, ranked[1:], strict=False))


def test_upper_median_of_repeats_and_a_dominant_group(spark):
    rows = [("hot", i % 7) for i in range(900)] + [("small", 3)]
    got = {r.g: r.m for r in K.upper_median(spark.createDataFrame(rows, "g string, v long"), ["g"], "v", "m").collect()}
    assert got == {"hot": sorted(i % 7 for i in range(900))[450], "small": 3}


def test_numbering_follows_the_data_with_equal_coarse_values(spark, monkeypatch):
    """One value of ``uses`` and a group with most rows: partitions stay even, numbers are those of the order."""
    rows = [("hot", 0, i * i) for i in range(4000)] + [("cold", 0, i) for i in range(200)] + [(None, 0, 5), (None, 0, 3)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, uses long, k long").repartition(5)
    parts, write = [], K.materialized

    def seen(part, label):
        stored = write(part, label)
        parts.extend(r["count"] for r in stored.groupBy(F.shiftright("_at", 33)).count().collect())
        return stored

    monkeypatch.setattr(K, "materialized", seen)
    got = {(r.g, r.k): r.idx for r in K.running_index(df, ["g"], "k", ranges=8, coarse=("uses",)).collect()}
    want = {(g, k): i + 1 for g in ("hot", "cold", None) for i, k in enumerate(sorted(k for h, _, k in rows if h == g))}
    assert got == want and max(parts) <= 2 * len(rows) / 8


def test_batches_are_bundled_and_read_with_outside_files(spark, tmp_path):
    rows = [(i, "web" if i % 3 else "app", f" text {i} ") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, platform string, query_text string")
    packed = files.pack_batches(df, ["platform"], "id", 7)
    path = f"{tmp_path}/r1"
    files.write_batches(packed, ["platform"], ["id", "query_text"], path)
    stored = [p for p in (tmp_path / "r1").rglob("part-*.json")]
    lines = [json.loads(line) for p in stored for line in p.read_text().splitlines()]
    assert len(lines) == 48 + 24 and len(stored) <= 2 * 4 and all(len(x["rows"]) <= 7 for x in lines)
    (tmp_path / "r2").mkdir()
    (tmp_path / "r2" / "web_b01_out.json").write_text(json.dumps([{"id": 4, "query_text": "first"}, {"id": 4, "query_text": "later"}], indent=1))
    (tmp_path / "r2" / "broken.json").write_text("[{broken")
    got = {r.id: r.query_text for r in files.read_batch_outputs(spark, str(tmp_path), "id long, query_text string").collect()}
    assert got == {i: f"text {i}" for i in range(500)} | {4: "later"}


def test_label_structure_with_many_labels(spark):
    rng = random.Random(2)
    rows = [(i, i % 400, [rng.gauss(0, 1) for _ in range(6)]) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, label long, v array<double>")
    one = {r.id: (round(r.own_sim, 9), round(r.other_sim, 9), r.other_label) for r in V.label_structure(df, "id", "label", "v", per_block=1000).collect()}
    many = {r.id: (round(r.own_sim, 9), round(r.other_sim, 9), r.other_label) for r in V.label_structure(df, "id", "label", "v", per_block=16).collect()}
    assert one == many and len(one) == 1200


def test_late_first_rows_are_stored(spark):
    src, root = new_folder(spark, "src"), new_folder(spark, "late")

    def run(rows, name):
        spark.createDataFrame(rows, "id long, ts string").coalesce(1).write.json(f"{src}/{name}")
        stream = spark.readStream.schema("id long, ts timestamp").option("recursiveFileLookup", "true").json(src)
        I.append_finished(stream, "id", "ts", f"{root}/out", f"{root}/cp")
        return sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect())

    assert run([(1, "2024-01-10T00:00:00")], "one") == [1]
    assert run([(2, "2024-01-01T00:00:00"), (3, "2024-01-11T00:00:00"), (1, "2024-01-12T00:00:00")], "two") == [1, 2, 3]


def test_last_row_of_a_load_wins(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string")
    new = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (3, "only", 3)], "id long, v string, n long")
    table = VersionedTable(spark, new_folder(spark, "loads"), ["id"])
    table.create(old, 4)
    table.upsert(new, "n")
    assert sorted((r.id, r.v) for r in table.read().collect()) == [(1, "last"), (2, "old"), (3, "only")]


def test_empty_cells_stay_and_fill(spark):
    nested = spark.createDataFrame([('{"a": {"l2full": "A", "topics": ["x"]}, "b": {"l2full": "B", "topics": []}, "c": {"l2full": "C"}}',)], "j string")
    pool = pools.explode_pool(nested, "j")
    assert sorted((r.l2, r.topic) for r in pool.collect()) == [("a", "x"), ("b", None), ("c", None)]
    assert {r.l2: r.need for r in O.gap_worklist(pool, 2).collect()} == {"a": 1, "b": 2, "c": 2}
    fresh = spark.createDataFrame([("b", "n1", 0), ("b", "N1 ", 1), ("b", "n2", 2), ("b", "n3", 3), ("d", "lost", 0)], "l2 string, topic string, pos long")
    merged = O.merge_topics(pool, fresh, 2)
    assert sorted(((r.l2, r.topic) for r in merged.collect()), key=str) == [("a", "x"), ("b", "n1"), ("b", "n2"), ("c", None)]
    counts = {r.l2: (r.added, r.dropped, r.beyond_cap) for r in O.merge_counts(pool, fresh, merged, 2).collect()}
    assert counts == {"a": (0, 0, 0), "b": (2, 1, 1), "c": (0, 0, 0)}


def test_tiny_weights_keep_their_share(spark):
    combos = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 3e-10), ("g", "c", 3e-10)], "g string, o string, w double")
    placed = S.weighted_draws(combos, "g", "o", "w", spark.range(2000).select(F.col("id").alias("draw")), "s")
    assert placed.count() == 2000


def test_scratch_is_deleted_on_request(spark):
    import os

    from corpusloom.sources import storage

    path = storage.materialized(spark.range(3), "gone").inputFiles()[0]
    folder = os.path.dirname(path.removeprefix("file://"))
    assert os.path.isdir(folder)
    assert storage.clear_scratch(spark) > 0 and not os.path.isdir(folder)


def test_quantiles_hold_if_approximate_cuts_differ_between_evaluations(spark, monkeypatch):
    """``percentile_approx`` depends on the order partial results arrive in; here its cuts differ each time it is evaluated."""

    @F.pandas_udf("array<double>")
    def loose(values: pd.Series) -> list:
        return sorted(random.SystemRandom().sample(sorted(values), min(15, len(values))))

    monkeypatch.setattr(K.F, "percentile_approx", lambda value, shares, accuracy: loose(value))
    rows = [("ab"[i % 2], float((i * 7919) % 4001)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p10, r.p50, r.p100) for r in K.floor_quantiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p100": 1.0}).collect()}
    for g in "ab":
        vs = sorted(v for h, v in rows if h == g)
        assert got[g] == (vs[int(len(vs) * 0.1)], vs[len(vs) // 2], vs[-1])
