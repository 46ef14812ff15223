import pytest
from pyspark.sql import functions as F

from corpusloom.sources import files
from corpusloom.sources.storage import new_folder
from corpusloom.sources.versions import Folder, VersionConflict, VersionedTable

ROW = "id long, name string, size int"


def table(spark, rows, buckets=8):
    t = VersionedTable(spark, new_folder(spark, "table"), ["id"])
    t.create(spark.createDataFrame(rows, ROW), buckets)
    return t


def content(t, version=None):
    return sorted((tuple(r) for r in t.read(version).collect()), key=str)


def test_only_touched_buckets_are_rewritten(spark):
    rows = [(i, f"n{i}", i % 5) for i in range(200)]
    t = table(spark, rows)
    before = t.manifest()
    fresh = spark.createDataFrame([(7, "x", 1, 1), (7, "y", 2, 3), (7, "z", 3, 2), (999, "new", 0, 0)], ROW + ", n long")
    assert t.upsert(fresh, "n") == 1
    after = t.manifest()
    touched = {str(r[0]) for r in fresh.select(t.bucket(8)).distinct().collect()}
    assert {b for b in after.folders if after.folders[b] != before.folders.get(b)} == touched and len(touched) < 8
    want = {i: (i, n, s) for i, n, s in rows} | {7: (7, "y", 2), 999: (999, "new", 0)}
    assert content(t) == sorted(want.values(), key=str)
    assert content(t, 0) == sorted(rows, key=str)  # the version before is still there


def test_a_load_that_fails_leaves_the_old_version(spark, monkeypatch):
    t = table(spark, [(1, "a", 1), (2, "b", 2)])
    broken = spark.createDataFrame([(1, "x", 1, 1), (3, "y", 1, 1)], ROW + ", n long").withColumn("size", F.when(F.col("id") == 3, F.raise_error("lost").cast("int")).otherwise(1))
    with pytest.raises(Exception):  # noqa: B017
        t.upsert(broken, "n")
    assert t.versions() == [0] and content(t) == [(1, "a", 1), (2, "b", 2)]
    with monkeypatch.context() as m:  # files are written, the manifest is not
        m.setattr(Folder, "put_new", lambda self, name, text: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.upsert(spark.createDataFrame([(1, "x", 9, 1)], ROW + ", n long"), "n")
    assert t.versions() == [0] and content(t) == [(1, "a", 1), (2, "b", 2)]
    t.clean()
    assert content(t) == [(1, "a", 1), (2, "b", 2)]
    assert len([n for n in Folder(spark, t.root).names() if n.startswith("data-")]) == 1


def test_two_changes_from_one_version_conflict(spark):
    t = table(spark, [(1, "a", 1)])
    base = t.manifest()
    t.upsert(spark.createDataFrame([(1, "b", 1, 1)], ROW + ", n long"), "n")
    with pytest.raises(VersionConflict):
        t._commit(base, base.buckets, t.read().schema, {}, {})
    with pytest.raises(VersionConflict):
        t.create(spark.createDataFrame([], ROW))
    assert content(t) == [(1, "b", 1)]


def test_null_keys_other_columns_empty_loads_and_cleaning(spark):
    t = table(spark, [(None, "a", 1), (2, "b", 2)])
    t.upsert(spark.createDataFrame([(None, "c", "extra", 1), (4, "d", "extra", 1)], "id long, name string, more string, n long"), "n")
    assert content(t) == sorted([(None, "c", None), (2, "b", 2), (4, "d", None)], key=str)
    t.upsert(spark.createDataFrame([], ROW + ", n long"), "n", {"note": 5})
    assert t.versions() == [0, 1, 2] and t.manifest().properties == {"note": 5}
    t.clean(keep=1)
    assert t.versions() == [2] and content(t) == sorted([(None, "c", None), (2, "b", 2), (4, "d", None)], key=str)
    empty = table(spark, [])
    assert content(empty) == [] and empty.upsert(spark.createDataFrame([(1, "a", 1, 1)], ROW + ", n long"), "n") == 1
    assert content(empty) == [(1, "a", 1)]
    with pytest.raises(ValueError):
        t.read(0)


def test_a_repeated_load_gives_the_same_tables(spark):
    root = new_folder(spark, "warehouse")
    queries = spark.createDataFrame([("q1", "t1", "2024-01-01", 1), ("q1", "t2", "2024-01-01", 2), ("q2", "t3", "2024-01-01", 3)], "id string, text string, created_at string, n long")
    scenes = spark.createDataFrame([("s1", "label", 1)], "id string, label string, n long")
    log = "id string, mode string, total_planned long, total_generated long, created_at string"
    files.create_tables(spark, root, {"queries": queries.drop("n").limit(0), "imported_requirements": scenes.drop("n").limit(0), "generation_runs": spark.createDataFrame([], log)}, 4)
    for _ in range(2):
        files.load_tables(spark, root, scenes, queries, "seed", F.col("created_at"), "n")
        assert sorted(tuple(r) for r in files.stored_table(spark, root, "queries").read().collect()) == [("q1", "t2", "2024-01-01"), ("q2", "t3", "2024-01-01")]
        assert files.stored_table(spark, root, "generation_runs").read().count() == 1
