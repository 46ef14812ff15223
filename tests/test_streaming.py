from corpusloom.sources.storage import new_folder
from corpusloom.sources.versions import Folder
from corpusloom.streaming import incremental as I


def test_usage_survives_restart_and_new_files(spark):
    src, root = new_folder(spark, "src"), new_folder(spark, "usage")

    def feed(rows, name):
        spark.createDataFrame(rows, "l2 string, topic string").coalesce(1).write.json(f"{src}/{name}")

    def run():
        stream = spark.readStream.schema("l2 string, topic string").option("recursiveFileLookup", "true").json(src)
        I.track_usage(stream, "l2", "topic", f"{root}/out", f"{root}/cp")
        return {(r["l2"], r["topic"]): r["uses"] for r in I.current_usage(spark, f"{root}/out").collect()}

    feed([("a", "x"), ("a", "x"), ("a", ""), ("b", "y")], "one")
    assert run() == {("a", "x"): 2, ("b", "y"): 1}
    assert run() == {("a", "x"): 2, ("b", "y"): 1}  # nothing new: nothing counted twice
    feed([("a", "x"), ("c", "z")], "two")
    assert run() == {("a", "x"): 3, ("b", "y"): 1, ("c", "z"): 1}


def test_append_once_keeps_late_rows_and_drops_replays_across_restarts(spark):
    src, root = new_folder(spark, "src"), new_folder(spark, "append")
    schema = "id long, ts timestamp, big long, note string"

    def run(rows, name):
        spark.createDataFrame([(i, t, 2**60 + (i or 0), n) for i, t, n in rows], "id long, ts string, big long, note string").repartition(2).write.json(f"{src}/{name}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(src)
        query = I.append_finished(stream, "id", "ts", f"{root}/out", f"{root}/cp")
        stored = spark.read.parquet(f"{root}/out").collect()
        assert all(r["big"] == 2**60 + (r["id"] or 0) for r in stored)
        looked_up = sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"])
        return sorted(((r["id"], r["note"]) for r in stored), key=str), looked_up

    got, n = run([(1, "2024-01-03T00:00:00.000002", "b"), (2, "2024-01-03T00:00:00", "a"), (1, "2024-01-03T00:00:00.000001", "a")], "one")
    assert got == [(1, "a"), (2, "a")] and n == 2
    got, n = run([(2, "2024-01-01T00:00:00", "replay"), (3, "2024-01-01T00:00:00", "late"), (None, None, "none"), (None, None, "none")], "two")
    assert got == [(1, "a"), (2, "a"), (3, "late"), (None, "none")] and n == 2  # what this batch adds, not what is stored
    assert run([(i, "2024-01-05T00:00:00", "new") for i in (1, 2, 3, 4)], "three")[0] == [(1, "a"), (2, "a"), (3, "late"), (4, "new"), (None, "none")]
    assert spark.read.parquet(f"{root}/out").filter("id = 1").first()["ts"].microsecond == 1


def test_a_batch_does_not_read_what_is_stored(spark):
    """The stored rows are gone between two runs, and the ids are still known."""
    src, root = new_folder(spark, "src"), new_folder(spark, "append")

    def run(ids, name, out):
        spark.createDataFrame([(i, "2024-01-01T00:00:00") for i in ids], "id long, ts string").write.json(f"{src}/{name}")
        stream = spark.readStream.schema("id long, ts timestamp").option("recursiveFileLookup", "true").json(src)
        I.append_finished(stream, "id", "ts", f"{root}/{out}", f"{root}/cp")
        return sorted(r["id"] for r in spark.read.parquet(f"{root}/{out}").collect())

    assert run(range(5), "one", "first") == [0, 1, 2, 3, 4]
    assert run(range(3, 8), "two", "second") == [5, 6, 7]


def test_usage_is_folded_into_versions(spark, monkeypatch):
    src, root = new_folder(spark, "src"), new_folder(spark, "fold")
    out, versions = f"{root}/out", f"{root}/versions"

    def run(rows, name):
        spark.createDataFrame(rows, "l2 string, topic string").coalesce(1).write.json(f"{src}/{name}")
        stream = spark.readStream.schema("l2 string, topic string").option("recursiveFileLookup", "true").json(src)
        I.track_usage(stream, "l2", "topic", out, f"{root}/cp")

    def counts(df):
        return {(r["l2"], r["topic"]): r["uses"] for r in df.collect()}

    run([("a", "x"), ("a", "x"), ("b", "y")], "one")
    assert I.fold_usage(spark, out, versions, buckets=4) == 0
    assert not [n for n in Folder(spark, out).names() if n.startswith("batch=")]
    run([("a", "x"), (None, "z")], "two")
    now = {("a", "x"): 3, ("b", "y"): 1, (None, "z"): 1}
    assert counts(I.current_usage(spark, out, versions)) == now
    # a fold that ends after its version is named, before the batches are deleted
    with monkeypatch.context() as m:
        m.setattr(Folder, "delete", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
        try:
            I.fold_usage(spark, out, versions)
        except OSError:
            pass
    assert counts(I.current_usage(spark, out, versions)) == now
    assert I.fold_usage(spark, out, versions) == 1  # nothing new: only what was left over goes
    assert not [n for n in Folder(spark, out).names() if n.startswith("batch=")]
    assert counts(I.usage_at(spark, versions, 0)) == {("a", "x"): 2, ("b", "y"): 1} and counts(I.usage_at(spark, versions)) == now


def test_append_once_calls_no_python_per_id(spark):
    """Ids are looked up by Spark's own deduplication; the earliest of a batch is stored, rows without a time come last."""
    src, root = new_folder(spark, "src"), new_folder(spark, "native")
    rows = [(i, f"2024-01-0{1 + (i + k) % 3}T00:00:00" if k < 3 else None, k) for i in range(400) for k in range(4)]
    spark.createDataFrame(rows, "id long, ts string, k int").repartition(5).write.json(f"{src}/one")
    stream = spark.readStream.schema("id long, ts timestamp, k int").option("recursiveFileLookup", "true").json(src)
    query = I.append_finished(stream, "id", "ts", f"{root}/out", f"{root}/cp")
    assert [o["operatorName"] for o in query.recentProgress[0]["stateOperators"]] == ["dedupe"]
    stored = spark.read.parquet(f"{root}/out").collect()
    assert len(stored) == 400 and all(r.ts.day == 1 and r.k == -r.id % 3 for r in stored)
