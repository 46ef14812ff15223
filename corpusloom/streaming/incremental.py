"""Incremental operators on Structured Streaming.

State, checkpoints and outputs live in the shared folder, and every write is
idempotent per batch, so a lost executor or a restarted query repeats work
without changing the result.  What a batch costs depends on its own rows: ids and
counts seen before are in the state store (RocksDB), looked up by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions import text as T
from corpusloom.sources.versions import Folder, VersionedTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _keyed_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: on disk, read by key, not held in memory as a whole."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def append_finished(stream: DataFrame, id_col: str, ts: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append each finished record once, whenever it comes; of several in a batch the earliest by ``ts``.

    The state of an id says that a batch has stored it, so a batch looks up its own
    ids and nothing reads what is stored.  Ids that are new come from Spark's own
    deduplication and meet the rows of the same batch in one grouping.  State has no end: a replay is known
    however late it comes, and a late row that is not stored yet is not lost.  A
    batch overwrites the folder of its own number, and its state is committed after
    it, so a repeated batch changes nothing.  Rows without an id are one id.  Returns the
    finished query, whose progress tells the ids looked up.
    """

    ids = stream.select(F.col(id_col).alias("_id"))
    row = F.struct(*stream.columns)
    coming = stream.select(F.col(id_col).alias("_id"), row.alias("_row"), F.lit(False).alias("_new"))
    first_seen = ids.dropDuplicates(["_id"]).select("_id", F.lit(None).cast(coming.schema["_row"].dataType).alias("_row"), F.lit(True).alias("_new"))
    rows = coming.unionByName(first_seen)
    place = F.struct(F.col(f"_row.{ts}").isNull(), F.unix_micros(F.col(f"_row.{ts}").cast("timestamp")))

    def save(batch: DataFrame, batch_id: int) -> None:
        best = batch.groupBy("_id").agg(F.bool_or("_new").alias("_new"), F.min_by("_row", F.when(~F.col("_new"), place)).alias("_row"))
        best.filter("_new").select("_row.*").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with _keyed_store(stream.sparkSession):
        query = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def track_usage(stream: DataFrame, l2: str, topic: str, out: str, checkpoint: str) -> StreamingQuery:
    """Running use counts per (l2, topic); every batch writes the counts it changed."""
    used = stream.filter(T.or_empty(F.col(topic).cast("string")) != "")
    counts = used.groupBy(F.col(l2).alias("l2"), F.col(topic).alias("topic")).agg(F.count("*").alias("uses"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with _keyed_store(stream.sparkSession):
        query = (
            counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(save).trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


USAGE = "l2 string, topic string, uses long"


def _snapshots(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, ["l2", "topic"])


def _after(spark: SparkSession, out: str, upto: int) -> tuple[DataFrame, list[int]]:
    """(l2, topic, uses, batch) of the batches after ``upto``, and their numbers."""
    numbers = sorted(int(n.removeprefix("batch=")) for n in Folder(spark, out).names() if n.startswith("batch="))
    new = [n for n in numbers if n > upto]
    if not new:
        return spark.createDataFrame([], USAGE + ", batch long"), new
    paths = [f"{out}/batch={n}" for n in new]
    rows = spark.read.option("basePath", out).parquet(*paths)
    return rows.select("l2", "topic", "uses", F.col("batch").cast("long").alias("batch")), new


def current_usage(spark: SparkSession, out: str, snapshots: str | None = None) -> DataFrame:
    """Latest count of each key (counts only grow): the newest snapshot and the batches after it."""
    base = _snapshots(spark, snapshots).manifest() if snapshots else None
    rows, _ = _after(spark, out, base.properties["upto"] if base else -1)
    if base:
        rows = rows.unionByName(usage_at(spark, snapshots, base.version).withColumn("batch", F.lit(-1).cast("long")))
    return rows.groupBy("l2", "topic").agg(F.max_by("uses", "batch").alias("uses"))


def fold_usage(spark: SparkSession, out: str, snapshots: str, buckets: int = 64) -> int:
    """Fold the batches so far into a new version of the table ``snapshots`` and delete them; returns the version.

    Only buckets with a changed count are rewritten.  The version names the last
    batch in it (``upto``) and becomes the newest in one step, so a fold that fails
    between any two steps leaves counts right: batches up to ``upto`` are ignored
    by readers, and deleted by the next fold if this one has not come to it.  A fold
    without new batches makes no version.
    """
    table = _snapshots(spark, snapshots)
    base = table.manifest()
    upto = base.properties["upto"] if base else -1
    rows, new = _after(spark, out, upto)
    if base is None:
        first = rows.groupBy("l2", "topic").agg(F.max_by("uses", "batch").alias("uses"))
        version = table.create(first, buckets, {"upto": max(new, default=-1)})
    elif new:
        version = table.upsert(rows, "batch", {"upto": max(new)})
    else:
        version = base.version
    folded = max(new, default=upto)
    folder = Folder(spark, out)
    for name in folder.names():
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= folded:
            folder.delete(name)
    return version


def usage_at(spark: SparkSession, snapshots: str, version: int | None = None) -> DataFrame:
    """(l2, topic, uses) of a version, the newest by default: a plan that names its version can be made again."""
    return _snapshots(spark, snapshots).read(version).select("l2", "topic", "uses")
