"""Shared scratch folders for checkpoints, staged files and streaming state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
SPREAD_KEY = "corpusloom.minInputPartitions"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see; a temporary one only on a local master where none is set."""
    named = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if not named and not local:
        raise RuntimeError(f"set {KEY} to a folder that the driver and all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(KEY, named)
    return named


_WRITTEN: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Delete the folders this process wrote, but for those whose path holds one of ``keep``; returns how many went.

    Call it when the results that read them are stored; ``since`` is a number from ``scratch_mark``.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for name in _WRITTEN[since:]:
        if any(k in name for k in keep):
            continue
        path = jvm.org.apache.hadoop.fs.Path(name)
        gone += bool(path.getFileSystem(conf).delete(path, True))
        _WRITTEN.remove(name)
    return gone


def drop_scratch(written: DataFrame) -> None:
    """Delete the folder of a ``materialized`` result that nothing reads any more: what came of it is written itself."""
    spark = written.sparkSession
    files = {f.rsplit("/", 1)[0] for f in written.inputFiles()}
    for name in [n for n in _WRITTEN if any(f.endswith("/" + n.rsplit("/", 1)[1]) for f in files)]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_mark() -> int:
    """How many folders are written so far."""
    return len(_WRITTEN)


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage and saves recomputation where one result feeds several
    branches; as a table it survives lost executors and allows column pruning.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_small_input(df: DataFrame, key: str) -> DataFrame:
    """Deal input that arrives in few partitions over more of them.

    Text work is CPU bound, and a small file is one scan task.  How many is set by
    ``corpusloom.minInputPartitions``; unset, it is the cores of a local master and
    nothing on a cluster, so that no large table is shuffled for having few splits.
    """
    context = df.sparkSession.sparkContext
    named = df.sparkSession.conf.get(SPREAD_KEY, None)
    least = int(named) if named else context.defaultParallelism if context.master.startswith("local[") else 0
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least, key)
