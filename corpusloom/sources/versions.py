"""Tables in versions: bucketed folders of Parquet and a log of manifests.

A manifest names the folder of every bucket.  A change writes the folders of the
buckets it touches and then a new manifest; until that file has its name, readers
see the version before, so a change that fails leaves no trace but unused folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"


class Folder:
    """Small files and folders on whatever file system a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self.path = self.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path)) if self.fs.exists(self.path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Give a file its name in one step, unless the name is taken."""
        hidden = self.at(f".{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.exists(self.at(name)) and self.fs.rename(hidden, self.at(name)):
            return True
        self.fs.delete(hidden, False)
        return False

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


class VersionConflict(RuntimeError):
    """Somebody else has committed a version since this change began."""


@dataclass(frozen=True)
class Manifest:
    version: int
    buckets: int
    schema: str
    folders: dict[str, str]
    properties: dict = field(default_factory=dict)


class VersionedTable:
    """A keyed table below ``root``; rows lie in buckets by a hash of the key columns."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys
        self.log = Folder(spark, f"{self.root}/_versions")

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.log.names() if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version's manifest, the newest by default; None for a table that has none."""
        known = self.versions()
        if version is not None and version not in known:
            raise ValueError(f"no version {version} of {self.root}")
        return Manifest(**json.loads(self.log.read(f"{known[-1] if version is None else version:012d}.json"))) if known else None

    def read(self, version: int | None = None, of: list[int] | None = None) -> DataFrame:
        """The rows of a version, of all buckets or those in ``of``."""
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"no version of {self.root}")
        schema = StructType.fromJson(json.loads(manifest.schema))
        wanted = [f"{self.root}/{p}" for b, p in manifest.folders.items() if of is None or int(b) in of]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    def _commit(self, base: Manifest | None, buckets: int, schema: StructType, folders: dict[str, str], properties: dict) -> int:
        version = base.version + 1 if base else 0
        text = json.dumps({"version": version, "buckets": buckets, "schema": json.dumps(schema.jsonValue()), "folders": folders, "properties": properties})
        if not self.log.put_new(f"{version:012d}.json", text):
            raise VersionConflict(f"version {version} of {self.root} is taken")
        return version

    def _write(self, rows: DataFrame, buckets: int) -> dict[str, str]:
        """Write rows (with ``BUCKET``), a file or a few per bucket; the folder of each bucket that has rows."""
        name = f"data-{uuid.uuid4().hex}"
        dealt = rows.repartition(BUCKET, F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(max(64 // buckets, 1))))
        dealt.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        found = [n for n in Folder(self.spark, f"{self.root}/{name}").names() if n.startswith(f"{BUCKET}=")]
        return {n.removeprefix(f"{BUCKET}="): f"{name}/{n}" for n in found}

    def create(self, rows: DataFrame, buckets: int = 64, properties: dict | None = None) -> int:
        """Version 0 of a table that does not exist: ``rows`` as they are."""
        if self.versions():
            raise VersionConflict(f"{self.root} exists")
        folders = self._write(rows.withColumn(BUCKET, self.bucket(buckets)), buckets)
        return self._commit(None, buckets, rows.schema, folders, properties or {})

    def upsert(self, incoming: DataFrame, order: str, properties: dict | None = None) -> int:
        """Insert or replace by key; of several incoming rows with one key the last by ``order``, which is not stored.

        Only buckets with an incoming row are read and written; the others keep
        their files.  Columns that the table does not have are left out, absent ones
        become null.  Rows whose key holds a null are one key.
        """
        base = self.manifest()
        if base is None:
            raise ValueError(f"no version of {self.root}")
        schema = StructType.fromJson(json.loads(base.schema))
        last = incoming.withColumn(BUCKET, self.bucket(base.buckets)).groupBy(BUCKET, *self.keys).agg(F.max_by(F.struct(*[c for c in incoming.columns if c not in self.keys]), order).alias("_r"))
        fresh = last.select(BUCKET, *[self._of(incoming, f).cast(f.dataType).alias(f.name) for f in schema])
        touched = sorted(r[0] for r in incoming.select(self.bucket(base.buckets).alias("b")).distinct().collect())  # at most the table's buckets
        stored = self.read(base.version, touched).withColumn(BUCKET, self.bucket(base.buckets))
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"i.{k}")) for k in (BUCKET, *self.keys)]
        matched = same[0]
        for c in same[1:]:
            matched = matched & c
        kept = stored.alias("s").join(fresh.select(BUCKET, *self.keys).alias("i"), matched, "left_anti")
        folders = self._write(kept.unionByName(fresh), base.buckets) if touched else {}
        return self._commit(base, base.buckets, schema, base.folders | folders, base.properties | (properties or {}))

    def _of(self, incoming: DataFrame, f) -> Column:
        return F.col(f.name) if f.name in self.keys else F.col("_r")[f.name] if f.name in incoming.columns else F.lit(None)

    def clean(self, keep: int = 1) -> None:
        """Forget all but the newest ``keep`` versions and delete the folders that none of the others names.

        Run it when no change is under way: what such a change has written has no version yet.
        """
        known = self.versions()
        kept = known[-keep:]
        named = {p for v in kept for p in self.manifest(v).folders.values()}
        for v in known[: len(known) - len(kept)]:
            self.log.delete(f"{v:012d}.json")
        top = Folder(self.spark, self.root)
        for name in top.names():
            if name.startswith("data-"):
                inside = Folder(self.spark, f"{self.root}/{name}")
                for part in inside.names():
                    if part.startswith(f"{BUCKET}=") and f"{name}/{part}" not in named:
                        inside.delete(part)
                if not any(p.startswith(f"{name}/") for p in named):
                    top.delete(name)
