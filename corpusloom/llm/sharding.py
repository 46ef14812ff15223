"""Two-pass external shuffle into shards of equal row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources.storage import materialized


def measured_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: strings and binaries as long as they are, nested columns as JSON, 8 for any other."""
    total = F.lit(16).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total += F.lit(8)
            continue
        total += F.coalesce(F.octet_length(column), F.lit(0))
    return total


def scatter(df: DataFrame, seed: int = 11, bucket_bytes: int = 64 << 20, row_bytes: Column | None = None) -> tuple[DataFrame, int, int]:
    """Pass 1: rows ``at``, ``row``, ``w`` (bytes) and ``bucket``; with them the number of buckets and of rows.

    A bucket is a seeded hash of the row's place in the input.  The bytes of all
    rows are measured and buckets aim at half of ``bucket_bytes``: while rows are
    small against a bucket, its sum of independent rows does not come near twice
    its mean.  Only rows of the order of ``bucket_bytes`` itself can go beyond.
    """
    spark = df.sparkSession
    weight = measured_bytes(df) if row_bytes is None else row_bytes
    rows = df.select(F.struct(*df.columns).alias("row"), weight.cast("long").alias("w"), F.monotonically_increasing_id().alias("at"))
    first = materialized(rows, "scatter")
    total = first.agg(F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")).first()
    buckets = max(-(-2 * int(total.w) // bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return first.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "at"), F.lit(buckets)).cast("int")), buckets, int(total.n)


def external_shuffle(
    df: DataFrame, shards: int, seed: int = 11, bucket_bytes: int = 64 << 20, row_bytes: Column | None = None
) -> DataFrame:
    """Shuffle all rows uniformly, whole, and cut the permutation into ``shards`` shards.

    Pass 1 scatters rows into buckets by a seeded hash of the row's place in the
    input, not of its content, so no value, copy or null can fill a bucket; the
    places are fixed by writing the rows to the shared folder.  Pass 2 moves every
    bucket into a task of its own and shuffles it in memory (Spark's ``shuffle`` is
    a Fisher-Yates shuffle) from a sorted start with the seed, so a repeated task
    gives the same order.  ``row_bytes`` measures a row (``measured_bytes`` if
    none is given); a bucket stays within ``bucket_bytes``, see ``scatter``.

    Buckets laid end to end are one random permutation.  Shard s is its s-th equal
    slice: row counts differ by one at most.  Adds ``shard`` (int) and ``slot``
    (long, gapless from 0).  Every row is kept, repeated ones included; values are
    never compared, so nulls, long texts and ties are ordinary; an empty table
    gives an empty result; columns named ``shard`` or ``slot`` are replaced.
    Columns must be orderable (no maps).
    """
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")])
    scattered, buckets, n_rows = scatter(kept, seed, bucket_bytes, row_bytes)
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("c"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    rows = scattered.select("bucket", F.struct("at", "row").alias("item"), F.lit(None).cast("long").alias("offset"))
    # a bucket's offset travels with its rows, so that its array is joined with nothing
    offsets = counts.select(
        "bucket", F.lit(None).cast(rows.schema["item"].dataType).alias("item"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset")
    )
    dealt = rows.unionByName(offsets).repartitionById(buckets, F.col("bucket"))
    grouped = dealt.groupBy("bucket").agg(F.max("offset").alias("offset"), F.sort_array(F.collect_list("item")).alias("items"))
    placed = grouped.select("offset", F.posexplode(F.shuffle("items", seed)).alias("i", "item"))
    n, s = F.lit(max(n_rows, 1)), F.lit(shards).cast("long")
    position = F.col("offset") + F.col("i")
    shard = F.call_function("div", position * s, n)
    start = F.call_function("div", F.col("shard").cast("long") * n + s - 1, s)
    return (
        placed.withColumn("shard", shard.cast("int"))
        .select("item.row.*", "shard", (position - start).cast("long").alias("slot"))
    )


def write_shards(shuffled: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Write one folder per shard, rows in slot order within and across its files."""
    shards = shuffled.select("shard").distinct().count()
    (
        shuffled.repartitionByRange(max(shards * files_per_shard, 1), "shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
