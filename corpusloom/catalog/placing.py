"""Places of rows in an ordered result, so that a comparison of sets also compares the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized


def placed(ordered: DataFrame) -> DataFrame:
    """Adds the place in the order the rows come in: their number within sorted partitions plus those before."""
    marked = materialized(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = marked.groupBy(part.alias("_p")).agg(F.count("*").alias("_c"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s"))
    low = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn("_p", part).join(starts, "_p").withColumn("place", F.col("_s") + low + 1).drop("_p", "_s", "_at")
