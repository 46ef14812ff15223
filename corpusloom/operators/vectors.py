"""Embedding vectors: normalise, pool, project, rescale, label structure."""

from __future__ import annotations

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(vec: Column) -> Column:
    v = F.transform(vec, lambda x: x.cast("double"))
    norm = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-12))
    return F.transform(v, lambda x: x / norm)


def mean_pool(df: DataFrame, key: str, vec: str, mask: Column | None = None) -> DataFrame:
    """Mean vector per key over rows where ``mask`` holds.

    Works on (key, position, value) rows, so partial sums combine before the
    shuffle whatever the size of a key.
    """
    rows = df if mask is None else df.filter(mask)
    cells = rows.select(F.col(key).alias("k"), F.posexplode(vec).alias("pos", "val"))
    means = cells.groupBy("k", "pos").agg(F.avg(F.col("val").cast("double")).alias("m"), F.count("*").alias("n"))
    packed = means.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("cells"), F.max("n").alias("rows"))
    return packed.select(F.col("k").alias(key), F.transform("cells", lambda c: c["m"]).alias("mean"), "rows")


def project(df: DataFrame, id_col: str, vec: str, k: int) -> DataFrame:
    """(id, pcs): coordinates on the first k principal components of centred vectors."""
    rows = df.select(id_col, array_to_vector(F.transform(vec, lambda x: x.cast("double"))).alias("raw"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="cen").fit(rows).transform(rows)
    model = PCA(k=k, inputCol="cen", outputCol="pc").fit(centred)
    return model.transform(centred).select(id_col, vector_to_array("pc").alias("pcs"))


def min_max_rescale(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Rescale columns to [-1, 1]; a constant column becomes -1."""
    out = df
    for c in columns:
        # scalar sub-queries: the bounds reach the projection as literals
        lo, hi = df.select(F.min(c)).scalar(), df.select(F.max(c)).scalar()
        width = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
        out = out.withColumn(c, T.round_to(2 * (F.col(c) - lo) / width - 1, digits))
    return out


def label_structure(df: DataFrame, id_col: str, label: str, vec: str, per_block: int = 256) -> DataFrame:
    """Cosine of each vector to its own and to the nearest other label centroid.

    Centroids are packed into array rows of about ``per_block`` and met by an equi
    join on the block number, so no row grows with the number of labels; Spark
    broadcasts them when they are small and shuffles them when there are many.
    """
    unit = df.select(id_col, label, l2_normalize(F.col(vec)).alias("u"))
    cents = mean_pool(unit, label, "u").select(F.col(label).alias("l"), l2_normalize(F.col("mean")).alias("c"))
    centroid_blocks = max(-(-df.select(label).distinct().count() // per_block), 1)
    packed = cents.groupBy(F.pmod(F.xxhash64("l"), F.lit(centroid_blocks)).alias("blk")).agg(
        F.collect_list(F.struct("l", "c")).alias("cents")
    )
    spread = unit.withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(centroid_blocks - 1).cast("long"))))
    sims = spread.join(packed, "blk").select(
        id_col, label, F.transform("cents", lambda s: F.struct(dot(F.col("u"), s["c"]).alias("sim"), s["l"].alias("l"))).alias("sims")
    )
    own = F.array_max(F.transform(F.filter("sims", lambda s: s["l"] == F.col(label)), lambda s: s["sim"]))
    other = F.array_max(F.filter("sims", lambda s: s["l"] != F.col(label)))
    sims = sims.select(id_col, label, own.alias("own"), other.alias("other"))
    best = sims.groupBy(id_col, label).agg(F.max("own").alias("own"), F.max("other").alias("other"))
    return best.select(
        id_col, label, F.col("own").alias("own_sim"), F.col("other.sim").alias("other_sim"), F.col("other.l").alias("other_label")
    )


def label_purity(df: DataFrame, id_col: str, label: str, vec: str) -> DataFrame:
    rows = label_structure(df, id_col, label, vec)
    return rows.groupBy(label).agg(
        F.count("*").alias("rows"),
        T.round_to(F.avg("own_sim"), 5).alias("mean_own"),
        T.round_to(F.avg("other_sim"), 5).alias("mean_other"),
        T.ratio(F.count_if(F.col("own_sim") > F.col("other_sim")), F.count("*")).alias("share_own_nearest"),
    )
