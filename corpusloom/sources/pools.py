"""Topic pools stored as nested JSON, and natural-language samples of foreign data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.plans.tasks import pad

POOL_SCHEMA = "map<string, struct<l2full string, topics array<string>>>"


def explode_pool(df: DataFrame, json_col: str) -> DataFrame:
    """``{l2: {l2full, topics[]}}`` -> (l2, l2full, topic, pos).

    A cell without topics is one row whose topic is null; the operators on pools
    count it as a cell of size 0.
    """
    cells = df.select(F.explode(F.from_json(json_col, POOL_SCHEMA)).alias("l2", "cell"))
    return cells.select("l2", "cell.l2full", F.posexplode_outer("cell.topics").alias("pos", "topic")).select(
        "l2", "l2full", "topic", F.col("pos").cast("long").alias("pos")
    )


def first_turn(turns: DataFrame, conv: str, turn: str, role: str, text: str, human: str = "user") -> DataFrame:
    """First human turn of each conversation, else its first turn."""
    rows = turns.withColumn("_t", F.when(T.or_empty(F.col(text)) != "", F.col(text)))
    return rows.groupBy(conv).agg(
        F.coalesce(
            F.min_by("_t", F.when(F.col(role) == human, F.col(turn))), F.min_by("_t", turn)
        ).alias("text")
    )


def as_samples(rows: DataFrame, slug: str, number: str, text: Column) -> DataFrame:
    """(id, source, text) with a padded stable id; blank texts dropped."""
    body = T.trim_ws(text)
    return rows.filter(body != "").select(
        F.concat(F.lit(slug + "_"), pad(F.col(number), 4)).alias("id"), F.lit(slug).alias("source"), body.alias("text")
    )
