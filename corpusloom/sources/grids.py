"""Spreadsheet-like grids: (row_id, cells array) -> taxonomy rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import render as R
from corpusloom.functions import text as T
from corpusloom.operators.ranking import forward_fill
from corpusloom.plans.tasks import pad

# fixed values: header and total markers of requirement sheets
L1_HEADER, L2_HEADER, COUNT_HEADER = "一级场景", "二级场景", "预计"
SUBTOTAL, GRAND_TOTAL = "合计", "总计"


def parse_number(c: Column) -> Column:
    """'1,234' -> 1234.0; anything unreadable is null."""
    return F.trim(F.replace(c, F.lit(","), F.lit(""))).try_cast("double")


def fill_merged(grid: DataFrame, merges: DataFrame) -> DataFrame:
    """Copy the top-left value of merged ranges into their blank cells.

    ``grid``: (row_id, cells); ``merges``: (r0, c0, r1, c1), inclusive, 0-based columns.
    """
    covered = merges.select("*", F.explode(F.sequence("r0", "r1")).alias("row_id")).select(
        "row_id", "r0", "c0", F.explode(F.sequence("c0", "c1")).alias("col")
    )
    corner = grid.select(F.col("row_id").alias("r0"), F.col("cells").alias("_top"))
    values = covered.join(corner, "r0").select("row_id", "col", F.get("_top", "c0").alias("v"))
    patch = values.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("col", "v"))).alias("_patch"))
    fixed = F.transform(
        "cells", lambda x, i: F.when(T.clean_text(x) == "", F.coalesce(F.try_element_at("_patch", i), x)).otherwise(x)
    )
    return grid.join(patch, "row_id", "left").select("row_id", fixed.alias("cells"))


def _column_of(header: Column, marker: str) -> Column:
    """0-based position of the first header cell that contains ``marker``."""
    hits = F.transform(header, lambda h: F.contains(T.normalize_key(h), F.lit(marker)))
    return (F.array_position(hits, True) - 1).cast("int")


def taxonomy_from_grid(grid: DataFrame) -> DataFrame:
    """Detect the header, fill L1 downwards, drop header and total rows, parse numbers, split labels."""
    has = lambda m: F.exists("cells", lambda x: F.contains(T.normalize_key(x), F.lit(m)))
    header = grid.filter(has(L1_HEADER) & has(L2_HEADER)).agg(F.min_by(F.struct("row_id", "cells"), "row_id").alias("h"))
    at = {m: header.select(_column_of(F.col("h.cells"), m)).scalar() for m in (L1_HEADER, L2_HEADER, COUNT_HEADER)}
    body = grid.filter(F.col("row_id") > header.select("h.row_id").scalar())
    rows = body.select(
        "row_id",
        F.nullif(T.clean_text(F.get("cells", at[L1_HEADER])), F.lit("")).alias("l1_scene"),
        T.clean_text(F.get("cells", at[L2_HEADER])).alias("l2_scene_raw"),
        parse_number(F.get("cells", at[COUNT_HEADER])).alias("target_count"),
    )
    rows = forward_fill(rows, "row_id", "l1_scene")
    both = F.lower(F.concat_ws(" ", "l1_scene", "l2_scene_raw"))
    marker = T.contains_any(both, [L1_HEADER, L2_HEADER, SUBTOTAL]) | (F.trim(both) == GRAND_TOTAL)
    rows = rows.filter(F.col("l1_scene").isNotNull() & (F.col("l2_scene_raw") != "") & ~marker)
    label, examples = T.split_label(F.col("l2_scene_raw"))
    rows = rows.withColumn("l2_scene_label", label).withColumn("l2_scene_examples", examples)
    return rows.select(
        F.concat(F.lit("scene_"), pad(F.col("row_id"), 3)).alias("id"), F.col("row_id").alias("source_row_id"), "l1_scene",
        "l2_scene_raw", "l2_scene_label", "l2_scene_examples",
        R.application_candidates(F.col("l1_scene"), F.col("l2_scene_label"), F.col("l2_scene_examples")).alias("candidates"),
        "target_count",
    )
