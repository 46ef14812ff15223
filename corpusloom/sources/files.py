"""File sources and sinks: JSON lines, CSV, batch files, keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.ranking import running_index
from corpusloom.sources.versions import VersionedTable

RECORD_SCHEMA = (
    "id string, l1_scene string, l2_scene_label string, corpus_l2_key string, corpus_topic string, "
    "corpus_persona_id string, platform string, target_complexity string, query_text string, word_count long, error string"
)

# fixed values: what a missing field reads as
FIELD_DEFAULTS = {
    "l1_scene": "(unknown)", "l2_scene_label": "(unknown)", "corpus_l2_key": "(unknown)", "corpus_topic": "(unknown)",
    "corpus_persona_id": "(none)", "target_complexity": "(unknown)",
}


def usable_records(raw: DataFrame) -> DataFrame:
    """Drop rows with an error or blank text; fill defaults (null and '' alike)."""
    ok = (T.or_empty(F.col("error")) == "") & (T.trim_ws(F.col("query_text")) != "")
    filled = {c: F.when(T.or_empty(F.col(c)) == "", d).otherwise(F.col(c)) for c, d in FIELD_DEFAULTS.items() if c in raw.columns}
    return raw.filter(ok).withColumns(filled).withColumn("word_count", F.coalesce("word_count", F.lit(0)).cast("long"))


def read_records(spark: SparkSession, path: str | list[str], schema: str = RECORD_SCHEMA) -> DataFrame:
    """JSON lines with a fixed schema; malformed lines are dropped."""
    return usable_records(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path))


def read_runs(spark: SparkSession, registry: list[tuple[str, str, str]], root: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Union of run folders with version and platform from the registry (folder, version, platform)."""
    raw = (
        spark.read.schema(schema).option("mode", "DROPMALFORMED").json([f"{root}/{d}" for d, _, _ in registry])
        .withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1))
    )
    version, default_platform = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d, v, p in registry:
        version = F.when(F.col("run") == d, v).otherwise(version)
        default_platform = F.when(F.col("run") == d, p).otherwise(default_platform)
    rows = usable_records(raw).withColumn("version", version)
    return rows.withColumn("platform", F.when(T.or_empty(F.col("platform")) == "", default_platform).otherwise(F.col("platform")))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def csv_projection(df: DataFrame, id_col: str, text: str, prefix: str) -> DataFrame:
    """(id, prompt): prefix + text, line breaks flattened to blanks; a blank text leaves the prefix, a null one no prompt."""
    whole = F.when(F.col(text).isNotNull(), F.concat(F.lit(prefix + " "), T.trim_ws(F.col(text))))
    one_line = F.regexp_replace(whole, r"\r\n|\n|\r", " ")
    return df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), one_line.alias("prompt"))


#: Inner quotes doubled; no other character escapes (Spark's default here is NUL), and blanks at the ends are content.
_CSV = {"header": True, "escape": '"', "charToEscapeQuoteEscaping": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    """All cells quoted, inner quotes doubled; null is an empty cell."""
    df.write.mode("overwrite").options(**_CSV, quoteAll=True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files of ``write_csv``; an empty cell reads as null."""
    return spark.read.schema(schema).options(**_CSV, multiLine=False).csv(path)


def pack_batches(df: DataFrame, by: list[str], order: str, size: int) -> DataFrame:
    """Number rows into fixed-size batches per group: (…, batch, slot)."""
    numbered = running_index(df, by, order, name="_i", start=0)
    return (
        numbered.withColumn("batch", F.floor(F.col("_i") / size).cast("long") + 1)
        .withColumn("slot", F.col("_i") % size)
        .drop("_i")
    )


BUNDLE = "part-*.json"


def write_batches(packed: DataFrame, by: list[str], payload: list[str], path: str, per_file: int = 10_000) -> None:
    """Batches bundled into JSON lines: one line ``{"batch": n, "rows": [...]}`` per batch, below a folder per group.

    A batch has a fixed small number of rows, so it is the one group that may be
    collected into a single value.  Batches are sorted into ranges of (group, batch),
    one task per range: files follow the size of the data, not the number of batches,
    and none holds more than ``per_file`` of them.  Files appear when the whole job
    has succeeded; a write that fails leaves no batch that ``read_batch_outputs`` sees.
    """
    item = F.struct("slot", F.struct(*payload).alias("p"))
    arrays = packed.groupBy(*by, "batch").agg(F.sort_array(F.collect_list(item)).alias("items"))
    lines = arrays.select(*by, "batch", F.transform("items", lambda x: x["p"]).alias("rows"))
    ranged = lines.repartitionByRange(*by, "batch").sortWithinPartitions(*by, "batch")
    ranged.write.mode("overwrite").option("maxRecordsPerFile", per_file).option("ignoreNullFields", False).partitionBy(*by).json(path)


def read_batch_outputs(spark: SparkSession, path: str, schema: str, id_col: str = "id", text: str = "query_text") -> DataFrame:
    """All rows of batch files; blank texts dropped, text trimmed; per id the last row of the last batch wins.

    Two kinds of files are read below ``path``: bundles of ``write_batches``
    (``part-*.json``), line by line, and any other file, also ``*.json``, as one JSON
    array, which is a batch by itself.
    Batches are ordered by folder, then by number, then by file.  What is no JSON array
    is skipped.
    """
    item = f"array<struct<{', '.join(f.strip().replace(' ', ': ', 1) for f in schema.split(','))}>>"
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/", 1)
    at = [folder.alias("_folder"), F.col("_metadata.file_path").alias("_file")]
    options = {"recursiveFileLookup": True}
    bundles = spark.read.options(**options, pathGlobFilter=BUNDLE).text(path)
    line = F.from_json("value", f"batch bigint, rows {item}")
    lines = bundles.select(*at, line.alias("r")).select("_folder", F.col("r.batch").alias("_batch"), "_file", F.posexplode("r.rows").alias("_row", "r"))
    whole = spark.read.options(**options).text(path, wholetext=True).filter(~F.col("_metadata.file_name").like(BUNDLE.replace("*", "%")))
    single = whole.select(*at, F.lit(0).cast("long").alias("_batch"), F.posexplode(F.from_json("value", item)).alias("_row", "r"))
    place = ["_folder", "_batch", "_file", "_row"]
    rows = lines.unionByName(single).select("r.*", *place)
    names = [c for c in rows.columns if c not in (id_col, *place)]
    rows = rows.filter(F.col(id_col).isNotNull() & (T.or_empty(F.col(text)) != "")).withColumn(text, T.trim_ws(F.col(text)))
    last = F.max_by(F.struct(*names), F.struct(*place))
    return rows.groupBy(id_col).agg(last.alias("r")).select(id_col, "r.*")


TABLE_KEYS = {"imported_requirements": "id", "queries": "id", "generation_runs": "id"}


def stored_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    """One of the three tables below ``root``: requirements, queries, the run log."""
    return VersionedTable(spark, f"{root}/{name}", [TABLE_KEYS[name]])


def create_tables(spark: SparkSession, root: str, stored: dict[str, DataFrame], buckets: int = 64) -> None:
    for name in TABLE_KEYS:
        stored_table(spark, root, name).create(stored[name], buckets)


def load_tables(spark: SparkSession, root: str, scenes: DataFrame, queries: DataFrame, mode: str, at: Column, order: str) -> dict[str, int]:
    """One load: requirements and queries inserted or replaced by id, and a row in the run log; returns the new versions.

    ``scenes`` and ``queries`` carry their load order in ``order``.  A table's load
    reads and writes the buckets that its rows touch.  The run log comes last: a load
    whose row it holds is complete, and repeating one that failed gives the same
    tables.
    """
    log = run_log_row(queries, mode, at).withColumn(order, F.lit(0).cast("long"))
    rows = {"imported_requirements": scenes, "queries": queries, "generation_runs": log}
    return {name: stored_table(spark, root, name).upsert(df, order) for name, df in rows.items()}


def run_log_row(queries: DataFrame, mode: str, at: Column) -> DataFrame:
    """The load's log row: id from time, row count and mode."""
    counted = queries.agg(F.count("*").alias("n"), F.max(at).alias("created_at"))
    run_id = F.concat(F.lit("run_"), T.short_hash(F.concat_ws(":", "created_at", F.col("n").cast("string"), F.lit(mode))))
    return counted.select(run_id.alias("id"), F.lit(mode).alias("mode"), F.col("n").alias("total_planned"), F.col("n").alias("total_generated"), "created_at")


def ordered_view(df: DataFrame, created: str, id_col: str) -> DataFrame:
    """Newest first, then by id: the stable order of reports."""
    return df.orderBy(F.desc(created), F.asc(id_col))
