"""URL rules: host-suffix and path-prefix expressions joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "host string, path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for text without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows from a short list."""
    return spark.createDataFrame(rules, RULE_SCHEMA)


def url_decisions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One (host, path, rule, verdict) row for each distinct (host, path) that a rule fits.

    A URL is expanded into (host suffix, path prefix) expressions, but only of the
    shapes that rules have: so many labels, so many characters.  Expressions meet
    rules on the first four bytes of their SHA-256 and count when all 32 agree.
    The longest rule wins, then the longer host; ``block`` wins over ``allow`` if
    the same rule is listed twice.  Only the distinct shapes (at most labels times
    path lengths of the rules) reach the driver; URLs and rules never do.
    """
    spelled = rules.select(F.coalesce("host", F.lit("")).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
    known = spelled.groupBy("h", "p").agg(F.max("verdict").alias("verdict")).select(
        _labels(F.col("h")).alias("k"), F.length("p").alias("l"), F.concat("h", "p").alias("rule"), "verdict"
    )
    shapes = sorted((r.k, r.l) for r in known.select("k", "l").distinct().collect())
    if not shapes:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("l")) for k, n in shapes])
    known = known.withColumn("digest", _digest(F.col("rule"))).withColumn("short", F.substring("digest", 1, 4))
    fits = F.filter(table, lambda s: (s["k"] <= _labels(F.col("host"))) & (s["l"] <= F.length("path")))
    spread = (
        urls.select("host", "path").distinct()
        .select("host", "path", F.explode(fits).alias("s"))
        .withColumn(
            "own",
            _digest(F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("s.k")), F.substring(F.col("path"), F.lit(1), F.col("s.l")))),
        )
        .withColumn("short", F.substring("own", 1, 4))
    )
    hits = spread.join(known, "short").filter(F.col("own") == F.col("digest"))
    best = F.max(F.struct(F.length("rule").alias("n"), known["k"], "rule", "verdict")).alias("best")
    return hits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def filter_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    A rule (host, path) fits its host and all subdomains if the path starts with
    the rule's path; it is spelled host followed by path (``example.org/es/``).
    Work is done once per distinct (host, path), so a URL that fills the table
    costs one decision; the join back is one Spark can split when it is skewed.

    Null URLs and URLs without ``://`` have empty host and path, and ``default``;
    an empty path starts with no ``/``.  Repeated rows are judged alike, an empty
    table gives an empty result, and columns that carry one of the four result
    names are replaced.
    """
    host, path = host_and_path(F.col(url))
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    judged = df.select(*kept, host.alias("host"), path.alias("path"))
    found = url_decisions(judged, rules)
    return (
        judged.join(found, ["host", "path"], "left")
        .select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    )
