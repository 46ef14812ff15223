"""Registry and small SQL snippets shared by the oracle queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its oracle unless SQL cannot express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL snippets (DuckDB dialect) ---------------------------------------------------


def s_clean(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g'))"


def s_words(x: str) -> str:
    return f"len(list_filter(string_split({s_clean(x)}, ' '), lambda w: w <> ''))"


def s_tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9'']+')"


def s_round(x: str, digits: int) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def s_ratio(num: str, den: str, digits: int = 6) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0e0 ELSE {s_round(f'({num})::DOUBLE / ({den})::DOUBLE', digits)} END"


def s_hash(x: str) -> str:
    """First 32 bits of sha1 as a number."""
    return f"('0x' || substr(sha1({x}), 1, 8))::BIGINT"


def s_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


def s_any_word(words: list[str]) -> str:
    return (r"(?i)\b(?:" + "|".join(words) + r")\b").replace("'", "''")


def s_count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def s_contains(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def s_tags(x: str, rules) -> str:
    """Concatenated tag lists of the matching rules (duplicates kept)."""
    parts = [f"(CASE WHEN {s_contains(x, words)} THEN {s_list(tags)} ELSE [] END)" for words, tags in rules]
    return "(" + " || ".join(parts) + ")"


def s_distinct(col: str) -> str:
    """Ordered distinct of a list column."""
    return f"list_filter({col}, lambda x, i: list_position({col}, x) = i)"


def s_strip_ordinal(x: str) -> str:
    return rf"regexp_replace({s_clean(x)}, '^[①②③④⑤⑥⑦⑧⑨⑩]\s*', '')"
