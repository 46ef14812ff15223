"""Filters and labels by rule: pre-filter reasons, tags, facets, relevance, regenerate flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T


def prefilter_reason(c: Column, min_len: int = 30, max_len: int = 600, min_cjk: float = 0.05, min_ascii: float = 0.9) -> Column:
    """First failing rule, or 'ok'.  A text without CJK must be mostly ASCII to count as English."""
    text = T.or_empty(c)
    dense = F.length(F.replace(text, F.lit(" "), F.lit("")))
    cjk = F.regexp_count(text, F.lit("[一-鿿]"))
    ascii_chars = F.regexp_count(text, F.lit("[!-~]"))
    foreign = (dense > 0) & (cjk / dense < min_cjk) & (ascii_chars / dense < min_ascii)
    return (
        F.when(F.length(text) < min_len, "too_short")
        .when(F.length(text) > max_len, "too_long")
        .when(foreign, "unsupported_language")
        .when(~T.contains_any(F.lower(text), fv.UI_KEYWORDS), "not_ui_related")
        .when(T.contains_any(text, fv.REFUSAL_PHRASES), "llm_refusal")
        .otherwise("ok")
    )


def keyword_tags(c: Column, tags: list[str]) -> Column:
    """Tags whose name occurs in the text, any case, in table order; ``a_b`` is also found as ``a b``."""
    low = F.lower(T.or_empty(c))
    forms = lambda t: list(dict.fromkeys([t.lower(), t.lower().replace("_", " ")]))
    return F.array_compact(F.array(*[F.when(T.contains_any(low, forms(t)), F.lit(t)) for t in tags]))


def mentions(c: Column, words: list[str]) -> Column:
    return T.contains_any(F.lower(T.or_empty(c)), [w.lower() for w in words])


def label_columns(c: Column) -> dict[str, Column]:
    """Multi-label tags; ``mobile_responsive`` is null when not mentioned."""
    return {
        "components": keyword_tags(c, fv.COMPONENT_TAGS),
        "tech_stack": keyword_tags(c, fv.TECH_TAGS),
        "interactions": keyword_tags(c, fv.INTERACTION_TAGS),
        "has_data_viz": mentions(c, fv.DATA_VIZ_WORDS),
        "mobile_responsive": F.when(mentions(c, fv.RESPONSIVE_WORDS), F.lit(True)),
        "explicit_style": mentions(c, fv.STYLE_NAMES),
    }


def facet_filter(df: DataFrame, facets: dict[str, str | None], keyword: str | None = None, searched: list[str] | None = None) -> DataFrame:
    """Conjunction of the facets that are set, plus a case-insensitive keyword over columns."""
    conds = [F.coalesce(F.col(c).cast("string"), F.lit("")) == v for c, v in facets.items() if v]
    if keyword and keyword.strip():
        hay = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in searched or []]))
        conds.append(F.contains(hay, F.lit(keyword.strip().lower())))
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def page_of(df: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    """One result page: an ordered limit with offset, no full ranking."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def topic_search(topics: DataFrame, query: str, text: str, group: str) -> DataFrame:
    """Matches of a substring, counted per group."""
    hits = topics.filter(F.contains(F.lower(F.col(text)), F.lit(query.lower())))
    return hits.groupBy(group).agg(F.count("*").alias("matches"), F.count_distinct(text).alias("distinct_topics"))


def relevant(score: Column, first: Column, second: Column, text: Column, min_score: float = 0.4, min_len: int = 50) -> Column:
    some = (F.coalesce(F.size(first), F.lit(0)) > 0) | (F.coalesce(F.size(second), F.lit(0)) > 0)
    return (score >= min_score) & some & (F.length(text) >= min_len)


def regenerate_rules(c: Column, patterns=fv.REGENERATE_PATTERNS) -> Column:
    """Names of the matching regenerate rules."""
    return F.array_compact(F.array(*[F.when(T.or_empty(c).rlike(p), F.lit(n)) for n, p in patterns]))


def needs_translation(text: Column, error: Column, translated: Column) -> Column:
    return (T.or_empty(text) != "") & (T.or_empty(error) == "") & (T.or_empty(translated) == "")


def excluded(c: Column, parts: list[str]) -> Column:
    """True when ``c`` contains one of the excluded substrings."""
    return T.contains_any(T.or_empty(c), parts) if parts else F.lit(False)
