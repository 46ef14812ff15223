"""Personal data: patterns, and terms that disclose a protected entity by co-occurrence."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The email pattern's leftmost matches, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        done = match.end() if match else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """(kind, start, end) of emails, IP addresses, cards and phones, by start, then kind."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.groups())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def entity_of(kind: str, value: str) -> str:
    """One spelling for each protected entity."""
    return f"{kind}:{value.lower() if kind == 'email' else '.'.join(p.lstrip('0') or '0' for p in value.split('.')) if kind == 'ip' else re.sub('[^0-9]', '', value)}"


def term_positions(text: str) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of words of three letters or more, lower-cased."""
    for m in _WORD.finditer(text):
        if m.end() - m.start() > 2:
            yield m.group().lower(), m.start(), m.end()


def outside(terms: list[tuple[str, int, int]], spans: list[Span]) -> list[tuple[str, int, int]]:
    """The terms, in order, that no span touches."""
    edges = sorted((a, b) for _, a, b in spans)
    out, k, reach = [], 0, 0
    for t in terms:
        while k < len(edges) and edges[k][0] < t[2]:
            reach = max(reach, edges[k][1])
            k += 1
        if t[1] >= reach:
            out.append(t)
    return out


def surroundings(terms: list[tuple[str, int, int]], span: Span, words: int = 8) -> str:
    """Hash of the nearest terms on both sides of an entity, wherever they stand."""
    at = bisect_left(terms, span[1], key=lambda t: t[1])
    near = [t for t, _, _ in terms[max(at - words, 0) : at + words]]
    return hashlib.md5("\n".join(near).encode()).hexdigest()


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SPANS = "array<struct<kind: string, a: int, b: int>>"


def _scan(text: Column) -> Column:
    """Base spans, entities with their surroundings and all distinct terms outside spans (one a line), of whole texts."""

    @F.pandas_udf(f"struct<spans: {_SPANS}, entities: array<struct<entity: string, context: string>>, terms: string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        spans, entities, terms = [], [], []
        for t in texts:
            t = t or ""
            found = pattern_spans(t)
            spans.append([{"kind": k, "a": a, "b": b} for k, a, b in found])
            if found:
                free = outside(list(term_positions(t)), found)
                seen = {(entity_of(s[0], t[s[1] : s[2]]), surroundings(free, s)) for s in found}
                entities.append([{"entity": e, "context": c} for e, c in sorted(seen)])
                terms.append("\n".join({w for w, _, _ in free}))
            else:
                entities.append([])
                terms.append("\n".join({w.lower() for w in set(_WORD.findall(t)) if len(w) > 2}))
        return pd.DataFrame({"spans": spans, "entities": entities, "terms": terms})

    return run(text)


def _each(terms: str) -> Column:
    return F.explode(F.filter(F.split(terms, "\n"), lambda w: w != "")).alias("term")


def disclosures(
    entities: DataFrame, terms: DataFrame, frequency: DataFrame, support: int = 3, remove_bits: float = 1.0, generalise_bits: float = 2.0
) -> tuple[DataFrame, DataFrame]:
    """What discloses an entity, (entity, term, p_entity, bits, action), and where: (doc, term, action).

    ``entities``: doc, entity, context (one or more per document); ``terms``: doc,
    terms (one a line), of the documents with entities; ``frequency``: term, df over all documents.
    A term counts with an entity if both are in a document, however far apart.  What
    term t tells about entity c is their pointwise mutual information,
    log2(p(c, t) / p(c) p(t)); all that can be told is c's own information,
    -log2 p(c).  The difference, -log2 p(c | t), is what t leaves open: at
    ``remove_bits`` or less the term gives the entity away and is removed, at
    ``generalise_bits`` or less it is generalised.  The bounds do not move with the
    size of the corpus.  A pair in fewer than ``support`` documents, or with fewer
    different surroundings of the entity, is no evidence: copies of one passage
    have one surrounding.

    Pairs are made when what cannot matter is gone: entities with too few documents
    or surroundings, and terms in too few documents or in so many that none of the
    entities beside them could be told by them.
    """
    widest = 2.0**generalise_bits
    seen = entities.groupBy("entity").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("doc").alias("docs"))
    known = materialized(seen.filter(F.least("contexts", "docs") >= support).select("entity", "docs"), "pii-entities")
    held = materialized(entities.join(known, "entity"), "pii-held")
    most = held.groupBy("doc").agg(F.max("docs").alias("most"))
    largest = known.agg(F.coalesce(F.max("docs"), F.lit(0))).first()[0]
    useful = frequency.filter((F.col("df") >= support) & (F.col("df") <= widest * largest))
    beside = terms.join(most, "doc").select("doc", "most", _each("terms")).join(useful, "term").filter(F.col("df") <= widest * F.col("most")).select("doc", "term", "df")
    pairs = materialized(held.join(beside, "doc").filter(F.col("df") <= widest * F.col("docs")).select("doc", "entity", "context", "term", "df"), "pii-pairs")
    counted = pairs.groupBy("entity", "term").agg(
        F.count_distinct("context").alias("contexts"), F.count_distinct("doc").alias("together"), F.first("df").alias("df")
    )
    given = F.least(F.col("together") / F.col("df"), F.lit(1.0))
    bits = -F.log2(given)
    action = F.when(bits <= remove_bits, "remove").when(bits <= generalise_bits, "generalise")
    told = counted.filter(F.least("contexts", "together") >= support).select("entity", "term", given.alias("p_entity"), bits.alias("bits"), action.alias("action"))
    told = materialized(told.filter("action IS NOT NULL"), "pii-told")
    where = pairs.select("doc", "entity", "term").distinct().join(told, ["entity", "term"]).groupBy("doc", "term").agg(F.max("action").alias("action"))
    return told, where


def _mark(text: Column, terms: Column, base: Column) -> Column:
    """Spans of the given terms outside base spans in whole texts; ``terms``: array<struct<term, action>>."""

    @F.pandas_udf(_SPANS)
    def run(texts: pd.Series, wanted: pd.Series, bases: pd.Series) -> pd.Series:
        rows = []
        for t, w, b in zip(texts, wanted, bases, strict=True):
            kinds = {x["term"]: x["action"] for x in w}
            free = outside(list(term_positions(t or "")), [(s["kind"], s["a"], s["b"]) for s in b])
            rows.append([{"kind": kinds[p], "a": a, "b": e} for p, a, e in free if p in kinds])
        return pd.Series(rows)

    return run(text, terms, base)


def find_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """The columns of ``df`` (those in ``keep``) in ``row``, with ``base`` and ``added`` spans (kind, a, b) in code points.

    ``base`` are the four patterns; ``added`` are the terms that ``disclosures``
    finds for an entity of the same document, wherever they stand in it, except
    inside base spans.  The kind of an added span is what to do: ``remove`` or
    ``generalise`` (the stronger if two entities differ).

    A null text is empty; rows that agree in id and text are one document in all
    counts and get the same spans; an empty table gives an empty result; columns of
    ``df`` never clash, as they stay in ``row``.
    """
    docs = df.select(F.struct(*(keep or df.columns)).alias("row"), F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    docs = docs.withColumn("th", F.xxhash64("t"))
    # texts are not written again: the few that have terms to mark are read from their source
    scanned = docs.select("row", "id", "th", _scan(F.col("t")).alias("f"), F.monotonically_increasing_id().alias("at"))
    scanned = materialized(scanned.select("row", "id", "th", "at", F.col("f.spans").alias("base"), F.col("f.entities").alias("entities"), F.col("f.terms").alias("terms")), "pii")
    # of the rows of one document the first counts; which ones do not is found without their terms
    names = scanned.select("id", "th", "at")
    again = names.groupBy("id", "th").agg(F.count("*").alias("c"), F.min("at").alias("first")).filter("c > 1")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    repeats = names.join(again.select(F.col("id").alias("_id"), F.col("th").alias("_th"), "first"), same).filter("at <> first")
    once = scanned.select("at", "entities", "terms").join(materialized(repeats.select("at"), "pii-repeats"), "at", "left_anti")
    frequency = once.select(_each("terms")).groupBy("term").agg(F.count("*").alias("df"))
    carriers = once.filter(F.size("entities") > 0).withColumnRenamed("at", "doc")
    entities = carriers.select("doc", F.explode("entities").alias("e")).select("doc", "e.entity", "e.context")
    _, where = disclosures(entities, carriers.select("doc", "terms"), frequency, **options)
    lists = where.groupBy("doc").agg(F.collect_list(F.struct("term", "action")).alias("wanted"))  # of one text
    lists = lists.join(scanned.select(F.col("at").alias("doc"), F.col("id").alias("_id"), F.col("th").alias("_th"), "base"), "doc")
    marked = docs.select("id", "th", "t").join(materialized(lists, "pii-lists"), same).select("_id", "_th", _mark(F.col("t"), F.col("wanted"), F.col("base")).alias("added"))
    marked = marked.groupBy("_id", "_th").agg(F.first("added").alias("added"))
    joined = scanned.select("row", "id", "th", "base").join(marked, same, "left")
    return joined.select("row", "base", F.coalesce("added", F.array().cast(_SPANS)).alias("added"))


def cleaned_text(text: str, spans: list[Span]) -> str:
    """A text with entities named by kind, terms generalised to ``[TERM]`` or removed; overlaps merge into the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], "" if kind == "remove" else "[TERM]" if kind == "generalise" else f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with its text sanitised; null texts stay null; see ``find_spans``."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series, base: pd.Series, added: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else cleaned_text(t, [(s["kind"], s["a"], s["b"]) for s in [*b, *x]]) for t, b, x in zip(texts, base, added, strict=True)])

    found = find_spans(df, doc_id, text, **options)
    return found.select(*[(clean(F.col(f"row.{text}"), F.col("base"), F.col("added")) if c == text else F.col("row")[c]).alias(c) for c in df.columns])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def span_digest(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, counts by kind, SHA-256 of the base spans and all spans as text."""

    @F.pandas_udf("struct<base_sha256: string, spans: string>")
    def spell(base: pd.Series, added: pd.Series) -> pd.DataFrame:
        order = {k: i for i, k in enumerate((*KINDS, "generalise", "remove"))}
        rows = []
        for b, x in zip(base, added, strict=True):
            own = [(s["kind"], s["a"], s["b"]) for s in b]
            both = sorted(own + [(s["kind"], s["a"], s["b"]) for s in x], key=lambda s: (s[1], order[s[0]]))
            rows.append((hashlib.sha256(spans_text(own).encode()).hexdigest(), spans_text(both)))
        return pd.DataFrame(rows, columns=["base_sha256", "spans"])

    narrow = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = find_spans(narrow, "doc_id", "text", ["doc_id"], **options)
    n = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("row.doc_id").alias("doc_id"), *n, spell(F.col("base"), F.col("added")).alias("s")).select("doc_id", *[f"n_{k}" for k in KINDS], "s.base_sha256", "s.spans")
