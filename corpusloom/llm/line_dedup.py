"""Remove repeated passages: content-defined chunks of lines, compared byte by byte.

Chunks end where a rolling hash over line hashes says so, and most of a passage falls
into chunks that are the same wherever it stands.  Its first and last lines may share
a chunk with foreign lines, and a passage of two or three lines may have no chunk of
its own.  So the rolling hash of every window of two lines is looked up as well: such
windows complete the chunks, and what they cover together has to make up a passage.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized

_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def line_chunks(text: str, window: int = 2, divisor: int = 2, least: int = 2, most: int = 16, passage_words: int = 50) -> list[tuple[int, int]]:
    """(first line, lines) of the chunks of a text.

    A polynomial hash rolls over the hashes of the last ``window`` lines of the
    chunk; where it is divisible by ``divisor`` a chunk of ``least`` lines or more
    ends, at ``most`` lines it ends anyway.  So ends depend on nearby lines only and
    fall alike in every text that holds the passage.  A line of ``passage_words``
    words is a passage by itself: it is a chunk and ends the one before.
    """
    lines = text.split("\n")
    out: list[tuple[int, int]] = []
    first, recent = 0, []
    for i, line in enumerate(lines):
        if len(line) >= 2 * passage_words - 1 and len(line.split()) >= passage_words:
            if i > first:
                out.append((first, i - first))
            out.append((i, 1))
            first, recent = i + 1, []
            continue
        recent = [*recent, xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))][-window:]
        rolling = 0
        for h in recent:
            rolling = (rolling * _BASE + h) & _MASK
        n = i + 1 - first
        if n >= most or (n >= least and len(recent) == window and (rolling >> 17) % divisor == 0):
            out.append((first, n))
            first = i + 1
    if first < len(lines):
        out.append((first, len(lines) - first))
    return out


def candidate_ranges(text: str, passage_words: int = 50, **options) -> list[tuple[int, int, int, list[int]]]:
    """(first line, lines, hash, words per line) of the chunks and two-line windows that may repeat.

    Both are taken over the lines that are not blank; the blank lines after one of
    these go with it, as do those before the first, and are not hashed.
    Chunks need two lines that are not blank, or one of ``passage_words`` words.
    Windows need two lines that are not both passages by themselves.
    """
    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    full = [i for i, w in enumerate(words) if w]
    starts = [0, *full[1:], len(lines)]
    hashes = [xxhash.xxh64_intdigest(lines[i].encode("utf-8", "surrogatepass")) for i in full]
    own = [lines[i] for i in full]
    out = []

    def add(first: int, n: int, digest: int) -> None:
        a, b = starts[first], starts[first + n]
        out.append((a, b - a, digest, words[a:b]))

    for first, n in line_chunks("\n".join(own), passage_words=passage_words, **options) if own else []:
        if n > 1 or words[full[first]] >= passage_words:
            add(first, n, xxhash.xxh64_intdigest("\n".join(own[first : first + n]).encode("utf-8", "surrogatepass")))
    for i in range(len(own) - 1):
        if min(words[full[i]], words[full[i + 1]]) < passage_words:
            add(i, 2, (hashes[i] * _BASE + hashes[i + 1]) & _MASK)
    return out


def _ranges(text: Column, **options) -> Column:
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    @F.pandas_udf("array<struct<line: int, n: int, h: long, w: array<int>>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"line": a, "n": n, "h": signed(h), "w": w} for a, n, h, w in candidate_ranges(t or "", **options)] for t in texts])

    return run(text)


def passages(ranges: list[tuple[int, list[int]]], passage_words: int = 50) -> list[tuple[int, int]]:
    """(line, lines) of the runs of covered lines that hold ``passage_words`` words; ``ranges``: first line, words per line."""
    covered: dict[int, int] = {}
    for first, words in ranges:
        covered |= {first + k: w for k, w in enumerate(words)}
    out, run = [], []
    for line in [*sorted(covered), None]:
        if run and line != run[-1] + 1:
            if sum(covered[x] for x in run) >= passage_words:
                out.append((run[0], len(run)))
            run = []
        if line is not None:
            run.append(line)
    return out


def _passages(ranges: Column, passage_words: int) -> Column:
    @F.pandas_udf("array<struct<line: int, n: int>>")
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series([[{"line": a, "n": n} for a, n in passages([(x["line"], list(x["w"])) for x in r], passage_words)] for r in rows])

    return run(ranges)


def repeated_chunks(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(id, th, removed): the line ranges (line, n) that each document loses; ``th`` is the hash of its text.

    A chunk or window that occurs again anywhere stays where it comes first by (id,
    text hash, line), nulls last, and is taken out everywhere else, if its bytes are
    those of the first one, blank lines aside; equal hashes alone remove nothing.  What is taken out
    of a document goes if it makes up runs of ``passage_words`` words; shorter
    repeats, such as a line or two that many texts end with, stay.
    """
    docs = df.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("th", F.xxhash64("t"))
    found = docs.select("id", "th", F.explode(_ranges(F.col("t"), **options)).alias("c")).select("id", "th", "c.*")
    chunks = materialized(found, "chunks")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "line")
    firsts = chunks.groupBy("h").agg(F.count("*").alias("c"), F.min(place).alias("first")).filter("c > 1").select("h", "first")
    again = chunks.join(firsts, "h").select("id", "th", F.struct("line", "n", "h", "w", (place == F.col("first")).alias("keep")).alias("o"))
    marked = materialized(again.groupBy("id", "th").agg(F.collect_set("o").alias("o")), "repeats")
    same = F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.th") == F.col("m.th"))
    holders = docs.alias("d").join(marked.alias("m"), same)
    lines = F.split(F.col("d.t"), "\n", -1)
    own = F.filter(F.slice("ls", F.col("o.line") + 1, F.col("o.n")), lambda x, i: F.element_at("o.w", i + 1) > 0)
    texts = holders.select(F.col("d.id"), F.col("d.th"), lines.alias("ls"), F.explode("o").alias("o")).select(
        "id", "th", "o.*", F.array_join(own, "\n").alias("bytes")
    )
    texts = materialized(texts, "repeat-texts")
    # rows that agree in id and text hold the same first chunk
    kept = texts.filter("keep").select("h", F.col("bytes").alias("first_bytes")).dropDuplicates(["h"])
    gone = texts.filter("NOT keep").join(kept, "h").filter("bytes = first_bytes")
    lists = gone.groupBy("id", "th").agg(F.collect_set(F.struct("line", "w")).alias("ranges"))
    runs = lists.select("id", "th", _passages(F.col("ranges"), options.get("passage_words", 50)).alias("removed"))
    return runs.filter(F.size("removed") > 0)


def drop_repeated_chunks(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """All rows with their repeated passages taken out, and what was taken in ``removed``.

    ``removed`` is an array of (line, n) from line 0, empty where nothing went.  No
    row is dropped: a text that holds nothing of its own becomes empty.  ``length``,
    if there is such a column, follows the text.

    Null texts stay null; empty texts have nothing to repeat; rows that agree in id
    and text are one document, so they are edited alike; rows without an id come
    after all others; an empty table gives an empty result; a column named
    ``removed`` is replaced.
    """
    kept = [c for c in df.columns if c != "removed"]
    gone = materialized(repeated_chunks(df, doc_id, text, **options), "removed").select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("removed").alias("_gone"))
    rows = df.select(F.struct(*kept).alias("row"), F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"))
    # a merge join at every size: what has gone has no bound that would let it be broadcast
    joined = rows.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    lines = F.split(F.col(f"row.{text}"), "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.exists("_gone", lambda g: (i >= g["line"]) & (i < g["line"] + g["n"])))
    new = {text: F.when(F.col("_gone").isNull(), F.col(f"row.{text}")).otherwise(F.array_join(left, "\n"))}
    if length in df.columns:
        new[length] = F.when(F.col("_gone").isNull(), F.col(f"row.{length}")).otherwise(F.length(new[text]).cast(df.schema[length].dataType))
    none = F.array().cast("array<struct<line: int, n: int>>")
    return joined.select(*[new.get(c, F.col("row")[c]).alias(c) for c in kept], F.coalesce("_gone", none).alias("removed"))
