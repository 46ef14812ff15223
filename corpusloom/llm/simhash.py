"""SimHash near-duplicates by a grid range-join over segment popcounts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.similarity import connected_components
from corpusloom.sources.storage import materialized

SEED = 42
_CHUNK = 1 << 15
_ODD = 0x5555555555555555


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the word shingles of a whole text, in parts; see ``text_fingerprint``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(len(words) - shingle + 1, 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[-n:].tolist()
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    for i in range(0, n, _CHUNK):
        yield np.fromiter((digest(joined[a:b]) for a, b in zip(starts[i : i + _CHUNK], stops[i : i + _CHUNK], strict=True)), np.uint64)


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a whole text, as a signed long.

    A-Z are lower-cased, words are parted by ASCII white space, repeats count.  A
    bit is 1 if it is set in over half of the shingles' XXH64 (seed 42).  A text of
    fewer words is one shingle; null and wordless texts have fingerprint zero.
    """
    n, counts = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle):
        n += len(hashes)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """``text_fingerprint`` on Arrow batches."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(text)


def popcount_code(fp: Column) -> Column:
    """The 32 two-bit segment popcounts of a fingerprint, each as 00, 01 or 11.

    In this code the Manhattan distance of the counts is the number of differing
    bits, and it never exceeds the number of differing bits of the fingerprints.
    """
    next_bit = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(next_bit).bitwiseAND(F.lit(_ODD))
    both = fp.bitwiseAND(next_bit).bitwiseAND(F.lit(_ODD))
    return some.bitwiseOR(F.shiftleft(both, 1))


#: The cell and the cells one step away in one of its 16 counts (00 - 01 - 11).
_AROUND = """concat(array(cell),
  filter(transform(sequence(0, 15), i -> if((cell & shiftleft(2L, 2 * i)) = 0, cell ^ shiftleft(1L, 2 * i), null)), x -> x is not null),
  filter(transform(sequence(0, 15), i -> if((cell & shiftleft(1L, 2 * i)) <> 0, cell ^ shiftleft(2L, 2 * i), null)), x -> x is not null))"""


def _cells(codes: DataFrame) -> DataFrame:
    """Each fingerprint with the grid cells of its two halves (16 counts each)."""
    low, high = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("code", 32)
    return codes.select("*", F.posexplode(F.array(low, high)).alias("half", "cell"))


def _near(bits: int, code: Column, other_code: Column) -> Column:
    manhattan = F.bit_count(code.bitwiseXOR(other_code))
    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    return (manhattan <= bits) & (hamming <= bits)


def fingerprint_components(classes: DataFrame, bits: int = 3) -> DataFrame:
    """(key, comp): smallest fingerprint reachable over pairs at most ``bits`` (up to 3) apart.

    Counts of two-bit segments embed a fingerprint in a grid of 32 dimensions.  If
    two are 3 apart in Manhattan distance, one half of the dimensions has at most
    1 of it: so one side stands in its own cell of each half, the other also in all
    cells one step away, and an equi join finds every pair.  The full Manhattan
    distance prunes, the fingerprints decide.

    Crowds are joined first: each cell links its members to its smallest one if
    near.  The range-join then only has to return pairs of different components, so
    a crowd of near-copies does not come out as all its pairs.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the grid finds pairs up to 3 bits apart")
    codes = classes.select("fp", popcount_code(F.col("fp")).alias("code"))
    cells = _cells(codes)
    pivots = cells.groupBy("half", "cell").agg(F.min(F.struct("fp", "code")).alias("p"))
    pivots = pivots.select("half", "cell", F.col("p.fp").alias("other"), F.col("p.code").alias("other_code"))
    # Spark sizes exploded rows as if there was one of each, and would broadcast what grows with the documents: merge joins here and below
    star = cells.join(pivots.hint("merge"), ["half", "cell"]).filter((F.col("fp") > F.col("other")) & _near(bits, F.col("code"), F.col("other_code")))
    edges = materialized(star.select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct(), "simhash-star")
    comps = connected_components(edges)

    # dealt out before it is multiplied; a row carries no more than the fingerprint and, where it is another, the component
    own = F.nullif(F.coalesce("comp", "fp"), F.col("fp")).alias("comp")
    known = materialized(classes.select("fp").join(comps.withColumnRenamed("key", "fp"), "fp", "left").select("fp", own), "simhash-comps")
    known = known.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    cells = _cells(known.withColumn("code", popcount_code(F.col("fp"))))
    place = F.shiftleft(F.col("half").cast("long"), 32).bitwiseOR(F.col("cell")).alias("place")
    here = cells.select("fp", "comp", place)
    there = cells.select(F.col("fp").alias("other"), F.col("comp").alias("other_comp"), "half", F.explode(F.expr(_AROUND)).alias("cell"))
    there = there.select("other", "other_comp", place)
    a, b = F.coalesce("comp", "fp"), F.coalesce("other_comp", "other")
    apart = (F.col("fp") < F.col("other")) & (a != b)
    found = here.join(there.hint("merge"), "place").filter(apart & _near(bits, popcount_code(F.col("fp")), popcount_code(F.col("other"))))
    bridges = found.select(a.alias("a"), b.alias("b")).distinct()
    return connected_components(edges.unionByName(materialized(bridges, "simhash-bridges")))


def _grouped(df: DataFrame, carried: list[Column], doc_id: str, text: str, bits: int, shingle: int) -> DataFrame:
    """(row, id, fp, component_id); ``row`` holds the carried columns.  Texts are read once and written nowhere."""
    rows = df.select(F.struct(*carried).alias("row"), F.col(doc_id).alias("id"), fingerprints(F.col(text), shingle).alias("fp"))
    rows = materialized(rows, "simhash")
    classes = materialized(rows.groupBy("fp").agg(F.min("id").alias("id")), "simhash-classes")
    comps = classes.join(fingerprint_components(classes, bits).withColumnRenamed("key", "fp"), "fp", "left")
    comps = comps.withColumn("comp", F.coalesce("comp", "fp"))
    lowest = comps.groupBy("comp").agg(F.min("id").alias("component_id"))
    ids = comps.join(lowest, "comp").select("fp", "component_id", F.col("comp").alias("component"))
    return rows.join(ids, "fp")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3, shingle: int = 3, keep: list[str] | None = None
) -> DataFrame:
    """Add ``fingerprint`` (16 hex digits) and ``component_id`` to every row, of its columns those in ``keep``.

    Fingerprints at most ``bits`` apart are linked; the component is the smallest
    id reachable over links, the row's own included.  Rows with equal fingerprints
    are folded before any comparison.  Null, empty and wordless texts have
    fingerprint zero and are linked like any other; rows without an id get the
    smallest id of their component, null if it has none; repeated rows are kept;
    an empty table gives an empty result; columns that carry one of the two result
    names are replaced.
    """
    kept = [c for c in keep or df.columns if c not in ("fingerprint", "component_id")]
    found = _grouped(df, [F.col(c) for c in kept], doc_id, text, bits, shingle)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(*[F.col("row")[c].alias(c) for c in kept], fingerprint.alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3, shingle: int = 3) -> DataFrame:
    """One row of each component: the one with the smallest id, of several with that id the one with the smallest text hash.

    A component without any id keeps its row with the smallest text hash.  The
    choice is made on narrow rows; the rows that stay are then fetched by id and
    text hash, and repeats of them are dropped where they meet.
    """
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    found = _grouped(df, [body.alias("th")], doc_id, text, bits, shingle)
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col("row.th").alias("th"))
    stays = found.groupBy("component").agg(F.min(order).alias("o")).select(_place(F.col("o.id"), F.col("o.th")).alias("k"), F.col("o.th").alias("th"))
    rows = df.select(F.struct(*df.columns).alias("row"), _place(F.col(doc_id), body).alias("k"), body.alias("th"))
    # a merge join at every size: what stays grows with the documents
    return rows.join(stays.hint("merge"), ["k", "th"], "left_semi").dropDuplicates(["k", "th"]).select("row.*")


def _place(id_: Column, th: Column) -> Column:
    """A key that is never null, for an id that may be."""
    return F.xxhash64(id_.isNull(), id_, th)
