"""Near copies of texts: SimHash links from the grid range-join, and min-hash candidates verified on the word shingles of whole texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.simhash import _place, fingerprint_components, fingerprints, shingle_hashes
from corpusloom.operators.similarity import block_pairs, connected_components, forest_edges, map_groups
from corpusloom.sources.storage import materialized

#: Min-hashes a band and bands: a pair at 0.8 shares a band with probability 0.9993, one at 0.3 with 0.017.
ROWS, BANDS = 6, 24
_CHUNK = 4096
_RNG = np.random.default_rng(29)
_MULT = _RNG.integers(1, 2**61, size=ROWS * BANDS, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, size=ROWS * BANDS, dtype=np.uint64)
_FOLD = _RNG.integers(1, 2**61, size=ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text; empty for null and wordless texts."""
    parts = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def min_hash_bands(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` hashes of ``ROWS`` min-hashes each; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        low = np.minimum(low, (hashes[at : at + _CHUNK, None] * _MULT + _ADD).min(axis=0))
    return (low.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64).view(np.int64)


def _sketches(text: Column, shingle: int) -> Column:
    """Size and two hashes of a text's shingle set, which tell sets apart, and its bands."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    @F.pandas_udf("struct<n: int, h1: long, h2: long, bands: array<long>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = shingle_set(t, shingle)
            raw = found.tobytes()
            rows.append((len(found), signed(xxhash.xxh64_intdigest(raw)), signed(xxhash.xxh64_intdigest(raw, seed=1)), min_hash_bands(found)))
        return pd.DataFrame(rows, columns=["n", "h1", "h2", "bands"])

    return run(text)


def _sets(text: Column, shingle: int) -> Column:
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, shingle).view(np.int64) for t in texts])

    return run(text)


def simhash_links(classes: DataFrame, bits: int) -> DataFrame:
    """(a, b): each class (key, fp) with the smallest class its fingerprint reaches over pairs at most ``bits`` apart."""
    fps = materialized(classes.select("fp").distinct(), "near-fingerprints")
    comps = fingerprint_components(fps, bits).withColumnRenamed("key", "fp")
    placed = classes.select("key", "fp").join(comps, "fp", "left").select("key", F.coalesce("comp", "fp").alias("comp"))
    placed = materialized(placed, "near-simhash")
    lowest = placed.groupBy("comp").agg(F.min("key").alias("a"))
    return placed.join(lowest, "comp").filter("a <> key").select("a", F.col("key").alias("b"))


def near_components(classes: DataFrame, texts: DataFrame, threshold: float, shingle: int, block_rows: int, bits: int = 3) -> DataFrame:
    """(key, comp): components of classes over SimHash links and pairs whose sets have a Jaccard similarity of ``threshold`` or more.

    ``classes``: key, k, th, fp, bands; ``texts``: k, th, t.  Fingerprints at most
    ``bits`` apart link first (``fingerprint_components``).  Each cell (a band's value)
    then links its members to its smallest one, which takes a crowd of near copies
    together without its pairs.  Cells of three or more that then still hold several
    components compare all of them in blocks that return spanning forests.  Sets are
    made only of texts that share a cell, and every link is verified on whole sets.
    """
    cells = classes.select("key", F.posexplode("bands").alias("band", "bucket")).select("key", F.xxhash64("band", "bucket").alias("grp"))
    crowded = cells.groupBy("grp").agg(F.count("*").alias("m"), F.min("key").alias("pivot"), F.bit_xor(F.xxhash64("key")).alias("sig")).filter("m > 1")
    # merge joins of exploded rows at every size: Spark sizes them as if there was one of each
    placed = materialized(cells.join(crowded.hint("merge"), "grp"), "near-cells")
    wanted = classes.select("key", "k", "th").join(placed.select("key").distinct(), "key")
    sets = texts.join(wanted.hint("merge"), ["k", "th"]).dropDuplicates(["key"]).select("key", _sets(F.col("t"), shingle).alias("sh"))
    sets = materialized(sets.select("key", "sh", F.size("sh").alias("n")), "near-sets")

    other = sets.select(F.col("key").alias("pivot"), F.col("sh").alias("other"), F.col("n").alias("other_n"))
    pairs = placed.filter("key <> pivot").select("key", "pivot").distinct()
    shared = F.size(F.array_intersect("sh", "other"))
    similar = shared >= F.lit(threshold) * (F.col("n") + F.col("other_n") - shared)
    longest = F.least("n", "other_n") >= F.lit(threshold) * F.greatest("n", "other_n")
    star = pairs.join(sets, "key").join(other, "pivot").filter(longest & similar)
    star = star.select(F.col("pivot").alias("a"), F.col("key").alias("b"))
    edges = materialized(star.unionByName(simhash_links(classes, bits)), "near-star")
    comps = connected_components(edges)

    members = placed.filter("m > 2").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = members.groupBy("grp", "m", "sig").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1")
    # near copies share many bands: cells with the same members are verified once
    once = mixed.groupBy("m", "sig").agg(F.min("grp").alias("grp")).select("grp")
    rest = materialized(members.join(once, "grp", "left_semi").select("key", "grp", "comp"), "near-rest")
    across = block_pairs(rest, block_rows, deal=True).join(sets.hint("merge"), "key")
    found = map_groups(across, ["grp", "lo", "hi"], forest_edges(threshold), "a long, b long").distinct()
    return connected_components(edges.unionByName(materialized(found, "near-bridges")))


def drop_near_copies(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, shingle: int = 5, block_rows: int = 256,
    bits: int = 3, fingerprint_shingle: int = 3,
) -> DataFrame:
    """One row of each group of near copies: the smallest id, of several rows with that id the smallest text hash.

    Texts are near copies if their SimHash fingerprints (``fingerprint_shingle`` words)
    differ in at most ``bits`` bits, as in ``simhash.near_duplicates``, or if their sets
    of ``shingle``-word shingles have a Jaccard similarity of ``threshold`` or more;
    groups are closed over chains of both.  A-Z are
    lower-cased and words are parted by ASCII white space; a text of fewer words is
    one shingle; null, empty and wordless texts are copies of each other.  Rows
    without an id come last; an empty table gives an empty result.
    """
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    marks = [_sketches(F.col(text), shingle).alias("s"), fingerprints(F.col(text), fingerprint_shingle).alias("fp")]
    own = df.select(F.col(doc_id).alias("id"), body.alias("th"), *marks).select("id", "th", "s.*", "fp")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    # equal sets can have other repeats, so other fingerprints
    classes = own.groupBy("h1", "h2", "n", "fp").agg(F.min(order).alias("o"), F.first("bands").alias("bands"))
    classes = classes.select(F.monotonically_increasing_id().alias("key"), "o", _place(F.col("o.id"), F.col("o.th")).alias("k"), F.col("o.th").alias("th"), "fp", "bands")
    classes = materialized(classes, "near-classes")
    texts = df.select(_place(F.col(doc_id), body).alias("k"), body.alias("th"), F.col(text).alias("t"))
    comps = near_components(classes, texts, threshold, shingle, block_rows, bits)
    stays = classes.select("key", "o").join(comps, "key", "left").groupBy(F.coalesce("comp", "key").alias("comp")).agg(F.min("o").alias("o"))
    stays = stays.select(_place(F.col("o.id"), F.col("o.th")).alias("k"), F.col("o.th").alias("th"))
    rows = df.select(F.struct(*df.columns).alias("row"), _place(F.col(doc_id), body).alias("k"), body.alias("th"))
    # a merge join at every size: what stays grows with the documents
    return rows.join(stays.hint("merge"), ["k", "th"], "left_semi").dropDuplicates(["k", "th"]).select("row.*")
