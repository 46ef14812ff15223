"""Tokenise, cut and pack documents by bulk-synchronous best fit."""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from struct import pack as pack_ids

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized

TOKENIZER_FILE = "word_bpe_49k.json"
#: Words whose ids a worker remembers; the memory is emptied when full.
_REMEMBERED = 400_000
_LONGEST_REMEMBERED = 64
#: Signs that are neither letters, numbers nor white space, without the apostrophe.
_SIGNS = ".,;:!?#$%&*)"
#: Beyond Latin, and the dotted capital I: here lower-casing may depend on who does it.
_OTHER_CASE = re.compile("[\u0130\u0180-\U0010ffff]")


def tokenizer_path() -> str:
    """Where the public vocabulary file lies; never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


#: Byte-level vocabularies write a byte as a sign of its own: itself if it prints, else the next one from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class WordIds:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers.

    This tokenizer drops white space, lower-cases, and never merges across white
    space or between a word and the signs after it.  So a text's ids are those of
    its parts, and a part that comes again needs no second run; parts are told
    apart without case, where lower-casing is the same everywhere, and without the
    signs at their end.  ``tests`` hold this against whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.known: dict[str, bytes] = {"": b""}
        self.lowered = False

    def run(self, word: str) -> bytes:
        if self.lowered and word.isalpha():  # one run of letters in its normal form: only the merges are left to do
            found = [t.id for t in self.merge(word.encode().decode("latin-1").translate(_BYTE_SIGNS))]
        else:
            found = self.encode(word, add_special_tokens=False).ids
        ids = pack_ids(f"<{len(found)}I", *found)
        if len(word) <= _LONGEST_REMEMBERED:
            if len(self.known) >= _REMEMBERED:
                self.known = {"": b""}
            self.known[word] = ids
        return ids

    def part(self, word: str) -> bytes:
        base = word.rstrip(_SIGNS)
        if len(base) == len(word) or not base or not base[-1].lower()[-1].isalnum():
            return self.run(word)
        signs = word[len(base) :]
        head, tail = self.known.get(base), self.known.get(signs)
        return (self.run(base) if head is None else head) + (self.run(signs) if tail is None else tail)

    def text(self, text: str) -> bytes:
        if "<|" in text:  # may be a special token, whose case counts
            return np.asarray(self.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self.lowered = text.isascii() or not _OTHER_CASE.search(text)
        if self.lowered:
            text = text.lower()
        get, part = self.known.get, self.part
        out = []
        for w in text.replace("\n", " ").split(" "):
            ids = get(w)
            if ids is None:
                ids = part(w)
                get = self.known.get
            out.append(ids)
        return b"".join(out)


_LOADED: dict[str, WordIds] = {}


def loaded(path: str) -> WordIds:
    """One tokenizer per worker process and file."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


PIECES = "piece int, start long, length long, ids binary"


def cut_pieces(df: DataFrame, text: str, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Rows (row, row_no, piece, start, length, ids) from rows (row, ``text``); ids are unsigned 32-bit numbers, little-endian.

    A document is its ids and ``end_id``; only one longer than ``capacity`` is cut,
    into pieces of ``capacity`` of which the last may be shorter.  ``row_no`` tells
    rows apart, repeated ones included.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    @F.pandas_udf(f"array<struct<{', '.join(x.replace(' ', ': ') for x in PIECES.split(', '))}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids_of = loaded(path).text
        step = capacity * 4
        for texts in batches:
            rows = []
            for t in texts:
                ids = ids_of(t or "") + end
                parts = [ids[i : i + step] for i in range(0, len(ids), step)]
                rows.append([{"piece": k, "start": k * capacity, "length": len(p) // 4, "ids": p} for k, p in enumerate(parts)])
            yield pd.Series(rows)

    numbered = df.select("row", F.monotonically_increasing_id().alias("row_no"), cut(F.col(text)).alias("ps"))
    return numbered.select("row", "row_no", F.explode("ps").alias("p")).select("row", "row_no", "p.*")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand Python so many rows at a time: whole texts and their ids are large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


Run = tuple[int, int, int, int, int, int]


def best_fit_rounds(lengths: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Placement runs (length, first rank, count, first bin, per bin, offset) and the number of bins.

    Documents and gaps are kept in sorted order as runs of equal values, because
    equal ones are interchangeable: a run of documents is a count, a run of gaps
    lists the bins that have it.  One round takes the longest documents left.  Their
    sweep starts at the successor of their length among the gaps and goes up; rank
    r among the documents takes the r-th place, so no two claim the same; gaps are
    then updated and the next round begins.  A bin that still fits the length after
    one document is its own best fit, so a gap takes as many as it can at once.
    Only what no gap takes opens bins.

    State is bounded by the capacity, not by the documents: at most two runs are
    split and one opened a round, and each placement at least halves a gap, so there
    are at most 3 * capacity * log2(capacity) runs.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    runs: list[Run] = []
    bins = 0
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0

        def place(first: int, count: int, gap: int, length: int = length) -> int:
            """Fill ``count`` bins of one gap; returns how many documents they took."""
            nonlocal left, rank
            fit = gap // length
            full = min(count, left // fit)
            if full:
                runs.append((length, rank, full * fit, first, fit, capacity - gap))
                gaps[gap - fit * length].append((first, full))
                left, rank = left - full * fit, rank + full * fit
            if full < count:
                if left:
                    runs.append((length, rank, left, first + full, left, capacity - gap))
                    gaps[gap - left * length].append((first + full, 1))
                    rank, left, full = rank + left, 0, full + 1
                if full < count:
                    gaps[gap].append((first + full, count - full))
            return full

        for gap in sorted(g for g in gaps if g >= length):
            if not left:
                break
            for first, count in gaps.pop(gap):
                if left:
                    place(first, count, gap)
                else:
                    gaps[gap].append((first, count))
        if left:
            opened = -(-left // (capacity // length))
            first, bins = bins, bins + opened
            place(first, opened, capacity)
        gaps.pop(0, None)
    return runs, bins


def pack(
    df: DataFrame, text: str = "text", path: str | None = None, capacity: int = 2048, end_id: int = 0, rows_per_bucket: int = 20_000
) -> DataFrame:
    """Pieces of all rows with their ids, ``sequence_id`` and ``offset``: (row, row_no, piece, start, length, ids, sequence_id, offset).

    Tokenising is one pass whose result is kept.  Documents that agree in length
    are counted, at most ``capacity`` counts plan the packing
    (``best_fit_rounds``), and each piece finds its place in the plan by its rank
    among pieces of its length.  Ranks are taken in hashed buckets with prefix sums
    over them, so a length that most documents share is many tasks; only lengths
    and numbers go through them, and the ids join the places at the end.

    A null text is empty and gives the one id ``end_id``; repeated rows are packed
    each for itself, ``row_no`` tells them apart; ties in length go by a hash of the
    piece; an empty table gives an empty result; other columns are carried as they
    are (``row``), whatever their names.
    """
    spark = df.sparkSession
    path = path or tokenizer_path()
    kept = [c for c in df.columns if c != text]
    rows = df.select(F.struct(*kept).alias("row") if kept else F.struct(F.lit(None).alias("_")).alias("row"), F.col(text).alias("t"))
    with arrow_batches(spark, 512):
        kept_pieces = materialized(cut_pieces(rows, "t", path, capacity, end_id), "pieces")
    pieces = kept_pieces.select("row_no", "piece", "length")
    totals = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = best_fit_rounds(totals, capacity)
    plan = spark.createDataFrame(runs or [(0, 0, 0, 0, 1, 0)], "length long, rank0 long, n long, bin0 long, per_bin long, base long")

    buckets = max(-(-sum(totals.values()) // rows_per_bucket), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("h", F.xxhash64("row_no", "piece")).withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    counts = salted.groupBy("length", "bucket").agg(F.count("*").alias("c"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("h")) - 1
    ranked = salted.withColumn("rank", inside).join(offsets, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    # at most 3 * capacity * log2(capacity) rows whatever the input
    placed = ranked.join(F.broadcast(plan), "length").filter((F.col("rank") >= F.col("rank0")) & (F.col("rank") < F.col("rank0") + F.col("n")))
    nth = F.col("rank") - F.col("rank0")
    places = placed.select(
        "row_no", "piece",
        (F.col("bin0") + F.call_function("div", nth, F.col("per_bin"))).alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("per_bin")) * F.col("length")).alias("offset"),
    )
    return kept_pieces.join(places, ["row_no", "piece"]).select("row", "row_no", "piece", "start", "length", "ids", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): every sequence with the ids of its pieces in their order.

    A sequence holds at most ``capacity`` tokens, so it may be put together in one place.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda s, p: F.concat(s, p["ids"]))
    return whole.select("sequence_id", "n_tokens", ids.alias("ids"))


def write_sequences(packed: DataFrame, path: str) -> None:
    """Training sequences as Parquet, in the order of their numbers within and across files."""
    sequences(packed).repartitionByRange("sequence_id").sortWithinPartitions("sequence_id").write.parquet(path)
