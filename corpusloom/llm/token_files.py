"""Token ids in binary files of directly addressable codes.

File layout, little-endian, sections at multiples of eight bytes::

    magic "DACIDS01" | checksum u32 of all after it, 4 bytes zero | documents u64 | tokens u64 | levels u64
    per level: bits of a chunk u64 | entries u64 | place of chunks u64 | of the bitmap u64 | of the directory u64
    document ids i64 | bitmap of null ids | starts u64 (documents + 1, within the file)
    per level: chunks, packed | continuation bitmap | directory u64

An id is cut into chunks, lowest bits first.  Level 0 holds the lowest chunk of
every id; a bit of its continuation bitmap says that the id goes on in level 1,
at the place that is the number of such bits before it, and so on.  The directory holds that
number for every block of 512 bits, so one more chunk costs one entry of it and at most 64
bytes of the bitmap: token i is read without touching its neighbours.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.packing import loaded, tokenizer_path

MAGIC = b"DACIDS01"
_HEAD = struct.Struct("<8sIIQQQ")
_LEVEL = struct.Struct("<QQQQQ")
_BLOCK = 512
INDEX = "_index"


def chunk_widths(ids: np.ndarray, most: int = 8) -> list[int]:
    """Chunk widths, lowest first, that make the codes of ``ids`` shortest, in at most ``most`` levels.

    The size depends only on how many ids have how many bits.  A level that starts
    at bit b holds the ids of more than b bits, each with its chunk and, unless it is
    the last, a continuation bit and an eighth of one for the directory.
    """
    bits = np.bincount(np.ceil(np.log2(ids.astype(np.float64) + 1)).astype(np.int64)) if len(ids) else np.array([0, 1])
    top = max(len(bits) - 1, 1)
    more = [int(bits[b + 1 :].sum()) if b else int(bits.sum()) for b in range(top)]
    # cost[l][b]: the cheapest codes of the bits from b on, in at most l levels
    cost: list[dict[int, tuple[float, list[int]]]] = [{top: (0.0, [])}]
    for _ in range(most):
        new: dict[int, tuple[float, list[int]]] = {top: (0.0, [])}
        for b in range(top):
            for end in range(b + 1, top + 1):
                if end in cost[-1]:
                    whole = more[b] * ((end - b) + (1.125 if end < top else 0.0)) + cost[-1][end][0]
                    if b not in new or whole < new[b][0]:
                        new[b] = (whole, [end - b, *cost[-1][end][1]])
        cost.append(new)
    return cost[-1][0][1]


def _pack(values: np.ndarray, width: int) -> bytes:
    """``width`` bits per value, lowest first."""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    planes = np.empty((len(values), width), np.uint8)
    for k in range(width):
        planes[:, k] = (values >> k) & 1
    return np.packbits(planes.reshape(-1), bitorder="little").tobytes()


def _unpack(data: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    values = np.zeros(count, np.uint32)
    for k in range(width):
        values |= planes[:, k].astype(np.uint32) << np.uint32(k)
    return values


def encode_file(doc_ids: list[int | None], documents: list[bytes]) -> bytes:
    """One file of documents, each given as its ids in unsigned 32-bit numbers."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    starts = np.zeros(len(documents) + 1, "<u8")
    starts[1:] = np.cumsum([len(d) // 4 for d in documents])
    widths = chunk_widths(ids)
    sections: list[bytes] = [
        np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
        np.packbits(np.array([i is None for i in doc_ids], bool), bitorder="little").tobytes(),
        starts.tobytes(),
    ]
    entries, rest = [], ids.astype(np.uint32)
    for k, width in enumerate(widths):
        entries.append((width, len(rest)))
        sections.append(_pack(rest & np.uint32((1 << width) - 1), width))
        last = k == len(widths) - 1
        high = np.zeros(0, np.uint32) if last else rest >> np.uint32(width)
        goes_on = high > 0
        padded = np.zeros(-(-len(goes_on) // _BLOCK) * _BLOCK, np.uint8)
        padded[: len(goes_on)] = goes_on
        ones = padded.reshape(-1, _BLOCK).sum(axis=1, dtype=np.uint64)
        sections += [np.packbits(padded, bitorder="little").tobytes(), (np.cumsum(ones) - ones).astype("<u8").tobytes()]
        rest = high[goes_on]
    at = _HEAD.size + _LEVEL.size * len(widths)
    places, body = [], []
    for s in sections:
        places.append(at)
        body.append(s + b"\0" * (-len(s) % 8))
        at += len(body[-1])
    table = b"".join(_LEVEL.pack(w, n, *places[3 + 3 * k : 6 + 3 * k]) for k, (w, n) in enumerate(entries))
    counts = struct.pack("<QQQ", len(documents), len(ids), len(widths))
    content = counts + table + b"".join(body)
    return _HEAD.pack(MAGIC, zlib.crc32(content), 0, len(documents), len(ids), len(widths)) + content[len(counts) :]


class TokenFile:
    """A file behind ``read(offset, length)``; only the head is read when it is opened."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        magic, self.checksum, _, self.documents, self.tokens, levels = _HEAD.unpack(read(0, _HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        table = read(_HEAD.size, _LEVEL.size * levels)
        self.levels = [_LEVEL.unpack_from(table, k * _LEVEL.size) for k in range(levels)]
        self.start_of_ids = _HEAD.size + _LEVEL.size * levels
        self.start_of_nulls = self.start_of_ids + 8 * self.documents
        self.start_of_starts = self.start_of_nulls + -(-(-(-self.documents // 8)) // 8) * 8

    @staticmethod
    def of(data: bytes) -> TokenFile:
        """A file in memory, its checksum verified."""
        file = TokenFile(lambda at, n: data[at : at + n])
        if zlib.crc32(memoryview(data)[16:]) != file.checksum:
            raise ValueError("a token file is damaged")
        return file

    def token(self, i: int) -> int:
        """The id at place i: one chunk a level, and one directory entry with at most 64 bytes of bitmap to the next."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = shift = 0
        for k, (width, _, chunks, bitmap, directory) in enumerate(self.levels):
            first = i * width
            part = int.from_bytes(self.read(chunks + first // 8, (first % 8 + width + 7) // 8), "little")
            value |= (part >> first % 8 & (1 << width) - 1) << shift
            if k == len(self.levels) - 1:
                break
            block, inside = divmod(i, _BLOCK)
            bits = int.from_bytes(self.read(bitmap + block * _BLOCK // 8, inside // 8 + 1), "little")
            if not bits >> inside & 1:
                break
            before = int.from_bytes(self.read(directory + 8 * block, 8), "little")
            i = before + (bits & (1 << inside) - 1).bit_count()
            shift += width
        return value

    def document(self, number: int) -> tuple[int | None, int, int]:
        """(id, start, end) of a document of the file."""
        start, end = struct.unpack("<QQ", self.read(self.start_of_starts + 8 * number, 16))
        null = self.read(self.start_of_nulls + number // 8, 1)[0] >> number % 8 & 1
        return None if null else struct.unpack("<q", self.read(self.start_of_ids + 8 * number, 8))[0], start, end

    def all_documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, null flags, starts) of all documents."""
        n = self.documents
        nulls = np.unpackbits(np.frombuffer(self.read(self.start_of_nulls, -(-n // 8)), np.uint8), count=n, bitorder="little").astype(bool)
        return np.frombuffer(self.read(self.start_of_ids, 8 * n), "<i8"), nulls, np.frombuffer(self.read(self.start_of_starts, 8 * n + 8), "<u8").astype(np.int64)

    def all_tokens(self) -> np.ndarray:
        """All ids, level by level."""
        values = np.zeros(self.tokens, np.uint32)
        at, shift = np.arange(self.tokens), 0
        for k, (width, count, chunks, bitmap, _) in enumerate(self.levels):
            values[at] |= _unpack(self.read(chunks, -(-count * width // 8)), count, width) << np.uint32(shift)
            if k < len(self.levels) - 1:
                more = np.unpackbits(np.frombuffer(self.read(bitmap, -(-count // 8)), np.uint8), count=count, bitorder="little")
                at, shift = at[more.astype(bool)], shift + width
        return values


def _store(folder: str):
    """(file system, path) of a folder named by a path or a URI; opened by the tasks that write."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


_WRITTEN = "part int, seq int, file string, documents long, tokens long"


def write_tokens(
    df: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = 2, file_tokens: int = 1 << 21
) -> DataFrame:
    """Write the token ids of all texts in ascending order of ``doc_id``; returns the index: file, documents, tokens, first.

    Each document is its ids and ``end_id``.  Rows are range-partitioned by id and by
    their place in the input, sorted, tokenised and written by one task per range,
    a file for every ``file_tokens`` tokens or so, so a task holds one file.  A task
    names its files at random; the index, which Spark commits, names those of the
    tasks that succeeded, so a repeated task leaves no trace.  ``first`` is the number of
    tokens in all files before: a prefix sum over ranges, then within one.

    ``folder`` is a path or URI that executors can write (pyarrow's file systems), and is
    read again by Spark.  A null or empty text is the end id alone; a null id comes
    first; rows with one id, repeated rows among them, stay in the order of the input;
    a document is never cut, so a very long one makes a long file; other columns are
    not looked at; an empty table writes no file and an empty index.
    """
    path = path or tokenizer_path()
    end = np.asarray([end_id], "<u4").tobytes()
    _store(folder)  # an unknown kind of folder is an error here

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = loaded(path).text
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        seq, held_ids, held, size = 0, [], [], 0

        def flush() -> pd.DataFrame:
            nonlocal seq, held_ids, held, size
            name = f"{part:06d}-{seq:04d}-{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(encode_file(held_ids, held))
            row = pd.DataFrame({"part": [part], "seq": [seq], "file": [name], "documents": [len(held)], "tokens": [size]})
            seq, held_ids, held, size = seq + 1, [], [], 0
            return row

        for pdf in batches:
            missing = pdf["id"].isna().to_numpy()
            for i, gone, t in zip(pdf["id"], missing, pdf["t"], strict=True):
                ids = ids_of(t or "") + end
                held_ids.append(None if gone else int(i))
                held.append(ids)
                size += len(ids) // 4
                if size >= file_tokens:
                    yield flush()
        if held:
            yield flush()

    spark = df.sparkSession
    # a null id travels as a flag: pandas would turn longs with nulls into doubles
    rows = df.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"), F.monotonically_increasing_id().alias("at"))
    parts = max(df.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "i", "at").sortWithinPartitions("i", "at")
    written = ordered.select(F.col("i").cast("string").alias("id"), "t").mapInPandas(run, _WRITTEN)
    written.write.parquet(f"{folder}/{INDEX}/files")
    return token_index(spark, folder)


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """file, documents, tokens, first (tokens in the files before)."""
    files = spark.read.schema(_WRITTEN).parquet(f"{folder}/{INDEX}/files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = files.groupBy("part").agg(F.sum("tokens").alias("all"))
    ranges = ranges.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return files.join(ranges, "part").select("file", "documents", "tokens", first.alias("first"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """file, content, first of every file that the index names."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder)
    named = content.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.join(token_index(spark, folder).select("file", "first"), "file")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens, ids (unsigned 32-bit, little-endian) of every document, read from the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data, first in zip(pdf["content"], pdf["first"], strict=True):
                file = TokenFile.of(bytes(data))
                ids, nulls, starts = file.all_documents()
                raw = file.all_tokens().astype("<u4").tobytes()
                yield pd.DataFrame({
                    "doc_id": pd.arrays.IntegerArray(ids.astype(np.int64), nulls),
                    "start": starts[:-1] + first, "n_tokens": np.diff(starts),
                    "ids": [raw[4 * a : 4 * b] for a, b in zip(starts[:-1], starts[1:], strict=True)],
                })

    if token_index(spark, folder).isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    return _files(spark, folder).mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(spark: SparkSession, folder: str, places: DataFrame, place: str = "place", reach: int = 1 << 21) -> DataFrame:
    """The columns of ``places`` and ``token``: the id at each place of the whole output; null beyond its ends.

    Files are listed under every stretch of ``reach`` tokens that they touch, so a
    place meets the files of its own stretch.  Tasks read the few bytes of each
    token, not the files.  Repeated places are read once; null places have no token.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        name, file, handle = None, None, None
        for pdf in batches:
            tokens = []
            for f, i in zip(pdf["file"], pdf["inside"], strict=True):
                if f != name:
                    if handle:
                        handle.close()
                    name, handle = f, store.open_input_file(f"{base}/{f}")
                    file = TokenFile(lambda at, n, h=handle: h.read_at(n, at))
                tokens.append(file.token(int(i)))
            yield pd.DataFrame({"_place": pdf["_place"], "token": tokens})
        if handle:
            handle.close()

    step = F.lit(reach)
    index = token_index(spark, folder).filter("tokens > 0")
    stretch = F.sequence(F.call_function("div", F.col("first"), step), F.call_function("div", F.col("first") + F.col("tokens") - 1, step))
    listed = index.select("file", "first", "tokens", F.explode(stretch).alias("s"))
    wanted = places.select(F.col(place).cast("long").alias("_place")).filter("_place IS NOT NULL").distinct()
    met = wanted.withColumn("s", F.call_function("div", F.col("_place"), step)).join(listed, "s")
    met = met.filter((F.col("_place") >= F.col("first")) & (F.col("_place") < F.col("first") + F.col("tokens")))
    near = met.select("file", (F.col("_place") - F.col("first")).alias("inside"), "_place").sortWithinPartitions("file", "inside")
    found = near.mapInPandas(run, "_place long, token long")
    return places.drop("token").join(found, F.col(place) == F.col("_place"), "left").drop("_place")
