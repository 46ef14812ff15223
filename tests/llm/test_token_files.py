import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import packing as P
from corpusloom.llm import token_files as T
from corpusloom.llm.queries import QUERIES


def whole(tok, text, end=2):
    return np.asarray([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_query(spark, sf, docs):
    rows = {r.doc_id: r for r in QUERIES["op11_token_output"](spark, sf).collect()}
    tok = Tokenizer.from_file(P.tokenizer_path())
    at = 0
    assert len(rows) == len(docs)
    for d, t, _ in sorted(docs):
        ids = whole(tok, t)
        assert tuple(rows[d]) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def id_lists():
    rng = random.Random(5)
    yield []
    yield [0] * 700
    yield [2**32 - 1, 0, 1, 2**31]
    yield [rng.randint(0, 49_407) for _ in range(5_000)]
    yield [int(rng.paretovariate(0.6)) % 49_408 for _ in range(3_000)]
    yield [rng.choice([0, 255, 256, 257, 511, 65_535, 65_536]) for _ in range(1_300)]


def test_file_gives_back_every_token():
    rng = random.Random(1)
    for ids in id_lists():
        cuts = sorted(rng.randint(0, len(ids)) for _ in range(6))
        bounds = [0, *cuts, len(ids)]
        docs = [np.asarray(ids[a:b], "<u4").tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
        names = [None if k == 2 else k - 3 for k in range(len(docs))]
        data = T.encode_file(names, docs)
        file = T.TokenFile.of(data)
        assert file.all_tokens().tolist() == ids
        assert [file.token(i) for i in range(len(ids))] == ids
        assert [file.document(k) for k in range(len(docs))] == list(zip(names, bounds, bounds[1:], strict=False))
        with pytest.raises(IndexError):
            file.token(len(ids))


def test_one_token_reads_a_few_bytes():
    ids = [int(random.Random(i).paretovariate(0.7)) % 49_408 for i in range(200_000)]
    data = T.encode_file([1], [np.asarray(ids, "<u4").tobytes()])
    assert len(data) < 0.6 * 4 * len(ids)  # smaller than plain numbers
    touched = []

    def read(at, n):
        touched.append(n)
        return data[at : at + n]

    file = T.TokenFile(read)
    for i in random.Random(2).sample(range(len(ids)), 200):
        touched.clear()
        assert file.token(i) == ids[i]
        assert sum(touched) <= len(file.levels) * (5 + 64 + 8)


def test_widths_are_the_cheapest():
    def cost(widths, ids):
        total, rest = 0.0, list(ids)
        for k, w in enumerate(widths):
            total += len(rest) * (w + (1.125 if k < len(widths) - 1 else 0))
            rest = [i >> w for i in rest if i >> w]
        assert not rest
        return total

    def splits(n):
        return [[]] if not n else [[w, *s] for w in range(1, n + 1) for s in splits(n - w)]

    for seed in range(20):
        rng = random.Random(seed)
        ids = np.array([int(rng.paretovariate(rng.choice([0.3, 0.8, 2]))) % 512 for _ in range(60)], np.uint32)
        top = max(int(ids.max()).bit_length(), 1)
        best = min(cost(s, ids.tolist()) for s in splits(top))
        assert abs(cost(T.chunk_widths(ids, 16), ids.tolist()) - best) < 1e-9


def test_damage_is_seen():
    data = bytearray(T.encode_file([1], [struct.pack("<3I", 7, 70_000, 2)]))
    data[-9] ^= 1
    with pytest.raises(ValueError):
        T.TokenFile.of(bytes(data))
    with pytest.raises(ValueError):
        T.TokenFile(lambda at, n: (b"x" * 100)[at : at + n])


def test_edges_and_random_access(spark, weird, nothing, tmp_path):
    tok = Tokenizer.from_file(P.tokenizer_path())
    df = weird.withColumnsRenamed({"lang": "start", "source": "ids"}).repartition(3)
    T.write_tokens(df, str(tmp_path / "a"), file_tokens=500)
    got = sorted(T.read_documents(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in weird.collect()), key=lambda i: (i is not None, i or 0))
    at = 0
    want: dict = {}
    for r in weird.collect():
        want.setdefault(r.doc_id, []).append(whole(tok, r.text).tobytes())
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        want[r.doc_id].remove(bytes(r.ids))
        at += r.n_tokens
    assert not any(want.values())
    everything = b"".join(bytes(r.ids) for r in got)
    index = T.token_index(spark, str(tmp_path / "a")).collect()
    assert sum(r.tokens for r in index) == at and len(index) > 3
    places = [0, 1, at - 1, at, -1, None, 7, 7, *random.Random(3).sample(range(at), 50)]
    asked = spark.createDataFrame([(p, "x") for p in places], "place long, token string")
    ids = np.frombuffer(everything, "<u4")
    answer = T.tokens_at(spark, str(tmp_path / "a"), asked, reach=500).collect()
    assert sorted(((r.place, r.token) for r in answer), key=str) == sorted(
        ((p, int(ids[p]) if p is not None and 0 <= p < at else None) for p in places), key=str
    )
    T.write_tokens(nothing, str(tmp_path / "b"))
    assert T.read_documents(spark, str(tmp_path / "b")).count() == 0


def test_a_task_that_ran_twice_leaves_no_trace(spark, docs, tmp_path):
    folder = str(tmp_path / "c")
    df = spark.createDataFrame([(d, t) for d, t, _ in docs[:40]], "doc_id long, text string")
    T.write_tokens(df, folder, file_tokens=2_000)
    with open(f"{folder}/000000-0000-lost.dac", "wb") as out:  # what a lost attempt wrote
        out.write(T.encode_file([99], [struct.pack("<2I", 5, 2)]))
    got = T.read_documents(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _, _ in docs[:40])
