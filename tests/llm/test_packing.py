import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from corpusloom.llm import packing as P
from corpusloom.llm.queries import QUERIES


def whole_ids(text):
    return Tokenizer.from_file(P.tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def verify(rows, capacity=2048):
    seqs = {}
    for r in rows:
        assert 0 < r.length <= capacity
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_query(spark, sf, docs):
    rows = QUERIES["op5_packing"](spark, sf).collect()
    tok = Tokenizer.from_file(P.tokenizer_path())
    want = {}
    for d, t, _ in docs:
        ids = np.asarray(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[d, k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    used = verify(rows)
    assert used <= -(-sum(w[1] for w in want.values()) // 2048) + 1


def test_ids_by_parts_are_ids_of_the_whole():
    words = P.WordIds(P.tokenizer_path())
    rng = random.Random(4)
    alphabet = "ab 'stveÉéß\n\t\u00a0\u3000\u2028\x1c.,-_1२Σσς\u0301İ中😀<|endoftext|>"
    for _ in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(words.text(text), "<u4").tolist() == words.encode(text, add_special_tokens=False).ids, repr(text)
    latin = "".join(chr(c) for c in range(0x20, 0x180))
    for _ in range(2000):
        text = "".join(rng.choice(latin) for _ in range(rng.randint(0, 12))) + rng.choice(["", ".", " "]) + "".join(rng.choice("aeßéñťŉĳ ,") for _ in range(9))
        assert np.frombuffer(words.text(text), "<u4").tolist() == words.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("ΑΣ ΑΣ", "É, È. ÀB!? c'S. it's, $x$ a,b. (x) «y». 3. ½. e\u0301, ...", "<|ENDOFTEXT|> <|endoftext|>.", "İ. I.", "a<|endoftext|> b", "it's DON'T  x", " lead trail ", "a" * 500):
        assert np.frombuffer(words.text(text), "<u4").tolist() == words.encode(text, add_special_tokens=False).ids


def test_rounds_are_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(200):
        cap = rng.choice([7, 20, 64])
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs, bins = P.best_fit_rounds(counts, cap)
        gaps = []
        for n in sorted(lengths, reverse=True):
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - n)
            else:
                gaps.append(cap - n)
        assert bins == len(gaps)
        full = [0] * bins
        ranks = {n: [] for n in counts}
        for n, rank, count, first, per, offset in runs:
            for i in range(count):
                ranks[n].append(rank + i)
                assert full[first + i // per] == offset + i % per * n
                full[first + i // per] += n
        assert all(sorted(v) == list(range(counts[n])) for n, v in ranks.items())
        assert sorted(cap - f for f in full) == sorted(gaps)


def test_sequences_are_rebuilt_and_read_as_text(spark, docs, tmp_path):
    rows = docs[:60] + docs[:5] + [(9_999, None, "x"), (9_998, "word " * 700, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    packed = P.pack(df, capacity=256).cache()
    P.write_sequences(packed, str(tmp_path / "sequences"))
    stored = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in spark.read.parquet(str(tmp_path / "sequences")).collect()}
    assert all(len(v) <= 256 for v in stored.values()) and sum(map(len, stored.values())) == packed.agg({"length": "sum"}).first()[0]
    texts: dict = {}
    for r in sorted(packed.collect(), key=lambda r: (r.row_no, r.piece)):
        part = stored[r.sequence_id][r.offset : r.offset + r.length]
        assert part.tobytes() == bytes(r.ids) and r.start == r.piece * 256
        texts.setdefault((r.row_no, r.row.doc_id), []).extend(part.tolist())
    tok = Tokenizer.from_file(P.tokenizer_path())
    assert sorted((d, ids) for (_, d), ids in texts.items()) == sorted((d, [*whole_ids(t), 0]) for d, t, _ in rows)
    long = texts[next(k for k in texts if k[1] == 9_998)][:-1]
    assert "".join(map(tok.id_to_token, long)).replace("</w>", " ").split() == ["word"] * 700


def test_edges(spark, weird, nothing):
    rows = P.pack(weird.withColumnRenamed("lang", "length"), capacity=256).collect()
    verify(rows, 256)
    by = {}
    for r in rows:
        by.setdefault((r.row.doc_id, r.row.source), []).append(r)
    assert by[1, None][0].length == 1 and by[2, "a"][0].length == 1
    long = sorted(by[5, "b"], key=lambda r: r.piece)
    assert [r.start for r in long] == [i * 256 for i in range(len(long))] and all(r.length == 256 for r in long[:-1])
    assert sum(r.length for r in long) == 60_001
    assert len(by[3, "a"]) == 2
    assert P.pack(nothing).count() == 0
