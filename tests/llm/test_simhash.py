import random
import re

import pytest
import xxhash

from corpusloom.llm import simhash as S
from corpusloom.llm.queries import QUERIES


def naive(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^ \t-\r]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=3):
    """id -> smallest id reachable, brute force."""
    ids, low = list(prints), {i: i for i in prints}
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if bin(prints[a] ^ prints[b]).count("1") <= bits]
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if (low[a], low[b]) != (m, m):
                low[a] = low[b] = m
                changed = True
    return low


def test_query(spark, sf, docs):
    rows = QUERIES["op10_simhash_dedup"](spark, sf).collect()
    prints = {d: naive(t) for d, t, _ in docs}
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == components(prints)


def test_no_pair_is_lost(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.append(base)
        for n in (0, 1, 2, 3, 3, 4, 5):
            p = prints[-1] if rng.random() < 0.3 else base
            for b in rng.sample(range(64), n):
                p ^= 1 << b
            prints.append(p)
    prints += [0, 7, (1 << 64) - 1, 1 << 63, 0xAAAAAAAAAAAAAAAA]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for bits in (3, 1):
        want = components({s: p for s, p in zip(signed, prints, strict=True)}, bits)
        got = S.fingerprint_components(spark.createDataFrame([(s,) for s in set(signed)], "fp long"), bits).collect()
        found = {s: s for s in signed} | {r.key: r.comp for r in got}
        assert found == want


def test_code_is_a_lower_bound(spark):
    rng = random.Random(5)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", S.popcount_code(S.F.col("a")).alias("x"), S.popcount_code(S.F.col("b")).alias("y"))
    for r in df.collect():
        count = lambda v: [bin(v >> i & 3).count("1") for i in range(0, 64, 2)]
        manhattan = sum(abs(p - q) for p, q in zip(count(r.a), count(r.b), strict=True))
        assert bin((r.x ^ r.y) & (2**64 - 1)).count("1") == manhattan <= bin(r.a ^ r.b).count("1")


def test_edges(spark, weird, nothing):
    rows = S.near_duplicates(weird.withColumnRenamed("lang", "fingerprint")).collect()
    assert len(rows) == 11
    wordless = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in wordless} == {1} and len(wordless) == 4
    assert {r.component_id for r in rows if r.text == "one"} == {3}
    assert [r.component_id for r in rows if r.text == "two words"] == [None]
    kept = S.drop_near_duplicates(weird)
    assert kept.columns == weird.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 5), (False, 6), (False, 8), (True, 0)]
    assert S.near_duplicates(nothing).count() == 0 and S.drop_near_duplicates(nothing).count() == 0


def test_reach_is_bounded(spark):
    with pytest.raises(ValueError):
        S.fingerprint_components(spark.createDataFrame([(1,)], "fp long"), 4)


def test_long_text_in_parts():
    rng = random.Random(9)
    text = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 999)) for _ in range(40_000))
    assert S.text_fingerprint(text) == naive(text) - (1 << 64) * (naive(text) >> 63)


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    """Spark sizes the cells around a fingerprint as one row, and would send all of them through the driver."""
    rng, plans = random.Random(3), {}

    def noted(df, label, run=S.materialized):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return run(df, label)

    monkeypatch.setattr(S, "materialized", noted)
    classes = spark.createDataFrame([(rng.getrandbits(63),) for _ in range(50)], "fp long")
    assert S.fingerprint_components(classes).count() == 0
    for label in ("simhash-star", "simhash-bridges"):
        assert "SortMergeJoin" in plans[label] and "BroadcastHashJoin" not in plans[label]
