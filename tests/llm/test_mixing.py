import re
from collections import defaultdict

from pyspark.sql import functions as F

from corpusloom.llm import mixing as M
from corpusloom.llm.queries import QUERIES

WORD = re.compile(r"[^ \t-\r]+")


def naive_targets(sizes, cap=3, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return held | share
        held |= {s: cap * sizes[s] for s in over}


def naive_quotas(targets, block):
    v = {s: t / block for s, t in targets.items()}
    seats = int(sum(v.values()) + 0.5)
    q = dict.fromkeys(v, 0)
    for _ in range(seats):
        best = max(v, key=lambda s: v[s] / (2 * q[s] + 1))
        q[best] += 1
    return q


def check(rows, block):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    want = naive_targets(sizes)
    for s in sizes:
        assert abs(want[s] - target[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= block, s
    return sizes, taken


def test_query_rows(spark, sf, docs):
    rows = QUERIES["op7_mixing"](spark, sf).collect()
    sources = {d: s for d, _, s in docs}
    size = {d: len(WORD.findall(t)) for d, t, _ in docs}
    assert {r.doc_id: r.size for r in rows} == size

    class Row:
        def __init__(self, r):
            self.source, self.size, self.taken, self.target = sources[r.doc_id], r.size, r.taken, r.target

    sizes, _ = check([Row(r) for r in rows], 16)
    assert all(r.source_size == sizes[sources[r.doc_id]] for r in rows)
    again = QUERIES["op7_mixing"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_caps_and_quotas(spark):
    sizes = {"a": 10, "b": 100_000, "c": 0, "Z": 700, "é": 5000, None: 60, "d": 33}
    rows = [(i, s, n // 4 + (i % 4 < n % 4)) for s, n in sizes.items() for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    got = M.mix_plan(df, "source", F.col("n"), [F.col("doc_id"), F.col("source")], block=16).collect()
    check(got, 16)
    sources = spark.createDataFrame([(i, float(t)) for i, t in enumerate([5.5, 21.5, 33.5, 8.4, 7.6, 0.0])], "ordinal int, target double")
    q = {r.ordinal: r.quota for r in M.sainte_lague(sources, 3).collect()}
    assert q == naive_quotas(dict(enumerate([5.5, 21.5, 33.5, 8.4, 7.6, 0.0])), 3)


def test_quotas_off_both_ways(spark):
    for targets in ([1.5] * 9, [1.4] * 9, [2.5, 2.5, 2.5, 0.4], [0.45] * 20, [7.49, 7.49, 7.49, 7.49]):
        sources = spark.createDataFrame([(i, float(t)) for i, t in enumerate(targets)], "ordinal int, target double")
        q = {r.ordinal: r.quota for r in M.sainte_lague(sources, 1).collect()}
        assert q == naive_quotas(dict(enumerate(targets)), 1), targets


def naive_shards(targets, block, shards):
    """Quotas per shard from the whole list of seats in the order they are dealt."""
    v = {s: t / block for s, t in targets.items()}
    q, order = dict.fromkeys(v, 0), []
    for _ in range(int(sum(v.values()) + 0.5)):
        best = max(v, key=lambda s: v[s] / (2 * q[s] + 1))
        q[best] += 1
        order.append(best)
    cuts = [len(order) * k // shards for k in range(shards + 1)]
    return {(s, k): order[cuts[k] : cuts[k + 1]].count(s) for s in v for k in range(shards)}


def test_quotas_per_shard(spark):
    for targets, shards in (([5.5, 21.5, 33.5, 8.4, 7.6, 0.0], 4), ([1.5] * 9, 5), ([700.3, 11.1, 0.2, 90.0], 16), ([0.0, 0.0], 3), ([2.0], 7)):
        sources = spark.createDataFrame([(i, float(t)) for i, t in enumerate(targets)], "ordinal int, target double")
        rows = M.shard_quotas(sources, 1, shards).collect()
        assert {(r.ordinal, r.shard): r.quota for r in rows} == naive_shards(dict(enumerate(targets)), 1, shards), targets


def test_shards_take_their_quotas(spark):
    rows = [(i, "abc"[i % 3 if i < 90 else 0], " ".join(f"{i}.{w}" for w in range(i % 17))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = M.mix_plan(docs, "source", M.word_count(F.col("text")), [F.col("doc_id")], block=4, shards=5).collect()
    assert all(len(r.shard_words) == 5 and sum(r.shard_words) == r.taken for r in plan)
    sizes = {s: sum(r.size for r in plan if r.source == s) for s in "abc"}
    want = naive_shards(naive_targets(sizes), 4, 5)
    for s in "abc":
        limit, done = 3 * sizes[s], 0
        for k in range(5):
            words = min(4 * want[s, k], limit - done)
            assert sum(r.shard_words[k] for r in plan if r.source == s) == words
            done += words
    out = M.mixed_documents(docs, ["doc_id"], "to", block=4, shards=5).collect()
    got, need = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.text in dict((d, t) for d, _, t in rows)[r.doc_id]
        got[r.doc_id, r.to] += len(WORD.findall(r.text))
    for r in plan:
        for k, n in enumerate(r.shard_words):
            need[r.doc_id, k] += n
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in need.items() if n}
    # shards change where words go, not which are taken
    plain = M.mix_plan(docs, "source", M.word_count(F.col("text")), [F.col("doc_id")], block=4).collect()
    assert {r.doc_id: r.taken for r in plain} == {r.doc_id: r.taken for r in plan}


def test_documents_carry_what_the_plan_takes(spark, weird):
    plan = M.mix_plan(weird.withColumn("size", F.lit("clash")), "source", M.word_count(F.col("text")), [F.col("doc_id"), F.col("text")]).collect()
    out = M.mixed_documents(weird, ["doc_id", "text"]).collect()
    words = lambda rows: sum(len(WORD.findall(r.text or "")) for r in rows)
    assert words(out) == sum(r.taken for r in plan)
    assert all(r.n_chars == len(r.text) for r in out if r.text and r.doc_id == 5)


def test_slice(spark):
    df = spark.createDataFrame([("  a\nb  c d ",)], "t string")
    got = df.select(M.word_slice(F.col("t"), F.lit(1), F.lit(3)).alias("x"), M.word_slice(F.col("t"), F.lit(0), F.lit(4)).alias("y")).first()
    assert got.x == "b  c" and got.y == "a\nb  c d"


def test_nothing(spark, nothing):
    assert M.mix_plan(nothing, "source", M.word_count(F.col("text")), [F.col("doc_id")]).count() == 0
    assert M.mixed_documents(nothing, ["doc_id"]).count() == 0
