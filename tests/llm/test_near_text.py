import random

import corpus_pipeline as C
from corpusloom.llm import near_text as N
from corpusloom.llm import simhash as S


def shingles(text, n=5):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def edited(rng, words, least, most):
    """A copy whose similarity lies in [least, most)."""
    while True:
        out = list(words)
        for _ in range(rng.randint(1, len(words) // 8)):
            out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
        if least <= jaccard(" ".join(words), " ".join(out)) < most:
            return " ".join(out)


def test_planted_pairs(spark):
    """Of these 90 pairs at 0.8 to 0.95, 17 have SimHash fingerprints within 3 bits."""
    rng = random.Random(6)
    rows, near, far = [], [], []
    for i in range(120):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([64, 120, 250]))]
        lo, hi = [(0.8, 0.85), (0.85, 0.9), (0.9, 0.951), (0.5, 0.75)][i % 4]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, edited(rng, words, lo, hi))]
        (far if i % 4 == 3 else near).append(2 * i + 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in C.drop_near_duplicates(spark, docs, "").collect()}
    assert set(range(0, 240, 2)) <= kept and set(far) <= kept
    assert not kept & set(near)


def test_crowds_and_chains_in_blocks(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(100)]
    texts = [" ".join(words)]
    for k in range(60):
        copy = list(words)
        copy[rng.randrange(100)] = f"a{k}"
        copy[rng.randrange(100)] = f"b{k}"
        texts.append(" ".join(copy))
    low = list(range(len(texts)))
    links = [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in N.drop_near_copies(docs, block_rows=8).collect()} == set(low)


def test_edges(spark, weird, nothing):
    kept = N.drop_near_copies(weird)
    assert kept.columns == weird.columns and N.drop_near_copies(nothing).count() == 0
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 5), (False, 6), (False, 8), (True, 0)]


def test_simhash_links_of_the_stage(spark):
    """Fingerprints that are near link texts whose shingle sets are far apart; min-hash links those beyond 3 bits."""
    rng = random.Random(8)
    tail = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    phrase, common = "one two three four five six seven".split() * 60, tail(300)
    texts = [phrase + tail(60), phrase + tail(60), common, common[:50] + tail(5) + common[55:], tail(80)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert jaccard(rows[0][1], rows[1][1]) < 0.2 and jaccard(rows[2][1], rows[3][1]) >= 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in S.near_duplicates(docs.filter("doc_id <> 3")).collect()} == {0: 0, 1: 0, 2: 2, 4: 4}
    assert {r.doc_id for r in C.drop_near_duplicates(spark, docs, "").collect()} == {0, 2, 4}


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    """Bands and block visits are many times the rows that Spark sizes them by; no join may send them through the driver."""
    rng, plans = random.Random(4), {}

    def noted(df, label, run=N.materialized):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return run(df, label)

    monkeypatch.setattr(N, "materialized", noted)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[:30] + rng.sample(words, 3))) for i in range(12)]
    assert N.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).count() < 12
    for label in ("near-cells", "near-bridges"):
        joins = [x for x in plans[label].splitlines() if "HashJoin" in x or "SortMergeJoin" in x]
        assert joins and "SortMergeJoin" in joins[0], (label, joins)
