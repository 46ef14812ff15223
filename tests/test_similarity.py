import itertools
import random

import numpy as np
import pytest

from corpusloom.operators import ranking as K
from corpusloom.operators import similarity as S


def grams(text):
    t = text.lower().split()
    return {tuple(t[i : i + 3]) for i in range(len(t) - 2)}


def jac(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.fixture(scope="module")
def corpus(spark):
    """One group holds most rows and many copies; a frequent phrase occurs in every row of it."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(160):
        group = "hot" if i < 110 else f"g{i % 5}"
        body = "one two three four " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        rows.append((i, group, "same text as all copies here" if i % 4 == 0 else body))
    rows += [(900, "lonely", "only one row here"), (901, "hot", ""), (902, "hot", ""), (903, "hot", "a b")]
    return rows


def brute(rows):
    out = {}
    for i, g, t in rows:
        out[i] = max([jac(grams(t), grams(u)) for j, h, u in rows if h == g and j != i], default=0.0)
    return out


@pytest.mark.parametrize("kw", [{}, {"direct_rows": 0}, {"direct_rows": 0, "rare": 1, "block_rows": 8}, {"direct_rows": 0, "rare": 4, "block_rows": 8}, {"block_rows": 8}])
def test_max_peer_matches_brute_force(spark, corpus, kw):
    df = spark.createDataFrame(corpus, "id long, grp string, text string").repartition(3)
    got = {r["id"]: r["sim"] for r in S.max_peer_similarity(df, "id", "grp", "text", **kw).collect()}
    want = brute(corpus)
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-12 for i in want)
    assert all(0.0 <= v <= 1.0 for v in got.values())


def best_by_lists(texts):
    """Largest Jaccard of each set of three-word shingles to another one, from full posting lists."""
    ids = {}
    sets = [np.array(sorted({ids.setdefault(g, len(ids)) for g in grams(t)}), dtype=np.int64) for t in texts]
    size = np.array([len(s) for s in sets])
    rows, values = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    lists = np.split(rows[order], np.cumsum(np.bincount(values))[:-1])
    best = np.zeros(len(sets))
    for i, s in enumerate(sets):
        if len(s):
            both = np.bincount(np.concatenate([lists[v] for v in s]), minlength=len(sets))
            both[i] = 0
            best[i] = (both / np.maximum(size[i] + size - both, 1)).max()
    return best


def test_max_peer_of_a_group_of_20000_rows(spark, monkeypatch):
    """Frequent phrases leave rows open; they visit few of the cells, and the result is that of all pairs."""
    rng = random.Random(11)
    phrases = [" ".join(f"p{k}x{j}" for j in range(rng.randint(4, 9))) for k in range(40)]
    rows = []
    for i in range(20_000):
        own = " ".join(f"w{rng.randrange(400_000)}" for _ in range(rng.choice([0, 2, 5, 10, 20, 40, 80])))
        rows.append((i, "hot", " ".join(rng.sample(phrases, rng.choice([0, 1, 1, 2]))) + " " + own))
    seen, write = {}, S.materialized

    def kept(part, label):
        stored = write(part, label)
        seen.setdefault(label, []).append(stored)
        return stored

    monkeypatch.setattr(S, "materialized", kept)
    df = spark.createDataFrame(rows, "id long, grp string, text string").repartition(8)
    got = {r.id: r.sim for r in S.max_peer_similarity(df, "id", "grp", "text").collect()}
    want = best_by_lists([t for _, _, t in rows])
    assert len(got) == len(rows) and max(abs(got[i] - want[i]) for i in got) < 1e-12
    cells = S.with_cells(seen["frequent"][0]).groupBy("c_f", "c_n").count()
    rounds = [v.join(cells, ["c_f", "c_n"]).agg({"count": "sum"}).first()[0] or 0 for v in seen["visits"]]
    probes, classes = seen["gains"][0].select("key").distinct().count(), seen["classes"][0].count()
    print(f"open probes {probes}, comparisons {rounds}, {probes * classes} with every block visited")
    assert len(rounds) == 2 and 0 < sum(rounds) < 0.5 * probes * classes


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_scan_carries_shared_shingles_a_bounded_number_of_times(spark, corpus, monkeypatch, blocks):
    """Shingles of one class are not carried, and no row goes to more than ``_SCAN_BLOCKS`` units, however small blocks are."""
    carried, plain = [], S.map_groups

    def seen(df, keys, kernel, schema):
        carried.append(df.groupBy("key").count().agg({"count": "max"}).first()[0])
        return plain(df, keys, kernel, schema)

    monkeypatch.setattr(S, "map_groups", seen)
    monkeypatch.setattr(S, "_SCAN_ROWS", 1)
    monkeypatch.setattr(S, "_SCAN_BLOCKS", blocks)
    monkeypatch.setattr(S, "_SLICE_CELLS", 40)
    df = spark.createDataFrame(corpus, "id long, grp string, text string").repartition(3)
    got = {r["id"]: r["sim"] for r in S.max_peer_similarity(df, "id", "grp", "text").collect()}
    want = brute(corpus)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)
    assert carried == [blocks]


def test_peer_profile_matches_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, "id long, grp string, text string")
    for block in (8, 512):
        got = {r["grp"]: r for r in S.peer_profile(df, "id", "grp", "text", tokens="space", block_rows=block).collect()}
        for g in {r[1] for r in corpus}:
            texts = [grams(t) for _, h, t in corpus if h == g]
            n = len(texts)
            sims = [[jac(a, b) for j, b in enumerate(texts) if j != i] for i, a in enumerate(texts)]
            mx = sorted(max(s, default=0.0) for s in sims)
            mn = sorted(sum(s) / (n - 1) if n > 1 else 0.0 for s in sims)
            r = got[g]
            assert r["n_pairs"] == n * (n - 1) // 2
            assert abs(r["max_peer_mean"] - sum(mx) / n) < 1e-7
            assert abs(r["mean_peer_mean"] - sum(mn) / n) < 1e-7
            assert abs(r["max_peer_p90"] - mx[min(n - 1, int(n * 0.9))]) < 1e-7
            assert abs(r["mean_peer_p50"] - mn[n // 2]) < 1e-7


def test_peer_mean_estimate_is_within_its_error(spark, corpus):
    df = spark.createDataFrame(corpus, "id long, grp string, text string")
    for r in S.peer_mean_estimate(df, "id", "grp", "text", tokens="space").collect():
        texts = [grams(t) for _, h, t in corpus if h == r["grp"]]
        pairs = [jac(a, b) for i, a in enumerate(texts) for b in texts[:i]]
        exact = sum(pairs) / len(pairs) if pairs else 0.0
        assert r["rows"] == len(texts) and abs(r["mean_similarity"] - exact) <= 5 * r["standard_error"] + 1e-9


def test_near_duplicates_groups_chains_and_copies(spark):
    base = "the quick brown fox jumps over the lazy dog while the cat sleeps on the warm window sill all day long "
    rows = [(i, base * 3, 1.0) for i in range(40)]  # copies
    rows += [(100, base * 3 + "and more", 5.0), (101, base * 3 + "and more again", 2.0)]
    rows += [(200, "something entirely different about boats and harbours in the north", 1.0), (300, "", 1.0), (301, "", 1.0)]
    df = spark.createDataFrame(rows, "id long, text string, score double")
    got = {r["id"]: (r["keep_id"], r["members"]) for r in S.near_duplicates(df, "id", "text", "score").collect()}
    assert all(got[i] == (100, 42) for i in list(range(40)) + [100, 101])
    assert got[200] == (200, 1)
    assert got[300] == (300, 2) and got[301] == (300, 2)  # no shingle: equal empty sets


def test_connected_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)] + [(500, k) for k in range(501, 540)]
    df = spark.createDataFrame([(min(e), max(e)) for e in edges], "a long, b long")
    got = {r["key"]: r["comp"] for r in S.connected_components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}


def test_floor_quantiles_on_integer_boundaries(spark):
    rows = [("a", float(v)) for v in range(100)] + [("b", 7.0)] * 10 + [("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for buckets in (1, 16):
        got = {r["g"]: (r["p10"], r["p50"], r["p100"]) for r in K.floor_quantiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p100": 1.0}, buckets=buckets).collect()}
        assert got == {"a": (10.0, 50.0, 99.0), "b": (7.0, 7.0, 7.0), "c": (1.0, 1.0, 1.0)}


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_running_index_and_forward_fill_do_not_depend_on_ranges(spark, span):
    rows = [("hot" if i % 10 else "cold", i * 3, None if i % 4 else f"v{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "g string, k long, v string").repartition(5)
    got = sorted((r["g"], r["k"], r["idx"]) for r in K.running_index(df, ["g"], "k", ranges=span).collect())
    want = []
    for g in ("cold", "hot"):
        ks = sorted(k for h, k, _ in rows if h == g)
        want += [(g, k, i + 1) for i, k in enumerate(ks)]
    assert got == want
    filled = {r["k"]: r["v"] for r in K.forward_fill(df, "k", "v", ranges=span).collect()}
    assert all(filled[i * 3] == f"v{i // 4 * 4}" for i in range(100))


def test_result_is_independent_of_partition_count(spark, corpus):
    df = spark.createDataFrame(corpus, "id long, grp string, text string")
    a = sorted(map(tuple, S.max_peer_similarity(df.repartition(1), "id", "grp", "text").collect()))
    b = sorted(map(tuple, S.max_peer_similarity(df.repartition(7), "id", "grp", "text").collect()))
    assert a == b
    assert len(list(itertools.groupby(a))) == len(corpus)


@pytest.mark.parametrize("dense_from", [0, 10**9])
def test_overlap_matrix_chunks(monkeypatch, dense_from):
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(S, "_MATCH_CHUNK", 3)
    monkeypatch.setattr(S, "_DENSE_FROM", dense_from)
    monkeypatch.setattr(S, "_DENSE_COLUMNS", 2)
    a = pd.Series([np.array([1, 2, 3]), np.array([], dtype=np.int64), np.array([3, 9])])
    b = pd.Series([np.array([2, 3, 9]), np.array([5])])
    assert S.overlap_matrix(a, b).tolist() == [[2, 0], [0, 0], [2, 0]]
    rng = np.random.default_rng(0)
    left = pd.Series([np.unique(rng.integers(-50, 50, 30)) for _ in range(9)])
    right = pd.Series([np.unique(rng.integers(-50, 50, 30)) for _ in range(7)])
    want = [[len(set(x) & set(y)) for y in right] for x in left]
    assert S.overlap_matrix(left, right).tolist() == want


def char_grams(t):
    return {t[i : i + 3] for i in range(len(t) - 2)}


@pytest.mark.parametrize("block_rows", [4, 256])
def test_crowded_cells_match_brute_force(spark, block_rows):
    """Many near-copies of two long texts, bridged and not, in blocks far smaller than the crowd."""
    rng = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyz "
    seeds = ["".join(rng.choice(alphabet) for _ in range(900)) for _ in range(3)]
    rows = []
    for i in range(60):
        t = list(" ".join(seeds[i % 3].split()))
        for _ in range(rng.randint(0, 14)):
            t[rng.randrange(len(t))] = rng.choice(alphabet.strip())
        rows.append((i, " ".join("".join(t).split()), 0.0))
    df = spark.createDataFrame(rows, "id long, text string, score double")
    got = {r["id"]: r["keep_id"] for r in S.near_duplicates(df, "id", "text", "score", block_rows=block_rows).collect()}
    sets = {i: char_grams(t) for i, t, _ in rows}
    comp = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if comp[a] != comp[b] and jac(sets[a], sets[b]) >= 0.85:
                low, high = sorted((comp[a], comp[b]))
                comp = {k: low if v == high else v for k, v in comp.items()}
    assert got == comp


def greedy(order, near):
    kept: list = []
    for i in order:
        if not any(near(i, k) for k in kept):
            kept.append(i)
    return set(kept)


@pytest.mark.parametrize("kw", [{}, {"block_rows": 4, "least_share": 1.0}])
def test_greedy_keeps_what_a_walk_in_order_keeps(spark, kw):
    """Chains whose ends are far apart, crowds, copies and equal scores."""
    rng = random.Random(13)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for seed in range(4):
        t = [rng.choice(alphabet) for _ in range(400)]
        for step in range(25):  # each link changes little, the chain drifts away
            rows.append((len(rows), "".join(t), float(rng.randint(0, 3))))
            for _ in range(6 if seed % 2 else 2):
                t[rng.randrange(len(t))] = rng.choice(alphabet)
    rows += [(len(rows) + i, rows[3][1], 2.0) for i in range(5)] + [(900, "", 1.0), (901, "ab", 3.0), (902, None, None), (903, "quite another text", None)]
    df = spark.createDataFrame(rows, "id long, text string, score double").repartition(3)
    got = {r["id"]: r for r in S_greedy(df, **kw)}
    sets = {i: char_grams(t or "") for i, t, _ in rows}
    order = [i for i, _, _ in sorted(rows, key=lambda r: (-(r[2] or 0.0), r[0]))]
    near = lambda a, b: sets[a] == sets[b] or jac(sets[a], sets[b]) >= 0.85
    want = greedy(order, near)
    assert {i for i, r in got.items() if r["kept"]} == want and len(got) == len(rows)
    place = {i: k for k, i in enumerate(order)}
    for i, r in got.items():
        assert r["keep_id"] in want and place[r["keep_id"]] <= place[i] and near(i, r["keep_id"])
        assert r["similarity"] == pytest.approx(jac(sets[i], sets[r["keep_id"]]) if sets[i] else 1.0)


def S_greedy(df, **kw):
    from corpusloom.operators.greedy import greedy_keep_first

    return greedy_keep_first(df, "id", "text", "score", **kw).collect()


def test_sketches_agree_as_often_as_sets_overlap():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    for size in (1, 3, 20, 400):
        pairs = []
        for _ in range(400 if size < 100 else 60):
            common = rng.integers(-(2**63), 2**63 - 1, size)
            pairs += [np.unique(np.append(common, rng.integers(-(2**63), 2**63 - 1, 1 + size // 4))), np.unique(np.append(common, rng.integers(-(2**63), 2**63 - 1, 1 + size // 4)))]
        sketch = S.one_permutation_sketches(pd.Series(pairs), 128, 7)
        agree = (sketch[::2] == sketch[1::2]).mean()
        want = np.mean([len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(pairs[::2], pairs[1::2], strict=True)])
        assert abs(agree - want) < 0.03
        assert (sketch == S.one_permutation_sketches(pd.Series(pairs), 128, 7)).all()


def test_near_cells_part_rows_that_cannot_be_near(spark):
    """Whole sets go only where sketches leave room: once for each group of near rows, whatever cells they share."""
    rng = random.Random(17)
    letters = "abcdefgh"
    rows = []
    for i in range(24):
        text = "".join(rng.choice(letters) for _ in range(900))
        rows += [(10 * i + k, text[: 700 + k] + "".join(rng.choice(letters) for _ in range(30)) + text[730 + k :]) for k in range(3)]
    sets = {i: char_grams(t) for i, t in rows}
    classes = S.char_shingles(spark.createDataFrame(rows, "id long, text string"), "id", "text").withColumnRenamed("id", "key")
    marks = S.minhash_sketches(classes)
    cells = S.near_cells(marks, 0.85, 128).collect()
    met = {}
    for r in cells:
        met.setdefault(r.grp, set()).add(r.key)
    near = {(a, b) for a in sets for b in sets if a < b and jac(sets[a], sets[b]) >= 0.85}
    assert len(near) >= 24 and all(any({a, b} <= m for m in met.values()) for a, b in near)
    plain = S.duplicate_cells(marks, 0.85)
    crowded = plain.groupBy("grp").count().filter("count > 1").agg({"count": "sum"}).first()[0]
    assert len(cells) * 2 < crowded and len({frozenset(m) for m in met.values()}) == len(met)


def test_peer_profile_carries_shared_shingles_only(spark, monkeypatch):
    """Shingles of one class alone stay behind; blocks see sets of what is shared."""
    rows = [(i, "g", " ".join(["same old words"] + [f"own{i}x{k}" for k in range(50)])) for i in range(40)]
    carried = []
    inner = S._in_block_pairs

    def spy(lists, sizes, deal=False):
        carried.append((sizes.first()["blocks"], lists.selectExpr("max(size(sh)) AS m").first()["m"]))
        return inner(lists, sizes, deal)

    monkeypatch.setattr(S, "_in_block_pairs", spy)
    got = S.peer_profile(spark.createDataFrame(rows, "id long, grp string, text string"), "id", "grp", "text", tokens="space").collect()
    sim = 1 / (2 * 51 - 1)
    assert carried == [(1, 1)]
    assert abs(got[0]["max_peer_max"] - sim) < 1e-8 and abs(got[0]["mean_peer_mean"] - sim) < 1e-8


def test_character_sets_are_exact_and_carried_small(spark):
    """Sets are what shuffles carry most of; as plain 64-bit hashes they took several times their texts."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéü", k=rng.randint(2, 9))) for _ in range(400)]
    texts = [None, "", "ab", "abc", "a😀b😀", "日本語の文章", " ".join(rng.choices(words, k=600))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for r in S.char_shingles(df, "id", "text").collect():
        text = (texts[r.id] or "").lower()
        want = {text[i : i + 3] for i in range(len(text) - 2)}
        got = S.unpack_set(bytes(r.sh)).tolist()
        assert got == sorted(got) and r.n == len(got) == len(want)
        assert {"".join(chr(x >> s & 0x1FFFFF) for s in (42, 21, 0)) for x in got} == want
    assert len(r.sh) * 3 < 8 * r.n


def test_few_pairs_fetch_few_sets(spark):
    """The sets of all classes went through a shuffle for every side of every round, however few pairs were left."""
    rows = [(i, f"text number {i} of several and a bit longer") for i in range(40)] + [(40, "text number 7 of several and a bit longer!")]
    classes = S.char_shingles(spark.createDataFrame(rows, "id long, text string"), "id", "text").withColumnRenamed("id", "key")
    classes = S.materialized(classes, "test-sets")
    n = {r.key: r.n for r in classes.collect()}
    pairs = spark.createDataFrame([(40, n[40], 7, n[7]), (40, n[40], 12, n[12] * 3)], "key long, n int, other long, other_n int")
    near = S.near_pairs(pairs, classes, 0.85)
    assert [(r.key, r.other) for r in near.collect()] == [(40, 7)] and near.first().similarity > 0.9
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi, BuildRight") >= 2, plan


def test_copies_fold_without_a_shuffle_of_sets(spark, tmp_path):
    """The sets went through a shuffle to find one row of each class, and stayed on disk to the end."""
    import os

    from corpusloom.sources import storage

    rows = [(1, "a", "one two three four"), (2, "a", "one two three four"), (3, None, "one two three four"), (4, None, "one two three four"), (5, "a", ""), (6, "b", "x y z")]
    df = spark.createDataFrame(rows, "id long, g string, text string")
    members, heads, classes, keyed = S.fold_copies(S.word_shingles(df, "id", "g", "text"))
    key = {r.id: r.key for r in members.collect()}
    assert key[1] == key[2] and key[3] == key[4] and len(set(key.values())) == 4
    assert {r.key: r.copies for r in heads.collect()} == {key[1]: 2, key[3]: 2, key[5]: 1, key[6]: 1}
    assert sorted(r.key for r in classes.collect()) == sorted(set(key.values()))
    assert "Exchange hashpartitioning" not in classes._jdf.queryExecution().executedPlan().toString()
    folder = os.path.dirname(keyed.inputFiles()[0].removeprefix("file://"))
    storage.drop_scratch(keyed)
    assert not os.path.exists(folder) and members.count() == 6
