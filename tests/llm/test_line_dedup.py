import random
from collections import defaultdict

from corpusloom.llm import line_dedup as L
from corpusloom.llm.queries import QUERIES


def naive(rows, passage=50):
    """(id, text) -> edited text, all in memory."""
    docs = sorted({(d is None, d or 0, L.xxhash.xxh64_intdigest((t or "").encode()), d, t or "") for d, t in rows}, key=lambda r: r[:2])
    seen, out = {}, {}
    for *_, d, t in docs:
        lines = t.split("\n")
        size = [len(x.split()) for x in lines]
        ranges = [("chunk", a, n) for a, n in L.line_chunks(t) if (size[a] >= passage if n == 1 else sum(s > 0 for s in size[a : a + n]) > 1)]
        ranges += [("window", i, 2) for i in range(len(lines) - 1) if all(size[i : i + 2]) and not all(s >= passage for s in size[i : i + 2])]
        gone = set()
        for kind, a, n in sorted(ranges, key=lambda r: r[1]):
            own = kind, "\n".join(lines[a : a + n])
            if own in seen:
                gone |= set(range(a, a + n))
            seen.setdefault(own, d)
        for i in sorted(gone):
            if i - 1 not in gone:
                run = [i]
                while run[-1] + 1 in gone:
                    run.append(run[-1] + 1)
                if sum(size[j] for j in run) < passage:
                    gone -= set(run)
        out[d, t] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_query(spark, sf, docs):
    rows = QUERIES["op4_line_dedup"](spark, sf).collect()
    want = naive([(d, t) for d, t, _ in docs])
    assert {r.doc_id: r.text for r in rows} == {d: want[d, t] for d, t, _ in docs} and len(rows) == len(docs)
    assert sum(r.removed_lines for r in rows) > 0


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_planted_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(8)
    passage = sentence(rng, 60)
    block = [sentence(rng, 12) for _ in range(14)]
    rows, clean = [], []
    for i in range(40):
        own = [sentence(rng, rng.randint(3, 30)) for _ in range(8)]
        if i % 2:
            at = rng.randint(0, 8)
            rows.append((i, "\n".join(own[:at] + ([passage] if i % 4 == 1 else block) + own[at:])))
        else:
            clean.append(i)
            rows.append((i, "\n".join(["All rights reserved.", *own])))
    got = {r.doc_id: r for r in L.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"), length="none").collect()}
    before = dict(rows)
    assert all(got[i].text == before[i] for i in clean)
    assert [i for i in got if passage in (got[i].text or "")] == [1]
    left = [sum(line in got[i].text.split("\n") for line in block) for i in range(3, 40, 4)]
    assert left == [14] + [0] * 9


def test_short_repeats_stay_and_short_passages_go(spark):
    rng = random.Random(4)
    pair = [sentence(rng, 26), sentence(rng, 31)]
    licence = ["All rights reserved.", "Released under some licence, version 3."]
    rows = []
    for i in range(12):
        own = [sentence(rng, 20) for _ in range(5)]
        rows.append((i, "\n".join([*own[:2], *pair, *own[2:], *licence])))
    got = {r.doc_id: r.text for r in L.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in range(12) if pair[0] in got[i] or pair[1] in got[i]] == [0]
    assert all(got[i].endswith("\n".join(licence)) for i in range(12))


def test_runs_make_up_passages():
    assert L.passages([(0, [10, 20]), (1, [20, 25]), (5, [30, 10])]) == [(0, 3)]
    assert L.passages([(3, [60])]) == [(3, 1)] and L.passages([]) == []


def test_edges(spark, weird, nothing):
    two = weird.unionAll(weird.withColumn("doc_id", weird.doc_id + 100)).withColumnRenamed("lang", "removed")
    rows = L.drop_repeated_chunks(two).collect()
    assert len(rows) == 22
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[1][0].text is None and by[2][0].text == "" and by[105][0].text == "" and by[105][0].n_chars == 0
    assert by[5][0].text == "w " * 60_000 and [r.text for r in by[3]] == ["one", "one"] == [r.text for r in by[103]]
    assert by[8][0].removed == [] and L.drop_repeated_chunks(nothing).count() == 0


def test_chunks_cover_the_text():
    rng = random.Random(2)
    for _ in range(50):
        lines = [sentence(rng, rng.choice([0, 3, 60])) for _ in range(rng.randint(1, 60))]
        at = 0
        for first, n in L.line_chunks("\n".join(lines)):
            assert first == at and 0 < n <= 16
            at += n
        assert at == len(lines)


def test_equal_hash_other_bytes_stay(spark, monkeypatch):
    monkeypatch.setattr(L.xxhash, "xxh64_intdigest", lambda b: 12)
    a, b = "x " * 60, "y " * 60
    # the driver's Python only plans; what a colliding hash would do is in the join on bytes
    df = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.drop_repeated_chunks(df).collect()}
    assert got[1] == a and got[2] == b


def test_passages_with_blank_lines_and_tabs_go(spark):
    rng = random.Random(11)
    for words, paragraphs in ((20, 3), (12, 5), (30, 4)):
        passage = [sentence(rng, words) for _ in range(paragraphs)]
        rows = []
        for i in range(20):
            own = [sentence(rng, 20) for _ in range(4)]
            gap = "\n\n" if i % 3 else "\n \t\n\n"
            rows.append((i, gap.join([*own[:2], *passage, *own[2:]])))
        got = {r.doc_id: r.text for r in L.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got[0] == rows[0][1]
        left = [i for i in range(1, 20) if any(p in got[i] for p in passage)]
        assert left == []
        assert all(len(got[i].split()) == 80 for i in range(1, 20))


def test_tab_separated_lines_are_passages():
    line = "\t".join(f"w{k}" for k in range(60))
    assert L.line_chunks(f"a b\n{line}\nc d") == [(0, 1), (1, 1), (2, 1)]
    assert [r[:2] for r in L.candidate_ranges(f"\n\n{line}\n\n")] == [(0, 5)] and L.candidate_ranges("\n \n") == []
