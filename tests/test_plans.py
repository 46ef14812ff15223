import pytest
from pyspark.sql import functions as F

from corpusloom.operators import merging as M
from corpusloom.operators import reports as A
from corpusloom.operators import scoring as Q
from corpusloom.plans import sampling as S
from corpusloom.plans import tasks as P
from corpusloom.plans import topics as O

SCENE = "id string, idx long, source_row_id long, l1_scene string, l2_scene_raw string, l2_scene_label string, l2_scene_examples array<string>, candidates array<string>, target_count double"


def scenes(spark, targets, l1=None):
    rows = [(f"s{i}", i, i + 1, (l1 or ["L"] * len(targets))[i], f"raw{i}", f"label{i}", [], [f"a{i}", f"b{i}"], t) for i, t in enumerate(targets)]
    return spark.createDataFrame(rows, SCENE)


def counts(df):
    return [r["allocated"] for r in df.orderBy("idx").collect()]


def test_allocation_sums_to_total_and_breaks_ties_by_order(spark):
    assert counts(P.allocate(scenes(spark, [1.0, 1.0, 1.0]), 5)) == [2, 2, 1]
    got = counts(P.allocate(scenes(spark, [5.0, 3.0, 0.0, 9.0]), 101))
    assert sum(got) == 101 and got[2] == 0


def test_allocation_with_only_zero_weights_gives_one_to_the_first_rows(spark):
    assert counts(P.allocate(scenes(spark, [0.0, None, 0.0]), 2)) == [1, 1, 0]
    assert counts(P.allocate(scenes(spark, [0.0, None, 0.0]), 9)) == [1, 1, 1]
    assert counts(P.allocate(scenes(spark, [1.0, 2.0]), 0)) == [0, 0]


def test_l1_targets_are_shared_by_their_rows(spark):
    got = counts(P.allocate(scenes(spark, [10.0, 10.0, 10.0], ["A", "A", "B"]), 20, flat=False))
    assert got == [5, 5, 10]


def test_seed_counts(spark):
    df = spark.createDataFrame([(None,), (0.0,), (10.0,), (30.0,), (50.0,), (500.0,)], "t double")
    assert [r[0] for r in df.select(P.seed_count(F.col("t"))).collect()] == [3, 3, 3, 5, 8, 9]


def test_fan_out_is_whole_across_chunks(spark):
    df = spark.createDataFrame([("hot", 1000), ("one", 1), ("none", 0)], "id string, n long")
    out = P.fan_out(df, "n", chunk=64)
    assert {(r["id"], r["c"], r["m"]) for r in out.groupBy("id").agg(F.count_distinct("i").alias("c"), F.max("i").alias("m")).collect()} == {("hot", 1000, 999), ("one", 1, 0)}


def test_seed_plan_covers_all_levels_and_pads_ids(spark):
    plan = P.seed_plan(scenes(spark, [20.0])).orderBy("query_id").collect()
    assert [r["query_id"] for r in plan] == ["q_s0_001", "q_s0_002", "q_s0_003"]
    assert {r["target_complexity"] for r in plan} == {"vague", "medium", "complex"}
    assert len({r["persona_seed"] for r in plan}) == 1


def test_backfill_continues_numbers(spark):
    have = spark.createDataFrame([("s0",)] * 4, "scene_id string")
    plan = P.backfill_plan(scenes(spark, [6.0, 2.0]), have).orderBy("query_id").collect()
    assert [r["query_id"] for r in plan] == ["q_s0_005", "q_s0_006", "q_s1_001", "q_s1_002"]
    assert [r["target_complexity"] for r in plan[:2]] == ["medium", "complex"]


POOL = [("a", "t1", 0), ("a", "t2", 1), ("a", "t3", 2), ("b", "x", 0)]


def pool_of(spark):
    return spark.createDataFrame(POOL, "l2 string, topic string, pos long").withColumn("l2_pos", F.when(F.col("l2") == "a", 0).otherwise(1))


def test_least_used_first_with_cycling(spark):
    usage = spark.createDataFrame([("a", "t1", 2), ("a", "gone", 9)], "l2 string, topic string, uses long")
    want = spark.createDataFrame([("a", 5), ("b", 0)], "l2 string, k long")
    got = [(r["l2"], r["i"], r["topic"]) for r in O.pick_least_used(pool_of(spark), usage, want, chunk=2).orderBy("l2", "i").collect()]
    assert got == [("a", 0, "t2"), ("a", 1, "t3"), ("a", 2, "t1"), ("a", 3, "t2"), ("a", 4, "t3")]


def test_picks_differ_by_at_most_one_from_equal_start(spark):
    usage = spark.createDataFrame([], "l2 string, topic string, uses long")
    want = spark.createDataFrame([("a", 11)], "l2 string, k long")
    uses = [r["n"] for r in O.pick_least_used(pool_of(spark), usage, want).groupBy("topic").agg(F.count("*").alias("n")).collect()]
    assert max(uses) - min(uses) <= 1


def test_corpus_plan_falls_back_without_pool_and_counts_after_exclusion(spark):
    s = scenes(spark, [1.0, 4.0, 2.0], ["skip me", "L", "L"])
    pool = spark.createDataFrame([("label1", "topic", 0, 0)], "l2 string, topic string, pos long, l2_pos long")
    usage = spark.createDataFrame([], "l2 string, topic string, uses long")
    plan = O.corpus_plan(s, pool, usage, 6, ["skip"], flat=True).orderBy("query_id").collect()
    assert [r["query_id"] for r in plan] == ["q_s1_001", "q_s1_002", "q_s1_003", "q_s1_004", "q_s2_001", "q_s2_002"]
    assert [r["application_type"] for r in plan] == ["topic"] * 4 + ["b2", "a2"]


def test_topic_merge_is_idempotent_and_capped(spark):
    fresh = spark.createDataFrame([("a", " T1! ", 0), ("a", "new one", 1), ("a", "New  One", 2), ("a", "other", 3), ("zz", "lost", 4), ("b", "  ", 5)], "l2 string, topic string, pos long")
    pool = pool_of(spark).select("l2", "topic", "pos")
    once = O.merge_topics(pool, fresh, 4)
    assert sorted(r["topic"] for r in once.filter("origin = 'new'").collect()) == ["new one"]
    again = O.merge_topics(once.select("l2", "topic", "pos"), fresh, 4)
    assert again.filter("origin = 'new'").count() == 0
    full = O.merge_topics(pool, fresh, 1)
    assert full.count() == pool.count()


def test_match_pool_key_prefers_exact_then_first_containing(spark):
    keys = spark.createDataFrame([("① abc", 0), ("bc", 1), ("zzz long key", 2)], "k string, o long")
    s = spark.createDataFrame([("1", "② bc", "x"), ("2", "xxbcxx", "x"), ("3", "long", ""), ("4", "nope", "zzz long key"), ("5", "q", "q"), ("6", "", "w")], "id string, label string, raw string")
    got = {r["id"]: r["k"] for r in M.match_pool_key(s, keys, "id", "label", "raw", "k", "o").collect()}
    assert got == {"1": "bc", "2": "bc", "3": "zzz long key", "4": "zzz long key", "5": None, "6": "① abc"}


def test_first_scene_per_l1_fails_when_too_few(spark):
    s = scenes(spark, [1.0, 1.0, 1.0], ["A", "A", "B"])
    assert [r["id"] for r in P.first_scene_per_l1(s, [], 2).collect()] == ["s0", "s2"]
    with pytest.raises(Exception, match="too few"):
        P.first_scene_per_l1(s, [], 3).collect()


def test_merge_results_only_touches_failed_rows(spark):
    rec = spark.createDataFrame([(1, "old", None, 1, 5.0, "m"), (2, "", "TIMEOUT", 0, 5.0, "m"), (3, "", "PREP_ONLY_PENDING", 0, 5.0, "m"), (4, "", "X", 0, 5.0, "m")], "id long, query_text string, error string, word_count long, duration_ms double, generator_mode string")
    out = spark.createDataFrame([(1, "new"), (2, " a b "), (3, "c"), (4, "  ")], "id long, query_text string")
    got = {r["id"]: (r["query_text"], r["error"], r["generator_mode"], r["word_count"], r["merge_status"]) for r in M.merge_results(rec, out).collect()}
    assert got[1] == ("old", None, "m", 1, "unchanged")
    assert got[2] == ("a b", None, "subagent-retry", 2, "recovered")
    assert got[3] == ("c", None, "subagent-prep-only", 1, "recovered")
    assert got[4] == ("", "X", "m", 0, "still_failed")
    again = M.merge_results(M.merge_results(rec, out), out)
    assert {r["id"]: r["query_text"] for r in again.collect()} == {i: v[0] for i, v in got.items()}


def test_weighted_draws_hit_exactly_one_interval(spark):
    combos = spark.createDataFrame([("g1", "a", 0.7), ("g1", "b", 0.1), ("g2", "a", 0.2)], "g string, o string, w double")
    draws = spark.range(2000).withColumnRenamed("id", "draw")
    for chunk in (1, 2, 1024):
        got = S.weighted_draws(combos, "g", "o", "w", draws, "s", chunk)
        assert got.count() == 2000
        share = got.filter("g = 'g1' and o = 'a'").count() / 2000
        assert 0.65 < share < 0.75


def test_weighted_draws_of_a_dominant_group_follow_the_intervals(spark):
    """3,000 combinations of one group, a heavy one, many tiny and zero ones: each draw hits the interval it falls into."""
    rows = [("hot", i, 500.0 if i == 1700 else 0.0 if i % 5 == 0 else 1e-6 if i % 3 == 0 else 1.0) for i in range(3000)] + [("other", 0, 3.0), ("other", 1, None)]
    combos = spark.createDataFrame(rows, "g string, o long, w double").repartition(5)
    got = S.weighted_draws(combos, "g", "o", "w", spark.range(4000).withColumnRenamed("id", "draw"), "s", 64).collect()
    assert sorted(r.draw for r in got) == list(range(4000))
    ends, at, total = [], 0.0, sum(w or 0.0 for *_, w in rows)
    for g, o, w in rows:
        ends.append((at / total, (at + (w or 0.0)) / total))
        at += w or 0.0
    place = {(g, o): e for (g, o, _), e in zip(rows, ends, strict=True)}
    assert all(place[r.g, r.o][0] - 1e-9 <= r.u < place[r.g, r.o][1] + 1e-9 for r in got)


def test_summary_null_rules(spark):
    df = spark.createDataFrame([("", "d", 2.0), (None, None, None)], "a string, b string, quality_score double")
    got = {(r["dim"], r["value"]): (r["n"], r["mean_score"]) for r in A.corpus_summary(df, {"a": None, "b": "unspecified"}).collect()}
    assert got[("a", "")] == (1, 2.0) and got[("a", "unknown")] == (1, 0.0)
    assert got[("b", "unspecified")] == (1, 0.0) and got[("total", "all")] == (2, 1.0)


RECORD = "id long, scene string, text string, target_complexity string, design_style string, application_type string, product_type string, persona_title string"


def test_scores_follow_the_rubric(spark):
    rows = [
        (1, "s", "I want to track my daily habits with a simple app.", "vague", "Dark", "habit应用", "dashboard", "p"),
        (2, "s", "form? thanks", "vague", None, "通用内容应用", "dashboard", None),
        (3, None, "Build a dashboard with card, table, filter and modal so that we can compare results: fast. Please add a timeline and toast; step 2 shows detail on hover.", "complex", None, None, "form_flow", None),
        (4, None, "Build a dashboard with card, table, filter and modal so that we can compare results: fast. Please add a timeline and toast; step 2 shows detail on hover.", "complex", None, None, "dashboard", None),
    ]
    got = {r["id"]: r for r in Q.score_records(spark.createDataFrame(rows, RECORD)).collect()}
    assert (got[1]["authenticity"], got[1]["specificity"], got[1]["diversity"]) == (5, 5, 5)
    assert got[1]["quality_score"] == 5.0 and got[1]["quality_pass"]
    assert (got[2]["authenticity"], got[2]["specificity"], got[2]["diversity"]) == (1, 3, 3)
    assert got[2]["form_bias_flag"] and not got[2]["quality_pass"]
    assert got[3]["peer_similarity"] == 1.0 and got[3]["diversity"] == 1
    assert not got[3]["form_bias_flag"] and got[4]["form_bias_flag"]
    assert got[3]["specificity"] == 5 and got[3]["complexity_level"] == "complex"


def test_quota_plan_bonus_and_styles(spark):
    rows = [(f"s{i}", i, "news", f"label {i}", ["a", "b", "c"], ["form_flow"], 0) for i in range(3)]
    scenes = spark.createDataFrame(rows, "id string, idx long, l1_scene string, l2_scene_label string, candidates array<string>, products array<string>, target_count int")
    none = scenes.limit(0)
    plan = {r.query_id: r for r in P.quota_plan(none, none, scenes, "auto").collect()}
    assert len(plan) == 10 and {r.plan_type for r in plan.values()} == {"expand_new"}
    bonus = plan["q_s0_004"]
    assert (bonus.application_type, bonus.product_type, bonus.target_complexity, bonus.design_style) == ("a", "dashboard", "complex", "Dark")
    assert plan["q_s2_003"].design_style == "Dark" and plan["q_s2_002"].design_style == "Cyberpunk"
    assert {r.design_style for r in P.quota_plan(none, none, scenes).collect()} == {None}
    with pytest.raises(ValueError):
        P.quota_plan(none, none, scenes, "dark")
