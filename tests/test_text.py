import re

from pyspark.sql import functions as F

from corpusloom.functions import model_output as M
from corpusloom.functions import render as R
from corpusloom.functions import tagging as G
from corpusloom.functions import text as T


def one(spark, expr_of, value):
    return spark.createDataFrame([(value,)], "c string").select(expr_of(F.col("c")).alias("r")).first()["r"]


def test_clean_text_handles_unicode_blanks_and_null(spark):
    nbsp, ideographic = chr(0xA0), chr(0x3000)
    assert one(spark, T.clean_text, f" {nbsp}a\r\n\tb{ideographic}c ") == "a b c"
    assert one(spark, T.clean_text, None) == ""


def test_word_counts_and_tokens(spark):
    assert one(spark, T.word_count, "  one two\nthree ") == 3
    assert one(spark, T.word_count, "   ") == 0
    assert one(spark, T.alnum_tokens, "Don't stop-now 42é") == ["don't", "stop", "now", "42"]


def test_ngrams_shorter_than_n(spark):
    assert one(spark, lambda c: T.ngrams(T.alnum_tokens(c), 3), "a b") == []
    assert one(spark, lambda c: T.ngrams(T.alnum_tokens(c), 3), "a b c d") == ["a b c", "b c d"]
    assert one(spark, lambda c: F.size(T.char_ngram_hashes(c, 3)), "") == 0
    assert one(spark, lambda c: F.size(T.char_ngram_hashes(c, 3)), "ab") == 0
    assert one(spark, lambda c: F.size(T.char_ngram_hashes(c, 3)), "abcd") == 2


def test_split_label_forms(spark):
    df = spark.createDataFrame([("① 旅行（相册、 照片,回忆）",), ("plain label",), ("x (a，b)",), ("x（a）tail",)], "c string")
    label, ex = T.split_label(F.col("c"))
    rows = [(r[0], r[1]) for r in df.select(label, ex).collect()]
    assert rows == [("旅行", ["相册", "照片", "回忆"]), ("plain label", []), ("x", ["a", "b"]), ("x（a）tail", [])]


def test_normalize_application(spark):
    assert one(spark, T.normalize_application, "办公类") == "办公应用"
    assert one(spark, T.normalize_application, "登录页面") == "登录页面"
    assert one(spark, T.normalize_application, " ") == "通用内容应用"


def test_scope_rewrite_keeps_case_and_fixes_articles(spark):
    text = "A small Page with a SECTION, a page, an widget and one Feature. pages stay"
    assert one(spark, T.rewrite_scope, text) == "A App with a APP, an app, a tool and one Tool. pages stay"


def test_scope_rewrite_accented_neighbours_are_boundaries(spark):
    assert one(spark, T.rewrite_scope, "épage") == "éapp"


def test_sentences_openers_fingerprints(spark):
    assert one(spark, T.sentence_count, "One. Two!! Three? v1.2 end") == 3
    assert one(spark, T.sentence_count, "none") == 1
    assert one(spark, T.opener_bucket, "<image>\n** Build a, Nice app") == "build a nice"
    assert one(spark, T.opener_bucket, "...") == "∅"
    assert one(spark, T.lead_fingerprint, " Hello World! more") == "hello world"


def test_jargon_is_whole_word(spark):
    assert one(spark, T.jargon_hits, "Dashboard dashboards auto/generate CTA modal-x") == 4


def test_rotate_negative_and_empty(spark):
    df = spark.createDataFrame([(["a", "b", "c"], -1), ([], 5), (["a", "b"], 3)], "x array<string>, k int")
    assert [r[0] for r in df.select(T.rotate(F.col("x"), F.col("k"))).collect()] == [["c", "a", "b"], [], ["b", "a"]]


def test_translate_label_order_and_empty(spark):
    assert one(spark, T.translate_label, "任务管理应用") == "task management"
    assert one(spark, T.translate_label, "类") == "the product"
    assert one(spark, T.translate_label, "其他/天气信息") == "miscellaneous and weather information"


def test_candidate_names_fallback_only_when_few(spark):
    df = spark.createDataFrame([("x", "y", [], ["c应用"]), ("办公效率", "任务 看板", ["待办"], ["a应用", "b应用"])], "l1 string, l2 string, ex array<string>, cand array<string>")
    rows = df.select(R.candidate_names(*[F.col(c) for c in ("l1", "l2", "ex", "cand")]).alias("n")).collect()
    few = [(x["name"], x["source"]) for x in rows[0]["n"]]
    assert few == [("c应用", "xlsx_candidate"), ("y应用", "fallback_extension"), ("y工具", "fallback_extension"), ("y平台", "fallback_extension"), ("x应用", "fallback_extension")]
    many = rows[1]["n"]
    assert len(many) == 12 and "fallback_extension" not in {x["source"] for x in many}
    assert len({x["name"] for x in many}) == 12


def test_render_skips_null_lines(spark):
    df = spark.createDataFrame([("v", None)], "a string, b string")
    assert df.select(R.render(["A {a}", "B {b}", "end"])).first()[0] == "A v\nend"


def test_parse_objects_statuses(spark):
    rows = [
        (1, '{"k": 1}'), (2, 'text ```json\n{"k": 2}\n``` tail'), (3, 'so {"k": 3, "s": "a } b"} and {"k": 9}'),
        (4, '{"k": 4, "s": "he said "x: y" ok"}'), (5, '{"k": 5'), (6, "[1, 2]"), (7, ""), (8, None), (9, '{"k": "bad"}'),
        (10, '{"k": 10, "s": "say: "hi" now"}'),
    ]
    df = spark.createDataFrame(rows, "id int, a string")
    out = M.parse_objects(df, "a", {"k": ("bigint", F.lit(-1)), "s": ("string", F.lit("-"))}).orderBy("id").collect()
    assert [(r["k"], r["parse_status"]) for r in out] == [
        (1, "parsed"), (2, "parsed"), (3, "recovered"), (4, "recovered"), (-1, "fallback"), (-1, "fallback"), (-1, "fallback"), (-1, "fallback"), (-1, "parsed"), (10, "recovered"),
    ]
    assert out[2]["s"] == "a } b" and out[3]["s"] == 'he said "x: y" ok' and out[9]["s"] == 'say: "hi" now'


def test_parse_arrays(spark):
    df = spark.createDataFrame([('```json\n["a", "b"]\n```',), ("none",)], "a string")
    assert [r["t"] for r in M.parse_arrays(df, "a", "t").collect()] == [["a", "b"], None]


def test_prefilter_order(spark):
    df = spark.createDataFrame([("short",), ("x" * 700,), ("é" * 50,), ("plain words without the thing, long enough",), ("a page, but I cannot do that for you today",), ("设计一个页面，按钮和布局都要清楚，整体简洁一点，配色温和，移动端也要好用",)], "c string")
    assert [r[0] for r in df.select(G.prefilter_reason(F.col("c"))).collect()] == ["too_short", "too_long", "unsupported_language", "not_ui_related", "llm_refusal", "ok"]


def test_regenerate_rules(spark):
    assert one(spark, G.regenerate_rules, "好的，作为一个设计师的角色") == ["role_play", "assistant_opening"]
    assert one(spark, G.regenerate_rules, "请帮我做一个网站") == ["vague_one_liner"]
    assert one(spark, G.regenerate_rules, None) == []


def test_long_work_on_a_text_is_planned_once(spark):
    """Cleaning is no part of every range, and item hashes no part of every slice of the windows."""
    from corpusloom.operators import lexical as L
    from corpusloom.operators import reports as A
    from corpusloom.operators import similarity as S

    df = spark.createDataFrame([(1, "g", "a b  c")], "id long, g string, text string")

    def times(out, part):
        return out._jdf.queryExecution().optimizedPlan().toString().count(part)

    assert times(A.range_histogram(df, "g", "text"), "regexp_replace(") <= 3
    for sets in (S.word_shingles(df, "id", "g", "text"), S.char_shingles(df, "id", "text"), L.distinct_n(df, "g", "text")):
        assert times(sets, "lambdafunction(xxhash64(lambda t") + times(sets, "transform(") <= 5


def test_white_space_of_every_kind(spark):
    rows = [" a", "a\u2003 b", "\t\n", "a  b\u00a0", "\ufeffa\u3000\u2028b c ", "a\x0b\x0cb", "", "a\u0085b", None]
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    got = [tuple(r) for r in df.select(T.clean_text(F.col("c")), T.trim_ws(F.col("c")), T.word_count(F.col("c"))).collect()]
    ws = T.WS_CHARS
    for r, (clean, trimmed, n) in zip(rows, got, strict=True):
        words = re.split(f"[{ws}]+", (r or "").strip(ws))
        assert clean == " ".join(words) and trimmed == (r or "").strip(ws) and n == (len(words) if words != [""] else 0)
