"""FN: column functions, filters, labels, rendering, parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import bindings as B
from corpusloom.catalog.base import (
    query, s_any_word, s_clean, s_contains, s_count, s_distinct, s_hash, s_list, s_ratio, s_round, s_tags, s_tokens, s_words,
)
from corpusloom.catalog.wording import CLUB, CLUB_BASELINE, LETTER
from corpusloom.functions import fixed_values as fv
from corpusloom.functions import model_output as M
from corpusloom.functions import render as R
from corpusloom.functions import tagging as G
from corpusloom.functions import text as T




def docs(spark, sf):
    return B.table(spark, sf, "documents")


@query("fn01_clean_text", f"SELECT doc_id, md5({s_clean('text')}) AS clean_md5, md5(lower({s_clean('text')})) AS key_md5 FROM documents")
def fn01(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.clean_text(F.col("text"))).alias("clean_md5"), F.md5(T.normalize_key(F.col("text"))).alias("key_md5"))


@query("fn02_dedup_key", "SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9一-鿿]+', ' ', 'g'))) AS key_md5 FROM documents")
def fn02(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.dedup_key(F.col("text"))).alias("key_md5"))


@query("fn03_two_tokenizers", f"""SELECT doc_id, {s_words('text')} AS words, len({s_tokens('text')}) AS tokens,
  md5(array_to_string({s_tokens('text')}, '|')) AS token_md5 FROM documents""")
def fn03(spark, sf):
    rows = docs(spark, sf).select("doc_id", T.word_count(F.col("text")).alias("words"), T.alnum_tokens(F.col("text")).alias("tok"))
    return rows.select("doc_id", "words", F.size("tok").cast("long").alias("tokens"), F.md5(F.array_join("tok", "|")).alias("token_md5"))


@query("fn04_ngrams", f"""WITH t AS (SELECT doc_id, {s_tokens('text')} AS tok FROM documents),
g AS (SELECT doc_id, list_transform(range(1, greatest(len(tok) - 1, 1)), lambda i: tok[i] || ' ' || tok[i+1] || ' ' || tok[i+2]) AS g FROM t)
SELECT doc_id, len(g) AS n_grams, len(list_distinct(g)) AS n_distinct, md5(array_to_string(g, '|')) AS gram_md5 FROM g""")
def fn04(spark, sf):
    rows = docs(spark, sf).select("doc_id", T.alnum_tokens(F.col("text")).alias("tok")).select("doc_id", T.ngrams(F.col("tok"), 3).alias("g"))
    return rows.select(
        "doc_id", F.size("g").cast("long").alias("n_grams"), F.size(F.array_distinct("g")).cast("long").alias("n_distinct"),
        F.md5(F.array_join("g", "|")).alias("gram_md5"),
    )


@query("fn05_split_label", f"WITH {B.SCN} SELECT id, l2_scene_label, array_to_string(l2_scene_examples, '|') AS examples FROM scn")
def fn05(spark, sf):
    label, examples = T.split_label(F.col("l2_scene_raw"))
    return B.scenes(spark, sf).select("id", label.alias("l2_scene_label"), F.array_join(examples, "|").alias("examples"))


# the fixture's prose is not Chinese, so the tag queries over documents use their own keyword table
DOC_RULES = [
    (["tion", "ment"], ["abstract", "french"]), (["the ", "and "], ["english"]), (["der ", "und "], ["german", "abstract"]),
    (["que", "leaux"], ["french", "dense"]),
]


@query("fn06_keyword_tags", f"""WITH t AS (SELECT doc_id, lower(text) AS x FROM documents), h AS (SELECT doc_id, {s_tags('x', DOC_RULES)} AS h FROM t),
{B.SCN}, st AS (SELECT source_row_id, l1_scene || ' ' || l2_scene_label || ' ' || candidates[1] AS x FROM scn),
sh AS (SELECT source_row_id, {s_tags('x', fv.PRODUCT_RULES)} AS p, {s_tags('x', fv.STYLE_RULES)} AS s FROM st)
SELECT 'document' AS kind, doc_id AS id, CASE WHEN len(h) = 0 THEN 'other' ELSE array_to_string({s_distinct('h')}, '|') END AS tags, '' AS styles FROM h
UNION ALL SELECT 'scene', source_row_id, CASE WHEN len(p) = 0 THEN 'portfolio|dashboard|form_flow' ELSE array_to_string({s_distinct('p')}, '|') END,
  array_to_string(['free'] || {s_distinct('s')}, '|') FROM sh""")
def fn06(spark, sf):
    d = docs(spark, sf).select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        F.array_join(T.tags_by_rules(F.lower(F.col("text")), DOC_RULES, default=["other"]), "|").alias("tags"), F.lit("").alias("styles"),
    )
    src = F.concat_ws(" ", "l1_scene", "l2_scene_label", F.get("candidates", F.lit(0)))
    s = B.scenes(spark, sf).select(
        F.lit("scene").alias("kind"), F.col("source_row_id").alias("id"), F.array_join(R.infer_products(src), "|").alias("tags"),
        F.array_join(R.infer_styles(src), "|", "free").alias("styles"),
    )
    return d.unionByName(s)


STYLE_LIST = ["Dark", "", "Luxury", "Vibrant"]


@query("fn07_style_policy", f"""WITH {B.SCN}, s AS (SELECT id, idx, [NULL] || {s_distinct('h')} AS st FROM (SELECT id, idx,
  {s_tags("(l1_scene || ' ' || l2_scene_label || ' ' || candidates[1])", fv.STYLE_RULES)} AS h FROM scn))
SELECT id, 'free' AS none_style, coalesce(st[1 + idx % len(st)], 'free') AS auto_style,
  coalesce(nullif(({s_list(STYLE_LIST)})[1 + idx % 4], ''), 'free') AS listed_style FROM s""")
def fn07(spark, sf):
    src = F.concat_ws(" ", "l1_scene", "l2_scene_label", F.get("candidates", F.lit(0)))
    free = lambda m: F.coalesce(R.resolve_style(m, F.col("idx"), src), F.lit("free"))
    return B.scenes(spark, sf).select("id", free(None).alias("none_style"), free("auto").alias("auto_style"), free(STYLE_LIST).alias("listed_style"))


@query("fn08_rotate", f"""WITH {B.SCN}, r AS (SELECT id, candidates AS c, ((idx - 12) % len(candidates) + len(candidates)) % len(candidates) AS k FROM scn)
SELECT id, array_to_string(c[k + 1:] || c[1:k], '|') AS rotated FROM r""")
def fn08(spark, sf):
    return B.scenes(spark, sf).select("id", F.array_join(T.rotate(F.col("candidates"), F.col("idx") - 12), "|").alias("rotated"))


PERSONAS = s_list(fv.PERSONA_IDS)


@query("fn09_seeded_pick", f"SELECT doc_id, ({PERSONAS})[1 + {s_hash("doc_id || ':0'")} % 5] AS pick0, ({PERSONAS})[1 + {s_hash("doc_id || ':7'")} % 5] AS pick7 FROM documents")
def fn09(spark, sf):
    return docs(spark, sf).select("doc_id", T.pick_seeded(fv.PERSONA_IDS, F.col("doc_id")).alias("pick0"), T.pick_seeded(fv.PERSONA_IDS, F.col("doc_id"), 7).alias("pick7"))


@query("fn10_opener_by_id", f"SELECT doc_id, ({s_list(fv.OPENERS)})[1 + {s_hash('doc_id::VARCHAR')} % 5] AS opener FROM documents")
def fn10(spark, sf):
    return docs(spark, sf).select("doc_id", T.opener_for(F.col("doc_id")).alias("opener"))


PART_WORDS = [("small", "little"), ("red", "crimson"), ("widget", "gadget"), ("ring", "")]


def s_replace_all(x: str, rules) -> str:
    for a, b in rules:
        x = f"replace({x}, '{a}', '{b}')"
    return x


@query("fn11_translate_label", rf"""WITH p AS (SELECT p_partkey AS id, trim(regexp_replace(regexp_replace(regexp_replace({s_replace_all(s_clean("p_name || ' / (' || p_type || ')'"), PART_WORDS)},
    '[（）()]', ' ', 'g'), '\s*/\s*', ' and ', 'g'), '\s+', ' ', 'g')) AS label FROM part),
{B.SCN}, s AS (SELECT source_row_id AS id, trim(regexp_replace({s_replace_all(s_clean('candidates[1]'), fv.LABEL_TRANSLATIONS)}, '\s+', ' ', 'g')) AS label FROM scn)
SELECT 'part' AS kind, id, label FROM p UNION ALL SELECT 'scene', id, label FROM s""")
def fn11(spark, sf):
    named = F.concat("p_name", F.lit(" / ("), F.col("p_type"), F.lit(")"))
    p = B.table(spark, sf, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), T.translate_label(named, PART_WORDS).alias("label"))
    s = B.scenes(spark, sf).select(F.lit("scene").alias("kind"), F.col("source_row_id").alias("id"), T.translate_label(F.get("candidates", F.lit(0))).alias("label"))
    return p.unionByName(s)


# documents with page-level nouns put in front of and behind the prose
SCOPED = "CASE doc_id % 4 WHEN 0 THEN 'Build a small page with a widget. ' WHEN 1 THEN 'A TINY Screen and an mini feature: ' WHEN 2 THEN 'SECTION view ' ELSE '' END || text || ' one more Module'"


def s_scope(x: str) -> str:
    for n in fv.PAGE_NOUNS:
        for a, b in ((n.upper(), "APP"), (n[0].upper() + "(?i:" + n[1:] + ")", "App"), ("(?i)" + n, "app")):
            x = rf"regexp_replace({x}, '\b{a}\b', '{b}', 'g')" if not a.startswith("(?i)") else rf"regexp_replace({x}, '(?i)\b{n}\b', '{b}', 'g')"
    for n in fv.TOOL_NOUNS:
        for a, b in ((n.upper(), "TOOL"), (n[0].upper() + "(?i:" + n[1:] + ")", "Tool")):
            x = rf"regexp_replace({x}, '\b{a}\b', '{b}', 'g')"
        x = rf"regexp_replace({x}, '(?i)\b{n}\b', 'tool', 'g')"
    return x


# RE2 has no look-ahead: the size word and its noun are matched together and the noun is put back
_SIZED = rf"regexp_replace(regexp_replace(x, '(?i)\b(?:little|small|tiny|mini)\s+(page|screen|view|section|module|feature|widget)\b', '\1', 'g'), '[ \t]+', ' ', 'g')"


def scoped(spark, sf):
    i = F.col("doc_id") % 4
    lead = F.when(i == 0, "Build a small page with a widget. ").when(i == 1, "A TINY Screen and an mini feature: ").when(i == 2, "SECTION view ").otherwise("")
    return docs(spark, sf).select("doc_id", F.concat(lead, F.col("text"), F.lit(" one more Module")).alias("x")).withColumn("y", T.rewrite_scope(F.col("x")))


@query("fn12_scope_rewrite", rf"""WITH t AS (SELECT doc_id, {SCOPED} AS x FROM documents), r AS (SELECT doc_id, x, {s_scope(_SIZED)} AS y FROM t),
f AS (SELECT doc_id, x, regexp_replace(regexp_replace(regexp_replace(y, '\ba\s+app\b', 'an app', 'g'), '\ban\s+tool\b', 'a tool', 'g'), '^\s+|\s+$', '', 'g') AS y FROM r)
SELECT doc_id, md5(y) AS text_md5, x <> y AS changed, {s_words('x')} AS words_before, {s_words('y')} AS words_after FROM f""")
def fn12(spark, sf):
    rows = scoped(spark, sf)
    return rows.select("doc_id", F.md5("y").alias("text_md5"), (F.col("x") != F.col("y")).alias("changed"), T.word_count(F.col("x")).alias("words_before"), T.word_count(F.col("y")).alias("words_after"))


@query("fn12_rewrite_summary", rf"""WITH t AS (SELECT doc_id, {SCOPED} AS x FROM documents), r AS (SELECT doc_id, x, {s_scope(_SIZED)} AS y FROM t),
f AS (SELECT doc_id, x, regexp_replace(regexp_replace(regexp_replace(y, '\ba\s+app\b', 'an app', 'g'), '\ban\s+tool\b', 'a tool', 'g'), '^\s+|\s+$', '', 'g') AS y FROM r)
SELECT count(*) AS rows, count(*) FILTER (WHERE x <> y) AS changed, {s_round(f"avg({s_words('x')})", 2)} AS mean_words_before, {s_round(f"avg({s_words('y')})", 2)} AS mean_words_after FROM f""")
def fn12_summary(spark, sf):
    return scoped(spark, sf).agg(*T.rewrite_summary(F.col("x"), F.col("y")))


def s_line(template: str) -> str:
    parts = R._FIELD.split(template)
    out = [f"'{p.replace(chr(39), chr(39) * 2)}'" if k % 2 == 0 else f"{p}::VARCHAR" for k, p in enumerate(parts) if k % 2 or p]
    return "(" + " || ".join(out) + ")"


RENDERED = ["persona", "persona_query", "topic_query", "scene_query", "topic_persona"]


@query("fn13_prompt_columns", f"""WITH {B.REC}, r AS (SELECT id, scene AS l2_scene_label, l1 AS l1_scene, application_type, design_style, target_complexity, persona_title,
  'goal of ' || scene AS user_goal, 'web' AS platform, 'maker' AS corpus_persona_id, scene || ' topic' AS corpus_topic, ({s_list(fv.OPENERS)})[1 + {s_hash('id::VARCHAR')} % 5] AS opener FROM rec)
SELECT id, {", ".join(f"md5(concat_ws(chr(10), {', '.join(s_line(x) for x in R.TEMPLATES[k])})) AS {k}" for k in RENDERED)} FROM r""")
def fn13(spark, sf):
    r = B.records(spark, sf).select(
        "id", F.col("scene").alias("l2_scene_label"), F.col("l1").alias("l1_scene"), "application_type", "design_style", "target_complexity",
        "persona_title", F.concat(F.lit("goal of "), "scene").alias("user_goal"), F.lit("web").alias("platform"), F.lit("maker").alias("corpus_persona_id"),
        F.concat("scene", F.lit(" topic")).alias("corpus_topic"), T.opener_for(F.col("id")).alias("opener"),
    )
    return r.select("id", *[F.md5(R.render(R.TEMPLATES[k])).alias(k) for k in RENDERED])


SEED_SQL = "substr(sha1(id || ':' || candidates[1] || ':0'), 1, 10)"
EXAMPLE_SQL = "regexp_replace(candidates[1], '应用$', '')"


@query("fn14_persona_struct", f"""WITH {B.SCN}, t AS (SELECT *, {SEED_SQL} AS seed, {EXAMPLE_SQL} AS ex, (['vague', 'medium', 'complex'])[1 + idx % 3] AS lv FROM scn),
a AS (SELECT *, ({PERSONAS})[1 + {s_hash("seed || ':0'")} % 5] AS arch FROM t)
SELECT id, 'persona_' || substr(sha1(id || ':' || seed), 1, 10) AS persona_id, 'User of ' || ex AS persona_title, 'A ' || arch || ' who works on ' || l2_scene_label AS persona_description,
  arch || '/' || lv AS persona_style_hint, 'Get ' || ex || ' done with less effort' AS user_goal, (['low', 'medium', 'high'])[1 + idx % 3] AS domain_familiarity,
  'deterministic_persona_fallback' AS persona_source FROM a""")
def fn14(spark, sf):
    app = F.get("candidates", F.lit(0))
    seed = T.short_hash(F.concat_ws(":", "id", app, F.lit("0")))
    lv = B.nth(fv.COMPLEXITY_LEVELS, F.col("idx") % 3)
    return B.scenes(spark, sf).select("id", R.persona_struct(F.col("id"), seed, lv, app, F.col("l2_scene_label")).alias("p")).select("id", "p.*")


CLUB_SQL = """'Our club runs ' || l2_scene_label || ' and would enjoy a ' || pl || '.' || coalesce(' Members favour ' || st || ' tones.', '') || ' Half of them read it on the tram.'"""


@query("fn15_text_by_complexity", f"""WITH {B.SCN}, t AS (SELECT *, CASE WHEN idx % 2 = 0 THEN 'Dark' END AS st, CASE WHEN idx % 5 < 2 THEN 'dashboard' ELSE 'gadget' END AS pl, (['vague', 'medium', 'complex'])[1 + idx % 3] AS lv FROM scn)
SELECT id, CASE lv WHEN 'vague' THEN l2_scene_label || ': one ' || pl || ', nothing fancy.' WHEN 'medium' THEN {CLUB_SQL}
  ELSE {CLUB_SQL} || ' Please plan for this as well:' || chr(10) || '- a guest who never signs up' || chr(10) || '- a winter without network' || chr(10) || '- next year''s board taking over' END AS query_text,
  l2_scene_label || ' deserves a ' || pl || '.' AS baseline FROM t""")
def fn15(spark, sf):
    """Two in five tasks are bound to a product."""
    style, product = F.when(F.col("idx") % 2 == 0, "Dark"), F.when(F.col("idx") % 5 < 2, "dashboard").otherwise("gadget")
    fields = {"app": F.col("l2_scene_label"), "style": style, "product": product}
    lv = B.nth(fv.COMPLEXITY_LEVELS, F.col("idx") % 3)
    return B.scenes(spark, sf).select("id", R.text_by_level(lv, fields, CLUB).alias("query_text"), R.text_by_level(lv, fields, CLUB_BASELINE).alias("baseline"))


def s_pick(items: str, offset: int) -> str:
    return f"({items})[1 + {s_hash(f"seed || ':{offset}'")} % len({items})]"


# spelled out, so that the oracle sees a wrong table
LENS_SQL = """CASE WHEN regexp_matches(x, '深度研究展示|品牌|传记|历史|科普|作品集|相册|故事') THEN
    {'name': 'story', 'crowd': ['school classes', 'grandparents'], 'worry': ['losing the thread', 'dry dates'], 'thing': ['a ribbon of years', 'a family tree']}
  WHEN regexp_matches(x, '搜索|筛选|排序|选择|查找') THEN
    {'name': 'search', 'crowd': ['warehouse pickers', 'students before an exam'], 'worry': ['forty near misses', 'typing with one thumb'], 'thing': ['a spyglass', 'an index drawer']}
  WHEN regexp_matches(x, '任务|待办|进度|打卡|习惯|提醒|计划') THEN
    {'name': 'planning', 'crowd': ['choir leaders', 'night nurses'], 'worry': ['double bookings', 'forgotten birthdays'], 'thing': ['a wall calendar', 'a string of beads']}
  WHEN regexp_matches(x, '健康|运动|睡眠|饮食|冥想|服药') THEN
    {'name': 'tracking', 'crowd': ['marathon beginners', 'allergy patients'], 'worry': ['gaps after holidays', 'too many decimals'], 'thing': ['a thermometer', 'a tide chart']}
  WHEN regexp_matches(x, '图片|海报|模板|内容创作|编辑|播放') THEN
    {'name': 'making', 'crowd': ['puppet builders', 'zine printers'], 'worry': ['lost drafts', 'smudged margins'], 'thing': ['a workbench', 'a light table']}
  WHEN regexp_matches(x, '商品|购物|订单|物流') THEN
    {'name': 'buying', 'crowd': ['market stall owners', 'gift hunters'], 'worry': ['hidden fees', 'parcels gone astray'], 'thing': ['a till', 'a shopping trolley']}
  ELSE {'name': 'general', 'crowd': ['passers-by', 'lodgers'], 'worry': ['small print', 'dead ends'], 'thing': ['a doorbell', 'a noticeboard']} END"""
HAIL, CAUSE = "['Hello there', 'Good morning', 'Dear workshop']", "['our paper notebook fell apart', 'the old spreadsheet crashed again', 'the colleague who knew it all moved away']"
WISH, HOUR, PLACE = "['surprise me', 'borrow whatever idea you fancy']", "['at dawn', 'between shifts', 'late at night']", "['a noisy bakery', 'the back of a van', 'a quiet archive']"
RISK, PROOF = "['gloves on', 'a cracked screen', 'the lights out']", "['a printed slip', 'a short beep']"
BUDGET, SIGN = "['two afternoons', 'one long weekend', 'about a week']", "['Cheers, Ola', 'Thanks in advance', 'See you on Friday']"
LOOK_SQL = "coalesce(' Paint it ' || st || '.', '')"


def s_lens_text(t: str) -> str:
    """CTEs that add ``lens`` and ``query_text`` to ``t`` (id, lv, app, pt, st, x)."""
    return f"""ls AS (SELECT *, {LENS_SQL} AS lens, id || ':' || app || ':' || pt || ':' || coalesce(st, 'unspecified') AS seed FROM {t}),
lt AS (SELECT *, CASE lv
  WHEN 'vague' THEN {s_pick(HAIL, 1)} || ', could you put together a ' || pt || ' for ' || app || '? Why now: ' || {s_pick(CAUSE, 2)} || '.' || {LOOK_SQL} || ' As for the rest, ' || {s_pick(WISH, 3)} || '. ' || {s_pick(SIGN, 4)} || '.'
  WHEN 'complex' THEN {s_pick(HAIL, 1)} || ', ' || app || ' needs a ' || pt || ' that serves ' || {s_pick('lens.crowd', 2)} || ' and, on busy days, ' || {s_pick('lens.crowd', 3)}
    || '. All of them dread ' || {s_pick('lens.worry', 4)} || ' and ' || {s_pick('lens.worry', 5)} || '; think of ' || {s_pick('lens.thing', 6)} || '. It lives in ' || {s_pick(PLACE, 7)} || ' and is used ' || {s_pick(HOUR, 8)}
    || ', even with ' || {s_pick(RISK, 9)} || '. When something is saved, give ' || {s_pick(PROOF, 10)} || '.' || {LOOK_SQL} || ' You have ' || {s_pick(BUDGET, 11)} || '. ' || {s_pick(SIGN, 12)} || '.'
  ELSE 'A ' || pt || ' for ' || app || ', please, meant for ' || {s_pick('lens.crowd', 1)} || '. They dread ' || {s_pick('lens.worry', 2)} || ', so it should feel like ' || {s_pick('lens.thing', 3)}
    || '. We will use it ' || {s_pick(HOUR, 4)} || ' in ' || {s_pick(PLACE, 5)} || '.' || {LOOK_SQL} || ' You have ' || {s_pick(BUDGET, 6)} || '. ' || {s_pick(SIGN, 7)} || '.' END AS query_text FROM ls)"""


@query("fn16_combinatorial_text", f"""WITH {B.SCN}, t AS (SELECT id, idx, candidates[1] AS app, CASE WHEN idx % 2 = 0 THEN 'dashboard' ELSE 'form_flow' END AS pt, CASE WHEN idx % 5 > 0 THEN 'Dark' END AS st,
  (['vague', 'medium', 'complex'])[1 + idx % 3] AS lv, l1_scene || ' ' || l2_scene_label || ' ' || candidates[1] AS x FROM scn), {s_lens_text('t')} SELECT id, lens.name AS lens, query_text FROM lt""")
def fn16(spark, sf):
    app = F.get("candidates", F.lit(0))
    lens = R.scene_lens(F.concat_ws(" ", "l1_scene", "l2_scene_label", app), LETTER)
    product, style = F.when(F.col("idx") % 2 == 0, "dashboard").otherwise("form_flow"), F.when(F.col("idx") % 5 > 0, "Dark")
    rows = B.scenes(spark, sf).select("id", "idx", app.alias("app"), product.alias("product"), style.alias("style"), lens.alias("lens"))
    fields = {c: F.col(c) for c in ("app", "product", "style")}
    lv = B.nth(fv.COMPLEXITY_LEVELS, F.col("idx") % 3)
    text = R.text_by_level(lv, fields, LETTER, R.record_seed(F.col("id"), *fields.values()), F.col("lens"))
    return rows.select("id", F.col("lens.name").alias("lens"), text.alias("query_text"))


def s_app_name(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '({'|'.join(fv.APP_NAME_SUFFIXES)})$') THEN {x} ELSE {x} || '应用' END)"


L1_SQL = "CASE l1_scene " + " ".join(f"WHEN '{k}' THEN {s_list(v)}" for k, v in fv.L1_EXPANSIONS) + " ELSE [] END"
# the fixture's label is one token of letters, digits and ideographs
CAND_SQL = f"""gen AS (SELECT id, unnest(range(1, 7)) AS g, [candidates,
    flatten(list_transform(l2_scene_examples, lambda e: [e, e || '应用', e || '工具', e || '展示', e || '记录'])),
    [l2_scene_label || '应用'], {L1_SQL}, {s_tags("(l1_scene || ' ' || l2_scene_label || ' ' || array_to_string(l2_scene_examples, ' '))", fv.KEYWORD_EXPANSIONS)},
    [l2_scene_label || '应用', l2_scene_label || '工具', l2_scene_label || '平台', l1_scene || '应用']] AS all_lists FROM scn),
flat AS (SELECT id, g, unnest(all_lists[g]) AS raw, generate_subscripts(all_lists[g], 1) AS k FROM gen),
named AS (SELECT id, g, k, {s_app_name('raw')} AS name FROM flat),
once AS (SELECT id, name, min(g * 1000 + k) AS ord FROM named GROUP BY 1, 2),
main AS (SELECT id, count(*) FILTER (WHERE ord < 6000) AS n_main FROM once GROUP BY 1),
kept AS (SELECT once.*, row_number() OVER (PARTITION BY id ORDER BY ord) AS pos FROM once JOIN main USING (id) WHERE ord < 6000 OR n_main < 6),
cands AS (SELECT id, pos, name, (['xlsx_candidate', 'l2_example_extension', 'label_token_extension', 'l1_extension', 'keyword_extension', 'fallback_extension'])[ord // 1000] AS source
  FROM kept WHERE pos <= 12)"""


@query("fn17_expand_candidates", f"WITH {B.SCN}, {CAND_SQL} SELECT id, pos, name, source FROM cands")
def fn17(spark, sf):
    names = R.candidate_names(F.col("l1_scene"), F.col("l2_scene_label"), F.col("l2_scene_examples"), F.col("candidates"))
    return B.scenes(spark, sf).select("id", F.posexplode(names).alias("p", "c")).select("id", (F.col("p") + 1).cast("long").alias("pos"), "c.name", "c.source")


PTS_SQL = f"CASE WHEN len(p) = 0 THEN {s_list(fv.DEFAULT_PRODUCT_TYPES)} ELSE p END"


def extra_ctes(src: str, where: str) -> str:
    """CTEs xp (products) and xs (styles) for every row of ``where`` with text ``src``."""
    return f"""x0 AS (SELECT *, {src} AS x FROM {where}),
x1 AS (SELECT *, {s_tags('x', fv.PRODUCT_RULES)} AS p, {s_tags('x', fv.EXTRA_PRODUCT_RULES)} AS p2,
  {s_tags('x', fv.EXTRA_STYLE_RULES)} || {s_tags('x', fv.STYLE_RULES)} AS s FROM x0),
x2 AS (SELECT * EXCLUDE (p, s), ({PTS_SQL}) || p2 AS p, s AS s FROM x1),
x3 AS (SELECT * EXCLUDE (p, s), {s_distinct('p')} AS pts, list_slice([NULL] || {s_distinct('s')}, 1, 6) AS sts FROM x2)"""


@query("fn18_extra_rules", f"""WITH {B.SCN}, {extra_ctes("l1_scene || ' ' || l2_scene_label || ' ' || candidates[1]", 'scn')}
SELECT id, array_to_string(pts, '|') AS products, array_to_string(list_transform(sts, lambda v: coalesce(v, 'free')), '|') AS styles FROM x3""")
def fn18(spark, sf):
    src = F.concat_ws(" ", "l1_scene", "l2_scene_label", F.get("candidates", F.lit(0)))
    return B.scenes(spark, sf).select("id", F.array_join(R.expand_products(src), "|").alias("products"), F.array_join(R.expand_styles(src), "|", "free").alias("styles"))


@query("fn19_exclude_l1", f"WITH {B.SCN} SELECT id, l1_scene FROM scn WHERE NOT (contains(l1_scene, '健康') OR contains(l1_scene, '新闻'))")
def fn19(spark, sf):
    return B.scenes(spark, sf).filter(~G.excluded(F.col("l1_scene"), ["健康", "新闻"])).select("id", "l1_scene")


@query("fn20_facet_filter_page", f"""WITH {B.REC} SELECT id, scene, target_complexity FROM rec WHERE l1 = 'en' AND product_type = 'dashboard'
  AND contains(lower(text || ' ' || scene), 'the') ORDER BY quality_score DESC NULLS LAST, id LIMIT 25 OFFSET 25""")
def fn20(spark, sf):
    hits = G.facet_filter(B.records(spark, sf), {"l1": "en", "product_type": "dashboard", "design_style": None}, " The ", ["text", "scene"])
    return G.page_of(hits, [F.desc_nulls_last("quality_score"), F.asc("id")], 2, 25).select("id", "scene", "target_complexity")


@query("fn21_topic_search", "SELECT p_brand, count(*) AS matches, count(DISTINCT p_name) AS distinct_topics FROM part WHERE contains(lower(p_name), 'red') GROUP BY 1")
def fn21(spark, sf):
    return G.topic_search(B.table(spark, sf, "part"), "RED", "p_name", "p_brand")


@query("fn22_prefilter_reasons", f"""WITH t AS (SELECT text, len(replace(text, ' ', '')) AS dense, {s_count('text', '[一-鿿]')} AS cjk, {s_count('text', '[!-~]')} AS ascii FROM documents)
SELECT CASE WHEN len(text) < 200 THEN 'too_short' WHEN len(text) > 4000 THEN 'too_long'
  WHEN dense > 0 AND cjk / dense::DOUBLE < 0.05e0 AND ascii / dense::DOUBLE < 0.97e0 THEN 'unsupported_language'
  WHEN NOT {s_contains('lower(text)', fv.UI_KEYWORDS)} THEN 'not_ui_related'
  WHEN {s_contains('text', [p.replace("'", "''") for p in fv.REFUSAL_PHRASES])} THEN 'llm_refusal' ELSE 'ok' END AS reason, count(*) AS n FROM t GROUP BY 1""")
def fn22(spark, sf):
    reason = G.prefilter_reason(F.col("text"), 200, 4000, 0.05, 0.97)
    return docs(spark, sf).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def s_kw(x: str, tags: list[str]) -> str:
    spoken = lambda t: f"contains(replace({x}, '_', ' '), '{t.lower().replace('_', ' ')}')" if "_" in t else f"contains({x}, '{t.lower()}')"
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {spoken(t)} THEN '{t}' END" for t in tags) + "], lambda v: v IS NOT NULL), '|')"


@query("fn23_multi_label_tags", f"""WITH t AS (SELECT page_id, lower(html) AS h FROM pages) SELECT page_id, {s_kw('h', fv.COMPONENT_TAGS)} AS components, {s_kw('h', fv.TECH_TAGS)} AS tech_stack,
  {s_kw('h', fv.INTERACTION_TAGS)} AS interactions, {s_contains('h', fv.DATA_VIZ_WORDS)} AS has_data_viz,
  CASE WHEN {s_contains('h', fv.RESPONSIVE_WORDS)} THEN 'true' ELSE 'not mentioned' END AS mobile_responsive, {s_contains('h', [n.lower() for n in fv.STYLE_NAMES])} AS explicit_style FROM t""")
def fn23(spark, sf):
    cols = G.label_columns(F.col("html"))
    for k in ("components", "tech_stack", "interactions"):
        cols[k] = F.array_join(cols[k], "|")
    cols["mobile_responsive"] = F.coalesce(cols["mobile_responsive"].cast("string"), F.lit("not mentioned"))
    return B.table(spark, sf, "pages").select("page_id", *[c.alias(k) for k, c in cols.items()])


@query("fn24_parse_model_output", r"""WITH t AS (SELECT event_id, event_id % 7 AS m, (props::JSON->>'k')::BIGINT AS k FROM events)
SELECT event_id, CASE WHEN m IN (5, 6) THEN -1 ELSE k END AS k, CASE m WHEN 0 THEN 'plain' WHEN 1 THEN 'fence' WHEN 2 THEN 'prose' WHEN 3 THEN 'say "hi" now' WHEN 4 THEN '{a} } b' ELSE 'none' END AS note,
  CASE WHEN m IN (0, 1) THEN 'parsed' WHEN m IN (2, 3, 4) THEN 'recovered' ELSE 'fallback' END AS parse_status FROM t""")
def fn24(spark, sf):
    """props wrapped the ways a model spoils JSON: fence, prose, bare quotes, braces in strings, cut off, empty."""
    e = B.table(spark, sf, "events").select("event_id", "props", (F.col("event_id") % 7).alias("m"))
    body = F.regexp_replace("props", r"\}\s*$", "")
    with_note = lambda n: F.concat(body, F.lit(f', "note": "{n}"}}'))
    answer = (
        F.when(F.col("m") == 0, with_note("plain"))
        .when(F.col("m") == 1, F.concat(F.lit("```json\n"), with_note("fence"), F.lit("\n```")))
        .when(F.col("m") == 2, F.concat(F.lit("Sure: here it is\n"), with_note("prose"), F.lit(" hope that helps {x}")))
        .when(F.col("m") == 3, with_note('say "hi" now'))
        .when(F.col("m") == 4, F.concat(F.lit("answer "), with_note("{a} } b")))
        .when(F.col("m") == 5, body)
        .otherwise("")
    )
    out = M.parse_objects(e.withColumn("answer", answer), "answer", {"k": ("bigint", F.lit(-1)), "note": ("string", F.lit("none"))})
    return out.select("event_id", "k", "note", "parse_status")


# props as the text of a chat answer, in the shapes that gateways return
MESSAGE_SHAPES = [
    ('{"choices": [{"message": {"content": "', '"}}]}'),
    ('{"choices": [{"text": "', '", "message": {"content": "", "reasoning": "why", "refusal": "no"}}]}'),
    ('{"choices": [{"reasoning": "late", "message": {"content": [{"type": "text", "text": "', '"}, "plain", {"type": "thinking", "summary": "hm"}, {"type": "image", "text": "x"}, 7]}}]}'),
    ('{"choices": [{"message": {"content": null, "thinking": "', '", "reasoning_content": "r"}}]}'),
    ('{"choices": [{"text": "', '"}]}'),
    ('{"choices": [], "text": "', '"}'),
    ('{"choices": [{"message": {"content": "', '"'),
]


@query("fn24_message_text", """WITH t AS (SELECT event_id, event_id % 7 AS m, replace(event_type || ' ' || event_id, '"', '') AS x FROM events)
SELECT event_id, CASE m WHEN 0 THEN x WHEN 1 THEN x || chr(10) || chr(10) || 'why' || chr(10) || chr(10) || 'no' WHEN 2 THEN x || chr(10) || chr(10) || 'plain' || chr(10) || chr(10) || 'hm' || chr(10) || chr(10) || 'late'
  WHEN 3 THEN 'r' || chr(10) || chr(10) || x WHEN 4 THEN x ELSE '' END AS text FROM t""")
def fn24_message(spark, sf):
    x = F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))
    m = F.col("event_id") % 7
    payload = F.concat(B.nth([a for a, _ in MESSAGE_SHAPES], m), x, B.nth([b for _, b in MESSAGE_SHAPES], m))
    return B.table(spark, sf, "events").select("event_id", M.message_text(payload).alias("text"))


@query("fn24_parse_arrays", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type || '|' || event_id WHEN 1 THEN event_type ELSE '(none)' END AS items FROM events""")
def fn24_arrays(spark, sf):
    e, m = F.col("event_type"), F.col("event_id") % 3
    answer = F.when(m == 0, F.concat(F.lit('```json\n["'), e, F.lit('", "'), F.col("event_id").cast("string"), F.lit('"]\n```')))
    answer = answer.when(m == 1, F.concat(F.lit('Here: ["'), e, F.lit('"] as asked.'))).otherwise(F.concat(e, F.lit(" no list")))
    out = M.parse_arrays(B.table(spark, sf, "events").select("event_id", answer.alias("a")), "a", "items")
    return out.select("event_id", F.coalesce(F.array_join("items", "|"), F.lit("(none)")).alias("items"))


@query("fn25_needs_translation", f"WITH {B.EREC} SELECT id FROM erec WHERE error IS NULL AND query_text <> '' AND id % 3 <> 0")
def fn25(spark, sf):
    r = B.run_records(spark, sf).withColumn("zh", F.when(F.col("id") % 3 == 0, "zh").otherwise(""))
    return r.filter(G.needs_translation(F.col("query_text"), F.col("error"), F.col("zh"))).select("id")


@query("fn26_relevance_filter", f"""WITH {B.REC} SELECT id, quality_score FROM rec WHERE quality_score / 5 >= 0.4e0 AND (id % 3 = 0 OR id % 5 = 0) AND len(text) >= 50""")
def fn26(spark, sf):
    some = lambda k: F.when(F.col("id") % k == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    r = B.records(spark, sf)
    return r.filter(G.relevant(F.col("quality_score") / 5, some(3), some(5), F.col("text"))).select("id", "quality_score")


FN27_LEADS = ["好的，", "作为一个设计师角色，", "非常好看 ", "我来扮演 ", "根据以上提示词，", "这是训练数据 ", "当然，很漂亮。", "角色作为一个"]


@query("fn27_regenerate_flags", f"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 10 = 8 THEN '请帮我做一个短页面' WHEN doc_id % 10 = 9 THEN text ELSE ({s_list(FN27_LEADS)})[1 + doc_id % 10] || text END AS x FROM documents)
SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(x, '作为一个.*角色') THEN 'role_play' END, CASE WHEN regexp_matches(x, '我来扮演') THEN 'acting' END,
  CASE WHEN regexp_matches(x, '根据.*提示词') THEN 'prompt_leak' END, CASE WHEN regexp_matches(x, '^(好的|当然|我理解)') THEN 'assistant_opening' END, CASE WHEN contains(x, '训练数据') THEN 'training_data' END,
  CASE WHEN x LIKE '请帮我做一个%' AND len(x) <= 22 THEN 'vague_one_liner' END,
  CASE WHEN regexp_matches(x, '(非常|很|极其|特别)+(美观|好看|漂亮)') THEN 'generic_adjective' END], lambda v: v IS NOT NULL), '|') AS rules FROM t""")
def fn27(spark, sf):
    i = F.col("doc_id") % 10
    text = F.when(i == 8, "请帮我做一个短页面").when(i == 9, F.col("text")).otherwise(F.concat(B.nth([*FN27_LEADS, "", ""], i), F.col("text")))
    return docs(spark, sf).select("doc_id", F.array_join(G.regenerate_rules(text), "|").alias("rules"))
