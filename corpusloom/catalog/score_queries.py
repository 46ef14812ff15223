"""QS, SM, LX, SO: scoring, similarity, lexical metrics, quantiles and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import bindings as B
from corpusloom.catalog.base import query, s_any_word, s_clean, s_count, s_ratio, s_round, s_tokens, s_words
from corpusloom.functions import fixed_values as fv
from corpusloom.functions import text as T
from corpusloom.catalog.placing import placed
from corpusloom.operators import lexical as L
from corpusloom.operators import ranking as K
from corpusloom.operators import reports as A
from corpusloom.operators import scoring as Q
from corpusloom.operators import similarity as S
from corpusloom.operators.greedy import greedy_keep_first
from corpusloom.sources import files


def docs(spark, sf):
    return B.table(spark, sf, "documents")


# --- scores ---------------------------------------------------------------------------

_HITS = s_count("c", "(?i)" + "|".join(fv.INTERACTION_WORDS))
_ACTUAL = rf"""CASE WHEN w >= 70 OR regexp_matches(c, '(?i)key requirements:|[0-9]\.') OR {_HITS} >= 5 THEN 'complex' WHEN w >= 28 OR {_HITS} >= 2 THEN 'medium' ELSE 'vague' END"""


def s_point(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


_UI = s_count("c", s_any_word(fv.UI_NOUNS))
_FIRST = r"(?i)\b(?:i |i''|my |we |our )"
_AUTH = f"""1 + {s_point(f"regexp_matches(c, '{_FIRST}')")} + {s_point(f"regexp_matches(c, '{s_any_word(fv.MOTIVE_WORDS)}')")}
  + {s_point("coalesce(persona_title, '') <> ''")} + {s_point("w >= CASE WHEN target_complexity = 'vague' THEN 5 ELSE 20 END")}"""
_BRIEF = rf"""1 + {s_point(f"regexp_matches(c, '{s_any_word(fv.APP_NOUNS)}') OR coalesce(application_type, '') <> ''")} + {s_point(r"NOT regexp_matches(c, '\?\s*$')")}
  + {s_point(f"NOT regexp_matches(c, '{s_any_word(fv.SIGN_OFF_WORDS)}')")} + {s_point("w BETWEEN 5 AND 40")} - {s_point(f"{_UI} >= 3")}"""
_RICH = f"""1 + {s_point(f"{_UI} >= 1")} + {s_point(f"{_UI} >= 3")} + {s_point("actual <> 'vague'")}
  + {s_point("regexp_matches(c, '[,:;]') AND len(list_filter(regexp_split_to_array(c, '[.!?]'), lambda x: len(trim(x)) > 5)) >= 2")}"""
_SPEC = f"CASE WHEN target_complexity = 'vague' THEN {_BRIEF} ELSE {_RICH} END"
_BIAS = f"""(regexp_matches(c, '{s_any_word([t for t in fv.FORM_VOCABULARY if t.isascii()])}') AND coalesce(product_type, '') <> 'form_flow')"""
_DIV = f"""1 + {s_point("coalesce(design_style, '') <> ''")} + {s_point("coalesce(application_type, '') <> '' AND NOT starts_with(application_type, '通用')")}
  + {s_point("sim < 0.55e0")} + {s_point("sim < 0.30e0")}"""

BASE = f"""{B.REC}, cl AS (SELECT *, {s_clean('text')} AS c FROM rec), cw AS (SELECT *, {s_words('c')} AS w FROM cl), ca AS (SELECT *, {_ACTUAL} AS actual FROM cw)"""

# brute force over shared word trigrams of the same scene
SIM = r"""tk AS (SELECT id, scene, list_filter(string_split(lower(c), ' '), lambda v: v <> '') AS t FROM cl),
sh AS (SELECT DISTINCT id, scene, unnest(list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i+1] || ' ' || t[i+2])) AS s FROM tk),
sz AS (SELECT id, count(*) AS n FROM sh GROUP BY 1),
pr AS (SELECT a.id AS ia, b.id AS ib, count(*) AS o FROM sh a JOIN sh b ON a.scene = b.scene AND a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
mx AS (SELECT ia AS id, max(o / (x.n + y.n - o)::DOUBLE) AS sim FROM pr JOIN sz x ON x.id = ia JOIN sz y ON y.id = ib GROUP BY 1),
cs AS (SELECT ca.*, coalesce(mx.sim, 0e0) AS sim FROM ca LEFT JOIN mx USING (id))"""


def scored(spark, sf):
    return Q.score_records(B.records(spark, sf))


@query("qs01_actual_complexity", f"WITH {BASE} SELECT l1, actual AS complexity, count(*) AS n FROM ca GROUP BY 1, 2")
def qs01(spark, sf):
    rows = Q.with_clean(B.records(spark, sf), "text")
    return rows.groupBy("l1", Q.actual_complexity(F.col("clean"), F.col("words")).alias("complexity")).agg(F.count("*").alias("n"))


@query("qs02_authenticity", f"WITH {BASE} SELECT id, ({_AUTH})::BIGINT AS authenticity FROM ca")
def qs02(spark, sf):
    rows = Q.with_clean(B.records(spark, sf), "text")
    return rows.select("id", Q.authenticity(F.col("clean"), F.col("words"), F.col("target_complexity"), F.col("persona_title")).cast("long").alias("authenticity"))


@query("qs03_specificity", f"WITH {BASE} SELECT id, ({_SPEC})::BIGINT AS specificity FROM ca")
def qs03(spark, sf):
    rows = Q.with_clean(B.records(spark, sf), "text").withColumn("actual", Q.actual_complexity(F.col("clean"), F.col("words")))
    spec = Q.specificity(F.col("clean"), F.col("words"), F.col("target_complexity"), F.col("actual"), F.col("application_type"))
    return rows.select("id", spec.cast("long").alias("specificity"))


@query("qs04_diversity", f"WITH {BASE}, {SIM} SELECT id, ({_DIV})::BIGINT AS diversity FROM cs")
def qs04(spark, sf):
    r = B.records(spark, sf)
    sim = S.max_peer_similarity(r, "id", "scene", "text")
    return r.join(sim, "id").select("id", Q.diversity(F.col("design_style"), F.col("application_type"), F.col("sim")).cast("long").alias("diversity"))


@query("qs05_form_bias", f"WITH {BASE} SELECT id, {_BIAS} AS form_bias_flag FROM ca")
def qs05(spark, sf):
    rows = Q.with_clean(B.records(spark, sf), "text")
    return rows.select("id", Q.form_bias(F.col("clean"), F.col("product_type")).alias("form_bias_flag"))


@query("qs05_form_bias_cjk", rf"""WITH {B.REC}, cl AS (SELECT id, product_type, {s_clean("CASE id % 5 WHEN 0 THEN 'a表单b ' WHEN 1 THEN '表单 ' WHEN 2 THEN 'x填写 ' WHEN 3 THEN '请9步骤z ' ELSE '' END || text")} AS c FROM rec)
SELECT id, (regexp_matches(c, '(?i)\b(?:form|step \d|step-by-step|wizard|fill (?:in|out)|submit|multi-step)\b') OR regexp_matches(c, '[A-Za-z0-9_](?:填写|表单|步骤)[A-Za-z0-9_]'))
  AND coalesce(product_type, '') <> 'form_flow' AS form_bias_flag FROM cl""")
def qs05_cjk(spark, sf):
    """Ideographs count only between ASCII word characters."""
    i = F.col("id") % 5
    lead = F.when(i == 0, "a表单b ").when(i == 1, "表单 ").when(i == 2, "x填写 ").when(i == 3, "请9步骤z ").otherwise("")
    rows = Q.with_clean(B.records(spark, sf).withColumn("text", F.concat(lead, F.col("text"))), "text")
    return rows.select("id", Q.form_bias(F.col("clean"), F.col("product_type")).alias("form_bias_flag"))


def s_total(a: str, s: str, d: str) -> str:
    clamp = lambda x: f"least(5, greatest(1, {x}))"
    return s_round(f"(2 * {clamp(a)} + 2 * {clamp(s)} + {clamp(d)}) / 5e0", 2)


@query("qs06_total_and_pass", f"""WITH {BASE}, t AS (SELECT id, {s_total(_AUTH, _SPEC, '(1 + id % 5)')} AS quality_score FROM ca) SELECT id, quality_score, quality_score >= 2.8e0 AS quality_pass FROM t""")
def qs06(spark, sf):
    """Totals with a given diversity score."""
    rows = Q.with_clean(B.records(spark, sf), "text").withColumn("actual", Q.actual_complexity(F.col("clean"), F.col("words")))
    auth = Q.authenticity(F.col("clean"), F.col("words"), F.col("target_complexity"), F.col("persona_title"))
    spec = Q.specificity(F.col("clean"), F.col("words"), F.col("target_complexity"), F.col("actual"), F.col("application_type"))
    rows = rows.select("id", Q.total_score(auth, spec, 1 + F.col("id") % 5).alias("quality_score"))
    return rows.withColumn("quality_pass", F.col("quality_score") >= fv.PASS_SCORE)


@query("qs07_score_records", f"""WITH {BASE}, {SIM}, t AS (SELECT * EXCLUDE (quality_score), {s_total(_AUTH, _SPEC, _DIV)} AS quality_score FROM cs)
SELECT id, quality_score, quality_score >= 2.8e0 AS quality_pass, actual AS complexity_level, {s_round('sim', 3)} AS peer_similarity, {_BIAS} AS form_bias_flag FROM t""")
def qs07(spark, sf):
    return scored(spark, sf).select("id", "quality_score", "quality_pass", "complexity_level", "peer_similarity", "form_bias_flag")


# --- similarity ---------------------------------------------------------------------------


@query("sm01_max_peer_similarity", f"WITH {BASE}, {SIM} SELECT id, {s_round('sim', 6)} AS sim FROM cs")
def sm01(spark, sf):
    sim = S.max_peer_similarity(B.records(spark, sf), "id", "scene", "text")
    return sim.select("id", T.round_to(F.col("sim"), 6).alias("sim"))


def s_quantile(col: str, p: str) -> str:
    """Floor-index quantile of a column inside a GROUP BY."""
    return f"list_sort(list({col}))[1 + least(count(*) - 1, floor(count(*) * {p})::BIGINT)]"


PEERS = f"""us AS (SELECT doc_id AS id, source, {s_tokens('text')} AS t FROM documents),
sh AS (SELECT DISTINCT id, source, unnest(list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i+1] || ' ' || t[i+2])) AS s FROM us),
sz AS (SELECT id, count(*) AS n FROM sh GROUP BY 1),
pr AS (SELECT a.id AS ia, b.id AS ib, count(*) AS o FROM sh a JOIN sh b ON a.source = b.source AND a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
js AS (SELECT ia AS id, max(o / (x.n + y.n - o)::DOUBLE) AS mx, sum(o / (x.n + y.n - o)::DOUBLE) AS sm FROM pr JOIN sz x ON x.id = ia JOIN sz y ON y.id = ib GROUP BY 1),
cn AS (SELECT source, count(*) AS n FROM us GROUP BY 1),
pp AS (SELECT us.source, n, coalesce(mx, 0e0) AS mx, coalesce(sm, 0e0) / (n - 1) AS mn FROM us JOIN cn USING (source) LEFT JOIN js USING (id)),
peer AS (SELECT source, (max(n) * (max(n) - 1) // 2)::BIGINT AS n_pairs, avg(mx) AS max_peer_mean, {s_quantile('mx', '0.5e0')} AS max_peer_p50, {s_quantile('mx', '0.9e0')} AS max_peer_p90,
  max(mx) AS max_peer_max, avg(mn) AS mean_peer_mean, {s_quantile('mn', '0.5e0')} AS mean_peer_p50 FROM pp GROUP BY 1)"""
PEER_COLS = ["max_peer_mean", "max_peer_p50", "max_peer_p90", "max_peer_max", "mean_peer_mean", "mean_peer_p50"]


@query("sm02_peer_profile", f"WITH {PEERS} SELECT source, n_pairs, {', '.join(f'{s_round(c, 6)} AS {c}' for c in PEER_COLS)} FROM peer")
def sm02(spark, sf):
    prof = S.peer_profile(docs(spark, sf), "doc_id", "source", "text")
    return prof.select("source", "n_pairs", *[T.round_to(F.col(c), 6).alias(c) for c in PEER_COLS])


@query("sm02_peer_mean_estimate")
def sm02_estimate(spark, sf):
    """Mean similarity in linear time, with its standard error; tests hold it against all pairs."""
    return S.peer_mean_estimate(docs(spark, sf), "doc_id", "source", "text")


@query("sm03_near_duplicates", f"""WITH RECURSIVE d AS (SELECT doc_id AS id, lower({s_clean('text')}) AS c FROM documents),
g AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(len(c) - 1, 1)), lambda i: c[i:i+2])) AS s FROM d),
z AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
gn AS (SELECT g.id, s, n FROM g JOIN z USING (id)),
e AS (SELECT a.id AS ia, b.id AS ib FROM gn a JOIN gn b ON a.s = b.s AND a.id < b.id AND b.n >= 0.85e0 * a.n AND a.n >= 0.85e0 * b.n
  GROUP BY 1, 2 HAVING count(*) / (max(a.n) + max(b.n) - count(*))::DOUBLE >= 0.85e0),
both_ways AS (SELECT ia, ib FROM e UNION ALL SELECT ib, ia FROM e),
reach AS (SELECT id AS a, id AS b FROM d UNION SELECT r.a, w.ib FROM reach r JOIN both_ways w ON w.ia = r.b),
comp AS (SELECT a AS id, min(b) AS root, count(*) AS members FROM reach GROUP BY 1),
sc AS (SELECT d.doc_id AS id, coalesce(quality, 0) AS q FROM documents d LEFT JOIN labels USING (doc_id)),
best AS (SELECT root, arg_min(id, [-q, id]) AS keep_id FROM comp JOIN sc USING (id) GROUP BY 1),
kp AS (SELECT id, keep_id, members FROM comp JOIN best USING (root)),
io AS (SELECT kp.id, count(*) AS o FROM kp JOIN g a ON a.id = kp.id JOIN g b ON b.id = kp.keep_id AND b.s = a.s WHERE kp.id <> keep_id GROUP BY 1)
SELECT kp.id, keep_id, members, kp.id = keep_id AS kept, CASE WHEN kp.id = keep_id THEN 1e0 ELSE floor(coalesce(o, 0) / (za.n + zb.n - coalesce(o, 0))::DOUBLE * 1e6 + 0.5) / 1e6 END AS similarity
FROM kp LEFT JOIN io ON io.id = kp.id LEFT JOIN z za ON za.id = kp.id LEFT JOIN z zb ON zb.id = keep_id""")
def sm03(spark, sf):
    d = docs(spark, sf).join(B.table(spark, sf, "labels"), "doc_id", "left")
    out = S.near_duplicates(d, "doc_id", "text", "quality")
    return out.withColumn("kept", F.col("id") == F.col("keep_id")).withColumn("similarity", T.round_to(F.col("similarity"), 6))


@query("sm03_greedy_kept", f"""WITH RECURSIVE d AS (SELECT doc_id AS id, lower({s_clean('text')}) AS c FROM documents),
g AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(len(c) - 1, 1)), lambda i: c[i:i+2])) AS s FROM d),
z AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
gn AS (SELECT g.id, s, n FROM g JOIN z USING (id)),
e AS (SELECT a.id AS ia, b.id AS ib FROM gn a JOIN gn b ON a.s = b.s AND a.id < b.id AND b.n >= 0.85e0 * a.n AND a.n >= 0.85e0 * b.n
  GROUP BY 1, 2 HAVING count(*) / (max(a.n) + max(b.n) - count(*))::DOUBLE >= 0.85e0),
both_ways AS (SELECT ia, ib FROM e UNION ALL SELECT ib, ia FROM e),
linked AS (SELECT ia AS id, coalesce(max(quality), 0) AS q FROM both_ways LEFT JOIN labels ON doc_id = ia GROUP BY 1),
ord AS (SELECT id, row_number() OVER (ORDER BY q DESC, id) AS pos FROM linked),
adj AS (SELECT x.pos, list(y.pos) AS near FROM both_ways b JOIN ord x ON x.id = b.ia JOIN ord y ON y.id = b.ib GROUP BY 1),
walk AS (SELECT 0::BIGINT AS pos, []::BIGINT[] AS kept UNION ALL
  SELECT a.pos, CASE WHEN list_has_any(w.kept, a.near) THEN w.kept ELSE list_append(w.kept, a.pos) END FROM walk w JOIN adj a ON a.pos = w.pos + 1),
fin AS (SELECT unnest(kept) AS pos FROM walk WHERE pos = (SELECT max(pos) FROM walk))
SELECT d.id, (ord.pos IS NULL OR fin.pos IS NOT NULL) AS kept, TRUE AS near_a_kept_row FROM d LEFT JOIN ord USING (id) LEFT JOIN fin USING (pos)""")
def sm03_greedy(spark, sf):
    """In order of quality and id: what stays, and whether all that goes is near to a row that stays."""
    d = docs(spark, sf).join(B.table(spark, sf, "labels"), "doc_id", "left")
    out = greedy_keep_first(d, "doc_id", "text", "quality")
    stays = out.filter("kept").select(F.col("id").alias("keep_id"), F.lit(True).alias("stays"))
    near = F.coalesce("stays", F.lit(False)) & (F.col("similarity") >= fv.NEAR_DUPLICATE_JACCARD)
    return out.join(stays, "keep_id", "left").select("id", "kept", near.alias("near_a_kept_row"))


@query("sm04_normalized_duplicates", """WITH k AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9一-鿿]+', ' ', 'g')) AS k FROM documents)
SELECT md5(k) AS key_md5, min(doc_id) AS doc_id, count(*) AS copies FROM k GROUP BY k""")
def sm04(spark, sf):
    once = S.drop_duplicate_keys(docs(spark, sf), F.md5(T.dedup_key(F.col("text"))), "doc_id")
    return once.withColumnRenamed("key", "key_md5")


# --- lexical --------------------------------------------------------------------------------


def s_grams(n: int) -> str:
    grams = " || ' ' || ".join(f"t[i+{k}]" if k else "t[i]" for k in range(n))
    return f"list_transform(range(1, greatest(len(t) - {n - 2}, 1)), lambda i: {grams})"


TOKENS = f"tk AS (SELECT doc_id AS id, source, {s_tokens('text')} AS t FROM documents)"


def s_distinct_n(n: int) -> str:
    return f"SELECT source, {n}::BIGINT AS n, count(DISTINCT g) AS distinct_n, count(*) AS total_n FROM (SELECT source, unnest({s_grams(n)}) AS g FROM tk) GROUP BY 1"


GRAMS = f"gr AS ({' UNION ALL '.join(s_distinct_n(n) for n in (1, 2, 3))})"


@query("lx01_distinct_n", f"WITH {TOKENS}, {GRAMS} SELECT *, {s_ratio('distinct_n', 'total_n')} AS ratio FROM gr")
def lx01(spark, sf):
    return L.distinct_n(docs(spark, sf), "source", "text")


@query("lx02_type_token_ratio", f"WITH {TOKENS}, w AS (SELECT source, unnest(t) AS g FROM tk) SELECT source, count(DISTINCT g) AS types, count(*) AS tokens, {s_ratio('count(DISTINCT g)', 'count(*)')} AS ttr FROM w GROUP BY 1")
def lx02(spark, sf):
    return L.type_token_ratio(docs(spark, sf), "source", "text")


OPENERS = r"""op AS (SELECT source, trim(regexp_replace(regexp_replace(lower(regexp_extract(regexp_replace(text, '^\s+|\s+$', '', 'g'), '^([^A-Za-z0-9]*)(\S+\s+\S+\s+\S+|\S+\s+\S+|\S+)', 2)), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')) AS o FROM documents),
oc AS (SELECT source, CASE WHEN o = '' THEN '∅' ELSE array_to_string(string_split(o, ' ')[1:3], ' ') END AS opener, count(*) AS n FROM op GROUP BY 1, 2),
ot AS (SELECT source, sum(n)::BIGINT AS rows, count(*) AS unique_openers, -sum(n / (SELECT count(*) FROM documents d WHERE d.source = oc.source)::DOUBLE * log2(n / (SELECT count(*) FROM documents d WHERE d.source = oc.source)::DOUBLE)) AS h FROM oc GROUP BY 1),
orank AS (SELECT oc.source, opener, n, rows, row_number() OVER (PARTITION BY oc.source ORDER BY n DESC, opener) AS rank FROM oc JOIN ot USING (source))"""


@query("lx03_opener_profile", f"WITH {OPENERS} SELECT source, unique_openers, rows, {s_round('h', 6)} AS entropy_bits FROM ot")
def lx03(spark, sf):
    return L.opener_profile(docs(spark, sf), "source", "text")


@query("lx03_top_openers", f"WITH {OPENERS} SELECT source, rank, opener, n, {s_ratio('n', 'rows')} AS share FROM orank WHERE rank <= 10")
def lx03_top(spark, sf):
    return L.top_openers(docs(spark, sf), "source", "text")


@query("lx04_length_profile", f"""WITH {TOKENS}, l AS (SELECT source, len(t) AS len FROM tk)
SELECT source, {s_quantile('len', '0.1e0')} AS p10, {s_quantile('len', '0.5e0')} AS p50, {s_quantile('len', '0.9e0')} AS p90, max(len) AS max_len, {s_ratio('sum(len)', 'count(*)')} AS mean_len FROM l GROUP BY 1""")
def lx04(spark, sf):
    return L.length_profile(docs(spark, sf), "source", "text")


_JARGON = s_any_word([t.replace("-", r"[\-/]") for t in fv.JARGON_TERMS])
PAGE_TEXT = "lower(html)"


@query("lx05_jargon_hits", f"SELECT page_id AS id, {s_count('html', _JARGON)} AS hits FROM pages UNION ALL SELECT doc_id + 1000000000, {s_count('text', _JARGON)} FROM documents")
def lx05(spark, sf):
    pages = B.table(spark, sf, "pages").select(F.col("page_id").alias("id"), T.jargon_hits(F.col("html")).alias("hits"))
    return pages.unionByName(docs(spark, sf).select((F.col("doc_id") + 1000000000).alias("id"), T.jargon_hits(F.col("text")).alias("hits")))


_SENT = rf"greatest(1, {s_count('b', r'[.!?]+(?:\s|$)')})"
VOICE = rf"""vo AS (SELECT doc_id AS id, source, regexp_replace(text, '^\s+|\s+$', '', 'g') AS b FROM documents),
vr AS (SELECT id, source, {s_count('b', _JARGON)} AS jargon, len({s_tokens('b')}) AS n_tok, {_SENT} AS n_sent FROM vo),
vp AS (SELECT source, count(*) AS n_samples, {s_round('avg(jargon)', 6)} AS jargon_per_q, {s_round('avg(n_tok)', 6)} AS mean_words_per_q,
  {s_round('avg(n_tok / n_sent::DOUBLE)', 6)} AS mean_sentence_words, {s_quantile('n_tok', '0.5e0')} AS median_words_per_q FROM vr GROUP BY 1)"""


@query("lx06_sentence_stats", f"WITH {VOICE} SELECT id, n_sent, {s_round('n_tok / n_sent::DOUBLE', 6)} AS per_sentence FROM vr")
def lx06(spark, sf):
    body = T.strip_framing(F.col("text"))
    rows = docs(spark, sf).select(F.col("doc_id").alias("id"), T.sentence_count(body).alias("n_sent"), F.size(T.alnum_tokens(body)).alias("k"))
    return rows.select("id", "n_sent", T.round_to(F.col("k") / F.col("n_sent"), 6).alias("per_sentence"))


@query("lx07_voice_profile", f"WITH {VOICE} SELECT * FROM vp")
def lx07(spark, sf):
    return L.voice_profile(docs(spark, sf), "source", "text")


@query("lx08_scorecard", f"""WITH {VOICE}, {TOKENS}, {GRAMS}, {OPENERS}, {PEERS}
SELECT vp.source, jargon_per_q, median_words_per_q AS words_p50, {s_ratio('g3.distinct_n', 'g3.total_n')} AS distinct_3, {s_ratio('g1.distinct_n', 'g1.total_n')} AS ttr, unique_openers,
  opener AS top_opener, {s_ratio('orank.n', 'orank.rows')} AS top_share, {s_round('max_peer_mean', 6)} AS max_peer_mean
FROM vp JOIN gr g3 ON g3.source = vp.source AND g3.n = 3 JOIN gr g1 ON g1.source = vp.source AND g1.n = 1 JOIN ot ON ot.source = vp.source
JOIN orank ON orank.source = vp.source AND orank.rank = 1 JOIN peer ON peer.source = vp.source""")
def lx08(spark, sf):
    return L.scorecard(docs(spark, sf), "doc_id", "source", "text")


@query("lx09_strip_image_marker", r"""WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '<image>' || chr(10) WHEN 1 THEN '<IMAGE> ' ELSE 'see <image> ' END || text AS x FROM documents)
SELECT doc_id, md5(regexp_replace(regexp_replace(x, '(?i)^<image>\s*', ''), '^\s+|\s+$', '', 'g')) AS body_md5 FROM t""")
def lx09(spark, sf):
    i = F.col("doc_id") % 3
    lead = F.when(i == 0, "<image>\n").when(i == 1, "<IMAGE> ").otherwise("see <image> ")
    return docs(spark, sf).select("doc_id", F.md5(T.strip_framing(F.concat(lead, F.col("text")))).alias("body_md5"))


# --- sorts, quantiles, set operations -------------------------------------------------------------


@query("so01_floor_quantiles", f"SELECT l_returnflag, {s_quantile('l_extendedprice', '0.1e0')} AS p10, {s_quantile('l_extendedprice', '0.5e0')} AS p50, {s_quantile('l_extendedprice', '0.9e0')} AS p90, {s_quantile('l_extendedprice', '1e0')} AS p100 FROM lineitem GROUP BY 1")
def so01(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return K.floor_quantiles(li, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0})


@query("so02_upper_median", f"SELECT source, {s_quantile('n_chars', '0.5e0')} AS median_chars FROM documents GROUP BY 1")
def so02(spark, sf):
    return K.upper_median(docs(spark, sf), ["source"], "n_chars", "median_chars")


@query("so03_top_counts", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_name LIMIT 12")
def so03(spark, sf):
    return B.table(spark, sf, "part").groupBy("p_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_name").limit(12)


@query("so04_newest_first", f"WITH {B.REC} SELECT created_at, id, row_number() OVER (ORDER BY created_at DESC, id) AS place FROM rec")
def so04(spark, sf):
    return placed(files.ordered_view(B.records(spark, sf).select("created_at", "id"), "created_at", "id"))


@query("so05_set_operations", """WITH a AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'), c AS (SELECT c_custkey AS k FROM customer)
SELECT 'union_all' AS op, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) UNION ALL SELECT 'distinct', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)
UNION ALL SELECT 'except', count(*) FROM c WHERE k NOT IN (SELECT k FROM a)""")
def so05(spark, sf):
    o = B.table(spark, sf, "orders")
    a = o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    b = o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    c = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    size = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
    return (
        size("union_all", a.unionByName(b))
        .unionByName(size("distinct", a.unionByName(b).distinct()))
        .unionByName(size("except", c.join(a, "k", "left_anti")))
    )
