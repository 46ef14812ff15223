"""Queries over the given tables for the operators of this package, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import embed_dedup, hard_negatives, line_dedup, mixing, packing, pii, sharding, simhash, token_files, topk, toxicity, url_filter, whitening
from corpusloom.sources.storage import materialized, new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

URL_SQL = rf"""
WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (
  SELECT u.host, u.path, max({{'n': length(h) + length(p), 'k': length(h), 'v': v, 'r': h || p}}) AS b
  FROM (SELECT DISTINCT host, path FROM split) u JOIN rules ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)
  GROUP BY ALL)
SELECT page_id, s.host, s.path, b.r AS rule, coalesce(b.v, 'allow') AS verdict
FROM split s LEFT JOIN best USING (host, path)
"""


@query("op1_url_filter", URL_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.rules_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and disclosing-term spans of every document."""
    return pii.span_digest(table(spark, sf_dir, "documents"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, texts and all, in 40 shards whose row counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 16).cast("long")
    placed = sharding.external_shuffle(table(spark, sf_dir, "documents"), 40, row_bytes=size)
    return placed.select(
        "doc_id", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated chunks, and the line ranges that went."""
    edited = line_dedup.drop_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.aggregate("removed", F.lit(0).cast("long"), lambda n, g: n + g["n"])
    return edited.select("doc_id", "text", lines.alias("removed_lines"), F.array_join(F.transform("removed", lambda g: F.concat_ws(":", g["line"], g["n"])), ",").alias("removed"))


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    packed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


TOPK_SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.no, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM sound q, sound c WHERE q.vec_id % 50 = 0 AND c.no <> q.no)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY no ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


@query("op6_top_k", TOPK_SQL)
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every 50th vector."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document, in all and for each of its 16 shards."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("th")
    )
    mix = mixing.mix_plan(materialized(docs, "sizes"), "source", F.col("words"), [F.col("doc_id"), F.col("th")], shards=16)
    return mix.select("doc_id", "size", "source_size", "target", "taken", F.array_join("shard_words", ",").alias("shard_words"))


COSINE_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN lowest l ON e.vec_id = l.a
"""


@query("op8_embedding_dedup", COSINE_SQL)
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of one label at cosine 0.98."""
    vectors = embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))
    return vectors.select("vec_id", "n_links", "component_id", "kept")


def categories() -> dict:
    """Label columns in chain order."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities and the verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), categories(), "toxic")
    return toxicity.score(docs, chain, "toxic").select("doc_id", "p_low_quality", "p_toxic", "rejected")


@query("op10_simhash_dedup")
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


@query("op11_token_output")
def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, read back from the files."""
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    back = token_files.read_documents(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


NEGATIVES_SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.no, a.vec_id AS anchor_id, c.no AS other_no, c.vec_id, a.lab = c.lab AS same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM sound a, sound c WHERE a.vec_id % 100 = 0 AND c.no <> a.no),
positives AS (
  SELECT no, anchor_id, other_no, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  WINDOW w AS (PARTITION BY no ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id,
       p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.no = p.no AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.no, p.other_no ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 5
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives within 80 to 100 hundredths of each of the five positives of every 100th vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 leading whitened components."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.long_form(whitening.whiten(vectors))
