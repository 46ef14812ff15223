"""Documents to training sequences: toxicity, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import line_dedup, mixing, near_text, packing, toxicity
from corpusloom.llm.queries import categories
from corpusloom.sources.storage import clear_scratch, materialized, scratch_mark


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chain = toxicity.train(docs, labels, categories(), "toxic")
    return toxicity.score(docs, chain, "toxic").filter("NOT rejected").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand in an earlier one."""
    return line_dedup.drop_repeated_chunks(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group: SimHash fingerprints within 3 bits, or five-word shingles at Jaccard 0.8 or more."""
    return near_text.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in part where a block ends."""
    return mixing.mixed_documents(docs, ["doc_id", "text"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents in pieces, with the sequence and place of each; ``row_no`` tells the copies of a mixed document apart."""
    packed = packing.pack(docs.select("doc_id", "source", "text"))
    return packed.select("row.doc_id", "row.source", "row_no", "piece", "start", "length", "ids", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained weights, fingerprints and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again, and what it wrote besides is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        mark = scratch_mark()
        docs = materialized(stage(spark, docs, sf_dir), f"stage-{name}")
        clear_scratch(spark, mark, ("stage-",))
    return STAGES[-1][1](spark, docs, sf_dir)
