"""Queries against their oracles on the smallest tables.

By default a selection; CORPUSLOOM_FULL=1 runs every query.
"""

import os

import duckdb
import pytest
from check import TABLES, normal

from corpusloom.catalog import ORACLES, QUERIES

SF = os.environ.get("CORPUSLOOM_SF", "/root/testdata/sf0.001")
SELECTED = [
    "fn04_ngrams", "fn06_keyword_tags", "fn12_scope_rewrite", "fn17_expand_candidates", "fn24_parse_model_output", "src01_grid_to_taxonomy",
    "src02_read_json_lines", "src06_batch_outputs", "snk02_csv_round_trip", "snk05_pack_batches", "qs07_score_records", "sm02_peer_profile",
    "sm03_near_duplicates", "lx01_distinct_n", "lx03_opener_profile", "lx07_voice_profile", "jn01_match_pool_key", "jn06_merge_results",
    "ag01_corpus_summary", "ag13_pool_capacity", "pl06_corpus_plan", "pl11_merge_topics", "pl17_weighted_draws", "em05_label_structure",
    "so01_floor_quantiles", "st01_append_once", "st02_running_usage", "st02_usage_snapshot", "src04_nested_pool", "snk03_upsert_tables",
    "so04_newest_first", "snk04_ordered_view", "pl07_quota_plan", "pl11_merge_counts", "pl11_fill_to_target", "pl13_expansion_prompts",
    "fn15_text_by_complexity", "fn16_combinatorial_text", "fn23_multi_label_tags", "fn24_message_text", "fn27_regenerate_flags",
    "jn11_side_by_side_runs", "ag09_run_summary", "ag23_distribution_report", "ag12_run_summary", "ag13_capacity_by_platform", "ag17_counts_by_platform", "em03_pca_laws",
]
NAMES = list(ORACLES) if os.environ.get("CORPUSLOOM_FULL") else SELECTED


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), cols)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
