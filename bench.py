"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
BENCH_QUERIES: comma-separated name prefixes, or 'all'.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fn03_two_tokenizers", "fn12_scope_rewrite", "fn24_parse_model_output", "qs01_actual_complexity", "qs07_score_records",
    "sm01_max_peer_similarity", "sm02_peer_profile", "sm03_near_duplicates", "sm04_normalized_duplicates", "lx01_distinct_n",
    "lx03_opener_profile", "lx07_voice_profile", "lx08_scorecard", "jn01_match_pool_key", "jn06_merge_results",
    "ag01_corpus_summary", "ag13_pool_capacity", "ag14_pool_consumption", "ag19_word_frequency", "pl03_backfill_plan",
    "pl05_pick_least_used", "pl06_corpus_plan", "pl10_candidate_plan", "pl11_merge_topics", "so01_floor_quantiles",
    "em05_label_structure", "snk05_pack_batches", "st02_running_usage",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("corpusloom-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from corpusloom.catalog import QUERIES

    chosen = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE
    if chosen:
        names = [n for n in QUERIES if chosen == "all" or any(n.startswith(p) for p in chosen.split(","))]
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
