"""Time the registered queries and print one JSON line.

Settings come from the environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (runs per headline query,
the median counts) and BENCH_QUERIES (comma-separated names instead of all). ``value`` adds up the headline queries;
``other_queries`` are the remaining registered ones, the second of two runs. ``cold`` has every first run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gristmill.registry import queries  # noqa: E402
from gristmill.session import local_session  # noqa: E402

HEADLINE = (
    "staging_products staging_reviews product_features user_features product_review_stats user_product_interactions "
    "clean_text embedding_text embed_documents embedding_incremental embedding_upsert l2_normalize cosine_topk "
    "safe_json_ingest json_project dedup_latest_by_key product_upsert profile_rating_stats profile_freshness "
    "vector_table_checks dq_suite_reviews dq_suite_interactions raw_scan_manifest dynamic_overwrite table_row_counts "
    "incremental_extract"
).split()


def run_once(spark, query, sf_dir: str) -> float:
    """Seconds to compute the full result; rows go nowhere, so only the query is timed."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, app="bench")
    registered = queries()
    others = [] if chosen else [n for n in registered if n not in HEADLINE]
    seconds, other_seconds, cold = {}, {}, {}
    for name in [*(chosen or HEADLINE), *others]:
        times = [run_once(spark, registered[name], sf_dir) for _ in range(2 if name in others else runs)]
        cold[name] = round(times[0], 3)
        warm = round(times[-1] if name in others else statistics.median(times), 3)
        (other_seconds if name in others else seconds)[name] = warm
        print(f"{name}: {[round(t, 2) for t in times]}", file=sys.stderr, flush=True)
    reviews = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "other_queries": other_seconds,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
        "reviews_per_second": {
            n: round(reviews / seconds[n])
            for n in ("staging_reviews", "user_features", "product_review_stats", "user_product_interactions")
            if n in seconds
        },
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
