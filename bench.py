"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.plans import QUERIES
from millrace.session import build_session

HEADLINE = [
    "rolling_mean_5m", "sliding_error_count", "window_probe_count", "sessionize_arrival", "sessionize_event_time",
    "interval_merge", "asof_latest", "kway_merge", "flag_late", "token_bucket", "dedup_first", "top_n_dense",
    "sum_by_country", "broadcast_left_join", "pivot_sum", "product_summary", "partial_final_agg", "order_totals",
    "prefiltered_parse_agg", "ndjson_typed_scan", "medallion_split", "json_tags_explode", "json_flatten",
    "tx_validate_dlq", "order_contract", "scd2_merge", "upsert_by_key", "snapshot_delta_join", "fixed_chunk",
    "tokenize", "recursive_chunk", "semantic_chunk", "bm25_search", "vector_topk", "rrf_fuse", "hybrid_search",
    "topo_levels", "watermark_tumbling_count", "stream_sessionize",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "bench", shuffle_partitions=max(4, int(cpus)) if cpus.isdigit() else 8,
                          **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM up
    times = {}
    for name in wanted:
        t = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total_time_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
