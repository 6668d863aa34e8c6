"""Run the headline queries on local[BENCH_CPUS] over BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans import catalog  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "curation_flagship", "caption_metrics", "caption_issues", "caption_stats", "token_buckets", "word_frequency", "group_report", "balanced_topk", "category_quota", "stratified_sample",
    "round_robin_sample", "temporal_segments_best", "exact_dedup", "track_stats", "merge_segments", "segment_overlap", "speaker_map", "temporal_neighbors", "interpolate_rows", "describe_numeric",
    "quality_filter_reasons", "checkpoint_select", "centroids", "best_match", "pair_consistency", "near_dup_pairs", "merge_records_first", "scene_frames",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    took = {}
    for name in HEADLINE:
        times = []
        if runs > 1:  # a warm-up that isn't counted
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        for _ in range(runs):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(sorted(times)[len(times) // 2], 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
