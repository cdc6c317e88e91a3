"""Benchmark: run the headline registered queries at $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with the no-op sink (every row is produced,
nothing is collected to the driver). Timings are wall seconds per query,
warm JVM (one untimed warm-up query first).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ragloom.plans.registry import load_all  # noqa: E402
from ragloom.session import local_session  # noqa: E402

HEADLINE = [
    "dense_topk", "dense_metrics", "nested_subset_scaling", "knee_report", "bm25_topk", "lexical_qrels",
    "hashed_dense_topk", "rrf_hybrid", "rerank_two_stage", "lexical_retrieval_eval", "ivf_probe_sweep",
    "usage_today", "usage_breakdown", "usage_rollup", "latency_percentiles", "cost_by_model", "rate_limit_replay",
    "failure_window", "breaker_replay", "fallback_outcome", "guard_scan", "inflight_peak", "trace_assembly",
    "semantic_cache_candidates", "html_main_text", "parse_status", "fixed_chunks", "chunk_sweep", "recursive_chunks",
    "clean_captions", "dataset_clean_v2", "quality_rules", "version_diff", "extraction_eval", "classification_report",
    "char_vocab", "bigram_loss", "temperature_topk", "concept_expansion", "rag_context", "token_window_stream",
    "dedupe_stream", "semantic_cache_sequential", "breaker_stream", "semantic_cache_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    reg = load_all()
    todo = list(reg) if names == "all" else (names.split(",") if names else HEADLINE)
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="ragloom-bench")
    # warm-up: JVM code paths and Python workers (Arrow batches), untimed
    reg["class_balance"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(64).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for n in todo:
        t0 = time.time()
        try:
            reg[n].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[n] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"# {n}: {times.get(n, 'FAILED')}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": sf, "cpus": cpus, "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
