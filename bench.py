"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm the JVM, then is timed on a second run that
executes the whole plan into Spark's no-op sink (nothing is collected to the
driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["group_auc", "average_precision", "threshold_metrics", "profile_rollup",
            "stratified_sample", "stratified_folds", "chunk_sample", "truncate_to_cap",
            "oof_group_auc", "cv_summary", "ensemble_mean", "weighted_blend", "submission_join",
            "dictionary_encode", "hashed_fingerprint", "text_descriptors", "feature_table",
            "token_gain_topk", "stream_ingest", "cv_oof",
            "quick_screen"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("screenlake-bench")
             .config("spark.driver.memory", os.environ.get("BENCH_MEM", "4g"))
             .config("spark.sql.shuffle.partitions", str(max(4, 2 * cpus)))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from screenlake.plans.catalog import QUERIES
    from screenlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    names = sys.argv[1:] or HEADLINE
    times = {}
    for n in names:
        try:
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # keep the line well-formed; report the failure
            times[n] = None
            print(f"{n} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    ok = [v for v in times.values() if v is not None]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(ok), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "failed": [k for k, v in times.items() if v is None]}))


if __name__ == "__main__":
    main()
