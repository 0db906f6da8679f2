"""Benchmark the headline queries.

Runs each registered query over ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]`` and fully materialises its result with the ``noop``
sink (every row computed, nothing collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from penmark.plans.catalog import QUERIES, load_all  # noqa: E402
from penmark.plans.jobs import predict_job, train_job  # noqa: E402
from penmark.session import build_session, scratch_path  # noqa: E402
from penmark.sources.fixtures import recipes_d  # noqa: E402

HEADLINE = [
    "class_counts", "group_box_stats", "outlier_rows", "global_quantile",
    "text_concat", "feature_extraction", "stratified_split", "label_encode",
    "classification_report", "confusion_matrix",
    "scan_strict", "scan_tolerant", "parse_list_tolerant",
    "knn_within_class", "smote_oversample",
    "text_classifier_score", "train_job", "predict_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="penmark-bench-")
    spark = build_session(f"local[{cpus}]", app="penmark-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    load_all()
    # warm-up: JVM, Python workers and the file listing, not timed
    QUERIES["class_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        run = QUERIES[n]
        if n == "predict_job":          # scoring alone, from artifacts saved before the clock starts
            rows, path = recipes_d(spark, sf_dir), scratch_path(spark, "bench-artifacts")
            train_job(rows, artifacts_path=path)
            run = lambda s, d: predict_job(rows.drop("label"), path)
        t = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t, 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
