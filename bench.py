"""Benchmark the headline queries: prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Every query is fully
executed into Spark's ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from segmenta.plans import QUERIES  # noqa: E402
from segmenta.session import get_spark  # noqa: E402

HEADLINE = [
    "question_stats", "numeric_summary", "multi_mode_lineitem", "correlation_matrix", "histogram",
    "category_frequencies", "eda_numeric", "filter_range_category", "page_of_records", "minmax_survey",
    "sentiment_rows", "sentiment_documents", "tfidf_terms", "tfidf_documents", "assign_nearest",
    "silhouette_exact", "dbscan_labels", "single_linkage", "kmeans_fit", "gmm_fit", "pca_scores",
    "page_script_vars", "stream_scoring",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    scratch = tempfile.mkdtemp(prefix="segmenta-bench-")
    spark = get_spark("segmenta-bench", cpus=cpus, shuffle_partitions=max(8, cpus * 2))
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    QUERIES["total_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times, errors = {}, {}
    for name in names:
        t = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t, 3)
        except Exception as e:  # report, keep going
            errors[name] = f"{type(e).__name__}: {e}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
