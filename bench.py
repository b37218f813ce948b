"""Benchmark the headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query runs standalone (fitted state is not shared between queries) and is forced to completion
with the no-op sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "nb_predict",
    "svm_scores",
    "pipeline_predict",
    "tfidf_fit",
    "chi2_scores",
    "vocabulary_topn",
    "clean_titles",
    "label_frequency",
    "micro_metrics",
    "threshold_sweep",
    "tune_thresholds",
    "confusion_patterns",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tagwise.plans import queries as Q
    from tagwise.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    qs = Q.QUERIES
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    times: dict[str, float] = {}
    for name in names:
        Q._FIT_CACHE.clear()
        spark.catalog.clearCache()
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
