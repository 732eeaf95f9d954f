"""Headline-query timings.

Runs the main jobs on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line.  Each query is executed in
full with the no-op sink (every row produced, nothing collected).

Before timing, every headline query runs once on the smallest test scale
($BENCH_WARMUP_DIR, default /root/testdata/sf0.001, skipped if absent) so
the JVM's JIT has compiled Spark's operators; the timed runs then measure
steady-state execution, not compiler warm-up."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revlens.plans.catalog import QUERIES  # noqa: E402
from revlens.session import build_session  # noqa: E402

HEADLINE = [
    "clean_reviews",          # T18: anti join + cleaning chain + label
    "product_aspects",        # A12: seven rules, polarity, top-5 per product
    "naive_bayes_predict",    # L5/L7: TF-IDF + NB fit and score
    "logistic_predict",       # L6/L7: TF-IDF + LR fit and score
    "tfidf_exact",            # L4
    "encode_fixed_length",    # L9/L10
    "eval_weighted",          # E2
    "roc_auc",                # E6
    "balanced_sample",        # K2
    "similar_enriched_long",  # J4 + X1
    "similar_products_topk",  # X2
    "json_keyword_filter",    # S4/S7 + F5
    "reviews_per_product",    # G1 (long form)
    "chunk_reviews",          # G2
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.driver.extraJavaOptions": os.environ.get("BENCH_JAVA_OPTS", "")})
    # warm-up: JIT, Python workers, parquet footers
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        for n in names:
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    QUERIES["clean_label_summary"](spark, sf_dir).collect()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
