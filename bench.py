"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (full computation,
nothing collected); prints one JSON line with per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sentispark.plans.catalog import load_all  # noqa: E402
from sentispark.session import get_spark  # noqa: E402

HEADLINE = (
    "clean_text", "term_freq_by_class", "term_scores", "rank_frequency", "length_box_stats",
    "train_val_test_split", "tfidf", "chi2_select", "multinomial_nb", "roc_curve",
    "nearest_centroid", "phrase_candidates", "apply_phrases", "texts_to_sequences",
    "most_similar_words",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    reg = load_all()
    # warm the JVM (codegen, class loading) outside the timed region
    reg["class_counts"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
