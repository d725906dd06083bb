"""Summarise the final (adaptive) physical plans of registered queries.

usage: python tools/plan_report.py [sf_dir] [name ...]  -> markdown table on stdout

Counts shuffles (hash / range / round-robin / single-partition exchanges),
broadcasts, reused exchanges and regexp_replace nodes (one cleaner = 33) in the
plan Spark actually ran, plus the columns the parquet scans read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sentispark.plans.catalog import load_all  # noqa: E402
from sentispark.session import get_spark  # noqa: E402

DEFAULT = ("clean_text", "term_freq_by_class", "term_scores", "rank_frequency", "length_box_stats",
           "train_val_test_split", "tfidf", "multinomial_nb", "roc_curve", "apply_phrases",
           "texts_to_sequences", "most_similar_words", "wordcloud_weights", "class_head_sample")


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or DEFAULT
    spark = get_spark("local[8]", shuffle_partitions=8)
    reg = load_all()
    print("| query | hash | range | round-robin | single | broadcast | reused | regexp nodes | scan columns |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for n in names:
        df = reg[n].build(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # the final plan lists each stage once; the trailing initial plan is dropped
        final = plan.split("\n+- == Initial Plan ==")[0]
        scans = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan()
                                      .toString())))
        print(f"| {n} | {final.count('Exchange hashpartitioning')} | {final.count('Exchange rangepartitioning')} | "
              f"{final.count('RoundRobinPartitioning')} | {final.count('Exchange SinglePartition')} | "
              f"{final.count('BroadcastExchange')} | {final.count('ReusedExchange')} | "
              f"{final.count('regexp_replace(')} | "
              f"{'; '.join(scans)[:80]} |")


if __name__ == "__main__":
    main(sys.argv[1:])
