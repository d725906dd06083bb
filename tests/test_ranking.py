"""Global positions and the split on inputs large enough for range sampling."""

from pyspark.sql import functions as F

from sentispark.operators.ranking import global_row_number, global_running_sum
from sentispark.operators.split import train_val_test_split


def _rows(spark, n):
    return spark.range(n, numPartitions=8).select(
        F.md5(F.col("id").cast("string")).alias("k"), F.col("id"), F.repeat(F.lit("x"), 50).alias("payload"))


def test_row_number_with_payload_is_a_permutation(spark):
    n = 200_000
    ranked = global_row_number(_rows(spark, n), [F.col("k"), F.col("id")], "rn", 8)
    got = [ranked.agg(F.count_distinct("rn"), F.min("rn"), F.max("rn"), F.sum(F.xxhash64("id", "rn") % 1000003)).first()
           for _ in range(2)]
    assert got[0] == got[1]
    assert tuple(got[0])[:3] == (n, 1, n)
    again = global_row_number(_rows(spark, n), [F.col("k"), F.col("id")], "rn", 8)
    assert again.agg(F.sum(F.xxhash64("id", "rn") % 1000003)).first()[0] == got[0][3]


def test_running_sum_with_payload(spark):
    n = 50_000
    out = global_running_sum(_rows(spark, n), [F.col("id")], {"s": F.lit(1)}, 8)
    assert out.where(F.col("s") != F.col("id") + 1).count() == 0


def test_split_sizes_exact_and_repeatable(spark):
    n = 400_000
    df = _rows(spark, n).withColumnRenamed("id", "row_id")
    parts = train_val_test_split(df, test_size=0.4)
    got = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert got == {"train": 240_000, "validation": 80_000, "test": 80_000}
    other = train_val_test_split(df.select("row_id"), test_size=0.4)
    assert parts.join(other.withColumnRenamed("split", "s2"), "row_id").where("split <> s2").count() == 0
