"""Aggregations over rows and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.operators.ranking import exact_quantiles


def class_counts(df: DataFrame, label_col: str = "target") -> DataFrame:
    """A1: rows per label."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_rows"))


def length_box_stats(df: DataFrame, col: str) -> DataFrame:
    """A2: box-plot numbers: quartiles (linear interpolation), IQR, whiskers at
    the furthest datum within 1.5 IQR, and the outlier count.

    Quartiles are exact and distributed (histogram + range-partitioned
    running count); the whiskers are one more aggregate pass.
    """
    qs = (exact_quantiles(df, col, [0.25, 0.5, 0.75])
          .groupBy().pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value")))
    qs = qs.toDF("q1", "median", "q3").withColumn("iqr", F.col("q3") - F.col("q1"))
    x = F.col(col).cast("double")
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    stats = (df.select(x.alias("__x")).crossJoin(F.broadcast(qs))
             .groupBy("q1", "median", "q3", "iqr")
             .agg(F.min(F.when(F.col("__x") >= lo, F.col("__x"))).alias("whisker_low"),
                  F.max(F.when(F.col("__x") <= hi, F.col("__x"))).alias("whisker_high"),
                  F.count_if((F.col("__x") < lo) | (F.col("__x") > hi)).alias("n_outliers")))
    return stats


def max_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Longest text in words."""
    return df.agg(F.max(F.size(F.split(text_col, " "))).alias("max_words"),
                  F.count(F.lit(1)).alias("n_docs"))


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def class_share(df: DataFrame, split_col: str = "split", label_col: str = "label") -> DataFrame:
    """Entries and % negative / positive per split (labels 0/1)."""
    return (df.groupBy(split_col)
            .agg(F.count(F.lit(1)).alias("entries"),
                 F.round(F.avg((F.col(label_col) == 0).cast("double")) * 100, 2).alias("pct_negative"),
                 F.round(F.avg((F.col(label_col) == 1).cast("double")) * 100, 2).alias("pct_positive")))


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Documents per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_docs"))
