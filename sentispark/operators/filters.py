"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.functions import text as T
from sentispark.operators.ranking import global_row_number


def drop_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep only the named columns (pruned into the scan)."""
    return df.select(*keep)


def text_length(df: DataFrame, text_col: str = "text", out: str = "pre_clean_len") -> DataFrame:
    """Characters per text."""
    return df.withColumn(out, F.length(text_col).cast("bigint"))


def long_texts(df: DataFrame, n: int = 140, len_col: str = "pre_clean_len") -> DataFrame:
    """Rows longer than ``n`` characters."""
    return df.where(F.col(len_col) > n)


def class_filter(df: DataFrame, value: int, label_col: str = "target") -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(label_col) == value)


def any_null(cols: list[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def null_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P5: rows with a null in any of ``cols`` (default: all)."""
    return df.where(any_null(cols or df.columns))


def null_row_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number of rows with any null."""
    return df.agg(F.count_if(any_null(cols or df.columns)).alias("null_rows"))


def drop_empty(df: DataFrame, text_col: str = "text", na_literals: bool = True) -> DataFrame:
    """Drop rows with a null anywhere, and texts that are blank or a
    missing-value literal (the CSV round trip of the study dropped those)."""
    from sentispark.operators.corpus import keep_where
    others = [c for c in df.columns if c != text_col]
    kept = keep_where(F.col(text_col), lambda t: ~T.is_empty_text(t, na_literals))
    return (df.na.drop(subset=others) if others else df).select(
        *[kept.alias(c) if c == text_col else F.col(c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P8."""
    return df.withColumnsRenamed(mapping)


def terms_from(df: DataFrame, start: str = "aa", term_col: str = "term") -> DataFrame:
    """The lexicographic slice of the vocabulary from ``start`` on."""
    return df.where(F.col(term_col) >= start)


def data_dictionary(df: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """One row per column: name, type, description, non-null count, rows,
    number of columns.  One aggregate pass computes every count."""
    descriptions = descriptions or {}
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit(c).alias("column_name"),
                        F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                        F.lit(descriptions.get(c, "")).alias("description"),
                        F.col(f"__nn_{i}").alias("non_null"),
                        F.lit(i).alias("position"))
               for i, c in enumerate(df.columns)]
    return (counts.select(F.explode(F.array(*entries)).alias("e"), F.col("__rows").alias("n_rows"))
            .select("e.*", "n_rows", F.lit(len(df.columns)).alias("n_columns")))


def range_partition_rows(df: DataFrame, order_col: str, n_chunks: int = 4) -> DataFrame:
    """Chunk id by position, ``floor((rn - 1) / ceil(N / n_chunks))``."""
    ranked = global_row_number(df, [F.col(order_col)], "rn")
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    return (ranked.crossJoin(F.broadcast(n))
            .withColumn("chunk", F.floor((F.col("rn") - 1) / F.ceil(F.col("__n") / n_chunks))
                        .cast("bigint"))
            .drop("__n"))


def class_head_sample(df: DataFrame, frac: float, label_col: str = "target",
                      order_col: str = "row_id") -> DataFrame:
    """First ``int(frac * N)`` rows of each class, N = all rows.

    A class may hold most rows, so no window is partitioned by class: rows
    get a global position in (class, key) order from the range-partitioned
    ranker, and the per-class position subtracts the class's start offset,
    taken from the class-count table (one row per class).
    """
    from pyspark.sql import Window
    place = global_row_number(df.select(label_col, order_col), [F.col(label_col), F.col(order_col)], "__g")
    ranked = df.join(place, [label_col, order_col])
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.orderBy(label_col).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(label_col, F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__start"))
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    k = F.floor(F.col("__n") * F.lit(frac))
    return (ranked.join(F.broadcast(starts), label_col)
            .crossJoin(F.broadcast(n))
            .where(F.col("__g") - F.col("__start") <= k)
            .drop("__g", "__start", "__n"))


def minibatch_assign(df: DataFrame, batch_size: int, order_col: str = "row_id") -> DataFrame:
    """Consecutive mini-batches of ``batch_size`` rows in ``order_col``."""
    ranked = global_row_number(df, [F.col(order_col)], "__rn")
    return (ranked.withColumn("batch_id", F.floor((F.col("__rn") - 1) / batch_size).cast("bigint"))
            .drop("__rn"))


def block_label(line_no: Column, split_block, label_block=None) -> tuple[Column, Column]:
    """Split and sentiment from a line number by position blocks
    (train, test, extra, extra; each half positive then half negative).
    Block sizes are ints or Columns; ``label_block`` defaults to half."""
    sb = split_block if isinstance(split_block, Column) else F.lit(split_block)
    lbk = (sb / 2) if label_block is None else (
        label_block if isinstance(label_block, Column) else F.lit(label_block))
    b = F.floor(line_no / sb)
    split = F.when(b == 0, "train").when(b == 1, "test").when(b.isin(2, 3), "extra")
    lb = F.floor(line_no / lbk)
    sent = (F.when(lb.isin(0, 2), F.lit(1.0)).when(lb.isin(1, 3), F.lit(0.0))
            .otherwise(F.lit(None).cast("double")))
    return split, sent


def threshold_predict(score: Column, threshold: float = 0.0) -> Column:
    """Score below the threshold -> 0, otherwise 1."""
    return F.when(score < threshold, 0).otherwise(1).cast("int")


def round_probability(p: Column) -> Column:
    """Nearest integer, halves to even (``numpy.rint``)."""
    return F.bround(p, 0)


def preview(df: DataFrame, n: int = 5, order_col: str = "row_id") -> DataFrame:
    """First ``n`` rows in key order (a top-k, not a full sort)."""
    return df.orderBy(order_col).limit(n)


def normalize_label(c: Column | str = "target") -> Column:
    """0/4 -> 0/1."""
    c = F.col(c) if isinstance(c, str) else c
    return (c > 0).cast("int")
