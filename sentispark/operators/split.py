"""Exact, repeatable train / validation / test split (M1) and class shares.

``randomSplit`` is neither exact nor stable across partitionings, so rows are
ordered by ``md5(seed || '-' || key)``.  The held-out set is the ``ceil(f*n)``
rows with the smallest hashes; of them the first ``floor(m/2)`` are validation, the
rest test -- the sizes of two chained ``train_test_split`` calls.  Only the
narrow (hash, key) table is sorted, to find the two cut points (two rows, read by the
driver); every row's part is then a pure function of its key and two literals, so wide rows
take part in no sort or join and two uses of one split agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.operators.ranking import global_row_number


def split_hash(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))


def train_val_test_split(df: DataFrame, key: str = "row_id", seed: int = 2000,
                         test_size: float = 0.02, split_col: str = "split") -> DataFrame:
    h = split_hash(F.col(key), seed)
    ranked = global_row_number(df.select(h.alias("__h"), F.col(key).alias("__k")), [F.col("__h"), F.col("__k")], "__r")
    held_out = math.ceil(test_size * ranked.count())
    cuts = {r["__r"]: r for r in ranked.where(F.col("__r").isin(held_out // 2, held_out)).collect()}
    key_type = df.schema[key].dataType

    def until(rank: int) -> Column:
        if rank not in cuts:  # no row is that far in front
            return F.lit(False)
        cut_h, cut_k = F.lit(cuts[rank]["__h"]), F.lit(cuts[rank]["__k"]).cast(key_type)
        return (h < cut_h) | ((h == cut_h) & (F.col(key) <= cut_k))

    part = F.when(until(held_out // 2), "validation").when(until(held_out), "test").otherwise("train")
    return df.withColumn(split_col, part)


def split_sql(src: str, key: str = "row_id", seed: int = 2000, test_size: float = 0.02) -> str:
    """SQL text of the same split over relation ``src`` (adds ``split``)."""
    return f"""
SELECT * EXCLUDE (__r, __n, __m), CASE WHEN __r > __m THEN 'train'
  WHEN __r <= floor(__m / 2) THEN 'validation' ELSE 'test' END AS split FROM (
  SELECT *, ceil(CAST({test_size} AS DOUBLE) * __n) AS __m FROM (
    SELECT *, row_number() OVER (ORDER BY md5('{seed}-' || CAST({key} AS VARCHAR)), {key}) AS __r,
           count(*) OVER () AS __n FROM {src}))"""
