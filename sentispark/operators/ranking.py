"""Global order statistics without a one-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row into
one task.  The helpers here keep the work distributed:

* rows are range-partitioned on the ordering (balanced by sampling), sorted
  inside each partition and tagged with the partition and their place in it;
* the tagged rows are checkpointed.  Range boundaries are sampled anew each time
  Spark plans the exchange, so rows and per-partition counts may only be taken
  from one and the same run of it;
* each partition counts (or sums) its rows -- a table with one row per
  partition, so it has a fixed, small size and is broadcast;
* a running total over that small table gives each partition its offset.

The checkpoint writes what travels: pass the ordering and a key and join wide
rows back on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentispark.session import cut_lineage

_PID, _MID, _OFF, _N = "__pid", "__mid", "__off", "__n"


def _tagged(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    parts = [num_partitions] if num_partitions else []
    ordered = df.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
    # the low 33 bits of monotonically_increasing_id are the row's place in its partition
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return cut_lineage(ordered.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, place))


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of the row in ``order`` (a total order)."""
    tagged = _tagged(df, order, num_partitions)
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_N).over(w), F.lit(0)).alias(_OFF))
    return (tagged.join(F.broadcast(offsets), _PID)
            .withColumn(name, F.col(_OFF) + F.col(_MID) + 1)
            .drop(_PID, _MID, _OFF))


def global_running_sum(df: DataFrame, order: list[Column], sums: dict[str, Column],
                       num_partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums ``{out_name: column}`` along ``order``."""
    tagged = _tagged(df, order, num_partitions)
    part = tagged.groupBy(_PID).agg(*[F.sum(c).alias("__p_" + k) for k, c in sums.items()])
    w_small = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(_PID, *[F.coalesce(F.sum("__p_" + k).over(w_small), F.lit(0))
                                  .alias("__o_" + k) for k in sums])
    w_local = (Window.partitionBy(_PID).orderBy(_MID)
               .rowsBetween(Window.unboundedPreceding, 0))
    out = tagged.join(F.broadcast(offsets), _PID)
    for k, c in sums.items():
        out = out.withColumn(k, F.col("__o_" + k) + F.sum(c).over(w_local))
    return out.drop(_PID, _MID, *["__o_" + k for k in sums])


def exact_quantiles(df: DataFrame, col: str, probs: list[float],
                    num_partitions: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (``quantile_cont``) of a numeric column.

    Works on the histogram ``value -> count`` (bounded by the number of
    distinct values, not rows), so no task ever holds a whole column.
    Returns one row per probability: ``(prob, value)``.
    """
    spark = df.sparkSession
    hist = (df.where(F.col(col).isNotNull())
            .groupBy(F.col(col).cast("double").alias("v")).count())
    cum = global_running_sum(hist, [F.col("v")], {"cum": F.col("count")}, num_partitions)
    total = hist.agg(F.sum("count").alias("n"))
    p = spark.createDataFrame([(float(x),) for x in probs], "prob double")
    # 0-based fractional position of each quantile, and its two neighbours
    pos = (p.crossJoin(F.broadcast(total))
           .select("prob", (F.col("prob") * (F.col("n") - 1)).alias("pos"))
           .select("prob", "pos", F.floor("pos").alias("lo"), F.ceil("pos").alias("hi")))
    ranks = (pos.select("prob", F.col("lo").alias("k"), F.lit("lo").alias("side"))
             .unionByName(pos.select("prob", F.col("hi").alias("k"), F.lit("hi").alias("side"))))
    # the value at 0-based position k lies in the bucket with cum-count > k >= cum-count - count
    hit = (cum.join(F.broadcast(ranks),
                    (F.col("k") >= F.col("cum") - F.col("count")) & (F.col("k") < F.col("cum")))
           .groupBy("prob").pivot("side", ["lo", "hi"]).agg(F.first("v"))
           .withColumnsRenamed({"lo": "v_lo", "hi": "v_hi"}))
    frac = F.col("pos") - F.floor("pos")
    return (hit.join(F.broadcast(pos.select("prob", "pos")), "prob")
            .select("prob", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac).alias("value")))
