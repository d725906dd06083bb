"""Token and term aggregates (A3-A6, A8-A10), term scores (F1-F11) and top-k (K1-K4).

Shape of the work at scale: tokens are exploded next to the scan, counted
with a partial (map-side) hash aggregate, shuffled once on ``term`` and
finished there; a hot term such as ``the`` therefore reaches the shuffle as
one partial count per input partition, never as its raw occurrences.  Whole-
table statistics (class totals, mean and deviation) are one-row aggregates
joined back by broadcast.  Global ranks use the range-partitioned ranker.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.functions.mathx import hmean2, normcdf_expr
from sentispark.functions.stopwords import ENGLISH_STOP_WORDS
from sentispark.operators.ranking import global_row_number


def remove_stop_words(tokens: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """T16 on a token array (the list is a literal of fixed, small size)."""
    return F.filter(tokens, lambda w: ~w.isin(*stop_words))


def vocabulary(tokens: DataFrame, term_col: str = "term") -> DataFrame:
    """A3: distinct terms."""
    return tokens.select(term_col).distinct()


def doc_term_counts(tokens: DataFrame, doc_col: str = "row_id", term_col: str = "term") -> DataFrame:
    """A4: the document-term matrix in long form ``(doc, term, tf)``."""
    return tokens.groupBy(doc_col, term_col).agg(F.count(F.lit(1)).alias("tf"))


def term_freq_by_class(tokens: DataFrame, label_col: str = "target",
                       term_col: str = "term") -> DataFrame:
    """A5: ``(term, negative, positive, total)`` in one aggregation pass."""
    pos = F.col(label_col) > 0
    return (tokens.groupBy(term_col)
            .agg(F.count_if(~pos).alias("negative"), F.count_if(pos).alias("positive"))
            .withColumn("total", F.col("negative") + F.col("positive")))


def term_totals(tokens: DataFrame, term_col: str = "term") -> DataFrame:
    """``(term, total)`` where no class is asked for."""
    return tokens.groupBy(term_col).agg(F.count(F.lit(1)).alias("total"))


def top_k(df: DataFrame, k: int, by: str, tie: str = "term", ascending: bool = False) -> DataFrame:
    """K1-K3: the first ``k`` rows by ``by`` (ties by ``tie`` ascending).
    Planned as TakeOrderedAndProject: each partition keeps its own top k."""
    key = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(key, F.col(tie).asc()).limit(k)


def term_freq_limited(tokens: DataFrame, max_features: int = 10000, stop_words=ENGLISH_STOP_WORDS,
                      label_col: str = "target") -> DataFrame:
    """Stop words out, then the ``max_features`` most frequent terms."""
    kept = tokens.where(~F.col("term").isin(*stop_words)) if stop_words else tokens
    return top_k(term_freq_by_class(kept, label_col), max_features, "total")


def class_totals(tf: DataFrame) -> DataFrame:
    """One row with the class totals used as denominators."""
    return tf.agg(F.sum("negative").alias("neg_sum"), F.sum("positive").alias("pos_sum"))


def term_scores(tf: DataFrame, bound: int | None = None) -> DataFrame:
    """F1-F6 on a term-frequency table.

    Needs two whole-table statistics: class totals, then the mean and sample
    deviation of the rates and shares.  When the table is a top-k of at most
    ``bound`` rows (the usual ``max_features`` cut) they are windows over
    those k rows, so the corpus aggregation behind the top-k runs once.
    Without a bound they are one-row aggregates joined back by broadcast
    (never a window over an unbounded table).
    """
    from pyspark.sql import Window
    cols = ["pos_rate", "pos_freq_pct", "neg_rate", "neg_freq_pct"]
    if bound is not None:
        whole = Window.partitionBy()  # the k rows of a bounded top-k
        base = (tf.withColumn("pos_rate", F.col("positive") / F.col("total"))
                .withColumn("pos_freq_pct", F.col("positive") / F.sum("positive").over(whole))
                .withColumn("neg_rate", F.col("negative") / F.col("total"))
                .withColumn("neg_freq_pct", F.col("negative") / F.sum("negative").over(whole)))
        out = base.select("*", *[F.avg(c).over(whole).alias(f"{c}__mean") for c in cols],
                          *[F.stddev_samp(c).over(whole).alias(f"{c}__std") for c in cols])
    else:
        sums = class_totals(tf)
        base = (tf.crossJoin(F.broadcast(sums))
                .withColumn("pos_rate", F.col("positive") / F.col("total"))
                .withColumn("pos_freq_pct", F.col("positive") / F.col("pos_sum"))
                .withColumn("neg_rate", F.col("negative") / F.col("total"))
                .withColumn("neg_freq_pct", F.col("negative") / F.col("neg_sum"))
                .drop("pos_sum", "neg_sum"))
        stats = base.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols],
                         *[F.stddev_samp(c).alias(f"{c}__std") for c in cols])
        out = base.crossJoin(F.broadcast(stats))
    out = out.withColumn("pos_hmean", hmean2(F.col("pos_rate"), F.col("pos_freq_pct")))
    for c in cols:
        out = out.withColumn(f"{c}_normcdf", F.expr(normcdf_expr(c, f"{c}__mean", f"{c}__std")))
    out = (out.withColumn("pos_normcdf_hmean", hmean2(F.col("pos_rate_normcdf"), F.col("pos_freq_pct_normcdf")))
           .withColumn("neg_normcdf_hmean", hmean2(F.col("neg_rate_normcdf"), F.col("neg_freq_pct_normcdf"))))
    return out.drop(*[f"{c}__mean" for c in cols], *[f"{c}__std" for c in cols])


def mean_std(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and sample standard deviation per column (long form)."""
    parts = [df.agg(F.lit(c).alias("column_name"), F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("std")) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def zipf_expected(tf: DataFrame, k: int = 500, s: float = 1.0) -> DataFrame:
    """top-k terms by total with the Zipf expectation ``top / rank^s``.
    The rank is taken over the k rows only."""
    from pyspark.sql import Window
    top = top_k(tf, k, "total")
    w = Window.orderBy(F.col("total").desc(), F.col("term"))
    ranked = top.withColumn("rank", F.row_number().over(w))
    first = F.first("total").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return ranked.select("rank", "term", "total",
                         (first / F.pow(F.col("rank").cast("double"), s)).alias("expected"))


def rank_frequency(tf: DataFrame) -> DataFrame:
    """F8/K4: rank (1-based, by total desc then term) of every term, with
    log10 of rank and frequency.  Distributed ranking, no global window."""
    ranked = global_row_number(tf.select("term", "total"),
                               [F.col("total").desc(), F.col("term").asc()], "rank")
    return ranked.select("rank", "term", "total",
                         F.log10(F.col("rank").cast("double")).alias("log_rank"),
                         F.log10(F.col("total").cast("double")).alias("log_freq"))


def log_spaced_terms(tf: DataFrame, n_points: int = 25, start_exp: float = -0.5) -> DataFrame:
    """terms at ``n_points`` log-spaced zero-based ranks from 10^start to
    n-2 (``numpy.logspace(...).astype(int)``; repeated ranks kept)."""
    ranked = rank_frequency(tf)
    n = tf.agg(F.count(F.lit(1)).alias("n"))
    idx = F.sequence(F.lit(0), F.lit(n_points - 1))
    stop = F.log10((F.col("n") - 2).cast("double"))
    step = (stop - F.lit(start_exp)) / F.lit(n_points - 1)
    # the last point is n - 2 exactly (10 ** log10(n - 2) may round below it)
    pos = lambda i: F.when(i == n_points - 1, F.col("n") - 2).otherwise(
        F.floor(F.pow(F.lit(10.0), F.lit(start_exp) + i * step)))
    points = n.select(F.posexplode(F.transform(idx, pos)).alias("point", "zero_rank"))
    return (points.join(ranked, F.col("rank") == F.col("zero_rank") + 1)
            .select("point", "zero_rank", "term", "total"))


def wordcloud_weights(tokens: DataFrame, k: int = 200, label_col: str = "target") -> DataFrame:
    """per class, the k most frequent terms and ``freq / max freq``."""
    from pyspark.sql import Window
    counts = tokens.groupBy(label_col, "term").agg(F.count(F.lit(1)).alias("freq"))
    w = Window.partitionBy(label_col).orderBy(F.col("freq").desc(), F.col("term"))
    # row_number() <= k over a partitioned window is planned as a group limit:
    # each partition keeps only k rows per class before the shuffle.
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    wmax = Window.partitionBy(label_col)
    return top.withColumn("weight", F.col("freq") / F.max("freq").over(wmax))


def color_scale(scores: DataFrame, x: str = "pos_normcdf_hmean", lo_col: str = "pos_normcdf_hmean",
                hi_col: str = "neg_normcdf_hmean") -> DataFrame:
    """linear 0..1 scale, low = min(lo_col), high = max(hi_col), clamped."""
    bounds = scores.agg(F.min(lo_col).alias("__lo"), F.max(hi_col).alias("__hi"))
    v = (F.col(x) - F.col("__lo")) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0))
    return (scores.crossJoin(F.broadcast(bounds))
            .withColumn("color", F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))
            .drop("__lo", "__hi"))


def logspace_ranks(n: int, n_points: int = 25, start_exp: float = -0.5) -> list[int]:
    """Plain-Python reference of F9's rank positions (for tests)."""
    stop = math.log10(n - 2)
    return [n - 2 if i == n_points - 1 else int(10 ** (start_exp + i * (stop - start_exp) / (n_points - 1)))
            for i in range(n_points)]
