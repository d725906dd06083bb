"""Classifiers that are closed-form aggregates over the long (doc, term, value)
table: multinomial and Bernoulli naive Bayes (M11, M12), nearest centroid
(M17) and the lexicon polarity baseline (M22).

Training is one group-by over the training rows (class sums beside the vocabulary
counts); totals are one row, read once and used as literals.  Scoring joins a document's terms with the
per-term weight table (vocabulary-sized, so broadcast under the vocabulary
bound) and sums per document.  No vector ever has to fit on one machine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.session import write_once


def class_sums(label: str = "label") -> tuple[Column, ...]:
    """Aggregates of a term over training counts: occurrences ``c0, c1`` and documents ``d0, d1`` by class."""
    def of(c, value):
        return F.sum(F.when(F.col(label) == c, value).otherwise(0))
    return (*[of(c, F.col("tf")).alias(f"c{c}") for c in (0, 1)], *[of(c, F.lit(1)).alias(f"d{c}") for c in (0, 1)])


def class_sizes(labels: DataFrame, label: str = "label") -> tuple[int, int]:
    """Training documents of class 0 and 1: one row, read once."""
    row = labels.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return row.n0, row.n1


def _log_odds(sizes: tuple[int, int]) -> Column:
    return F.log(F.lit(sizes[1]) / F.lit(sizes[0]))


def multinomial_nb_fit(vocab: DataFrame, sizes: tuple[int, int], alpha: float = 1.0) -> tuple[DataFrame, Column]:
    """M11 fit on a vocabulary with :func:`class_sums` (a table, read twice).  Returns the term's
    log-likelihood ratio ``w = ln P(t|1) - ln P(t|0)`` and the bias."""
    tot = vocab.agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"), F.count(F.lit(1)).alias("V")).first()

    def log_p(c):
        return F.log((F.col(c) + alpha) / F.lit((tot[c] or 0) + alpha * tot.V))
    return vocab.select("term", (log_p("c1") - log_p("c0")).alias("w")), _log_odds(sizes)


def linear_score(counts: DataFrame, weights: DataFrame, bias: Column, docs: DataFrame,
                 value: str = "tf", key: str = "row_id") -> DataFrame:
    """Score = bias + sum(value * w) per document; documents with no known
    term get the bias alone.  ``docs`` lists every document to score."""
    s = counts.join(weights, "term").groupBy(key).agg(F.sum(F.col(value) * F.col("w")).alias("__s"))
    return docs.join(s, key, "left").withColumn("score", bias + F.coalesce("__s", F.lit(0.0))).drop("__s")


def bernoulli_nb_fit(vocab: DataFrame, sizes: tuple[int, int], alpha: float = 1.0) -> tuple[DataFrame, Column]:
    """M12 fit on a vocabulary with :func:`class_sums` (a table, read twice).
    ``w = ln(p1/(1-p1)) - ln(p0/(1-p0))`` for present terms, and the bias
    holds the prior odds plus the sum of ``ln((1-p1)/(1-p0))`` over the vocabulary."""
    p = vocab.select("term", *[((F.col(f"d{c}") + alpha) / F.lit(sizes[c] + 2 * alpha)).alias(f"p{c}") for c in (0, 1)])
    w = p.select("term", (F.log(F.col("p1") / (1 - F.col("p1"))) - F.log(F.col("p0") / (1 - F.col("p0")))).alias("w"))
    absent = p.agg(F.sum(F.log((1 - F.col("p1")) / (1 - F.col("p0")))).alias("a")).first().a
    return w, F.lit(absent or 0.0) + _log_odds(sizes)


def nearest_centroid(values: DataFrame, is_train: str, sizes: tuple[int, int], docs: DataFrame,
                     key: str = "row_id", label: str = "label", value: str = "value") -> DataFrame:
    """Class means of the (sparse) feature vectors ``(key, label, term, value)`` of the training
    rows, implicit zeros included (sum / class size); predict the class at the smaller Euclidean
    distance, ``|x|^2 - 2 x.mu + |mu|^2`` (ties -> class 0)."""
    def mean(c):
        total = F.sum(F.when(F.col(label) == c, F.col(value)).otherwise(0.0))
        return (total / F.nullif(F.lit(sizes[c]), F.lit(0))).alias(f"mu{c}")
    mu = write_once(values.where(is_train).groupBy("term").agg(mean(0), mean(1)), "centroids")
    norm = mu.agg(F.sum(F.col("mu0") ** 2).alias("m0"), F.sum(F.col("mu1") ** 2).alias("m1")).first()
    sums = (values.join(mu, "term", "left").groupBy(key)
            .agg(F.sum(F.col(value) ** 2).alias("x_sq"),
                 *[F.sum(F.col(value) * F.col(f"mu{c}")).alias(f"dot{c}") for c in (0, 1)]))
    out = docs.join(sums, key, "left").na.fill(0.0, ["x_sq", "dot0", "dot1"])
    for c in (0, 1):
        out = out.withColumn(f"dist{c}", F.col("x_sq") - 2 * F.col(f"dot{c}") + F.lit(norm[f"m{c}"] or 0.0))
    return (out.withColumn("pred", F.when(F.col("dist1") < F.col("dist0"), 1).otherwise(0))
            .drop("x_sq", "dot0", "dot1"))


def lexicon_polarity(tokens: DataFrame, lexicon: DataFrame, docs: DataFrame, key: str = "row_id") -> DataFrame:
    """Mean polarity of the document's words found in the lexicon
    ``(term, polarity)``; no match -> 0; predict 0 if polarity < 0 else 1."""
    pol = tokens.join(lexicon, "term").groupBy(key).agg(F.avg("polarity").alias("polarity"))
    return (docs.join(pol, key, "left")
            .withColumn("polarity", F.coalesce("polarity", F.lit(0.0)))
            .withColumn("pred", F.when(F.col("polarity") < 0, 0).otherwise(1)))
