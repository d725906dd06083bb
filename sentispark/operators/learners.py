"""Learners at the ML edge (M5-M10, M13, M14 on dense columns, M18, M20, M21) on pyspark.ml.

Vectors are built in the JVM from a fitted vocabulary whose size is the
caller's ``max_features`` (the only thing brought to the driver, and its size
is that bound).  TF-IDF follows the study's formula
``tf * (ln((1+n)/(1+df)) + 1)`` then L2: Spark's ``IDF`` gives
``ln((n+1)/(df+1))``, so its vector is shifted by one and applied with
``ElementwiseProduct``.  Optimisers are Spark's (tree-aggregated gradients).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.session import cut_lineage, write_once


def vocabulary_terms(vocab: DataFrame, max_features: int) -> list[str]:
    """Vocabulary terms in index order; bounded by ``max_features``."""
    rows = vocab.orderBy("index").select("term").collect()  # at most max_features rows
    return [r.term for r in rows]


def tfidf_vectors(df: DataFrame, terms: list[str], tokens_col: str = "grams",
                  train_filter=None, out: str = "features") -> DataFrame:
    """Count -> IDF fitted on the rows ``train_filter`` keeps -> +1 -> L2.  The counts are written once: the fit
    of the IDF and each pass over the result read them; ``tokens_col`` is not kept."""
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol="__tf")
    counted = write_once(cv.transform(df).drop(tokens_col), "term-counts")
    fit_on = counted.where(train_filter) if train_filter is not None else counted
    idf = IDF(inputCol="__tf", outputCol="__idf0").fit(fit_on)
    shift = ElementwiseProduct(scalingVec=DenseVector(idf.idf.toArray() + 1.0),
                               inputCol="__tf", outputCol="__tfidf")
    norm = Normalizer(p=2.0, inputCol="__tfidf", outputCol=out)
    return norm.transform(shift.transform(counted)).drop("__tf", "__tfidf")


def count_vectors(df: DataFrame, terms: list[str], tokens_col: str = "grams", out: str = "features",
                  binary: bool = False) -> DataFrame:
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol=out)
    cv.setBinary(binary)
    return cv.transform(df)


def logistic_regression(n_train: int, C: float = 1.0, **kw) -> LogisticRegression:
    """M7: L2 logistic regression with sklearn's C: regParam = 1 / (C n)."""
    return LogisticRegression(regParam=1.0 / (C * max(n_train, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=kw.pop("maxIter", 100), **kw)


def logit_unregularised(**kw) -> LogisticRegression:
    """M8: intercept + logit, no penalty."""
    return LogisticRegression(regParam=0.0, fitIntercept=True, standardization=False, **kw)


def linear_svc(n_train: int, C: float = 1.0, **kw) -> LinearSVC:
    """M9: hinge-loss linear SVM, regParam = 1 / (C n)."""
    return LinearSVC(regParam=1.0 / (C * max(n_train, 1)), standardization=False, **kw)


def l1_select_then_svc(train: DataFrame, n_train: int, C: float = 1.0, tol: float = 1e-5, max_iter: int = 100):
    """L1 model selects features (|w| > tol), an L2 SVM classifies them.
    Returns a fitted PipelineModel."""
    l1 = LogisticRegression(regParam=1.0 / (C * max(n_train, 1)), elasticNetParam=1.0,
                            standardization=False, maxIter=max_iter).fit(train)
    keep = [i for i, w in enumerate(l1.coefficients.toArray()) if abs(w) > tol]
    if not keep:  # nothing selected: the L1 model, which then is its intercept, decides
        return PipelineModel([l1])
    slicer = VectorSlicer(inputCol="features", outputCol="__sel", indices=keep)
    svc = linear_svc(n_train, C, featuresCol="__sel", maxIter=max_iter)
    return Pipeline(stages=[slicer, svc]).fit(train)


class RidgeClassifierModel:
    """Ridge regression on +-1 targets; predict the sign (>0 -> 1)."""

    def __init__(self, model):
        self.model = model

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        return out.withColumn("prediction", F.when(F.col("prediction") > 0, 1.0).otherwise(0.0))


def ridge_classifier(train: DataFrame, alpha: float = 1.0) -> RidgeClassifierModel:
    """regParam = alpha * std(y) / n on y in {-1, 1} matches the closed form
    (Spark scales the penalty by the label deviation)."""
    y = train.withColumn("__y", F.col("label") * 2.0 - 1.0)
    st = y.agg(F.stddev_samp("__y").alias("s"), F.count(F.lit(1)).alias("n")).first()
    s = st.s if st.s else 1.0
    lr = LinearRegression(labelCol="__y", regParam=alpha * s / max(st.n, 1), elasticNetParam=0.0,
                          standardization=False, solver="l-bfgs")
    return RidgeClassifierModel(lr.fit(y))


class AdaBoostModel:
    """Weighted stumps ``(feature, threshold, left, right)``; scored as one expression
    over the features the stumps use."""

    def __init__(self, trees, alphas):
        self.alphas, self.stumps = alphas, []
        for tree in trees:
            root = tree._call_java("rootNode")
            if tree.depth == 0:
                self.stumps.append((0, float("inf"), root.prediction(), root.prediction()))
            else:
                self.stumps.append((root.split().featureIndex(), root.split().threshold(),
                                    root.leftChild().prediction(), root.rightChild().prediction()))

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.stumps:
            return df.withColumn("prediction", F.lit(0.0))
        used = sorted({s[0] for s in self.stumps})
        out = VectorSlicer(inputCol="features", outputCol="__used", indices=used).transform(df)
        x = vector_to_array("__used")
        score = F.lit(0.0)
        for a, (f, threshold, left, right) in zip(self.alphas, self.stumps):
            vote = F.when(x[used.index(f)] <= F.lit(threshold), left).otherwise(right)
            score = score + F.lit(a) * (vote * 2 - 1)
        return out.withColumn("prediction", F.when(score > 0, 1.0).otherwise(0.0)).drop("__used")


def adaboost_stumps(train: DataFrame, rounds: int = 50, checkpoint_every: int = 5) -> AdaBoostModel:
    """Discrete AdaBoost (SAMME, two classes) on depth-1 trees.  The
    sample weight is a column; its lineage is cut by a reliable checkpoint
    every few rounds so a lost executor recomputes at most those rounds."""
    data = cut_lineage(train.withColumn("w", F.lit(1.0)))
    total = float(data.count())
    stumps, alphas = [], []
    for k in range(rounds):
        tree = DecisionTreeClassifier(maxDepth=1, weightCol="w", predictionCol="__p").fit(data)
        pred = tree.transform(data).withColumn("__miss", (F.col("__p") != F.col("label")).cast("double"))
        missed = pred.agg(F.sum(F.col("w") * F.col("__miss"))).first()[0]
        err = missed / total if missed is not None and total else None
        if err is None or err >= 0.5:
            break
        err = max(err, 1e-12)
        a = 0.5 * math.log((1 - err) / err)
        stumps.append(tree)
        alphas.append(a)
        data = (pred.withColumn("w", F.col("w") * F.exp(F.lit(a) * (2 * F.col("__miss") - 1)))
                .drop("__p", "rawPrediction", "probability", "__miss"))
        # the new weights' total follows from the error: no pass over the data
        total = total * ((1 - err) * math.exp(-a) + err * math.exp(a))
        if (k + 1) % checkpoint_every == 0:
            data = cut_lineage(data)
        if err <= 1e-12:
            break
    return AdaBoostModel(stumps, alphas)


def mlp_classifier(n_features: int, hidden: int = 64, seed: int = 7, max_iter: int = 100):
    """One hidden layer on the (selected) TF-IDF features."""
    return MultilayerPerceptronClassifier(layers=[n_features, hidden, 2], seed=seed, maxIter=max_iter)


def mlp_start(spark: SparkSession, n_features: int, hidden: int, seed: int = 7) -> np.ndarray:
    """The weights that :func:`mlp_classifier` starts from: the network after no iteration, which does not
    depend on its rows."""
    rows = spark.createDataFrame([(0.0, SparseVector(n_features, {})), (1.0, SparseVector(n_features, {}))], ["label", "features"])
    return mlp_classifier(n_features, hidden, seed, 0).fit(rows.coalesce(1)).weights.toArray()


def pipeline(terms: list[str], classifier, tokens_col: str = "grams") -> Pipeline:
    """M6: vectorizer -> classifier as one Pipeline."""
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol="features")
    return Pipeline(stages=[cv, classifier])

