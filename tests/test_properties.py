"""SURVEY §5 properties: closed-form agreement and partitioning invariance."""

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sentispark.operators import learners as L
from sentispark.operators import terms as TM


def test_ridge_matches_closed_form(spark):
    rng = np.random.RandomState(0)
    X = rng.randn(60, 4)
    y01 = (X @ np.array([1.0, -2.0, 0.5, 0.0]) + 0.3 * rng.randn(60) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(x), float(t)) for x, t in zip(X, y01)], ["features", "label"])
    model = L.ridge_classifier(df, alpha=1.0).model
    # closed form on +-1 targets, intercept not penalised (centre, solve, restore)
    y = 2 * y01 - 1
    xm, ym = X.mean(axis=0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(4), Xc.T @ yc)
    b = ym - xm @ w
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-4)
    assert abs(model.intercept - b) < 1e-4


def test_term_counts_invariant_under_repartition(spark):
    rows = [(i, 4 * (i % 2), w) for i in range(200) for w in ("a", "b", "a", "c%d" % (i % 7))]
    df = spark.createDataFrame(rows, "row_id int, target int, term string")
    base = sorted(TM.term_freq_by_class(df).collect())
    for n in (1, 3, 11):
        assert sorted(TM.term_freq_by_class(df.repartition(n)).collect()) == base


def test_logistic_matches_penalised_optimum(spark):
    rng = np.random.RandomState(1)
    X = rng.randn(80, 3)
    y = (X @ np.array([1.5, -1.0, 0.5]) + 0.5 * rng.randn(80) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(x), float(t)) for x, t in zip(X, y)], ["features", "label"])
    m = L.logistic_regression(len(y), C=1.0, maxIter=200, tol=1e-12).fit(df)
    # Newton on C * sum(logloss) + 0.5 * |w|^2 (intercept not penalised)
    A = np.hstack([X, np.ones((80, 1))])
    beta = np.zeros(4)
    reg = np.diag([1.0, 1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ beta))
        grad = A.T @ (p - y) + reg @ beta
        hess = A.T @ (A * (p * (1 - p))[:, None]) + reg
        beta -= np.linalg.solve(hess, grad)
    assert np.allclose(m.coefficients.toArray(), beta[:3], atol=1e-4)
    assert abs(m.intercept - beta[3]) < 1e-4
