"""Boosted stumps and L1 selection on small data whose answers are known."""

import random

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from sentispark.operators import learners as L


def _frame(spark, n=300, seed=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.random() for _ in range(6)]
        rows.append((i, float(x[1] > 0.3 and x[4] > 0.4), Vectors.dense(x)))
    return spark.createDataFrame(rows, ["row_id", "label", "features"])


def test_adaboost_scores_as_plain_python(spark):
    data = _frame(spark)
    model = L.adaboost_stumps(data, rounds=15)
    got = {r.row_id: r.prediction for r in model.transform(data).collect()}
    rows = data.select("row_id", "label", vector_to_array("features").alias("x")).collect()
    for r in rows:
        score = sum(a * ((left if r.x[f] <= t else right) * 2 - 1) for a, (f, t, left, right) in zip(model.alphas, model.stumps))
        assert got[r.row_id] == float(score > 0)
    assert np.mean([got[r.row_id] == r.label for r in rows]) > 0.95


def test_adaboost_weights_follow_the_error(spark):
    """Two rounds by hand: each round's vote comes from the weighted error of its stump."""
    data = _frame(spark, 200, 3)
    model = L.adaboost_stumps(data, rounds=2)
    rows = data.select("label", vector_to_array("features").alias("x")).collect()
    w = np.ones(len(rows))
    for a, (f, t, left, right) in zip(model.alphas, model.stumps):
        miss = np.array([(left if r.x[f] <= t else right) != r.label for r in rows])
        err = w[miss].sum() / w.sum()
        assert abs(a - 0.5 * np.log((1 - err) / err)) < 1e-9
        w *= np.exp(a * (2 * miss - 1))


def test_l1_selection_keeps_nothing_when_the_penalty_is_huge(spark):
    data = _frame(spark)
    out = L.l1_select_then_svc(data, 300, C=1e-9).transform(data)
    assert out.select("prediction").distinct().count() == 1
    kept = L.l1_select_then_svc(data, 300, C=10.0).transform(data)
    assert kept.where("prediction = label").count() > 250
