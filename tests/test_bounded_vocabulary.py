"""A vocabulary of fixed size goes to the tasks; the counts it meets are not shuffled by term."""

import math

import pytest

from sentispark.operators import features as FE


@pytest.fixture
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_meet_a_bounded_vocabulary_without_a_shuffle(spark, no_small_tables):
    dtc = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "z", 4)], "row_id long, term string, tf long")
    vocab = spark.createDataFrame([("a", 0, 3, 2), ("b", 1, 1, 1)], "term string, index int, cnt long, df long")
    n = spark.createDataFrame([(2,)], "n long")
    got = FE.tfidf(FE.vectorize_counts(dtc, vocab, 2), vocab, n, 2, normalize=False)
    assert "SortMergeJoin" not in _plan(got) and "BroadcastHashJoin" in _plan(got)
    rows = {(r.row_id, r.term): (r["index"], r.tfidf) for r in got.collect()}
    assert rows.keys() == {(1, "a"), (1, "b"), (2, "a")} and rows[1, "b"][0] == 1
    assert rows[1, "a"][1] == pytest.approx(2.0) and rows[1, "b"][1] == pytest.approx(math.log(3 / 2) + 1)
    # without a bound the vocabulary may be of any size: no forced broadcast
    assert "SortMergeJoin" in _plan(FE.vectorize_counts(dtc, vocab, None))
