"""Goldens and properties of the relational operators."""

import math

from pyspark.sql import functions as F

from sentispark.functions.stopwords import ENGLISH_STOP_WORDS
from sentispark.operators import evaluate as E
from sentispark.operators import features as FE
from sentispark.operators import phrases as PH
from sentispark.operators import ranking as R
from sentispark.operators import sequences as SQ
from sentispark.operators import split as SP
from sentispark.operators import terms as TM


def test_stop_words_equal_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert tuple(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS


def test_apply_phrases_golden(spark):
    toks = "a b c d e a b x b c".split()
    docs = spark.createDataFrame([(1, toks)], "row_id int, tokens array<string>")
    phrases = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    rows = PH.token_rows(docs)
    out = PH.apply_phrases(rows, phrases).first().tokens
    assert out == "a_b c_d e a_b x b_c".split()


def test_pad_sequences_golden(spark):
    df = spark.createDataFrame([([1, 2],), (list(range(1, 8)),), ([],)], "s array<int>")
    got = [r.p for r in df.select(SQ.pad_sequences(F.col("s"), 5).alias("p")).collect()]
    assert got == [[0, 0, 0, 1, 2], [3, 4, 5, 6, 7], [0, 0, 0, 0, 0]]


def test_auc_golden(spark):
    data = [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.35, 1)]
    df = spark.createDataFrame(data, "score double, label int")
    assert abs(E.auc(E.roc_curve(df)).first().auc - 0.75) < 1e-12


def test_auc_equals_mann_whitney(spark):
    import random
    rnd = random.Random(3)
    data = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(data, "score double, label int").repartition(7)
    pos = [s for s, y in data if y == 1]
    neg = [s for s, y in data if y == 0]
    mw = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(E.auc(E.roc_curve(df)).first().auc - mw) < 1e-9


def test_box_quartiles_golden(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    q = {r.prob: r.value for r in R.exact_quantiles(df, "x", [0.25, 0.5, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 3.25}


def test_idf_golden(spark):
    # 3 training docs; term 'a' in all three, 'b' in one -> idf 1 and 1 + ln 2
    counts = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", 1), (1, "b", 1)],
                                   "row_id int, term string, tf long")
    vocab = spark.createDataFrame([("a", 3), ("b", 1)], "term string, df long")
    n = spark.createDataFrame([(3,)], "n long")
    out = {(r.row_id, r.term): r.tfidf for r in FE.tfidf(counts, vocab, n, 10, normalize=False).collect()}
    assert abs(out[(1, "a")] - 1.0) < 1e-12
    assert abs(out[(1, "b")] - (1 + math.log(2))) < 1e-12


def test_global_row_number_matches_sort(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id"))
    for parts in (1, 3, 8):
        got = R.global_row_number(df, [F.col("k"), F.col("id")], "rn", parts)
        rows = sorted((r.k, r.id, r.rn) for r in got.collect())
        assert [r[2] for r in rows] == list(range(1, 1001))


def test_global_running_sum(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "k int, v int")
    got = {r.k: r.s for r in R.global_running_sum(df, [F.col("k")], {"s": F.col("v")}, 5).collect()}
    acc = 0
    for i in range(100):
        acc += i % 3
        assert got[i] == acc


def test_split_exact_and_disjoint(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "row_id")
    out = SP.train_val_test_split(df, "row_id", 2000, 0.02)
    sizes = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 980, "validation": 10, "test": 10}
    assert out.select("row_id").distinct().count() == 1000
    again = SP.train_val_test_split(df.repartition(5), "row_id", 2000, 0.02)
    assert sorted(out.collect()) == sorted(again.collect())


def test_term_totals_equal_token_count(spark):
    toks = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (2, 4, "a"), (3, 4, "c")],
                                 "row_id int, target int, term string")
    tf = TM.term_freq_by_class(toks)
    assert tf.agg(F.sum("total")).first()[0] == 4
    assert {r.term: (r.negative, r.positive) for r in tf.collect()} == {"a": (1, 1), "b": (1, 0), "c": (0, 1)}


def test_confusion_matrix_has_both_rows(spark):
    pred = spark.createDataFrame([(1, 1), (1, 1)], "label int, pred int")
    rows = {r.label: (r.predicted_negative, r.predicted_positive) for r in E.confusion_matrix(pred).collect()}
    assert rows == {0: (0, 0), 1: (0, 2)}


def test_counts_in_the_row_equal_grouped_counts(spark):
    rows = [(1, "a b a b a", 0), (2, "z", 1), (3, "", 1), (4, None, 0), (5, " ".join(["x y"] * 500), 1)]
    df = spark.createDataFrame(rows, "row_id int, text string, label int")
    for ngram in (1, 3):
        got = FE.doc_counts(df, ngram, keep=("row_id", "label"))
        want = FE.doc_term_table(FE.doc_grams(df, ngram, extra=("label",)), extra=("label",))
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_split_cuts_are_literals(spark):
    df = spark.createDataFrame([(i,) for i in range(300)], "row_id long")
    parts = SP.train_val_test_split(df)
    assert "Join" not in parts._jdf.queryExecution().optimizedPlan().toString()
    assert {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()} == {
        "train": 294, "validation": 3, "test": 3}
    one = SP.train_val_test_split(df.limit(1)).first()
    assert one.split == "test"  # ceil(0.02) = 1 held out, none of it validation
    assert SP.train_val_test_split(df.limit(0)).count() == 0


def test_phrases_joined_at_places(spark):
    docs = spark.createDataFrame([(1, "a b c a b".split()), (2, "c c".split()), (3, []), (4, None), (5, ["a", "b"])],
                                 "row_id int, tokens array<string>")
    phrases = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    got = {r.row_id: r.tokens for r in PH.join_phrases(docs, PH.token_rows(docs), phrases).collect()}
    assert got == {1: ["a_b", "c", "a_b"], 2: ["c", "c"], 3: [], 4: [], 5: ["a_b"]}
