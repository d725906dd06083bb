"""Registered queries: aggregates over the corpus, term tables, scores, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions.mathx import hmean2_sql, normcdf_expr
from sentispark.functions.stopwords import ENGLISH_STOP_WORDS
from sentispark.operators import aggregates as A
from sentispark.operators import corpus as C
from sentispark.operators import terms as TM
from sentispark.operators.filters import terms_from, text_length
from sentispark.plans import sqltext as S
from sentispark.plans.catalog import register
from sentispark.sources.tables import all_corpus, raw_corpus


def tokens(spark, sf):
    return C.explode_tokens(C.clean_corpus(raw_corpus(spark, sf)))


def all_tokens(spark, sf):
    return C.explode_tokens(C.clean_corpus(all_corpus(spark, sf)))


def tf_all(spark, sf):
    """Term totals over all documents."""
    return TM.term_totals(all_tokens(spark, sf))


def tf_full(spark, sf):
    return TM.term_freq_by_class(tokens(spark, sf))


def tf_limited(spark, sf):
    return TM.term_freq_limited(tokens(spark, sf), 10000)


STOPS_SQL = ", ".join(S.q(w) for w in ENGLISH_STOP_WORDS)
TF_SQL = ("tf AS (SELECT term, CAST(count(*) FILTER (WHERE NOT (target > 0)) AS BIGINT) AS negative, "
          "CAST(count(*) FILTER (WHERE target > 0) AS BIGINT) AS positive FROM tokens GROUP BY term), "
          "tft AS (SELECT term, negative, positive, negative + positive AS total FROM tf)")
TFL_SQL = ("tfs AS (SELECT term, CAST(count(*) FILTER (WHERE NOT (target > 0)) AS BIGINT) AS negative, "
           "CAST(count(*) FILTER (WHERE target > 0) AS BIGINT) AS positive FROM tokens "
           f"WHERE term NOT IN ({STOPS_SQL}) GROUP BY term), "
           "tfl AS (SELECT term, negative, positive, negative + positive AS total FROM tfs "
           "ORDER BY total DESC, term LIMIT 10000)")
WITH_TF = S.BASE_TOKENS.rstrip("\n") + ",\n" + TF_SQL + "\n"
WITH_TFL = S.BASE_TOKENS.rstrip("\n") + ",\n" + TFL_SQL + "\n"

ALL_TF = S.ALL_TOKENS.rstrip("\n") + ",\ntft AS (SELECT term, CAST(count(*) AS BIGINT) AS total FROM tokens GROUP BY term)\n"

_COLS = ["pos_rate", "pos_freq_pct", "neg_rate", "neg_freq_pct"]
SCORES_SQL = (
    "s1 AS (SELECT term, negative, positive, total, positive / total AS pos_rate, "
    "positive / sum(positive) OVER () AS pos_freq_pct, negative / total AS neg_rate, "
    "negative / sum(negative) OVER () AS neg_freq_pct FROM tfl), "
    "s2 AS (SELECT *, " + ", ".join(
        f"avg({c}) OVER () AS {c}__mean, stddev_samp({c}) OVER () AS {c}__std" for c in _COLS)
    + " FROM s1), "
    "s3 AS (SELECT term, negative, positive, total, pos_rate, pos_freq_pct, neg_rate, neg_freq_pct, "
    + hmean2_sql("pos_rate", "pos_freq_pct") + " AS pos_hmean, "
    + ", ".join(normcdf_expr(c, f"{c}__mean", f"{c}__std") + f" AS {c}_normcdf" for c in _COLS)
    + " FROM s2), "
    "scores AS (SELECT *, " + hmean2_sql("pos_rate_normcdf", "pos_freq_pct_normcdf")
    + " AS pos_normcdf_hmean, " + hmean2_sql("neg_rate_normcdf", "neg_freq_pct_normcdf")
    + " AS neg_normcdf_hmean FROM s3)")
WITH_SCORES = WITH_TFL.rstrip("\n") + ",\n" + SCORES_SQL + "\n"


# ---- A1, A2, A17, A18 --------------------------------------------------------
@register("class_counts",
          S.with_(S.CORPUS) + "SELECT target, CAST(count(*) AS BIGINT) AS n_rows FROM corpus GROUP BY target",
          ops=("A1",))
def q_class_counts(spark, sf):
    return A.class_counts(raw_corpus(spark, sf))


@register("length_box_stats", S.with_(
    S.ALL_CORPUS, "l AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM corpus)",
    "q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, "
    "quantile_cont(x, 0.75) AS q3 FROM l)") + """
SELECT q1, median, q3, q3 - q1 AS iqr,
       (SELECT min(x) FROM l WHERE x >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       (SELECT max(x) FROM l WHERE x <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
       (SELECT CAST(count(*) AS BIGINT) FROM l WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM q""", ops=("A2",))
def q_length_box_stats(spark, sf):
    return A.length_box_stats(text_length(all_corpus(spark, sf)), "pre_clean_len")


@register("max_words", S.ALL_BASE + "SELECT CAST(max(len(string_split(text, ' '))) AS INTEGER) AS max_words, "
          "CAST(count(*) AS BIGINT) AS n_docs FROM clean_nn", ops=("A17",))
def q_max_words(spark, sf):
    return A.max_words(C.clean_corpus(all_corpus(spark, sf)))


@register("shape", S.BASE + "SELECT CAST(count(*) AS BIGINT) AS n_rows, 3 AS n_columns FROM clean_nn",
          ops=("A18",))
def q_shape(spark, sf):
    return A.shape(C.clean_corpus(raw_corpus(spark, sf)))


# ---- A3-A6 ---------------------------------------------------------------------
@register("vocabulary", S.ALL_TOKENS + "SELECT DISTINCT term FROM tokens", ops=("A3",))
def q_vocabulary(spark, sf):
    return TM.vocabulary(all_tokens(spark, sf))


@register("vocabulary_size",
          S.ALL_TOKENS + "SELECT CAST(count(DISTINCT term) AS BIGINT) AS n_terms, "
          "CAST(count(*) AS BIGINT) AS n_tokens FROM tokens", ops=("A3",))
def q_vocabulary_size(spark, sf):
    return all_tokens(spark, sf).agg(F.count_distinct("term").alias("n_terms"),
                                 F.count(F.lit(1)).alias("n_tokens"))


@register("doc_term_counts",
          S.ALL_TOKENS + "SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf FROM tokens GROUP BY row_id, term",
          ops=("A4",))
def q_doc_term_counts(spark, sf):
    return TM.doc_term_counts(all_tokens(spark, sf))


@register("term_freq_by_class", WITH_TF + "SELECT term, negative, positive, total FROM tft", ops=("A5",))
def q_term_freq_by_class(spark, sf):
    return tf_full(spark, sf)


@register("terms_from", WITH_TF + "SELECT term, negative, positive, total FROM tft WHERE term >= 'aa'",
          ops=("P9",))
def q_terms_from(spark, sf):
    return terms_from(tf_full(spark, sf), "aa")


@register("term_freq_limited", WITH_TFL + "SELECT term, negative, positive, total FROM tfl", ops=("A6", "T16"))
def q_term_freq_limited(spark, sf):
    return tf_limited(spark, sf)


@register("column_total",
          WITH_TFL + "SELECT CAST(sum(negative) AS BIGINT) AS neg_sum, CAST(sum(positive) AS BIGINT) AS pos_sum "
          "FROM tfl", ops=("A8",))
def q_column_total(spark, sf):
    return TM.class_totals(tf_limited(spark, sf))


# ---- K1-K4 ---------------------------------------------------------------------
@register("top_terms", WITH_TF + "SELECT term, negative, positive, total FROM tft ORDER BY total DESC, term LIMIT 10",
          ops=("K1",))
def q_top_terms(spark, sf):
    return TM.top_k(tf_full(spark, sf), 10, "total")


@register("top_terms_by_class", WITH_TFL + """
SELECT 'negative' AS by_class, term, negative AS freq FROM (SELECT * FROM tfl ORDER BY negative DESC, term LIMIT 50)
UNION ALL
SELECT 'positive' AS by_class, term, positive AS freq FROM (SELECT * FROM tfl ORDER BY positive DESC, term LIMIT 50)""",
          ops=("K2",))
def q_top_terms_by_class(spark, sf):
    tfl = tf_limited(spark, sf)
    neg = TM.top_k(tfl, 50, "negative").select(F.lit("negative").alias("by_class"), "term",
                                                F.col("negative").alias("freq"))
    pos = TM.top_k(tfl, 50, "positive").select(F.lit("positive").alias("by_class"), "term",
                                                F.col("positive").alias("freq"))
    return neg.unionByName(pos)


@register("top_500", ALL_TF + "SELECT term, total FROM tft ORDER BY total DESC, term LIMIT 500", ops=("K3",))
def q_top_500(spark, sf):
    return TM.top_k(tf_all(spark, sf), 500, "total").select("term", "total")


@register("zipf_expected", ALL_TF + """
SELECT CAST(rank AS INTEGER) AS rank, term, total, first_value(total) OVER (ORDER BY rank) / power(CAST(rank AS DOUBLE), 1.0) AS expected
FROM (SELECT term, total, row_number() OVER (ORDER BY total DESC, term) AS rank FROM tft) WHERE rank <= 500""",
          ops=("F7",))
def q_zipf_expected(spark, sf):
    return TM.zipf_expected(tf_all(spark, sf), 500)


@register("rank_frequency", ALL_TF + """
SELECT rank, term, total, log10(CAST(rank AS DOUBLE)) AS log_rank, log10(CAST(total AS DOUBLE)) AS log_freq
FROM (SELECT term, total, row_number() OVER (ORDER BY total DESC, term) AS rank FROM tft)""",
          ops=("F8", "K4"))
def q_rank_frequency(spark, sf):
    return TM.rank_frequency(tf_all(spark, sf))


@register("log_spaced_terms", ALL_TF + """
, ranked AS (SELECT term, total, row_number() OVER (ORDER BY total DESC, term) AS rank FROM tft),
n AS (SELECT count(*) AS n FROM tft),
pts AS (SELECT CAST(i AS INTEGER) AS point,
               CASE WHEN i = 24 THEN n - 2 ELSE floor(power(10.0, -0.5 + i * ((log10(CAST(n - 2 AS DOUBLE)) + 0.5) / 24))) END AS zero_rank
        FROM n, range(25) t(i))
SELECT point, CAST(zero_rank AS BIGINT) AS zero_rank, term, total FROM pts JOIN ranked ON ranked.rank = pts.zero_rank + 1""",
          ops=("F9",))
def q_log_spaced_terms(spark, sf):
    return TM.log_spaced_terms(tf_all(spark, sf)).withColumn("zero_rank", F.col("zero_rank").cast("bigint"))


# ---- F1-F6, A9, A10, F11 ---------------------------------------------------------
_SCORE_COLS = ("term, negative, positive, total, pos_rate, pos_freq_pct, neg_rate, neg_freq_pct, pos_hmean, "
               "pos_rate_normcdf, pos_freq_pct_normcdf, neg_rate_normcdf, neg_freq_pct_normcdf, "
               "pos_normcdf_hmean, neg_normcdf_hmean")


def scores(spark, sf):
    return TM.term_scores(tf_limited(spark, sf), bound=10000)


@register("term_scores", WITH_SCORES + f"SELECT {_SCORE_COLS} FROM scores",
          ops=("F1", "F2", "F3", "F4", "F5", "F6"))
def q_term_scores(spark, sf):
    return scores(spark, sf).select(*[c.strip() for c in _SCORE_COLS.split(",")])


@register("top_terms_by_score", WITH_SCORES + """
SELECT 'pos_normcdf_hmean' AS score_name, term, pos_normcdf_hmean AS score FROM
  (SELECT * FROM scores ORDER BY pos_normcdf_hmean DESC, term LIMIT 10)
UNION ALL
SELECT 'neg_normcdf_hmean', term, neg_normcdf_hmean FROM (SELECT * FROM scores ORDER BY neg_normcdf_hmean DESC, term LIMIT 10)
UNION ALL
SELECT 'pos_rate', term, pos_rate FROM (SELECT * FROM scores ORDER BY pos_rate DESC, term LIMIT 10)""",
          ops=("K1", "F6"))
def q_top_terms_by_score(spark, sf):
    sc = scores(spark, sf)
    parts = [TM.top_k(sc, 10, c).select(F.lit(c).alias("score_name"), "term", F.col(c).alias("score"))
             for c in ("pos_normcdf_hmean", "neg_normcdf_hmean", "pos_rate")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("mean_std", WITH_SCORES + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg({c}) AS mean, stddev_samp({c}) AS std FROM scores" for c in _COLS),
    ops=("A9",))
def q_mean_std(spark, sf):
    return TM.mean_std(scores(spark, sf), _COLS)


@register("min_max", WITH_SCORES + "SELECT min(pos_normcdf_hmean) AS pos_min, max(pos_normcdf_hmean) AS pos_max, "
          "min(neg_normcdf_hmean) AS neg_min, max(neg_normcdf_hmean) AS neg_max FROM scores", ops=("A10",))
def q_min_max(spark, sf):
    sc = scores(spark, sf)
    return sc.agg(F.min("pos_normcdf_hmean").alias("pos_min"), F.max("pos_normcdf_hmean").alias("pos_max"),
                  F.min("neg_normcdf_hmean").alias("neg_min"), F.max("neg_normcdf_hmean").alias("neg_max"))


@register("color_scale", WITH_SCORES + """
SELECT term, least(greatest((pos_normcdf_hmean - lo) / nullif(hi - lo, 0), 0.0), 1.0) AS color
FROM scores, (SELECT min(pos_normcdf_hmean) AS lo, max(neg_normcdf_hmean) AS hi FROM scores)""",
          ops=("F11",))
def q_color_scale(spark, sf):
    return TM.color_scale(scores(spark, sf)).select("term", "color")


@register("wordcloud_weights", S.BASE_TOKENS + """
SELECT target, term, freq, rank, freq / max(freq) OVER (PARTITION BY target) AS weight FROM (
  SELECT target, term, freq, row_number() OVER (PARTITION BY target ORDER BY freq DESC, term) AS rank
  FROM (SELECT target, term, CAST(count(*) AS BIGINT) AS freq FROM tokens GROUP BY target, term))
WHERE rank <= 200""", ops=("F10", "T11"))
def q_wordcloud_weights(spark, sf):
    return TM.wordcloud_weights(tokens(spark, sf), 200).withColumn("rank", F.col("rank").cast("bigint"))
