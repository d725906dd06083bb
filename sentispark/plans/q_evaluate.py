"""Registered queries: closed-form classifiers (NB, centroid, lexicon) and
their evaluation (confusion matrix, accuracy, report, ROC, AUC, leaderboard).

All models are fit on the ``train`` split and scored on every document; the
metrics use the held-out rows (validation + test).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.operators import bayes as B
from sentispark.operators import corpus as C
from sentispark.operators import evaluate as E
from sentispark.operators import features as FE
from sentispark.operators import filters as P
from sentispark.operators import terms as TM
from sentispark.plans import q_terms as QT
from sentispark.plans.catalog import register
from sentispark.plans.q_features import WITH_SPLIT, split_corpus
from sentispark.session import write_once

VOCAB = 100_000
TRAIN = "split = 'train'"


# ---- shared Spark set-up ---------------------------------------------------------
def setup(spark, sf):
    """(documents, counts of vocabulary terms, vocabulary with class sums, training class sizes)."""
    sp = split_corpus(spark, sf)
    dtc = write_once(FE.doc_counts(sp, keep=("row_id", "label", "split")), "counts")
    vocab = write_once(FE.fit_vocabulary_counts(dtc.where(TRAIN), VOCAB, B.class_sums()), "vocabulary")
    docs = sp.select("row_id", "label", "split")
    return docs, dtc.join(vocab.select("term"), "term"), vocab, B.class_sizes(docs.where(TRAIN))


def mnb_scores(spark, sf):
    docs, counts, vocab, sizes = setup(spark, sf)
    w, bias = B.multinomial_nb_fit(vocab, sizes)
    s = B.linear_score(counts.select("row_id", "term", "tf"), w, bias, docs)
    return (s.withColumn("pred", F.when(F.col("score") > 0, 1).otherwise(0))
            .withColumn("prob", 1 / (1 + F.exp(-F.col("score")))))


def bnb_scores(spark, sf):
    docs, counts, vocab, sizes = setup(spark, sf)
    w, bias = B.bernoulli_nb_fit(vocab, sizes)
    s = B.linear_score(counts.select("row_id", "term", F.lit(1.0).alias("one")), w, bias, docs, value="one")
    return s.withColumn("pred", F.when(F.col("score") > 0, 1).otherwise(0))


def centroid_pred(spark, sf):
    docs, counts, vocab, sizes = setup(spark, sf)
    n_docs = docs.where(TRAIN).agg(F.count(F.lit(1)).alias("n"))
    vals = FE.tfidf(counts, vocab.select("term", "df"), n_docs, VOCAB).withColumnRenamed("tfidf", "value")
    vals = write_once(vals.select("row_id", "label", "split", "term", "value"), "values")
    return B.nearest_centroid(vals, TRAIN, sizes, docs)


def lexicon_pred(spark, sf):
    sp = split_corpus(spark, sf)
    toks = C.explode_tokens(sp, keep=("row_id", "split", "target"))
    lex = (TM.term_scores(TM.term_freq_limited(toks.where(F.col("split") == "train"), 10000), bound=10000)
           .select("term", (F.col("pos_normcdf_hmean") - F.col("neg_normcdf_hmean")).alias("polarity")))
    return B.lexicon_polarity(toks, lex, sp.select("row_id", "label", "split"))


def heldout(df):
    return df.where(F.col("split") != "train")


# ---- shared SQL -----------------------------------------------------------------------
def with_split(*parts: str) -> str:
    return WITH_SPLIT.rstrip("\n") + ",\n" + ",\n".join(x.strip().strip(",") for x in parts) + "\n"


SETUP_CTES = f"""
occ AS (SELECT row_id, split, unnest(string_split(text, ' ')) AS term FROM sp),
voc AS (SELECT term, cnt, df FROM (SELECT term, count(*) AS cnt, count(DISTINCT row_id) AS df FROM occ
        WHERE split = 'train' GROUP BY term) ORDER BY cnt DESC, term LIMIT {VOCAB}),
cnt AS (SELECT row_id, term, count(*) AS tf FROM occ JOIN voc USING (term) GROUP BY row_id, term),
lab AS (SELECT row_id, label, split FROM sp),
pri AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
        FROM lab WHERE split = 'train')"""
MNB_CTES = """
trc AS (SELECT term, sum(CASE WHEN label = 0 THEN tf ELSE 0 END) AS c0, sum(CASE WHEN label = 1 THEN tf ELSE 0 END) AS c1
        FROM cnt JOIN lab USING (row_id) WHERE split = 'train' GROUP BY term),
per AS (SELECT voc.term, coalesce(c0, 0) AS c0, coalesce(c1, 0) AS c1 FROM voc LEFT JOIN trc ON trc.term = voc.term),
tot AS (SELECT sum(c0) AS N0, sum(c1) AS N1, count(*) AS V FROM per),
mw AS (SELECT term, ln((c1 + 1) / (N1 + V)) - ln((c0 + 1) / (N0 + V)) AS w FROM per, tot),
mnb AS (SELECT lab.row_id, label, split, ln(n1 / n0) + coalesce(s, 0) AS score FROM lab
        LEFT JOIN (SELECT row_id, sum(tf * w) AS s FROM cnt JOIN mw USING (term) GROUP BY row_id) q
        ON q.row_id = lab.row_id, pri),
mnbp AS (SELECT *, CASE WHEN score > 0 THEN 1 ELSE 0 END AS pred, 1 / (1 + exp(-score)) AS prob FROM mnb)"""
BNB_CTES = """
trd AS (SELECT term, count(*) FILTER (WHERE label = 0) AS d0, count(*) FILTER (WHERE label = 1) AS d1
        FROM cnt JOIN lab USING (row_id) WHERE split = 'train' GROUP BY term),
pp AS (SELECT voc.term, (coalesce(d0, 0) + 1) / (n0 + 2) AS p0, (coalesce(d1, 0) + 1) / (n1 + 2) AS p1
       FROM voc LEFT JOIN trd ON trd.term = voc.term, pri),
bw AS (SELECT term, ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) AS w FROM pp),
bb AS (SELECT sum(ln((1 - p1) / (1 - p0))) + (SELECT ln(n1 / n0) FROM pri) AS bias FROM pp),
bnb AS (SELECT lab.row_id, label, split, bias + coalesce(s, 0) AS score,
               CASE WHEN bias + coalesce(s, 0) > 0 THEN 1 ELSE 0 END AS pred FROM lab
        LEFT JOIN (SELECT row_id, sum(w) AS s FROM cnt JOIN bw USING (term) GROUP BY row_id) q
        ON q.row_id = lab.row_id, bb)"""
CEN_CTES = """
nd AS (SELECT count(*) AS n FROM lab WHERE split = 'train'),
x0 AS (SELECT row_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS x FROM cnt JOIN voc USING (term), nd),
xv AS (SELECT row_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS value FROM x0),
sz AS (SELECT label, count(*) AS n_c FROM lab WHERE split = 'train' GROUP BY label),
mu AS (SELECT label, term, sum(value) / any_value(n_c) AS mu FROM xv JOIN lab USING (row_id) JOIN sz USING (label)
       WHERE split = 'train' GROUP BY label, term),
mq AS (SELECT sum(mu * mu) FILTER (WHERE label = 0) AS m0, sum(mu * mu) FILTER (WHERE label = 1) AS m1 FROM mu),
dots AS (SELECT row_id, sum(value * mu) FILTER (WHERE label = 0) AS dot0, sum(value * mu) FILTER (WHERE label = 1) AS dot1
         FROM xv JOIN mu USING (term) GROUP BY row_id),
xs AS (SELECT row_id, sum(value * value) AS x_sq FROM xv GROUP BY row_id),
cen AS (SELECT lab.row_id, label, split,
               coalesce(x_sq, 0) - 2 * coalesce(dot0, 0) + coalesce(m0, 0) AS dist0,
               coalesce(x_sq, 0) - 2 * coalesce(dot1, 0) + coalesce(m1, 0) AS dist1
        FROM lab LEFT JOIN xs ON xs.row_id = lab.row_id LEFT JOIN dots ON dots.row_id = lab.row_id, mq),
cenp AS (SELECT *, CASE WHEN dist1 < dist0 THEN 1 ELSE 0 END AS pred FROM cen)"""
SQL_SETUP = with_split(SETUP_CTES)
MNB_SQL = with_split(SETUP_CTES, MNB_CTES)
BNB_SQL = with_split(SETUP_CTES, BNB_CTES)
CENTROID_SQL = with_split(SETUP_CTES, CEN_CTES)
_train_tokens = ("tokens AS (SELECT row_id, target, unnest(string_split(text, ' ')) AS term FROM sp "
                 "WHERE split = 'train')")
LEXICON_SQL = (WITH_SPLIT.rstrip("\n") + ",\n" + _train_tokens + ",\n" + QT.TFL_SQL + ",\n" + QT.SCORES_SQL + """,
lexicon AS (SELECT term, pos_normcdf_hmean - neg_normcdf_hmean AS polarity FROM scores),
alltok AS (SELECT row_id, unnest(string_split(text, ' ')) AS term FROM sp),
pol AS (SELECT row_id, avg(polarity) AS polarity FROM alltok JOIN lexicon USING (term) GROUP BY row_id),
lex AS (SELECT sp.row_id, label, split, coalesce(pol.polarity, 0.0) AS polarity,
               CASE WHEN coalesce(pol.polarity, 0.0) < 0 THEN 0 ELSE 1 END AS pred
        FROM sp LEFT JOIN pol ON pol.row_id = sp.row_id)
""")


# ---- M11 / M12 / M17 / M22 / P16 ----------------------------------------------------------
@register("multinomial_nb", MNB_SQL + "SELECT row_id, label, split, score, pred FROM mnbp", ops=("M11",))
def q_multinomial_nb(spark, sf):
    return mnb_scores(spark, sf).select("row_id", "label", "split", "score", "pred")


@register("bernoulli_nb", BNB_SQL + "SELECT row_id, label, split, score, pred FROM bnb", ops=("M12",))
def q_bernoulli_nb(spark, sf):
    return bnb_scores(spark, sf).select("row_id", "label", "split", "score", "pred")


@register("nearest_centroid", CENTROID_SQL + "SELECT row_id, label, split, dist0, dist1, pred FROM cenp",
          ops=("M17",))
def q_nearest_centroid(spark, sf):
    return centroid_pred(spark, sf).select("row_id", "label", "split", "dist0", "dist1", "pred")


@register("lexicon_polarity", LEXICON_SQL + "SELECT row_id, label, split, polarity, pred FROM lex",
          ops=("M22", "P16"))
def q_lexicon_polarity(spark, sf):
    return lexicon_pred(spark, sf).select("row_id", "label", "split", "polarity", "pred")


@register("threshold_predict", MNB_SQL + """
SELECT row_id, prob, CAST(round_even(prob, 0) AS DOUBLE) AS rounded, CASE WHEN score < 0 THEN 0 ELSE 1 END AS pred
FROM mnbp""", ops=("P16",))
def q_threshold_predict(spark, sf):
    s = mnb_scores(spark, sf)
    return s.select("row_id", "prob", P.round_probability(F.col("prob")).alias("rounded"),
                    P.threshold_predict(F.col("score")).alias("pred"))


# ---- A11-A15, A19 -------------------------------------------------------------------------------
HELD = "(SELECT * FROM mnbp WHERE split <> 'train')"


@register("confusion_matrix", MNB_SQL + f"""
SELECT l.label, l.class_name, CAST(coalesce(c.pn, 0) AS BIGINT) AS predicted_negative,
       CAST(coalesce(c.pp, 0) AS BIGINT) AS predicted_positive
FROM (VALUES (0, 'negative'), (1, 'positive')) l(label, class_name)
LEFT JOIN (SELECT label, count(*) FILTER (WHERE pred = 0) AS pn, count(*) FILTER (WHERE pred = 1) AS pp
           FROM {HELD} GROUP BY label) c ON c.label = l.label""", ops=("A11",))
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(heldout(mnb_scores(spark, sf)))


@register("accuracy", MNB_SQL + """
SELECT split, avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM mnbp GROUP BY split""", ops=("A12",))
def q_accuracy(spark, sf):
    s = mnb_scores(spark, sf)
    return s.groupBy("split").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"),
                                  F.count(F.lit(1)).alias("n"))


@register("null_accuracy", MNB_SQL + f"""
SELECT null_accuracy, accuracy, accuracy - null_accuracy AS gap,
       CASE WHEN accuracy > null_accuracy THEN 'more accurate' WHEN accuracy = null_accuracy THEN 'same'
            ELSE 'less accurate' END AS verdict FROM (
  SELECT CASE WHEN avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) > 0.5 THEN avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END)
              ELSE 1 - avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) END AS null_accuracy,
         avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM {HELD})""", ops=("A13",))
def q_null_accuracy(spark, sf):
    return E.null_accuracy(heldout(mnb_scores(spark, sf)))


@register("classification_report", MNB_SQL + f"""
, c AS (SELECT count(*) FILTER (WHERE label = 0 AND pred = 0) AS tp0, count(*) FILTER (WHERE pred = 0) AS pp0,
              count(*) FILTER (WHERE label = 0) AS s0, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp1,
              count(*) FILTER (WHERE pred = 1) AS pp1, count(*) FILTER (WHERE label = 1) AS s1 FROM {HELD}),
r AS (SELECT 'negative' AS row_name, coalesce(tp0 / nullif(pp0, 0), 0.0) AS precision,
             coalesce(tp0 / nullif(s0, 0), 0.0) AS recall, s0 AS support FROM c
      UNION ALL SELECT 'positive', coalesce(tp1 / nullif(pp1, 0), 0.0), coalesce(tp1 / nullif(s1, 0), 0.0), s1 FROM c),
rf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM r)
SELECT row_name, precision, recall, CAST(support AS BIGINT) AS support, f1 FROM rf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), CAST(sum(support) AS BIGINT), avg(f1) FROM rf
UNION ALL SELECT 'weighted avg', coalesce(sum(precision * support) / nullif(sum(support), 0), 0.0),
       coalesce(sum(recall * support) / nullif(sum(support), 0), 0.0), CAST(sum(support) AS BIGINT),
       coalesce(sum(f1 * support) / nullif(sum(support), 0), 0.0) FROM rf""".replace("\n, c AS", ",\nc AS"),
          ops=("A14",))
def q_classification_report(spark, sf):
    return E.classification_report(heldout(mnb_scores(spark, sf)))


@register("error_rate", MNB_SQL + f"""
SELECT CAST(count(*) FILTER (WHERE round_even(prob, 0) <> label) AS BIGINT) AS errors, CAST(count(*) AS BIGINT) AS n,
       count(*) FILTER (WHERE round_even(prob, 0) <> label) / count(*) AS error_rate FROM {HELD}""", ops=("A15",))
def q_error_rate(spark, sf):
    return E.error_rate(heldout(mnb_scores(spark, sf)))


@register("zero_rule", MNB_SQL + """
, maj AS (SELECT CASE WHEN avg(CAST(label AS DOUBLE)) > 0.5 THEN 1 ELSE 0 END AS pred FROM lab WHERE split = 'train')
SELECT any_value(maj.pred) AS pred, avg(CASE WHEN label = maj.pred THEN 1.0 ELSE 0.0 END) AS accuracy,
       CAST(count(*) AS BIGINT) AS n FROM lab, maj WHERE split <> 'train'""".replace("\n, maj AS", ",\nmaj AS"),
          ops=("A19",))
def q_zero_rule(spark, sf):
    sp = split_corpus(spark, sf)
    z = E.zero_rule(sp.where(F.col("split") == "train"), heldout(sp))
    return z.agg(F.first("pred").alias("pred"),
                 F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))


# ---- W5 / W6 -----------------------------------------------------------------------------------------
ROC_SQL = with_split(SETUP_CTES, MNB_CTES, """
rper AS (SELECT round(score, 9) AS threshold, count(*) FILTER (WHERE label = 1) AS d_tp,
                count(*) FILTER (WHERE label = 0) AS d_fp FROM mnbp GROUP BY round(score, 9)),
tt AS (SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label = 0) AS N FROM mnbp),
roc AS (SELECT threshold, d_tp, d_fp, sum(d_tp) OVER (ORDER BY threshold DESC) AS tp,
               sum(d_fp) OVER (ORDER BY threshold DESC) AS fp FROM rper)""")


@register("roc_curve", ROC_SQL + """
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, fp / N AS fpr, tp / P AS tpr FROM roc, tt""",
          ops=("W5",))
def q_roc_curve(spark, sf):
    return E.roc_curve(mnb_scores(spark, sf)).select("threshold", "tp", "fp", "fpr", "tpr")


@register("auc", ROC_SQL + "SELECT sum(d_fp * (2 * tp - d_tp)) / (2.0 * sum(d_tp) * sum(d_fp)) AS auc FROM roc",
          ops=("W6",))
def q_auc(spark, sf):
    return E.auc(E.roc_curve(mnb_scores(spark, sf)))


# ---- K5 / S10 / M19 (closed-form learners) ------------------------------------------------------------
LEADER_SQL = with_split(SETUP_CTES, MNB_CTES, BNB_CTES, CEN_CTES, """
res AS (SELECT 'multinomial naive bayes' AS name, pred, label FROM mnbp WHERE split <> 'train'
        UNION ALL SELECT 'bernoulli naive bayes', pred, label FROM bnb WHERE split <> 'train'
        UNION ALL SELECT 'nearest centroid', pred, label FROM cenp WHERE split <> 'train'
        UNION ALL SELECT 'zero rule', (SELECT CASE WHEN avg(CAST(label AS DOUBLE)) > 0.5 THEN 1 ELSE 0 END
                                       FROM lab WHERE split = 'train'), label FROM lab WHERE split <> 'train'),
er AS (SELECT name, count(*) FILTER (WHERE pred <> label) / count(*) AS error_rate FROM res GROUP BY name)""")


@register("model_leaderboard", LEADER_SQL + """
SELECT name, error_rate, CAST(row_number() OVER (ORDER BY error_rate, name) AS INTEGER) AS rank FROM er""",
          ops=("K5",))
def q_model_leaderboard(spark, sf):
    def err(df, name):
        return heldout(df).agg(F.lit(name).alias("name"),
                               (F.count_if(F.col("pred") != F.col("label")) / F.count(F.lit(1))).alias("error_rate"))
    sp = split_corpus(spark, sf)
    zr = E.zero_rule(sp.where(F.col("split") == "train"), sp)
    res = (err(mnb_scores(spark, sf), "multinomial naive bayes")
           .unionByName(err(bnb_scores(spark, sf), "bernoulli naive bayes"))
           .unionByName(err(centroid_pred(spark, sf), "nearest centroid"))
           .unionByName(err(zr, "zero rule")))
    return E.leaderboard(res)


SWEEP = tuple(range(10_000, 100_001, 10_000))
SWEEP_SQL = with_split(SETUP_CTES, f"""
vr AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term) AS rk FROM voc),
runs AS (SELECT * FROM (VALUES {', '.join(f'({n})' for n in SWEEP)}) r(run)),
trc AS (SELECT term, sum(CASE WHEN label = 0 THEN tf ELSE 0 END) AS c0, sum(CASE WHEN label = 1 THEN tf ELSE 0 END) AS c1
        FROM cnt JOIN lab USING (row_id) WHERE split = 'train' GROUP BY term),
per AS (SELECT run, vr.term, coalesce(c0, 0) AS c0, coalesce(c1, 0) AS c1 FROM runs JOIN vr ON vr.rk <= runs.run
        LEFT JOIN trc ON trc.term = vr.term),
tot AS (SELECT run, sum(c0) AS N0, sum(c1) AS N1, count(*) AS V FROM per GROUP BY run),
mw AS (SELECT run, term, ln((c1 + 1) / (N1 + V)) - ln((c0 + 1) / (N0 + V)) AS w FROM per JOIN tot USING (run)),
sc AS (SELECT runs.run, lab.row_id, label, ln(n1 / n0) + coalesce(s, 0) AS score FROM runs CROSS JOIN lab
       LEFT JOIN (SELECT run, row_id, sum(tf * w) AS s FROM cnt JOIN mw USING (term) GROUP BY run, row_id) q
       ON q.row_id = lab.row_id AND q.run = runs.run, pri WHERE split <> 'train'),
sweep AS (SELECT run, avg(CASE WHEN (CASE WHEN score > 0 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END) AS accuracy
          FROM sc GROUP BY run)""")


def nb_sweep(spark, sf):
    """M19 for the closed-form learner: one vocabulary ranked once; run n
    keeps ranks <= n; all runs are fit and scored in the same jobs."""
    docs, counts, vocab, (n0, n1) = setup(spark, sf)
    runs = F.array(*[F.lit(n) for n in SWEEP])
    per = vocab.select("term", "c0", "c1", F.explode(F.filter(runs, lambda r: r > F.col("index"))).alias("run"))
    tot = per.groupBy("run").agg(F.sum("c0").alias("tok0"), F.sum("c1").alias("tok1"),
                                 F.count(F.lit(1)).alias("V"))  # a row per run
    w = per.join(F.broadcast(tot), "run").select("run", "term", (
        F.log((F.col("c1") + 1) / (F.col("tok1") + F.col("V")))
        - F.log((F.col("c0") + 1) / (F.col("tok0") + F.col("V")))).alias("w"))
    held = heldout(docs).select("row_id", "label", F.explode(runs).alias("run"))
    s = heldout(counts).join(w, "term").groupBy("run", "row_id").agg(F.sum(F.col("tf") * F.col("w")).alias("s"))
    sc = (held.join(s, ["run", "row_id"], "left")
          .withColumn("score", F.log(F.lit(n1) / F.lit(n0)) + F.coalesce("s", F.lit(0.0))))
    return sc.groupBy("run").agg(F.avg(((F.col("score") > 0).cast("int") == F.col("label")).cast("double"))
                                 .alias("accuracy"))


@register("feature_sweep_nb", SWEEP_SQL + "SELECT CAST(run AS INTEGER) AS run, accuracy FROM sweep", ops=("M19",))
def q_feature_sweep_nb(spark, sf):
    return nb_sweep(spark, sf)


@register("best_by_metric", SWEEP_SQL + """
SELECT CAST(arg_max(run, accuracy * 1000000 - run) AS INTEGER) AS best_run, max(accuracy) AS best_accuracy FROM sweep""",
          ops=("S10",))
def q_best_by_metric(spark, sf):
    return E.best_by_metric(nb_sweep(spark, sf), "run", "accuracy")
