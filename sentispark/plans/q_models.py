"""Registered queries: learners on pyspark.ml, online learners, embedding jobs.

These have no SQL form (iterative optimisers); the driver checks their rows.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sentispark.operators import boosting as BO
from sentispark.operators import corpus as C
from sentispark.operators import embed as EM
from sentispark.operators import evaluate as E
from sentispark.operators import features as FE
from sentispark.operators import learners as L
from sentispark.operators import online as ON
from sentispark.operators import phrases as PH
from sentispark.operators import similarity as SIM
from sentispark.operators import sparse as SP
from sentispark.plans.catalog import register
from sentispark.functions.stopwords import ENGLISH_STOP_WORDS
from sentispark.plans.q_evaluate import SWEEP, heldout
from sentispark.plans.q_features import WITH_SPLIT, split_corpus
from sentispark.plans.q_phrases import _WV, word_vectors
from sentispark.session import cut_lineage, write_once
from sentispark.sources.tables import all_corpus


ITERS = 100  # optimiser iterations of the study's library
GRAMS, FEATURES = 3, 100_000  # the study's text features


def _vocabulary(train, ngram: int, max_features: int, stop_words=None):
    """Vocabulary terms of the training texts.  Only the terms' counts are wanted, so grams go to the
    aggregation as they are (it sums them up before the exchange); no row's grams are sorted."""
    counts = FE.doc_grams(train, ngram, stop_words).withColumn("tf", F.lit(1))
    return L.vocabulary_terms(FE.fit_vocabulary_counts(counts, max_features), max_features)


def ml_frame(spark, sf, ngram: int = 1, max_features: int = 10000, kind: str = "tfidf", vocab_terms=None):
    sp = split_corpus(spark, sf)
    docs = sp.select("row_id", "split", F.col("label").cast("double").alias("label"),
                     FE.grams(F.col("text"), ngram).alias("grams"))
    if vocab_terms is None:
        vocab_terms = _vocabulary(sp.where(F.col("split") == "train"), ngram, max_features)
    if kind == "tfidf":
        feats = L.tfidf_vectors(docs, vocab_terms, "grams", F.col("split") == "train")
    else:
        feats = L.count_vectors(docs, vocab_terms, "grams", binary=(kind == "binary"))
    return feats.drop("grams"), vocab_terms


def _train(feats):
    tr = feats.where(F.col("split") == "train")
    return tr, tr.count()


def _preds(out):
    cols = ["row_id", "split", "label", F.col("prediction").cast("int").alias("prediction")]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability")[1].alias("prob_positive"))
    return out.select(*cols)


# ---- M6 / M7 / M8 / M9 / M10 / M13 / M14 / M18 ---------------------------------------------
@register("logistic_regression", ops=("M7", "M3"))
def q_logistic_regression(spark, sf):
    feats, _ = ml_frame(spark, sf, ngram=3, max_features=100000)
    tr, n = _train(feats)
    return _preds(L.logistic_regression(n, maxIter=ITERS).fit(tr).transform(feats))


@register("count_logreg_fit", ops=("M6", "M2"))
def q_count_logreg_fit(spark, sf):
    sp = split_corpus(spark, sf)
    docs = sp.select("row_id", "split", F.col("label").cast("double").alias("label"),
                     FE.grams(F.col("text"), 1).alias("grams"))
    tr = docs.where(F.col("split") == "train")
    terms = _vocabulary(sp.where(F.col("split") == "train"), 1, 10000)
    model = L.pipeline(terms, L.logistic_regression(tr.count(), maxIter=ITERS)).fit(tr)
    return _preds(model.transform(docs))


def _pv_errors(spark, sf, wanted, inferred: bool = False):
    """Error rate of logistic regression without penalty on the held-out documents, one row per
    named list of paragraph-vector modes (their vectors concatenated).  Vectors are trained on all
    documents; with ``inferred``, further rows score the held-out documents by vectors inferred
    from the trained word weights, as documents the models have not seen."""
    from pyspark.ml.functions import array_to_vector
    labels = cut_lineage(split_corpus(spark, sf).select("row_id", "split", F.col("label").cast("double").alias("label")))
    tokens = cut_lineage(_all_tokens(spark, sf))
    unseen = tokens.join(heldout(labels).select("row_id"), "row_id", "left_semi")
    trained, anew = {}, {}
    for m in sorted({m for parts in wanted.values() for m in parts}):
        vecs, words = _embed(spark, sf, m, tokens)
        trained[m] = vecs.select(F.col("key").alias("row_id"), F.col("vec").alias(m))
        if inferred:
            anew[m] = _embed(spark, sf, m, unseen, words)[0].select(F.col("key").alias("row_id"), F.col("vec").alias(m))
    out = None
    for name, parts in wanted.items():
        def data(vecs, rows):
            for m in parts:
                rows = rows.join(vecs[m], "row_id")
            return cut_lineage(rows.select("row_id", "split", "label", array_to_vector(F.concat(*parts)).alias("features")))
        known = data(trained, labels)
        model = L.logit_unregularised(maxIter=ITERS).fit(known.where(F.col("split") == "train"))
        tests = {name: heldout(known)}
        if inferred:
            tests[f"{name}_inferred"] = data(anew, heldout(labels))
        for label, rows in tests.items():
            scored = model.transform(rows).withColumn("prob", vector_to_array("probability")[1])
            row = E.error_rate(scored, "label", "prob").withColumn("name", F.lit(label))
            out = row if out is None else out.unionByName(row)
    return out


@register("logit_unregularised", ops=("M8", "A15"))
def q_logit_unregularised(spark, sf):
    return _pv_errors(spark, sf, {"dbow": ["dbow"]})


@register("pv_error_table", ops=("M8", "A15", "E1", "E2", "E3", "E4", "E5"))
def q_pv_error_table(spark, sf):
    return _pv_errors(spark, sf, {"dbow": ["dbow"], "dmm": ["dmm"], "dmc": ["dmc"], "dbow+dmm": ["dbow", "dmm"],
                                  "dbow+dmc": ["dbow", "dmc"]}, inferred=True)


@register("linear_svc", ops=("M9",))
def q_linear_svc(spark, sf):
    feats, terms = ml_frame(spark, sf, GRAMS, FEATURES)
    return _preds(SP.svc(_train(feats)[0], len(terms), max_iter=ITERS).transform(feats))


@register("l1_select_then_svc", ops=("M10",))
def q_l1_select_then_svc(spark, sf):
    feats, terms = ml_frame(spark, sf, GRAMS, FEATURES)
    return _preds(SP.l1_select_then_svc(_train(feats)[0], len(terms), max_iter=ITERS).transform(feats))


@register("ridge_classifier", ops=("M13",))
def q_ridge_classifier(spark, sf):
    feats, _ = ml_frame(spark, sf, GRAMS, FEATURES)
    tr, _n = _train(feats)
    return _preds(L.ridge_classifier(tr).transform(feats))


@register("adaboost_stumps", ops=("M14",))
def q_adaboost_stumps(spark, sf):
    feats, _ = ml_frame(spark, sf, GRAMS, FEATURES, kind="count")
    rows = cut_lineage(SP.from_vectors(feats))
    return _preds(BO.boost_stumps(rows.where(F.col("split") == "train")).transform(rows))


def _chi2_terms(spark, sf, k: int):
    from sentispark.operators import corpus as C
    from sentispark.operators import terms as TM
    sp = split_corpus(spark, sf).where(F.col("split") == "train")
    occ = C.explode_tokens(sp, keep=("row_id", "label"))
    top = TM.top_k(FE.chi2_scores(occ, sp), k, "chi2")
    return [r.term for r in top.orderBy(F.col("chi2").desc(), "term").collect()]  # k terms


@register("mlp_classify", ops=("M18", "C1"))
def q_mlp_classify(spark, sf):
    terms = _chi2_terms(spark, sf, 10_000)
    feats, _ = ml_frame(spark, sf, vocab_terms=terms)
    rows = SP.keep_rows(SP.from_vectors(feats))
    weights = SP.hidden_layer(rows.where(F.col("split") == "train"), len(terms), 64, L.mlp_start(spark, len(terms), 64), max_iter=ITERS)
    return SP.predict_hidden_layer(rows, weights, len(terms), 64)


@register("pca_project", ops=("C3",))
def q_pca_project(spark, sf):
    feats, terms = ml_frame(spark, sf, GRAMS, FEATURES)
    rows = SP.keep_rows(SP.from_vectors(feats.select("row_id", "features")))
    mean, components, _ = SP.principal_components(rows, len(terms), 10)
    return SP.project(rows, mean, components).select("row_id", *[F.col("pc")[i].alias(f"pc{i}") for i in range(10)])


# ---- M15 / M16 (iterative parameter mixing) ------------------------------------------------------------------
def _online(spark, sf, rule: str):
    feats, _ = ml_frame(spark, sf, GRAMS, FEATURES)
    rows = cut_lineage(SP.from_vectors(feats.withColumn("label", F.col("label").cast("int"))))
    w = ON.fit_online(rows.where(F.col("split") == "train"), rule, epochs=5)
    return ON.predict_online(rows, w).select("row_id", "split", "label", "score", "prediction")


@register("perceptron", ops=("M15",))
def q_perceptron(spark, sf):
    return _online(spark, sf, "perceptron")


@register("passive_aggressive", ops=("M16",))
def q_passive_aggressive(spark, sf):
    return _online(spark, sf, "pa")


# ---- M20 / M21 ---------------------------------------------------------------------------------------------
@register("classifier_comparison", ops=("M20", "A20", "J9"))
def q_classifier_comparison(spark, sf):
    """The study's ten learners on one TF-IDF table of 1-3-grams: held-out accuracy and fit time."""
    import time
    feats, terms = ml_frame(spark, sf, GRAMS, FEATURES)
    rows, d = SP.keep_rows(SP.from_vectors(feats)), len(terms)
    tr, ones = rows.where(F.col("split") == "train"), SP.presence(rows)
    vectors = feats.where(F.col("split") == "train")

    def online(rule):
        weights = ON.fit_online(tr.withColumn("label", F.col("label").cast("int")), rule, epochs=5)
        return lambda data: ON.predict_online(data, weights)

    def linear(weights):
        return lambda data: SP.add_scores(data, weights).withColumn("prediction", (F.col("score") > 0).cast("double"))

    estimators = {  # J9: names paired with estimators in a plain dict
        "logistic regression": (lambda: linear(SP.nested_logistic(tr, d, (d,), max_iter=ITERS)[:, 0]), rows),
        "linear svc": (lambda: linear(SP.squared_hinge(tr, d, max_iter=ITERS)), rows),
        "linear svc, l1 selection": (lambda: linear(SP.l1_select_then_svc(vectors, d, max_iter=ITERS).weights), rows),
        "multinomial nb": (lambda: linear(SP.multinomial_weights(tr, d)), rows),
        "bernoulli nb": (lambda: linear(SP.bernoulli_weights(ones.where(F.col("split") == "train"), d)), ones),
        "ridge classifier": (lambda: linear(SP.ridge(tr, d, max_iter=ITERS)), rows),
        "adaboost": (lambda: BO.boost_stumps(tr).transform, rows),
        "perceptron": (lambda: online("perceptron"), rows),
        "passive aggressive": (lambda: online("pa"), rows),
        "nearest centroid": (lambda: linear(SP.centroid_weights(tr, d)), rows),
    }
    out = None
    for name, (fit, data) in estimators.items():
        t0 = time.time()
        predict = fit()
        seconds = time.time() - t0  # A20: wall time of the fit, a reported (not compared) column
        row = predict(heldout(data)).agg(
            F.lit(name).alias("name"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
            F.count(F.lit(1)).alias("n"), F.lit(round(seconds, 3)).alias("fit_seconds"))
        out = row if out is None else out.unionByName(row)
    return out


SWEEP_MODES = ((1, "none"), (1, "english"), (1, "ten most frequent"), (2, "none"), (3, "none"))


@register("feature_sweep_logreg", ops=("M19", "J8"))
def q_feature_sweep_logreg(spark, sf):
    """Held-out accuracy of logistic regression by n-gram range, stop words and vocabulary size: one
    row per run; the sizes of a mode are fitted together."""
    sp = cut_lineage(split_corpus(spark, sf).select("row_id", "split", F.col("label").cast("double").alias("label"), "text"))
    occ = sp.where(F.col("split") == "train").select("row_id", F.explode(F.split("text", " ")).alias("term"))
    often = [r.term for r in occ.groupBy("term").count().orderBy(F.col("count").desc(), "term").limit(10).collect()]
    stops, out = {"none": None, "english": ENGLISH_STOP_WORDS, "ten most frequent": often}, []
    for ngram, mode in SWEEP_MODES:
        docs = sp.select("row_id", "split", "label", FE.grams(F.col("text"), ngram, stops[mode]).alias("grams"))
        terms = _vocabulary(sp.where(F.col("split") == "train"), ngram, SWEEP[-1], stops[mode])
        rows = SP.keep_rows(SP.from_vectors(L.count_vectors(docs, terms).drop("grams")))
        w = SP.nested_logistic(rows.where(F.col("split") == "train"), len(terms), SWEEP, max_iter=ITERS, tol=1e-3)
        out += [(ngram, mode, n, float(a)) for n, a in zip(SWEEP, SP.accuracies(heldout(rows), w))]
    return spark.createDataFrame(out, "ngram int, stop_words string, n_features int, accuracy double")  # a row per run


@register("roc_comparison", ops=("W5", "W6", "M7"))
def q_roc_comparison(spark, sf):
    """ROC points and AUC of logistic regression beside multinomial naive Bayes, all documents scored."""
    feats, terms = ml_frame(spark, sf, GRAMS, FEATURES)
    rows, d = SP.keep_rows(SP.from_vectors(feats)), len(terms)
    train = rows.where(F.col("split") == "train")
    weights = {"logistic regression": SP.nested_logistic(train, d, (d,), max_iter=ITERS)[:, 0],
               "multinomial nb": SP.multinomial_weights(train, d)}
    out = None
    for name, w in weights.items():
        curve = E.roc_curve(cut_lineage(SP.add_scores(rows.withColumn("label", F.col("label").cast("int")), w).select("label", "score")))
        got = curve.select(F.lit(name).alias("name"), "threshold", "tp", "fp", "fpr", "tpr").join(F.broadcast(E.auc(curve)))
        out = got if out is None else out.unionByName(got)
    return out


@register("train_test_evaluate", ops=("M21", "A11", "A14"))
def q_train_test_evaluate(spark, sf):
    feats, _ = ml_frame(spark, sf, ngram=3, max_features=80000, kind="count")
    tr, n = _train(feats)
    pred = heldout(L.logistic_regression(n, maxIter=ITERS).fit(tr).transform(feats)).withColumn(
        "pred", F.col("prediction").cast("int"))
    report = E.classification_report(pred, "label", "pred")
    rows = pred.agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"),
                    F.greatest(F.avg("label"), 1 - F.avg("label")).alias("null_accuracy"),
                    *[F.count_if((F.col("label") == a) & (F.col("pred") == b)).alias(f"true_{a}_predicted_{b}")
                      for a in (0, 1) for b in (0, 1)])
    return report.crossJoin(F.broadcast(rows))


# ---- M5 (SQL-checkable) ---------------------------------------------------------------------------------------
@register("minmax_scale", _WV.replace(WITH_SPLIT.rstrip("\n"), WITH_SPLIT.rstrip("\n"), 1).rstrip("\n") + """,
mm AS (SELECT dim, min(value) AS lo, max(value) AS hi FROM adv JOIN sp USING (row_id) WHERE split = 'train' GROUP BY dim)
SELECT row_id, dim, (value - lo) / CASE WHEN hi - lo = 0 THEN 1 ELSE hi - lo END AS scaled
FROM adv JOIN mm USING (dim)""", ops=("M5",))
def q_minmax_scale(spark, sf):
    _, counts, wv = word_vectors(spark, sf)
    # the split is a function of the key
    adv = write_once(SIM.avg_doc_arrays(counts, wv, 64, ("row_id", "split")), "doc-vectors")
    values = adv.select("row_id", "split", F.posexplode("vec").alias("dim", "value"))
    mm = values.where(F.col("split") == "train").groupBy("dim").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    rng = F.when(F.col("hi") - F.col("lo") == 0, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    return values.join(F.broadcast(mm), "dim").select("row_id", "dim", ((F.col("value") - F.col("lo")) / rng)
                                                     .alias("scaled"))


# ---- E1-E8, E14 ------------------------------------------------------------------------------------------------
WINDOW = {"dbow": 2, "dmm": 4, "dmc": 2, "cbow": 2, "sg": 2}  # the study's windows


def _all_tokens(spark, sf):
    """Cleaned tokens of every document: vectors are trained on unlabelled ones too."""
    return C.clean_corpus(all_corpus(spark, sf)).select("row_id", F.split("text", " ").alias("tokens"))


def _embed(spark, sf, mode: str, docs=None, words=None):
    docs = _all_tokens(spark, sf) if docs is None else docs
    return EM.train(docs, EM.EmbedParams(mode=mode, window=WINDOW[mode]), words)


def _doc_out(dv):
    return dv.select(F.col("key").alias("row_id"), "vec")


@register("pv_dbow", ops=("E1",))
def q_pv_dbow(spark, sf):
    return _doc_out(_embed(spark, sf, "dbow")[0])


@register("pv_dmm", ops=("E2",))
def q_pv_dmm(spark, sf):
    return _doc_out(_embed(spark, sf, "dmm")[0])


@register("pv_dmc", ops=("E3",))
def q_pv_dmc(spark, sf):
    return _doc_out(_embed(spark, sf, "dmc")[0])


@register("pv_combined", ops=("E4", "J5"))
def q_pv_combined(spark, sf):
    a, b = (_embed(spark, sf, m)[0].withColumnRenamed("key", "row_id") for m in ("dbow", "dmm"))
    return SIM.concat_vectors(a, b, "row_id").select("row_id", "vec")


@register("infer_vector", ops=("E5",))
def q_infer_vector(spark, sf):
    """Vectors of the held-out documents from word weights trained on the others."""
    sp = split_corpus(spark, sf).select("row_id", "split", F.split("text", " ").alias("tokens"))
    _, words = _embed(spark, sf, "dbow", sp.where(F.col("split") == "train"))
    return _doc_out(_embed(spark, sf, "dbow", heldout(sp), words)[0])


@register("pv_phrase_pair", ops=("E4", "W2", "W3"))
def q_pv_phrase_pair(spark, sf):
    """DBOW vectors of the bigram-phrased texts beside DMM vectors of the trigram-phrased ones."""
    tokens = cut_lineage(_all_tokens(spark, sf))
    bigrams = cut_lineage(PH.learn_and_apply(tokens, F.lit(True))[0])
    trigrams = cut_lineage(PH.learn_and_apply(bigrams, F.lit(True))[0])
    a, b = (_embed(spark, sf, m, docs)[0].withColumnRenamed("key", "row_id")
            for m, docs in (("dbow", bigrams), ("dmm", trigrams)))
    return SIM.concat_vectors(a, b, "row_id").select("row_id", "vec")


def _skipgram_vectors(spark, sf):
    return _embed(spark, sf, "sg")[1].select("term", F.col("w_in").alias("vec"))


def _cbow_vectors(spark, sf):
    return _embed(spark, sf, "cbow")[1].select("term", F.col("w_in").alias("vec"))


@register("word2vec_skipgram", ops=("E6",))
def q_word2vec_skipgram(spark, sf):
    return _skipgram_vectors(spark, sf)


@register("word2vec_cbow", ops=("E7",))
def q_word2vec_cbow(spark, sf):
    return _cbow_vectors(spark, sf)


@register("word_vectors_concat", ops=("E8", "J5"))
def q_word_vectors_concat(spark, sf):
    return SIM.concat_vectors(_cbow_vectors(spark, sf), _skipgram_vectors(spark, sf), "term").select("term", "vec")


@register("similarity_table", ops=("E14", "E9"))
def q_similarity_table(spark, sf):
    sg, cb = cut_lineage(_skipgram_vectors(spark, sf)), _cbow_vectors(spark, sf)
    models = {"skipgram": sg, "cbow": cb, "both": SIM.concat_vectors(cb, sg, "term")}
    # the query word: a seeded pick among words both models know
    q = cut_lineage(SIM.seeded_pick(sg.select("term").join(cb.select("term"), "term"), "term", 5))
    out = None
    for name, tab in models.items():
        top = SIM.most_similar(tab, tab.join(q, "term"), "term", "vec", 20)
        top = top.select(F.lit(name).alias("model"), F.col("q_key").alias("word"), F.col("term").alias("similar"), "similarity")
        out = top if out is None else out.unionByName(top)
    return out
