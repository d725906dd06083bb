"""Registered queries: split, class shares, n-grams, count / TF-IDF features,
feature selection, word index and sequences, lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions import text as T
from sentispark.functions.stopwords import ENGLISH_STOP_WORDS
from sentispark.operators import aggregates as A
from sentispark.operators import corpus as C
from sentispark.operators import features as FE
from sentispark.operators import sequences as SQ
from sentispark.operators import terms as TM
from sentispark.operators.filters import class_head_sample, normalize_label
from sentispark.operators.split import split_sql, train_val_test_split
from sentispark.plans import sqltext as S
from sentispark.plans.catalog import register
from sentispark.session import cut_lineage, write_once
from sentispark.sources.tables import all_corpus, raw_corpus, table, text_table

SEED = 2000


def split_corpus(spark, sf, seed: int = SEED):
    """Cleaned corpus with its split.  The cleaned texts are written once, as a table in the
    checkpoint folder; the split is a function of the key and two cut points, so
    it is not written.  Rows are dealt by key first: the exchange is the one a shuffle join
    with the labels needs anyway (Spark drops it then), and splits of uneven sizes even out."""
    raw = raw_corpus(spark, sf).repartition("row_id")
    d = write_once(C.clean_corpus(raw).withColumn("label", normalize_label("target")), "corpus")
    return train_val_test_split(d, "row_id", seed, 0.02)


SPLIT_CTE = ("sp AS MATERIALIZED (" + split_sql(f"(SELECT row_id, text, target, {S.label01()} AS label FROM clean_nn)",
                                   "row_id", SEED, 0.02) + ")")
WITH_SPLIT = S.BASE.rstrip("\n") + ",\n" + SPLIT_CTE + "\n"


def grams_sql(src: str, nmax: int, cols: str = "row_id, split") -> str:
    return (f"g0 AS (SELECT {cols}, string_split(text, ' ') AS t FROM {src}), "
            f"g1 AS (SELECT {cols}, n, t, unnest(range(1, len(t) - n + 2)) AS i FROM g0, range(1, {nmax + 1}) r(n)), "
            f"grams AS MATERIALIZED (SELECT {cols}, CAST(n AS INTEGER) AS n, array_to_string(t[i:i+n-1], ' ') AS term FROM g1)")


# ---- M1, A7, A16 -------------------------------------------------------------------
@register("train_val_test_split", WITH_SPLIT + "SELECT row_id, label, split FROM sp", ops=("M1",))
def q_split(spark, sf):
    return split_corpus(spark, sf).select("row_id", "label", "split")


@register("split_filter", WITH_SPLIT + "SELECT row_id, text, label FROM sp WHERE split = 'validation'", ops=("P10",))
def q_split_filter(spark, sf):
    return split_corpus(spark, sf).where(F.col("split") == "validation").select("row_id", "text", "label")


@register("split_counts", WITH_SPLIT + "SELECT split, CAST(count(*) AS BIGINT) AS n_docs FROM sp GROUP BY split",
          ops=("A16", "M1"))
def q_split_counts(spark, sf):
    return A.split_counts(split_corpus(spark, sf))


@register("class_share", WITH_SPLIT + """
SELECT split, CAST(count(*) AS BIGINT) AS entries,
       round(avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) * 100, 2) AS pct_negative,
       round(avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END) * 100, 2) AS pct_positive
FROM sp GROUP BY split""", ops=("A7", "T20"))
def q_class_share(spark, sf):
    return A.class_share(split_corpus(spark, sf))


# ---- T17 / M2 / M3 / M4 ---------------------------------------------------------------
@register("ngram_counts", S.ALL_BASE.rstrip("\n") + ",\n" + grams_sql("clean_nn", 3, "row_id") + """
SELECT term, n, CAST(count(*) AS BIGINT) AS cnt FROM grams GROUP BY term, n""", ops=("T17",))
def q_ngram_counts(spark, sf):
    d = C.clean_corpus(all_corpus(spark, sf))
    toks = d.select(F.split("text", " ").alias("toks"))

    def sized_grams(n):
        return F.transform(T.ngrams(F.col("toks"), n, n), lambda t: F.struct(t.alias("term"), F.lit(n).alias("n")))

    sized = F.concat(*[sized_grams(n) for n in (1, 2, 3)])
    occ = toks.select(F.inline(sized))
    return occ.groupBy("term", "n").agg(F.count(F.lit(1)).alias("cnt"))


def _vocab_sql(max_features: int, src: str = "occ") -> str:
    return (f"voc AS (SELECT term, cnt, df, row_number() OVER (ORDER BY cnt DESC, term) - 1 AS idx FROM ("
            f"SELECT term, count(*) AS cnt, count(DISTINCT row_id) AS df FROM {src} WHERE split = 'train' "
            f"GROUP BY term ORDER BY cnt DESC, term LIMIT {max_features}))")


def _fit_features(spark, sf, ngram_max: int, max_features: int, stop_words=None):
    """(split corpus, per-document term counts, vocabulary fitted on train)."""
    sp = split_corpus(spark, sf)
    dtc = write_once(FE.doc_counts(sp, ngram_max, stop_words, keep=("row_id", "split")), "counts")
    vocab = write_once(FE.fit_vocabulary_counts(dtc.where(F.col("split") == "train"), max_features), "vocabulary")
    return sp, dtc, vocab


@register("count_vectorize", WITH_SPLIT.rstrip("\n") + ",\n"
          "occ AS (SELECT row_id, split, unnest(string_split(text, ' ')) AS term FROM sp),\n"
          + _vocab_sql(10000) + """
SELECT row_id, term, CAST(idx AS INTEGER) AS "index", CAST(count(*) AS BIGINT) AS tf
FROM occ JOIN voc USING (term) GROUP BY row_id, term, idx""", ops=("M2",))
def q_count_vectorize(spark, sf):
    sp, dtc, vocab = _fit_features(spark, sf, 1, 10000)
    return FE.vectorize_counts(dtc, vocab, 10000)


_STOPS = ", ".join(S.q(w) for w in ENGLISH_STOP_WORDS)


@register("count_vectorize_stop", WITH_SPLIT.rstrip("\n") + ",\n"
          f"occ AS (SELECT row_id, split, term FROM (SELECT row_id, split, unnest(string_split(text, ' ')) AS term "
          f"FROM sp) WHERE term NOT IN ({_STOPS})),\n" + _vocab_sql(10000) + """
SELECT row_id, term, CAST(idx AS INTEGER) AS "index", CAST(count(*) AS BIGINT) AS tf
FROM occ JOIN voc USING (term) GROUP BY row_id, term, idx""", ops=("M2", "T16"))
def q_count_vectorize_stop(spark, sf):
    sp, dtc, vocab = _fit_features(spark, sf, 1, 10000, ENGLISH_STOP_WORDS)
    return FE.vectorize_counts(dtc, vocab, 10000)


TFIDF_SQL = (WITH_SPLIT.rstrip("\n") + ",\n" + grams_sql("sp", 3) + ",\n"
             "occ AS (SELECT row_id, split, term FROM grams),\n" + _vocab_sql(100000) + ",\n"
             "nd AS (SELECT count(*) AS n FROM sp WHERE split = 'train'),\n"
             "tfq AS (SELECT row_id, term, count(*) AS tf FROM occ JOIN voc USING (term) "
             "GROUP BY row_id, term),\n"
             "w AS (SELECT row_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS x FROM tfq JOIN voc USING (term), nd)\n")


def tfidf_all(spark, sf, normalize=True):
    """TF-IDF of every document; vocabulary and weights are fitted on the training split."""
    sp, dtc, vocab = _fit_features(spark, sf, 3, 100000)
    n_docs = sp.where(F.col("split") == "train").agg(F.count(F.lit(1)).alias("n"))
    counts = FE.vectorize_counts(dtc, vocab, 100000)
    return FE.tfidf(counts, vocab, n_docs, 100000, normalize=normalize)


@register("tfidf", TFIDF_SQL + "SELECT row_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS tfidf FROM w",
          ops=("M3", "T17"))
def q_tfidf(spark, sf):
    return tfidf_all(spark, sf).select("row_id", "term", "tfidf")


@register("l2_normalize", TFIDF_SQL + """
SELECT row_id, sqrt(sum(v * v)) AS norm, CAST(count(*) AS BIGINT) AS n_terms FROM (
  SELECT row_id, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS v FROM w) GROUP BY row_id""", ops=("M4",))
def q_l2_normalize(spark, sf):
    w = tfidf_all(spark, sf, normalize=False)
    v = FE.l2_normalize(w, "tfidf")
    return v.groupBy("row_id").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("norm"),
                                   F.count(F.lit(1)).alias("n_terms"))


# ---- C1 / C2 -----------------------------------------------------------------------------
_TRAIN_OCC = (WITH_SPLIT.rstrip("\n") + ",\n"
              "occ AS (SELECT row_id, label, unnest(string_split(text, ' ')) AS term FROM sp WHERE split = 'train'),\n"
              "lab AS (SELECT row_id, label FROM sp WHERE split = 'train')\n")


def _train_occ(spark, sf):
    sp = split_corpus(spark, sf).where(F.col("split") == "train")
    occ = C.explode_tokens(sp, keep=("row_id", "label"))
    return sp.select("row_id", "label"), occ


@register("chi2_select", _TRAIN_OCC + """
, cnt AS (SELECT row_id, term, count(*) AS tf FROM occ GROUP BY row_id, term),
pri AS (SELECT label, count(*) / (SELECT count(*) FROM lab) AS p_c FROM lab GROUP BY label),
tot AS (SELECT term, sum(tf) AS tot FROM cnt GROUP BY term),
obs AS (SELECT term, label, sum(tf) AS obs FROM cnt JOIN lab USING (row_id) GROUP BY term, label),
cells AS (SELECT tot.term AS term, pri.label, p_c * tot AS e, coalesce(obs.obs, 0) AS o FROM tot CROSS JOIN pri
          LEFT JOIN obs ON obs.term = tot.term AND obs.label = pri.label)
SELECT term, chi2 FROM (SELECT term, sum((o - e) * (o - e) / e) AS chi2 FROM cells GROUP BY term)
ORDER BY chi2 DESC, term LIMIT 100""".replace("\n, cnt AS", ",\ncnt AS"), ops=("C1",))
def q_chi2_select(spark, sf):
    lab, occ = _train_occ(spark, sf)
    return TM.top_k(FE.chi2_scores(occ, lab), 100, "chi2")


@register("mutual_info_select", _TRAIN_OCC + """
, pres AS (SELECT DISTINCT row_id, term FROM occ),
n AS (SELECT count(*) AS n, sum(label) AS n1 FROM lab),
t AS (SELECT term, count(*) AS nt, sum(label) AS nt1 FROM pres JOIN lab USING (row_id) GROUP BY term),
c AS (SELECT term, n, nt, n1, nt1 AS n11, nt - nt1 AS n10, n1 - nt1 AS n01, n - nt - n1 + nt1 AS n00 FROM t, n)
SELECT term, mi FROM (SELECT term,
  (CASE WHEN n11 > 0 THEN n11 / n * ln(n * n11 / (nt * n1)) ELSE 0 END)
+ (CASE WHEN n10 > 0 THEN n10 / n * ln(n * n10 / (nt * (n - n1))) ELSE 0 END)
+ (CASE WHEN n01 > 0 THEN n01 / n * ln(n * n01 / ((n - nt) * n1)) ELSE 0 END)
+ (CASE WHEN n00 > 0 THEN n00 / n * ln(n * n00 / ((n - nt) * (n - n1))) ELSE 0 END) AS mi FROM c)
ORDER BY mi DESC, term LIMIT 100""".replace("\n, pres AS", ",\npres AS"), ops=("C2",))
def q_mutual_info_select(spark, sf):
    lab = split_corpus(spark, sf).where(F.col("split") == "train")
    pres = lab.select("label", F.explode(F.array_distinct(F.split("text", " "))).alias("term"))
    return TM.top_k(FE.mutual_info_scores(pres, lab), 100, "mi")


# ---- W7 / W8 / W9 / J3 / E12 ----------------------------------------------------------------
INDEX_SQL = (WITH_SPLIT.rstrip("\n") + ",\n"
             "widx AS (SELECT term, cnt, row_number() OVER (ORDER BY cnt DESC, term) AS id FROM ("
             "SELECT term, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS term FROM sp "
             "WHERE split = 'train') GROUP BY term))\n")


def word_index(spark, sf):
    sp = split_corpus(spark, sf)
    return sp, SQ.frequency_index(C.explode_tokens(sp.where(F.col("split") == "train"), keep=()))


@register("frequency_index", INDEX_SQL + "SELECT term, CAST(cnt AS BIGINT) AS cnt, id FROM widx", ops=("W7",))
def q_frequency_index(spark, sf):
    return word_index(spark, sf)[1].select("term", "cnt", "id")


SEQ_SQL = (INDEX_SQL.rstrip("\n") + ",\n"
           "occ AS (SELECT row_id, unnest(range(1, len(t) + 1)) AS pos, t FROM "
           "(SELECT row_id, string_split(text, ' ') AS t FROM sp)),\n"
           "hits AS (SELECT row_id, pos, id FROM (SELECT row_id, pos, t[pos] AS term FROM occ) "
           "JOIN widx USING (term) WHERE id < 100000),\n"
           "seqs AS (SELECT sp.row_id, coalesce(list(CAST(id AS INTEGER) ORDER BY pos) FILTER (WHERE id IS NOT NULL), "
           "[]::INTEGER[]) AS seq FROM sp LEFT JOIN hits USING (row_id) GROUP BY sp.row_id)\n")


def sequences(spark, sf):
    sp, idx = word_index(spark, sf)
    return SQ.texts_to_sequences(sp, idx, 100000)


@register("texts_to_sequences", SEQ_SQL + "SELECT row_id, CAST(len(seq) AS INTEGER) AS n_ids, "
          "array_to_string(seq, ' ') AS seq FROM seqs", ops=("W8",))
def q_texts_to_sequences(spark, sf):
    s = sequences(spark, sf)
    return s.select("row_id", F.size("seq").alias("n_ids"), F.array_join("seq", " ").alias("seq"))


@register("pad_sequences", SEQ_SQL + """
SELECT row_id, array_to_string(CASE WHEN len(seq) >= 45 THEN seq[len(seq) - 44:]
       ELSE list_concat(list_transform(range(45 - len(seq)), lambda x: 0), seq) END, ' ') AS padded FROM seqs""",
          ops=("W9",))
def q_pad_sequences(spark, sf):
    s = sequences(spark, sf)
    return s.select("row_id", F.array_join(SQ.pad_sequences(F.col("seq"), 45), " ").alias("padded"))


@register("embedding_matrix", INDEX_SQL + """
SELECT id, term, e.vec_id IS NOT NULL AS has_vector,
       coalesce(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE))), 0.0) AS vec_sum,
       CAST(coalesce(len(e.embedding), 64) AS INTEGER) AS dim
FROM widx LEFT JOIN embeddings e ON e.vec_id = widx.id WHERE id < 100000""", ops=("J3", "E12"))
def q_embedding_matrix(spark, sf):
    _, idx = word_index(spark, sf)
    vecs = table(spark, sf, "embeddings")
    m = SQ.embedding_lookup(idx, vecs, 64, 100000)
    has = idx.select("id").join(vecs.select(F.col("vec_id").alias("id"), F.lit(True).alias("has_vector")),
                                "id", "left")
    return (m.join(has, "id")
            .select("id", "term", F.coalesce("has_vector", F.lit(False)).alias("has_vector"),
                    F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double")).alias("vec_sum"),
                    F.size("vec").alias("dim")))


# ---- J1 / J2 / J6 / J7 / J8 -------------------------------------------------------------------
@register("attach_by_index", S.BASE + """
SELECT c.row_id, c.t AS text, r.target AS target FROM clean c LEFT JOIN corpus r ON r.row_id = c.row_id""",
          ops=("J1",))
def q_attach_by_index(spark, sf):
    raw = raw_corpus(spark, sf)
    cleaned = raw.select("row_id", T.clean_text("text").alias("text"))
    return cleaned.join(raw.select("row_id", "target"), "row_id", "left")


# every seventh turn is a mention, which cleans to nothing: the check has rows to find
_CONV = ("conv AS (SELECT conv_id, turn, role, CASE WHEN (conv_id + turn) % 7 = 0 THEN '@someone' ELSE text END AS text "
         "FROM conversations)")
_CONV_CLEAN = [_CONV, *S.staged("cc", "conv", "conv_id, turn", "text", S.clean_steps())]


def with_mentions(conv):
    return conv.withColumn("text", F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, "@someone").otherwise(F.col("text")))


@register("originals_of_nulls", S.with_(*_CONV_CLEAN) + """
SELECT c.conv_id, c.turn, c.role, c.text FROM conv c
WHERE EXISTS (SELECT 1 FROM cc WHERE cc.conv_id = c.conv_id AND cc.turn = c.turn AND NOT """ + S.not_empty("cc.t") + ")",
          ops=("J2",))
def q_originals_of_nulls(spark, sf):
    conv = with_mentions(text_table(spark, sf, "conversations"))
    empty = conv.select("conv_id", "turn",
                        C.keep_where(T.clean_text("text"), lambda t: T.is_empty_text(t)).alias("t"))
    return conv.join(empty, ["conv_id", "turn"], "left_semi").select("conv_id", "turn", "role", "text")


@register("union_splits", S.BASE + """
SELECT target, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT row_id, target FROM (SELECT row_id, target, row_number() OVER (PARTITION BY target ORDER BY row_id) AS rk,
         count(*) OVER () AS n FROM clean_nn) WHERE rk <= floor(n * 0.05)) GROUP BY target""", ops=("J6", "P13"))
def q_union_splits(spark, sf):
    d = cut_lineage(C.clean_corpus(raw_corpus(spark, sf)))
    # the study concatenates the first rows of each class; union by name
    head = class_head_sample(d, 0.05)
    neg = head.where(F.col("target") == 0)
    pos = head.where(F.col("target") == 4)
    return neg.unionByName(pos).groupBy("target").agg(F.count(F.lit(1)).alias("n_rows"))


_TOP10_SQL = ("top10 AS (SELECT term FROM (SELECT term, count(*) AS total FROM tokens GROUP BY term) "
              "ORDER BY total DESC, term LIMIT 10)")


@register("is_subset", S.BASE_TOKENS.rstrip("\n") + ",\n" + _TOP10_SQL + f"""
SELECT CAST(count(*) AS BIGINT) AS n_top, CAST(count(*) FILTER (WHERE term NOT IN ({_STOPS})) AS BIGINT) AS n_not_stop,
       count(*) FILTER (WHERE term NOT IN ({_STOPS})) = 0 AS is_subset FROM top10""", ops=("J7",))
def q_is_subset(spark, sf):
    toks = C.explode_tokens(C.clean_corpus(raw_corpus(spark, sf)))
    top = TM.top_k(toks.groupBy("term").agg(F.count(F.lit(1)).alias("total")), 10, "total").select("term")
    stops = spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "term string")
    missing = top.join(F.broadcast(stops), "term", "left_anti")
    return (top.agg(F.count(F.lit(1)).alias("n_top"))
            .crossJoin(missing.agg(F.count(F.lit(1)).alias("n_not_stop")))
            .withColumn("is_subset", F.col("n_not_stop") == 0))


@register("top_terms_as_stops", S.BASE_TOKENS.rstrip("\n") + ",\n" + _TOP10_SQL + """
SELECT term, CAST(count(*) AS BIGINT) AS total FROM tokens WHERE term NOT IN (SELECT term FROM top10)
GROUP BY term""", ops=("J8",))
def q_top_terms_as_stops(spark, sf):
    toks = C.explode_tokens(C.clean_corpus(raw_corpus(spark, sf)))
    counts = toks.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    top = TM.top_k(counts, 10, "total").select("term")
    return counts.join(F.broadcast(top), "term", "left_anti")
