"""Text features (M2-M5, T17, C1-C3) in long form and at the ML edge.

Long form ``(row_id, term, value)`` is what SQL can check and what scales:
the vocabulary is a top-k (``max_features`` rows, a size fixed by the caller),
which is broadcast; without a bound Catalyst chooses its joins by measured size.
At the ML edge the same vocabulary feeds ``CountVectorizerModel`` so vectors
are built in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.functions import text as T
from sentispark.operators.terms import remove_stop_words


#: Most rows of a vocabulary that travels to the tasks.
LOOKUP = 1_000_000


def bounded(vocab: DataFrame, max_features: int | None) -> DataFrame:
    """A vocabulary of a size fixed by the caller is broadcast, whatever Catalyst's threshold: the counts
    that it meets, far larger, stay where they are."""
    return F.broadcast(vocab) if max_features is not None and max_features <= LOOKUP else vocab


def grams(text: Column, ngram_max: int = 1, stop_words=None) -> Column:
    """T16 + T17: n-grams (1..ngram_max) of a cleaned text; stop words first."""
    toks = F.split(text, " ")
    if stop_words:
        toks = remove_stop_words(toks, stop_words)
    return T.ngrams(toks, ngram_max)


def doc_grams(df: DataFrame, ngram_max: int = 1, stop_words=None, key: str = "row_id",
              extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per (document, gram occurrence)."""
    return df.select(key, *extra, F.explode(grams(F.col("text"), ngram_max, stop_words)).alias("term"))


def doc_counts(df: DataFrame, ngram_max: int = 1, stop_words=None,
               keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Term counts ``(keep..., term, tf)`` of each row of ``df``, counted inside the row: its grams
    are sorted and the lengths of equal runs taken, so nothing is shuffled.  A row is a
    document: a repeated key counts as two documents."""
    sorted_grams = df.select(*keep, F.sort_array(grams(F.col("text"), ngram_max, stop_words)).alias("__g"))
    at_start = F.transform("__g", lambda t, i: F.struct(t.alias("term"), i.alias("at")))
    runs = F.filter(at_start, lambda s: (s["at"] == 0) | (F.get(F.col("__g"), s["at"] - 1) != s["term"]))
    in_runs = sorted_grams.select(*keep, F.size("__g").alias("__n"), runs.alias("__s"))
    counted = F.transform("__s", lambda s, i: F.struct(
        s["term"].alias("term"),
        (F.coalesce(F.get(F.col("__s"), i + 1)["at"], F.col("__n")) - s["at"]).cast("long").alias("tf")))
    return in_runs.select(*keep, F.inline(counted))


def fit_vocabulary(occ: DataFrame, max_features: int | None, key: str = "row_id") -> DataFrame:
    """Vocabulary ``(term, index, cnt, df)``: the ``max_features`` most frequent
    terms (ties by term), index 0.. in that order."""
    from pyspark.sql import Window
    counts = occ.groupBy("term").agg(F.count(F.lit(1)).alias("cnt"),
                                      F.count_distinct(key).alias("df"))
    if max_features is not None:
        counts = counts.orderBy(F.col("cnt").desc(), F.col("term")).limit(max_features)
        w = Window.orderBy(F.col("cnt").desc(), F.col("term"))  # over max_features rows only
        return counts.withColumn("index", (F.row_number().over(w) - 1).cast("int"))
    from sentispark.operators.ranking import global_row_number
    return global_row_number(counts, [F.col("cnt").desc(), F.col("term")], "index") \
        .withColumn("index", (F.col("index") - 1).cast("int"))


def doc_term_table(occ: DataFrame, key: str = "row_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """Per-document term counts ``(key, extra..., term, tf)`` -- the one
    aggregation both the vocabulary and the vectors are built from."""
    return occ.groupBy(key, *extra, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary_counts(dtc: DataFrame, max_features: int | None, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Vocabulary from per-document counts: ``cnt = sum(tf)``, ``df = count``
    (one row per document and term), top ``max_features`` by cnt then term.
    ``extra``: further aggregates of a term, taken in the same pass."""
    from pyspark.sql import Window
    counts = dtc.groupBy("term").agg(F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df"), *extra)
    if max_features is not None:
        counts = counts.orderBy(F.col("cnt").desc(), F.col("term")).limit(max_features)
        w = Window.orderBy(F.col("cnt").desc(), F.col("term"))  # over max_features rows only
        return counts.withColumn("index", (F.row_number().over(w) - 1).cast("int"))
    from sentispark.operators.ranking import global_row_number
    return global_row_number(counts, [F.col("cnt").desc(), F.col("term")], "index") \
        .withColumn("index", (F.col("index") - 1).cast("int"))


def vectorize_counts(dtc: DataFrame, vocab: DataFrame, max_features: int | None,
                     key: str = "row_id") -> DataFrame:
    """M2 long form from per-document counts: ``(row_id, term, index, tf)``."""
    v = bounded(vocab.select("term", "index"), max_features)
    return dtc.join(v, "term").select(key, "term", "index", "tf")


def count_vectorize(occ: DataFrame, vocab: DataFrame, max_features: int | None,
                    key: str = "row_id") -> DataFrame:
    """M2 long form: ``(row_id, term, index, tf)`` restricted to the vocabulary."""
    v = bounded(vocab.select("term", "index"), max_features)
    return (occ.join(v, "term").groupBy(key, "term", "index")
            .agg(F.count(F.lit(1)).alias("tf")))


def tfidf(counts: DataFrame, vocab_df: DataFrame, n_docs: DataFrame, max_features: int | None,
          key: str = "row_id", normalize: bool = True) -> DataFrame:
    """M3: ``tf * (ln((1+n)/(1+df)) + 1)``, then L2 norm per document (M4).

    ``vocab_df`` carries ``df`` counted on the training documents; ``n_docs``
    is a one-row frame with column ``n``, read once.
    """
    n = F.lit(n_docs.first()["n"])
    idf = vocab_df.select("term", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    w = counts.join(bounded(idf, max_features), "term").withColumn("tfidf", F.col("tf") * F.col("idf"))
    return l2_normalize(w, "tfidf", key) if normalize else w


def l2_normalize(df: DataFrame, value_col: str, key: str = "row_id") -> DataFrame:
    """M4: divide by the document's L2 norm (window per document: bounded by
    its number of distinct vocabulary terms)."""
    from pyspark.sql import Window
    norm = F.sqrt(F.sum(F.col(value_col) * F.col(value_col)).over(Window.partitionBy(key)))
    return df.withColumn(value_col, F.col(value_col) / F.nullif(norm, F.lit(0.0)))


def _class_sizes(labels: DataFrame, label_col: str) -> tuple[int, int]:
    """Documents of class 0 and 1: one row, read once."""
    row = labels.agg(F.count_if(F.col(label_col) == 0).alias("n0"), F.count_if(F.col(label_col) == 1).alias("n1")).first()
    return row.n0, row.n1


def chi2_scores(occ: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Chi-squared of each term against the class 0/1 (occurrences per class vs. the class
    share times the term total).  ``occ``: one row ``(term, label)`` an occurrence."""
    sizes = _class_sizes(labels, label_col)
    per = occ.groupBy("term").agg(*[F.count_if(F.col(label_col) == c).alias(f"o{c}") for c in (0, 1)])
    total, chi2 = F.col("o0") + F.col("o1"), F.lit(0.0)
    for c in (0, 1):
        if sizes[c]:  # a class without documents has no cell
            expected = F.lit(sizes[c] / sum(sizes)) * total
            chi2 = chi2 + (F.col(f"o{c}") - expected) * (F.col(f"o{c}") - expected) / expected
    return per.select("term", chi2.alias("chi2"))


def mutual_info_scores(presence: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Mutual information between term presence and the class 0/1 (nats).
    ``presence``: one row ``(term, label)`` for each document that holds the term."""
    n0, n1 = _class_sizes(labels, label_col)
    n = n0 + n1
    t = presence.groupBy("term").agg(F.count(F.lit(1)).alias("nt"), F.sum(label_col).alias("n11"))
    n11, nt = F.col("n11"), F.col("nt")
    n10, n01 = nt - n11, F.lit(n1) - n11
    n00 = F.lit(n) - nt - F.lit(n1) + n11

    def cell(nij, ni, nj):
        return F.when(nij > 0, nij / F.lit(n) * F.log(F.lit(n) * nij / (ni * nj))).otherwise(F.lit(0.0))
    return t.select("term", (cell(n11, nt, F.lit(n1)) + cell(n10, nt, F.lit(n0)) + cell(n01, F.lit(n) - nt, F.lit(n1))
                             + cell(n00, F.lit(n) - nt, F.lit(n0))).alias("mi"))
