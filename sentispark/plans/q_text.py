"""Registered queries: projections, filters and text functions (P*, T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions import text as T
from sentispark.functions.stopwords import ENGLISH_STOP_WORDS
from sentispark.operators import corpus as C
from sentispark.operators import filters as P
from sentispark.plans import sqltext as S
from sentispark.plans.catalog import register
from sentispark.session import cut_lineage
from sentispark.sources.tables import all_corpus, raw_corpus, table, text_table


def clean_nn(spark, sf):
    return C.clean_corpus(raw_corpus(spark, sf))


def clean_all(spark, sf):
    return C.clean_corpus(all_corpus(spark, sf))


def clean_all_once(spark, sf):
    return cut_lineage(clean_all(spark, sf))


def clean_nn_once(spark, sf):
    """The cleaned corpus written once to the checkpoint folder, for plans
    that read it in several branches (ranking samples its input, then
    shuffles it; class and row counts are further passes)."""
    return cut_lineage(clean_nn(spark, sf))


def _corpus_text_sql(expr: str, alias: str = "text") -> str:
    return S.with_(S.CORPUS) + f"SELECT row_id, {expr.format(t='text')} AS {alias} FROM corpus"


def _all_text_sql(expr: str, alias: str = "text") -> str:
    return S.with_(S.ALL_CORPUS) + f"SELECT row_id, {expr.format(t='text')} AS {alias} FROM corpus"


# ---- T9 / P7 --------------------------------------------------------------
@register("clean_text", S.BASE + "SELECT row_id, t AS text, target FROM clean", ops=("T9",))
def q_clean_text(spark, sf):
    return C.clean_corpus(raw_corpus(spark, sf), drop_empty=False)


@register("drop_empty", S.BASE + "SELECT row_id, text, target FROM clean_nn", ops=("P7",))
def q_drop_empty(spark, sf):
    return P.drop_empty(C.clean_corpus(raw_corpus(spark, sf), drop_empty=False))


_PAGES_HTML = S.with_(*S.staged("ph", "pages", "page_id", "html", S.strip_html_steps()))


@register("strip_html", _PAGES_HTML + "SELECT page_id, t AS text FROM ph", ops=("T1",))
def q_strip_html(spark, sf):
    return text_table(spark, sf, "pages").select("page_id", T.strip_html("html").alias("text"))


_PAGES_CLEAN = S.with_(*S.staged("pc", "pages", "page_id", "html", S.clean_steps()))


@register("clean_pages", _PAGES_CLEAN + "SELECT page_id, t AS text FROM pc", ops=("T1", "T9"))
def q_clean_pages(spark, sf):
    return text_table(spark, sf, "pages").select("page_id", T.clean_text("html").alias("text"))


# ---- T2..T8 individually ----------------------------------------------------
@register("strip_bom", _all_text_sql(S.strip_bom("(chr(65279) || {t} || ' ' || chr(65533) || ' end')")), ops=("T2",))
def q_strip_bom(spark, sf):
    return all_corpus(spark, sf).select("row_id", T.strip_bom(F.concat(F.lit("\ufeff"), "text", F.lit(" \ufffd end"))).alias("text"))


_CONV_T3 = ("SELECT conv_id, turn, " + S.strip_mentions_urls("(text || ' @user_' || conv_id || ' see http://t.co/' || turn || ' end')") + " AS text FROM conversations")


@register("strip_mentions_urls", _CONV_T3, ops=("T3",))
def q_strip_mentions_urls(spark, sf):
    return (text_table(spark, sf, "conversations")
            .select("conv_id", "turn", T.strip_mentions_urls(F.concat(
                "text", F.lit(" @user_"), "conv_id", F.lit(" see http://t.co/"), "turn", F.lit(" end"))).alias("text")))


@register("strip_www", "SELECT page_id, " + S.strip_www("url") + " AS url_rest FROM pages",
          ops=("T4",))
def q_strip_www(spark, sf):
    return text_table(spark, sf, "pages").select("page_id", T.strip_www("url").alias("url_rest"))


@register("lowercase", _all_text_sql("lower({t})"), ops=("T5",))
def q_lowercase(spark, sf):
    return all_corpus(spark, sf).select("row_id", T.lowercase("text").alias("text"))


@register("expand_negations", _all_text_sql(S.expand_negations("(lower({t}) || ' isn''t can''t won''t shouldn''t')")), ops=("T6",))
def q_expand_negations(spark, sf):
    return all_corpus(spark, sf).select("row_id", T.expand_negations(
        F.concat(F.lower("text"), F.lit(" isn't can't won't shouldn't"))).alias("text"))


@register("letters_only", _all_text_sql(S.letters_only("{t}")), ops=("T7",))
def q_letters_only(spark, sf):
    return all_corpus(spark, sf).select("row_id", T.letters_only("text").alias("text"))


@register("tokenize_min2", _all_text_sql(S.tokenize_min2(S.letters_only("lower({t})"))),
          ops=("T8",))
def q_tokenize_min2(spark, sf):
    return all_corpus(spark, sf).select(
        "row_id", T.tokenize_min2(T.letters_only(F.lower("text"))).alias("text"))


# ---- T10..T19 -----------------------------------------------------------------
@register("whitespace_tokens",
          S.ALL_BASE + "SELECT row_id, CAST(len(w) AS INTEGER) AS n_tokens, array_to_string(w, '|') AS tokens "
          f"FROM (SELECT row_id, {S.whitespace_tokens('text')} AS w FROM clean_nn)",
          ops=("T10",))
def q_whitespace_tokens(spark, sf):
    w = T.whitespace_tokens("text")
    return clean_all(spark, sf).select("row_id", F.size(w).alias("n_tokens"),
                                      F.array_join(w, "|").alias("tokens"))


@register("normalize_review",
          _all_text_sql(S.normalize_review("replace({t}, chr(133), ' ')")), ops=("T12", "T13"))
def q_normalize_review(spark, sf):
    return all_corpus(spark, sf).select(
        "row_id", T.normalize_review(T.replace_control("text")).alias("text"))


@register("replace_control", "SELECT item_id, replace(replace(text, '. ', '.' || chr(133)), chr(133), ' ') AS text FROM benchmark",
          ops=("T13",))
def q_replace_control(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", T.replace_control(
        F.replace("text", F.lit(". "), F.lit(".\x85"))).alias("text"))


@register("path_to_name",
          "SELECT DISTINCT lang || '/' || source AS folder, "
          "replace(lang || '/' || source, '/', '-') || '.txt' AS file_name FROM documents",
          ops=("T14",))
def q_path_to_name(spark, sf):
    folder = F.concat_ws("/", "lang", "source")
    return (table(spark, sf, "documents").select(folder.alias("folder")).distinct()
            .select("folder", T.path_to_name("folder").alias("file_name")))


@register("word_count",
          S.ALL_BASE + f"SELECT row_id, CAST(len({S.whitespace_tokens('text')}) AS INTEGER) AS n_words FROM clean_nn",
          ops=("T15",))
def q_word_count(spark, sf):
    return clean_all(spark, sf).select("row_id", T.word_count("text").alias("n_words"))


@register("remove_stop_words",
          S.ALL_BASE + "SELECT row_id, array_to_string(list_filter(string_split(text, ' '), "
          f"lambda w: NOT list_contains([{', '.join(S.q(w) for w in ENGLISH_STOP_WORDS)}], w)), ' ') AS text "
          "FROM clean_nn",
          ops=("T16",))
def q_remove_stop_words(spark, sf):
    from sentispark.operators.terms import remove_stop_words
    return clean_all(spark, sf).select(
        "row_id", F.array_join(remove_stop_words(F.split("text", " ")), " ").alias("text"))


@register("vectorizer_tokens",
          S.ALL_BASE + "SELECT row_id, CAST(len(regexp_extract_all(lower(text), '\\b\\w\\w+\\b')) AS INTEGER) "
          "AS n_tokens FROM clean_nn",
          ops=("T18",))
def q_vectorizer_tokens(spark, sf):
    return clean_all(spark, sf).select("row_id", F.size(T.vectorizer_tokens("text")).alias("n_tokens"))


@register("tag_document",
          S.ALL_BASE + "SELECT 'all_' || CAST(row_id AS VARCHAR) AS tag, text AS words FROM clean_nn",
          ops=("T19",))
def q_tag_document(spark, sf):
    d = clean_all(spark, sf).select(T.tag_document(F.split("text", " "), "row_id").alias("doc"))
    return d.select(F.col("doc.tag").alias("tag"), F.array_join("doc.words", " ").alias("words"))


# ---- P1..P18 -----------------------------------------------------------------------
@register("drop_columns", S.with_(S.CORPUS) + "SELECT row_id, target AS sentiment, text FROM corpus",
          ops=("P1",))
def q_drop_columns(spark, sf):
    return P.drop_columns(raw_corpus(spark, sf).withColumnRenamed("target", "sentiment"),
                          ["row_id", "sentiment", "text"])


@register("text_length",
          S.with_(S.ALL_CORPUS) + "SELECT row_id, CAST(length(text) AS BIGINT) AS pre_clean_len FROM corpus",
          ops=("P2",))
def q_text_length(spark, sf):
    return P.text_length(all_corpus(spark, sf)).select("row_id", "pre_clean_len")


@register("long_texts",
          S.with_(S.ALL_CORPUS) + "SELECT row_id, CAST(length(text) AS BIGINT) AS pre_clean_len FROM corpus "
          "WHERE length(text) > 140",
          ops=("P3",))
def q_long_texts(spark, sf):
    return P.long_texts(P.text_length(all_corpus(spark, sf)).select("row_id", "pre_clean_len"))


@register("class_filter", S.BASE + "SELECT row_id, text FROM clean_nn WHERE target = 0", ops=("P4",))
def q_class_filter(spark, sf):
    return P.class_filter(clean_nn(spark, sf), 0).select("row_id", "text")


# every seventh turn is a mention, which cleans to nothing: the check has rows to find
_CONV = ("conv AS (SELECT conv_id, turn, role, CASE WHEN (conv_id + turn) % 7 = 0 THEN '@someone' ELSE text END AS text "
         "FROM conversations)")
_CONV_CLEAN = [_CONV, *S.staged("cc", "conv", "conv_id, turn, role", "text", S.clean_steps())]


def _cleaned_turns(spark, sf):
    """Turns with their cleaned text, null where nothing is left (the CSV round trip made nulls of those)."""
    conv = text_table(spark, sf, "conversations")
    text = F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, "@someone").otherwise(F.col("text"))
    cleaned = conv.select("conv_id", "turn", "role", T.clean_text(text).alias("text"))
    return cleaned.withColumn("text", F.when(T.is_empty_text("text"), None).otherwise(F.col("text")))


@register("null_rows",
          S.with_(*_CONV_CLEAN) + "SELECT conv_id, turn, role FROM cc WHERE NOT " + S.not_empty("t"),
          ops=("P5",))
def q_null_rows(spark, sf):
    return P.null_rows(_cleaned_turns(spark, sf), ["text"]).select("conv_id", "turn", "role")


@register("null_row_count",
          S.with_(*_CONV_CLEAN) + "SELECT CAST(count(*) FILTER (WHERE NOT " + S.not_empty("t")
          + ") AS BIGINT) AS null_rows FROM cc",
          ops=("P6",))
def q_null_row_count(spark, sf):
    return P.null_row_count(_cleaned_turns(spark, sf), ["text"])


@register("rename_columns",
          S.with_(S.CORPUS) + "SELECT row_id AS doc_index, text AS tweet, target AS sentiment FROM corpus",
          ops=("P8",))
def q_rename_columns(spark, sf):
    return P.rename_columns(raw_corpus(spark, sf),
                            {"row_id": "doc_index", "text": "tweet", "target": "sentiment"})


@register("data_dictionary",
          S.with_(S.CORPUS) + """
SELECT column_name, data_type, description, non_null, position, n_rows, n_columns FROM (
  SELECT 'sentiment' AS column_name, 'int' AS data_type, 'sentiment class - 0: negative, 1: positive' AS description,
         CAST(count(target) AS BIGINT) AS non_null, 0 AS position, CAST(count(*) AS BIGINT) AS n_rows, 3 AS n_columns FROM corpus
  UNION ALL
  SELECT 'text', 'string', 'text', CAST(count(text) AS BIGINT), 1, CAST(count(*) AS BIGINT), 3 FROM corpus
  UNION ALL
  SELECT 'pre_clean_len', 'bigint', 'Length of the text before cleaning', CAST(count(length(text)) AS BIGINT), 2,
         CAST(count(*) AS BIGINT), 3 FROM corpus)""",
          ops=("P11", "A18"))
def q_data_dictionary(spark, sf):
    df = P.text_length(raw_corpus(spark, sf)).select(
        F.col("target").alias("sentiment"), "text", "pre_clean_len")
    return P.data_dictionary(df, {"sentiment": "sentiment class - 0: negative, 1: positive",
                                  "text": "text",
                                  "pre_clean_len": "Length of the text before cleaning"})


@register("range_partition_rows",
          S.with_(S.ALL_CORPUS) + """
SELECT CAST(chunk AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n_rows,
       min(row_id) AS first_row, max(row_id) AS last_row FROM (
  SELECT row_id, floor((row_number() OVER (ORDER BY row_id) - 1) / ceil(count(*) OVER () / 4)) AS chunk
  FROM corpus) GROUP BY chunk""",
          ops=("P12", "W4"))
def q_range_partition_rows(spark, sf):
    chunks = P.range_partition_rows(all_corpus(spark, sf).select("row_id"), "row_id", 4)
    return chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.min("row_id").alias("first_row"),
                                       F.max("row_id").alias("last_row"))


def _head_sql(frac: float) -> str:
    return S.BASE + f"""
SELECT row_id, target FROM (
  SELECT row_id, target, row_number() OVER (PARTITION BY target ORDER BY row_id) AS rk,
         count(*) OVER () AS n FROM clean_nn)
WHERE rk <= floor(n * {frac})"""


@register("class_head_sample", _head_sql(0.1), ops=("P13",))
def q_class_head_sample(spark, sf):
    return P.class_head_sample(clean_nn_once(spark, sf), 0.1).select("row_id", "target")


@register("minibatch_assign",
          S.ALL_BASE + "SELECT row_id, CAST(floor((row_number() OVER (ORDER BY row_id) - 1) / 32) AS BIGINT) "
          "AS batch_id FROM clean_nn",
          ops=("P14",))
def q_minibatch_assign(spark, sf):
    return P.minibatch_assign(clean_all_once(spark, sf).select("row_id"), 32)


@register("block_label", """
SELECT doc_id, CASE floor(line_no / blk) WHEN 0 THEN 'train' WHEN 1 THEN 'test' WHEN 2 THEN 'extra'
                 WHEN 3 THEN 'extra' END AS split,
       CASE WHEN floor(line_no / (blk / 2)) IN (0, 2) THEN 1.0
            WHEN floor(line_no / (blk / 2)) IN (1, 3) THEN 0.0 END AS sentiment
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line_no,
             CAST(ceil(count(*) OVER () / 4) AS BIGINT) AS blk FROM documents)""",
          ops=("P15", "A16"))
def q_block_label(spark, sf):
    # the review layout: four equal position blocks (train, test, extra, extra),
    # each half positive then half negative; block size = ceil(N / 4)
    from sentispark.operators.ranking import global_row_number
    docs = table(spark, sf, "documents").select("doc_id")
    n = docs.agg(F.ceil(F.count(F.lit(1)) / 4).cast("bigint").alias("blk"))
    ranked = global_row_number(docs, [F.col("doc_id")], "rn").crossJoin(F.broadcast(n))
    split, sentiment = P.block_label(F.col("rn") - 1, F.col("blk"))
    return ranked.select("doc_id", split.alias("split"), sentiment.alias("sentiment"))


@register("preview", S.BASE + "SELECT row_id, text, target FROM clean_nn ORDER BY row_id LIMIT 5",
          ops=("P17",))
def q_preview(spark, sf):
    return P.preview(clean_nn(spark, sf), 5)


@register("normalize_label",
          S.with_(S.CORPUS) + f"SELECT row_id, target, {S.label01()} AS label FROM corpus",
          ops=("P18",))
def q_normalize_label(spark, sf):
    return raw_corpus(spark, sf).select("row_id", "target", P.normalize_label("target").alias("label"))
