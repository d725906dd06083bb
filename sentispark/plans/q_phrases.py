"""Registered queries: phrase mining (W1-W3), similarity and sampling on vectors
(E9-E11, E13, K6-K9, J4, J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.operators import corpus as C
from sentispark.operators import features as FE
from sentispark.operators import phrases as PH
from sentispark.operators import sequences as SQ
from sentispark.operators import similarity as SIM
from sentispark.plans.catalog import register
from sentispark.plans.q_features import WITH_SPLIT, split_corpus
from sentispark.plans import sqltext as S
from sentispark.session import cut_lineage, write_once
from sentispark.sources.tables import all_corpus, table


# ---- W1 / W2 / W3 ---------------------------------------------------------------------------
def phrase_ctes(p: str, src: str) -> str:
    return f"""
{p}tok AS (SELECT row_id, split, pos, t[pos + 1] AS term, t[pos + 2] AS nxt
           FROM (SELECT row_id, split, t, unnest(range(len(t))) AS pos FROM {src})),
{p}uni AS (SELECT term, count(*) AS c FROM {p}tok WHERE split = 'train' GROUP BY term),
{p}bi AS (SELECT term AS a, nxt AS b, count(*) AS cnt FROM {p}tok WHERE split = 'train' AND nxt IS NOT NULL
          GROUP BY term, nxt),
{p}v AS (SELECT (SELECT count(*) FROM {p}uni) + (SELECT count(*) FROM {p}bi) AS V),
{p}ph AS (SELECT a, b, a || '_' || b AS phrase, cnt, score FROM (
            SELECT a, b, cnt, (cnt - 5) / ua.c / ub.c * V AS score FROM {p}bi
            JOIN {p}uni ua ON ua.term = a JOIN {p}uni ub ON ub.term = b, {p}v WHERE cnt > 5) WHERE score > 10),
{p}fl AS (SELECT k.*, CASE WHEN ph.a IS NULL THEN 0 ELSE 1 END AS f FROM {p}tok k
          LEFT JOIN {p}ph ph ON ph.a = k.term AND ph.b = k.nxt),
{p}w1 AS (SELECT *, coalesce(max(CASE WHEN f = 0 THEN pos END) OVER (PARTITION BY row_id ORDER BY pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS lz FROM {p}fl),
{p}w2 AS (SELECT *, (f = 1 AND (pos - lz - 1) % 2 = 0) AS taken FROM {p}w1),
{p}w3 AS (SELECT *, coalesce(lag(taken) OVER (PARTITION BY row_id ORDER BY pos), false) AS absorbed FROM {p}w2),
{p}out AS (SELECT row_id, any_value(split) AS split,
           list(CASE WHEN taken THEN term || '_' || nxt ELSE term END ORDER BY pos) FILTER (WHERE NOT absorbed) AS t
           FROM {p}w3 GROUP BY row_id)"""


PH_SQL = (WITH_SPLIT.rstrip("\n") + ",\nsrc AS (SELECT row_id, split, string_split(text, ' ') AS t FROM sp),"
          + phrase_ctes("b_", "src") + "\n")
PH2_SQL = PH_SQL.rstrip("\n") + "," + phrase_ctes("t_", "b_out") + "\n"


def bigram_pass(spark, sf):
    sp = split_corpus(spark, sf).select("row_id", "split", F.split("text", " ").alias("tokens"))
    return PH.learn_and_apply(sp, F.col("split") == "train", extra=("split",))


@register("phrase_candidates", PH_SQL + "SELECT a, b, phrase, CAST(cnt AS BIGINT) AS cnt, score FROM b_ph",
          ops=("W1",))
def q_phrase_candidates(spark, sf):
    return bigram_pass(spark, sf)[1]


@register("apply_phrases", PH_SQL + "SELECT row_id, array_to_string(t, ' ') AS text FROM b_out", ops=("W2",))
def q_apply_phrases(spark, sf):
    out, _ = bigram_pass(spark, sf)
    return out.select("row_id", F.array_join("tokens", " ").alias("text"))


@register("trigram_phrases", PH2_SQL + "SELECT row_id, array_to_string(t, ' ') AS text FROM t_out", ops=("W3",))
def q_trigram_phrases(spark, sf):
    out, _ = bigram_pass(spark, sf)
    out2, _ = PH.learn_and_apply(out, F.col("split") == "train", extra=("split",))
    return out2.select("row_id", F.array_join("tokens", " ").alias("text"))


# ---- E9 / E10 / K6 / K7 / K8 / K9 ------------------------------------------------------------------
def _cos_sql(a: str, b: str) -> str:
    d = f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)))"
    na = f"sqrt(list_sum(list_transform({a}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
    nb = f"sqrt(list_sum(list_transform({b}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
    return f"{d} / nullif({na} * {nb}, 0)"


def _pick_sql(seed: int) -> str:
    return (f"q AS (SELECT vec_id AS q_key, embedding AS q_vec FROM embeddings "
            f"ORDER BY md5('{seed}-' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 1)")


@register("most_similar_words", f"WITH {_pick_sql(42)}\n" + f"""
SELECT q_key, vec_id, round({_cos_sql('embedding', 'q_vec')}, 9) AS similarity FROM embeddings, q
WHERE vec_id <> q_key ORDER BY similarity DESC, vec_id LIMIT 10""", ops=("E9",))
def q_most_similar_words(spark, sf):
    emb = table(spark, sf, "embeddings")
    return SIM.most_similar(emb, SIM.seeded_pick(emb, "vec_id", 42), "vec_id", "embedding", 10)


@register("most_similar_docs", f"WITH {_pick_sql(7)}\n" + f"""
SELECT q_key, vec_id, round({_cos_sql('embedding', 'q_vec')}, 9) AS similarity FROM embeddings, q
ORDER BY similarity DESC, vec_id LIMIT 3""", ops=("E10",))
def q_most_similar_docs(spark, sf):
    emb = table(spark, sf, "embeddings")
    return SIM.most_similar(emb, SIM.seeded_pick(emb, "vec_id", 7), "vec_id", "embedding", 3, exclude_self=False)


@register("most_similar_docs_many", f"""
SELECT q_key, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY q_key ORDER BY similarity DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS q_key, e.vec_id, round({_cos_sql('e.embedding', 'q.embedding')}, 9) AS similarity
    FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0))
WHERE rank <= 3""", ops=("E10",))
def q_most_similar_docs_many(spark, sf):
    """The three nearest of all vectors to every vector whose id is divisible by 20."""
    emb = table(spark, sf, "embeddings")
    return SIM.most_similar_many(emb, emb.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", 3)


@register("doc_neighbours", ops=("E10", "E1"))
def q_doc_neighbours(spark, sf):
    """The three documents nearest to every held-out document by DBOW paragraph vectors."""
    from sentispark.plans.q_evaluate import heldout
    from sentispark.plans.q_models import _embed
    vecs = cut_lineage(_embed(spark, sf, "dbow")[0])
    held = vecs.join(heldout(split_corpus(spark, sf)).select(F.col("row_id").alias("key")), "key", "left_semi")
    return SIM.most_similar_many(vecs, held, "key", "vec", 3).withColumnsRenamed({"q_key": "row_id", "key": "similar"})


@register("most_median_least", f"WITH {_pick_sql(11)},\n" + f"""
r AS (SELECT q_key, vec_id, similarity, row_number() OVER (ORDER BY similarity DESC, vec_id) - 1 AS rank FROM (
      SELECT q_key, vec_id, round({_cos_sql('embedding', 'q_vec')}, 9) AS similarity FROM embeddings, q
      WHERE vec_id <> q_key)),
n AS (SELECT count(*) AS n FROM r),
p AS (SELECT 'MOST' AS label, 0 AS rank UNION ALL SELECT 'MEDIAN', (SELECT n // 2 FROM n)
      UNION ALL SELECT 'LEAST', (SELECT n - 1 FROM n))
SELECT p.label, CAST(p.rank AS BIGINT) AS rank, q_key, vec_id, similarity FROM p JOIN r ON r.rank = p.rank""",
          ops=("K6", "E10"))
def q_most_median_least(spark, sf):
    emb = table(spark, sf, "embeddings")
    ranking = SIM.similarity_ranking(emb, SIM.seeded_pick(emb, "vec_id", 11), "vec_id", "embedding")
    return SIM.most_median_least(ranking).select("label", "rank", "q_key", "vec_id", "similarity")


_TOK = WITH_SPLIT.rstrip("\n") + ",\ntokens AS (SELECT row_id, unnest(string_split(text, ' ')) AS term FROM sp)\n"


@register("random_pick", _TOK + """
SELECT 'doc' AS kind, CAST(row_id AS VARCHAR) AS value FROM (
  SELECT row_id FROM sp ORDER BY md5('5-' || CAST(row_id AS VARCHAR)), row_id LIMIT 1)
UNION ALL
SELECT 'word', term FROM (SELECT term FROM tokens GROUP BY term HAVING count(*) > 10
                          ORDER BY md5('5-' || term), term LIMIT 1)""", ops=("K7",))
def q_random_pick(spark, sf):
    sp = split_corpus(spark, sf)
    doc = SIM.seeded_pick(sp, "row_id", 5).select(F.lit("doc").alias("kind"),
                                                  F.col("row_id").cast("string").alias("value"))
    words = C.explode_tokens(sp, keep=()).groupBy("term").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 10")
    word = SIM.seeded_pick(words, "term", 5).select(F.lit("word").alias("kind"), F.col("term").alias("value"))
    return doc.unionByName(word)


@register("seeded_shuffle", WITH_SPLIT + """
SELECT row_id, CAST(epoch AS INTEGER) AS epoch,
       row_number() OVER (PARTITION BY epoch ORDER BY md5('2000-' || CAST(epoch AS VARCHAR) || '-' || CAST(row_id AS VARCHAR)), row_id) - 1 AS position
FROM sp, range(3) e(epoch)""", ops=("K8",))
def q_seeded_shuffle(spark, sf):
    return SIM.seeded_shuffle(split_corpus(spark, sf), "row_id", 2000, 3)


@register("subsample", WITH_SPLIT + """
SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY md5('3-' || CAST(row_id AS VARCHAR)), row_id) AS r,
                    count(*) OVER () AS n FROM sp) WHERE r <= floor(n * 0.2)""", ops=("K9",))
def q_subsample(spark, sf):
    return SIM.subsample(split_corpus(spark, sf).select("row_id"), "row_id", 0.2, 3)


@register("vocab_min_count", S.ALL_TOKENS + "SELECT term, CAST(count(*) AS BIGINT) AS cnt FROM tokens GROUP BY term "
          "HAVING count(*) >= 2", ops=("E11",))
def q_vocab_min_count(spark, sf):
    return SIM.vocab_min_count(C.explode_tokens(C.clean_corpus(all_corpus(spark, sf)), keep=()), 2)


# ---- E13 / J4 / J5 ----------------------------------------------------------------------------------------------
_WV = _TOK.rstrip("\n") + """,
widx AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term) AS id FROM (
         SELECT term, count(*) AS cnt FROM tokens GROUP BY term)),
wv AS (SELECT term, embedding AS vec FROM widx JOIN embeddings ON embeddings.vec_id = widx.id),
adv AS (SELECT row_id, CAST(d - 1 AS INTEGER) AS dim, avg(CAST(vec[d] AS DOUBLE)) AS value
        FROM (SELECT row_id, vec, unnest(range(1, len(vec) + 1)) AS d FROM tokens JOIN wv USING (term))
        GROUP BY row_id, d)
"""


def word_vectors(spark, sf):
    """``(split corpus, word counts of its documents, word vectors)``: the ``embeddings`` rows
    assigned to terms by frequency index (id = vec_id), which is their rank."""
    sp = split_corpus(spark, sf)
    counts = write_once(FE.doc_counts(sp, keep=("row_id", "split")), "word-counts")
    idx = SQ.frequency_index(counts.select("term", "tf"), times="tf")
    emb = table(spark, sf, "embeddings")
    wv = idx.join(emb, idx["id"] == emb["vec_id"]).select("term", F.col("embedding").alias("vec"), F.col("id").alias("rank"))
    return sp, counts, write_once(wv, "word-vectors")


@register("avg_doc_vector", _WV + "SELECT row_id, dim, value FROM adv", ops=("E13",))
def q_avg_doc_vector(spark, sf):
    _, counts, wv = word_vectors(spark, sf)
    return SIM.avg_doc_vectors(counts, wv, 64)


@register("doc_vector_lookup", WITH_SPLIT + """
SELECT sp.row_id, split, CAST(len(embedding) AS INTEGER) AS dim,
       sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm
FROM sp JOIN embeddings e ON e.vec_id = sp.row_id""", ops=("J4",))
def q_doc_vector_lookup(spark, sf):
    sp = split_corpus(spark, sf)
    emb = table(spark, sf, "embeddings")
    j = sp.join(emb, sp["row_id"] == emb["vec_id"])
    return j.select("row_id", "split", F.size("embedding").alias("dim"), SIM.norm(F.col("embedding")).alias("norm"))


@register("concat_vectors", _WV.rstrip("\n") + """,
av AS (SELECT row_id, list(value ORDER BY dim) AS vec FROM adv GROUP BY row_id)
SELECT row_id, CAST(len(vec) + len(embedding) AS INTEGER) AS dim,
       sqrt(list_sum(list_transform(list_concat(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), vec),
                                    lambda x: x * x))) AS norm
FROM av JOIN embeddings e ON e.vec_id = av.row_id""", ops=("J5", "E4"))
def q_concat_vectors(spark, sf):
    _, counts, wv = word_vectors(spark, sf)
    av = SIM.avg_doc_arrays(counts, wv, 64)
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"),
                                                 F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    cv = SIM.concat_vectors(emb, av, "row_id")
    return cv.select("row_id", F.size("vec").alias("dim"), SIM.norm(F.col("vec")).alias("norm"))
