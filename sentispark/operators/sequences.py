"""Word index, integer sequences and padding (W7-W9), embedding lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.operators.ranking import global_row_number


def frequency_index(tokens: DataFrame, term_col: str = "term", times: str | None = None) -> DataFrame:
    """``(term, id, cnt)``, id 1.. by descending count then term; a row counts once, or
    ``times`` (a column) where it stands for several.
    Ranked with the distributed ranker (the vocabulary can be large)."""
    counts = tokens.groupBy(term_col).agg((F.sum(times) if times else F.count(F.lit(1))).alias("cnt"))
    return global_row_number(counts, [F.col("cnt").desc(), F.col(term_col)], "id")


def texts_to_sequences(docs: DataFrame, index: DataFrame, num_words: int | None = None,
                       key: str = "row_id", text_col: str = "text") -> DataFrame:
    """Words -> ids in text order; unknown words and ids >= num_words drop.

    The index is cut to ids < num_words first; Catalyst chooses the join by its size.
    """
    idx = index.select(F.col("term"), F.col("id"))
    if num_words is not None:
        idx = idx.where(F.col("id") < num_words)
    occ = docs.select(key, F.posexplode(F.split(F.col(text_col), " ")).alias("pos", "term"))
    hits = occ.join(idx, "term")
    seqs = (hits.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("__p"))
            .select(key, F.transform("__p", lambda s: s["id"].cast("int")).alias("seq")))
    # documents without any known word keep an empty sequence
    return (docs.select(key).join(seqs, key, "left")
            .select(key, F.coalesce("seq", F.array().cast("array<int>")).alias("seq")))


def pad_sequences(seq: Column, maxlen: int) -> Column:
    """Zeros in front, cut from the front (keep the last ``maxlen``)."""
    n = F.size(seq)
    return (F.when(n >= maxlen, F.slice(seq, n - maxlen + 1, maxlen))
            .otherwise(F.concat(F.array_repeat(F.lit(0), F.lit(maxlen) - n), seq)))


def embedding_lookup(index: DataFrame, vectors: DataFrame, dim: int, num_words: int,
                     vec_key: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, term, vec)`` for ids < num_words; zero vector if missing."""
    idx = index.where(F.col("id") < num_words).select("id", "term")
    v = vectors.select(F.col(vec_key).alias("id"), F.col(vec_col).alias("vec"))
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return idx.join(v, "id", "left").select("id", "term", F.coalesce("vec", zero).alias("vec"))
