"""Vector similarity, deterministic picks and shuffles.

Many queries are answered in blocks (:func:`most_similar_many`).  Otherwise:

A query is one vector (or a handful): it is broadcast against the table and
the top-k is a TakeOrderedAndProject, so no pair table is ever formed.  Full
rankings use the distributed ranker.  Random choices are replaced by an md5
order under a seed, so they repeat on any partitioning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentispark.operators.ranking import global_row_number
from sentispark.session import cut_lineage

#: Word vectors that travel to the tasks: 34 MB at 64 32-bit entries.
NEAR = 131_072


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def seeded_pick(df: DataFrame, key: str, seed: int | str, n: int = 1) -> DataFrame:
    """K7: ``n`` rows in md5(seed || key) order (a seeded random choice)."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))), F.col(key)).limit(n)


def most_similar(table: DataFrame, query: DataFrame, key: str, vec: str, k: int = 10,
                 exclude_self: bool = True, digits: int = 9) -> DataFrame:
    """Top-k rows of ``table`` by cosine to the (one-row) ``query``
    ``(q_key, q_vec)``; ties by key.  The query row is broadcast."""
    q = query.select(F.col(key).alias("q_key"), F.col(vec).alias("q_vec"))
    scored = (table.crossJoin(F.broadcast(q))
              .withColumn("similarity", F.round(cosine(F.col(vec), F.col("q_vec")), digits)))
    if exclude_self:
        scored = scored.where(F.col(key) != F.col("q_key"))
    return (scored.orderBy(F.col("similarity").desc(), F.col(key)).limit(k)
            .select("q_key", key, "similarity"))


def _nearest_in_blocks(ids: np.ndarray, units: np.ndarray, k: int, exclude_self: bool, digits: int):
    """``mapInPandas`` function: for every query of one block the ``k`` nearest of a task's rows."""
    def best(query: np.ndarray, key: np.ndarray, sim: np.ndarray):
        order = np.lexsort((key, -sim, query))
        query, key, sim = query[order], key[order], sim[order]
        start = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
        return query[place < k], key[place < k], sim[place < k]

    def run(batches):
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for b in batches:
            if not len(b):
                continue
            vec = np.array(b["vec"].tolist(), float)
            size = np.sqrt((vec * vec).sum(axis=1))
            some = size > 0
            key, vec = b["key"].to_numpy()[some], vec[some] / size[some, None]
            for at in range(0, len(key), 1024):  # rows x queries held at once
                sim = np.round(vec[at:at + 1024] @ units.T, digits)
                if exclude_self:
                    sim[key[at:at + 1024, None] == ids[None, :]] = -np.inf
                depth = min(k, len(sim))
                # every row that reaches a query's k-th similarity, ties included
                last = np.partition(sim, len(sim) - depth, axis=0)[len(sim) - depth]
                row, query = np.nonzero((sim >= last) & (sim > -np.inf))
                new = (query, key[at + row], sim[row, query])
                held = best(*(np.concatenate(p) for p in zip(held, new)))
        yield pd.DataFrame({"q_key": ids[held[0]], "key": held[1], "similarity": held[2]})
    return run


def most_similar_many(table: DataFrame, queries: DataFrame, key: str, vec: str, k: int = 3, exclude_self: bool = True,
                      digits: int = 9, block: int = 4096) -> DataFrame:
    """E10 for many queries: ``q_key, key, similarity, rank`` (1 to ``k``) of the nearest rows of
    ``table`` to every row of ``queries``, ties by key.  Both have a long key and vectors of
    one length; null and zero vectors have no neighbours.

    Queries are dealt to blocks of about ``block``; a block goes to the tasks as one matrix of that
    bounded size and meets the rows in matrix products, of which a task keeps ``k`` a query.
    Then at most ``k`` rows a query and task are ranked by query."""
    spark, has = table.sparkSession, F.col(vec).isNotNull()
    rows = cut_lineage(table.where(has).select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec")))
    asked = queries.where(has).select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec"))
    blocks = max(1, -(-asked.count() // block))
    asked = cut_lineage(asked.withColumn("of", F.pmod(F.xxhash64("key"), F.lit(blocks))))
    out = spark.createDataFrame([], "q_key long, key long, similarity double")
    for number in range(blocks):
        part = asked.where(F.col("of") == number).toPandas()
        if not len(part):
            continue
        matrix = np.array(part["vec"].tolist(), float).reshape(len(part), -1)
        size = np.sqrt((matrix * matrix).sum(axis=1))
        some = size > 0
        if some.any():
            units = matrix[some] / size[some, None]
            out = out.unionByName(cut_lineage(rows.mapInPandas(
                _nearest_in_blocks(part["key"].to_numpy()[some], units, k, exclude_self, digits),
                "q_key long, key long, similarity double")))
    place = F.row_number().over(Window.partitionBy("q_key").orderBy(F.col("similarity").desc(), "key"))
    return out.withColumn("rank", place).where(F.col("rank") <= k).withColumnRenamed("key", key)


def similarity_ranking(table: DataFrame, query: DataFrame, key: str, vec: str, digits: int = 9) -> DataFrame:
    """Full ranking (0-based) of every row by cosine to the query row."""
    q = query.select(F.col(key).alias("q_key"), F.col(vec).alias("q_vec"))
    scored = (table.crossJoin(F.broadcast(q)).where(F.col(key) != F.col("q_key"))
              .select("q_key", key, F.round(cosine(F.col(vec), F.col("q_vec")), digits).alias("similarity")))
    ranked = global_row_number(scored, [F.col("similarity").desc(), F.col(key)], "rank")
    return ranked.withColumn("rank", F.col("rank") - 1)


def most_median_least(ranking: DataFrame) -> DataFrame:
    """K6: ranks 0, n//2 and n-1 of a ranking."""
    n = ranking.agg(F.count(F.lit(1)).alias("n"))
    picks = n.select(F.explode(F.array(
        F.struct(F.lit("MOST").alias("label"), F.lit(0).cast("bigint").alias("rank")),
        F.struct(F.lit("MEDIAN").alias("label"), F.floor(F.col("n") / 2).cast("bigint").alias("rank")),
        F.struct(F.lit("LEAST").alias("label"), (F.col("n") - 1).cast("bigint").alias("rank")))).alias("p"))
    return picks.select("p.*").join(ranking, "rank")


def seeded_shuffle(df: DataFrame, key: str, seed: int, epochs: int) -> DataFrame:
    """K8: the position of every row in each epoch's seeded shuffle."""
    ep = df.sparkSession.range(epochs).select(F.col("id").cast("int").alias("epoch"))
    keyed = df.select(key).crossJoin(F.broadcast(ep)).withColumn(
        "__h", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(key).cast("string"))))
    ranked = global_row_number(keyed, [F.col("epoch"), F.col("__h"), F.col(key)], "__g")
    sizes = df.agg(F.count(F.lit(1)).alias("__n"))
    return (ranked.crossJoin(F.broadcast(sizes))
            .select(key, "epoch", (F.col("__g") - 1 - F.col("epoch") * F.col("__n")).alias("position")))


def subsample(df: DataFrame, key: str, frac: float, seed: int) -> DataFrame:
    """K9: exactly ``int(frac * n)`` rows chosen by the seeded md5 order."""
    h = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    ranked = global_row_number(df.withColumn("__h", h), [F.col("__h"), F.col(key)], "__r")
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    return (ranked.crossJoin(F.broadcast(n)).where(F.col("__r") <= F.floor(F.col("__n") * frac))
            .drop("__h", "__r", "__n"))


def vocab_min_count(tokens: DataFrame, min_count: int = 2) -> DataFrame:
    """Terms seen at least ``min_count`` times."""
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= min_count)


def avg_doc_arrays(counts: DataFrame, word_vectors: DataFrame, dim: int, keep: tuple[str, ...] = ("row_id",),
                   near: int = NEAR) -> DataFrame:
    """``(keep..., vec)``, the mean of the word vectors of a document's words; words without a
    vector are skipped, documents without a word that has one are left out.

    ``counts``: ``(keep..., term, tf)``, a document's rows beside each other; ``word_vectors``:
    ``(term, vec)`` of at most ``dim`` entries.  Where these have a column ``rank`` (1 the commonest
    word), the first ``near`` are sent to the tasks, so most words are summed where the
    document lies; the others meet their vectors in a join by term."""
    vec = F.when(F.size("vec") > dim, F.raise_error(F.lit(f"a word vector has more than {dim} entries"))).otherwise(F.col("vec"))
    known = word_vectors.where(F.size("vec") > 0).withColumn("vec", vec)
    entry = [F.get("vec", F.lit(d)).cast("double") for d in range(dim)]

    def summed(hits: DataFrame) -> DataFrame:
        return hits.groupBy(*keep).agg(
            F.max(F.size("vec")).alias("__size"), *[F.sum(F.col("tf") * x).alias(f"__s{d}") for d, x in enumerate(entry)],
            *[F.sum(F.when(x.isNotNull(), F.col("tf"))).alias(f"__n{d}") for d, x in enumerate(entry)])

    if "rank" in word_vectors.columns:
        common, rare = (known.where(side).select("term", "vec") for side in (F.col("rank") <= near, F.col("rank") > near))
        unmet = counts.join(F.broadcast(common.select("term").distinct()), "term", "left_anti")
        # a task meets few rows of one document here: vectors are dealt by document, then summed
        far = unmet.join(rare, "term").repartition(*keep)
        both = summed(counts.join(F.broadcast(common), "term")).unionByName(summed(far))
        sums = both.groupBy(*keep).agg(F.max("__size").alias("__size"), *[
            F.sum(c).alias(c) for c in both.columns if c.startswith(("__s", "__n")) and c != "__size"])
    else:
        sums = summed(counts.join(known, "term"))
    means = F.array(*[F.col(f"__s{d}") / F.col(f"__n{d}") for d in range(dim)])
    return sums.select(*keep, F.slice(means, F.lit(1), F.col("__size")).alias("vec"))


def avg_doc_vectors(counts: DataFrame, word_vectors: DataFrame, dim: int, key: str = "row_id") -> DataFrame:
    """E13 in long form, ``(key, dim, value)``: :func:`avg_doc_arrays`."""
    means = avg_doc_arrays(counts, word_vectors, dim, (key,))
    return means.select(key, F.posexplode("vec").alias("dim", "value"))


def concat_vectors(left: DataFrame, right: DataFrame, key: str, lvec: str = "vec", rvec: str = "vec") -> DataFrame:
    """Join two vector tables on the key and concatenate."""
    return (left.select(key, F.col(lvec).alias("__l")).join(right.select(key, F.col(rvec).alias("__r")), key)
            .select(key, F.concat("__l", "__r").alias("vec")))
