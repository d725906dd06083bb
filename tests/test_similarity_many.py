import numpy as np
import pytest

from sentispark.operators import similarity as SIM


@pytest.mark.parametrize("block,exclude", [(7, True), (4096, False)])
def test_blocks_equal_brute_force(spark, block, exclude):
    rng = np.random.default_rng(block)
    x = rng.integers(-2, 3, (300, 5)).astype(float)  # many ties and some zero vectors
    x[7] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, vec array<double>").repartition(4)
    got = SIM.most_similar_many(df, df.where("id % 5 = 2 or id = 900"), "id", "vec", 3, exclude, block=block).collect()
    unit = {i: v / np.linalg.norm(v) for i, v in enumerate(x) if v.any()}
    want = []
    for q in sorted(i for i in unit if i % 5 == 2):
        near = sorted((-round(float(unit[q] @ v), 9), i) for i, v in unit.items() if not (exclude and i == q))[:3]
        want += [(q, i, r + 1) for r, (_, i) in enumerate(near)]
    assert sorted((r.q_key, r.id, r["rank"]) for r in got) == sorted(want)


def test_no_queries_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0])], "id long, vec array<double>")
    assert SIM.most_similar_many(df, df.where("id > 5"), "id", "vec").count() == 0


def test_mean_word_vectors_by_document(spark):
    """Words beside the documents and words of the join give one mean; one row a document is shuffled."""
    docs = {1: ["a", "a", "b", "x"], 2: ["c"], 3: ["x"], 4: ["b", "c", "d"]}
    vectors = {"a": [1.0, 2.0], "b": [3.0, None], "c": [None, 5.0], "d": [7.0, 8.0]}
    counts = spark.createDataFrame([(k, t, ts.count(t)) for k, ts in docs.items() for t in sorted(set(ts))],
                                   "row_id long, term string, tf long")
    words = spark.createDataFrame([(t, v, i + 1) for i, (t, v) in enumerate(vectors.items())],
                                  "term string, vec array<float>, rank long")

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    want = {k: [mean([vectors[t][d] for t in ts if t in vectors]) for d in range(2)]
            for k, ts in docs.items() if any(t in vectors for t in ts)}
    for w, near in ((words, 2), (words, 9), (words, 0), (words.drop("rank"), 2)):
        got = SIM.avg_doc_arrays(counts, w, 2, near=near).collect()
        assert {r.row_id: r.vec for r in got} == want and len(got) == len(want)
    long = SIM.avg_doc_vectors(counts, words, 2).collect()
    assert {(r.row_id, r.dim): r.value for r in long} == {(k, d): x for k, v in want.items() for d, x in enumerate(v)}
