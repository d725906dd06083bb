"""Sources and sinks (S1-S5, S8, S9) and the streaming cleaner."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001

from sentispark.sources import files as S


def test_read_raw_csv_latin1_doubled_quotes(spark):
    d = tempfile.mkdtemp(prefix="sentispark-s1-")
    p = os.path.join(d, "raw.csv")
    line1 = '0,1,"Mon","NO_QUERY","u1","café ""hi"", x \\"\n'
    line2 = '4,2,"Mon","NO_QUERY","u2","nan"\n'
    with open(p, "wb") as f:
        f.write((line1 + line2).encode("latin-1"))
    rows = {r.id: r for r in S.read_raw_csv(spark, p).collect()}
    assert rows[1].text == 'café "hi", x \\'
    assert rows[1].sentiment == 0
    assert rows[2].text == "nan"  # stays text; dropped only by P7


def test_write_and_read_indexed_csv(spark):
    d = tempfile.mkdtemp(prefix="sentispark-s2-")
    df = spark.createDataFrame([(0, "a b", 0), (1, None, 4)], "row_id bigint, text string, target int")
    S.write_table(df, f"{d}/t", fmt="csv")
    back = S.read_indexed_csv(spark, f"{d}/t")
    assert sorted(back.collect(), key=lambda r: r.row_id) == sorted(df.collect(), key=lambda r: r.row_id)


def test_write_if_absent_keeps_first(spark):
    d = tempfile.mkdtemp(prefix="sentispark-s8-")
    S.write_if_absent(spark.range(3), f"{d}/x")
    S.write_if_absent(spark.range(10), f"{d}/x")
    assert spark.read.parquet(f"{d}/x").count() == 3


def test_text_dir_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="sentispark-s4-")
    docs = {"train/pos": ["Great film.<br />Loved it"], "train/neg": ["Bad (very)"],
            "test/pos": ["ok!"], "test/neg": ["no"], "train/unsup": ["maybe\u0085so"]}
    for folder, texts in docs.items():
        os.makedirs(f"{root}/{folder}")
        for i, t in enumerate(texts):
            with open(f"{root}/{folder}/{i}_1.txt", "w", encoding="utf-8") as f:
                f.write(t)
    df = S.read_text_dir(spark, root)
    got = {r.folder: (r.split, r.sentiment) for r in df.collect()}
    assert got == {"train/pos": ("train", 1.0), "train/neg": ("train", 0.0), "test/pos": ("test", 1.0),
                   "test/neg": ("test", 0.0), "train/unsup": ("extra", None)}
    out = tempfile.mkdtemp(prefix="sentispark-s5-") + "/lines"
    S.write_folder_text(df, out)
    back = spark.read.text(out).select("value", "file")
    rows = {r.file: r.value for r in back.collect()}
    assert rows["train-pos.txt"] == "great film .  loved it"
    assert rows["train-unsup.txt"] == "maybe so"


def test_save_and_load_model(spark):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense([1.0]), 1.0)], ["features", "label"])
    m = LogisticRegression(maxIter=5).fit(df)
    d = tempfile.mkdtemp(prefix="sentispark-s9-")
    S.save_model(m, f"{d}/m")
    back = S.load_model(LogisticRegressionModel, f"{d}/m")
    assert list(back.coefficients) == list(m.coefficients)


def test_streaming_cleaner_equals_batch(spark):
    from sentispark.functions import text as T
    from sentispark.streaming.clean_stream import stream_clean_documents
    work = tempfile.mkdtemp(prefix="sentispark-stream-")
    got = stream_clean_documents(spark, SF001, work)
    want = (spark.read.parquet(f"{SF001}/documents.parquet")
            .select("doc_id", T.clean_text("text").alias("text")).where(F.length("text") > 0))
    assert sorted(got.collect()) == sorted(want.collect())


def test_streaming_cleaner_reads_a_table_of_several_files(spark):
    from sentispark.streaming.clean_stream import stream_clean_documents
    src, work = (tempfile.mkdtemp(prefix="sentispark-stream-") for _ in range(2))
    docs = spark.createDataFrame([(i, f"Word{i} <b>here</b>", "en", "web", 10) for i in range(9)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{src}/documents.parquet")  # a folder of part files
    assert sorted(r.doc_id for r in stream_clean_documents(spark, src, work).collect()) == list(range(9))
