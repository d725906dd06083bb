import os
import uuid

import pytest

from sentispark.sources import document_files as DF
from sentispark.sources.files import FOLDERS


@pytest.fixture
def root(spark, tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


ROWS = [("train/pos", "1", "good\r\nfilm\n"), ("train/neg", "a b/c", "é \U0001F600"), ("test/pos", "1", ""), ("train/unsup", "x+y", None),
        (None, "top", "at the root"), ("train/pos", "1", "the same key again"), ("../out", "k", "stays below the root")]


def test_round_trip_and_append(spark, root):
    rows = spark.createDataFrame(ROWS, "folder string, key string, text string").repartition(3)
    DF.write_document_files(rows, root)
    got = sorted(map(tuple, DF.read_document_files(spark, root).collect()))
    want = [((f or "").removeprefix("../"), k, t or "") for f, k, t in ROWS]
    assert got == sorted(want)
    DF.write_document_files(rows.where("key = 'top'"), root)
    assert DF.read_document_files(spark, root).count() == len(ROWS) + 1


def test_files_of_lost_attempts_are_not_read(spark, root):
    rows = spark.createDataFrame(ROWS[:3], "folder string, key string, text string").repartition(2)
    DF.write_document_files(rows, root)
    lost = DF.DocumentFileWriter(root, "lost")
    lost.write(iter(rows.collect()))  # a task that finished but whose job never committed
    with open(os.path.join(root, "train", "pos", f"9.{'0' * 32}-0.txt"), "w") as f:
        f.write("half a fi")  # a task that died in the middle
    assert DF.read_document_files(spark, root).count() == 3
    with pytest.raises(Exception, match="appends"):
        rows.write.format("document_files").mode("overwrite").option("path", root).save()


def test_folders_of_the_study_read_by_the_text_reader(spark, root):
    from sentispark.sources.files import read_text_dir
    rows = [(f, str(i), f"text {i}\nof two lines") for i, f in enumerate(FOLDERS)]
    DF.write_document_files(spark.createDataFrame(rows, "folder string, key string, text string"), root)
    assert sorted((r.folder, r.text) for r in read_text_dir(spark, root).collect()) == sorted((f, t) for f, _, t in rows)
