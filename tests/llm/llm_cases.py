"""Fixtures and rows shared by the tests of this folder (no second conftest: its name would hide the first)."""

import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def _shipped(spark):
    from sentispark.llm.common import prepare
    prepare(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` rows, with a few columns whose names clash with
    the operators' own."""
    def make(rows, partitions=3):
        full = [(i, t, "en", f"src{(i or 0) % 3}" if i != 4 else None, 7, "x", -1) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, h long, content string, rep long").repartition(partitions)
    return make


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d"), (6, "a b c d e"), (7, "a b c d e"),
       (8, "A  b\tc d e"), (9, "word " * 20000), (10, "z" * 200000), (11, "\U0001F600 é ﬁ \x00 tail"), (12, None)]
