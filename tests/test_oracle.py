"""Registered queries against their DuckDB oracle text (sf0.001 subset by
default; SENTISPARK_ORACLE_ALL=1 runs every SQL-checked query)."""

import os

import pytest

from conftest import SF001

from sentispark.plans.catalog import load_all
from sentispark.plans.compare import compare, duckdb_connection

SUBSET = ("clean_text", "strip_html", "term_freq_by_class", "term_scores", "length_box_stats",
          "train_val_test_split", "tfidf", "multinomial_nb", "roc_curve", "apply_phrases",
          "pad_sequences", "most_median_least")
REG = load_all()
NAMES = [n for n, s in REG.items() if s.sql] if os.environ.get("SENTISPARK_ORACLE_ALL") else list(SUBSET)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    res = compare(REG[name].build(spark, SF001), con, REG[name].sql)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert "term" in df.columns and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
