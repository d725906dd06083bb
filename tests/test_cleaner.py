"""Cleaner goldens (FIXTURES.md part C) and text helpers."""

from pyspark.sql import functions as F

from sentispark.functions import text as T
from sentispark.operators.corpus import clean_corpus

GOLDEN = [
    ("@switchfoot http://twitpic.com/2y1zl - Awww, that's a bummer.", "awww that bummer"),
    ("I can't believe it isn't done!", "can not believe it is not done"),
    ("see www.example.com/x now", "see now"),
    ("awww that hurts", "hurts"),
    ("wwwhat is this", "is this"),
    ("a<br>b <b>bold</b> text", "ab bold text"),
    ("Tom &amp; Jerry &quot;rock&quot;", "tom jerry rock"),
    ("x &amp;lt;3 you", "lt you"),
    ("&#72;ello café 100%", "hello caf"),
    ("@only http://only.url", ""),
    ("I a b c", ""),
    ("don’t won't", "don will not"),
    ("http://a.b/c\nnext word here", "word here"),
]


def test_clean_text_goldens(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(GOLDEN)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", T.clean_text("s").alias("c")).collect()}
    for i, (_, want) in enumerate(GOLDEN):
        assert got[i] == want, (i, got[i], want)


def test_drop_empty_removes_rows_9_and_10(spark):
    df = spark.createDataFrame([(i, s, 0) for i, (s, _) in enumerate(GOLDEN)], "row_id int, text string, target int")
    kept = {r.row_id for r in clean_corpus(df).collect()}
    assert kept == set(range(13)) - {9, 10}


def test_na_literals_dropped(spark):
    df = spark.createDataFrame([(1, "nan", 0), (2, "NULL", 0), (3, "fine text", 4)], "row_id int, text string, target int")
    assert [r.row_id for r in clean_corpus(df).collect()] == [3]


def test_strip_html_and_entities(spark):
    df = spark.createDataFrame([("<!-- c --><script>var x='</p>';</script><p>A&#x48;&middot;B</p>",)], "h string")
    assert df.select(T.strip_html("h")).first()[0] == "AH·B"


def test_normalize_review_and_control(spark):
    df = spark.createDataFrame([("Good movie.<br />Really\u0085(yes)!",)], "s string")
    out = df.select(T.normalize_review(T.replace_control("s"))).first()[0]
    assert out == "good movie .  really  ( yes )  ! "


def test_whitespace_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("  a b\tc  d ",)], "s string")
    row = df.select(T.whitespace_tokens("s").alias("w")).first()
    assert row.w == ["a", "b", "c", "d"]
    g = df.select(T.ngrams(T.whitespace_tokens("s"), 3).alias("g")).first().g
    assert g == ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"]


def test_path_to_name(spark):
    df = spark.createDataFrame([("train/pos",)], "f string")
    assert df.select(T.path_to_name("f")).first()[0] == "train-pos.txt"


NESTED = {
    "&amp;lt;": "&lt;", "&#38;lt;": "&lt;", "&#x26;amp;": "&amp;", "&amp;amp;amp;": "&amp;amp;", "&amp;#38;": "&#38;",
    "&lt&amp;gt": "<&gt", "a&#X41;&#65;&#0;b": "aAA\ufffdb", "&unknown;&hellip;&bogus": " \u2026&bogus",
    "&&lt;;&": "&<;&", "&#38;#x41;&regular;": "&#x41;\u00aeular;", "&#1234567890;&#xD800;": "&#1234567890;\ufffd", "&nbsp": "\u00a0",
}


def test_references_are_decoded_once(spark):
    rows = [(k, v) for k, v in NESTED.items()] + [(f"x {k} y", f"x {v} y") for k, v in NESTED.items()] + [(None, None), ("", "")]
    df = spark.createDataFrame(rows, "t string, want string").select("t", "want", T.decode_entities("t").alias("got"))
    assert [(r.t, r.got) for r in df.collect() if r.got != r.want] == []


def test_references_in_sql_agree():
    import duckdb
    from sentispark.plans import sqltext as S
    con = duckdb.connect()
    con.execute("CREATE TABLE s (t VARCHAR, want VARCHAR)")
    con.executemany("INSERT INTO s VALUES (?, ?)", list(NESTED.items()))
    got = con.sql("WITH " + ", ".join(S.staged("d", "s", "want", "t", S.decode_entity_steps())) + " SELECT want, t FROM d").fetchall()
    assert [r for r in got if r[0] != r[1]] == [] and len(got) == len(NESTED)
