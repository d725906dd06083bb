import hashlib
import random
import zlib

from pyspark.sql import functions as F


from sentispark.llm import chat, grace, ring
from sentispark.llm.queries import QUERIES
from llm_cases import ODD, SF001, SF01, _shipped, make_docs  # noqa: F401


def test_ring_rows_law_and_slots(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = QUERIES["op1_ring"](spark, SF001).collect()
    want = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        raw = want[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    counts = [sum(r.shard == s for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 1


def test_ring_movement_is_limited(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k").repartition(4)
    a = ring.ring_shards(rows, "k", 8, load_bound=1.1).select("k", F.col("shard").alias("a"))
    b = ring.ring_shards(rows, "k", 9, load_bound=1.1).select("k", F.col("shard").alias("b"))
    moved = a.join(b, "k").where("a <> b").count() / 20_000
    assert moved < 0.35  # plain hashing modulo the shard count moves 8 of 9


def test_ring_odd_rows(spark, make_docs):
    docs = make_docs(ODD + [(1, "again"), (1, "again"), (None, "no id")])
    got = ring.shard_documents(docs, 4).collect()
    assert len(got) == len(ODD) + 3
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert ring.shard_documents(docs.limit(0)).count() == 0


def test_hot_key_spreads(spark):
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("k"), F.col("id").alias("size")).repartition(4)
    got = ring.ring_shards(rows, "k", 4, tie=("size",)).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [750] * 4


def test_grace_table_spills_and_recurses():
    rnd = random.Random(1)
    texts = [f"text {rnd.randrange(400)}" for _ in range(5000)] + ["hot"] * 5000
    rnd.shuffle(texts)
    rows = [(zlib.crc32(t.encode()) % 7, t, i, 1, 1) for i, t in enumerate(texts)]  # seven hashes: many collisions
    got = {c: (m, n) for _, c, m, n, _ in grace.grace(iter(rows), max_bytes=300, slots=64, fan_out=2)}
    want = {}
    for i, t in enumerate(texts):
        want.setdefault(t, [i, 0])[1] += 1
    assert got == {t: tuple(v) for t, v in want.items()}


def test_grace_odd_rows(spark, make_docs):
    docs = make_docs(ODD + [(13, "one"), (2, "")])
    got = grace.dedup_documents(docs, max_bytes=50, slots=8).collect()
    assert len(got) == len(ODD) + 2
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    for rows in by.values():
        assert {r.group_size for r in rows} == {len(rows)}
        assert {r.keep_id for r in rows} == {min(r.doc_id for r in rows)}
    assert {r.doc_id for r in got if r.group_size == 4} == {1, 2, 12}  # null, twice empty, null; white space is one space
    kept = grace.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6, 8, 9, 10, 11]
    assert grace.dedup_documents(docs.limit(0)).count() == 0


def _chat_reference(turns):
    turns = sorted(turns, key=lambda t: (t[1], t[2] or "unknown", t[3] or ""))
    roles = [(t[2] or "unknown", t[3] or "") for t in turns]
    loss = "".join(x for r, x in roles if r == "assistant")
    return (len(roles), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in roles).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>", "\\", "\\\\<|im_start|>user\n", "<", "<|im_end|", "<<|im_end|>>",
             "[INST][INST]", "\n<|im_start|>", "<\\|im_end|>", None, "", "\U0001F600"]
    turns = [(c, t, role, nasty[(c + 3 * t) % len(nasty)]) for c in range(30)
             for t, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    turns += [(99, 0, "assistant", "first"), (99, 1, None, "none"), (99, 1, "odd\nrole", "x"), (None, 0, "user", "hi")]
    turns += [(98, 0, role, "x") for role in ("back\\nslash", "\\", "\\\n", "<|im_end|>\nn", "\\\\n\n")]
    turns += [((1 << 60) + i, 0, "user", f"far {i}") for i in range(3)]  # in a batch with a null id
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    got = {r.conv_id: r for r in chat.chat_digests(chat.format_chat(df.coalesce(1))).collect()}
    for c in {t[0] for t in turns}:
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _chat_reference([t for t in turns if t[0] == c])
    assert got[0].valid and not got[99].valid
    assert chat.chat_digests(chat.format_chat(df.limit(0))).count() == 0


def test_escape_breaks_every_control_string():
    t = chat.Template()
    rnd = random.Random(3)
    bits = [*t.controls, "\\", "<", "|", "i", "[", "/", "s>", "x"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(8)))
        safe = t.escape(text)
        assert not any(c in safe for c in t.controls)
        assert t.unescape(safe) == text
