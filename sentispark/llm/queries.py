"""The operators' queries: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.llm import (chat, decontaminate, grace, importance, jaccard, line_runs, manifest, packing,
                            passages, ring, secret_scan, toxicity, warc)
from sentispark.llm.common import read_table


def op1_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_documents(read_table(spark, sf_dir, "documents"))


def op2_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.dedup_documents(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)],
                                  "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select(*added.columns).unionByName(added)
    return chat.chat_digests(chat.format_chat(turns))


_CONTROLS = chat.Template().controls
OP3_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
  length('<|im_start|>') + length(role) + 1 + length(text) + length('<|im_end|>') + 1
  + length(text) - length(replace(text, chr(92), '')) + """ + " + ".join(
    f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in _CONTROLS) + """ AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and((before || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')) AS valid
FROM f GROUP BY conv_id"""


def op4_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(read_table(spark, sf_dir, "documents")))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_duplicate_passages(read_table(spark, sf_dir, "documents"))


def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.secret_digests(secret_scan.scan_secrets(docs, secret_scan.train_markov(docs)))


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


OP9_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS last FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to FROM g"""

def op10_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_digests(line_runs.drop_common_lines(read_table(spark, sf_dir, "documents")))


OP11_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k JOIN d USING (r) LEFT JOIN f USING (key) GROUP BY r"""

#: CRC-32 in SQL: ``crc_table`` (its 256 constants from their rule) and an expression over a text.
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda v: list_reduce([v] || range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def crc_sql(text: str) -> str:
    return f"""xor(list_reduce([4294967295] || list_transform(range(octet_length(encode({text}))),
  lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)),
  lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1])), 4294967295)"""


def op12_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove_documents(read_table(spark, sf_dir, "documents"))


def _op12_sql(levels: int = 13) -> str:
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    def climb(name: str, at: str) -> str:
        steps = [f"{name}0 AS MATERIALIZED ({at})"]
        for k in range(levels):
            steps.append(f"""{name}r{k} AS MATERIALIZED (SELECT t, p // 3 AS p, any_value(n) AS n, string_agg(h, '' ORDER BY p) AS run
  FROM {name}{k} GROUP BY t, p // 3), {name}{k + 1} AS MATERIALIZED (SELECT t, p, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS h,
  (n + 2) // 3 AS n FROM {name}r{k})""")
        return ",\n".join(steps)

    def fold(first: str, at: str, name: str) -> str:
        steps, last = [], at
        for k in range(levels):
            here = "64 * CAST(a.p % 3 AS INTEGER)"
            side = f"CASE WHEN r.n > 1 THEN substr(run, 1, {here}) || substr(run, {here} + 65) ELSE '' END"
            mend = f"CASE WHEN r.n > 1 THEN sha256(substr(run, 1, {here}) || cur || substr(run, {here} + 65)) ELSE cur END"
            steps.append(f"""{first}{k} AS MATERIALIZED (SELECT g, a.t, a.p // 3 AS p, {mend} AS cur, proof || {side} AS proof
  FROM {last} a JOIN {name}r{k} r ON a.t = r.t AND a.p // 3 = r.p)""")
            last = f"{first}{k}"
        return ",\n".join(steps)

    own, cut = ("sha256(" + " || ".join(field(c) for c in (*manifest.FIELDS[:-1], text)) + ")"
                for text in ("text", "replace(text, chr(10), '')"))
    return f"""WITH {CRC_TABLE},
h AS (SELECT doc_id, source, {own} AS leaf, CASE WHEN {crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {cut} ELSE {own} END AS now
  FROM documents, crc_table),
o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS FIRST, doc_id NULLS FIRST, leaf) AS g,
  dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS t,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM h),
{climb("s", "SELECT t, p, leaf AS h, n FROM o")},
{climb("u", f"SELECT 0 AS t, t AS p, h, count(*) OVER () AS n FROM s{levels}")},
fs AS (SELECT g, t, p, now AS cur, '' AS proof FROM o), {fold("a", "fs", "s")},
ft AS (SELECT a.g, 0 AS t, a.t AS p, cur, proof FROM a{levels - 1} a), {fold("b", "ft", "u")}
SELECT doc_id, leaf, s.h AS subroot, u.h AS root, sha256(b.proof) AS proof_sha256, b.cur AS folded_root, b.cur = u.h AS verified
FROM o JOIN b{levels - 1} b USING (g) JOIN s{levels} s ON o.t = s.t, u{levels} u"""


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP13_SQL = f"""WITH {CRC_TABLE},
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
dw AS MATERIALIZED (SELECT r, word, count(*) AS k FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY ALL),
bw AS MATERIALIZED (SELECT word, count(*) AS k FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY ALL),
w AS MATERIALIZED (SELECT word, {crc_sql("word")} % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc_table),
s AS (SELECT bucket, sum(k) AS s FROM dw JOIN w USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(k) AS t FROM bw JOIN w USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(sum(coalesce(s, 0)) OVER () + 10000 AS DOUBLE)
  / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(sum(coalesce(t, 0)) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
v AS (SELECT r, CAST(sum(k * gain) AS BIGINT) AS total FROM dw JOIN w USING (word) JOIN g USING (bucket) GROUP BY r),
x AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features,
  CASE WHEN len(words) = 0 THEN 0 ELSE (total - ((total % len(words)) + len(words)) % len(words)) // len(words) END AS weight,
  CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN v USING (r)),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
  count(*) OVER (PARTITION BY n_features >= 20) AS able FROM y)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank FROM z"""


QUERIES = {f.__name__: f for f in (
    op1_ring, op2_grace_dedup, op3_chat, op4_factorization_machine, op5_jaccard_tiles, op6_packing,
    op7_compact_windows, op8_markov_secrets, op9_warc_index, op10_cgk_decontamination,
    op11_line_runs, op12_octopus_manifest, op13_importance)}
ORACLES = {"op2_grace_dedup": OP2_SQL, "op3_chat": OP3_SQL, "op9_warc_index": OP9_SQL,
           "op11_line_runs": OP11_SQL, "op12_octopus_manifest": _op12_sql(), "op13_importance": OP13_SQL}
