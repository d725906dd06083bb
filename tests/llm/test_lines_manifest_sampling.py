import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import ODD, _shipped, make_docs  # noqa: F401
from sentispark.llm import importance, line_runs, manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows, threshold):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if held[key(x)] < threshold]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


LINES = ["Share this page", " share THIS page\t", "É common", "é common", "unlike", "", " \x0b", "x"]


@pytest.mark.parametrize("options", [{}, {"hot_keys": 2}, {"hot_keys": 0, "batches": 1}, {"batches": 9, "fan_out": 2}])
def test_lines_equal_a_plain_count(spark, make_docs, options):
    rnd = random.Random(4)
    rows = [(i, "\n".join(rnd.choice(LINES + [f"own {i} {j}", f"few {rnd.randrange(9)}"]) for j in range(rnd.randrange(9))))
            for i in range(120)]
    rows += ODD + [(3, "few 1"), (None, "few 2\nx"), (200, "\n".join(["x", "few 3"] * 5000))]
    got = line_runs.drop_common_lines(make_docs(rows), **options).collect()
    assert by_id(got) == by_id(plain_lines(rows, 10))


def test_lines_threshold_and_empty_table(spark, make_docs):
    rows = [(i, "nine\nten") for i in range(9)] + [(9, "ten\nten"), (10, None)]
    got = {r.doc_id: r.text for r in line_runs.drop_common_lines(make_docs(rows)).collect()}
    assert got == {**dict.fromkeys(range(9), "nine"), 9: "", 10: ""}
    assert line_runs.drop_common_lines(make_docs(rows).limit(0)).count() == 0


def test_runs_take_batches_as_they_come(spark):
    runs = line_runs.LineRuns(spark, threshold=5, fan_out=2, buckets=3)
    total = Counter()
    for batch in range(7):
        counts = [(bytes([i]), 1 + (i * batch) % 3) for i in range(0, 40, 1 + batch % 2)]
        total.update(dict(counts))
        runs.add(spark.createDataFrame(counts, "h binary, n long"))
        assert all(len(level) < 2 for level in runs.levels)
        got = {bytes(r.h) for r in runs.frequent().collect()}
        assert got == {h for h, n in total.items() if n >= 5}
    runs.drop()


def test_run_merges_without_an_exchange(spark):
    runs = line_runs.LineRuns(spark, threshold=3, buckets=4)
    for _ in range(2):
        runs.add(spark.createDataFrame([(b"a", 1), (b"b", 2)], "h binary, n long"))
    plan = runs._merged(runs.levels[0])._jdf.queryExecution().executedPlan().toString()
    runs.drop()
    assert "Exchange" not in plan


def plain_manifest(rows):
    def h(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([h(levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, p):
        out = []
        for level in levels[:-1]:
            first = p - p % 3
            out.append((level[first:p], level[p + 1:first + 3]))
            p //= 3
        return out

    none_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((none_first(r[0]), h(map(field, r)), r))
    trees = {s: (sorted(v, key=lambda x: x[:2])) for s, v in sorted(by_source.items(), key=lambda x: none_first(x[0]))}
    levels = {s: tree([x[1] for x in v]) for s, v in trees.items()}
    top = tree([levels[s][-1][0] for s in trees])
    out = []
    for t, (s, v) in enumerate(trees.items()):
        for p, (_, leaf, r) in enumerate(v):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            cur = h(map(field, (*r[:4], r[4].replace("\n", "")))) if bad else leaf
            proof = []
            for left, right in path(levels[s], p) + path(top, t):
                proof += left + right
                cur = h([*left, cur, *right])
            out.append((r[0], leaf, levels[s][-1][0], top[-1][0], h(proof), cur, cur == top[-1][0]))
    return out


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_manifest_equals_plain_trees(spark, block):
    rnd = random.Random(block)
    rows = [(i, rnd.choice([None, "a", "b", "é", "", "hot", "hot", "hot"]), rnd.choice([None, "en"]), rnd.choice([None, 3]), t)
            for i, t in [(i, rnd.choice(["x\ny", "plain", None, "", "\n"])) for i in range(150)] + ODD]
    rows += [(5, "a", "en", 1, "same id"), (5, "a", "en", 1, "same id"), (None, "a", None, None, "no\nid"), (7, "only", "en", 1, "x")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int")
    got = manifest.prove_documents(docs.repartition(3), block).collect()
    assert by_id(got) == by_id(plain_manifest(rows))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("lift", [1, 2])
def test_manifest_of_several_lifts(spark, lift):
    rows = [(i, f"s{i % 40}" if i % 3 else "hot", "en", 1, f"t{i}\n") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert by_id(manifest.prove_documents(docs, 50, lift).collect()) == by_id(plain_manifest(rows))


def test_manifest_small_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert manifest.prove_documents(spark.createDataFrame([], schema)).count() == 0
    one = manifest.prove_documents(spark.createDataFrame([(1, None, None, None, None)], schema)).collect()
    assert one[0].leaf == one[0].root == one[0].subroot == one[0].folded_root
    assert one[0].proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_multiproof_fetches_the_minimal_union():
    # of 27 leaves, proofs of 0, 1 and 4 need leaf 2, leaves 3 and 5, then 2 of level 1, and 1 and 2 of level 2
    got = {lv: p.tolist() for lv, p in manifest.missing({0: np.array([0, 1, 4])}, 27)}
    assert got == {0: [2, 3, 5], 1: [2], 2: [1, 2]}
    assert all(not len(p) for _, p in manifest.missing({0: np.arange(10)}, 10))


def plain_resample(docs, target, percent, least, buckets, max_words, seed):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                        for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(feats(x)[1])
    for x in target:
        t.update(feats(x)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, x in docs:
        n_words, f = feats(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return [(r[0], r[2], r[3], r[4], rank.get(id(r))) for r in out]


@pytest.mark.parametrize("max_words,dictionary", [(1, 200_000), (3, 300), (2, 0)])
def test_resampling_equals_plain_counts(spark, make_docs, max_words, dictionary):
    rnd = random.Random(max_words)
    word = lambda: rnd.choice(["The", "straße", "x-1", "\U0001F600", f"W{rnd.randrange(700)}"])
    rows = [(i, " ".join(word() for _ in range(rnd.randrange(80)))) for i in range(150)] + ODD + [(None, "no id " * 30)]
    target = [" ".join(word() for _ in range(30)) for _ in range(20)] + [None, ""]
    got = importance.resample(make_docs(rows), spark.createDataFrame([(t,) for t in target], "text string"), percent=30,
                              least_words=20, buckets=500, max_words=max_words, dictionary_words=dictionary).collect()
    assert by_id(got) == by_id(plain_resample(rows, target, 30, 20, 500, max_words, 2024))


def test_resampling_empty_tables(spark, make_docs):
    no_target = spark.createDataFrame([], "text string")
    assert importance.resample(make_docs(ODD).limit(0), no_target).count() == 0
    assert importance.resample(make_docs(ODD), no_target).where(F.col("score").isNull()).count() == 0


def test_crc_shifts_compose():
    shifts, rnd = importance.Shifts(), random.Random(3)
    for _ in range(50):
        a, b = rnd.randbytes(rnd.randrange(9)), rnd.randbytes(rnd.choice([0, 1, 7, 70_000]))
        got = shifts.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))[0] ^ np.uint32(zlib.crc32(b))
        assert got == zlib.crc32(a + b)
