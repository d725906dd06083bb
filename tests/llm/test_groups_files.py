import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_cases import ODD, SF001, SF01, _shipped, make_docs  # noqa: F401
from sentispark.llm import components, jaccard, packing, passages, warc


def _near_copies(seed, groups=12, copies=9, length=80):
    """Groups of texts with a few changed words each, some straddling the threshold."""
    rnd = random.Random(seed)
    out, i = [], 100
    for _ in range(groups):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.randrange(6, length))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rnd.randrange(0, max(2, len(t) // 18))):
                t[rnd.randrange(len(t))] = f"x{rnd.randrange(10 ** 6)}"
            out.append((i, " ".join(t)))
            i += 1
    shared = [f"s{k}" for k in range(12)]  # a passage in many unlike texts
    for _ in range(60):
        body = [f"w{rnd.randrange(4000)}" for _ in range(25)]
        out.append((i, " ".join(body[:9] + shared + body[9:])))
        i += 1
    rnd.shuffle(out)
    return out


def _shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def _reference(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in root}, {i: len(s) for i, s in sets}


@pytest.mark.parametrize("small,block", [(64, 1024), (2, 8)])
def test_jaccard_matches_brute_force(make_docs, small, block):
    rows = _near_copies(small) + ODD
    want, sizes = _reference(rows)
    got = jaccard.jaccard_components(make_docs(rows), small=small, block=block).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes


def test_jaccard_null_and_repeated_ids(make_docs):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l"), (5, "g h i j k l"), (None, "a b c d e f"), (9, None)]
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(make_docs(rows)).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (None, None), (9, 9)}
    a, b = " ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))
    rows = [(3, a), (5, a), (5, b), (5, b), (7, b + " more"), (8, "b0 b1 b2 b3 b4 x"), (11, a + " z"), (12, b), (12, "alone is this text here")]
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(make_docs(rows)).collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (8, 8), (11, 3), (12, 3)}
    assert jaccard.jaccard_components(make_docs(rows).limit(0)).count() == 0


def test_bitmap_bound_holds():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rnd.integers(-2 ** 62, 2 ** 62, rnd.integers(1, 300)))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.8], rnd.integers(-2 ** 62, 2 ** 62, rnd.integers(0, 60))]))
        apart = int(np.bitwise_count(jaccard.signature(a) ^ jaccard.signature(b)).sum())
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - apart) // 2


def test_small_groups_list_what_bitmaps_allow():
    """Pairs of small groups: all that link, few that do not, whatever the batches."""
    import pyarrow as pa
    rnd = np.random.default_rng(4)
    base = rnd.integers(-2 ** 62, 2 ** 62, (3, 90))
    sets = [np.unique(np.concatenate([base[k % 3][rnd.random(90) < 0.97], rnd.integers(-2 ** 62, 2 ** 62, rnd.integers(0, 5))]))
            for k in range(30)]
    rows = sorted((h, (len(s) << 32) | h % 3, i, i, jaccard.signature(s, jaccard.SMALL_BITS).tobytes())
                  for i, s in enumerate(sets) for h in range(4))
    want = {(i, j) for i in range(30) for j in range(i + 1, 30)
            if 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (len(sets[i]) + len(sets[j]))}
    for size in (1000, 7, 1):
        parts = [pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*part))[:4]), pa.array([r[4] for r in part], pa.binary())],
                                            names=["h", "place", "rep", "comp", "bits"])
                 for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        got = [tuple(r) for b in jaccard._small_pairs(iter(parts)) for r in zip(*(c.to_pylist() for c in b.columns[:2]))]
        assert want <= set(got) and len(set(got) - want) <= 10
        assert len(got) == 4 * len(set(got))


def test_wide_signatures_tell_long_texts_apart():
    """Signatures of different lengths keep the bound; long sets that share a passage only are no candidates."""
    rnd = np.random.default_rng(7)
    sizes = rnd.integers(300, 6000, 40).tolist() + [1023, 1024, 1025, 1370] * 2
    passage = rnd.integers(-2 ** 62, 2 ** 62, 40)
    sets = [np.unique(np.concatenate([passage, rnd.integers(-2 ** 62, 2 ** 62, n - 40)])) for n in sizes]
    sets += [np.unique(np.concatenate([s[rnd.random(len(s)) < 0.9], rnd.integers(-2 ** 62, 2 ** 62, len(s) // 20)])) for s in sets]
    n, at = np.array([len(s) for s in sets]), np.arange(len(sets))
    i, j = (x.ravel() for x in np.meshgrid(at, at))
    ok = (i < j) & (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j]))
    i, j = i[ok], j[ok]
    both = np.array([len(np.intersect1d(sets[x], sets[y])) for x, y in zip(i, j)])
    links = both >= jaccard.need(n[i], n[j])
    wide = jaccard.Bitmaps([jaccard.signature(s, jaccard.wide_bits(len(s))).tobytes() for s in sets])
    assert len(set(wide.size.tolist())) > 3
    got = jaccard.within_bound(n[i], wide, i, n[j], wide, j)
    assert links.sum() == len(sets) // 2 and (got >= links).all() and (got & ~links).sum() == 0
    # as they travel with a group of more than a few members
    rows = sorted(((1, (len(s) << 32) | 1, k, k, jaccard.signature(s, jaccard.wide_bits(len(s))).tobytes()) for k, s in enumerate(sets)))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]), pa.array([r[4] for r in rows], pa.binary())],
                                       names=["h", "place", "rep", "comp", "bits"])
    pairs = {tuple(r) for b in jaccard._small_pairs(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns[:2]))}
    assert pairs == {(int(x), int(y)) for x, y, ok in zip(i, j, links) if ok}


def test_leaders_carry_over_batches():
    import pyarrow as pa
    rnd = random.Random(2)
    rows = sorted({(rnd.randrange(6), (rnd.randrange(20, 60) << 32) | rnd.randrange(3), rnd.randrange(50)) for _ in range(80)} | {(9, 5 << 32, 1)})

    def run(size):
        parts = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size])], names=["h", "place", "rep"])
                 for i in range(0, len(rows), size)]
        return [r for b in jaccard._lead(iter(parts)) for r in zip(*(c.to_pylist() for c in b.columns))]

    whole = run(1000)
    assert [r[:3] for r in whole] == [r for r in rows if sum(x[0] == r[0] for x in rows) > 1]
    for size in (1, 2, 7):
        assert run(size) == whole


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components.components(edges.limit(0)).count() == 0


def _check_packing(got, texts, window=2048):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.VOCABULARY)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        ids = [*tok.encode(texts[d] or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or at & (at - 1) == 0 and at < window
    return by_seq


def test_packing_is_exact_and_proportioned(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = packing.piece_digests(packing.pack_documents(docs)).collect()
    by_seq = _check_packing(got, {r.doc_id: r.text for r in docs.collect()})
    total = {}
    for r in got:
        total[r.source] = total.get(r.source, 0) + r.length
    n = sum(total.values())
    for pieces in by_seq.values():
        if sum(p.length for p in pieces) == 2048:
            for s in total:
                own = sum(p.length for p in pieces if p.source == s)
                assert abs(own - 2048 * total[s] / n) <= 2


def test_packing_odd_rows_and_special_strings(make_docs):
    rows = [r for r in ODD if r[0] != 11] + [(20, "<|endoftext|> it's  two\n\n  spaces x"), (21, "日本語 ééé 123")]
    got = packing.piece_digests(packing.pack_documents(make_docs(rows))).collect()
    _check_packing(got, dict(rows))
    assert packing.pack_documents(make_docs(rows).limit(0)).count() == 0


def test_rounds_against_one_run():
    """Windows computed alone agree with serving token by token."""
    totals, shares = [700, 90, 3, 0, 1200], [0.5, 0.1, 0.01, 0.1, 0.29]
    r = packing.Rounds(totals, shares, 64)
    order = sorted((r.key(j, s), s) for s, t in enumerate(totals) for j in range(t))
    for w in range(0, r.total // 64 + 2):
        served = [0] * 5
        for _, s in order[:64 * w]:
            served[s] += 1
        assert r.served(np.array([w]))[0].tolist() == served
    place = {}
    for at, (_, s) in enumerate(order):
        j = place.setdefault(s, [])
        j.append(at)
    for s, want in place.items():
        assert r.rank(np.full(len(want), s), np.arange(len(want))).tolist() == want


def test_compact_windows_are_the_tree():
    rng = np.random.default_rng(0)
    for k in range(150):
        v = rng.integers(0, 9 if k % 2 else 10 ** 9, rng.integers(1, 50))
        if k % 3 == 0 and len(v) > 5:
            v[rng.integers(0, len(v))] = -1
        t, want = int(rng.integers(2, 10)), set()

        def walk(lo, hi):
            if hi - lo + 1 >= t:
                c = lo + int(np.argmin(v[lo:hi + 1]))
                if v[c] >= 0:
                    want.add((lo, c, hi))
                walk(lo, c - 1)
                walk(c + 1, hi)

        walk(0, len(v) - 1)
        assert set(zip(*[x.tolist() for x in passages.compact_windows(v, t)])) == want


def test_passages_found_and_clean_left_alone(make_docs):
    rnd = random.Random(8)
    fresh = iter(range(10 ** 7))

    def words(n):
        return [f"u{next(fresh)}" for _ in range(n)]

    shared, other = words(70), words(90)
    docs, dirty = [], set()
    for d in range(100, 160):
        body = words(rnd.randrange(0, 200))
        if d % 4 == 0:
            at = rnd.randrange(len(body) + 1)
            own = list(shared)
            if d % 8 == 0:
                own[30] = words(1)[0]  # a near copy: one word changed
            body[at:at] = own
            dirty.add(d)
        if d % 10 == 3:
            body += other
            dirty.add(d)
        docs.append((d, " ".join(body)))
    whole = " ".join(words(60))
    docs += [(300, whole), (301, whole), (302, " ".join(words(49))), (303, docs[1][1][:40])] + ODD
    dirty |= {300, 301}
    got = passages.near_duplicate_passages(make_docs(docs)).collect()
    assert {r.doc_id for r in got} == dirty
    text = {d: (t or "").split() for d, t in docs}
    for r in got:
        a, b = set(text[r.doc_id][r.start:r.stop]), set(text[r.match_id][r.match_start:r.match_stop])
        assert r.stop - r.start >= 50 and len(a & b) >= 0.75 * len(a | b)
    assert passages.near_duplicate_passages(make_docs(docs).limit(0)).count() == 0


@pytest.mark.parametrize("twice", [1, 2])
def test_passage_twice_in_one_text(make_docs, twice):
    rnd = random.Random(twice)

    def words(n):
        return [f"u{rnd.randrange(10 ** 9)}" for _ in range(n)]

    docs, want = [], set()
    for k, length in enumerate((52, 60, 90, 150)):
        for gap in (0, 25, 120):
            shared = words(length)
            for d in (1, 2):
                text, i = words(30), 1000 * (k + 1) + 10 * gap + d
                for j in range(2 if d == twice else 1):
                    want.add((i, len(text), length))
                    text += shared + words(gap if j == 0 and d == twice else 30)
                docs.append((i, " ".join(text)))
    got = passages.near_duplicate_passages(make_docs(docs)).collect()
    found = {(i, at) for i, at, length in want for r in got
             if r.doc_id == i and at - 6 <= r.start and r.stop <= at + length + 6 and r.match_id == (i + 1 if i % 10 == 1 else i - 1)}
    assert found == {(i, at) for i, at, _ in want}


def test_warc_round_trip(spark):
    big, small = "<p>" + "é" * 600 + "</p>", "tiny"
    rows = [(1, "http://WWW.Example.org:80/a?b=1#c", big), (2, None, big), (3, "http://example.org/x y", big), (4, "u", small),
            (5, "u", small), (6, "http://[bad", None), (7, "", "line\r\n\r\nWARC/1.1\r\n"), (None, "n", "no id"), (8, "x\r\ny", "z" * 5000)]
    rows += [(100 + i, f"http://host.example.com/{i % 50}", f"page {i}") for i in range(700)]
    pages = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, offset int, key string").repartition(3)
    folder, parts, captures = warc.archive_pages(pages)
    assert captures.count() == len(rows)
    places = warc.look_up(warc.page_keys(pages), f"{folder}/index", parts)
    got = {r.page_id: r for r in warc.read_records(places, f"{folder}/archives").collect()}
    assert set(got) == {r[0] for r in rows}
    last = max(r[0] for r in rows if r[2] == big)
    for i, url, html in rows:
        raw = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        want = ("revisit", last) if html == big and i != last else ("response", None)
        assert (r.record_type, r.refers_to) == want
        assert r.payload == (raw if want[0] == "response" else None)
    missing = spark.createDataFrame([("zz)/none 1",), ("",)], "key string")
    assert warc.look_up(missing, f"{folder}/index", parts).count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("uri,want", [
    ("file:///a/b c", "/a/b c"), ("file:/a", "/a"), ("/a/b", "/a/b"), ("s3a://bucket/a:b", "s3://bucket/a:b"),
    ("s3n://bucket", "s3://bucket"), ("hdfs://host:8020/a", "hdfs://host:8020/a")])
def test_folder_uris(uri, want):
    assert warc.arrow_uri(uri) == want


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("component_id", F.lit(1))
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").first().text
    extra = docs.limit(1).select(F.lit(10 ** 6).cast("long").alias("doc_id"), F.lit("start " + bench + " end").alias("text"),
                                 *docs.columns[2:])
    twin = docs.limit(1).withColumn("doc_id", F.lit(10 ** 6 + 1).cast("long"))
    now, kept = docs.unionAll(extra).unionAll(twin), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF001)
        assert out.columns == docs.columns
        now = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r.doc_id for r in now.collect()})
    assert 10 ** 6 + 1 not in kept[1]
    assert 10 ** 6 in kept[2] and 10 ** 6 not in kept[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF001).collect()
    _check_packing(pieces, {r.doc_id: r.text for r in now.collect()})
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0


def test_variant_in_a_large_group(make_docs):
    """Two texts share a variant of a passage that many texts hold and neither is similar to."""
    rnd = random.Random(3)

    def words(n):
        return [f"u{rnd.randrange(10 ** 9)}" for _ in range(n)]

    docs, want = [], set()
    for k in range(12):
        shared = words(60)
        variant = list(shared)
        variant[20], variant[40] = words(2)
        ids = [1000 * (k + 1) + i for i in range(32)]
        x, y = rnd.sample(ids[2:], 2)
        want.add((min(x, y), max(x, y)))
        docs += [(i, " ".join(words(30) + (variant if i in (x, y) else shared) + words(30))) for i in ids]
    got = passages.near_duplicate_passages(make_docs(docs)).collect()
    assert want <= {(r.doc_id, r.match_id) for r in got}


def test_all_holders_of_a_passage_are_paired(make_docs):
    """Not only with the first holder and the one before: each with each, whole copies by their first document."""
    rnd = random.Random(11)

    def words(n):
        return [f"u{rnd.randrange(10 ** 9)}" for _ in range(n)]

    shared, docs = words(80), []
    for i in range(9):
        own = list(shared)
        if i % 3 == 2:
            own[40] = words(1)[0]
        docs.append((i, " ".join(words(20 + i) + own + words(30))))
    docs += [(50, docs[4][1]), (51, " ".join(words(120)))]
    got = passages.near_duplicate_passages(make_docs(docs)).collect()
    pairs = {(r.doc_id, r.match_id) for r in got if r.kind == "passage"}
    assert pairs == {(i, j) for i in range(9) for j in range(9) if i != j}
    assert {(r.doc_id, r.match_id) for r in got if r.kind == "copy"} == {(50, 4), (4, 50)}


def test_shared_values_go_on_over_batches():
    import pyarrow as pa
    rnd = random.Random(2)
    rows = sorted((rnd.randrange(60), rnd.randrange(4), k) for k in range(150))
    docs = {}
    for k, d, _ in rows:
        docs.setdefault(k, set()).add(d)
    want = [(*r, sum(k == r[0] for k, *_ in rows[:i])) for i, r in enumerate(rows) if len(docs[r[0]]) > 1]
    for size in (1, 2, 7, 150):
        cut = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size])], names=["key", "doc", "c"])
               for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in passages._shared(iter(cut)) for r in b.to_pylist()]
        assert got == want


def test_joint_values_of_texts_that_agree():
    """Two places whose windows agree under ``agree`` hashes share a joint value, whichever hashes they are."""
    from itertools import combinations
    w = np.zeros(8, passages._WINDOW)
    w["l"], w["r"] = 0, 99
    for number in range(8):
        w[number]["key"], w[number]["c"] = 64 * (number + 1) + number, 20 + 7 * number
    for some in combinations(range(8), 4):
        other = w.copy()
        for number in set(range(8)) - set(some):
            other[number]["key"] += 640
        x, y = (set(passages.joint_values(np.zeros(8, np.int64), v, 46, 4)[1].tolist()) for v in (w, other))
        assert x & y
    far = w.copy()
    far["l"], far["r"] = far["c"] - 10, far["c"] + 20  # too short
    assert not len(passages.joint_values(np.zeros(8, np.int64), far, 46, 4)[1])


def test_windows_leave_no_used_tables(spark, make_docs):
    """Disk: of the tables on the way only classes and passages, which the result reads, stay."""
    import os
    from urllib.parse import urlparse
    rnd = random.Random(5)
    body = " ".join(rnd.choice("abcdefghij") * 3 + str(rnd.randrange(500)) for _ in range(120))
    docs = [(i, f"x{i} {body} y{i}") for i in range(6)] + [(9, None)]
    folder = urlparse(spark.sparkContext.getCheckpointDir()).path
    before = set(os.listdir(folder))
    got = passages.near_duplicate_passages(make_docs(docs))
    left = {x.rsplit("-", 1)[0].split("-")[0] for x in set(os.listdir(folder)) - before if not x.startswith(".")}
    assert left == {"members", "passages"}
    assert {r.doc_id for r in got.collect()} == set(range(6))
