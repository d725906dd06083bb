"""Operator 5: exact n-gram Jaccard self-join with tiles and bitmap signatures.

Documents are sets of word shingles; two link when 100 |A & B| >= 75 |A | B|.
The result is exact; hashes of 64 bits stand for shingles.

1. *Sets.*  Equal sets form a class, one row each from here on.
2. *Postings.*  In one order of all shingles -- frequent ones last, else by hash -- two
   linked sets share a shingle among the first ``n - ceil(3n/4) + 1`` of each, so
   these go to one exchange by shingle.  Shingles that only one set holds drop out.
   Frequency is counted over all documents; it moves only the order, never the result.
   Prefixes are longer by ``SHARED - 1``, and then linked sets share ``SHARED`` shingles there (or their
   whole least overlap, if that is smaller), which one common phrase does not reach.
3. *Stars.*  In each shingle's group, sorted by size, members pair with one leader
   of their size band.  Pairs met under ``SHARED`` shingles are verified and give first components;
   more rounds do the same round other leaders where a group still holds several, and go on where the last
   one has linked something (at most ``ROUNDS``).  A group of copies costs as many
   pairs as it has members.
4. *Tiles.*  Only groups that still hold several components need more.  Up to ``SMALL`` members
   are paired at once; up to ``FEW`` under bitmaps of ``SMALL_BITS``, which is at most (``FEW`` - 1) / 2 pairs a
   member, and beyond under wide ones.  The members of larger groups, sorted by size, are cut into
   blocks, and blocks of compatible sizes meet in tiles of bounded size, spread over tasks.  In a
   tile, sizes, prefix positions and then bitmaps rule pairs out: a set's signature is the parity
   of its hashes over a number of bits, so the bits in which two differ are at most |A ^ B| and bound the
   overlap from above.  That bound tells sets apart only where there is about a bit for each shingle, so wide
   signatures have as many bits as the set has shingles; else long texts that share one passage would all pass.
   Stars pass the wide bitmaps, too, before any set is fetched; they are made with the sets.
5. *Verification* of what is left: the bitmap bound again, then the intersection of the
   sorted arrays, which are made anew for the sets in question only; and components.

Defined results: null and empty texts have the empty set and link with nothing; a
null doc_id is returned and links with nothing; rows that repeat a doc_id count as
one document with all their links; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentispark.llm.common import broadcast_if_small, discard, text_or_empty, written
from sentispark.llm.components import components
from sentispark.llm.shingles import WordHashes, shingle_sets

BITS = 2048
#: Bits of the smaller signatures that travel with small groups, and of wide ones at most.
SMALL_BITS, MOST_BITS = 512, 8192
BLOCK = 1024
SMALL = 64
#: Members of a group that are paired under the smaller signatures.
FEW = 8
SHARED = 3
#: Most rounds of stars round other leaders, before tiles, which settle whatever is left.
ROUNDS = 10
#: Most frequent shingles that sort last, at most so many (8 bytes each travel to the tasks).
FREQUENT = 1 << 17
#: Doc ids (8 bytes) are broadcast up to here, joined by shuffle beyond.
BROADCAST_IDS = 1_000_000


def need(a, b):
    """Least overlap of linked sets of sizes a and b."""
    return -(-3 * (a + b) // 7)


def prefix_length(n):
    return min(n, n - -(-3 * n // 4) + SHARED)


def signature(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity bitmap, as uint8 bytes."""
    return np.packbits((np.bincount(values & (bits - 1), minlength=bits) & 1).astype(np.uint8))


def wide_bits(n: int) -> int:
    """Bits of the wide signature of a set of size n: the power of two at or above n, within bounds."""
    return min(max(1 << (n - 1).bit_length(), SMALL_BITS), MOST_BITS) if n else SMALL_BITS


class Bitmaps:
    """Signatures of many sets, which may differ in length: 64-bit words in a row."""

    def __init__(self, column):
        held = column if isinstance(column, list) else column.to_pylist()
        self.words = np.frombuffer(b"".join(held), np.uint64)
        self.size = np.array([len(x) // 8 for x in held], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def rows(self, at: np.ndarray, size: int, width: int) -> np.ndarray:
        """Signatures of ``size`` words cut to ``width``: a longer one's halves meet by parity."""
        out = self.words[self.start[at][:, None] + np.arange(size)]
        while out.shape[1] > width:
            half = out.shape[1] // 2
            out = out[:, :half] ^ out[:, half:]
        return out


def within_bound(n, bits_n: Bitmaps, i, m, bits_m: Bitmaps, j) -> np.ndarray:
    """Sets of sizes n and m, rows ``i`` and ``j`` of their bitmaps, may overlap enough (compared at the shorter length)."""
    i, j = np.broadcast_arrays(i, j)
    kind, apart = (bits_n.size[i] << 32) + bits_m.size[j], np.zeros(len(i), np.int64)
    for k in np.unique(kind).tolist():
        sizes, at = (k >> 32, k & 0xFFFFFFFF), np.flatnonzero(kind == k)
        for part in np.array_split(at, 1 + len(at) * max(sizes) // (1 << 20)):
            x, y = bits_n.rows(i[part], sizes[0], min(sizes)), bits_m.rows(j[part], sizes[1], min(sizes))
            apart[part] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return n + m - apart >= 2 * need(n, m)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))


def frequent_shingles(docs: DataFrame, words: int, chunk: int = 2_000_000, local: int = 4,
                      least: int = 32) -> np.ndarray:
    """Shingles of many documents, sorted: counted in all texts, a chunk of shingles at a time;
    what a chunk holds fewer than ``local`` times is not sent on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held, size = WordHashes(), [], 0

        def counted():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values[n >= local]), pa.array(n[n >= local])], names=["h", "n"])

        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                sets = shingle_sets(whole.column(0).slice(at, 1000).to_pylist(), cache, words)
                held += sets
                size += sum(map(len, sets))
                if size >= chunk:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(FREQUENT)
    return np.sort(top.select("h").toArrow().column(0).to_numpy())  # one column, not a Row each


def _sets(docs: DataFrame, words: int, frequent: np.ndarray) -> DataFrame:
    """``doc_id, n, digest, bits, wide, prefix``: the set's size, identity, small signature and wide one (null where
    it is the small one), and the first shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                sizes, digests, bits, wide, prefixes = [], [], [], [], []
                for s in shingle_sets(b.column(1).to_pylist(), cache, words):
                    sizes.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    bits.append(signature(s, SMALL_BITS).tobytes())
                    wide.append(signature(s, w).tobytes() if (w := wide_bits(len(s))) > SMALL_BITS else None)
                    if len(s) and len(frequent):
                        last = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                        s = np.concatenate([s[~last], s[last]])
                    prefixes.append(s[:prefix_length(len(s))].tobytes() if len(s) else b"")
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (digests, bits, wide, prefixes))],
                    names=["doc_id", "n", "digest", "bits", "wide", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, bits binary, wide binary, prefix binary")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(rep, n, prefix)`` -> ``(h, place, rep)`` with place = n << 32 | position."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            b = whole.slice(at, 1000)
            h = [np.frombuffer(x, np.int64) for x in b.column(2).to_pylist()]
            sizes = [len(x) for x in h]
            place = np.concatenate([np.arange(k) for k in sizes]) + (np.repeat(b.column(1).to_numpy(), sizes) << 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(h)), pa.array(place), pa.array(np.repeat(b.column(0).to_numpy(), sizes))],
                names=["h", "place", "rep"])


def could_link(a, pa_, b, pb):
    """Sizes a <= b and positions of a shared shingle allow the pair a link."""
    least = need(a, b) - SHARED + 1
    return (4 * a >= 3 * b) & (pa_ <= a - least) & (pb <= b - least)


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``h, place, rep`` -> rows of shingles that two or more sets hold, with
    ``leader``: the first set of the row's size band in the group, if the pair may link, and
    ``least``: the shingles that pair must share in its prefixes.

    Keeps one row between batches: the last group's leader."""
    ghost, told = None, True  # the leader, and whether it has been passed on
    for batch in batches:
        if not batch.num_rows:
            continue
        h, place, rep = (c.to_numpy() for c in batch.columns)
        fresh = np.ones(len(h), bool)
        if ghost is not None:
            goes_on = h[0] == ghost[0]
            if goes_on:
                h, place, rep = (np.concatenate([[g], x]) for g, x in zip(ghost, (h, place, rep)))
                fresh = np.concatenate([[not told], fresh])
        first = np.concatenate([[True], h[1:] != h[:-1]])
        n, pos = place >> 32, place & 0xFFFFFFFF
        lead = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
        while True:  # rows too large for their leader: the first of them in each group leads the next band
            off = 4 * n[lead] < 3 * n
            if not off.any():
                break
            at = np.flatnonzero(off)
            starts = at[np.concatenate([[True], h[at[1:]] != h[at[:-1]]])]
            new = np.zeros(len(h), np.int64)
            new[starts] = starts
            lead = np.where(off, np.maximum.accumulate(new), lead)
        alone = first & np.concatenate([first[1:], [True]])
        keep = fresh & ~alone
        if not first[-1]:
            ghost, told = (h[lead[-1]], place[lead[-1]], rep[lead[-1]]), True
        else:  # the last row has met nobody yet
            ghost, told = (h[-1], place[-1], rep[-1]), not fresh[-1]
        pair = (lead != np.arange(len(h))) & (rep[lead] != rep) & could_link(n[lead], pos[lead], n, pos)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[keep]), pa.array(place[keep]), pa.array(rep[keep]),
             pa.array(rep[lead][keep], mask=~pair[keep]),
             pa.array(np.minimum(SHARED, need(n[lead], n))[keep])], names=["h", "place", "rep", "leader", "least"])


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """``rep, bits, shingles`` of the documents that share a posting."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                sets = shingle_sets(b.column(1).to_pylist(), cache, words)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "bits", "shingles"])

    return docs.mapInArrow(run, "rep long, bits binary, shingles binary")


def linked(a: bytes, bits_a: bytes, b: bytes, bits_b: bytes) -> bool:
    x, y = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
    least = need(len(x), len(y))
    apart = int(np.bitwise_count(np.frombuffer(bits_a, np.uint64) ^ np.frombuffer(bits_b, np.uint64)).sum())
    if len(x) + len(y) - apart < 2 * least:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= least


def _possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that wide signatures (``rep, n, wide``) allow; narrow rows, no sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = np.arange(b.num_rows)
                ok = within_bound(b.column(2).to_numpy(), Bitmaps(b.column(4)), at, b.column(3).to_numpy(), Bitmaps(b.column(5)), at)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in b.columns[:2]], names=["a", "b"])

    left = bits.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("wide").alias("ba"))
    right = bits.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("bb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ba", "bb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                ok = [linked(*row) for row in zip(*(c.to_pylist() for c in b.columns[2:]))]
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in b.columns[:2]], names=["a", "b"])

    left = signed.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"), F.col("bits").alias("ba"))
    right = signed.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"), F.col("bits").alias("bb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "ba", "sb", "bb")
            .mapInArrow(run, "a long, b long").distinct())


def tile_pairs(x: pd.DataFrame, y: pd.DataFrame | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs between two blocks (or within one) that sizes, positions and bitmaps allow
    and that lie in different components.  Columns ``place, rep, comp, bits``; every row
    of ``x`` sorts before every row of ``y`` by size."""
    within = y is None
    y = x if within else y
    (na, pa_), (nb, pb) = (((p := d["place"].to_numpy()) >> 32, p & 0xFFFFFFFF) for d in (x, y))
    bits_a, bits_b = (Bitmaps(d["bits"].tolist()) for d in (x, y))
    comp_a, comp_b, rep_a, rep_b = x["comp"].to_numpy(), y["comp"].to_numpy(), x["rep"].to_numpy(), y["rep"].to_numpy()
    out_a, out_b, out_least = [], [], []
    for i in range(len(x)):
        ok = could_link(na[i], pa_[i], nb, pb) & (comp_b != comp_a[i])
        if within:
            ok[:i + 1] = False
        j = np.flatnonzero(ok)
        if len(j):
            j = j[within_bound(na[i], bits_a, i, nb[j], bits_b, j)]
            out_a.append(np.full(len(j), rep_a[i]))
            out_b.append(rep_b[j])
            out_least.append(np.minimum(SHARED, need(na[i], nb[j])))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(out_a or none), np.concatenate(out_b or none), np.concatenate(out_least or none)


def _small_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``h, place, rep, comp, bits`` sorted by group, groups of at most ``SMALL`` rows -> possible
    pairs ``a, b, least`` (shingles they must share in their prefixes), once a shingle."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [*(c.to_numpy() for c in batch.columns[:4]), batch.column(4).to_pylist()]
        if held is not None:
            rows = [*(np.concatenate(x) for x in zip(held[:4], rows)), held[4] + rows[4]]
        end = int(np.searchsorted(rows[0], rows[0][-1]))  # the last group may go on
        held = [c[end:] for c in rows]
        yield _pairs_within(*(c[:end] for c in rows))
    if held is not None:
        yield _pairs_within(*held)


def _pairs_within(h, place, rep, comp, bits) -> pa.RecordBatch:
    n, pos, bits = place >> 32, place & 0xFFFFFFFF, Bitmaps(bits)
    out = [[], [], []]
    for d in range(1, len(h)):
        same = np.flatnonzero(h[d:] == h[:-d])
        if not len(same):
            break
        i, j = same, same + d
        ok = (comp[i] != comp[j]) & could_link(n[i], pos[i], n[j], pos[j])
        i, j = i[ok], j[ok]
        ok = within_bound(n[i], bits, i, n[j], bits, j)
        i, j = i[ok], j[ok]
        out[0].append(np.minimum(rep[i], rep[j]))
        out[1].append(np.maximum(rep[i], rep[j]))
        out[2].append(np.minimum(SHARED, need(n[i], n[j])))
    none = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or none)) for x in out], names=["a", "b", "least"])


def _enough(pairs: DataFrame) -> DataFrame:
    """Pairs found under as many shingles as linked sets share at least."""
    return (pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"))
            .where("n >= least").select("a", "b"))


def _tiles(groups: DataFrame, block: int) -> DataFrame:
    """Pairs ``a, b, least`` of large open groups ``h, place, rep, comp, bits`` that tiles can't rule out."""
    order = Window.partitionBy("h").orderBy("place", "rep")
    rows = groups.withColumn("blk", F.floor((F.row_number().over(order) - 1) / block).cast("int"))
    rows = written(rows, "blocks")
    size = F.shiftright("place", 32)
    blocks = rows.groupBy("h", "blk").agg(F.min(size).alias("lo"), F.max(size).alias("hi"))
    i = blocks.select("h", F.col("blk").alias("i"), F.col("hi").alias("hi_i"))
    j = blocks.select("h", F.col("blk").alias("j"), F.col("lo").alias("lo_j"))
    tiles = i.join(j, "h").where("i <= j and 4 * hi_i >= 3 * lo_j").select("h", "i", "j")
    left = rows.join(tiles, (rows["h"] == tiles["h"]) & (rows["blk"] == tiles["i"])).select(
        rows["*"], "i", "j", F.lit(0).alias("side"))
    right = rows.join(tiles.where("i < j"), (rows["h"] == tiles["h"]) & (rows["blk"] == tiles["j"])).select(
        rows["*"], "i", "j", F.lit(1).alias("side"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def solve(whole: pd.DataFrame) -> pd.DataFrame:
            got = []
            for _, t in whole.groupby(["h", "i", "j"], sort=False):
                x, y = t[t["side"] == 0], t[t["side"] == 1]
                got.append(tile_pairs(x, y if len(y) or t["i"].iloc[0] != t["j"].iloc[0] else None))
            a, b, least = (np.concatenate(x) for x in zip(*got))
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "least": least})

        for b in batches:  # the last tile of a batch may go on in the next
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            last = b[["h", "i", "j"]].eq(b[["h", "i", "j"]].iloc[-1]).all(axis=1)
            held = b[last]
            if not last.all():
                yield solve(b[~last])
        if held is not None:
            yield solve(held)

    return (left.unionAll(right).select("h", "i", "j", "side", "place", "rep", "comp", "bits")
            .repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "side", "place", "rep")
            .mapInPandas(run, "a long, b long, least long"))


def _signed_of(texts: DataFrame, ids: DataFrame, words: int, label: str = "signed") -> DataFrame:
    """:func:`_signed` of the documents ``ids`` (column ``rep``), as a table."""
    ids = broadcast_if_small(ids, BROADCAST_IDS)
    return written(_signed(texts.join(ids, texts["doc_id"] == ids["rep"], "left_semi"), words), label)


def _owned(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Postings of the groups that still hold several components, with their set's component so far."""
    marked = rows.select("h", "place", "rep").join(label, F.col("rep") == label["node"], "left").select(
        "h", "place", "rep", F.coalesce("component", "rep").alias("comp"))
    still = marked.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("h")
    return written(marked.join(still, "h", "left_semi"), "owned")


def _other_stars(owned: DataFrame, number: int) -> DataFrame:
    """Pairs ``a, b, least`` of each open group's members with another leader, the one whose hash
    is least; a set that leads one group leads most others it is in."""
    lead = (owned.groupBy("h").agg(F.min(F.struct(F.xxhash64("rep", F.lit(number)).alias("x"), "place", "rep", "comp")).alias("l"),
                                   F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo < hi").select("h", F.col("l.place").alias("lp"), F.col("l.rep").alias("lr"), F.col("l.comp").alias("lc")))
    size, lead_size = F.shiftright("place", 32), F.shiftright("lp", 32)
    low = F.lit((1 << 32) - 1)
    met = owned.join(lead, "h").where("comp <> lc").select(
        "rep", "lr", size.alias("n"), lead_size.alias("m"), F.col("place").bitwiseAND(low).alias("p"),
        F.col("lp").bitwiseAND(low).alias("q"), F.floor((3 * (size + lead_size) + 6) / 7).alias("need"))
    near = met.where((4 * F.least("n", "m") >= 3 * F.greatest("n", "m"))
                     & (F.col("p") <= F.col("n") - F.col("need") + SHARED - 1)
                     & (F.col("q") <= F.col("m") - F.col("need") + SHARED - 1))
    return near.select(F.least("rep", "lr").alias("a"), F.greatest("rep", "lr").alias("b"),
                       F.least(F.lit(SHARED), "need").cast("long").alias("least"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).unionAll(pairs.select(F.col("b").alias("rep"))).distinct()


def _links(texts: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The pairs of a written table that link, as a table; the pairs and the sets made for them go."""
    signed = _signed_of(texts, _ends(pairs), words)
    links = written(verified(pairs, signed), "links")
    discard(pairs, signed)
    return links


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                       block: int = BLOCK, small: int = SMALL) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row (smallest doc_id reachable by links)."""
    texts = _texts(docs, key, text)
    frequent = frequent_shingles(texts, words)
    sets = written(_sets(texts, words, frequent), "sets")
    narrow = written(sets.drop("prefix"), "sizes")
    some = narrow.where("n > 0 and doc_id is not null")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    member = written(some.select("doc_id", "digest").join(classes.where("rows > 1"), "digest", "left")
                     .select("doc_id", F.coalesce("rep", "doc_id").alias("rep"),
                             F.when(F.col("doc_id") != F.col("rep"), F.col("digest")).alias("digest")),
                     "classes")
    # by id and set: a repeated id may be a copy with one text and stand for itself with another
    copies = broadcast_if_small(member.where("digest is not null").select("doc_id", "digest").distinct(), BROADCAST_IDS)
    reps = (sets.where("n > 0 and doc_id is not null").join(copies, ["doc_id", "digest"], "left_anti")
            .select(F.col("doc_id").alias("rep"), "n", "prefix"))
    bits = some.join(copies, ["doc_id", "digest"], "left_anti").select(
        F.col("doc_id").alias("rep"), "n", "bits", F.coalesce("wide", "bits").alias("wide"))
    postings = reps.mapInArrow(_postings, "h long, place long, rep long")
    groups = written(postings.repartition("h").sortWithinPartitions("h", "place", "rep")
                     .mapInArrow(_lead, "h long, place long, rep long, leader long, least long"), "groups")
    discard(sets)

    stars = written(_possible(_enough(groups.where("leader is not null").select(
        F.col("leader").alias("a"), F.col("rep").alias("b"), "least")), bits), "stars")
    label = components(_links(texts, stars, words))

    opened = _owned(groups, label)
    discard(groups)
    rows = opened
    for number in range(1, ROUNDS + 1):
        stars = written(_possible(_enough(_other_stars(rows, number)), bits), "stars")
        links = _links(texts, stars, words)
        if not links.limit(1).count():
            break
        label = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(links))
        # the next leaders are tried where this round's have linked something
        joined = rows.join(_ends(links), "rep", "left_semi").select("h").distinct()
        before, rows = rows, _owned(rows.join(joined, "h", "left_semi"), label)
        if number > 1:
            discard(before)
    owned = _owned(opened, label)
    discard(opened)
    size = owned.groupBy("h").agg(F.count(F.lit(1)).alias("rows"))
    few = (owned.join(size.where(F.col("rows") <= small), "h").join(bits.drop("n"), "rep")
           .select("h", "place", "rep", "comp", F.when(F.col("rows") > FEW, F.col("wide")).otherwise(F.col("bits")).alias("bits"))
           .repartition("h").sortWithinPartitions("h", "place", "rep").mapInArrow(_small_pairs, "a long, b long, least long"))
    many = written(owned.join(size.where(F.col("rows") > small).select("h"), "h", "left_semi")
                   .select("h", "place", "rep", "comp"), "large")
    large = many.join(bits.select("rep", F.col("wide").alias("bits")), "rep")
    rest = written(_possible(_enough(few.unionAll(_tiles(large, block))), bits), "pairs")
    more = _links(texts, rest, words)
    final = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    # rows that share a doc_id share a component: their classes hang together by the id
    node = _with_repeats(member, final).select(F.col("node").alias("__node"), F.col("component").alias("__component"))
    return (narrow.select("doc_id", "n").join(node, F.col("doc_id") == F.col("__node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("__component", "doc_id").alias("component_id")))


def _with_repeats(member: DataFrame, final: DataFrame) -> DataFrame:
    """Components of all documents from those of their classes' representatives."""
    own = member.join(final, member["rep"] == final["node"], "left").select(
        "doc_id", F.coalesce("component", "rep").alias("comp"))
    own = written(own, "members")
    lows = own.groupBy("doc_id").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    bridges = lows.where("lo < hi")
    if bridges.limit(1).count():
        joined = components(own.join(bridges.select("doc_id"), "doc_id", "left_semi")
                            .join(bridges.select("doc_id", "lo"), "doc_id")
                            .select(F.col("comp").alias("a"), F.col("lo").alias("b")))
        lows = lows.join(joined, lows["lo"] == joined["node"], "left").select(
            "doc_id", F.coalesce("component", "lo").alias("lo"))
    return lows.select(F.col("doc_id").alias("node"), F.col("lo").alias("component"))
