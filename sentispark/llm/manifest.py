"""Operator 12: Merkle manifest of a dataset, proved by octopus multiproofs.

Every document is a leaf; the leaves of a source form a tree of ``ARITY`` children a node, and
the sources' subroots form the top tree in the same way.  A node is named by its coordinate
``(tree, level, pos)``; ``tree`` is the source's place in the order of sources, ``TOP`` for the
top tree.  All nodes are built by blocks of ``ARITY ** lift`` consecutive ones: a task
climbs ``lift`` levels at once, so there are few exchanges, of narrow rows.

Proofs are made by *leaf partitions*, runs of ``block`` consecutive leaves in global order.
For its leaves a partition computes, level by level, the minimal union of coordinates that it
can neither read nor derive (:func:`missing`); those are fetched in one join with the node
table; all interiors its proofs share are then derived once, and the proofs are expanded
locally.  A source of a third of all rows is many blocks and many leaf partitions.

Defined results: null fields hash as ``-``; a null source is a source of its own, the first; in
a source null ids come first and rows of one id ascend by leaf hash; an untampered text has no
line feeds or belongs to an id whose crc32 is odd or null; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import broadcast_if_small, prepare, written
from sentispark.operators.ranking import global_row_number

ARITY, LIFT, TOP = 3, 7, -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree long, level int, pos long, hash string, n long"
_NODES = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("pos", pa.int64()), ("hash", pa.string()),
                    ("n", pa.int64())])
#: Sources up to this many are joined by broadcast.
BROADCAST_SOURCES = 200_000


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def sizes(n: int) -> list[int]:
    """Nodes on each level of a tree over ``n`` leaves, the last level 1."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def missing(known: dict[int, np.ndarray], n: int) -> list[tuple[int, np.ndarray]]:
    """``(level, positions)`` to fetch for proofs of the leaves ``known[0]`` of a tree of
    ``n``: members of the leaves' runs that are neither given nor derivable from below."""
    have, out = known[0], []
    for level, width in enumerate(sizes(n)[:-1]):
        runs = np.unique(have // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append((level, np.setdiff1d(members[members < width], have, assume_unique=True)))
        have = runs
    return out


def _climb(lift: int):
    """Nodes of the levels above sorted rows ``tree, level, pos, hash, n, width`` (``width``:
    nodes on that level of the tree), at most ``lift`` levels, block by block."""
    def nodes(hashes: list[str], tree: int, level: int, first: int, n: int, width: int) -> Iterator[tuple]:
        for _ in range(lift):
            if width == 1:
                return
            hashes = [digest(hashes[i:i + ARITY]) for i in range(0, len(hashes), ARITY)]
            level, first, width = level + 1, first // ARITY, -(-width // ARITY)
            for i, h in enumerate(hashes):
                yield tree, level, first + i, h, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span, held, out, of = ARITY ** lift, [], [], None
        for b in batches:
            for tree, level, pos, h, n, width in zip(*(c.to_pylist() for c in b.columns)):
                if (block := (tree, level, pos // span * span, n, width)) != of:
                    if held:
                        out += nodes(held, *of)
                    held, of = [], block
                held.append(h)
            if len(out) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _NODES.types)], schema=_NODES)
                out = []
        if held:
            out += nodes(held, *of)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _NODES.types)], schema=_NODES)
    return run


def build_nodes(leaves: DataFrame, most: int, lift: int = LIFT) -> DataFrame:
    """All nodes above ``leaves`` (``tree, pos, hash, n``: leaves of that tree, ``most`` of
    them in the largest) and the leaves themselves, as ``tree, level, pos, hash, n``."""
    at = leaves.select("tree", F.lit(0).alias("level"), "pos", "hash", "n", F.col("n").alias("width"))
    tables, span = [at.drop("width")], ARITY ** lift
    depth, level = len(sizes(most)) - 1, 0
    while level < depth:
        block = F.floor(F.col("pos") / span)
        up = written(at.select("tree", "level", "pos", "hash", "n", "width").repartition("tree", block)
                     .sortWithinPartitions("tree", "pos").mapInArrow(_climb(lift), NODES), "nodes")
        tables.append(up)
        level += lift
        # each level rounds up: as many ceilings as levels
        width = F.col("n")
        for _ in range(level):
            width = F.ceil(width / ARITY).cast("long")
        at = up.where(F.col("level") == level).withColumn("width", width)
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**instead: Column) -> Column:
    return F.sha2(F.encode(F.concat(*[_field(instead.get(f, F.col(f))) for f in FIELDS]), "UTF-8"), 256)


def _coordinates(trees: pd.Series, pos: pd.Series, n: pd.Series, n_top: int) -> Iterator[tuple[int, int, int]]:
    """The coordinates a leaf partition has to fetch."""
    for tree, rows in pd.DataFrame({"tree": trees, "pos": pos, "n": n}).groupby("tree"):
        for level, at in missing({0: np.unique(rows["pos"].to_numpy())}, int(rows["n"].iloc[0])):
            yield from ((int(tree), level, int(p)) for p in at)
    for level, at in missing({0: np.unique(trees.to_numpy())}, n_top):
        yield from ((TOP, level, int(p)) for p in at)


def _ask(n_top: int):
    def run(leaves: pd.DataFrame) -> pd.DataFrame:
        rows = list(_coordinates(leaves["tree"], leaves["pos"], leaves["n"], n_top))
        out = pd.DataFrame(rows, columns=["tree", "level", "pos"])
        out.insert(0, "block", leaves["block"].iloc[0])
        return out
    return run


def _derive(hashes: dict[tuple, str], tree: int, positions: np.ndarray, n: int) -> None:
    """Add to ``hashes`` all interiors above ``positions``: siblings are there already."""
    for level, width in enumerate(sizes(n)[:-1]):
        positions = np.unique(positions // ARITY)
        for p in positions.tolist():
            members = range(p * ARITY, min((p + 1) * ARITY, width))
            hashes[tree, level + 1, p] = digest([hashes[tree, level, m] for m in members])


def _path(hashes: dict[tuple, str], tree: int, pos: int, n: int) -> Iterator[tuple[list[str], list[str]]]:
    """The siblings left and right of the path from a leaf to its root, level by level."""
    for level, width in enumerate(sizes(n)[:-1]):
        first = pos - pos % ARITY
        yield ([hashes[tree, level, m] for m in range(first, pos)],
               [hashes[tree, level, m] for m in range(pos + 1, min(first + ARITY, width))])
        pos //= ARITY


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(n_top: int):
    def run(leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        hashes = {(t, lv, p): h for t, lv, p, h in zip(fetched["tree"], fetched["level"], fetched["pos"], fetched["hash"])}
        hashes.update(((t, 0, p), h) for t, p, h in zip(leaves["tree"], leaves["pos"], leaves["leaf"]))
        subroots: dict[int, str] = {}
        for tree, rows in leaves.groupby("tree"):
            n = int(rows["n"].iloc[0])
            _derive(hashes, tree, rows["pos"].to_numpy(), n)
            subroots[tree] = hashes[tree, len(sizes(n)) - 1, 0]
            hashes[TOP, 0, tree] = subroots[tree]
        _derive(hashes, TOP, leaves["tree"].unique(), n_top)
        root = hashes[TOP, len(sizes(n_top)) - 1, 0]
        out = []
        for doc_id, no_id, tree, pos, n, leaf, now in zip(*(leaves[c] for c in ("doc_id", "no_id", "tree", "pos", "n", "leaf", "tampered"))):
            siblings, folded = [], now
            for walk in (_path(hashes, tree, pos, n), _path(hashes, TOP, tree, n_top)):
                for left, right in walk:
                    siblings += left + right
                    folded = digest([*left, folded, *right])
            out.append((None if no_id else doc_id, leaf, subroots[tree], root, digest(siblings), folded, folded == root))
        got = pd.DataFrame(out, columns=[c.split()[0] for c in PROOFS.split(", ")])
        return got.astype({"doc_id": "Int64"})
    return run


def manifest(docs: DataFrame, lift: int = LIFT) -> tuple[DataFrame, DataFrame, int]:
    """``(leaves, nodes, n_top)``: ranked leaves ``g, tree, pos, n, doc_id, no_id, leaf, tampered``
    (``tampered``: the leaf after the line feeds went, where they did), the table of all nodes ``tree, level, pos, hash, n``, and the number of sources."""
    prepare(docs.sparkSession)
    tamper = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.when(tamper & F.contains("text", F.lit("\n")), leaf_hash(text=F.translate("text", "\n", "")))
    # hashed next to the scan: only these narrow rows are sorted and exchanged
    hashed = written(docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf_hash().alias("leaf"),
                                 cut.alias("tampered")), "hashed")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ranked = global_row_number(hashed, order, "g").withColumn("g", F.col("g") - 1)
    per_source = ranked.groupBy("source").agg(F.min("g").alias("start"), F.count("*").alias("n"))
    sources = written(global_row_number(per_source, [F.col("start")], "tree").withColumn("tree", F.col("tree") - 1), "sources")
    n_top = sources.count()
    most = sources.agg(F.max("n")).head()[0]
    named = broadcast_if_small(sources.withColumnRenamed("source", "of"), BROADCAST_SOURCES)
    leaves = written(ranked.join(named, ranked["source"].eqNullSafe(named["of"])).select(
        "g", "tree", (F.col("g") - F.col("start")).alias("pos"), "n", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"), "leaf", F.coalesce("tampered", "leaf").alias("tampered")), "leaves")
    nodes = build_nodes(leaves.select("tree", "pos", F.col("leaf").alias("hash"), "n"), most or 0, lift)
    depth = F.lit(0)
    for k in range(len(sizes(most or 0)) - 1):
        depth = depth + (F.col("n") > ARITY ** k).cast("int")
    subroots = nodes.where(F.col("level") == depth).select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(n_top).cast("long").alias("n"))
    return leaves, nodes.unionByName(build_nodes(written(subroots, "subroots"), n_top, lift)), n_top


def prove_documents(docs: DataFrame, block: int = 4096, lift: int = LIFT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row,
    by leaf partitions of ``block`` rows."""
    leaves, nodes, n_top = manifest(docs, lift)
    spark = docs.sparkSession
    if not n_top:
        return spark.createDataFrame([], PROOFS)
    blocks = leaves.withColumn("block", F.floor(F.col("g") / block))
    asked = blocks.select("block", "tree", "pos", "n").groupBy("block").applyInPandas(
        _ask(n_top), "block long, tree long, level int, pos long")
    fetched = asked.join(nodes.drop("n"), ["tree", "level", "pos"])
    return (blocks.groupBy("block").cogroup(fetched.groupBy("block")).applyInPandas(_prove(n_top), PROOFS))
