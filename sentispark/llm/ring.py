"""Operator 1: consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on a 2^32 ring.  A key belongs to the arc
that ends at the next point clockwise.  Shards have capacities; keys that find
the owner of their arc full go on clockwise to the next points until a shard
has room, so balance is guaranteed, and because only overflowing keys move the
assignment stays close to the plain ring's.

At scale the walk is done on counts, not on rows: rows are counted per slice
(an arc cut into ``slices`` hash ranges, times a small salt), the counts -- at most
``shards * vnodes * slices * salts`` numbers, whatever the input -- are pushed
round the ring on the driver, and the resulting intervals of in-slice ranks
are joined back.  Rows move once, as narrow records, to be ranked in their
slice.

Defined results: a null key hashes like the text ``null``; repeated keys share
a ring position and are told apart by size and checksum, wholly identical rows
are interchangeable and spread over salts; an empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentispark.llm.common import written

RING = 1 << 32


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Sorted ``(position, shard)``.  A shard's points depend on its number
    alone, so one more shard only adds points."""
    points = {}
    for shard in range(shards):
        for v in range(vnodes):
            at = int.from_bytes(hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=4).digest(), "big")
            points.setdefault(at, shard)
    return sorted(points.items())


def capacities(rows: int, shards: int, load_bound: float) -> list[int]:
    """Largest row count of each shard: ``load_bound`` times the mean, and never
    less in sum than the rows.  With a bound of 1 the counts differ by at most one."""
    if load_bound <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-(-int(rows * load_bound) // shards) + 1] * shards


def walk(counts: dict[tuple[int, int, int], int], owners: Sequence[int],
         caps: Sequence[int]) -> list[tuple]:
    """Push slice counts round the ring: ``(arc, slice, salt, from_rank, to_rank,
    shard, first_slot)`` for each interval of in-slice ranks.

    Round d offers every arc's remaining rows to the owner of the d-th next
    point; shards admit in ring order until full.  Slices of an arc are offered
    in order, so what overflows is the tail of the arc."""
    room, slot = list(caps), [0] * len(caps)
    arcs: dict[int, list] = {}
    for (arc, sl, salt), n in sorted(counts.items()):
        arcs.setdefault(arc, []).append([sl, salt, 0, n])
    plan, n_points = [], len(owners)
    for d in range(n_points):
        left = False
        for arc in sorted(arcs):
            shard = owners[(arc + d) % n_points]
            for item in arcs[arc]:
                sl, salt, start, end = item
                take = min(room[shard], end - start)
                if take:
                    plan.append((arc, sl, salt, start, start + take, shard, slot[shard]))
                    room[shard] -= take
                    slot[shard] += take
                    item[2] += take
            arcs[arc] = [x for x in arcs[arc] if x[2] < x[3]]
            left = left or bool(arcs[arc])
        if not left:
            return plan
    raise ValueError("capacities are smaller than the rows")


def ring_shards(rows: DataFrame, key: str, shards: int, vnodes: int = 64,
                load_bound: float = 1.0, slices: int = 8, salts: int = 2,
                tie: Sequence[str | Column] = ()) -> DataFrame:
    """``rows`` with ``shard`` int and ``slot`` long (gapless from 0 in a shard).

    ``rows`` should be narrow: it is written once to the shared folder, since
    counts and ranks have to see the same rows.  ``tie`` orders rows of one key."""
    points = ring_points(shards, vnodes)
    ends, owners = [p for p, _ in points], [s for _, s in points]
    spark = rows.sparkSession
    tie_cols = [F.col(c) if isinstance(c, str) else c for c in tie]
    position = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("null"))), 32)
    # searching the fixed ring: bucket by the top byte, then count smaller ends in that byte
    cells = [[] for _ in range(256)]
    for e in ends:
        cells[e >> 24].append(e)
    base = [bisect.bisect_left(ends, c << 24) for c in range(256)]
    ring = F.from_json(F.lit("[" + ",".join("[" + ",".join(map(str, c)) + "]" for c in cells) + "]"),
                       "array<array<bigint>>")
    bases = F.from_json(F.lit(str(base)), "array<int>")
    cell = F.shiftright(F.col("__p"), 24).cast("int")
    below = F.size(F.filter(F.element_at(ring, cell + 1), lambda e: e < F.col("__p")))
    located = (rows.withColumn("__p", position)
               .withColumn("__arc", ((F.element_at(bases, cell + 1) + below) % F.lit(len(ends))).cast("int"))
               .withColumn("__slice", F.pmod(F.col("__p"), F.lit(slices)).cast("int"))
               .withColumn("__salt", F.pmod(F.xxhash64(*tie_cols) + F.spark_partition_id(), F.lit(salts)).cast("int")
                           if tie_cols else F.pmod(F.spark_partition_id(), F.lit(salts)).cast("int")))
    group = ["__arc", "__slice", "__salt"]
    ranked = written(located.withColumn("__rank", F.row_number().over(
        Window.partitionBy(*group).orderBy("__p", key, *tie_cols)).cast("long") - 1), "ring")
    counts = {(r[0], r[1], r[2]): r[3] for r in ranked.groupBy(*group).count().collect()}
    plan = walk(counts, owners, capacities(sum(counts.values()), shards, load_bound))
    steps = spark.createDataFrame(plan, "__arc int, __slice int, __salt int, __from long, __to long, shard int, __slot long")
    hit = ((F.col("r.__arc") == F.col("s.__arc")) & (F.col("r.__slice") == F.col("s.__slice"))
           & (F.col("r.__salt") == F.col("s.__salt"))
           & (F.col("r.__rank") >= F.col("s.__from")) & (F.col("r.__rank") < F.col("s.__to")))
    return (ranked.alias("r").join(F.broadcast(steps).alias("s"), hit)
            .select(*[F.col(f"r.{c}") for c in rows.columns], "s.shard",
                    (F.col("s.__slot") + F.col("r.__rank") - F.col("s.__from")).alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 8, vnodes: int = 64, load_bound: float = 1.0) -> DataFrame:
    """Documents on ``shards`` shards with equal row counts (law ``rows``)."""
    narrow = docs.select(
        "doc_id", F.coalesce(F.octet_length("text") + F.lit(1), F.lit(1)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    out = ring_shards(narrow, "doc_id", shards, vnodes, load_bound, tie=("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
