"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every document has a place on a ring, and so have many virtual nodes of every shard. A document
belongs to the first shard clockwise that still has room; a full shard passes it on. Room is
counted in rows, and the rooms add up to the number of rows, so shard sizes end at most one row
apart, while a changed number of shards moves few documents.

The walk round the ring is planned on a histogram: the ring is cut into `cells`, rows are counted
per cell, and the driver lays at most `cells` counts into shards. A row then only needs its cell
and its rank in the cell; both the shard and the slot follow from the plan.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS, CELLS, NODES = 40, 1 << 16, 256


def cell_of(key: Column, tie: Column, cells: int) -> Column:
    """Place on the ring: of the key, or where that is null, of the tie-breaking column."""
    return F.pmod(F.when(key.isNull(), F.xxhash64(tie)).otherwise(F.xxhash64(key)), F.lit(cells)).cast("int")


def ring(shards: int, cells: int, nodes: int) -> list[tuple[int, int, int]]:
    """Virtual nodes as (cell, node hash, shard), clockwise. A shard's nodes depend on its number
    alone, so one more shard adds nodes and moves none."""
    out = []
    for shard in range(shards):
        for node in range(nodes):
            h = int.from_bytes(hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big")
            out.append((h % cells, h, shard))
    return sorted(out)


def lay_out(counts: dict[int, int], shards: int, cells: int, nodes: int) -> list[tuple[int, int, int, int, int]]:
    """Spans (cell, first rank, end rank, shard, slot of the first rank); together they hold every row."""
    total = sum(counts.values())
    places = ring(shards, cells, nodes)
    at = [p[0] for p in places]
    order = sorted(range(shards), key=lambda s: hashlib.blake2b(f"extra/{s}".encode()).digest())
    room = [total // shards] * shards
    for s in order[:total % shards]:
        room[s] += 1
    used = [0] * shards
    # skip[i]: the next virtual node from i on whose shard may have room (paths are shortened as shards fill)
    skip = list(range(len(places)))

    def find(i: int) -> int:
        path = []
        while room[places[i][2]] == used[places[i][2]] or skip[i] != i:
            path.append(i)
            skip[i] = skip[i] if skip[i] != i else (i + 1) % len(places)
            i = skip[i]
        for j in path:
            skip[j] = i
        return i

    spans = []
    # A scattered order of cells: in ring order the overflow would pile up behind the last ones.
    for cell in sorted(counts, key=lambda c: hashlib.blake2b(f"cell/{c}".encode(), digest_size=8).digest()):
        rank, left = 0, counts[cell]
        i = bisect.bisect_left(at, cell) % len(places)
        while left:
            i = find(i)
            shard = places[i][2]
            n = min(left, room[shard] - used[shard])
            spans.append((cell, rank, rank + n, shard, used[shard]))
            used[shard] += n
            rank, left = rank + n, left - n
    return spans


def assign(docs: DataFrame, key: str = "doc_id", tie: str = "text", shards: int = SHARDS,
           cells: int = CELLS, nodes: int = NODES) -> DataFrame:
    """`docs` with `shard` and `slot` (gapless from 0 in each shard); own columns of these names go.

    Shards differ by one row at most. `tie` orders rows with one key and places rows without a
    key; rows with both null share one cell. Repeated rows are rows of their own. Fewer rows than
    shards leave shards empty; an empty table gives an empty result."""
    if min(shards, cells, nodes) < 1:
        raise ValueError("shards, cells and nodes are positive")
    docs = docs.drop("shard", "slot")
    placed = docs.select(F.struct("*").alias("_doc"), cell_of(F.col(key), F.col(tie), cells).alias("_cell"))
    key, tie = f"_doc.{key}", f"_doc.{tie}"
    counts = {r[0]: r[1] for r in placed.groupBy("_cell").count().collect()}  # at most `cells` rows
    plan = docs.sparkSession.createDataFrame(lay_out(counts, shards, cells, nodes) or [(-1, 0, 0, 0, 0)],
                                             "_at int, _from long, _to long, shard int, _slot long")
    # At most cells + shards spans of 28 bytes: a bound that does not depend on the data.
    ranked = placed.withColumn("_rank", F.row_number().over(
        W.partitionBy("_cell").orderBy(F.xxhash64(key), key, F.xxhash64(tie))).cast("long") - 1)
    joined = ranked.join(F.broadcast(plan), (F.col("_cell") == F.col("_at")) & (F.col("_rank") >= F.col("_from"))
                         & (F.col("_rank") < F.col("_to")))
    return joined.select("_doc.*", "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))
