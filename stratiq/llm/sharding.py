"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every row hashes to one of ``2**cell_bits`` ring cells; each shard owns
``vnodes`` cells.  A row belongs to the first virtual node clockwise from its
cell.  A shard takes rows only up to its capacity, what overflows continues
clockwise to the next virtual node whose shard still has room.

Only row *counts per cell* (at most ``2**cell_bits`` numbers, whatever the
input) reach the driver, where the ring is walked once.  The walk yields
segments ``(cell, first rank, end rank) -> (shard, first slot)``; rows get
their rank inside their cell by a window over narrow rows and pick their
segment by a join with that bounded table.  Texts are never shuffled.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 14
VNODES = 64
COPIES = 1024  # of one repeated row that stand in one array


def ring_points(n_shards: int, vnodes: int, cell_bits: int) -> list[tuple[int, int]]:
    """Sorted ``(cell, shard)`` of all virtual nodes; a shard's points do not
    depend on how many other shards there are."""
    points = []
    for shard in range(n_shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(digest, "big") >> (64 - cell_bits), shard))
    return sorted(points)


def capacities(n_rows: int, n_shards: int, slack: float) -> list[int]:
    """Rows each shard may take.  Without slack they add up to exactly
    ``n_rows`` and differ by one at most, so filling them balances the shards."""
    base, extra = divmod(n_rows, n_shards)
    return [int((base + (s < extra)) * (1 + slack) + (slack > 0)) for s in range(n_shards)]


def walk_ring(counts: dict[int, int], n_shards: int, vnodes: int, cell_bits: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """Segments ``(cell, start, end, shard, slot)`` for the given rows per cell."""
    points = ring_points(n_shards, vnodes, cell_bits)
    room = capacities(sum(counts.values()), n_shards, slack)
    used = [0] * n_shards
    follow = list(range(len(points)))  # the next virtual node whose shard may have room

    def free(v: int) -> int:
        path = []
        while True:
            while follow[v] != v:
                path.append(v)
                v = follow[v]
            if room[points[v][1]]:
                break
            path.append(v)
            follow[v] = (v + 1) % len(points)
            v = follow[v]
        for p in path:
            follow[p] = v
        return v

    segments: list[tuple[int, int, int, int, int]] = []

    def place(cell: int, start: int, end: int, shard: int) -> int:
        taken = min(end - start, room[shard])
        if taken:
            segments.append((cell, start, start + taken, shard, used[shard]))
            room[shard] -= taken
            used[shard] += taken
        return start + taken

    overflow = []
    at = 0
    for cell in sorted(counts):
        while at < len(points) and points[at][0] < cell:
            at += 1
        owner = at % len(points)
        start = place(cell, 0, counts[cell], points[owner][1])
        if start < counts[cell]:
            overflow.append((cell, start, owner))
    for cell, start, owner in overflow:
        while start < counts[cell]:
            start = place(cell, start, counts[cell], points[free(owner)][1])
    return segments


def shard_rows(df: DataFrame, n_shards: int, *, id_col: str = "doc_id", text_col: str = "text", slack: float = 0.0, vnodes: int = VNODES, cell_bits: int = CELL_BITS) -> DataFrame:
    """Put every row of ``df`` into a shard.

    Returns one row per input row: the id, ``size`` (UTF-8 bytes plus 16),
    ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``slack=0`` makes capacities exact: shard row counts are at most one apart.
    A positive slack allows ``1 + slack`` times the mean and moves fewer rows
    when shards come or go.

    Null texts count as empty (size 16).  Rows whose id is null hash by size
    and checksum.  Identical rows are interchangeable: they are counted before
    any shuffle and each copy gets a slot of its own, written out
    piece by piece.  Of texts of any length only size and checksum are read on.  An
    empty input gives an empty result; extra columns of ``df`` are not read.
    """
    if n_shards < 1 or slack < 0:
        raise ValueError("n_shards must be positive and slack not negative")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("__id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    spot = F.when(F.col("__id").isNull(), F.xxhash64("size", "text_crc32")).otherwise(F.xxhash64("__id"))
    rows = rows.withColumn("__spot", spot).withColumn("__cell", F.shiftrightunsigned("__spot", 64 - cell_bits).cast("int"))

    counts = {r[0]: r[1] for r in rows.groupBy("__cell").count().collect()}  # at most 2**cell_bits rows
    segments = walk_ring(counts, n_shards, vnodes, cell_bits, slack)
    spark = df.sparkSession
    schema = "cell int, start long, end long, shard int, base long"
    seg = spark.createDataFrame(pd.DataFrame(segments, columns=["cell", "start", "end", "shard", "base"]), schema) if segments else spark.createDataFrame([], schema)

    copies = rows.groupBy("__cell", "__spot", "__id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__cell").orderBy("__spot", "__id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = copies.withColumn("__first", F.sum("__n").over(before) - F.col("__n"))
    runs = ranked.withColumn("__from", F.explode(F.expr(f"sequence(__first, __first + __n - 1, {COPIES})")))
    each = runs.select("*", F.explode(F.expr(f"sequence(__from, least(__from + {COPIES}, __first + __n) - 1)")).alias("__rank"))
    found = each.join(F.broadcast(seg), (F.col("__cell") == F.col("cell")) & (F.col("__rank") >= F.col("start")) & (F.col("__rank") < F.col("end")))
    return found.select(F.col("__id").alias(id_col), "size", "text_crc32", "shard", (F.col("base") + F.col("__rank") - F.col("start")).alias("slot"))
