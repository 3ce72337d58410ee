"""Exact top-k inner-product search over a bit-sliced index.

Vectors are quantised to integers.  The index holds blocks of rows; in a block
every attribute is a set of bit slices, bitmaps with one bit per row.  A query
adds the slices of all attributes, weighted by its own bits, with carry-save
and ripple adders on whole bitmaps, which yields the bit slices of all scores
at once.  Reading these from the most significant slice downward selects rows
that are surely among the k best and leaves a boundary set of equal scores,
which is resolved exactly by the smaller id.

The index is written once and its blocks stay where they are: queries go to
them in rounds, as a broadcast of ``ROUND_BYTES`` at most.  A task keeps the
``k`` best rows of every query over all its blocks, so what is shuffled is
``k`` rows a query and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiq.llm.common import materialise

BLOCK_ROWS = 8192
ROUND_BYTES = 32_000_000
INDEX_FILES = 10_000
INDEX = "block long, n long, dim long, low long, bits long, ids binary, slices binary"


def quantised(embedding: str, scale: int):
    """floor(scale * x) of every component, x as double."""
    return F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(embedding: str):
    """Not null, and every component a finite number."""
    bad = F.exists(F.col(embedding), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(embedding).isNotNull() & ~bad


def slice_block(values: np.ndarray, low: int, bits: int) -> np.ndarray:
    """(dim, bits, words): bit b of ``values - low``, 64 rows a word."""
    n, dim = values.shape
    words = -(-n // 64)
    shifted = (values - low).astype(np.uint64)
    out = np.zeros((dim, bits, words), np.uint64)
    for b in range(bits):
        plane = np.zeros((dim, words * 64), np.uint8)
        plane[:, :n] = ((shifted >> np.uint64(b)) & np.uint64(1)).T
        out[:, b] = np.packbits(plane, axis=1, bitorder="little").view("<u8")
    return out


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ripple-carry sum of two slice stacks (bits, words)."""
    if len(a) < len(b):
        a, b = b, a
    out = np.empty((len(a) + 1, a.shape[1]), np.uint64)
    carry = np.zeros(a.shape[1], np.uint64)
    for i in range(len(a)):
        x = a[i]
        if i < len(b):
            half = x ^ b[i]
            out[i] = half ^ carry
            carry = (x & b[i]) | (half & carry)
        else:
            out[i] = x ^ carry
            carry = x & carry
    out[len(a)] = carry
    return out if carry.any() else out[:-1]


def _sum(stacks: np.ndarray) -> np.ndarray:
    """Sum of stacks (m, bits, words).  Carry-save adders take three numbers to
    two, all thirds at once, until two are left for the ripple adder."""
    while len(stacks) > 2:
        m = len(stacks) // 3
        a, b, c = stacks[:m], stacks[m : 2 * m], stacks[2 * m : 3 * m]
        half = a ^ b
        bits = stacks.shape[1] + 1
        out = np.zeros((2 * m + len(stacks) - 3 * m, bits, stacks.shape[2]), np.uint64)
        np.bitwise_xor(half, c, out=out[:m, :-1])
        np.bitwise_or(a & b, half & c, out=out[m : 2 * m, 1:])
        out[2 * m :, :-1] = stacks[3 * m :]
        stacks = out
    return stacks[0] if len(stacks) == 1 else _add(stacks[0], stacks[1])


def score_slices(slices: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Bit slices of a number that orders rows as their inner product with the
    query does: attributes with negative weights enter complemented."""
    size = np.abs(query)
    mine = np.where((query < 0)[:, None, None], ~slices, slices)
    total = np.zeros((1, slices.shape[2]), np.uint64)
    for b in range(int(size.max()).bit_length() - 1, -1, -1):
        total = np.concatenate([np.zeros((1, total.shape[1]), np.uint64), total])  # twice
        chosen = mine[(size >> b) & 1 == 1]
        if len(chosen):
            total = _add(total, _sum(chosen))
    return total


def best_rows(scores: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows among ``alive``, from the top slice down;
    of the boundary rows, which tie in every slice, the first ones."""
    sure = np.zeros_like(alive)
    maybe = alive.copy()
    need = k
    count = int(np.bitwise_count(maybe).sum())
    for plane in scores[::-1]:
        if count <= need:
            break
        ones = maybe & plane
        n = int(np.bitwise_count(ones).sum())
        if n <= need:
            sure |= ones
            need -= n
            maybe &= ~plane
            count -= n
            if not need:
                maybe[:] = 0
                break
        else:
            maybe, count = ones, n
    positions = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    return np.concatenate([positions(sure), positions(maybe)[:need]])


def search_block(ids: np.ndarray, slices: np.ndarray, low: int, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of one block (rows by ascending id) for every query."""
    n = len(ids)
    full = np.packbits(np.pad(np.ones(n, np.uint8), (0, slices.shape[2] * 64 - n)), bitorder="little").view("<u8")
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    dim, bits, _ = slices.shape
    powers = 1 << np.arange(bits, dtype=np.int64)
    for qid, query in zip(query_ids, queries, strict=True):
        alive = full.copy()
        for p in range(int(np.searchsorted(ids, qid)), int(np.searchsorted(ids, qid, "right"))):
            alive[p // 64] &= ~(np.uint64(1) << np.uint64(p % 64))
        rows = best_rows(score_slices(slices, query), alive, k)
        taken = (slices[:, :, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        values = (taken.astype(np.int64) * powers[None, :, None]).sum(1) + low
        out.append((np.full(len(rows), qid), ids[rows], query @ values))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def best_of(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of each query, of (query, row, score) from several blocks."""
    query, row, score = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], row[keep], score[keep]


def top_k(vectors: DataFrame, *, k: int = 5, query_step: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """For every row whose id is divisible by ``query_step``: its ``k`` best
    other rows by integer inner product, ties to the smaller id.

    Returns ``query_id, rank, vec_id, score``.  Rows whose id or vector is
    null, or that hold a null or non-finite component, take no part; shorter
    vectors, empty ones too, count as padded with zeros.  A row that repeats
    an id is one more candidate, but not for queries of that id; as a query, an
    id stands once, with its least vector.  Equal rows beyond the ``k``-th
    cannot be among the ``k`` best and are counted, not sent.  An empty table
    gives no rows; further columns are not read.  Scores that may leave the
    64-bit integers raise a ``ValueError``.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), quantised(vector_col, scale).alias("v"))
    asks = F.col("id") % query_step == 0
    facts = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v")), F.count_if(asks)).head()
    total, dim, low, high, n_queries = facts
    schema = "query_id long, vec_id long, score long"
    if not n_queries:
        return spark.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    dim, low, high = max(dim, 1), min(low or 0, 0), max(high or 0, 0)
    if dim * max(-low, high) ** 2 >= 1 << 63:
        raise ValueError(f"components of {max(-low, high)} in {dim} dimensions: scores may not fit 64 bits")
    bits = max(1, int(high - low).bit_length())
    blocks = -(-total // block_rows)
    parts = max(1, spark.sparkContext.defaultParallelism // blocks)  # with few blocks, tasks share out the queries
    rounds = -(-n_queries * dim * 8 // round_bytes)

    def matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
        lists = column.combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        out = np.zeros((n, dim), np.int64)
        out[np.arange(dim)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
        return out

    def pack(block: pa.Table) -> pa.Table:
        block = block.sort_by("id")
        n = block.num_rows
        ids = block["id"].to_numpy().astype("<i8")
        return pa.table({"block": [block["block"][0].as_py()], "n": [n], "dim": [dim], "low": [low], "bits": [bits], "ids": [ids.tobytes()], "slices": [slice_block(matrix(block["v"], n), low, bits).tobytes()]})

    copies = rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
    dealt = copies.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks))).select("block", "id", "v", F.explode(F.expr(f"sequence(1, least(n, {k}))")).alias("copy"))
    index = dealt.drop("copy").groupBy("block").applyInArrow(pack, INDEX)
    index = index.select("n", "ids", "slices", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    index = materialise(index.repartition(min(blocks * parts, INDEX_FILES)), "index")
    queries = rows.where(asks).groupBy("id").agg(F.min("v").alias("v"))
    if rounds > 1:
        queries = materialise(queries, "queries")

    def one_round(r: int) -> DataFrame:
        some = queries if rounds == 1 else queries.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r)
        asked = some.orderBy("id").toArrow()  # about round_bytes
        held = spark.sparkContext.broadcast((asked["id"].to_numpy().astype("<i8"), matrix(asked["v"], asked.num_rows)))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, values = held.value
            best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    n, own, slices, part = (batch.column(c)[i] for c in range(4))
                    part = part.as_py()
                    block = np.frombuffer(slices.as_buffer(), "<u8").reshape(dim, bits, -1)
                    found = search_block(np.frombuffer(own.as_buffer(), "<i8")[: n.as_py()], block, low, ids[part::parts], values[part::parts], k)
                    best[part] = best_of([best[part], found], k) if part in best else found
            for found in best.values():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

        return index.mapInArrow(search, schema)

    found = one_round(0)
    for r in range(1, rounds):
        found = found.unionByName(one_round(r))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
