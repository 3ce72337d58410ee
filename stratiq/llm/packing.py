"""Conflict-constrained best-fit packing of documents into fixed-size bins.

A document longer than a bin is cut into full pieces and a rest; every piece
goes into the open bin with the smallest residual that it fits into, provided
that the bin holds no piece of the same source and none of the same duplicate
cluster.  Bins are ordered by residual and carry bitmaps of their sources and
duplicate clusters; the successor search starts at the piece's size and
continues upward until a compatible bin is found, else a bin is opened.

Best-fit is sequential, so pieces are dealt by hash into blocks of bounded
size which are packed on their own: only ids, sizes and cluster hashes are
shuffled, and the bins a block leaves partly filled are its only extra cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 8192
BLOCK_ROWS = 8192
SCHEMA = "doc_id long, piece long, size long, cluster long, bin_id long, bin_offset long"


class BestFitBins:
    """Open bins by residual.  At each residual, bins with the same source and
    cluster bitmaps are one entry, so a search tests each combination once."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.at: list[dict[tuple[int, int], list[int]] | None] = [None] * (capacity + 1)
        self.common: list[int] = [0] * (capacity + 1)  # sources held by all entries of a residual
        self.filled = 0  # bit r: some bin has residual r
        self.used: list[int] = []

    def _put(self, bin_id: int, residual: int, sources: int, clusters: int) -> None:
        entries = self.at[residual]
        if not entries:
            self.at[residual] = {(sources, clusters): [bin_id]}
            self.common[residual] = sources
            self.filled |= 1 << residual
        else:
            entries.setdefault((sources, clusters), []).append(bin_id)
            self.common[residual] &= sources

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece into the tightest compatible bin; returns bin and offset."""
        rest = self.filled >> size
        residual = size
        while rest:
            step = (rest & -rest).bit_length() - 1
            residual += step
            if not self.common[residual] & source:
                entries = self.at[residual]
                for key, bins in entries.items():
                    if not (key[0] & source or key[1] & cluster):
                        bin_id = bins.pop()
                        if not bins:
                            del entries[key]
                            if not entries:
                                self.filled ^= 1 << residual
                        offset = self.used[bin_id]
                        self.used[bin_id] += size
                        if residual > size:
                            self._put(bin_id, residual - size, key[0] | source, key[1] | cluster)
                        return bin_id, offset
            rest >>= step + 1
            residual += 1
        bin_id = len(self.used)
        self.used.append(size)
        if size < self.capacity:
            self._put(bin_id, self.capacity - size, source, cluster)
        return bin_id, 0


def _bits(codes: np.ndarray, shared_only: bool) -> list[int]:
    """A one-bit mask per row; with ``shared_only``, values that occur once need none."""
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    index = np.cumsum(counts > 1) - 1 if shared_only else np.arange(len(counts))
    return [1 << int(index[i]) if not shared_only or counts[i] > 1 else 0 for i in inverse]


def pack_block(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each row, taken in the given order.  Source code 0 means none."""
    source_bits = _bits(sources, False)
    bins = BestFitBins(capacity)
    placed = [bins.place(int(n), s if code else 0, c) for n, s, code, c in zip(sizes, source_bits, sources, _bits(clusters, True), strict=True)]
    out = np.array(placed, dtype=np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """Pack all documents into bins of ``capacity`` bytes.

    A document takes its UTF-8 bytes plus one for its end mark; null and empty
    texts take one.  ``cluster_col`` names the duplicate cluster (equal texts
    are one cluster by default).  A null source conflicts with nothing.

    Returns one row per piece: the id, ``piece`` (from 0), ``size``,
    ``cluster``, ``bin_id`` and ``bin_offset`` (bytes into the bin).  Repeated
    rows are packed one by one, in different bins, as they are one cluster.
    Of pieces of equal size the smaller id comes first.  The block of a piece
    depends on its content and the number of blocks alone; blocks that exceed
    twice ``block_rows`` are packed in sections of exactly so many pieces, so
    memory is bounded.  A text of any length is cut into pieces; only sizes and
    hashes are read on.  An empty table gives no rows; columns other than the
    three named are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cluster = F.col(cluster_col).cast("long") if cluster_col else F.xxhash64(text)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("bytes"),
        F.when(F.col(source_col).isNull(), F.lit(0)).otherwise(F.xxhash64(source_col)).alias("source"),
        F.coalesce(cluster, F.xxhash64(text)).alias("cluster"),
    )
    pieces = narrow.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("bytes") - 1) / capacity).cast("long"))))
    pieces = pieces.withColumn("size", F.least(F.lit(capacity).cast("long"), F.col("bytes") - F.col("piece") * capacity)).drop("bytes")
    total = narrow.select(F.sum(F.ceil(F.col("bytes") / capacity))).head()[0] or 0
    blocks = max(1, -(-int(total) // block_rows))
    dealt = pieces.repartition(blocks, "doc_id", "piece", "cluster").sortWithinPartitions(F.desc("size"), "doc_id", "piece", "cluster", "source")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, n
            if n:
                t = pa.Table.from_batches(held).combine_chunks()
                bins, offsets = pack_block(*(t[c].to_numpy() for c in ("size", "source", "cluster")), capacity)
                cols = {c: t[c] for c in ("doc_id", "piece", "size", "cluster")} | {"bin_id": pa.array(bins + first), "bin_offset": pa.array(offsets)}
                yield from pa.table(cols).to_batches()
                first += int(bins.max()) + 1
            held, n = [], 0

        for batch in batches:
            at = 0
            while at < batch.num_rows:  # sections end at fixed row numbers, whatever the batches
                part = batch.slice(at, 2 * block_rows - n)
                held.append(part)
                n += part.num_rows
                at += part.num_rows
                if n == 2 * block_rows:
                    yield from flush()
        yield from flush()

    return dealt.mapInArrow(pack, SCHEMA).withColumnRenamed("doc_id", id_col)
