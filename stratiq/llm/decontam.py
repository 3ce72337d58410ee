"""Benchmark decontamination with SimHash windows and multi-index Hamming search.

Every benchmark item gets a SimHash fingerprint of its words.  Documents are
read in windows as long as an item, at every word; a window's fingerprint comes
from prefix sums of its words' bit votes.  Fingerprints are cut into four
blocks of 16 bits.  Two fingerprints within ``radius`` bits agree in one block
up to ``radius // 4`` bits, so posting lists of the items at every block value
within that distance find all of them; the whole distance is then taken of
those few.  Each pair that is left is compared exactly: weighted Jaccard
similarity of word shingles, weights being occurrence counts.

Two exact bounds keep the work small.  A window needs ``least`` times an item's
shingles in common with it, so windows with fewer shingles of any item are not
fingerprinted; and of an item's windows those that may be best are compared
first.  An item that shares enough shingles with a text but was not found by
its fingerprints is compared at every window that may hold it, so that no near
copy is lost to the radius; ``distance`` tells how far the reported window is.

A benchmark up to ``SECTION_BYTES`` (its size is taken first) is broadcast and
the corpus is read once.  A larger one first leaves, in one scan of the corpus
with a bitmap of fixed size, the texts that hold shingles of it; these are
written down and compared with one section of the benchmark after the other.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiq.llm.common import materialise, slices
from stratiq.llm.wordhash import mix, separators, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 14
BITS = 64
BLOCKS = 4
SECTION_BYTES = 4_000_000
BITMAP_BITS = 27
CHUNK_WORDS = 1 << 15
PUNCTUATION = b"!\"'(),.:;?[]"
_TABLE = separators(PUNCTUATION)
_TO_SPACE = bytes(32 if c in PUNCTUATION else c for c in range(256))
SCHEMA = "doc_id {id}, item_id long, similarity double, start_word long, n_words long, distance int"


def words_of(text: str | None) -> list[bytes]:
    """Words: runs of bytes that are neither white space nor ASCII punctuation, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()


def shingles(words: list[bytes], size: int = SHINGLE) -> Counter:
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: sum of least over sum of greatest counts."""
    common = sum((a & b).values())
    union = sum(a.values()) + sum(b.values()) - common
    return common / union if union else 0.0


def hashes_of(words: list[bytes]) -> np.ndarray:
    return word_hashes([b" ".join(words)], _TABLE)[0]


def grams_of(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each start."""
    made = np.zeros(len(starts), np.uint64)
    for k in range(size):
        made = made * np.uint64(0x9E3779B97F4A7C15) + (hashes[starts + k] ^ (made >> np.uint64(29)))
    return made


def votes(hashes: np.ndarray) -> np.ndarray:
    """(words, 64): +1 where the word's hash has the bit, else -1."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int8) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """A bit where the votes are positive; ties count as positive."""
    return np.packbits(sums >= 0, axis=1, bitorder="little").view("<u8").ravel()


def nearby(bits: int, distance: int) -> np.ndarray:
    """All ``bits``-bit numbers with ``distance`` ones at most."""
    return np.array([sum(1 << b for b in ones) for n in range(distance + 1) for ones in itertools.combinations(range(bits), n)], np.uint64)


class HammingIndex:
    """Finds all of a set of fingerprints within ``radius`` bits of others."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        width = BITS // BLOCKS
        around = nearby(width, radius // BLOCKS)
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        for b in range(BLOCKS):
            shift = np.uint64(b * width)
            values = (((prints >> shift) & np.uint64((1 << width) - 1))[:, None] ^ around[None, :]).ravel().astype(np.uint16)
            order = np.argsort(values, kind="stable")
            first = np.zeros((1 << width) + 1, np.int64)
            np.cumsum(np.bincount(values, minlength=1 << width), out=first[1:])
            self.tables.append((shift, first, (order // len(around)).astype(np.int32)))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of positions in ``prints`` and of own fingerprints that share a posting."""
        mine, own = [], []
        for shift, first, owners in self.tables:
            values = ((prints >> shift) & np.uint64(0xFFFF)).astype(np.int64)
            begin, many = first[values], first[values + 1] - first[values]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            own.append(owners[np.repeat(begin, many) + within])
            mine.append(np.repeat(np.arange(len(prints)), many))
        return np.concatenate(mine), np.concatenate(own)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs within the radius, each once, and their distances."""
        mine, own = self.candidates(prints)
        far = np.bitwise_count(prints[mine] ^ self.prints[own])
        close = far <= self.radius
        pairs, at = np.unique(mine[close] * len(self.prints) + own[close], return_index=True)
        return pairs // max(1, len(self.prints)), pairs % max(1, len(self.prints)), far[close][at]


def _by_owner(owners: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each owner with its values, in the order in which they stand."""
    order = np.argsort(owners, kind="stable")
    found, cuts = np.unique(owners[order], return_index=True)
    if len(found):
        yield from zip(found.tolist(), np.split(values[order], cuts[1:]), strict=True)


class BenchmarkIndex:
    """Items with their fingerprints, posting lists and shingles."""

    def __init__(self, items: list[tuple[int, str]], shingle: int = SHINGLE, least: float = SIMILARITY, radius: int = RADIUS):
        self.shingle, self.least = shingle, least
        self.items = [(i, w) for i, t in items if (w := words_of(t))]
        self.sets = [shingles(w, shingle) for _, w in self.items]
        self.lengths = np.array([len(w) for _, w in self.items], np.int64)
        self.prints = np.array([fingerprints(votes(hashes_of(w)).sum(0, dtype=np.int32)[None, :])[0] for _, w in self.items], np.uint64)
        self.index = HammingIndex(self.prints, radius)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        holders: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for n, (_, w) in enumerate(self.items):
            size = min(shingle, len(w))
            grams = np.unique(grams_of(hashes_of(w), np.arange(len(w) - size + 1), size))
            holders[size].append((grams, np.full(len(grams), n)))
        for size, held in holders.items():
            grams, owners = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(grams, kind="stable")
            distinct, first = np.unique(grams[order], return_index=True)
            coarse = np.zeros(1 << 20, bool)
            coarse[distinct >> np.uint64(44)] = True
            self.grams[size] = (distinct, np.append(first, len(order)), owners[order], coarse)

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(text, item, similarity, first word, words, distance) of the best window for each item found."""
        if not self.items:
            return
        hashes, counts = word_hashes(texts, _TABLE)
        ends = np.cumsum(counts)
        hits = {}  # per shingle size: the words at which a known shingle begins, and which it is
        for size, (distinct, _, _, coarse) in self.grams.items():
            grams = grams_of(hashes, np.arange(max(0, len(hashes) - size + 1)), size)
            maybe = np.flatnonzero(coarse[grams >> np.uint64(44)])
            at = np.minimum(np.searchsorted(distinct, grams[maybe]), len(distinct) - 1)
            same = distinct[at] == grams[maybe]
            hits[size] = (maybe[same], at[same])
        some = np.zeros(len(texts), bool)
        for places, _ in hits.values():
            some[np.searchsorted(ends, places, "right")] = True
        for i in np.flatnonzero(some).tolist():
            begin, end = int(ends[i] - counts[i]), int(ends[i])
            own = {}
            for size, (places, at) in hits.items():
                lo, hi = np.searchsorted(places, [begin, max(begin, end - size + 1)])
                own[size] = (places[lo:hi] - begin, at[lo:hi])
            for found in self._matches(hashes[begin:end], texts[i], own):
                yield (i, *found)

    def _needed(self, n: int) -> int:
        """How many of an item's shingles a text must hold."""
        return math.ceil(self.least * (self.lengths[n] - min(self.shingle, self.lengths[n]) + 1) - 1e-9)

    def _holding(self, hits: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
        """Items that share enough shingles with a text: the words at which these begin."""
        out = {}
        for size, (places, at) in hits.items():
            _, first, owners, _ = self.grams[size]
            many = first[at + 1] - first[at]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items, where = owners[np.repeat(first[at], many) + within], np.repeat(places, many)
            out |= {n: w for n, w in _by_owner(items, where) if len(w) >= self._needed(n)}
        return out

    def _matches(self, hashes: np.ndarray, text: bytes, hits: dict[int, tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, float, int, int, int]]:
        total = len(hashes)
        holding = self._holding(hits)
        if not holding:
            return []
        words = words_of(text.decode("utf-8", "surrogatepass"))
        by_length: dict[int, list[int]] = defaultdict(list)
        for n in holding:
            by_length[int(self.lengths[n])].append(n)
        best: dict[int, tuple[float, int, int, int]] = {}
        for length, members in by_length.items():
            span, size = min(length, total), min(self.shingle, length)
            inner, own = span - size + 1, length - size + 1
            places = np.unique(np.concatenate([holding[n] for n in members]))
            starts = np.arange(max(0, places[0] - inner + 1), min(total - span, places[-1]) + 1)
            known = np.searchsorted(places, starts + inner) - np.searchsorted(places, starts)
            starts = starts[known >= math.ceil(self.least * own - 1e-9)]
            close: dict[int, list[np.ndarray]] = defaultdict(list)
            for at, prints in self._prints(hashes, starts, span):
                mine, items, far = self.index.near(prints)
                right = self.lengths[items] == length
                for n, w in _by_owner(items[right], at[mine[right]]):
                    close[n].append(w)
            for n in members:
                windows = np.concatenate(close[n]) if n in close else np.empty(0, np.int64)
                found = self._best(n, np.sort(windows), holding[n], words, span) or self._best(n, starts, holding[n], words, span)
                if found:
                    s, start = found
                    print_ = next(self._prints(hashes, np.array([start]), span))[1]
                    best[n] = (s, start, span, int(np.bitwise_count(print_ ^ self.prints[n])[0]))
        return [(self.items[n][0], *found) for n, found in sorted(best.items())]

    def _prints(self, hashes: np.ndarray, starts: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and fingerprints of the windows, a stretch of the text at a time."""
        for part in np.split(starts, np.flatnonzero(np.diff(starts // CHUNK_WORDS)) + 1):
            if len(part):
                lo = int(part[0])
                sums = np.zeros((int(part[-1]) + span - lo + 1, BITS), np.int32)
                np.cumsum(votes(hashes[lo : int(part[-1]) + span]), axis=0, dtype=np.int32, out=sums[1:])
                for few in np.array_split(part, -(-len(part) // 4096)):
                    yield few, fingerprints(sums[few + span - lo] - sums[few - lo])

    def _best(self, n: int, starts: np.ndarray, places: np.ndarray, words: list[bytes], span: int) -> tuple[float, int] | None:
        """The best of an item's windows, the first of equals; those that may be best come first."""
        size = min(self.shingle, int(self.lengths[n]))
        inner, own = span - size + 1, int(self.lengths[n]) - size + 1
        common = np.searchsorted(places, starts + inner) - np.searchsorted(places, starts)
        bound = common / np.maximum(own + inner - common, 1)
        best: tuple[float, int] | None = None
        for i in np.argsort(-bound, kind="stable"):
            if bound[i] < max(self.least, best[0] if best else 0.0) - 1e-9 or (best and best[0] == 1.0):
                break
            start = int(starts[i])
            s = similarity(shingles(words[start : start + span], self.shingle), self.sets[n])
            if s >= self.least and (best is None or (s, -start) > (best[0], -best[1])):
                best = (s, start)
        return best


_INDEXES: dict[str, BenchmarkIndex] = {}


class _Section:
    """A part of the benchmark, broadcast; its index is built once in a worker."""

    def __init__(self, spark, items: list[tuple[int, str]], shingle: int, least: float, radius: int):
        self.token, self.settings = uuid.uuid4().hex, (shingle, least, radius)
        self.items = spark.sparkContext.broadcast(items)

    def index(self) -> BenchmarkIndex:
        if self.token not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[self.token] = BenchmarkIndex(self.items.value, *self.settings)
        return _INDEXES[self.token]


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Items with an id and a text, and how many sections their bytes make."""
    items = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return items, max(1, -(-size // SECTION_BYTES))


def _sections(items: DataFrame, n: int, settings: tuple[int, float, int]) -> Iterator[_Section]:
    """The items by hash of their text, one section on the driver at a time."""
    spot = F.pmod(F.xxhash64("text"), F.lit(n))
    for k in range(n):
        rows = (items if n == 1 else items.where(spot == k)).orderBy("item_id", "text").collect()  # about SECTION_BYTES
        yield _Section(items.sparkSession, [(r[0], r[1]) for r in rows], *settings)


def _bitmap(items: DataFrame, shingle: int) -> tuple[np.ndarray, int]:
    """Two bits for every shingle of the benchmark in a bitmap of fixed size, and
    the least number of its shingles that any text must hold."""
    rows_per, width = 1 << 16, BITMAP_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spots, fewest = [], []
            for text in _texts(batch.column(1)):
                hashes = word_hashes([text], _TABLE)[0]
                if len(hashes):
                    size = min(shingle, len(hashes))
                    spots.append(_spots(grams_of(hashes, np.arange(len(hashes) - size + 1), size), width).ravel())
                    fewest.append(len(hashes) - size + 1 if size == shingle else 0)
            if spots:
                every = np.unique(np.concatenate(spots))
                blocks, cuts = np.unique(every // rows_per, return_index=True)
                held = [np.bincount(part % rows_per, minlength=rows_per).astype(bool) for part in np.split(every, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([np.packbits(h).tobytes() for h in held], pa.binary()), pa.array([min(fewest)] * len(held), pa.int64())], ["block", "bits", "fewest"])

    def merge(part: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(b.as_buffer(), np.uint8) for b in part["bits"].combine_chunks()])
        return pa.table({"block": [part["block"][0].as_py()], "bits": pa.array([bits.tobytes()], pa.binary()), "fewest": [min(part["fewest"].to_pylist())]})

    schema = "block long, bits binary, fewest long"
    out = np.zeros((1 << width) // 8, np.uint8)
    fewest = []
    for r in items.mapInArrow(run, schema).groupBy("block").applyInArrow(merge, schema).toLocalIterator():  # the bitmap's blocks
        out[r["block"] * rows_per // 8 : (r["block"] + 1) * rows_per // 8] = np.frombuffer(r["bits"], np.uint8)
        fewest.append(r["fewest"])
    return out, min(fewest, default=0)


def _spots(grams: np.ndarray, width: int) -> np.ndarray:
    return np.stack([x >> np.uint64(64 - width) for x in (mix(grams), mix(grams ^ np.uint64(0x9E3779B97F4A7C15)))]).astype(np.int64)


def _touched(docs: DataFrame, at: int, items: DataFrame, shingle: int, least: float) -> DataFrame:
    """The rows whose text (column ``at``) may hold enough shingles of an item."""
    width = BITMAP_BITS
    bits, fewest = _bitmap(items, shingle)
    held = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    needed = max(1, math.ceil(least * fewest - 1e-9))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(held.value, np.uint8)
        for batch in slices(batches):
            hashes, counts = word_hashes(_texts(batch.column(at)), _TABLE)
            ends = np.cumsum(counts)
            keep = np.zeros(batch.num_rows, bool)
            for size in (shingle,) if fewest else range(1, shingle + 1):
                spots = _spots(grams_of(hashes, np.arange(max(0, len(hashes) - size + 1)), size), width)
                known = ((bitmap[spots >> 3] >> (7 - (spots & 7)).astype(np.uint8)) & 1).all(axis=0)
                upto = np.concatenate([[0], np.cumsum(known)])
                upto = np.pad(upto, (0, len(hashes) + 1 - len(upto)), "edge")
                keep |= upto[ends] - upto[ends - counts] >= needed
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Pairs of document and benchmark item of which the document holds a near copy.

    One row per row of ``docs`` and item found: the id, ``item_id``,
    ``similarity`` of the best window, its ``start_word`` and ``n_words``, and
    the ``distance`` of its fingerprint to the item's.  Null and empty texts
    and items match nothing; an item shorter than a shingle is one shingle;
    ties go to the first window.  Texts of any length are read whole, a stretch
    at a time; repeated rows give repeated results, empty tables none; further
    columns of either table are not read.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(id=docs.schema[id_col].dataType.simpleString())
    items, n = _items(benchmark, item_col, item_text_col)
    if n > 1:
        narrow = materialise(_touched(narrow, 1, items, shingle, least), "touched", few=True)
    found = None
    for section in _sections(items, n, (shingle, least, radius)):

        def run(batches: Iterator[pa.RecordBatch], section=section) -> Iterator[pa.RecordBatch]:
            index = section.index()
            for batch in slices(batches):
                hits = list(index.matches(_texts(batch.column(1))))
                if hits:
                    rows, *values = zip(*hits, strict=True)
                    cols = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c) for c in values[:-1]), pa.array(values[-1], pa.int32())]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "similarity", "start_word", "n_words", "distance"])

        part = narrow.mapInArrow(run, schema)
        part = part if n == 1 else materialise(part, "contaminated", few=True)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("doc_id", id_col)


def uncontaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` in which :func:`contaminated` finds no item, all columns
    as they are.  Null and empty texts stay, and so does every row where the
    benchmark is empty; repeated rows stay or go together.  Nothing is shuffled
    unless the benchmark takes several sections."""
    items, n = _items(benchmark, item_col, item_text_col)
    if n > 1:
        digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
        found = contaminated(docs.select(digest.alias("__digest"), F.col(text_col).alias("text")), items, id_col="__digest", shingle=shingle, least=least, radius=radius)
        return docs.withColumn("__digest", digest).join(found.select("__digest").distinct(), "__digest", "left_anti").select(*docs.columns)
    at = docs.columns.index(text_col)
    section = next(_sections(items, 1, (shingle, least, radius)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = section.index()
        for batch in slices(batches):
            keep = np.ones(batch.num_rows, bool)
            for hit in index.matches(_texts(batch.column(at))):
                keep[hit[0]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
