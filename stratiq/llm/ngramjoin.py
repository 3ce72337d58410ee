"""Exact Jaccard self-join of word n-gram sets with prefix trees.

1. *Frequencies.*  How many documents hold each n-gram is counted over all of
   them: tasks send sorted, packed key ranges, which are merged and counted.
   The most frequent n-grams, ``HOT_KEYS`` at most, define the global order:
   by frequency class, rarest first, then by hash.  (Any order is right; this
   one keeps common passages out of the prefixes.)
2. *Classes.*  Documents with equal word sequences are one class, joined once.
3. *Prefixes.*  Two sets that link share one of the first
   ``n - ceil(t n) + 1`` n-grams of each.  Classes meet at their shared prefix
   n-grams; length and position bounds leave few candidates.
4. *Verification in two rounds.*  First every class is compared with the least
   class at each of its n-grams.  Then only classes that did not link up with
   it are compared with the others there, so a large group of near copies is
   not expanded into all its pairs.
5. *Prefix trees.*  A class's candidates, as globally ordered sets (most
   frequent first), form a trie; the class's own set walks it once, so partial
   overlaps are shared, and subtrees whose remaining lengths cannot reach the
   overlap needed are pruned.  The sets are made of the texts' real words, not
   of hashes.  A class with many candidates meets them in several tasks.
6. *Components* of the links give the groups: of ``FEW_LINKS`` at most in one
   pass on the driver, of more by star steps.

Hashes decide what is looked at (equal n-grams have equal hashes, so nothing
is lost); every link is decided on real words.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiq.llm.common import materialise, slices
from stratiq.llm.wordhash import mix, separators, word_hashes
from stratiq.operators.graph import components

HOT_KEYS = 1 << 20
FIRST_LEVEL = 3  # n-grams in fewer than 2**FIRST_LEVEL documents are all alike
WIDE_LEVEL = 10  # prefix groups of n-grams from this level on may be large
RANGE_KEYS = 1 << 20
CHUNK_KEYS = 1 << 20
FILTER_BITS = (20, 28)  # of the bitmap of asked ids: least and most
PROBE_ROWS = 256  # candidates that one task compares with a set
BUFFER_BYTES = 2_000_000
FEW_LINKS = 1 << 16  # that one pass over them on the driver groups
_TABLE = separators()
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def ngram_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text.  A text of fewer words
    has its whole word sequence as its one n-gram, a text without words none."""
    words, counts = word_hashes(texts, _TABLE)
    grams = words[: max(0, len(words) - size + 1)].copy()
    for j in range(1, size):
        grams = mix(grams * _FOLD + words[j : j + len(grams)])
    out = []
    at = 0
    for n in counts.tolist():
        if n >= size:
            a = np.sort(grams[at : at + n - size + 1])
            out.append(a[np.concatenate([[True], a[1:] != a[:-1]])])
        elif n:
            h = np.full(1, n, np.uint64)
            for j in range(at, at + n):
                h = mix(h * _FOLD + words[j : j + 1])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def sequence_key(text: bytes) -> bytes:
    """Stands for a text's word sequence."""
    return hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest()


def planes(values: np.ndarray, width: int) -> bytes:
    """Differences of ``values`` byte plane by byte plane: zero planes compress away."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    wide = np.zeros((raw.shape[1], 8), np.uint8)
    wide[:, :width] = raw.T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64) & np.uint64((1 << (8 * width)) - 1)


class Order:
    """The global order: n-grams' frequency classes (0 for the many rare ones)."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray):
        self.keys, self.levels = keys, levels
        self.coarse = np.zeros(1 << 22, bool)
        self.coarse[keys >> np.uint32(10)] = True

    def of(self, grams: np.ndarray) -> np.ndarray:
        short = (grams >> np.uint64(32)).astype(np.uint32)
        out = np.zeros(len(grams), np.uint8)
        maybe = np.flatnonzero(self.coarse[short >> np.uint32(10)])
        if len(maybe):
            some = short[maybe]
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == some, self.levels[at], 0)
        return out


class _Numbers(dict):
    """Numbers things from 0 in the order in which they are first asked for."""

    def __missing__(self, thing) -> int:
        n = self[thing] = len(self)
        return n


def exact_sets(texts: list[bytes], size: int, order: Order | None = None) -> list[np.ndarray]:
    """The n-gram sets of texts as ascending ranks, equal if and only if the
    n-grams are equal word by word.  Ranks follow the global order, the most
    frequent first, then the hash, then the n-gram."""
    numbers, short = _Numbers(), _Numbers()
    split = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in split])
    words = np.fromiter((numbers[w] for ws in split for w in ws), np.int64, int(counts.sum()))
    n = max(0, len(words) - size + 1)
    code, most = words[:n].copy(), len(numbers)
    for j in range(1, size):
        if most * len(numbers) >= 1 << 62:
            known, code = np.unique(code, return_inverse=True)
            most = len(known)
        code = code * len(numbers) + words[j : j + n]
        most *= len(numbers)
    distinct, first, code = np.unique(code, return_index=True, return_inverse=True)
    hashes, _ = word_hashes(texts, _TABLE)
    grams = hashes[:n].copy()
    for j in range(1, size):
        grams = mix(grams * _FOLD + hashes[j : j + n])
    grams = grams[first]
    level = order.of(grams) if order is not None and len(order.keys) else np.zeros(len(grams), np.uint8)
    rank = np.empty(len(distinct), np.uint32)
    rank[np.lexsort((grams, -level.astype(np.int64)))] = np.arange(len(distinct))
    code = rank[code]
    out = []
    for begin, many, ws in zip((np.cumsum(counts) - counts).tolist(), counts.tolist(), split, strict=True):
        if many >= size:
            out.append(np.unique(code[begin : begin + many - size + 1]))
        else:
            out.append(np.array([len(distinct) + short[tuple(ws)]] if ws else [], np.uint32))
    return out


class PrefixTree:
    """Trie over globally ordered sets.  Sets in lexicographic order, with the
    length each shares with the one before, are the trie's depth-first walk:
    what two neighbours share is their common path from the root."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.sets[:-1], self.sets[1:], strict=True):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared.append(int(differ[0]) if len(differ) else m)

    def overlaps(self, probe: np.ndarray, needed: list[int]) -> Iterator[tuple[int, int]]:
        """(position, overlap) of the sets whose overlap with ``probe`` reaches ``needed``."""
        probe = np.sort(probe)
        along = np.zeros(1, np.int64)  # overlap after each step of the current path
        for i, (own, path) in enumerate(zip(self.sets, self.shared, strict=True)):
            want = needed[self.order[i]]
            known = min(path, len(along) - 1)  # a pruned path ends where it was left
            along = along[: known + 1]
            size, have = known, int(along[-1])
            while size < len(own) and have + min(len(own) - size, len(probe) - have) >= want:
                piece = own[size : size + 128]
                found = probe[np.minimum(np.searchsorted(probe, piece), len(probe) - 1)] == piece
                along = np.concatenate([along, have + np.cumsum(found)])
                size, have = size + len(piece), int(along[-1])
            if size == len(own) and have >= want:
                yield self.order[i], have


_ORDERS: dict[str, Order] = {}


def _order(ordering) -> Order:
    """The order of one run, by the run's own token: workers outlive runs."""
    token, broadcast = ordering
    if token not in _ORDERS:
        _ORDERS.clear()
        keys, levels = broadcast.value
        _ORDERS[token] = Order(np.frombuffer(keys, "<u4"), np.frombuffer(levels, np.uint8))
    return _ORDERS[token]


def _binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def frequent(narrow: DataFrame, size: int, hot_keys: int = HOT_KEYS) -> tuple[np.ndarray, np.ndarray]:
    """Short keys and frequency classes of the most frequent n-grams: all from
    the lowest class on that leaves ``hot_keys`` at most."""
    total = narrow.count()
    bits = min(14, max(3, (total * 512 // RANGE_KEYS).bit_length()))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            if n:
                keys, counts = np.unique(np.concatenate(held), return_counts=True)
                edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(32 - bits))
                rows = [(r, planes(k, 4), planes(c, 4)) for r, (k, c) in enumerate(zip(np.split(keys, edges), np.split(counts, edges), strict=True)) if len(k)]
                yield pa.RecordBatch.from_pydict(dict(zip(("range", "keys", "counts"), map(list, zip(*rows, strict=True)), strict=True)), pa.schema([("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))
            held, n = [], 0

        for batch in slices(batches):
            for a in ngram_sets(_binary(batch.column(1)), size):
                held.append((a >> np.uint64(32)).astype(np.uint32))
                n += len(a)
                if n >= CHUNK_KEYS:
                    yield from flush()
        yield from flush()

    def merge(part: pa.Table) -> pa.Table:
        keys = np.concatenate([unplanes(k, 4) for k in part["keys"].to_pylist()]).astype(np.uint32)
        counts = np.concatenate([unplanes(k, 4) for k in part["counts"].to_pylist()]).astype(np.int64)
        by = np.argsort(keys, kind="stable")
        keys, counts = keys[by], counts[by]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        levels = np.log2(np.add.reduceat(counts, first)).astype(np.int64)
        keys = keys[first]
        found = [(int(v), int((levels == v).sum()), keys[levels == v].astype("<u4").tobytes()) for v in np.unique(levels) if v >= FIRST_LEVEL]
        level, n, packed = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"level": pa.array(level, pa.int32()), "n": pa.array(n, pa.int64()), "keys": pa.array(packed, pa.binary())})

    sent = narrow.mapInArrow(send, "range int, keys binary, counts binary")
    counted = materialise(sent.groupBy("range").applyInArrow(merge, "level int, n long, keys binary"), "frequencies", few=True)
    left, least = hot_keys, None
    for level, n in sorted(counted.groupBy("level").agg(F.sum("n")).collect(), reverse=True):
        if n > left:
            break
        left, least = left - n, level
    if least is None:
        return np.empty(0, np.uint32), np.empty(0, np.uint8)
    rows = counted.where(F.col("level") >= least).collect()  # hot_keys keys at most
    keys = np.concatenate([np.frombuffer(r["keys"], "<u4") for r in rows])
    levels = np.concatenate([np.full(r["n"], min(r["level"], 60), np.uint8) for r in rows])
    by = np.argsort(keys)
    return keys[by], levels[by]


def link_documents(docs: DataFrame, *, size: int = 3, numerator: int = 90, denominator: int = 100, id_col: str = "doc_id", text_col: str = "text", hot_keys: int = HOT_KEYS) -> DataFrame:
    """Link documents with ``denominator * |A & B| >= numerator * |A | B|`` on
    their sets of word ``size``-grams, A-Z lower-cased, and group them.

    Returns one row per row of ``docs``: the id, ``n_shingles``,
    ``component_id`` (least id of the group) and ``class_id`` (least id with an
    equal word sequence).  Texts without words, and nulls, have no n-gram and
    link with nothing.  Rows without an id take no part and get null for both;
    rows that share an id share a group, and so do the groups of their texts.
    Texts of any length are read whole; an empty table gives no rows; further
    columns are not read.
    """
    spark = docs.sparkSession
    num, den = numerator, denominator
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    keys, levels = frequent(narrow, size, hot_keys)
    ordering = (uuid.uuid4().hex, spark.sparkContext.broadcast((keys.astype("<u4").tobytes(), levels.tobytes())))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _order(ordering)
        for batch in slices(batches):
            texts = _binary(batch.column(1))
            sets = ngram_sets(texts, size)
            level = order.of(np.concatenate(sets)) if sets and len(order.keys) else np.zeros(sum(map(len, sets)), np.uint8)
            parts, narrow_counts, at = [], [], 0
            for a in sets:
                lv = level[at : at + len(a)]
                at += len(a)
                if len(a):
                    p = len(a) - -(-num * len(a) // den) + 1
                    if lv.any():
                        by = np.argsort((lv.astype(np.uint64) << np.uint64(58)) | (a >> np.uint64(6)))[:p]
                        a, lv = a[by], lv[by]
                    else:
                        a, lv = a[:p], lv[:p]
                parts.append(a.view(np.int64))
                narrow_counts.append(int((lv < WIDE_LEVEL).sum()))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(sequence_key, texts), pa.binary()), pa.ListArray.from_arrays(offsets, flat), pa.array(narrow_counts, pa.int32())],
                ["doc_id", "n", "sig", "prefix", "n_narrow"],
            )

    schema = "doc_id long, n long, sig binary, prefix array<long>, n_narrow int"
    made = materialise(narrow.mapInArrow(prefixes, schema), "prefixes")
    usable = made.where("n > 0 and doc_id is not null")
    classes = usable.groupBy("sig").agg(F.min(F.struct("doc_id", "n", "prefix", "n_narrow")).alias("r")).select("sig", "r.*").withColumnRenamed("doc_id", "rep")

    entries = classes.select("rep", "n", "n_narrow", F.posexplode("prefix").alias("pos", "key"))
    here = Window.partitionBy("key")
    columns = ["key", "rep", "n", "pos"]
    least = F.min(F.struct("rep", "n", "pos"))
    few = entries.where("pos < n_narrow").select(*columns, least.over(here).alias("c"), F.count(F.lit(1)).over(here).alias("k")).where("k > 1")
    wide = entries.where("pos >= n_narrow")
    many = wide.join(wide.groupBy("key").agg(least.alias("c"), F.count(F.lit(1)).alias("k")).where("k > 1"), "key").select(*columns, "c", "k")
    shared = materialise(few.unionByName(many).drop("k").select(*columns, F.col("c.rep").alias("c_rep"), F.col("c.n").alias("c_n"), F.col("c.pos").alias("c_pos")), "shared", few=True)

    def possible(n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
        """Length bound, and position bound as at the first n-gram in common."""
        lengths = F.least(n1, n2) * den >= F.greatest(n1, n2) * num
        return lengths & (F.least(n1 - p1, n2 - p2) * (den + num) >= (n1 + n2) * num)

    col = F.col
    star = shared.where(col("rep") != col("c_rep")).where(possible(col("n"), col("pos"), col("c_n"), col("c_pos")))
    first = _verified(star.select(col("c_rep").alias("a"), col("rep").alias("b")).distinct(), narrow, ordering, size, num, den)
    first = materialise(first, "links", few=True)
    groups = components(first, few=FEW_LINKS)
    one, other = groups.select(col("node").alias("rep"), col("component").alias("g")), groups.select(col("node").alias("c_rep"), col("component").alias("cg"))
    named = shared.join(one, "rep", "left").join(other, "c_rep", "left").withColumn("g", F.coalesce("g", "rep")).withColumn("cg", F.coalesce("cg", "c_rep"))
    named = materialise(named.select("key", "rep", "n", "pos", "c_rep", "g", (col("g") != col("cg")).alias("apart")), "named", few=True)
    s, o = named.where("apart").alias("s"), named.alias("o")
    meet = (col("s.key") == col("o.key")) & (col("s.g") != col("o.g")) & (col("o.rep") != col("s.c_rep")) & (~col("o.apart") | (col("s.rep") < col("o.rep")))
    rest = s.join(o, meet & possible(col("s.n"), col("s.pos"), col("o.n"), col("o.pos"))).select(col("s.rep").alias("a"), col("o.rep").alias("b"))
    links = groups.where("node <> component").select(col("node").alias("u"), col("component").alias("v")).unionByName(_verified(rest.distinct(), narrow, ordering, size, num, den))
    texts_of = usable.groupBy("doc_id").agg(F.min("sig").alias("one"), F.max("sig").alias("other")).where("one <> other").select("doc_id")
    reps = usable.groupBy("sig").agg(F.min("doc_id").alias("rep"))
    joined = usable.select("doc_id", "sig").join(texts_of, "doc_id").join(reps, "sig").where("doc_id <> rep").select(F.least("doc_id", "rep").alias("u"), F.greatest("doc_id", "rep").alias("v"))
    groups = components(links.unionByName(joined.distinct()), few=FEW_LINKS)

    class_groups = reps.join(groups, col("rep") == col("node"), "left").select("sig", "rep", F.coalesce("component", "rep").alias("component"))
    out = made.select("doc_id", "n", "sig").join(class_groups, "sig", "left")
    empty = col("n") == 0
    return out.select(
        col("doc_id").alias(id_col),
        col("n").alias("n_shingles"),
        F.when(col("doc_id").isNotNull(), F.when(empty, col("doc_id")).otherwise(col("component"))).alias("component_id"),
        F.when(col("doc_id").isNotNull(), F.when(empty, col("doc_id")).otherwise(col("rep"))).alias("class_id"),
    )


def one_per_group(docs: DataFrame, *, size: int = 5, numerator: int = 80, denominator: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of every group of near copies: the one with the
    least id.  Documents without words, and rows without an id, all stay.

    Where ids repeat, every distinct pair of id and text is a document: equal
    pairs are one, of which the row with the least hash stays; different texts
    of an id are grouped by their texts, so that none is lost to its id.
    """
    settings = {"size": size, "numerator": numerator, "denominator": denominator, "text_col": text_col}
    named = docs.where(F.col(id_col).isNotNull())
    if named.groupBy(id_col).count().where("count > 1").isEmpty():
        linked = link_documents(docs, id_col=id_col, **settings)
        gone = linked.where(F.col(id_col) != F.col("component_id")).select(id_col)
        return docs.join(gone, id_col, "left_anti").select(*docs.columns)
    keyed = named.withColumn("__key", F.xxhash64(id_col, text_col))
    linked = link_documents(keyed, id_col="__key", **settings).select("__key", "component_id").distinct()
    least = linked.join(keyed.select("__key", F.col(id_col).alias("__id")).distinct(), "__key").groupBy("component_id").agg(F.min(F.struct("__id", "__key")).alias("least"))
    kept = keyed.join(least.select(F.col("least.__key").alias("__key")), "__key", "left_semi")
    one = Window.partitionBy("__key").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return kept.withColumn("__row", F.row_number().over(one)).where("__row = 1").select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def _candidate_texts(narrow: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``narrow`` whose id is asked for (``rep``), and few others.  A
    bitmap of hashes of the ids, 16 bits for each as far as its greatest size
    allows, tells which texts to send on."""
    asked = ids.count()
    bits = min(max((16 * asked).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    spot = F.pmod(F.xxhash64("rep"), F.lit(1 << bits))
    words = ids.select(spot.alias("spot")).groupBy(F.expr("spot div 32").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(spot, 32) as int))")).alias("b"))
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    for part in words.toArrow().to_batches():  # at most 2**(bits - 5) words
        bitmap[part.column(0).to_numpy()] = (part.column(1).to_numpy() & 0xFFFFFFFF).astype(np.uint32)
    held = narrow.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, "<u4")
        for batch in batches:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["rep", "text"])

    rows = narrow.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)).cast("int").alias("at"))
    return rows.mapInArrow(run, "rep long, text string")


def _verified(pairs: DataFrame, narrow: DataFrame, ordering, size: int, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` that link, as ``u``, ``v``.  Each ``a`` gets its own
    text and its candidates' texts in one run of rows, its own first; one with
    over ``PROBE_ROWS`` candidates gets several runs, in different tasks."""
    pairs = materialise(pairs, "pairs", few=True)
    probes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PROBE_ROWS).cast("int").alias("k"))
    dealt = pairs.join(probes, "a").select("a", F.pmod(F.xxhash64("b"), "k").cast("int").alias("salt"), "b")
    own = probes.select("a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt"), F.col("a").alias("b"))
    asked = dealt.unionByName(own)
    texts = _candidate_texts(narrow, asked.select(F.col("b").alias("rep")).distinct())
    sent = asked.join(texts.select(F.col("rep").alias("b"), "text"), "b")
    runs = sent.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("a") != F.col("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _order(ordering)
        texts: list[bytes] = []
        groups: list[tuple[int, list[int], list[tuple[int, int]]]] = []  # a, its texts, candidates and their texts
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            links: list[tuple[int, int]] = []
            sets = exact_sets(texts, size, order)
            for a, mine, others in groups:
                if others:
                    tree = PrefixTree([sets[t] for _, t in others])
                    for m in mine:
                        needed = [-(-num * (len(sets[m]) + len(sets[t])) // (den + num)) for _, t in others]
                        links.extend((a, others[i][0]) for i, _ in tree.overlaps(sets[m], needed))
            again = [texts[m] for m in groups[-1][1]] if groups else []  # the last group may go on
            if groups:
                groups[:] = [(groups[-1][0], list(range(len(again))), [])]
            texts[:] = again
            held = sum(map(len, again))
            if links:
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        now = None
        for batch in batches:
            for a, salt, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()), strict=True):
                if (a, salt) != now:
                    if held >= BUFFER_BYTES:
                        yield from flush()
                        texts.clear()
                        groups.clear()
                        held = 0
                    now = (a, salt)
                    groups.append((a, [], []))
                elif held >= BUFFER_BYTES and groups[-1][2]:
                    yield from flush()
                at = len(texts)
                texts.append(text.as_py())
                held += len(texts[-1])
                if b == a:
                    groups[-1][1].append(at)
                else:
                    groups[-1][2].append((b, at))
        yield from flush()

    found = runs.select("a", "salt", "b", "text").mapInArrow(run, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
