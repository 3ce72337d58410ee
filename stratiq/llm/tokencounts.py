"""Token counts that follow edits.

A document's text is a sequence of pre-tokens, each of which a byte-level BPE
encodes on its own.  The counts are kept in a segment tree: leaves hold runs of
pre-tokens, inner nodes the sums of characters and tokens below them.  An edit
re-reads only the pre-tokens it touches plus boundary context:

* to the left, from the pre-token that holds the second character before the
  edit (where a pre-token ends depends on two characters after it at most,
  and on none before it);
* to the right, until a new boundary beyond the edit falls on an old one; what
  follows is the same text read from the same place.

The tree is stored per document (piece lengths and counts, 32-bit unsigned),
so counts can be kept up over many rounds of edits.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiq.llm.common import slices

#: Fixed value: the byte-level pre-tokeniser's pattern.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 64
CACHE = 250_000
_SPLIT = regex.compile(PIECES)


class PieceCounts(dict):
    """Pre-token to its number of tokens."""

    def __init__(self, ranks_path: str):
        super().__init__()
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("counts", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        n = len(self._encoding.encode_ordinary(piece))
        if len(self) < CACHE:
            self[piece] = n
        return n

    def of(self, pieces: list[str]) -> list[int]:
        return list(map(self.__getitem__, pieces))


_LOADED: dict[str, PieceCounts] = {}


def counter(path: str) -> PieceCounts:
    if path not in _LOADED:
        _LOADED[path] = PieceCounts(path)
    return _LOADED[path]


class CountTree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self.leaves = [(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(lengths), LEAF)] or [([], [])]
        self._build()

    def _build(self) -> None:
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (lengths, counts) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(lengths), sum(counts)
        for i in range(self.width - 1, 0, -1):
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and where the leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if at >= begin + self.chars[node] and node - self.width < len(self.leaves):
                right = node + 1
                if right >= self.width and right - self.width >= len(self.leaves):
                    continue
                begin += self.chars[node]
                node = right
        return min(node - self.width, len(self.leaves) - 1), begin

    def _set(self, leaf: int) -> None:
        i = self.width + leaf
        self.chars[i], self.tokens[i] = sum(self.leaves[leaf][0]), sum(self.leaves[leaf][1])
        while i > 1:
            i //= 2
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, text: str, at: int, removed: int, inserted: str, counts: PieceCounts) -> tuple[str, int]:
        """Replace ``removed`` characters at ``at`` by ``inserted``; returns the
        new text and how many characters were read again.  Positions beyond
        the text are moved to its end."""
        at = min(max(at, 0), len(text))
        removed = min(max(removed, 0), len(text) - at)
        new = text[:at] + inserted + text[at + removed :]
        if not removed and not inserted:
            return new, 0
        shift = len(inserted) - removed
        leaf, begin = self.find(max(at - 2, 0))
        k = 0
        lengths = self.leaves[leaf][0]
        while k < len(lengths) and begin + lengths[k] <= at - 2:
            begin += lengths[k]
            k += 1
        start, old, last, j = begin, begin, leaf, k
        fresh: list[str] = []
        position = start
        for match in _SPLIT.finditer(new, start):
            fresh.append(match.group())
            position = match.end()
            if position >= at + len(inserted):
                while old < position - shift and last < len(self.leaves):
                    lengths = self.leaves[last][0]
                    if j < len(lengths):
                        old += lengths[j]
                        j += 1
                    if j >= len(lengths):
                        last, j = last + 1, 0
                if old == position - shift:
                    break
        else:
            last, j = len(self.leaves), 0
        head, tail = self.leaves[leaf], self.leaves[last] if last < len(self.leaves) else ([], [])
        sizes = head[0][:k] + [len(p) for p in fresh] + tail[0][j:]
        numbers = head[1][:k] + counts.of(fresh) + tail[1][j:]
        stop = min(last + 1, len(self.leaves))
        touched = stop - leaf
        if touched <= len(sizes) <= 2 * LEAF * touched:  # the same leaves hold what is new: only sums above them change
            cuts = [len(sizes) * i // touched for i in range(touched + 1)]
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                self.leaves[leaf + i] = (sizes[a:b], numbers[a:b])
                self._set(leaf + i)
        else:
            parts = [(sizes[i : i + LEAF], numbers[i : i + LEAF]) for i in range(0, len(sizes), LEAF)]
            self.leaves[leaf:stop] = parts
            if not self.leaves:
                self.leaves = [([], [])]
            self._build()
        return new, position - start

    def dump(self) -> bytes:
        return np.array([[x for leaf in self.leaves for x in leaf[k]] for k in (0, 1)], "<u4").tobytes()

    @staticmethod
    def load(data: bytes) -> CountTree:
        lengths, counts = np.frombuffer(data, "<u4").reshape(2, -1).tolist()
        return CountTree(lengths, counts)


def count_tokens(docs: DataFrame, ranks_path: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``count_tree`` (the stored tree).
    Null texts count as empty; columns of these names are replaced."""
    docs = docs.drop("n_tokens", "count_tree")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("count_tree", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(ranks_path)
        split = _SPLIT.findall
        for batch in slices(batches):
            totals, trees = [], []
            for text in batch.column(batch.schema.names.index(text_col)):
                pieces = split(text.as_py() or "")
                numbers = counts.of(pieces)
                totals.append(sum(numbers))
                trees.append(np.array([list(map(len, pieces)), numbers], "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64()), pa.array(trees, pa.binary())], [*batch.schema.names, "n_tokens", "count_tree"])

    return docs.mapInArrow(run, schema)


def recount(counted: DataFrame, ranks_path: str, *, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """Apply ``edits`` (array of at, removed, inserted; in order, in code points
    of the text as it then is) to rows of :func:`count_tokens`.

    The text, ``n_tokens`` and ``count_tree`` are replaced by those after the
    edits; ``n_reread`` is how many characters were read again, ``n_edits``
    how many edits were made.  Null edits and null insertions are none;
    the result has no ``edits`` column.
    """
    counted = counted.drop("n_reread", "n_edits")
    kept = [f for f in counted.schema.fields if f.name != edits_col]
    schema = T.StructType([*kept, T.StructField("n_reread", T.LongType()), T.StructField("n_edits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(ranks_path)
        for batch in slices(batches):
            names = batch.schema.names
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            texts, totals, trees, reread, made = [], [], [], [], []
            for text, total, stored, edits in zip(cols[text_col], cols["n_tokens"], cols["count_tree"], cols[edits_col], strict=True):
                text, edits, read = text.as_py(), [e for e in edits.as_py() or [] if e], 0
                if edits:
                    tree = CountTree.load(stored.as_py())
                    text = text or ""
                    for e in edits:
                        text, n = tree.edit(text, e["at"] or 0, e["removed"] or 0, e["inserted"] or "", counts)
                        read += n
                    totals.append(tree.n_tokens)
                    trees.append(tree.dump())
                else:
                    totals.append(total.as_py())
                    trees.append(stored.as_py())
                texts.append(text)
                reread.append(read)
                made.append(len(edits))
            cols |= {text_col: pa.array(texts, pa.string()), "n_tokens": pa.array(totals, pa.int64()), "count_tree": pa.array(trees, pa.binary()), "n_reread": pa.array(reread, pa.int64()), "n_edits": pa.array(made, pa.int64())}
            yield pa.RecordBatch.from_arrays([cols[f.name] for f in schema.fields], schema.names)

    return counted.mapInArrow(run, schema)


def sample_edits(text, ident):
    """Three edits per document, fixed by its id: a deletion, a replacement and
    an insertion of a passage of its own."""
    n = F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1))

    def draw(seed: int, most):
        return F.pmod(F.xxhash64(ident, F.lit(seed)), most.cast("long")).cast("int")

    def one(seed: int, removed, inserted):
        return F.struct(draw(seed, n).alias("at"), removed.alias("removed"), inserted.alias("inserted"))

    passage = F.substring(F.coalesce(text, F.lit("")), draw(7, n) + 1, draw(8, F.lit(200)))
    return F.array(
        one(1, draw(2, F.lit(40)), F.lit("")),
        one(3, draw(4, F.lit(12)), F.concat(F.lit("rev "), draw(5, F.lit(10000)).cast("string"))),
        one(6, F.lit(0), passage),
    )
