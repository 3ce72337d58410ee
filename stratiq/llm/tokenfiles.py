"""Token ids as flat files of unsigned integers with 64-bit document offsets.

Documents are dealt by ranges of their id, so part files in order hold them in
ascending order.  Each part is three flat little-endian files that can be
memory-mapped: ``.bin`` (token ids, unsigned 16 or 32 bits), ``.off`` (unsigned
64-bit offsets of the documents in the part, one more than documents) and
``.ids`` (signed 64-bit document ids).  The manifest (Parquet) has each part's
size and its base: how many ids and documents stand before it, by prefix sums.

A part is written under a name of its task attempt and renamed when complete,
so a task that runs again after a lost executor replaces it whole.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE = 500_000
MANIFEST = "part long, n_docs long, n_tokens long, n_null long, doc_base long, token_base long"
#: Characters beyond the ranges below, and marks of special tokens.
_UNUSUAL = re.compile("[\x00-\x08\x0b-\x1f\x7f-\xa0ɐ-\U0010ffff]|<\\|")
#: The byte-level pre-tokeniser's pattern for texts without such characters:
#: letters and numbers up to U+024F, tab, line feed and space written out.
_LETTER, _NUMBER, _BLANK = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t\n "
PIECES = re.compile(f" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")


class PieceEncoder(dict):
    """Encodes texts to little-endian id bytes with a ``tokenizers`` file.

    A byte-level BPE encodes each piece of its pre-tokeniser on its own, so
    the ids of a piece are worked out once by the library and kept.  Texts with
    unusual characters, and files of any other kind, go to the library whole.
    """

    def __init__(self, path: str, wide: bool):
        super().__init__()
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._code = "I" if wide else "H"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self._by_piece = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True) and spec["model"]["type"] == "BPE" and not spec["model"].get("ignore_merges")
        self._split = PIECES.findall

    def _encode(self, text: str) -> bytes:
        ids = array(self._code, self._tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self._encode(piece)
        if len(self) < CACHE:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self._by_piece and not _UNUSUAL.search(text):
            return b"".join(map(self.__getitem__, self._split(text)))
        return self._encode(text)


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, wide: bool) -> PieceEncoder:
    if (path, wide) not in _ENCODERS:
        _ENCODERS[path, wide] = PieceEncoder(path, wide)
    return _ENCODERS[path, wide]


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write_tokens(docs: DataFrame, out_dir: str, tokenizer_path: str, *, end_id: int = 2, wide: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents into ``out_dir``, which every executor can reach; returns the manifest.

    ``wide`` stores 32-bit ids; otherwise all ids must be below 65,536.
    Null texts are empty: only ``end_id`` is stored.  Repeated ids stand in
    the order of their texts; null ids come first (a part's manifest row says
    how many of its documents have none).  Texts of any length are encoded
    whole.  An empty table gives an empty manifest; columns other than the two
    named are not read.
    """
    narrow = docs.select(F.col(id_col).isNotNull().alias("named"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    order = ["named", "id", F.xxhash64("text")]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, root = _store(out_dir)
        encode = encoder(tokenizer_path, wide).encode
        end = np.array([end_id], "<u4" if wide else "<u2").tobytes()
        width = len(end)
        ids, offsets, at, nulls = array("q"), array("Q", [0]), 0, 0
        first = next(batches, None)
        if first is None:
            return
        store.create_dir(root, recursive=True)
        name = f"{root}/part-{part:08d}"
        with store.open_output_stream(f"{name}.bin.{attempt}") as out:
            batch: pa.RecordBatch | None = first
            while batch is not None:
                nulls += batch.num_rows - batch.column(0).true_count
                ids.extend(batch.column(1).to_pylist())
                for text in batch.column(2):
                    data = encode(text.as_py()) + end
                    out.write(data)
                    at += len(data) // width
                    offsets.append(at)
                batch = next(batches, None)
        for kind, values in (("off", np.array(offsets, "<u8")), ("ids", np.array(ids, "<i8"))):
            with store.open_output_stream(f"{name}.{kind}.{attempt}") as out:
                out.write(values.tobytes())
        for kind in ("bin", "off", "ids"):
            store.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(ids)], "n_tokens": [at], "n_null": [nulls]})

    parts = sorted(tuple(r) for r in dealt.mapInArrow(run, "part long, n_docs long, n_tokens long, n_null long").collect())  # a row per part file
    doc_base = [0, *accumulate(p[1] for p in parts)]
    token_base = [0, *accumulate(p[2] for p in parts)]
    spark = docs.sparkSession
    spark.createDataFrame([(*p, d, t) for p, d, t in zip(parts, doc_base, token_base, strict=False)], MANIFEST).coalesce(1).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


def _mapped(store: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_tokens(spark: SparkSession, out_dir: str, *, wide: bool = False) -> DataFrame:
    """One row per stored document, from its memory-mapped part: ``doc_id``,
    ``start`` (ids before it in all parts), ``n_tokens`` and ``ids_crc32``
    (of its ids as little-endian unsigned 32-bit integers)."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(out_dir)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{root}/part-{row['part']:08d}"
                tokens, offsets, ids = _mapped(store, f"{name}.bin", "<u4" if wide else "<u2"), _mapped(store, f"{name}.off", "<u8"), _mapped(store, f"{name}.ids", "<i8")
                for lo in range(0, len(ids), 8192):
                    off = offsets[lo : lo + 8193].astype(np.int64)
                    crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(off[:-1], off[1:], strict=True)]
                    some = np.asarray(ids[lo : lo + 8192])
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(some, mask=np.arange(lo, lo + len(some)) < row["n_null"]), "start": off[:-1] + row["token_base"], "n_tokens": np.diff(off), "ids_crc32": pa.array(crc, pa.int64())})

    return manifest.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
