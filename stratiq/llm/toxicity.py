"""Toxicity by compression distance.

Two zstandard dictionaries are trained (``zstandard.train_dictionary``), one on
toxic and one on ordinary text.  A text is read in windows of running words,
each window is compressed with both dictionaries, and the difference of the two
compressed lengths is its evidence.  Every window counts: a text's score is a
logistic regression on the shares of its windows with each difference, which is
the calibrated threshold.

Toxic texts are ordinary prose with a few toxic passages, so a dictionary of
their whole text is one of ordinary prose.  The toxic dictionary is therefore
trained on the *stretches* of toxic texts whose byte strings are commoner there
than in ordinary texts, the ordinary one on ordinary texts without them, and
both continue the same trained base of ordinary prose, so that lengths differ
by what is particular to a class.  How much evidence a string needs is chosen
by two-fold validation on the training rows.

Training reads a bounded sample of labelled rows (``max_toxic``,
``max_ordinary`` and ``max_bytes``, chosen by hash of the id); scoring reads
every whole text, in place, without a shuffle and without a cache.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiq.llm.common import slices

WINDOW = 20  # bytes of running words
THRESHOLD = 0.3
#: zstd takes no match that starts in a block's last bytes and stores small
#: blocks raw: a known head and an unknown tail around each window see to it
#: that lengths differ by the window's own matches only.
HEAD = bytes(range(1, 9)) + bytes(range(14, 22))
TAIL = b" " + bytes(range(22, 31))
SPREAD = 10  # differences are clipped to +-SPREAD
LENGTHS = (5, 6, 7, 8)  # bytes of a toxic string
FLOORS = (24.0, 64.0, 192.0)  # evidence a toxic string needs, chosen between on the training rows
FOLDS = 3
VALIDATED = 3  # all toxic rows and one in so many ordinary ones choose the evidence
BASE_BYTES = 8192
SAMPLE_BYTES = 160  # of one training sample of ordinary prose
TRAIN_SAMPLES = 12_000
GROUP = 128  # toxic texts whose strings are counted at once


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """The whole text as runs of words of ``size`` bytes at most; a longer word
    is cut into pieces that overlap by half."""
    out: list[bytes] = []
    held: list[bytes] = []
    n = 0
    for word in words:
        if n + len(word) > size and held:
            out.append(b" ".join(held))
            held, n = [], 0
        if len(word) > size:
            out += [word[i : i + size] for i in range(0, len(word) - size // 2, size // 2)]
        else:
            held.append(word)
            n += len(word) + 1
    if held:
        out.append(b" ".join(held))
    return out


def _compressor(content: bytes):
    params = zstandard.ZstdCompressionParameters(window_log=17, chain_log=14, hash_log=14, search_log=5, min_match=3, target_length=32, strategy=zstandard.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0)
    trained = zstandard.ZstdCompressionDict(content + HEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=params).compress


class Differences:
    """Ordinary minus toxic compressed length of windows."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self._toxic, self._ordinary = _compressor(toxic), _compressor(ordinary)

    def window(self, piece: bytes) -> int:
        block = HEAD + b" " + piece + TAIL
        return len(self._ordinary(block)) - len(self._toxic(block))

    def of(self, words: list[bytes]) -> np.ndarray:
        """Clipped differences of all windows, from 0."""
        pieces = windows(words)
        found = np.fromiter(map(self.window, pieces), np.int64, len(pieces))
        return np.clip(found, -SPREAD, SPREAD) + SPREAD


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # of the share of each clipped difference
    offset: float

    def score(self, differences: np.ndarray) -> float:
        z = float(shares(differences) @ np.array(self.weights)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def shares(differences: np.ndarray) -> np.ndarray:
    """Root of the share of a text's windows that has each difference."""
    return np.sqrt(np.bincount(differences, minlength=2 * SPREAD + 1) / max(1, len(differences)))


def _packed(raw: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` bytes from each position as an integer; 0 where white space is
    among them but for the first."""
    size = len(raw) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    packed = np.zeros(size, np.uint64)
    broken = np.zeros(size, bool)
    for k in range(n):
        packed = (packed << np.uint64(8)) | raw[k : k + size]
        if k:
            broken |= raw[k : k + size] == 32
    packed[broken] = 0
    return packed


def running(text: str | None) -> bytes:
    """The words of a text, each after a blank.  The training sample is held in
    this form: a list of its words takes several times the memory."""
    return b" " + b" ".join(words_of(text))


def _grams(text: bytes, n: int) -> np.ndarray:
    """Distinct ``n``-byte strings without inner white space, as integers."""
    found = np.unique(_packed(np.frombuffer(text, np.uint8), n))
    return found[1:] if len(found) and not found[0] else found


def _shared_grams(texts: list[bytes], n: int) -> np.ndarray:
    """The strings that two texts or more hold, counted over ``GROUP`` texts at a time."""
    grams, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for at in range(0, len(texts), GROUP):
        more, seen = np.unique(np.concatenate([_grams(t, n) for t in texts[at : at + GROUP]]), return_counts=True)
        where = np.searchsorted(grams, more)
        known = np.zeros(len(more), bool)
        known[where < len(grams)] = grams[where[where < len(grams)]] == more[where < len(grams)]
        counts[where[known]] += seen[known]
        grams, counts = np.insert(grams, where[~known], more[~known]), np.insert(counts, where[~known], seen[~known])
    return grams[counts >= 2]


@dataclass(frozen=True)
class Strings:
    """Strings of toxic texts, and in how many texts of each class and fold they stand."""

    grams: list[np.ndarray]  # of each length
    counts: list[np.ndarray]  # (ordinary and toxic, FOLDS, grams)
    sizes: np.ndarray  # texts, (ordinary and toxic, FOLDS)


def strings_of(toxic: list[bytes], ordinary: list[bytes]) -> Strings:
    sizes = np.array([[len(texts[f::FOLDS]) for f in range(FOLDS)] for texts in (ordinary, toxic)])
    found, counted = [], []
    for n in LENGTHS:
        grams = _shared_grams(toxic, n)
        there = np.zeros((2, FOLDS, len(grams)), np.int32)
        for label, texts in enumerate((ordinary, toxic) if len(grams) else ()):
            for i, text in enumerate(texts):
                own = _grams(text, n)
                at = np.searchsorted(grams, own)
                at = at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == own)]
                there[label, i % FOLDS, at] += 1
        found.append(grams)
        counted.append(there)
    return Strings(found, counted, sizes)


def toxic_strings(strings: Strings, folds: list[int], floor: float) -> list[np.ndarray]:
    """For each length, the strings (sorted, as integers) at least twice as
    common in toxic texts with ``floor`` evidence or more."""
    n_ordinary, n_toxic = np.maximum(1, strings.sizes[:, folds].sum(1)).tolist()
    kept = []
    for grams, counts in zip(strings.grams, strings.counts, strict=True):
        ordinary, toxic = counts[:, folds].sum(1)
        ratio = (toxic / n_toxic) / ((ordinary + 1) / n_ordinary)
        value = toxic * np.log(np.maximum(ratio, 1e-9))
        kept.append(grams[(ratio >= 2) & (value >= floor)])
    return kept


def covered(raw: np.ndarray, marks: list[np.ndarray]) -> np.ndarray:
    """Which bytes of a running text lie within a marked string."""
    edge = np.zeros(len(raw) + 1, np.int64)
    for n, known in zip(LENGTHS, marks, strict=True):
        packed = _packed(raw, n)
        if len(known) and len(packed):
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, packed), len(known) - 1)] == packed)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + n, -1)
    return np.cumsum(edge)[:-1] > 0


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    samples = samples[:TRAIN_SAMPLES]
    if sum(map(len, samples)) > 4 * size and len(samples) >= 8:
        try:
            return zstandard.train_dictionary(size, samples, k=24, d=6).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def dictionaries(toxic: list[bytes], ordinary: list[bytes], marks: list[np.ndarray]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary."""
    stretches: list[bytes] = []
    for text in toxic:
        raw = np.frombuffer(text, np.uint8)
        inside = np.diff(np.concatenate([[False], covered(raw, marks), [False]]).astype(np.int8))
        stretches += [raw[a:b].tobytes() for a, b in zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist(), strict=True)]
    samples = [b"".join(stretches[i : i + 8]) for i in range(0, len(stretches), 8)]
    plain: list[bytes] = []
    for text in ordinary:
        raw = np.frombuffer(text, np.uint8)
        clean = np.where(covered(raw, marks), np.uint8(32), raw).astype(np.uint8).tobytes()
        plain += [clean[i : i + SAMPLE_BYTES] for i in range(0, len(clean), SAMPLE_BYTES)]
        if len(plain) >= 2 * TRAIN_SAMPLES:
            break
    size = int(np.clip(8 * sum(map(len, marks)), 512, 4096))
    base = _trained(plain[::2], BASE_BYTES)
    return base + _trained(samples, size), base + _trained(plain[1::2], size)


def train(toxic_texts: list[str], ordinary_texts: list[str]) -> Model:
    """Fit dictionaries and the regression.  With one class missing, every text
    scores the labels' mean."""
    prior = (len(toxic_texts) + 0.5) / (len(toxic_texts) + len(ordinary_texts) + 1)
    flat = Model(b"", b"", (0.0,) * (2 * SPREAD + 1), float(np.log(prior / (1 - prior))))
    if not toxic_texts or not ordinary_texts:
        return flat
    toxic, ordinary = [running(t) for t in toxic_texts], [running(t) for t in ordinary_texts]
    strings = strings_of(toxic, ordinary)
    y = np.array([1] * len(toxic) + [0] * len(ordinary))
    fold = np.concatenate([np.arange(len(toxic)) % FOLDS, np.arange(len(ordinary)) % FOLDS])
    every = np.arange(len(y))
    some = every[np.concatenate([np.zeros(len(toxic), int), np.arange(len(ordinary)) // FOLDS % VALIDATED]) == 0]

    def fitted(floor: float, rows: np.ndarray) -> tuple[np.ndarray, float, float]:
        """Weights, offset and loss; each row is read with dictionaries from the other fold."""
        x = np.zeros((len(y), 2 * SPREAD + 1))
        for f in range(FOLDS):
            others = [k for k in range(FOLDS) if k != f]
            marks = toxic_strings(strings, others, floor * len(others) / FOLDS)
            kept = [[t for i, t in enumerate(texts) if i % FOLDS != f] for texts in (toxic, ordinary)]
            differences = Differences(*dictionaries(*kept, marks))
            for i in rows[fold[rows] == f]:
                x[i] = shares(differences.of((toxic[i] if i < len(toxic) else ordinary[i - len(toxic)]).split()))
        return _logistic(x[rows], y[rows], fold[rows])

    floor = min(FLOORS, key=lambda v: fitted(v, some)[2])
    weights, offset, _ = fitted(floor, every)
    return Model(*dictionaries(toxic, ordinary, toxic_strings(strings, list(range(FOLDS)), floor)), tuple(map(float, weights)), offset)


def _logistic(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights and offset of a ridge logistic regression by damped Newton steps,
    and its mean loss on each fold when fitted on the others."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    design = np.column_stack([(x - mean) / spread, np.ones(len(y))])

    def solve(rows: np.ndarray) -> np.ndarray:
        d, t = design[rows], y[rows]
        beta = np.zeros(design.shape[1])
        beta[-1] = np.log((t.mean() + 1e-9) / (1 - t.mean() + 1e-9))
        ridge = np.eye(len(beta))
        ridge[-1, -1] = 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(d @ beta, -30, 30)))
            weight = p * (1 - p) + 1e-9
            step = np.linalg.solve(d.T @ (d * weight[:, None]) + ridge + 1e-9 * np.eye(len(beta)), d.T @ (t - p) - ridge @ beta)
            beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        return beta

    loss = 0.0
    for f in np.unique(fold):
        if (fold != f).any():
            z = np.clip(design[fold == f] @ solve(fold != f), -30, 30)
            loss += float(np.logaddexp(0, np.where(y[fold == f] == 1, -z, z)).sum())
    beta = solve(np.ones(len(y), bool))
    weights = beta[:-1] / spread
    return weights, float(beta[-1] - weights @ mean), loss / len(y)


def sample(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, max_toxic: int, max_ordinary: int, max_bytes: int) -> tuple[list[str], list[str]]:
    """Toxic and ordinary texts to train on: ids by hash, then sizes, then the
    texts that fit; each step collects what its bound allows and no more."""
    spark = docs.sparkSession
    ident = F.col(id_col)
    known = labels.where(ident.isNotNull() & F.col(label_col).isNotNull() & (F.crc32(ident.cast("string").cast("binary")) % 4 != 2))
    known = known.groupBy(id_col).agg(F.max((F.col(label_col) == 1).cast("int")).alias("__label"))
    picked = []
    for label, most in ((1, max_toxic), (0, max_ordinary)):
        some = known.where(F.col("__label") == label).orderBy(F.xxhash64(id_col), id_col).limit(most)
        picked += [(r[0], r[1], label) for r in some.select(id_col, F.xxhash64(id_col)).collect()]  # at most max_toxic + max_ordinary ids
    if not picked:
        return [], []
    kind = labels.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("__text"))
    ids = spark.createDataFrame([r[:1] for r in picked], f"`{id_col}` {kind}")
    size = F.octet_length("__text").alias("__size")
    sizes = {r[0]: r[1] for r in rows.join(F.broadcast(ids), id_col).groupBy(id_col).agg(F.min(size).alias("size")).collect()}  # a row per picked id
    wanted, total = [], 0
    for i, _, label in sorted(picked, key=lambda r: r[1]):
        if i in sizes and total + sizes[i] <= max_bytes:
            total += sizes[i]
            wanted.append((i, sizes[i], label))
    if not wanted:
        return [], []
    asked = spark.createDataFrame(wanted, f"`{id_col}` {kind}, `__size` int, `__label` int")
    found = rows.select(id_col, "__text", size).join(F.broadcast(asked), [id_col, "__size"]).groupBy(id_col, "__label").agg(F.min("__text").alias("text"))
    texts: tuple[list[str], list[str]] = ([], [])
    for row in found.orderBy(F.xxhash64(id_col), id_col).collect():  # at most max_bytes of text
        texts[row["__label"]].append(row["text"])
    return texts[1], texts[0]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_toxic: int = 2000, max_ordinary: int = 4500, max_bytes: int = 12_000_000) -> Model:
    """Train on a bounded sample of the labelled rows whose crc32(id) mod 4 is not 2.

    The sample is the ``max_toxic`` and ``max_ordinary`` ids with the smallest
    hash, and of these the texts that fit into ``max_bytes``; texts over that
    size are passed over.  Null labels and ids are left out; an id labelled
    both ways counts as toxic; of several texts of one id the shortest (of
    equally short ones the least) is read.  Null texts are empty.  Without
    labelled rows, or with one class only, every text scores the labels' mean.
    Further columns of either table are not read.
    """
    return train(*sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, max_toxic=max_toxic, max_ordinary=max_ordinary, max_bytes=max_bytes))


_LOADED: dict[Model, Differences] = {}


def score(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` from 0 to 1, which depends on the text alone.

    Null and empty texts have no window and score as evidence 0; texts of any
    length are read whole; equal texts score the same; an empty table stays
    empty.  A column that is already named ``score_col`` is replaced.
    """
    docs = docs.drop(score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = _LOADED.get(model)
        if differences is None:
            _LOADED.clear()
            differences = _LOADED[model] = Differences(model.toxic, model.ordinary)
        for batch in slices(batches):
            texts = batch.column(batch.schema.names.index(text_col))
            scores = [model.score(differences.of(words_of(t.as_py()))) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)
