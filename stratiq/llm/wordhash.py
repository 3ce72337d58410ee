"""Hashes of all words of many texts at once, without a Python step per word.

A word's hash is its bytes as a polynomial over the 64-bit integers: one prefix
sum over the bytes of all texts gives it for every word, divided by the power
of the position at which the word begins (the base is odd, so it has an
inverse).
"""

from __future__ import annotations

import numpy as np

BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 19
#: Fixed value: the white space that separates words.
SPACE = b"\t\n\x0b\x0c\r "
_POWERS = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def separators(extra: bytes = b"") -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACE + extra)] = True
    return table


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS[base]
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hash(raw: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the positions at which the words begin."""
    data = np.frombuffer(raw, np.uint8)
    apart = np.ones(len(data) + 2, bool)
    apart[1:-1] = table[data]
    turn = np.flatnonzero(apart[1:] != apart[:-1])
    begin, end = turn[::2], turn[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * _powers(BASE, len(data)), out=sums[1:])
    return mix((sums[end] - sums[begin]) * _powers(INVERSE, len(data) + 1)[begin]), begin


def word_hashes(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and how many words each text has."""
    hashes, counts = [], []
    group: list[bytes] = []
    size = 0

    def flush() -> None:
        if group:
            found, begin = _hash(b"\n".join(group).lower(), table)
            first = np.cumsum([0] + [len(t) + 1 for t in group])
            hashes.append(found)
            counts.append(np.diff(np.searchsorted(begin, first)))
            group.clear()

    for text in texts:
        group.append(text)
        size += len(text)
        if size >= CHUNK:
            flush()
            size = 0
    flush()
    if not counts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)
