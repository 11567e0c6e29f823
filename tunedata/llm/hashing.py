"""Vectorised hashes of words, shingles and substrings."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 18  # bytes hashed at a time

# 64-bit constants: odd base of the polynomial, its inverse modulo 2**64, one value per byte.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WEIGHTS = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_values() -> np.ndarray:
    """A value per byte; capital A-Z count as small letters, white space as nothing."""
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[[32, 9, 10, 11, 12, 13]] = 0
    return values


_VALUES = _byte_values()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, count: int) -> np.ndarray:
    known = _POWERS.get(name)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _POWERS[name] = np.multiply.accumulate(steps)
    return known[:count]


def _words_of_piece(data: np.ndarray) -> np.ndarray:
    values = _VALUES[data]
    inside = values != 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _powers("up", _BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers("down", _INVERSE, len(data) + 1)[starts])


def word_hashes(text: bytes | pa.Buffer | None) -> np.ndarray:
    """One uint64 per word of UTF-8 bytes, split at ASCII white space, A-Z lower-cased."""
    data = np.frombuffer(text or b"", np.uint8)
    if len(data) <= PIECE:
        return _words_of_piece(data) if len(data) else np.zeros(0, np.uint64)
    found, begin = [], 0
    blanks = np.flatnonzero(_VALUES[data] == 0)
    while begin < len(data):
        at = np.searchsorted(blanks, begin + PIECE)
        end = int(blanks[at]) + 1 if at < len(blanks) else len(data)
        found.append(_words_of_piece(data[begin:end]))
        begin = end
    return np.concatenate(found)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of ``width`` words in a row, sorted; fewer words count as one sequence."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        weight = _WEIGHTS[i % 64] + np.uint64(2 * (i // 64))
        total += words[i : len(words) - width + 1 + i] * weight
    return np.unique(mix(total))
