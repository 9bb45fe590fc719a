"""Words, shingles and their 64-bit hashes over byte arrays."""

from __future__ import annotations

import numpy as np

from .common import Texts

SHINGLE = 5
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space words of all texts, A-Z lower-cased, and each text's bounds in them."""
    data, bounds = texts.data, texts.bounds
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_of_texts = bounds[:-1][bounds[:-1] < len(data)]
    first[starts_of_texts] = inside[starts_of_texts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    powers = _powers(int(lengths.max()))
    with np.errstate(over="ignore"):
        values = _BYTE[data[starts[0] :]] * powers[place]
        values[~inside[starts[0] :]] = 0
        sums = np.add.reduceat(values, starts - starts[0])
    return mixed(sums), np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct ``n``-word shingles of each text; a shorter text's words are one shingle."""
    with np.errstate(over="ignore"):
        if len(hashes) >= n:
            width = len(hashes) - n + 1
            total = np.zeros(width, np.uint64)
            for i in range(n):
                total += hashes[i : i + width] * _STEP[i]
            rolled = mixed(total)
        else:
            rolled = np.zeros(0, np.uint64)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= n:
                s = np.sort(rolled[a : b - n + 1])
                keep = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                out.append(s[keep])
            elif b > a:
                whole = (hashes[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) + _STEP[32 + b - a]
                out.append(mixed(np.array([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on; the last n - 1 positions are left out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    width = len(hashes) - n + 1
    total = np.zeros(width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total += hashes[i : i + width] * _STEP[i]
    return mixed(total)
