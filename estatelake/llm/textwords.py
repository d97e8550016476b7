"""Word and shingle hashes of whole texts, without a Python loop over words."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 2**64)
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64; kept up to a size."""
    if len(_powers["up"]) > n:
        return _powers["up"][: n + 1], _powers["down"][: n + 1]
    size = max(n + 1, 1 << 16)
    out = []
    for base in (_P, _P_INV):
        x = np.full(size, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    if size <= 1 << 20:
        _powers["up"], _powers["down"] = out
    return out[0][: n + 1], out[1][: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of byte values times powers of the base; any piece's hash is a difference of two (see piece_hashes)."""
    up, _ = powers(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=out[1:])
    return out


def piece_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end], equal for equal bytes wherever they stand."""
    _, down = powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words [^\\x20\\x09-\\x0D]+ begin and end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def shingles(text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of n words, sorted, and how often each occurs; a shorter text is one shingle."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_bounds(raw)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = piece_hashes(prefix_sums(raw), starts, ends)
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_P_INV) + words[i : len(words) - n + 1 + i]
    return np.unique(mix(out), return_counts=True)
