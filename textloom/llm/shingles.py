"""Word shingle sets of many texts at once, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True

_powers = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n at least."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for k, b in enumerate((BASE, INVERSE)):
            p = np.full(size, U(b), dtype=U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' words (A-Z lower-cased, parted by ASCII white space) in one row; the
    first word of each text and one past the last; each word's first and last byte + 1 in its text."""
    parts = [t.encode() for t in texts]
    raw = np.frombuffer(b" ".join(parts).translate(LOWER) + b" ", dtype=np.uint8)
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    power, inverse = powers(len(raw) + 1)
    space = IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    first, last = edge[::2], edge[1::2]  # a space ends the buffer, so the ends pair up
    sums = np.zeros(len(raw) + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * power[: len(raw)], out=sums[1:])
    words = mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(U))
    bounds = np.searchsorted(first, starts)
    home = np.repeat(starts[:-1], np.diff(bounds))
    return words, bounds, first - home, last - home


def shingle_sets(texts: list[str], k: int = 5) -> list[np.ndarray]:
    """Each text's distinct k-word shingles; all words as one with fewer; none without words."""
    words, bounds, _, _ = word_hashes(texts)
    grams = np.zeros(max(0, len(words) - k + 1), dtype=U)
    for i in range(k):
        grams = grams * U(0xD6E8FEB86659FD93) + words[i : i + len(grams)]
    grams = mix(grams)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            h = b - a
            for w in words[a:b].tolist():
                h = (h * 0xA0761D6478BD642F + w) % (1 << 64)
            out.append(mix(np.array([h], dtype=U)))
        else:
            out.append(np.zeros(0, dtype=U))
    return out


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a set, equal for equal sets."""
    if not len(s):
        return 0
    total = np.array([s.sum(dtype=U), np.bitwise_xor.reduce(mix(s)), len(s)], dtype=U)
    h = mix(mix(mix(total[:1]) + total[1:2]) + total[2:])
    return int(h.view(np.int64)[0])
