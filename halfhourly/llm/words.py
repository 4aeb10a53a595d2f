"""Word and word-window hashes of many texts at once, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1


@lru_cache(maxsize=1)
def _word_marks() -> np.ndarray:
    """For each code point, whether it belongs to a word: letters, digits, underscore."""
    return np.array([chr(c).isalnum() or c == 95 for c in range(0x110000)], dtype=bool)


def powers(n: int, base: int = _ODD) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    steps = np.full(max(n, 1), base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words, and where each text's words start (one entry more)."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = _word_marks()[codes]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    text_starts = np.cumsum([0] + [len(t) + 1 for t in lowered])
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(first[at]) - 1
    place = at - starts[word]
    values = (codes[at].astype(np.uint64) + np.uint64(1)) * powers(int(place.max()) + 1)[place]
    hashes = _mixed(np.add.reduceat(values, np.flatnonzero(first[at])))
    return hashes, np.searchsorted(starts, text_starts)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row; windows are counted by their first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for step, factor in enumerate(powers(size, 0xD6E8FEB86659FD93)):
        out += words[step:step + n] * factor
    return _mixed(out)


def rolling(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and inverse powers from which ``rolled`` gets a Karp-Rabin hash of any window."""
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(len(words)), dtype=np.uint64, out=sums[1:])
    return sums, powers(len(words), pow(_ODD, -1, _WRAP + 1))


def rolled(state: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    sums, inverse = state
    n = len(sums) - size
    return (sums[size:] - sums[:n]) * inverse[:n]
