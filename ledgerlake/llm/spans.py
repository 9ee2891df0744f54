"""Vectorised text scanning for Python tasks: code points, character classes,
token spans and span hashes of a whole batch at once (numpy, no per-character
Python)."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

LETTER, NUMBER, SPACE, OTHER, EDGE = range(5)

# The Unicode White_Space code points.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = SPACE
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (wraps modulo 2^64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _char_hash() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@dataclass
class Batch:
    """Code points of several texts, one EDGE position after each text.

    ``first[d]`` and ``end[d]`` bound text ``d`` in ``cp``."""

    cp: np.ndarray
    kind: np.ndarray
    first: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "Batch":
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        cp = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        end = np.cumsum(lens + 1) - 1
        kind = classes()[cp]
        kind[end] = EDGE
        return cls(cp, kind, end - lens, end)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Start positions of runs of equal class, and the class of each run
        (an EDGE is a run of its own)."""
        k = self.kind
        at = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (k[1:] == EDGE))))
        return at, k[at]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each span: equal strings, equal hashes."""
        n = len(self.cp)
        size = 1 << max(16, int(n + 1).bit_length())
        up, down = _powers(size)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_char_hash()[self.cp] * up[:n], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def chunks(texts: list[str], chars: int = 1 << 19):
    """Cut a list of whole texts into (start, stop) slices of about ``chars``
    characters (a longer single text is a slice of its own)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs of letters and numbers, lower case) of a slice of
    texts: the hash of each word in reading order, and the first and last+1
    word index of each text."""
    b = Batch.of([t.lower() for t in texts])
    b.kind[b.kind == NUMBER] = LETTER
    at, kind = b.runs()
    stop = np.append(at[1:], len(b.cp))
    is_word = kind == LETTER
    start, stop = at[is_word], stop[is_word]
    return b.hashes(start, stop), np.searchsorted(start, b.first), np.searchsorted(start, b.end)
