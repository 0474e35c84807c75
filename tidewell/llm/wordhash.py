"""64-bit hashes of the words of many texts at once, from Arrow's byte buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 20  # bytes of text worked on at a time; a longer text makes a chunk of its own
M1, M2, M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


@lru_cache(2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, b & (1 << 64) - 1, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def chunks(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of texts of about CHUNK bytes; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and off[-1] else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)


def spans(b: np.ndarray, off: np.ndarray, space: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs of bytes other than 0x20 and 0x09 to 0x0D inside one text."""
    word = ~((b == 32) | ((b >= 9) & (b <= 13))) if space is None else ~space
    edge = np.zeros(len(b) + 1, bool)
    edge[off] = True
    before = np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    after = np.empty_like(word)
    after[-1:], after[:-1] = False, word[1:]
    return np.flatnonzero(word & (~before | edge[:-1])), np.flatnonzero(word & (~after | edge[1:])) + 1


class Hasher:
    """Hashes of any byte ranges of one run of texts."""

    def __init__(self, b: np.ndarray):
        self.p, self.q = powers(1 << max(20, int(len(b) + 1).bit_length()))
        self.c = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.p[: len(b)], out=self.c[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.c[end] - self.c[start]) * self.q[start] + (end - start).astype(np.uint64) * M3)


def word_hashes(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin among them."""
    start, end = spans(b, off)
    return Hasher(b)(start, end), np.searchsorted(start, off)


def shingle_sets(col: pa.Array, k: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text its sorted distinct k-word shingles as 64-bit hashes.

    A text of fewer words has one shingle, the whole sequence; one without words has none.
    """
    for i, j, b, off in chunks(col):
        h, at = word_hashes(lower_ascii(b) if lower else b, off)
        full = h.copy()
        with np.errstate(over="ignore"):
            for step in range(1, k):
                full[: len(h) - step] = mix(full[: len(h) - step] * M3 + h[step:])
            for r in range(j - i):
                x, y = at[r], at[r + 1]
                if y - x >= k:
                    yield np.unique(full[x : y - k + 1])
                elif y > x:
                    s = h[x : x + 1].copy()
                    for step in range(x + 1, y):
                        s = mix(s * M3 + h[step : step + 1])
                    yield s + np.uint64(y - x)
                else:
                    yield h[:0]
