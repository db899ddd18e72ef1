"""Words of many texts at once, in numpy: where they start and end and a 64-bit hash of each.

Texts are taken in chunks of about a megabyte, so memory follows the longest text, not the batch. A word is a run of
ASCII letters, digits and bytes from 0x80 on; ASCII capitals count as small letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
IS_WORD = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
IS_SPACE = (_byte == 32) | ((_byte >= 9) & (_byte <= 13))


def scatter(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s with s[j] - s[i] = sum of (byte + 1) * base^position over [i, j)."""
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


class Words:
    """Words of the texts of one chunk: ``first``, ``last`` (byte offsets, last exclusive), ``of`` (text), ``code`` (hash)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, marks: bool = False):
        """``marks``: runs of other visible characters count as words too."""
        self.data, self.offsets = data, offsets
        low = LOWER[data]
        kind = IS_WORD[data].astype(np.int8)
        if marks:
            kind[(kind == 0) & ~IS_SPACE[data]] = 2
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = kind[1:] != kind[:-1]
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        begin, end = edges[:-1], edges[1:]
        keep = kind[begin] > 0 if len(data) else np.zeros(0, bool)
        self.first, self.last = begin[keep], end[keep]
        self.of = np.searchsorted(offsets, self.first, "right") - 1
        sums = prefix_sums(low)
        _, down = powers(len(data) + 1)
        raw = (sums[self.last] - sums[self.first]) * down[self.first]
        self.code = scatter(raw + (self.last - self.first).astype(np.uint64))
        self.low = low

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.of, minlength=len(self.offsets) - 1)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every n words in a row of one text."""
        if len(self.code) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(len(self.code) - n + 1, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                total = total * _BASE + self.code[j:len(self.code) - n + 1 + j]
        inside = np.flatnonzero(self.of[: len(total)] == self.of[n - 1:])
        return inside, scatter(total[inside])


def chunks(texts: pa.Array, marks: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of consecutive pieces of a string column; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        low, high = offsets[start], offsets[end]
        yield start, end, Words(data[low:high], offsets[start:end + 1] - low, marks)
        start = end
