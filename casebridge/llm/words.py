"""Words of many texts at once: positions and 64-bit hashes from the bytes of an Arrow column, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER_ASCII = IDENTITY.copy()
LOWER_ASCII[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table of the bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Everything but space and the controls 9 to 13.
NOT_SPACE = ~byte_set((9, 13), (32, 32))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, m in enumerate((MULTIPLIER, _INVERSE)):
            table = np.full(size, m, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    if len(column) == 0:
        ends = np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a larger row stands alone."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """Words of texts ``first`` .. ``last`` of a column: row, start, end (bytes) and hash of each, and of each text its word range."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, fold: np.ndarray = IDENTITY, kinds: np.ndarray | None = None) -> None:
        """``kinds``: bytes of different kinds are different words even side by side."""
        self.bytes = fold[data]
        inside = word_bytes[data]
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if kinds is not None and n:
            k = kinds[data]
            cut[1:n] |= k[1:] != k[:-1]
        if n:
            starts = inside.copy()
            starts[1:] &= ~inside[:-1] | cut[1:n]
            ends = inside.copy()
            ends[:-1] &= ~inside[1:] | cut[1:n]
            self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.of_text = np.searchsorted(self.start, offsets)
        power, inverse = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mixed(raw ^ ((self.end - self.start).astype(np.uint64) << np.uint64(56)))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` words of one text; of the whole text where it has fewer; none without words."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = mixed(out * np.uint64(MULTIPLIER) + words[j : n - width + 1 + j])
    return out
