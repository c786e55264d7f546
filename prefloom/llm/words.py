"""Words of whole Arrow text columns: byte spans and 64-bit hashes, computed with numpy for many texts at a time.

A word is a longest run of bytes other than the blank and 0x09-0x0D, so UTF-8 needs no decoding. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        table[0] = 1
        table = _powers[int(base)] = np.multiply.accumulate(table)
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


@dataclass
class Words:
    """Words of the texts ``first`` to ``first + len(bounds) - 1``; text i has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    raw: np.ndarray
    first: int
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    text_starts: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def hashes(self, lower: bool) -> np.ndarray:
        """A 64-bit hash of every word; ``lower`` folds A-Z first."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        codes = (_LOWER[self.raw] if lower else self.raw).astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _power_table(_BASE, len(codes)), out=total[1:])
        value = (total[self.ends] - total[self.starts]) * _power_table(_INVERSE, len(codes) + 1)[self.starts]
        return mix(value + (self.ends - self.starts).astype(np.uint64) * _STEP)

    def owner(self) -> np.ndarray:
        """The text, counted from 0 in this slice, of every word."""
        return np.repeat(np.arange(len(self), dtype=np.int64), np.diff(self.bounds))


def word_slices(column: pa.Array, limit: int = SLICE_BYTES, blank: np.ndarray = _BLANK) -> Iterator[Words]:
    """The words of a column, in slices of whole texts of about ``limit`` bytes; ``blank`` marks the bytes between words."""
    raw, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        part, at = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        inner = ~blank[part]
        begins, ends = inner.copy(), inner.copy()
        begins[1:] &= ~inner[:-1]
        ends[:-1] &= ~inner[1:]
        head, tail = at[:-1], at[1:] - 1
        head, tail = head[at[:-1] < at[1:]], tail[at[:-1] < at[1:]]
        begins[head] = inner[head]
        ends[tail] = inner[tail]
        starts = np.flatnonzero(begins)
        yield Words(part, i, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at), at)
        i = j


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbouring words; the caller leaves out runs that cross texts."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        out = out * _BASE + mix(hashes[k:len(out) + k] + np.uint64(k + 1))
    return mix(out)
