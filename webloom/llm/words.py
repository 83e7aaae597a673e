"""Words, shingles and column access of Arrow batches as numpy arrays (no per-word Python).

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Every function works on one
*slice* of consecutive texts: their UTF-8 bytes end to end plus row offsets. ``slices`` cuts a
batch into slices of about one megabyte, so temporary arrays stay small whatever the batch holds
(one text longer than that is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse modulo 2**64
_R_INV = pow(_R, -1, 1 << 64)
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of unsigned 64-bit integers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_R))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for slices of the usual length."""
    size = max(n, SLICE_BYTES + 1)
    got = _powers.get(str(base))
    if got is None or len(got) < n:
        got = np.full(size, base, U64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        if size == SLICE_BYTES + 1:
            _powers[str(base)] = got
    return got[:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and n + 1 row offsets; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offs = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Word bounds and hashes of one slice. ``row`` is ascending; ``first`` has n + 1 word offsets by row."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = False):
        self.data, self.offs, self.n = data, offs, len(offs) - 1
        space = SPACE[data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        inner = offs[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        before[inner], after[inner - 1] = True, True
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.row = np.repeat(np.arange(self.n), np.diff(self.first))
        self.count = np.diff(self.first)
        self._lower = lower

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes (A-Z lower-cased first if asked)."""
        data = _LOWER[self.data] if self._lower else self.data
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE[data] * _power(_R, len(data)), out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * _power(_R_INV, len(data) + 1)[self.start]
        return mix(own ^ ((self.end - self.start).astype(U64) << U64(40)))

    def windows(self, size: int, whole_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of ``size`` words inside a row.

        ``whole_short``: a row with 1 to size - 1 words gives its whole sequence as one window.
        """
        h = self.hashes()
        step = [mix(np.array([k + 1], U64))[0] | U64(1) for k in range(size)]
        at = np.flatnonzero(self.row[:len(h) - size + 1] == self.row[size - 1:]) if len(h) >= size else np.zeros(0, int)
        total = np.zeros(len(at), U64)
        for k in range(size):
            total += h[at + k] * step[k]
        out = mix(total)
        if whole_short:
            rows = np.flatnonzero((self.count > 0) & (self.count < size))
            short = np.zeros(len(rows), U64)
            for k in range(size - 1):
                on = self.count[rows] > k
                short[on] += h[self.first[rows[on]] + k] * step[k]
            short = mix(short ^ (self.count[rows].astype(U64) << U64(32)) ^ U64(0xA5A5))
            at, out = np.concatenate([at, self.first[rows]]), np.concatenate([out, short])
            order = np.argsort(at, kind="stable")
            at, out = at[order], out[order]
        return at, out


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
