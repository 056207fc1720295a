"""Word hashes of whole text columns, computed with numpy over Arrow buffers inside tasks.

A word is a run of bytes other than space, tab, LF, VT, FF and CR. Words are hashed to 64 bits by a
polynomial over random byte values; equal words have equal hashes on every executor.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19  # texts are handled in slices of about this size, a longer text alone
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {}


def mix(x):
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]


def _power(base, n):
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        full = np.full(size, base, dtype=np.uint64)
        full[0] = 1
        have = np.cumprod(full, dtype=np.uint64)
        if size <= CHUNK_BYTES * 2:
            _powers[base] = have
    return have[:n]


def slices(batch, column, limit=CHUNK_BYTES):
    """Row slices of a record batch whose texts have about `limit` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


class Words:
    """Words of a slice: byte spans `start`/`end` into `data`, `hash`, and `ptr[i]:ptr[i+1]` of row i."""

    def __init__(self, column, lower=False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        data = data[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        word = ~_SPACE[data]
        first, last = word.copy(), word.copy()
        if len(data):
            edge = np.zeros(len(data) + 1, dtype=bool)
            edge[offsets] = True
            first[1:] &= ~word[:-1] | edge[1:-1]
            last[:-1] &= ~word[1:] | edge[1:-1]
        self.data, self.rows, self.offsets = data, len(column), offsets
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.ptr = np.searchsorted(self.start, offsets)
        n = len(data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_LOWER if lower else _VALUES)[data] * _power(_BASE, n), out=sums[1:])
        inverse = _power(_INVERSE, n)
        span = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mix(span ^ mix((self.end - self.start).astype(np.uint64)))

    def counts(self):
        return np.diff(self.ptr)

    def row_end(self):
        """End of the own row for every word."""
        return np.repeat(self.ptr[1:], self.counts())

    def grams(self, k):
        """(start index, hash) of every k consecutive words of one row."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        at = np.flatnonzero(np.arange(n) + k <= self.row_end()[:n])
        acc = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            acc *= _STEP
            acc += self.hash[j:j + n]
        return at, mix(acc[at] ^ _U(k))

    def sequence(self, a, b):
        """Hash of the words a..b-1 as one sequence."""
        acc = np.zeros(1, dtype=np.uint64)
        for h in self.hash[a:b]:
            acc = acc * _STEP + h
        return mix(acc ^ _U(b - a))[0]

    def joined(self, keep):
        """Per row, the kept words joined by one space, as memory views."""
        n, kept = len(self.data), np.flatnonzero(keep)
        if not len(kept):
            return [b""] * self.rows
        data, edge = self.data.copy(), np.zeros(n + 1, dtype=np.int8)
        edge[self.start[kept]] += 1
        edge[self.end[kept]] -= 1
        use = np.cumsum(edge[:-1], dtype=np.int8) > 0
        row = np.repeat(np.arange(self.rows), self.counts())[kept]
        space = self.end[kept[:-1]][row[1:] == row[:-1]]  # the white byte after a kept word that another follows
        data[space], use[space] = 32, True
        bounds = np.concatenate(([0], np.cumsum(use)))[self.offsets]
        out = memoryview(data[use])
        return [out[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def string_hashes(column):
    """64-bit hashes of the strings of an array."""
    out = []
    for first in range(0, len(column), 50_000):
        part = column.slice(first, 50_000).cast(pa.large_string())
        bounds = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + len(part) + 1]
        raw = part.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[bounds[0]:bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
        bounds, n = bounds - bounds[0], len(data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * _power(_BASE, n), out=sums[1:])
        inverse = _power(_INVERSE, n + 1)
        out.append(mix((sums[bounds[1:]] - sums[bounds[:-1]]) * inverse[bounds[:-1]] ^ mix(np.diff(bounds).astype(np.uint64))))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def signed(x):
    return x.view(np.int64)


def unsigned(x):
    return np.asarray(x, dtype=np.int64).view(np.uint64)
