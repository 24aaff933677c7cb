"""Array helpers that run inside tasks: byte views of Arrow text columns,
word spans, 64-bit word keys, key counting and keyed lookup. They work on
blocks of about a megabyte, so a task's memory does not follow its input."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
LONG = 256

#: Byte classes: ASCII white space (space, tab to carriage return) is False.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def text_blocks(column: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of whole texts of about ``block``
    bytes; a longer text is a run of its own. A null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, "right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``inside`` that stay within one text."""
    n = len(inside)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * _MUL
    return x ^ (x >> np.uint64(29))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_tables: dict[str, np.ndarray] = {"up": _powers(BLOCK, _BASE), "down": _powers(BLOCK, _INVERSE)}


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each span's bytes: a polynomial in an odd base, read
    off prefix sums (so the cost is a few passes over the bytes), then mixed.

    Modulo 2^64 such polynomials agree on certain long strings whatever the
    base (of 1,024 bytes and more), so spans of over ``LONG`` bytes are hashed
    one by one with BLAKE2b instead."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        hi = int(ends[j - 1])
        n = hi - lo
        up, down = (_tables["up"], _tables["down"]) if n <= BLOCK else (_powers(n, _BASE), _powers(n, _INVERSE))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _MUL)
        i = j
    for k in np.flatnonzero(ends - starts > LONG):
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


class Counter64:
    """Counts of 64-bit keys with an array of values that follows each key;
    ``add`` gives back a table to emit whenever it holds over ``limit`` keys."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None, *extra: np.ndarray) -> tuple | None:
        if len(keys):
            self.parts.append((keys, np.ones(len(keys), np.int64) if counts is None else counts, *extra))
            self.held += len(keys)
        if self.held <= 2 * self.limit:
            return None
        merged = self._merge()
        if len(merged[0]) > self.limit:
            return self.drain(merged)
        self.parts, self.held = [merged], len(merged[0])
        return None

    def _merge(self) -> tuple:
        cols = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        keys, first, inverse = np.unique(cols[0], return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=cols[1], minlength=len(keys)).astype(np.int64)
        return (keys, counts, *(c[first] for c in cols[2:]))

    def drain(self, merged: tuple | None = None) -> tuple | None:
        if merged is None and self.parts:
            merged = self._merge()
        self.parts, self.held = [], 0
        return merged


class KeyTable:
    """Open-addressing map from distinct 64-bit keys to their row numbers,
    built and probed with whole-array steps."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.bits = max(4, int(2 * n).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        self.slot_key = np.zeros(1 << self.bits, np.uint64)
        self.slot_row = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(n)
        at = self._home(keys)
        while len(todo):
            free = self.slot_row[at] < 0
            take, first = np.unique(at[free], return_index=True)
            rows = todo[free][first]
            self.slot_row[take], self.slot_key[take] = rows, keys[rows]
            left = self.slot_row[at] != todo
            todo, at = todo[left], (at[left] + np.uint64(1)) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _BASE) >> np.uint64(64 - self.bits)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where it is unknown."""
        at = self._home(keys)
        row = self.slot_row[at]
        out = np.where((row >= 0) & (self.slot_key[at] == keys), row, -1)
        todo = np.flatnonzero((row >= 0) & (out < 0))
        at = at[todo]
        while len(todo):
            at = (at + np.uint64(1)) & self.mask
            row = self.slot_row[at]
            hit = (row >= 0) & (self.slot_key[at] == keys[todo])
            out[todo[hit]] = row[hit]
            more = (row >= 0) & ~hit
            todo, at = todo[more], at[more]
        return out
