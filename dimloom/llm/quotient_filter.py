"""Counting quotient filters of packed id sequences, as numpy arrays.

A sequence of ``n`` ids of ``bits`` bits each is packed into n * bits bits and permuted by a Feistel
network, which can be undone.  The permuted value spreads evenly whatever the ids; its leading bits
are the quotient, the others the remainder, kept whole.  A filter holds the sorted permuted values
with their counts, so it counts exactly, filters over the same shape merge by merging sorted runs,
and every sequence can be read back.

In memory a value is ``top`` (64 bits or fewer) and ``rest`` (what does not fit; None where all fits).
Written to bytes, a filter over one shard (the values that share their first bits) has two bits a
slot for the runs of its quotients, remainders in whole bytes and a byte a count, more only for
counts of 255 or above.  The number of quotients follows the number of values.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
#: Values of a task's filter before it is sent.
FLUSH = 1 << 20


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + U(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shape(NamedTuple):
    """Sequences of ``n`` ids of ``bits`` bits: at most 128 bits in all."""

    n: int
    bits: int

    @property
    def halves(self) -> tuple[int, int]:
        """Bits of the ids of the first and of the second half."""
        return self.bits * (self.n - self.n // 2), self.bits * (self.n // 2)

    @property
    def single(self) -> bool:
        return self.n * self.bits <= 64

    @property
    def top_bits(self) -> int:
        return self.n * self.bits if self.single else self.halves[0]

    @property
    def rest_bits(self) -> int:
        return 0 if self.single else self.halves[1]


def _rounds(left: np.ndarray, right: np.ndarray, widths: tuple[int, int], salts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    for salt in salts:
        if salt % 2:
            right = right ^ (_mix(left, salt) >> U(64 - widths[1]))
        else:
            left = left ^ (_mix(right, salt) >> U(64 - widths[0]))
    return left, right


def permuted(ids: list[np.ndarray], shape: Shape) -> tuple[np.ndarray, np.ndarray | None]:
    """(top, rest) of the sequences whose k-th ids are ``ids[k]``."""
    cut = shape.n - shape.n // 2
    halves = []
    for part in (ids[:cut], ids[cut:]):
        packed = np.zeros(len(ids[0]), U)
        for x in part:
            packed = (packed << U(shape.bits)) | x.astype(U)
        halves.append(packed)
    left, right = _rounds(*halves, shape.halves, (1, 2, 3, 4))
    return ((left << U(shape.halves[1])) | right, None) if shape.single else (left, right)


def restored(top: np.ndarray, rest: np.ndarray | None, shape: Shape) -> np.ndarray:
    """The sequences, one row each: the permutation undone."""
    if rest is None:
        wide = U(shape.halves[1])
        top, rest = top >> wide, top & ((U(1) << wide) - U(1))
    halves = _rounds(top, rest, shape.halves, (4, 3, 2, 1))
    mask = (U(1) << U(shape.bits)) - U(1)
    out = []
    for packed, many in zip(halves, (shape.n - shape.n // 2, shape.n // 2), strict=True):
        out += [(packed >> U(shape.bits * (many - 1 - k))) & mask for k in range(many)]
    return np.stack(out, axis=1)


class Filter(NamedTuple):
    """Sorted different values with their counts."""

    top: np.ndarray
    rest: np.ndarray | None
    count: np.ndarray


def merged(parts: list[Filter]) -> Filter:
    """One filter of several runs; the values need not be sorted or different."""
    top = np.concatenate([p.top for p in parts])
    rest = None if parts[0].rest is None else np.concatenate([p.rest for p in parts])
    count = np.concatenate([p.count for p in parts])
    if not len(top):
        return Filter(top, rest, count)
    if rest is None and count.max() == 1:  # no order to carry along
        top = np.sort(top)
        at = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
        return Filter(top[at], None, np.diff(np.append(at, len(top))))
    order = np.argsort(top, kind="stable") if rest is None else np.lexsort((rest, top))
    top, count = top[order], count[order]
    new = np.empty(len(top), bool)
    new[0] = True
    new[1:] = top[1:] != top[:-1]
    if rest is not None:
        rest = rest[order]
        new[1:] |= rest[1:] != rest[:-1]
        rest = rest[new]
    at = np.flatnonzero(new)
    return Filter(top[at], rest, np.add.reduceat(count, at))


def counted(top: np.ndarray, rest: np.ndarray | None) -> Filter:
    return merged([Filter(top, rest, np.ones(len(top), np.int64))])


def _in_bytes(x: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()


def _from_bytes(data: bytes, at: int, m: int, bits: int) -> tuple[np.ndarray, int]:
    wide = (bits + 7) // 8
    out = np.zeros((m, 8), np.uint8)
    out[:, :wide] = np.frombuffer(data, np.uint8, m * wide, at).reshape(m, wide)
    return out.view("<u8").ravel().astype(U), at + m * wide


def to_bytes(f: Filter, shape: Shape, shard_bits: int) -> bytes:
    """The filter of one shard: all values share their first ``shard_bits`` bits, which are left out."""
    m, left = len(f.top), shape.top_bits - shard_bits
    q = min(left, max(0, m.bit_length() - 1))
    inside = f.top & U((1 << left) - 1)
    runs = np.zeros(m + (1 << q), np.uint8)  # a one for each value, a zero at the end of each quotient's run
    runs[np.arange(m) + (inside >> U(left - q)).astype(np.int64) if q else np.arange(m)] = 1
    large = f.count >= 255
    return b"".join([struct.pack("<QB", m, q), np.packbits(runs).tobytes(), _in_bytes(inside & U((1 << (left - q)) - 1), left - q),
                     b"" if f.rest is None else _in_bytes(f.rest, shape.rest_bits),
                     np.where(large, 255, f.count).astype(np.uint8).tobytes(), f.count[large].astype("<i8").tobytes()])


def from_bytes(data: bytes, shape: Shape, shard_bits: int, shard: int) -> Filter:
    m, q = struct.unpack_from("<QB", data)
    at, left, slots = 9, shape.top_bits - shard_bits, m + (1 << q)
    runs = np.unpackbits(np.frombuffer(data, np.uint8, (slots + 7) // 8, at), count=slots)
    quotient = (np.flatnonzero(runs) - np.arange(m)).astype(U)
    remainder, at = _from_bytes(data, at + (slots + 7) // 8, m, left - q)
    top = remainder | (U(shard) << U(left) if shard else U(0))
    if q:
        top |= quotient << U(left - q)
    rest = None
    if shape.rest_bits:
        rest, at = _from_bytes(data, at, m, shape.rest_bits)
    count = np.frombuffer(data, np.uint8, m, at).astype(np.int64)
    count[count == 255] = np.frombuffer(data, "<i8", -1, at + m)
    return Filter(top, rest, count)


def shards(f: Filter, shape: Shape, shard_bits: int) -> list[tuple[int, bytes]]:
    """(shard, bytes) of each shard that has values; ``f`` is sorted."""
    if not len(f.top):
        return []
    which = f.top >> U(shape.top_bits - shard_bits) if shard_bits else np.zeros(len(f.top), U)
    begin = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    ends = [*begin[1:], len(which)]
    return [(int(s), to_bytes(Filter(f.top[a:b], None if f.rest is None else f.rest[a:b], f.count[a:b]), shape, shard_bits))
            for s, a, b in zip(which[begin], begin, ends, strict=True)]


class Collector:
    """The filter of a task: runs are merged when they are many, and given out in shards when that leaves many."""

    def __init__(self, shape: Shape, shard_bits: int):
        self.shape, self.shard_bits, self.parts, self.size = shape, shard_bits, [], 0

    def add(self, part: Filter) -> Iterator[pa.RecordBatch]:
        self.parts.append(part)
        self.size += len(part.top)
        if self.size > FLUSH:
            self.parts = [merged(self.parts)]
            self.size = len(self.parts[0].top)
            if self.size > FLUSH // 2:
                yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            found = shards(merged(self.parts), self.shape, self.shard_bits)
            self.parts, self.size = [], 0
            for at in range(0, len(found), 1024):
                some = found[at: at + 1024]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int64()), pa.array([b for _, b in some], pa.binary())],
                                                 ["shard", "filter"])


def bits_set(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Whether the slots' bits are set in a table of little-endian bits."""
    return (table[(slot >> U(3)).astype(np.int64)] >> (slot & U(7)).astype(np.uint8)) & 1 > 0


def bit_table(slot: np.ndarray, size: int) -> bytes:
    """``size`` bits, those of ``slot`` set."""
    bits = np.zeros(size, np.uint8)
    bits[slot.astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()
