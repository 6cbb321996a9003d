"""Counting quotient filters over packed n-grams of word ids, lossless.

A key of n ids is cut into lanes (at least two, of at most 64 bits). The lanes are permuted by rounds in which each
takes the exclusive or with a mix of the others; every step can be undone, so a permuted key is as good as the n-gram, and its leading bits are
evenly spread: the first ones name a shard, the next the quotient, and all others are the remainder.

A filter holds the sorted distinct keys of a shard: one bit per quotient (does a run begin?), one bit per key (does the run end?), the remainder's
bytes, and a counter of one byte, or of eight where 255 is not enough. Filters of one shard merge by their sorted keys.
"""

from __future__ import annotations

import struct

import numpy as np

from . import textcore as tc

_U = np.uint64
ROUNDS = 3
_HEAD = struct.Struct("<QQBB")


def _join(parts: list[np.ndarray], widths: list[int]) -> np.ndarray:
    out = parts[0].astype(_U)
    for p, w in zip(parts[1:], widths[1:]):
        out = (out << _U(w)) | p.astype(_U)
    return out


def _split(value: np.ndarray, widths: list[int]) -> list[np.ndarray]:
    out = []
    for w in reversed(widths):
        out.append(value & _U((1 << w) - 1))
        value = value >> _U(w) if w < 64 else np.zeros_like(value)
    return out[::-1]


class Keys:
    """Keys of n ids below 2^bits; widths are the bits of a permuted key's columns, the leading one first."""

    def __init__(self, n: int, bits: int):
        self.bits = bits
        self.groups = [len(g) for g in np.array_split(np.arange(n), max(2, -(-n // (64 // bits))))]
        self.lanes = [g * bits for g in self.groups]
        self.widths = [sum(self.lanes)] if sum(self.lanes) <= 64 else self.lanes

    def _round(self, lanes: list[np.ndarray], r: int, i: int) -> None:
        other = np.zeros_like(lanes[0])
        for j, lane in enumerate(lanes):
            if j != i:
                other = tc.mix(other ^ (lane + _U((r * 64 + i * 8 + j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
        lanes[i] = lanes[i] ^ (other >> _U(64 - self.lanes[i]))

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Columns of n-grams, not yet permuted."""
        lanes, at = [], 0
        for g in self.groups:
            lanes.append(_join(ids[at : at + g], [self.bits] * g))
            at += g
        return [_join(lanes, self.lanes)] if len(self.widths) == 1 else lanes

    def permute(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        lanes = _split(columns[0], self.lanes) if len(self.widths) == 1 else list(columns)
        for r in range(ROUNDS):
            for i in range(len(lanes)):
                self._round(lanes, r, i)
        return [_join(lanes, self.lanes)] if len(self.widths) == 1 else lanes

    def ids(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """The n ids of permuted keys."""
        lanes = _split(columns[0], self.lanes) if len(self.widths) == 1 else list(columns)
        for r in reversed(range(ROUNDS)):
            for i in reversed(range(len(lanes))):
                self._round(lanes, r, i)
        return [x for lane, g in zip(lanes, self.groups) for x in _split(lane, [self.bits] * g)]


def combine(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not len(counts):
        return columns, counts
    order = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(counts), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(counts[order], at)


def shards(column: np.ndarray, width: int, bits: int) -> np.ndarray:
    return (column >> _U(width - bits)).astype(np.int64) if bits else np.zeros(len(column), dtype=np.int64)


def encode(columns: list[np.ndarray], counts: np.ndarray, widths: list[int], shard_bits: int) -> bytes:
    """The filter of sorted distinct permuted keys of one shard."""
    n = len(counts)
    rest = widths[0] - shard_bits
    q = min(rest, max(1, n - 1).bit_length())
    tail = columns[0] & _U((1 << rest) - 1)
    quotient = (tail >> _U(rest - q)).astype(np.int64) if q else np.zeros(n, dtype=np.int64)
    occupied = np.zeros(1 << q, dtype=bool)
    occupied[quotient] = True
    ends = np.ones(n, dtype=bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    parts = [np.packbits(occupied).tobytes(), np.packbits(ends).tobytes()]
    for values, w in zip([tail & _U((1 << (rest - q)) - 1), *columns[1:]], [rest - q, *widths[1:]]):
        parts.append(np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(n, 8)[:, : -(-w // 8)].tobytes())
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<u8").tobytes()]
    first = int(columns[0][0]) >> rest if rest < 64 else 0
    return _HEAD.pack(n, first, shard_bits, q) + b"".join(parts)


def decode(data: bytes, widths: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Permuted keys, sorted, and their counts."""
    n, shard, shard_bits, q = _HEAD.unpack_from(data)
    raw, at = np.frombuffer(data, np.uint8), _HEAD.size
    rest = widths[0] - shard_bits

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size : at]

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
    ends = np.unpackbits(take(-(-n // 8)), count=n).astype(bool)
    run = np.zeros(n, dtype=np.int64)
    run[1:] = np.cumsum(ends[:-1])
    columns = []
    for w in [rest - q, *widths[1:]]:
        size = -(-w // 8)
        full = np.zeros((n, 8), dtype=np.uint8)
        full[:, :size] = take(n * size).reshape(n, size)
        columns.append(full.view("<u8").ravel().astype(_U))
    lead = occupied[run].astype(_U) << _U(rest - q) if rest - q < 64 else _U(0)
    columns[0] = columns[0] | lead | (_U(shard << rest) if rest < 64 else _U(0))
    counts = take(n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=at).astype(np.int64)
    return columns, counts
