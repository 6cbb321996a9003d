"""Words and n-grams of an Arrow string column as numpy arrays.

A word is ``[^\\x20\\x09-\\x0D]+``. These separators are single bytes in UTF-8, so words are cut
on the raw column buffers without decoding. A word's hashes are halves of a keyed blake2b digest of its bytes,
taken once per distinct word of a slice; n-gram hashes are polynomials over them, for runs too short for two of them to cancel by their
pattern. Hashes are 64 bits wide (two of them where rows are matched by hash alone) and depend only on the bytes, never on batch or partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Odd multipliers of the two n-gram hashes (drawn once from a fixed seed).
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BASES = [int(x) | 1 for x in _RNG.integers(1 << 62, 1 << 63, 2, dtype=np.uint64)]
#: Key of the word hashes (any fixed value; another one gives other candidates of the same results).
_KEY = b"funnelforge words"
#: Bytes of text and number of texts handled at once inside a task.
SLICE_BYTES, SLICE_ROWS = 1 << 19, 2000
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 (or of the inverse base)."""
    have = _POWERS.get((which, inverse))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        base = pow(_BASES[which], -1, 1 << 64) if inverse else _BASES[which]
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[which, inverse] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) that spreads every input bit."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Polynomial hash of values[start:end] for every span, mixed with its length."""
    n = len(values)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(values * powers(which, n), out=total[1:])
    h = (total[ends] - total[starts]) * powers(which, n + 1, inverse=True)[starts]
    return mix(h ^ mix((ends - starts).astype(_U)))


def word_hashes(data: np.ndarray, size: np.ndarray, hashes: int) -> list[np.ndarray]:
    """Keyed hashes of words that lie one after another in data."""
    places = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    keyed = hashlib.blake2b(digest_size=8 * hashes, key=_KEY)
    digests = []
    for word in found.dictionary.to_pylist():
        own = keyed.copy()
        own.update(word)
        digests.append(own.digest())
    h = np.frombuffer(b"".join(digests), dtype="<u8").astype(_U).reshape(-1, hashes)[found.indices.to_numpy()]
    return [np.ascontiguousarray(h[:, k]) for k in range(hashes)]


class Words:
    """The words of a run of texts: byte spans, hashes and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashes: int = 1):
        self.data, self.offsets = data, offsets
        space = _SPACE[data]
        begins = ~space
        begins[1:] &= space[:-1]
        edge = offsets[1:-1]
        edge = edge[edge < len(data)]
        begins[edge] = ~space[edge]
        ends = ~space
        ends[:-1] &= space[1:]
        inner = edge[edge > 0] - 1
        ends[inner] = ~space[inner]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        #: first[i]:first[i + 1] are the words of text i
        self.first = np.searchsorted(self.starts, offsets)
        seen = LOWER[data] if lower else data
        self.hash = word_hashes(seen[~space], self.ends - self.starts, hashes)

    def grams(self, n: int, which: int = 0) -> np.ndarray:
        """Hash of the n words from each word on; meaningless where they cross a text's end."""
        m = len(self.starts)
        if m < n:
            return np.zeros(0, dtype=_U)
        at = np.arange(m - n + 1)
        return span_hash(self.hash[which], at, at + n, which)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())  # no copy of what is a string column already
    if column.null_count:
        column = column.fill_null("")
    raw = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(raw[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or raw[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(raw[2], dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that each holds about size (SLICE_BYTES) of text (one text at least)."""
    size = size or SLICE_BYTES
    for batch in batches:
        data, off = buffers(batch.column(batch.schema.get_field_index(column)))
        at, n = 0, batch.num_rows
        while at < n:
            to = min(n, at + SLICE_ROWS, max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1))
            yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


def sliding(values: np.ndarray, w: int, how: np.ufunc) -> np.ndarray:
    """Minimum or maximum (np.minimum, np.maximum) of every w consecutive values."""
    n = len(values)
    if n < w:
        return values[:0]
    pad = -n % w
    full = np.concatenate([values, np.repeat(values[-1:], pad)]).reshape(-1, w)
    left = how.accumulate(full, axis=1).ravel()
    right = how.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return how(right[: n - w + 1], left[w - 1 : n])


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, .. for every (start, count), one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - starts, counts)


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
