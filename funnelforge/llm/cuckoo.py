"""A cuckoo filter over 128-bit keys: 16-bit fingerprints, four to a bucket, with deletion and growth."""

from __future__ import annotations

import numpy as np

from .textcore import mix

SLOTS = 4
#: Share of slots up to which a table takes keys; four-slot buckets find places for nearly all of them.
LOAD = 0.85
_KICKS = 200


class CuckooFilter:
    """Answers "maybe" for every key held and, with a probability of about 1e-4 per table, for others.

    Fingerprints do not hold the bits that a larger table would need, so a filter grows by a table of twice the
    size: new keys go to the last one, all are searched. A key that finds no place after _KICKS moves goes
    to a stash that is searched as well, so no insertion is ever lost; below LOAD hardly any key needs it.
    """

    def __init__(self, capacity: int):
        self.tables = [np.zeros((1 << max(2, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.8))))), SLOTS), dtype=np.uint16)]
        self.used = 0  # of the last table
        #: (table, bucket, fingerprint): number of keys
        self.stash: dict[tuple[int, int, int], int] = {}

    def _places(self, k1: np.ndarray, k2: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fp = (mix(k2.view(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        one = (mix(k1.view(np.uint64)) & np.uint64(len(table) - 1)).astype(np.int64)
        return one, self._other(one, fp, table), fp

    @staticmethod
    def _other(at, fp, table):
        jump = mix(np.atleast_1d(fp).astype(np.uint64)) & np.uint64(len(table) - 1)
        return at ^ jump.astype(np.int64)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        found = np.zeros(len(k1), dtype=bool)
        for n, table in enumerate(self.tables):
            one, two, fp = self._places(k1, k2, table)
            found |= (table[one] == fp[:, None]).any(1) | (table[two] == fp[:, None]).any(1)
            held = np.array([at << 16 | f for m, at, f in self.stash if m == n], dtype=np.int64)
            if len(held):
                found |= np.isin(one << 16 | fp, held) | np.isin(two << 16 | fp, held)
        return found

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        done = 0
        while done < len(k1):
            table = self.tables[-1]
            room = int(LOAD * table.size) - self.used
            if room <= 0:
                self.tables.append(np.zeros((2 * len(table), SLOTS), dtype=np.uint16))
                self.used = 0
                continue
            some = slice(done, done + room)
            for at, alt, fp in zip(*(x.tolist() for x in self._places(k1[some], k2[some], table))):
                for place in (at, alt):
                    free = np.flatnonzero(table[place] == 0)
                    if len(free):
                        table[place, free[0]] = fp
                        break
                else:
                    self._kick(table, alt, fp)
                self.used += 1
            done = min(len(k1), done + room)

    def _kick(self, table: np.ndarray, at: int, fp: int) -> None:
        for turn in range(_KICKS):
            slot = (fp + turn) % SLOTS
            fp, table[at, slot] = int(table[at, slot]), fp
            at = int(self._other(at, np.uint16(fp), table)[0])
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = fp
                return
        key = (len(self.tables) - 1, at, fp)
        self.stash[key] = self.stash.get(key, 0) + 1

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Remove one copy of each key; only keys that were inserted may be deleted."""
        where = [[x.tolist() for x in self._places(k1, k2, table)] for table in self.tables]
        for i in range(len(k1)):
            any(self._drop(n, (where[n][0][i], where[n][1][i]), where[n][2][i]) for n in reversed(range(len(self.tables))))

    def _drop(self, n: int, places: tuple[int, int], fp: int) -> bool:
        for place in places:
            held = np.flatnonzero(self.tables[n][place] == fp)
            if len(held):
                self.tables[n][place, held[0]] = 0
                self.used -= n == len(self.tables) - 1
                return True
            if (n, place, fp) in self.stash:
                self.stash[n, place, fp] -= 1
                if not self.stash[n, place, fp]:
                    del self.stash[n, place, fp]
                return True
        return False

    def to_bytes(self) -> bytes:
        stash = np.array([(*k, n) for k, n in self.stash.items()], dtype=np.int64).reshape(-1, 4)
        sizes = np.int64([len(self.tables), self.used, *map(len, self.tables)])
        return sizes.tobytes() + b"".join(t.tobytes() for t in self.tables) + stash.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> "CuckooFilter":
        out = cls(1)
        many, out.used = np.frombuffer(blob, np.int64, 2).tolist()
        sizes, at, out.tables = np.frombuffer(blob, np.int64, many, 16).tolist(), 16 + 8 * many, []
        for n in sizes:
            out.tables.append(np.frombuffer(blob, np.uint16, n * SLOTS, at).reshape(n, SLOTS).copy())
            at += 2 * n * SLOTS
        out.stash = {tuple(x[:3]): x[3] for x in np.frombuffer(blob, np.int64, -1, at).reshape(-1, 4).tolist()}
        return out
