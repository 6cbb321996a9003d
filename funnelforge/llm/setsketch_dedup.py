"""Near-duplicate documents by SetSketch registers.

A document's set holds the hashes of its distinct ``shingle``-word runs (words
``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer words: the whole sequence as one; none: empty, and
linked with nothing). Two documents are linked if ``100 * |A & B| >= percent * |A | B|``.

1. *Sketch.* Register i holds floor(1 - log_b(minimum of exponential variables)), cut off at
   0 and q + 1. The variables of an element are the arrivals of a Poisson process, each dealt to
   a random register, generated in ascending order until they pass the largest minimum of the
   set. Sketches merge by the maximum of each register (``merge``).
2. *Classes.* Documents with equal sets form a class; only its smallest doc_id goes on.
3. *Bands.* Classes with equal values in a band of registers share a bucket. With 40 bands of five
   registers a pair at similarity 0.85 is missed with probability 6e-11, at 0.8 with 1.2e-7.
4. *Estimate.* The similarity of a candidate pair is estimated by maximum likelihood from the
   numbers of larger, smaller and equal registers and both set sizes.
5. *Verify.* Pairs estimated at ``MARGIN`` (over five standard errors) below the threshold or more
   are compared on their full sets.

A bucket is first compared with two of its members (the smallest doc_id and a random one),
which links almost all of a large group of near copies with as many comparisons as it has
members. In buckets that then still hold different components all pairs across them are looked at by
their registers: members whose sizes allow the threshold and that agree in all but ``FAMILY_MARGIN`` more of them than
the threshold asks for form families, directly or through others (a linked pair agrees in fewer with probability 2e-13 at most). Sharing a
bucket alone makes no family, or short texts with a common line would become one that grows with the table. Within a family all members are
compared on their full sets, chunk by chunk, and only a spanning forest of the links comes out: no link that joins two components is
lost and no bucket emits all pairs.

Null texts are empty. Rows without a doc_id and rows with an empty set are linked with nothing
(their component is their own id). Rows that share a doc_id are judged by their own texts. An
empty table gives an empty result. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .shared import components, fresh, read, spanning, texts, units, written

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
MARGIN = 0.15
#: Below the threshold, the share of equal registers that makes two members of a bucket a family.
FAMILY_MARGIN = 0.25
#: Members compared with one copy of their leader.
LEADER_SHARE = 2000
#: Members of a chunk of a bucket, those of a bucket whose pairs are listed, and pairs and rows held at once.
CHUNK_BUCKET, _SMALL, _PAIRS, _HELD = 4096, 64, 1 << 13, 1 << 13
#: Shingles and members of a chunk of a family, columns and cells of a comparison's matrix.
CHUNK_SHINGLES, CHUNK_MEMBERS, _COLUMNS, _CELLS = 1 << 20, 4096, 512, 1 << 20
#: A column of the matrix is multiplied if it adds to more than one in so many cells; the others are added cell by cell.
_SPARSE = 256


class ShingleSets:
    """Sorted distinct shingle hashes of a run of texts: text i has values[first[i]:first[i + 1]]."""

    def __init__(self, data: np.ndarray, off: np.ndarray, shingle: int):
        words = tc.Words(data, off, lower=True)
        count = np.diff(words.first)
        size = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
        start = tc.ragged(words.first[:-1], size)
        length = np.repeat(np.minimum(count, shingle), size)
        h = tc.span_hash(words.hash[0], start, start + length)
        edge = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            h[a:b].sort()
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        new[edge[:-1][size > 0]] = True
        self.values = h[new]
        self.first = np.concatenate([[0], np.cumsum(new)])[edge]
        self.sizes = np.diff(self.first)

    def of(self, i: int) -> np.ndarray:
        return self.values[self.first[i] : self.first[i + 1]]


def sketch(sets: ShingleSets) -> np.ndarray:
    """Registers (uint16, one row per text) of every set; an empty set's are 0."""
    n = len(sets.sizes)
    low = np.full(n * REGISTERS, np.inf)
    doc = np.repeat(np.arange(n), sets.sizes)
    h, t, drawn, chunk = sets.values, np.zeros(len(sets.values)), 0, 1
    while len(h):
        turn = np.arange(drawn + 1, drawn + chunk + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        x = tc.mix(h[:, None] + turn[None, :])
        at = t[:, None] + np.cumsum(-np.log(((x >> np.uint64(12)).astype(float) + 0.5) * 2.0**-52), axis=1) / (RATE * REGISTERS)
        register = (((x & np.uint64(0xFFF)) * np.uint64(REGISTERS)) >> np.uint64(12)).astype(np.int64)
        np.minimum.at(low, (doc[:, None] * REGISTERS + register).ravel(), at.ravel())
        t, drawn = at[:, -1], drawn + chunk
        go = t < low.reshape(n, REGISTERS).max(axis=1)[doc]
        h, t, doc = h[go], t[go], doc[go]
        chunk = int(max(1, min(64, 200_000 // max(1, len(h)), drawn)))
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low) / np.log(BASE))
    return np.clip(k, 0, LIMIT + 1).astype(np.uint16).reshape(n, REGISTERS)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One hash per text and band."""
    r = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), r.shape[:2])
    for i in range(ROWS):
        key = tc.mix(key ^ (r[:, :, i] << np.uint64(20)))
    return key


def likelihood_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from registers (rows of a and b) and set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = REGISTERS - more - less
    u, v = na / (na + nb), nb / (na + nb)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def score(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny))
                + same * np.log(np.maximum(1 - up - down, tiny)))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the log-likelihood is concave in the similarity
        one, two = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        better = score(one) < score(two)
        lo, hi = np.where(better, one, lo), np.where(better, hi, two)
    return (lo + hi) / 2


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, tkey, n, s1, s2, registers); (s1, s2) is the set's own 128-bit hash."""
    def work(batches):
        for batch, data, off in tc.slices(batches, "text"):
            sets = ShingleSets(data, off, shingle)
            regs = sketch(sets)
            sums = []
            for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
                total = np.concatenate([[0], np.cumsum(tc.mix(sets.values ^ np.uint64(salt)), dtype=np.uint64)]).astype(np.uint64)
                sums.append(tc.signed(total[sets.first[1:]] - total[sets.first[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sets.sizes.astype(np.int64)), *sums,
                 pa.array([r.tobytes() for r in regs], pa.binary())], ["doc_id", "tkey", "n", "s1", "s2", "registers"])

    return docs.mapInArrow(work, "doc_id long, tkey long, n long, s1 long, s2 long, registers binary")


def _band_rows(classes: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            who = pa.array(np.repeat(np.arange(len(regs)), BANDS))
            yield pa.RecordBatch.from_arrays([tc.signed(band_keys(regs).ravel()), batch.column(0).take(who), batch.column(1).take(who)],
                                             ["band", "c", "n"])

    return classes.select("c", "n", "registers").mapInArrow(work, "band long, c long, n long")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and registers allow the threshold, with their text keys."""
    @F.pandas_udf("boolean")
    def likely(ra: pd.Series, na: pd.Series, rb: pd.Series, nb: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(x), np.uint16).reshape(-1, REGISTERS) for x in (ra, rb))
        return pd.Series(likelihood_similarity(a, b, na.to_numpy(float), nb.to_numpy(float)) >= percent / 100 - MARGIN)

    side = lambda x: classes.select(F.col("c").alias(x), F.col("ckey").alias(f"{x}key"), F.col("n").alias(f"n{x}"),
                                    F.col("registers").alias(f"r{x}"))
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            .where(likely("ra", "na", "rb", "nb")).select("a", "akey", "b", "bkey"))


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (u, v) among the pairs, by full sets.

    Both sides' texts come by one join. The rows of a leader then stream past its set, which comes
    first in its partition; a leader with many partners is copied to several partitions.
    """
    shares = pairs.groupBy("a", "akey").agg(F.ceil(F.count("*") / LEADER_SHARE).cast("int").alias("shares"))
    lead = shares.select("a", "akey", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("role"),
                         F.col("a").alias("doc_id"), F.col("akey").alias("tkey"))
    rest = pairs.join(shares, ["a", "akey"]).select("a", "akey", F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share"),
                                                    F.lit(1).alias("role"), F.col("b").alias("doc_id"), F.col("bkey").alias("tkey"))
    rows = docs.join(lead.unionByName(rest), ["doc_id", "tkey"]).select("a", "akey", "share", "role", "doc_id", "text")

    def work(batches):
        at, held = None, None
        for batch, data, off in tc.slices(batches, "text"):
            sets = ShingleSets(data, off, shingle)
            a, key, share, role, doc = (batch.column(i).to_pylist() for i in range(5))
            found = []
            for i in range(batch.num_rows):
                own = sets.of(i)
                if role[i] == 0:
                    at, held = (a[i], key[i], share[i]), own.copy()
                elif at == (a[i], key[i], share[i]) and len(held):
                    place = np.minimum(np.searchsorted(held, own), len(held) - 1)
                    both = int((held[place] == own).sum())
                    if 100 * both >= percent * (len(held) + len(own) - both):
                        found.append((a[i], doc[i]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["u", "v"])

    return (rows.repartition("a", "akey", "share").sortWithinPartitions("a", "akey", "share", "role")
            .mapInArrow(work, "u long, v long"))


def crossing(low: np.ndarray, n: np.ndarray, component: np.ndarray, need: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) that connect the rows of one bucket as its pairs of different components with ``need`` equal registers do.

    Breadth first: a row is compared with those that none has reached yet.
    """
    left, of, size, own = np.arange(len(n)), np.ascontiguousarray(low.T), n, component
    reached, found = [], [np.zeros((0, 2), dtype=np.int64)]
    while len(left):
        if reached:
            x = reached.pop()
        else:
            x, left, of, size, own = left[-1], left[:-1], of[:, :-1], size[:-1], own[:-1]
        hit = (own != component[x]) & (np.minimum(size, n[x]) * 100 >= np.maximum(size, n[x]) * percent)
        if hit.any():
            hit &= (of == low[x][:, None]).view(np.uint8).sum(axis=0, dtype=np.uint8) >= need
        if hit.any():
            new, go = left[hit], ~hit
            reached += new.tolist()
            found.append(np.stack([np.full(len(new), x), new], axis=1))
            left, of, size, own = left[go], of[:, go], size[go], own[go]
    both = np.concatenate(found)
    return both[:, 0], both[:, 1]


def _near(band_first: np.ndarray, low: np.ndarray, n: np.ndarray, component: np.ndarray, need: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) of all buckets, whose rows begin at band_first[:-1]."""
    sizes = np.diff(band_first)
    some = [np.zeros((2, 0), dtype=np.int64)]
    for k in np.flatnonzero(sizes > _SMALL).tolist():
        x, y = band_first[k], band_first[k + 1]
        some.append(np.stack(crossing(low[x:y], n[x:y], component[x:y], need, percent)) + x)
    small = sizes <= _SMALL
    row = tc.ragged(band_first[:-1][small], sizes[small])
    last = np.repeat(band_first[1:][small], sizes[small])
    more = last - row - 1
    edge = np.concatenate([[0], np.cumsum(more)])
    cut = np.unique(np.concatenate([np.searchsorted(edge, np.arange(0, edge[-1], _PAIRS)), [len(row)]]))
    for x, y in zip(cut[:-1], cut[1:]):
        i, j = np.repeat(row[x:y], more[x:y]), tc.ragged(row[x:y] + 1, more[x:y])
        go = (component[i] != component[j]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent)
        i, j = i[go], j[go]
        go = (low[i] == low[j]).view(np.uint8).sum(axis=1, dtype=np.uint8) >= need
        some.append(np.stack([i[go], j[go]]))
    both = np.concatenate(some, axis=1)
    return both[0], both[1]


def _low(members: DataFrame) -> DataFrame:
    """(c, ckey, n, low) of classes; low holds the lower byte of every register, which differs in 255 of 256 where the register does."""
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16).reshape(-1, REGISTERS).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array([r.tobytes() for r in regs], pa.binary())], ["c", "ckey", "n", "low"])

    return members.select("c", "ckey", "n", "registers").mapInArrow(work, "c long, ckey long, n long, low binary")


def _runs(rows: pa.Table, keys: int) -> np.ndarray:
    """Where the runs of rows with equal values in the first ``keys`` columns begin, and the number of rows."""
    new = np.ones(rows.num_rows + 1, dtype=bool)
    key = [rows.column(i).to_numpy() for i in range(keys)]
    new[1:-1] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
    return np.flatnonzero(new)


def _near_links(opened: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """A forest (u, v) of the pairs of a bucket that are of different components and may be linked.

    opened has (band, c, component, rows), with the members of the bucket in rows. A bucket is cut into chunks of about CHUNK_BUCKET members; every
    pair of chunks is a unit of its own.
    """
    need = int(np.ceil(REGISTERS * (percent / 100 - FAMILY_MARGIN)))
    chunks = F.ceil(F.col("rows") / CHUNK_BUCKET).cast("int")
    rows = (opened.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("chunks = 1 OR own <> other")
            .join(members.select("c", "n", "low"), "c")
            .select("band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "c", "component", "n", "low"))

    def links(held: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        c, component, n = (held.column(i).to_numpy() for i in (3, 4, 5))
        low = np.frombuffer(b"".join(held.column(6).to_pylist()), np.uint8).reshape(-1, REGISTERS)
        i, j = _near(first, low, n, component, need, percent)
        ids, at = np.unique(c, return_inverse=True)
        found = spanning(ids, at[i], at[j])
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    def work(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows >= _HELD and len(first := _runs(held, 3)) > 2:  # the last unit may go on in the next batch
                yield links(held.slice(0, first[-2]), first[:-1])
                held = held.slice(first[-2])
        if held is not None:
            yield links(held, _runs(held, 3))

    return rows.repartition("band", "p", "q").sortWithinPartitions("band", "p", "q").mapInArrow(work, "u long, v long")


def shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray):
    """(first, counts) for runs of a from first on: sizes of the intersections of sets[a[first + i]] and sets[b[j]].

    Shingles of many sets are counted by products of 0/1 matrices, those of a few pair by pair. A shingle of one text only adds nothing.
    """
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    column = np.cumsum(np.concatenate([[False], value[1:] != value[:-1]])[: len(value)])
    total = int(column[-1]) + 1 if len(column) else 0
    sides = []
    for which in (a, b):
        place = np.full(len(sets), -1)
        place[which] = np.arange(len(which))
        row = place[owner]
        sides.append((row[row >= 0], column[row >= 0]))
    (arow, acol), (brow, bcol) = sides
    many = np.bincount(acol, minlength=total) * np.bincount(bcol, minlength=total)
    common = (many > 0) & (np.bincount(column, minlength=total) > 1)
    full = common & (many * _SPARSE >= len(a) * len(b))
    number, columns = np.cumsum(full) - 1, int(full.sum())
    afull, bfull, few = full[acol], full[bcol], (common & ~full)[acol]
    begin = np.searchsorted(bcol, np.arange(total + 1))
    frow, fcol = arow[few], acol[few]
    by = np.argsort(frow, kind="stable")
    frow, fcol, count = frow[by], fcol[by], np.diff(begin)[fcol[by]]
    lrow, lcol, rrow, rcol = arow[afull], number[acol[afull]], brow[bfull], number[bcol[bfull]]
    step = max(1, _CELLS // max(1, len(b)))
    for first in range(0, len(a), step):
        m = min(step, len(a) - first)
        out = np.zeros((m, len(b)), dtype=np.float32)
        for at in range(0, columns, _COLUMNS):
            wide = min(_COLUMNS, columns - at)
            left, right = np.zeros((m, wide), dtype=np.float32), np.zeros((len(b), wide), dtype=np.float32)
            here = (lcol >= at) & (lcol < at + wide) & (lrow >= first) & (lrow < first + m)
            left[lrow[here] - first, lcol[here] - at] = 1
            here = (rcol >= at) & (rcol < at + wide)
            right[rrow[here], rcol[here] - at] = 1
            out += left @ right.T  # whole numbers below 2^24 are exact
        x, y = np.searchsorted(frow, (first, first + m))
        edge = np.concatenate([[0], np.cumsum(count[x:y])])
        cut = np.unique(np.concatenate([np.searchsorted(edge, np.arange(0, edge[-1], _CELLS)), [y - x]])) + x
        for u, v in zip(cut[:-1], cut[1:]):
            cell = np.repeat((frow[u:v] - first) * len(b), count[u:v]) + brow[tc.ragged(begin[fcol[u:v]], count[u:v])]
            np.add.at(out.reshape(-1), cell, np.float32(1))
        yield first, out.astype(np.int64)


def _family_links(members: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (u, v) between members (c, ckey, n, component, family) of one family and different components.

    A family is cut into chunks of about CHUNK_SHINGLES shingles and CHUNK_MEMBERS members at most; every pair of chunks is a unit of
    its own. A unit compares all its pairs and emits a spanning forest of the links.
    """
    chunks = members.groupBy("family").agg(F.ceil(F.greatest(F.sum("n") / CHUNK_SHINGLES, F.count("*") / CHUNK_MEMBERS)).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int")
    placed = members.join(written(chunks, "chunks"), "family").select("family", "component", "chunks", own.alias("own"), F.col("c").alias("doc_id"), F.col("ckey").alias("tkey"))
    rows = (docs.join(placed, ["doc_id", "tkey"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("family", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).alias("side"),
                    "component", "doc_id", "text"))

    def work(batches):
        for (_, p, q), held in units(batches, 3):
            sets, cols = [], [[], [], []]
            for batch, data, off in tc.slices(held, "text"):
                some = ShingleSets(data, off, shingle)
                sets += [some.of(i).copy() for i in range(batch.num_rows)]
                for c, i in zip(cols, (3, 4, 5)):
                    c.append(batch.column(i).to_numpy(zero_copy_only=False))
            side, component, doc = (np.concatenate(c) for c in cols)
            a = np.flatnonzero(~side.astype(bool)) if p != q else np.arange(len(sets))
            b = np.flatnonzero(side) if p != q else a
            if not len(a) or not len(b):
                continue
            size, every, some = np.array([len(x) for x in sets]), np.arange(len(sets)), [np.zeros((0, 2), dtype=np.int64)]
            for first, both in shared_counts(sets, a, b):
                x = a[first : first + len(both)]
                i, j = np.nonzero((100 * both >= percent * (size[x][:, None] + size[b][None, :] - both)) & (component[x][:, None] != component[b][None, :]))
                some.append(spanning(every, x[i], b[j]))
            i, j = np.concatenate(some).T
            found = spanning(doc, i, j)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    return (rows.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q")
            .mapInArrow(work, "u long, v long"))


def link(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, tkey, n_shingles, component_id) of every row of docs(doc_id, text, tkey) with an id."""
    held = written(sketches(docs, shingle), "sketches")
    names = held.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("c"), F.min_by("tkey", "doc_id").alias("ckey"))
    names = written(names, "classes")
    classes = written(held.join(names.drop("s1", "s2"), (F.col("doc_id") == F.col("c")) & (F.col("tkey") == F.col("ckey")))
                      .select("c", "ckey", "n", "registers").dropDuplicates(["c", "ckey"]), "representatives")
    bands = written(_band_rows(classes), "bands")

    drawn = F.xxhash64("c", "band")
    leaders = (bands.groupBy("band").agg(F.min("c").alias("first"), F.min_by("c", drawn).alias("drawn"), F.max("c").alias("last"))
               .where("first < last").drop("last"))
    near = bands.join(written(leaders, "leaders"), "band").select("c", F.explode(F.array_distinct(F.array("first", "drawn"))).alias("leader")).where("c <> leader")
    tried = written(near.select(F.least("c", "leader").alias("a"), F.greatest("c", "leader").alias("b")).distinct(), "tried")
    links = written(_verified(written(_estimated(tried, classes, percent), "pairs"), docs, shingle, percent), "links")
    joined = written(components(links), "components")

    # Buckets with members of different components: the families among them are compared as a whole.
    placed = bands.join(joined.withColumnRenamed("node", "c"), "c", "left").select("band", "c", F.coalesce("component", "c").alias("component"))
    split = (placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows"))
             .where("x < y").drop("x", "y"))
    open_ = written(placed.join(written(split, "split"), "band"), "open")
    if not open_.isEmpty():
        inside = written(open_.select("c", "component").distinct(), "inside")
        low = written(_low(classes.join(inside.select("c"), "c", "left_semi")), "low")
        family = components(_near_links(open_, low, percent))
        members = (inside.join(family.select(F.col("node").alias("c"), F.col("component").alias("family")), "c")
                   .join(low.select("c", "ckey", "n"), "c"))
        rest = written(_family_links(written(members, "families"), docs, shingle, percent), "links")
        joined = written(components(links.unionByName(rest)), "components")

    return (held.select("doc_id", "tkey", "n", "s1", "s2").join(names.select("s1", "s2", "c"), ["s1", "s2"], "left")
            .join(joined.withColumnRenamed("node", "c"), "c", "left")
            .select("doc_id", "tkey", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "c")).alias("component_id")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs plus n_shingles, component_id (smallest linked doc_id) and kept (it is the document's own)."""
    rows = texts(docs, id_col, text_col).withColumn("tkey", F.xxhash64("text"))
    found = link(rows.where("doc_id is not null"), shingle, percent)
    doc, key = fresh(docs, "linked_doc"), fresh(docs, "linked_key")
    found = found.dropDuplicates(["doc_id", "tkey"]).withColumnsRenamed({"doc_id": doc, "tkey": key})
    text = F.col(f"`{text_col}`").cast("string")
    own = docs[f"`{id_col}`"].cast("long")
    return (docs.join(found, (own == found[doc]) & (F.xxhash64(text) == found[key]), "left").drop(doc, key)
            .withColumn("n_shingles", F.coalesce("n_shingles", F.lit(0).cast("long")))
            .withColumn("kept", F.coalesce(own == F.col("component_id"), F.lit(True))))


def op2_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.withColumn("tkey", F.xxhash64("text"))
    return (link(rows, shingle=3, percent=85).select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


#: The same rows in DuckDB SQL: every pair of documents that shares a shingle.
OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+2], ' ') AS x
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM shared JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 100 * k >= 85 * (p.n + q.n - k)),
edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT d, v FROM reach JOIN edge ON u = r),
comp AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN comp ON d = w.doc_id
"""
