"""Benchmark decontamination: word pairs as seeds, then Smith-Waterman alignment of words.

Test items are cut into passages of at most ``PASSAGE`` words (overlapping by half). Words are
``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document is aligned with a passage by Smith-Waterman (match +2,
mismatch -1, gap -1). The similarity is the best local score over that of the whole passage against itself; a
document leaks an item from ``leak`` on.

Seeds only say where to align, and miss no leak. An alignment of M matches and E errors (mismatched, added or
missing words) with a passage of n words reaches ``leak`` if 2M - E >= 2 leak n. Then it has at most M - leak n pairs of
successive matches with two or more errors between them, so at least ceil(leak n) - 1 pairs with one or none: two
words that stand one or two apart both in the passage and in the document. It covers at most
M + E <= (3 - 2 leak) n words of the document. So a passage's seeds are its word pairs at distances 1 and 2, and where so
many words of a document within that reach start a seed, the stretch is aligned. To spare hits of common pairs, the
half of those places whose seeds most passages of the block share is left out, and the number asked for falls by
as many. (This holds where leak n > 1, so for every item at the default.)

The items are the stated query set. They are handled in blocks of at most ``BLOCK_WORDS`` words (one
item at least); for each block the documents are read once, without a shuffle of texts, and the block is
broadcast, so its bound holds at any size of either table.

Items with fewer than SHORTEST words cannot be told from ordinary text inside a longer one: they leak where they are, as a whole, a
document's words. Null and empty items never leak; null and empty documents leak nothing. Items with equal ids count as one, with the
best passage of any. Rows without a doc_id are counted but give no result; rows that share a doc_id
give one row per item, with the best score. Empty tables give no rows. Other columns are ignored
(``clean`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .shared import fresh, read, texts, written

SHORTEST, LEAK = 3, 0.5
PASSAGE, BLOCK_WORDS = 128, 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
EXPAND = 1 << 21
_BITS = 24
_UNIT, _LOW = 1 << _BITS, (1 << _BITS) - 1


def short_leaks(words: tc.Words, block: "Block") -> list[tuple[int, int, float, int, int]]:
    """Texts whose words are, as a whole, those of a short item: two words inside a longer text say nothing."""
    size = np.diff(words.first)
    out = []
    for d in np.flatnonzero((size > 0) & (size < SHORTEST)).tolist() if block.short else []:
        key = tuple(words.hash[0][words.first[d] : words.first[d + 1]].tolist())
        out += [(d, item, 1.0, 0, len(key)) for item in block.short.get(key, [])]
    return out


LEAKS = "doc_id long, item_id long, score double, start_word long, end_word long"


def _pairs(words: np.ndarray, apart: int) -> np.ndarray:
    """Hash of each word and the one so far behind it."""
    return words[:-apart] * np.uint64(0x9E3779B97F4A7C15) + words[apart:] * np.uint64(0xC2B2AE3D27D4EB4F)


class Block:
    """Passages of some items: words, seeds, which passages have which seed, and how many seeds a leak has at least."""

    def __init__(self, item_ids: list, column: pa.Array, leak: float = LEAK):
        words = tc.Words(*tc.buffers(column), lower=True)
        self.item, self.words = [], []
        #: Items of fewer than SHORTEST words, by their words' hashes.
        self.short: dict[tuple, list] = {}
        for i, item in enumerate(item_ids):
            a, b = int(words.first[i]), int(words.first[i + 1])
            if b - a < SHORTEST:
                if a < b:
                    self.short.setdefault(tuple(words.hash[0][a:b].tolist()), []).append(item)
                continue
            step = PASSAGE // 2
            for s in range(a, max(a + 1, b - step), step) if b - a > PASSAGE else [a]:
                self.item.append(item)
                self.words.append(words.hash[0][s : min(b, s + PASSAGE)])
        self.size = np.array([len(x) for x in self.words], dtype=np.int64)
        need = np.maximum(1, np.ceil(leak * self.size - 1e-9).astype(np.int64) - 1)
        spare = need // 2
        self.need, self.reach = need - spare, np.ceil((3 - 2 * leak) * self.size).astype(np.int64)
        seeds = [np.concatenate([_pairs(x, 1), _pairs(x, 2)]) for x in self.words]
        place = [np.concatenate([np.arange(n - 1), np.arange(n - 2)]) for n in self.size.tolist()]
        passage = np.repeat(np.arange(len(seeds)), np.array([len(x) for x in seeds], dtype=np.int64))
        many = max(1, len(seeds))
        flat = np.concatenate([*seeds, np.zeros(0, np.uint64)])
        _, which = np.unique(flat, return_inverse=True)
        held = np.bincount(np.unique(which * many + passage) // many, minlength=1)[which]  # passages that share the seed
        keep = np.zeros(len(flat), dtype=bool)
        at = 0
        for p, where in enumerate(place):
            shared = np.zeros(int(self.size[p]) - 1, dtype=np.int64)
            np.maximum.at(shared, where, held[at : at + len(where)])
            rare = np.ones(len(shared), dtype=bool)
            rare[np.argsort(-shared, kind="stable")[: spare[p]]] = False
            keep[at : at + len(where)] = rare[where]
            at += len(where)
        self.seeds, which = np.unique(flat[keep], return_inverse=True)
        has = np.unique(which * many + passage[keep])  # by seed, then passage
        which, self.passage = has // many, has % many
        self.first = np.searchsorted(which, np.arange(len(self.seeds) + 1))
        self.shift = np.uint64(64 - min(25, max(10, (16 * len(self.seeds)).bit_length())))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), dtype=bool)  # leading bits of the seeds
        self.maybe[self.seeds >> self.shift] = True


def _hits(words: tc.Words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(word, seed) of every place where a text has a seed, by word."""
    doc, at, seeds = words.doc_of_word(), [], []
    for apart in (1, 2):
        if len(words.hash[0]) <= apart or not len(block.seeds):
            continue
        grams = _pairs(words.hash[0], apart)
        pos = np.flatnonzero(block.maybe[grams >> block.shift])
        seed = np.minimum(np.searchsorted(block.seeds, grams[pos]), len(block.seeds) - 1)
        real = (block.seeds[seed] == grams[pos]) & (doc[pos] == doc[pos + apart])
        at.append(pos[real])
        seeds.append(seed[real])
    if not at:
        return (np.zeros(0, dtype=np.int64),) * 2
    pos, seed = np.concatenate(at), np.concatenate(seeds)
    order = np.argsort(pos, kind="stable")
    return pos[order], seed[order]


def align(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each a[i] (document words) with b[i] (passage words): score, start, end in a.

    All pairs go on together, a passage word at a time. A cell holds score and path start in one
    integer, so a maximum takes the higher score and then the earlier start; gaps along the document
    are a running maximum.
    """
    n, wide, tall = len(a), max(map(len, a)), max(map(len, b))
    left, top = np.zeros((n, wide), dtype=np.uint64), np.zeros((n, tall), dtype=np.uint64)
    in_a, in_b = np.zeros((n, wide), dtype=bool), np.zeros((n, tall), dtype=bool)
    for i, (x, y) in enumerate(zip(a, b)):
        left[i, : len(x)], in_a[i, : len(x)] = x, True
        top[i, : len(y)], in_b[i, : len(y)] = y, True
    j = np.arange(wide, dtype=np.int64)
    empty = _LOW - np.arange(wide + 1, dtype=np.int64)  # score 0, start at the next word
    slope = -GAP * _UNIT * j
    row = np.broadcast_to(empty, (n, wide + 1)).copy()
    best, end = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for k in range(tall):
        gain = np.where((left == top[:, k, None]) & in_a, MATCH, MISMATCH) * _UNIT
        cell = np.maximum(row[:, :-1] + gain, row[:, 1:] + GAP * _UNIT)
        cell = np.maximum(np.maximum.accumulate(cell + slope, axis=1) - slope, empty[1:])
        cell = np.where(in_b[:, k, None], cell, row[:, 1:])
        row[:, 1:] = cell
        at = cell.argmax(axis=1)
        top_cell = cell[np.arange(n), at]
        better = (top_cell >> _BITS) > (best >> _BITS)
        best, end = np.where(better, top_cell, best), np.where(better, at + 1, end)
    return best >> _BITS, np.where(best > 0, _LOW - (best & _LOW), 0), end


def _stretches(words: tc.Words, block: Block, doc: np.ndarray, pos: np.ndarray, passage: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, passage, first word, end word) of all pieces that can hold a leak, from the words that start a passage's seed."""
    n = max(1, len(doc))
    key = np.unique(passage * n + pos)  # a word counts once
    passage, pos = key // n, key % n
    reach = block.reach[passage]
    begin = passage * n + np.maximum(words.first[doc[pos]], pos - reach + 1)
    strong = np.arange(len(key)) - np.searchsorted(key, begin) + 1 >= block.need[passage]
    passage, pos, reach = passage[strong], pos[strong], reach[strong]
    if not len(pos):
        return []
    new = np.ones(len(pos), dtype=bool)
    new[1:] = (np.diff(passage) != 0) | (np.diff(doc[pos]) != 0) | (np.diff(pos) > reach[1:])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(pos)) - 1
    out = []
    for g, e in zip(begin.tolist(), last.tolist()):
        d, p, wide = int(doc[pos[g]]), int(passage[g]), int(reach[g])
        a, b = max(int(words.first[d]), int(pos[g]) - wide), min(int(words.first[d + 1]), int(pos[e]) + wide + 2)
        out += [(d, p, s, min(b, s + 3 * wide)) for s in range(a, max(a + 1, b - wide), 2 * wide)]  # pieces overlap by wide
    return out


def leaks_of(words: tc.Words, block: Block, leak: float) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, start word, end word) of the leaks in a run of texts."""
    pos, seed = _hits(words, block)
    doc = words.doc_of_word()
    count = block.first[seed + 1] - block.first[seed]
    done, todo = np.append(0, np.cumsum(count)), []
    back = int(block.reach.max(initial=0))
    a = 0
    while a < len(pos):  # about EXPAND pairs of a hit and a passage, and the words before them that a leak can cover
        b = max(a + 1, int(np.searchsorted(done, done[a] + EXPAND, "right")) - 1)
        from_, a = int(np.searchsorted(pos, pos[a] - back)), b
        todo += _stretches(words, block, doc, np.repeat(pos[from_:b], count[from_:b]), block.passage[tc.ragged(block.first[seed[from_:b]], count[from_:b])])
    todo.sort(key=lambda x: (x[3] - x[2], len(block.words[x[1]])))
    out = []
    for at in range(0, len(todo), 128):
        some = todo[at : at + 128]
        score, start, end = align([words.hash[0][a:b] for _, _, a, b in some], [block.words[p] for _, p, _, _ in some])
        for (d, p, a, _), x, s, e in zip(some, score.tolist(), start.tolist(), end.tolist()):
            share = x / (MATCH * int(block.size[p]))
            if share >= leak:
                out.append((d, block.item[p], share, a + s - int(words.first[d]), a + e - int(words.first[d])))
    return out


def _blocks(items: DataFrame, leak: float):
    """The items, in blocks of about BLOCK_WORDS words by a hash of the id; each block is collected in turn."""
    items = written(items.where("doc_id is not null and text is not null"), "items")
    words = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = -(-words // BLOCK_WORDS)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == k).orderBy("doc_id", "text").toArrow()
        yield Block(rows.column(0).to_pylist(), rows.column(1), leak)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", leak: float = LEAK) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): the best alignment of every leaked item in a document."""
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    found = spark.createDataFrame([], LEAKS)
    for block in _blocks(texts(items, item_col, item_text), leak):
        held = spark.sparkContext.broadcast(block)

        def work(batches, held=held):
            for batch, data, off in tc.slices(batches, "text"):
                ids = batch.column(0).to_pylist()
                words = tc.Words(data, off, lower=True)
                got = [(ids[d], *x) for d, *x in [*leaks_of(words, held.value, leak), *short_leaks(words, held.value)] if ids[d] is not None]
                cols = list(zip(*got)) if got else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["doc_id", "item_id", "score", "start_word", "end_word"])

        found = found.unionByName(rows.mapInArrow(work, LEAKS))
    best = F.struct("score", -F.col("start_word"), -F.col("end_word"))
    return (found.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
            .select("doc_id", "item_id", "best.score", (-F.col("best.col2")).alias("start_word"), (-F.col("best.col3")).alias("end_word")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without those that leak an item."""
    key = fresh(docs, "leaked")
    bad = leaks(docs, items, id_col, text_col, **how).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(bad, docs[f"`{id_col}`"].cast("long") == bad[key], "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"))
