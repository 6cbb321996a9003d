"""Edit-aware token counts: a segment tree of pre-token counts per document.

A byte-level BPE tokenizer cuts a text into pre-tokens by a pattern and encodes each alone. A new document's
tree has a leaf for every ``LEAF`` pre-tokens, holding their characters and tokens; inner nodes hold the
sums below them (``char_sums`` and ``sums``: heap order, root first, leaves last). Both heaps are stored, read and updated.

An edit replaces the characters [start, stop) by a text. The tree leads from the edit's offset to the
last leaf that starts two characters or more before it (no pre-token that ends there looks further ahead).
From there on the new text is cut and encoded until, behind the last edit in reach, a pre-token ends where
an old leaf ended: the pattern never looks back, so all that follows is as before. Only those
leaves are replaced, and the sums on their paths to the root updated. The new pre-tokens are dealt to as many leaves as they replace, so an edit
touches O(log leaves) sums whether it adds pre-tokens or takes some away; a leaf may run empty or grow to ``FULL``
pre-tokens, and only beyond that is the tree laid out anew.

Edits name code points of the text before any edit. They are taken by start, then stop; one that
starts before the end of the one before it, or outside the text, is skipped and counted. Null
texts count as empty, which have no leaves and no tokens. Rows are independent, so repeated rows and empty
tables need no care. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fresh, read

LEAF, FULL = 64, 256
#: Pre-tokens whose counts a worker remembers.
CACHE = 300_000


def default_ranks() -> str:
    """The public byte-level vocabulary installed on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        out = list(map(known.get, pieces))
        if None in out:
            if len(known) > CACHE:
                known.clear()
            for i, n in enumerate(out):
                if n is None:
                    piece = pieces[i]
                    n = known.get(piece)
                    if n is None:
                        n = len(self.encoding.encode_ordinary(piece))
                        if len(piece) <= 64:
                            known[piece] = n
                    out[i] = n
        return out


def _leaves(pieces: list[str], counts: list[int], many: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of every LEAF pre-tokens; or of ``many`` leaves, if so many can hold them."""
    if many and len(pieces) <= many * FULL:
        each = np.add.reduceat if len(pieces) >= many else None
        if each is None:  # fewer pre-tokens than leaves: the last ones are empty
            size, own = np.zeros((2, many), np.int64), len(pieces)
            size[0, :own], size[1, :own] = list(map(len, pieces)), counts
            return size[0], size[1]
        at = np.arange(many) * len(pieces) // many
    elif not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    else:
        at = np.arange(0, len(pieces), LEAF)
    return np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), at), np.add.reduceat(np.asarray(counts, np.int64), at)


def _sums(leaves: np.ndarray) -> np.ndarray:
    """Heap of sums: node i has the children 2 i + 1 and 2 i + 2; the leaves fill the last row."""
    if not len(leaves):
        return np.zeros(0, np.int64)
    wide = 1 << int(np.ceil(np.log2(len(leaves))))
    out = np.zeros(2 * wide - 1, np.int64)
    out[wide - 1 : wide - 1 + len(leaves)] = leaves
    while wide > 1:
        half = wide // 2
        out[half - 1 : wide - 1] = out[wide - 1 : 2 * wide - 1].reshape(-1, 2).sum(1)
        wide = half
    return out


@dataclass
class Tree:
    """Sums of characters and of tokens over the same leaves."""

    chars: np.ndarray
    tokens: np.ndarray
    leaves: int

    @classmethod
    def of(cls, chars: np.ndarray, tokens: np.ndarray) -> "Tree":
        return cls(_sums(chars), _sums(tokens), len(chars))

    @classmethod
    def build(cls, text: str, counter: Counter) -> "Tree":
        pieces = counter.pattern.findall(text)
        return cls.of(*_leaves(pieces, counter.counts(pieces)))

    def leaf_values(self) -> tuple[np.ndarray, np.ndarray]:
        wide = (len(self.chars) + 1) // 2
        return tuple(x[wide - 1 : wide - 1 + self.leaves] if self.leaves else x for x in (self.chars, self.tokens))

    def find(self, offset: int) -> tuple[int, int]:
        """(leaf that holds the character at offset, characters before that leaf); the last leaf beyond the end."""
        wide, node, before = (len(self.chars) + 1) // 2, 0, 0
        while node < wide - 1:
            left = 2 * node + 1
            if offset - before < self.chars[left] or not self.chars[left + 1]:
                node = left
            else:
                before, node = before + int(self.chars[left]), left + 1
        return node - (wide - 1), before

    def replace(self, a: int, b: int, chars: np.ndarray, tokens: np.ndarray) -> "Tree":
        """The tree with leaves a to b - 1 replaced; sums are updated on their paths if their number stays."""
        if len(chars) != b - a:
            own = self.leaf_values()
            return Tree.of(*(np.concatenate([x[:a], y, x[b:]]) for x, y in zip(own, (chars, tokens))))
        wide = (len(self.chars) + 1) // 2
        for heap, new in ((self.chars, chars), (self.tokens, tokens)):
            lo, hi = wide - 1 + a, wide - 1 + b
            heap[lo:hi] = new
            while lo > 0:
                lo, hi = (lo - 1) // 2, (hi - 2) // 2 + 1
                node = np.arange(lo, hi)
                heap[lo:hi] = heap[2 * node + 1] + heap[2 * node + 2]
        return self


def usable(edits, n: int) -> tuple[list[tuple[int, int, str]], int]:
    """Edits in order that fit the text, and how many do not."""
    out, end, skipped = [], 0, 0
    for s, e, t in sorted((x for x in edits or () if x is not None), key=lambda x: (x[0] is None, x[0] or 0, x[1] or 0, x[2] or "")):
        if s is None or e is None or not end <= s <= e <= n:
            skipped += 1
            continue
        out.append((s, e, t or ""))
        end = e
    return out, skipped


def edited(text: str, tree: Tree, edits, counter: Counter) -> tuple[str, Tree, int, int]:
    """(new text, its tree, pre-tokens cut again, edits skipped)."""
    edits, skipped = usable(edits, len(text))
    parts, at = [], 0
    for s, e, t in edits:
        parts += [text[at:s], t]
        at = e
    new = "".join([*parts, text[at:]])
    if not text or not edits:
        return (new, Tree.build(new, counter) if edits else tree, 0, skipped)
    chars, _ = tree.leaf_values()
    ends = np.cumsum(chars)
    jobs, k, shift, again = [], 0, 0, 0
    while k < len(edits):
        leaf, begin = tree.find(max(0, edits[k][0] - 2))
        if jobs and leaf < jobs[-1][1]:
            leaf = jobs[-1][1]
            begin = int(ends[leaf - 1])
        pieces, pos, last = [], begin + shift, leaf
        more, old_end, stop = shift, begin, leaf
        # Old leaf ends come up one by one; edits that start before the end (and its look-ahead) are in reach.
        wanted = set()
        while True:
            while k < len(edits) and (edits[k][0] <= old_end + 1 or not wanted):
                s, e, t = edits[k]
                more += len(t) - (e - s)
                old_end = max(old_end, e)
                k += 1
                wanted.add(e)
            m = counter.pattern.match(new, pos)
            if m is None:
                stop = tree.leaves
                break
            pieces.append(m.group())
            pos = m.end()
            old = pos - more
            if old >= old_end:
                stop = int(np.searchsorted(ends, old))
                hit = stop < len(ends) and int(ends[stop]) == old
                if k < len(edits) and edits[k][0] <= old + 1:
                    old_end = max(old_end, old)
                    continue
                if hit:
                    stop += 1
                    break
        jobs.append((leaf, stop, *_leaves(pieces, counter.counts(pieces), stop - leaf)))
        again += len(pieces)
        shift = more
    for leaf, stop, c, t in reversed(jobs):
        tree = tree.replace(leaf, stop, c, t)
    return new, tree, again, skipped


_FIELDS = [("leaf_chars", pa.int32()), ("leaf_tokens", pa.int32()), ("char_sums", pa.int64()), ("sums", pa.int64())]
TREE = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("leaf_chars", T.ArrayType(T.IntegerType())),
                     T.StructField("leaf_tokens", T.ArrayType(T.IntegerType())), T.StructField("char_sums", T.ArrayType(T.LongType())),
                     T.StructField("sums", T.ArrayType(T.LongType()))])


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(kind.to_pandas_dtype())))


def _column(trees: list[Tree]) -> pa.Array:
    leaf = [t.leaf_values() for t in trees]
    columns = [[c for c, _ in leaf], [n for _, n in leaf], [t.chars for t in trees], [t.tokens for t in trees]]
    return pa.StructArray.from_arrays([pa.array([int(t.tokens[0]) if len(t.tokens) else 0 for t in trees], pa.int64()),
                                       *[_lists(x, kind) for x, (_, kind) in zip(columns, _FIELDS)]], ["n_tokens", *[n for n, _ in _FIELDS]])


def _trees(column: pa.StructArray) -> list[Tree]:
    """The trees of a column, from their stored sums."""
    at, values = {}, {}
    for name in ("leaf_chars", "char_sums", "sums"):
        lists = column.field(name)
        at[name], values[name] = lists.offsets.to_numpy(), lists.values.to_numpy()
    part = lambda name, i: values[name][at[name][i] : at[name][i + 1]].copy()
    return [Tree(part("char_sums", i), part("sums", i), int(at["leaf_chars"][i + 1] - at["leaf_chars"][i])) for i in range(len(column))]


def build(docs: DataFrame, text_col: str = "text", column: str = "tree", ranks: str | None = None) -> DataFrame:
    """docs plus each text's tree (TREE)."""
    out, at, path = fresh(docs, column), docs.columns.index(text_col), ranks or default_ranks()

    def work(batches):
        counter = Counter(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                trees = [Tree.build(t or "", counter) for t in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, _column(trees)], [*batch.schema.names, out])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(out, TREE)]))


def apply_edits(trees: DataFrame, text_col: str = "text", tree_col: str = "tree", edits_col: str = "edits", ranks: str | None = None) -> DataFrame:
    """trees with text and tree after the edits (array of struct start, stop, text), n_again and n_skipped.

    n_again counts the pre-tokens that were cut and encoded again.
    """
    again, skip, path = fresh(trees, "n_again"), fresh(trees, "n_skipped"), ranks or default_ranks()
    at = {n: trees.columns.index(n) for n in (text_col, tree_col, edits_col)}

    def work(batches):
        counter = Counter(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                rows = []
                for text, own, edits in zip(batch.column(at[text_col]).to_pylist(), _trees(batch.column(at[tree_col])), batch.column(at[edits_col]).to_pylist()):
                    rows.append(edited(text or "", own, [tuple(e.values()) for e in edits or () if e is not None], counter))
                new = list(batch.columns)
                new[at[text_col]] = pa.array([r[0] for r in rows], pa.string())
                new[at[tree_col]] = _column([r[1] for r in rows])
                yield pa.RecordBatch.from_arrays([*new, pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                                                 [*batch.schema.names, again, skip])

    return trees.mapInArrow(work, T.StructType([*trees.schema.fields, T.StructField(again, T.LongType()), T.StructField(skip, T.LongType())]))


def with_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id", column: str = "edits") -> DataFrame:
    """trees plus the edits of each document, from a table (doc_id, start, stop, text)."""
    key = fresh(trees, "edited_doc")
    lists = edits.groupBy(F.col("doc_id").alias(key)).agg(F.collect_list(F.struct("start", "stop", "text")).alias(column))
    return trees.join(lists, trees[f"`{id_col}`"] == lists[key], "left").drop(key)


def sample_edits(text):
    """Three edits of every text from its own characters: a replacement, a deletion and an insertion."""
    n = F.char_length(text)
    at = lambda share: F.floor(n * share).cast("int")
    edit = lambda s, e, t: F.struct(s.alias("start"), F.least(e, n).alias("stop"), t.alias("text"))
    return F.when(n > 0, F.array(edit(at(0.25), at(0.25) + 5, F.substring(text, at(0.5) + 1, F.lit(8))),
                                 edit(at(0.5), at(0.5) + 3, F.lit("")),
                                 edit(at(0.75), at(0.75), F.substring(text, 1, 12))))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trees = build(docs).withColumns({"n_tokens": F.col("tree.n_tokens"), "edits": sample_edits(F.coalesce("text", F.lit("")))})
    return apply_edits(trees).select("doc_id", "n_tokens", F.col("tree.n_tokens").alias("n_tokens_edited"), "n_again", "n_skipped",
                                     F.col("tree.leaf_chars").alias("leaf_chars"), F.col("tree.leaf_tokens").alias("leaf_tokens"))
