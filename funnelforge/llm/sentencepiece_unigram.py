"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

``load`` reads a SentencePiece model file. Pieces of a unigram model have their stored log scores. A BPE
model stores merge ranks instead; its pieces get log scores by Zipf's law, -log(rank + 1) - log H_n. Nothing
is trained.

A text is encoded as SentencePiece does without normalisation: a blank is put in front, blanks are
the marker U+2581, and the sequence of pieces with the largest sum of scores is taken (of equal
ones that with the longer last piece). A character outside the vocabulary scores 10 below the
least piece and becomes its UTF-8 bytes, as byte pieces. Decoding joins pieces and bytes, turns markers into
blanks and drops the first. A U+2581 in the text itself goes through byte pieces, so decoding gives back
every text exactly.

No piece has a marker after another character, so a text falls into independent segments before each
run of blanks. Each distinct segment of a slice of texts is searched once, all of them together:
one walk of the trie from every byte, then dynamic programming over the end positions.

Null texts have null ids and decode to null; empty texts have none. Rows are independent, so
repeated rows, ties and empty tables need no care. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .shared import fresh, read

MARK, UNKNOWN_PENALTY = "▁", 10.0
_BLANK, _NEWLINE = 0x20, 0x0A


def default_model() -> str:
    """The public 32k vocabulary installed on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """Vocabulary as arrays: the trie over bytes (blanks for markers), scores, and each id's bytes."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # id + 1 of the piece that ends in a node, or 0
    score: np.ndarray
    unknown: float
    byte_id: np.ndarray
    blob: np.ndarray  # bytes of all ids, one after another
    first: np.ndarray
    split_blank: bool
    split_newline: bool


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value: from node s, byte c leads to t = base[s] + c if check[t] == s."""
    children: list[dict[int, int]] = [{}]
    ends = [0]
    for key, i in keys:
        at = 0
        for c in key:
            nxt = children[at].get(c)
            if nxt is None:
                nxt = children[at][c] = len(children)
                children.append({})
                ends.append(0)
            at = nxt
        ends[at] = i + 1
    size = 2 * len(children) + 512
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.zeros(size, np.int32)
    used = bytearray(size)
    used[0] = 1
    check[0] = 0
    place, free, scan, todo = {0: 0}, 256, 256, [0]  # from 256 on, every byte can go to the first free place
    for node in todo:
        s = place[node]
        value[s] = ends[node]
        kids = sorted(children[node])
        if not kids:
            continue
        while used[free]:
            free += 1
        scan = max(scan, free)
        b, tries = max(1, (free if len(kids) == 1 else scan) - kids[0]), 0
        while True:
            if b + 512 >= len(used):
                used += bytes(size)
                base, check, value = (np.concatenate([x, np.full(size, f, np.int32)]) for x, f in ((base, 0), (check, -1), (value, 0)))
            if not any(used[b + c] for c in kids):
                break
            b, tries = b + 1, tries + 1
        if tries > 50:  # a crowded stretch: larger nodes go on behind it, single children fill it
            scan = b + kids[0]
        base[s] = b
        for c in kids:
            used[b + c] = 1
            check[b + c] = s
            place[children[node][c]] = b + c
            todo.append(children[node][c])
    return base, check, value


def load(path: str | None = None) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path or default_model(), "rb") as f:
        model.ParseFromString(f.read())
    kind = pb.ModelProto.SentencePiece
    normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED)]
    score = np.zeros(len(model.pieces))
    if model.trainer_spec.model_type == pb.TrainerSpec.UNIGRAM:
        for i, _, s in normal:
            score[i] = s
    else:
        order = sorted(normal, key=lambda x: (-x[2], x[0]))
        harmonic = np.log(np.sum(1.0 / np.arange(1, len(order) + 1)))
        for rank, (i, _, _) in enumerate(order):
            score[i] = -np.log(rank + 1.0) - harmonic
    keys = [(p.replace(MARK, " ").encode(), i) for i, p, _ in normal if " " not in p]
    byte_id = np.zeros(256, np.int32)
    said = [b""] * len(model.pieces)
    for i, p in enumerate(model.pieces):
        if p.type == kind.BYTE:
            byte_id[int(p.piece[3:5], 16)] = i
            said[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type == kind.UNKNOWN:
            said[i] = " ⁇ ".encode()
    if len({*byte_id.tolist()}) != 256:
        raise ValueError("the model has no byte pieces")
    for k, i in keys:
        said[i] = k
    return Pieces(*double_array(keys), score, float(score[[i for _, i in keys]].min()) - UNKNOWN_PENALTY, byte_id,
                  np.frombuffer(b"".join(said), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in said])]),
                  not any(b" " in k.lstrip(b" ") for k, _ in keys), not any(b"\n" in k for k, _ in keys))


def _edges(u: np.ndarray, stop: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, id) of every piece in the bytes u; stop[i]: where the segment of byte i ends. id -1: one unknown character."""
    lead = (u & 0xC0) != 0x80
    begin = np.flatnonzero(lead)
    ends_at = np.append(begin[1:], len(u))
    single = np.zeros(len(begin), dtype=bool)
    which = np.arange(len(begin))
    node, pos = np.zeros(len(begin), np.int32), begin.copy()
    found = []
    while len(pos):
        to = p.base[node] + u[pos]
        ok = (p.check[to] == node) & (p.base[node] > 0)
        which, node, pos = which[ok], to[ok], pos[ok] + 1
        hit = p.value[node] > 0
        found.append((begin[which[hit]], pos[hit], p.value[node[hit]] - 1))
        single[which[hit & (pos == ends_at[which])]] = True
        more = pos < stop[begin[which]]
        which, node, pos = which[more], node[more], pos[more]
    lone = np.flatnonzero(~single)
    found.append((begin[lone], ends_at[lone], np.full(len(lone), -1, np.int32)))
    return tuple(np.concatenate(x) for x in zip(*found))


def search(u: np.ndarray, first: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Best ids of the segments u[first[i]:first[i + 1]] (none empty), and where each segment's ids begin."""
    size = np.diff(first)
    seg = np.repeat(np.arange(len(size)), size)
    start, end, piece = _edges(u, first[1:][seg], p)
    gain = np.where(piece < 0, p.unknown, p.score[piece])
    where = seg[start]
    # Node of a position: one more per segment, so that a segment's end is not the next one's start.
    a, b = start + where, end + where
    depth = end - first[:-1][where]
    order = np.lexsort((-start, depth))
    a, b, gain, depth = a[order], b[order], gain[order], depth[order]
    best, back = np.full(len(u) + len(size), -np.inf), np.zeros(len(u) + len(size), np.int64)
    best[first[:-1] + np.arange(len(size))] = 0
    cuts = np.append(np.flatnonzero(np.diff(depth, prepend=-1)), len(depth)).tolist()
    for x, y in zip(cuts[:-1], cuts[1:]):
        at, score = b[x:y], best[a[x:y]] + gain[x:y]
        np.maximum.at(best, at, score)
        win = np.flatnonzero(score == best[at])
        back[at[win]] = order[x:y][win]  # the last one, with the earliest start
    s_, k_, e_ = [], [], []
    at, who = first[1:].copy(), np.arange(len(size))
    turn = 0
    while len(at):
        edge = back[at + who]
        s_.append(who)
        k_.append(np.full(len(who), -turn))
        e_.append(edge)
        at = start[edge]
        go = at > first[who]
        at, who, turn = at[go], who[go], turn + 1
    who, edge = np.concatenate(s_), np.concatenate(e_)
    order = np.lexsort((np.concatenate(k_), who))
    who, edge = who[order], edge[order]
    unknown = piece[edge] < 0
    many = np.where(unknown, end[edge] - start[edge], 1)
    ids = np.repeat(piece[edge], many)
    ids[np.repeat(unknown, many)] = p.byte_id[u[tc.ragged(start[edge][unknown], many[unknown])]]
    return ids, np.concatenate([[0], np.cumsum(np.bincount(who, many, len(size)).astype(np.int64))])


def encode_column(data: np.ndarray, off: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text's ids begin."""
    size = np.diff(off)
    texts_ = np.flatnonzero(size)
    u = np.insert(data, off[:-1][texts_], _BLANK)
    if not len(u):
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    begin = off[:-1][texts_] + np.arange(len(texts_))
    cut = np.zeros(len(u), dtype=bool)
    if p.split_blank:
        blank = u == _BLANK
        cut[1:] = blank[1:] & ~blank[:-1]
    if p.split_newline:
        line = u == _NEWLINE
        cut |= line
        cut[1:] |= line[:-1]
    cut[begin] = True
    start = np.flatnonzero(cut)
    stop = np.append(start[1:], len(u))
    # Equal segments are searched once; they are compared by their bytes.
    same = (pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(u))), pa.py_buffer(u)])
            .dictionary_encode().indices.to_numpy())
    one = np.zeros(same.max() + 1, dtype=np.int64)
    one[same[::-1]] = np.arange(len(same))[::-1]
    length = (stop - start)[one]
    ids, first = search(u[tc.ragged(start[one], length)], np.concatenate([[0], np.cumsum(length)]), p)
    count = np.diff(first)[same]
    out = ids[tc.ragged(first[:-1][same], count)]
    total = np.concatenate([[0], np.cumsum(count)])
    edge = np.zeros(len(off), np.int64)
    edge[1:] = total[np.searchsorted(start, off[1:] + np.searchsorted(texts_, np.arange(1, len(off))))]
    return out, edge


def decode_column(ids: np.ndarray, first: np.ndarray, p: Pieces) -> list[str]:
    size = np.diff(p.first)[ids]
    data = p.blob[tc.ragged(p.first[ids], size)].tobytes()
    edge = np.concatenate([[0], np.cumsum(size)])[first].tolist()
    out = []
    for a, b in zip(edge[:-1], edge[1:]):
        out.append(data[a + (data[a : a + 1] == b" ") : b].decode("utf-8", "replace"))
    return out


def _held(spark, p: Pieces):
    return spark.sparkContext.broadcast(pickle.dumps(p))  # bounded by the vocabulary


def encode(docs: DataFrame, p: Pieces, text_col: str = "text", column: str = "ids") -> DataFrame:
    """docs plus the column of token ids."""
    out, at = fresh(docs, column), docs.columns.index(text_col)
    held = _held(docs.sparkSession, p)

    def work(batches):
        own = pickle.loads(held.value)
        for batch, data, off in tc.slices(batches, text_col):
            ids, first = encode_column(data, off, own)
            null = pa.compute.is_null(batch.column(at))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=null)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, out])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(tokens: DataFrame, p: Pieces, ids_col: str = "ids", column: str = "decoded") -> DataFrame:
    """tokens plus the column of decoded texts; ids outside the vocabulary raise an error."""
    out, at = fresh(tokens, column), tokens.columns.index(ids_col)
    held = _held(tokens.sparkSession, p)

    def work(batches):
        own = pickle.loads(held.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                lists = batch.column(at).fill_null([]) if batch.column(at).null_count else batch.column(at)
                first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                said = decode_column(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), first, own)
                col = pa.array(said, pa.string(), mask=pa.compute.is_null(batch.column(at)).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*batch.columns, col], [*batch.schema.names, out])

    return tokens.mapInArrow(work, T.StructType([*tokens.schema.fields, T.StructField(out, T.StringType())]))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    p = load()
    tokens = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), p)
    return (decode(tokens, p).select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids",
                                     F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip")))
