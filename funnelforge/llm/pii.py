"""Personal data in texts: exact patterns, and a character-level BiLSTM-CRF that adds spans.

*Base* spans are the matches of four patterns (leftmost, non-overlapping within a kind):
e-mail addresses, IP addresses (each part at most 255), payment cards (13 to 19 digits with a
right check digit) and phone numbers (``+`` and 9 to 15 digits); matches that fail are dropped.

The *tagger* (``bilstm_crf``) learns from labelled windows: base spans of a bounded sample of
documents, and copies whose spans are respelled (other separators, no ``+``). At scoring time,
overlapping windows cover every place where a span can be added: every ``[0-9@]`` outside
the base spans whose surroundings have an ``@`` or four digits, up to where names, hosts and numbers that begin there end. Each character
takes its emissions from the window that has it farthest from an edge, and one Viterbi pass with the CRF's
transitions decodes the whole stretch. A span is added if it meets no base span, does not cut a word, a
number or a host in two, and passes its kind's check (an e-mail has an ``@`` between two words with a dot; an IP has four parts of at most
255; a card has 13 to 19 digits and a right check digit; a phone number has 9 to 15 digits and a separator or ``+``). Numbers that fail a
check are left alone, parts of them too.

Null texts are empty; empty texts have no spans. Offsets are code points, the end exclusive. Repeated
rows give equal results. If the sample has no base span, nothing is learned or added. Other
columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bilstm_crf import Tagger
from .shared import fresh, read, texts

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window and between the starts of two; documents of the training sample and windows of the training set.
WINDOW, STRIDE = 64, 32
SAMPLE_DOCS, SAMPLE_WINDOWS = 4000, 2000
#: Training steps of 32 windows that a small training set is repeated for.
STEPS = 500
_AROUND, _APART = 24, 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that no match can start in is tried once, at its first digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")


def _emails(t: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @ outwards."""
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        s = at
        while s > end and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at) if s < at else None
        if m:
            out.append((s, m.end()))
            end = m.end()
        at = t.find("@", max(end, at + 1))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def _is_card(s: str) -> bool:
    d = _digits(s)
    return 13 <= len(d) <= 19 and _luhn(d)


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    out = [(0, s, e) for s, e in _emails(t)] if "@" in t else []
    if _DIGITS.search(t):
        out += [(1, *m.span()) for m in _IP.finditer(t) if all(map(_small, m.group().split(".")))]
        out += [(2, *m.span()) for m in _CARD.finditer(t) if _is_card(m.group())]
        if "+" in t:
            out += [(3, *m.span()) for m in _PHONE.finditer(t) if 9 <= len(_digits(m.group())) <= 15]
    return out


def plausible(kind: int, s: str) -> bool:
    """Whether a span that the tagger proposes may be added."""
    if kind == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s*@\s*[A-Za-z0-9-]+(\s*\.\s*[A-Za-z0-9-]+)+", s)) and len(s.split()) <= 12
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(map(_small, parts)) and not re.search(r"[A-Za-z]", s)
    if kind == 2:
        return _is_card(s) and not re.search(r"[A-Za-z]", s)
    return 9 <= len(_digits(s)) <= 15 and bool(re.search(r"[-+ ().]", s)) and not re.search(r"[A-Za-z]", s)


# What goes on beside a span, by kind: the left part of a longer name, number or address, and the right part.
_LEFT = [re.compile(p) for p in (r"[A-Za-z0-9._%+@-]\Z", r"(?:\w|[0-9]\s?[.,:/-]\s?)\Z", r"(?:[\w+]|[0-9][ ./()-]{1,3})\Z", r"(?:[\w+]|[0-9][ ./()-]{1,3})\Z")]
_RIGHT = [re.compile(p) for p in (r"[A-Za-z0-9@_-]|\.[A-Za-z0-9]|\s\.\s?[A-Za-z0-9]", r"\w|\s?[.,:/-]\s?[0-9]", r"\w|[ ./()-]{1,3}[0-9]", r"\w|[ ./()-]{1,3}[0-9]")]


def cuts(kind: int, t: str, s: int, e: int) -> bool:
    """Whether a span is only a part of a longer name, number or host in the text."""
    return bool(_LEFT[kind].search(t[max(0, s - 4) : s]) or _RIGHT[kind].match(t, e))


# Symbols: classes of letters, digits and blanks; each of these marks for itself; other.
_MARKS = "@.+-()_%/:,;=#\"'|[]{}<>*&"
_PAD, _OTHER = 0, 6


def symbols(s: str) -> np.ndarray:
    code = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)
    return _TABLE[np.minimum(code, len(_TABLE) - 1)]


def _table() -> np.ndarray:
    out = np.full(0x251, 5, dtype=np.int64)  # letters outside ASCII
    for c in range(128):
        ch = chr(c)
        out[c] = 1 if ch.isdigit() else 2 if ch.islower() else 3 if ch.isupper() else 4 if ch.isspace() else _OTHER
    for i, ch in enumerate(_MARKS):
        out[ord(ch)] = _OTHER + 1 + i
    out[-1] = _OTHER
    return out


_TABLE = _table()
SYMBOLS, TAGS = _OTHER + 1 + len(_MARKS), 1 + 2 * len(KINDS)


def places(t: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches of text in which a span can be added."""
    covered = sorted((s, e) for _, s, e in base)
    out, at, digits, ats, k = [], None, 0, 0, 0
    for m in _ANCHOR.finditer(t):
        p = m.start()
        while k < len(covered) and covered[k][1] <= p:
            k += 1
        if any(s <= p < e for s, e in covered[max(0, k - 4) : k + 4]):
            continue
        if at is not None and p - at[1] > _APART:
            out += [at] * (ats > 0 or digits >= 4)
            at, digits, ats = None, 0, 0
        at = (at[0] if at else p, p)
        ats, digits = ats + (m.group() == "@"), digits + (m.group() != "@")
    if at is not None:
        out += [at] * (ats > 0 or digits >= 4)
    return _widened(t, [(max(0, a - _AROUND), min(len(t), b + 1 + _AROUND)) for a, b in out])


_NAME_ON = re.compile(r"[A-Za-z0-9_%+-]*(?:\s?\.\s?[A-Za-z0-9_%+-]+)*")


def _widened(t: str, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches up to where the name that the left edge cuts begins, and where the host or number that the right edge cuts ends; those
    that then touch are one. Every character is passed once."""
    out: list[tuple[int, int]] = []
    for a, b in stretches:
        low = out[-1][1] if out else 0
        if b <= low:
            continue
        a = max(a, low)
        while a > low and t[a - 1] in _LOCAL:
            a -= 1
        if t[b - 1] in _LOCAL or t[b - 1].isspace():
            b = _NAME_ON.match(t, b).end()
        if out and a <= low:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def windows(stretch: tuple[int, int]) -> list[int]:
    a, b = stretch
    return [a] + [a + x for x in range(STRIDE, max(0, b - a - WINDOW + STRIDE), STRIDE)]


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the runs of tags: 0 is outside, 1 + 2 k begins kind k, 2 + 2 k continues it."""
    out, kind, start = [], None, 0
    for i, y in enumerate(np.append(tags, 0).tolist()):
        if kind is not None and y != 2 + 2 * kind:
            out.append((kind, start, i))
            kind = None
        if y and (kind is None):
            kind, start = (y - 1) // 2, i
    return out


def reconciled(stretch: tuple[int, int], of_window: dict[int, np.ndarray]) -> np.ndarray:
    """Emissions [length, tags] of a stretch: each character's from the window that has it farthest from an inner edge."""
    a, b = stretch
    e, depth = np.zeros((b - a, TAGS), dtype=np.float32), np.full(b - a, -1)
    for w in windows(stretch):
        n = min(WINDOW, b - w)
        inner = np.minimum(np.arange(n) + (WINDOW if w == a else 0), np.arange(n)[::-1] + (WINDOW if w + WINDOW >= b else 0))
        at = np.flatnonzero(inner > depth[w - a : w - a + n])
        depth[w - a + at], e[w - a + at] = inner[at], of_window[w][at]
    return e


def added(t: str, base, stretches, tags: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """The spans of the stretches' tags that may be added."""
    out = []
    for (a, _), tag in zip(stretches, tags):
        for k, s, e in spans_of(tag):
            s, e = s + a, e + a
            while s < e and t[s].isspace():
                s += 1
            while s < e and (t[e - 1].isspace() or t[e - 1] in ".,;:-"):
                e -= 1
            if s < e and plausible(k, t[s:e]) and not cuts(k, t, s, e) and not any(s < y and x < e for _, x, y in base):
                out.append((k, s, e))
    return out


def _padded(s: str) -> np.ndarray:
    out = np.full(WINDOW, _PAD, dtype=np.int64)
    own = symbols(s[:WINDOW])
    out[: len(own)] = own
    return out


def training_windows(t: str, r: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Labelled windows of one text: around base spans, as they are and respelled, with all other spans that a window meets (whole or
    cut by its edge), and places without any."""
    out = []
    base = base_spans(t)
    for k, s, e in base:
        if any(x < e and s < y and (x, y) != (s, e) for _, x, y in base):
            continue
        for body in (t[s:e], _respelled(k, t[s:e], r), _respelled(k, t[s:e], r)):
            start = s - min(s, int(r.integers(0, max(1, WINDOW - len(body)))))  # a span longer than the window is cut at its end
            text = (t[start:s] + body + t[e : e + WINDOW])[:WINDOW]
            y = np.zeros(WINDOW, dtype=np.int64)
            moved = len(body) - (e - s)
            for kind, x, z in base:
                x, z = (x + moved, z + moved) if x >= e else (x, z + moved) if (x, z) == (s, e) else (x, z)
                lo, hi = max(0, x - start), min(len(text), z - start)
                if lo < hi:
                    y[lo:hi] = 2 + 2 * kind
                    if x >= start:
                        y[lo] = 1 + 2 * kind
            out.append((_padded(text), y))
    for a, _ in places(t, base)[:2]:
        out.append(_unlabelled(t, a, base))
    return out


def _unlabelled(t: str, a: int, base) -> tuple[np.ndarray, np.ndarray]:
    """The window at a place where a span could be added, with the base spans it meets."""
    y = np.zeros(WINDOW, dtype=np.int64)
    for kind, x, z in base:
        lo, hi = max(0, x - a), min(WINDOW, z - a)
        if lo < hi:
            y[lo:hi] = 2 + 2 * kind
            if x >= a:
                y[lo] = 1 + 2 * kind
    return _padded(t[a : a + WINDOW]), y


def _respelled(kind: int, s: str, r: np.random.Generator) -> str:
    if kind == 0:
        return s.replace("@", (" @ ", "@ ", " @")[int(r.integers(3))])
    if kind == 1:
        return s.replace(".", (" . ", ". ", "-")[int(r.integers(3))])
    if kind == 2:
        d, sep = _digits(s), (".", "  ", " - ", "/")[int(r.integers(4))]
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    body = s.lstrip("+")
    return (body, re.sub(r"[ ().-]+", ".", body), re.sub(r"[ ().-]+", "-", body).strip("-"), "00" + body)[int(r.integers(4))]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger | None:
    """A tagger from at most SAMPLE_DOCS documents (first by a hash of the id) that may hold a span."""
    rows = texts(docs, id_col, text_col)
    chosen = (rows.where("doc_id is not null and text rlike '@|[0-9][0-9 .()+-]{6,}[0-9]'").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))  # so many rows at most are broadcast

    def work(batches):
        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r = np.random.Generator(np.random.PCG64(doc & ((1 << 63) - 1)))
                made = training_windows(t or "", r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(made), pa.int64()), pa.array(range(len(made)), pa.int64()),
                     pa.array([x.astype(np.int8).tobytes() + y.astype(np.int8).tobytes() for x, y in made], pa.binary())], ["doc", "k", "x"])

    made = rows.join(F.broadcast(chosen), "doc_id").mapInArrow(work, "doc long, k long, x binary")
    have = made.orderBy(F.xxhash64("doc", "k"), "doc", "k", "x").limit(SAMPLE_WINDOWS).collect()
    if not have:
        return None
    both = np.frombuffer(b"".join(r["x"] for r in have), np.int8).reshape(-1, 2, WINDOW).astype(np.int64)
    if not both[:, 1].any():
        return None
    model = Tagger(SYMBOLS, TAGS)
    model.train(both[:, 0], both[:, 1], epochs=max(8, min(60, -(-STEPS * 32 // len(both)))), batch=32)
    return model


def _all_spans(found: list[str | None], model: Tagger | None) -> list[tuple[list, list]]:
    """(base, added) spans of every text."""
    found = [t or "" for t in found]
    base = [base_spans(t) for t in found]
    if model is None:
        return [(b, []) for b in base]
    where = [places(t, b) for t, b in zip(found, base)]
    asked = [(i, w) for i, x in enumerate(where) for stretch in x for w in windows(stretch)]
    of_window: list[dict[int, np.ndarray]] = [{} for _ in found]
    for at in range(0, len(asked), 512):
        some = asked[at : at + 512]
        e = model.emissions(np.stack([_padded(found[i][w : w + WINDOW]) for i, w in some]))
        for j, (i, w) in enumerate(some):
            of_window[i][w] = e[:, j]
    tags = [[model.viterbi(reconciled(x, own)) for x in some] for some, own in zip(where, of_window)]
    return [(b, added(t, b, x, y)) for t, b, x, y in zip(found, base, where, tags)]


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


FOUND = [*((f"n_{k}", T.LongType()) for k in KINDS), ("base_sha256", T.StringType()), ("spans", T.StringType()), ("n_added", T.LongType())]


def find(docs: DataFrame, model: Tagger | None, text_col: str = "text") -> DataFrame:
    """docs plus n_<kind> and base_sha256 (of base spans), spans (all) and n_added."""
    names = [fresh(docs, n) for n, _ in FOUND]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, (_, t) in zip(names, FOUND))])
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # a few thousand weights

    def work(batches):
        own = pickle.loads(held.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                rows = _all_spans(batch.column(at).to_pylist(), own)
                counts = np.array([[sum(x[0] == i for x in b) for i in range(len(KINDS))] for b, _ in rows], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(counts[:, i]) for i in range(len(KINDS))),
                     pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b, _ in rows]),
                     pa.array([_said([*b, *x]) for b, x in rows]), pa.array([len(x) for _, x in rows], pa.int64())],
                    [*batch.schema.names, *names])

    return docs.mapInArrow(work, schema)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, train(docs)).drop("text")
