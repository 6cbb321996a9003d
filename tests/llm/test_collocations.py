"""Phrase collocations against brute force, and quotient filters against dictionaries."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from funnelforge.llm import collocations as co
from funnelforge.llm import quotient_filter as qf
from tests.llm.conftest import ODD, SF


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_count, longest=5, percent=100, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f.setdefault(lang, Counter())[tuple(ws[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = {}
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), a)
        found = []
        for p, a in cand.items():
            if p in inside and 100 * inside[p] >= percent * a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), " ".join(p), a, counts[p[:k]], counts[p[k:]], score))
        for rank, (_, _, _, phrase, a, left, right, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase, a, left, right, n[lang], score))
    return sorted(out)


def corpus(seed, n=120):
    r = random.Random(seed)
    vocab = ["of", "the", "Of", "É", "née", "a_b", " x", "日本", "w" * 300] + [f"v{i}" for i in range(30)]
    fixed = ["new york city hall", "the united states of america now", "a rose is a rose is a rose", "x x x x x x"]
    rows = []
    for _ in range(n):
        parts = [r.choice(vocab) if r.random() < 0.7 else r.choice(fixed) for _ in range(r.randrange(0, 40))]
        rows.append((r.choice(["en", "en", "de", None, "und", ""]), "".join(p + r.choice([" ", "\t ", ", ", "\n", ". "]) for p in parts)))
    return rows + [("en", rows[0][1])] * 20


def collect(spark, rows, **kw):
    docs = spark.createDataFrame([(t, lang, "c", "d") for lang, t in rows], "text string, lang string, chunk string, a string")
    return sorted(map(tuple, co.collocations(docs, **kw).collect()))


def test_collocations_equal_brute_force(spark):
    rows = corpus(1) + [("odd", t) for t in ODD]
    want = brute(rows, 4)
    assert collect(spark, rows, min_count=4) == want and len({len(w[2].split()) for w in want}) == 4


def test_other_parameters_many_shards_and_flushes(spark, monkeypatch):
    import funnelforge.llm.textcore as tc

    rows = corpus(2)
    monkeypatch.setattr(co, "PER_SHARD", 64)
    monkeypatch.setattr(co, "CHUNK", 300)
    monkeypatch.setattr(co, "BLOOM", 1 << 16)
    count = co.count_grams
    monkeypatch.setattr(co, "count_grams", lambda *a, **kw: count(*a, **kw, hold=50))
    assert collect(spark, rows, min_count=3, longest=3, percent=70, top=5) == brute(rows, 3, 3, 70, 5)
    assert tc.SLICE_BYTES > co.CHUNK


def test_nothing_to_find(spark):
    assert collect(spark, []) == [] and collect(spark, [(None, None), ("en", ""), ("en", "a, b. c")], min_count=1) == []
    assert collect(spark, [("en", "one two")], min_count=1) == [("en", 1, "one two", 1, 1, 1, 2, 2000)]


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 7), (2, 31), (3, 13), (4, 16), (5, 13), (5, 25), (5, 31)])
def test_filters_are_lossless(n, bits):
    r = np.random.default_rng(n * 100 + bits)
    keys = qf.Keys(n, bits)
    ids = [r.integers(0, 1 << bits, 5000).astype(np.uint32) for _ in range(n)]
    ids = [np.concatenate([x, x[:1000], x[:10].repeat(300)]) for x in ids]
    want = Counter(zip(*[x.tolist() for x in ids]))
    shard_bits = min(3, keys.widths[0] - 1)
    found = Counter()
    for half in (slice(0, 4000), slice(4000, None)):  # two filters a shard, merged by adding
        columns, counts = qf.combine(keys.permute(keys.pack([x[half] for x in ids])), np.ones(len(ids[0][half]), dtype=np.int64))
        shard = qf.shards(columns[0], keys.widths[0], shard_bits)
        for s in np.unique(shard):
            at = shard == s
            data = qf.encode([c[at] for c in columns], counts[at], keys.widths, shard_bits)
            again, n_again = qf.decode(data, keys.widths)
            assert all((a == c[at]).all() for a, c in zip(again, columns)) and (n_again == counts[at]).all()
            found.update(dict(zip(zip(*[x.tolist() for x in keys.ids(again)]), n_again.tolist())))
    assert found == want


def test_permutation_spreads_the_shards():
    keys = qf.Keys(2, 14)
    columns = keys.permute(keys.pack([np.repeat(np.arange(200), 200).astype(np.uint32), np.tile(np.arange(200), 200).astype(np.uint32)]))
    assert len(np.unique(columns[0])) == 40000
    assert np.bincount(qf.shards(columns[0], 28, 4), minlength=16).max() < 1.1 * 40000 / 16


def test_query_equals_its_sql(spark):
    got = sorted(map(tuple, co.op13_phrase_collocations(spark, SF).collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got and got == sorted(db.execute(co.OP13_SQL).fetchall())
