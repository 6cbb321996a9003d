"""Substring, line, near-duplicate and embedding deduplication against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelforge.llm import embedding_dedup, line_dedup, setsketch_dedup, shared, substring_dedup
from funnelforge.llm.cuckoo import CuckooFilter
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\v\f\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def corpus(seed, n=60):
    """Texts with shared passages, copies and near copies."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passages = [[r.choice(vocab) for _ in range(r.choice([20, 49, 50, 51, 70, 120]))] for _ in range(6)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(r.randrange(1, 4)):
            words += [r.choice(vocab) for _ in range(r.randrange(0, 60))]
            if r.random() < 0.6:
                words += r.choice(passages)
        out.append(" ".join(words))
    for _ in range(n // 4):
        words = r.choice(out).split()
        if words and r.random() < 0.7:
            words[r.randrange(len(words))] = "edited"
        out.append(" ".join(words))
    out.append("same " * 130)
    out.append("same " * 90 + "end")
    return out


def brute_substring(rows, window):
    held = {}
    for i, t in rows:
        ws = WORD.findall(t or "")
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k : k + window])
            held[key] = min(held.get(key, i), i)
    out = {}
    for n, (i, t) in enumerate(rows):
        ws = WORD.findall(t or "")
        gone = set()
        for k in range(len(ws) - window + 1):
            if held[tuple(ws[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[n] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


@pytest.mark.parametrize(("seed", "window"), [(1, 50), (2, 50), (3, 7)])
def test_substring_equals_brute_force(docs_of, seed, window):
    texts = corpus(seed) + ODD
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    got = {r["n_chars"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.dedup(docs_of(texts, ids), window=window).collect()}
    assert got == brute_substring(list(zip(ids, texts)), window)


def test_substring_repeated_ids_nulls_and_empty_table(docs_of):
    long = " ".join(f"a{i}" for i in range(60))
    rows = [(1, long), (1, long), (None, long), (2, long), (2, "x " * 60)]
    got = {(r["doc_id"], r["n_chars"]): r["n_removed"] for r in substring_dedup.dedup(docs_of([t for _, t in rows], [i for i, _ in rows])).collect()}
    assert got == {(1, 0): 0, (1, 1): 0, (None, 2): 0, (2, 3): 60, (2, 4): 0}
    assert substring_dedup.dedup(docs_of([])).collect() == []


def brute_lines(rows, min_chars=20, min_docs=3):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(BLANK))
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(i)
    blocked = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (blocked.get(lower(x.strip(BLANK)), -1) > i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def line_corpus(seed, n=80):
    r = random.Random(seed)
    pool = [f"Line number {i} with É text {i * 7}" for i in range(30)] + ["short", "exactly twenty chars", "exactly 19 charslong"]
    return ["\n".join(r.choice(["", " ", "\t"]) + (x.upper() if r.random() < 0.2 else x) + r.choice(["", " \r"]) for x in r.choices(pool, k=r.randrange(0, 6)))
            for _ in range(n)] + ["a very common line in many documents"] * 40


def applied(index, docs):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.apply(index, docs).collect()}


def test_lines_equal_brute_force(docs_of):
    texts = line_corpus(5) + ODD
    docs = docs_of(texts)
    assert applied(line_dedup.build(docs), docs) == brute_lines(list(enumerate(texts)))


def test_line_index_insert_and_delete_are_reversible(docs_of):
    texts = line_corpus(6)
    rows = list(enumerate(texts))
    docs = docs_of(texts)
    some = docs.where("doc_id < 50")
    base = line_dedup.build(some)
    grown = line_dedup.insert(base, docs.where("doc_id >= 50"))
    assert applied(grown, docs) == brute_lines(rows)
    back = line_dedup.delete(grown, docs.where("doc_id >= 50"))
    assert applied(back, some) == applied(base, some) == brute_lines(rows[:50])
    for a, b in ((back.refs, base.refs), (grown.refs, line_dedup.build(docs).refs)):
        assert sorted(map(tuple, a.select("k1", "k2", "n_docs", "max_doc").collect())) == sorted(map(tuple, b.select("k1", "k2", "n_docs", "max_doc").collect()))


def test_lines_null_ids_and_empty_table(docs_of):
    line = "a line that is long enough"
    docs = docs_of([line] * 5, [None, 1, 2, 2, 3])
    got = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in line_dedup.apply(line_dedup.build(docs), docs).collect())
    assert got == [(0, 0), (1, 1), (2, 1), (2, 1), (3, 0)]
    empty = docs_of([])
    assert line_dedup.apply(line_dedup.build(empty), empty).collect() == []


def test_cuckoo_filter_holds_and_forgets():
    r = np.random.default_rng(1)
    k = r.integers(-(1 << 62), 1 << 62, (3000, 2))
    f = CuckooFilter(1000)  # more keys than it was made for: it grows
    f.insert(k[:1500, 0], k[:1500, 1])
    f = CuckooFilter.from_bytes(f.to_bytes())
    assert f.contains(k[:1500, 0], k[:1500, 1]).all()
    assert f.contains(k[1500:, 0], k[1500:, 1]).mean() < 0.05
    f.delete(k[:700, 0], k[:700, 1])
    assert f.contains(k[700:1500, 0], k[700:1500, 1]).all()
    f.delete(k[700:1500, 0], k[700:1500, 1])
    assert not any(t.any() for t in f.tables) and not f.stash


def test_cuckoo_filter_takes_many_times_its_capacity_in_linear_time():
    import time

    k = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, (40000, 2))
    f, spent = CuckooFilter(2000), []
    for at in range(0, 40000, 10000):
        begin = time.time()
        f.insert(k[at : at + 10000, 0], k[at : at + 10000, 1])
        spent.append(time.time() - begin)
    assert len(f.stash) < 50 and len(f.tables) > 2 and max(spent) < 8 * min(spent) + 1
    f = CuckooFilter.from_bytes(f.to_bytes())
    assert f.contains(k[:, 0], k[:, 1]).all()
    f.delete(k[:30000, 0], k[:30000, 1])
    assert f.contains(k[30000:, 0], k[30000:, 1]).all() and f.contains(k[:30000, 0], k[:30000, 1]).mean() < 0.05


def test_line_index_grows_its_shards_with_the_blocked_lines(spark, docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 8)
    line = lambda i: f"a line of text number {i} that repeats"
    small = docs_of([line(0)] * 3)
    more = docs_of(["\n".join(line(i) for i in range(1, 400))] * 3, ids=[10, 11, 12])
    index = line_dedup.build(small)
    grown = line_dedup.insert(index, more)
    assert index.shards == 16 and grown.shards >= 400 // 8 and grown.filters.count() > 16
    whole = line_dedup.build(small.unionByName(more))
    got, want = (sorted((r["doc_id"], r["n_dropped"], r["kept_text"]) for r in line_dedup.apply(x, small.unionByName(more)).collect()) for x in (grown, whole))
    assert got == want and sum(x[1] for x in got) == 2 + 2 * 399


def test_a_hot_line_is_probed_in_several_places(spark, docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBED", 50)
    docs = docs_of(["the same line of text in every document"] * 400)
    rows = line_dedup.apply(line_dedup.build(docs), docs).collect()
    assert sorted(r["n_dropped"] for r in rows) == [0] + [1] * 399
    index = line_dedup.build(docs)
    parts = line_dedup._probe(index, index.postings)
    assert parts.count() == 400


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_of_a_built_pattern_do_not_collide(spark, docs_of):
    one, two = thue_morse(4096), thue_morse(4096, "b", "a")
    words = [f"w{i}" for i in range(49)]
    texts = [" ".join([one, *words]), " ".join([two, *words]), one, two]
    rows = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup(docs_of(texts)).collect()}
    assert rows == {0: 0, 1: 0, 2: 0, 3: 0}
    near = {r["doc_id"]: r["component_id"] for r in setsketch_dedup.dedup(docs_of(texts[2:])).collect()}
    assert near == {0: 0, 1: 1}


def test_a_star_of_links_is_split_over_tasks(spark):
    n = 20000
    star = spark.range(1, n + 1).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("v"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(keep, ("10k", "2", "10k", "-1")):
        spark.conf.set(k, v)
    try:
        got = shared.components(star)
        assert got.where("component = 0").count() == n + 1
        sides = shared.written(star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v"))), "sides")
        least = shared.written(sides.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = sides.join(least, "u")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def shingles(t, n):
    ws = WORD.findall(lower(t or ""))
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def brute_near(texts, n, percent):
    sets = [shingles(t, n) for t in texts]
    comp = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = comp[a], comp[b]
            comp = [min(x, y) if c in (x, y) else c for c in comp]
    return {i: (len(s), comp[i]) for i, s in enumerate(sets)}


def near_corpus(seed):
    """A large family of near copies around the threshold, and unrelated texts."""
    r = random.Random(seed)
    base = [f"b{r.randrange(500)}" for _ in range(60)]
    out = corpus(seed, 30)
    for _ in range(120):
        words = list(base)
        for _ in range(r.randrange(0, 4)):
            words[r.randrange(60)] = f"e{r.randrange(100)}"
        out.append(" ".join(words))
    return out + ["Tiny", "tiny", "two words", "two WORDS"]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_near_dedup_equals_brute_force(docs_of, seed, n, percent):
    texts = near_corpus(seed) + ODD
    rows = setsketch_dedup.dedup(docs_of(texts), shingle=n, percent=percent).collect()
    want = brute_near(texts, n, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_a_common_line_makes_no_family_of_short_texts(docs_of, monkeypatch):
    """Texts that only share a line meet in buckets by chance; the family they formed before grew with the table."""
    r = random.Random(8)
    line = " ".join(f"c{i}" for i in range(14))
    texts = [f"{line}\n{' '.join(f'v{r.randrange(5000)}' for _ in range(14))}" for _ in range(700)]
    for t in texts[:40]:
        texts.append(" ".join(t.split()[:-1] + ["edited"]))
        texts.append(" ".join(["other", "words", "first", *t.split()]))
    largest, found = [], setsketch_dedup._family_links

    def watched(members, *rest):
        largest.append(members.groupBy("family").count().agg(F.max("count")).first()[0] or 0)
        return found(members, *rest)

    monkeypatch.setattr(setsketch_dedup, "_family_links", watched)
    rows = setsketch_dedup.dedup(docs_of(texts), shingle=3, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_near(texts, 3, 85)
    assert largest and max(largest) <= 10  # 331 of the 780 before


def star(seed, copies=250, words=80):
    """Copies of one text, edited in up to a quarter of the words."""
    r = random.Random(seed)
    base = [f"b{r.randrange(500)}" for _ in range(words)]
    return [" ".join(f"e{r.randrange(300)}" if r.random() < share else w for w in base) for share in (r.choice([0, 0.02, 0.05, 0.1, 0.25]) for _ in range(copies))]


def test_near_dedup_of_a_star_in_chunks_equals_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(setsketch_dedup, "CHUNK_BUCKET", 30)
    monkeypatch.setattr(setsketch_dedup, "CHUNK_MEMBERS", 40)
    texts = star(3)
    rows = setsketch_dedup.dedup(docs_of(texts), shingle=3, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_near(texts, 3, 85)


@pytest.mark.parametrize("small", [1, 64])
def test_near_members_of_buckets_equal_brute_force(monkeypatch, small):
    monkeypatch.setattr(setsketch_dedup, "_SMALL", small)
    monkeypatch.setattr(setsketch_dedup, "_PAIRS", 50)
    r = np.random.default_rng(small)
    first = np.concatenate([[0], np.cumsum(r.integers(1, 90, 10))])
    rows = first[-1]
    low = r.integers(0, 256, (6, setsketch_dedup.REGISTERS))[r.integers(0, 6, rows)]
    low = np.where(r.random(low.shape) < 0.6 * r.random((rows, 1)), r.integers(0, 256, low.shape), low).astype(np.uint8)
    n, component = r.integers(80, 120, rows), r.integers(0, rows // 3, rows)
    want = [(i, j) for x, y in zip(first[:-1], first[1:]) for i, j in itertools.combinations(range(x, y), 2)
            if component[i] != component[j] and min(n[i], n[j]) * 100 >= 85 * max(n[i], n[j]) and (low[i] == low[j]).sum() >= 120]
    forest = lambda i, j: shared.spanning(np.arange(rows), np.array(i), np.array(j)).tolist()
    assert want
    assert forest(*setsketch_dedup._near(first, low, n, component, 120, 85)) == forest(*zip(*want))


@pytest.mark.parametrize(("sparse", "cells", "columns"), [(256, 1 << 22, 2048), (2, 300, 7), (0, 300, 7)])
def test_shared_counts_equal_intersections(monkeypatch, sparse, cells, columns):
    for name, value in (("_SPARSE", sparse), ("_CELLS", cells), ("_COLUMNS", columns)):
        monkeypatch.setattr(setsketch_dedup, name, value)
    r = np.random.default_rng(7)
    sets = [np.unique(np.concatenate([r.integers(0, 40, k), r.integers(0, 4000, 2 * k)])).astype(np.uint64) for k in r.integers(1, 30, 60)]
    every, side = np.arange(60), r.random(60) < 0.4
    for a, b in ((every, every), (np.flatnonzero(side), np.flatnonzero(~side))):
        got = np.concatenate([counts for _, counts in setsketch_dedup.shared_counts(sets, a, b)])
        want = np.array([[len(np.intersect1d(sets[i], sets[j])) for j in b] for i in a])
        other = a[:, None] != b[None, :]
        assert (got[other] == want[other]).all()


def test_near_dedup_repeated_and_null_ids(docs_of):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (4, None), (5, "")]
    got = setsketch_dedup.dedup(docs_of([t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (3, 1, False), (4, 4, True), (5, 5, True)]
    assert setsketch_dedup.dedup(docs_of([])).collect() == []


def test_sketches_estimate_and_merge():
    from funnelforge.llm import textcore as tc
    import pyarrow as pa

    r = random.Random(4)
    words = [f"v{i}" for i in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[400:2400])  # about 1600 of 2400 shared
    both = " ".join(words[:2400])
    tiny = [f"{r.random()}" for _ in range(3)]
    sets = setsketch_dedup.ShingleSets(*tc.buffers(pa.array([a, b, both, *tiny])), 1)
    regs = setsketch_dedup.sketch(sets)
    assert (setsketch_dedup.merge(regs[0], regs[1]) == regs[2]).all()
    one = np.array([2000.0])
    assert abs(setsketch_dedup.likelihood_similarity(regs[:1], regs[1:2], one, one)[0] - 1600 / 2400) < 0.12
    assert (regs[3:] > 0).all()


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in shared.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 400)]}}


def vectors(seed=3):
    r = np.random.default_rng(seed)
    centre = r.standard_normal((12, 16))
    out = [(c + 0.2 * r.standard_normal(16)).astype(np.float32).tolist() for c in centre for _ in range(12)]
    return out + out[:5] + [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]


def test_embedding_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows)], "vec_id long, embedding array<float>, copies string")
    got = {r["vec_id"]: r for r in embedding_dedup.dedup(df).collect()}
    ok = [i for i, v in enumerate(rows) if v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = set()
    for a, b in itertools.combinations(ok, 2):
        x, y = np.array(rows[a], np.float64), np.array(rows[b], np.float64)
        if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.95:
            links.add((a, b))
    assert len(links) > 100
    found = sum(r["n_links"] for r in got.values()) / 2
    assert 0.9 * len(links) <= found <= len(links)
    for i in set(got) - set(ok):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert embedding_dedup.dedup(df.limit(0)).collect() == []


def test_embedding_recall_is_measured_at_the_threshold():
    r = np.random.default_rng(2)
    x = r.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = r.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    model = embedding_dedup.Itq(x, len(x))
    assert (model.codes(x) == model.codes(y)).any(1).mean() > 0.998


def common_mean(r, n, mean, dims=64):
    """n unit vectors whose cosine is mean on average, and a partner of each at a cosine just over 0.95."""
    x = np.sqrt(mean) * np.eye(dims)[0] + np.sqrt((1 - mean) / dims) * r.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = r.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    return x, 0.9501 * x + np.sqrt(1 - 0.9501**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)


@pytest.mark.parametrize("mean", [0.0, 0.5, 0.7, 0.8])
def test_embedding_recall_with_a_common_mean(mean):
    x, y = common_mean(np.random.default_rng(5), 4000, mean)
    for classes in (len(x), 10**6):
        model = embedding_dedup.Itq(x, classes)
        assert 0 < len(model.tables) <= embedding_dedup.MOST and model.recall >= (embedding_dedup.RECALL if classes < 10**6 or mean < 0.7 else 0.97)
        assert (model.codes(x) == model.codes(y)).any(1).mean() > 0.97


def test_substrings_grow_with_the_classes_and_copies_with_the_tables_only():
    x = np.random.default_rng(9).standard_normal((2000, 64))
    seen = []
    for classes in (100, 50_000, 10**7, 10**9):
        model = embedding_dedup.Itq(x, classes)
        width = {j - i for _, i, j in model.tables}
        assert len(width) == 1 and model.codes(x).shape == (2000, len(model.tables)) and model.recall >= 0.99
        seen.append((width.pop(), len(model.tables)))
    assert [w for w, _ in seen] == [4, 6, 14, 20] and seen[-1][1] <= 100
    most = np.bincount(embedding_dedup.Itq(x, 50_000).codes(x)[:, 0], minlength=64).max()
    assert most < 4 * 2000 / 64  # balanced


def test_large_and_small_doubles_link(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((40, 8))
    rows = [*(x * 1e200).tolist(), *(x * 1e-200).tolist(), *(x + 0.001).tolist()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.dedup(df).collect()}
    unit = np.concatenate([x, x, x + 0.001])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    assert {i: n for i, (n, _) in got.items()} == {i: int(link[i].sum()) - 1 for i in range(120)}
    assert all(got[i][1] == got[i + 40][1] == got[i + 80][1] for i in range(40))


def test_embedding_links_with_a_common_mean_and_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 128)
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 1000)
    r = np.random.default_rng(6)
    x, y = common_mean(r, 600, 0.8)
    cluster = x[0] + 0.3 / 8 * r.standard_normal((600, 64))  # a third of the rows, cosine about 0.92
    rows = np.concatenate([x, y, cluster]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    got = {v["vec_id"]: v["n_links"] for v in embedding_dedup.dedup(df).collect()}
    unit = rows.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    assert want[:1200].sum() >= 1200 and want[1200:].sum() > 100
    for part in (range(1200), range(1200, 1800)):
        assert 0.97 * want[part].sum() <= sum(got[i] for i in part) <= want[part].sum()


@pytest.mark.parametrize("sample", [40, 8192])
def test_embedding_links_within_every_length(spark, monkeypatch, sample):
    monkeypatch.setattr(embedding_dedup, "SAMPLE", sample)  # 40: the codes of the two longer lengths are learned from some of their vectors
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    r = np.random.default_rng(8)
    rows = []
    for dims, n in ((3, 5), (24, 60), (64, 90)):
        x = r.standard_normal((n, dims)).astype(np.float32)
        rows += [v.tolist() for v in [*x, *(x + np.float32(0.01)), x[0]]]
    rows += [[5.0], [2.0], [-1.0], None, []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    got = {v["vec_id"]: (v["n_links"], v["component_id"], v["kept"]) for v in embedding_dedup.dedup(df).collect()}
    links = {i: set() for i in range(len(rows))}
    for i, j in itertools.combinations(range(len(rows)), 2):
        if rows[i] and rows[j] and len(rows[i]) == len(rows[j]):
            x, y = np.array(rows[i]), np.array(rows[j])
            if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.95:
                links[i].add(j)
                links[j].add(i)
    component = list(range(len(rows)))
    for _ in rows:
        component = [min([component[i], *(component[j] for j in links[i])]) for i in range(len(rows))]
    assert got == {i: (len(links[i]), component[i], component[i] == i) for i in links}


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op2_minhash_near_dedup", "op5_warc", "op7_line_dedup", "op9_embedding_near_dedup"])
def test_query_equals_duckdb(spark, name):
    import duckdb

    import __spark_entry__ as entry
    from tests.llm.conftest import SF

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted((tuple(r) for r in cur.fetchall()), key=str)
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want


def test_op2_and_op7_hashes(spark):
    """The thin queries hash what the operators keep."""
    from tests.llm.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = line_dedup.apply(line_dedup.build(docs), docs).select("doc_id", F.sha2("kept_text", 256)).limit(5).collect()
    by = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.op7_line_dedup(spark, SF).collect()}
    assert all(by[i] == h for i, h in kept)
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
