"""Toxicity, PII, SentencePiece, token counts, WARC and decontamination."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from funnelforge.llm import decontamination, pii, sentencepiece_unigram, token_counts, toxicity, warc
from funnelforge.llm import textcore as tc
from tests.llm.conftest import ODD


def toxic_table(spark, n=300):
    r = random.Random(5)
    calm = ["river", "stone", "window", "paper", "garden", "music", "yellow", "market", "winter", "letter"]
    bad = ["grobian", "widerling", "scoundrel"]
    rows = []
    for i in range(n):
        words = [r.choice(calm) for _ in range(r.randrange(5, 60))]
        if i % 4 == 0:
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels, truth = toxic_table(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).select("doc_id", "score_", toxicity.held_out("doc_id").alias("h")).collect()
    assert {r["doc_id"] for r in rows if r["h"]} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    held = [(r["score_"], truth[r["doc_id"]]) for r in rows if r["h"]]
    pairs = [(a, b) for a, x in held for b, y in held if x and not y]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.95


def test_toxicity_odd_texts_and_missing_labels(spark, docs_of):
    docs, labels, _ = toxic_table(spark, 120)
    got = toxicity.score(docs_of(ODD), toxicity.train(docs, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r["score_"] <= 1 for r in got)
    by = {r["doc_id"]: r["score_"] for r in got}
    assert by[0] == by[1]
    for some in (labels.limit(0), labels.where("toxic = 0")):
        assert all(r["score_"] == pytest.approx(0.5, abs=0.5) for r in toxicity.score(docs_of(["x"]), toxicity.train(docs, some)).collect())
    assert toxicity.score(docs_of([]), toxicity.train(docs, labels)).collect() == []


def test_ngram_buckets_do_not_depend_on_the_batch():
    texts = ["Hello É world", "", "ab", "Hello É world"]
    ids, first = toxicity.grams(*tc.buffers(pa.array(texts)))
    one, _ = toxicity.grams(*tc.buffers(pa.array(texts[:1])))
    assert (ids[first[0] : first[1]] == one).all() and (ids[first[3] : first[4]] == one).all()
    assert first[2] == first[1] and first[3] == first[2]
    assert len(one) == sum(len(texts[0]) - o + 1 for o in toxicity.ORDERS)


BASE = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(t):
    out = []
    for k, p in enumerate(BASE):
        for m in p.finditer(t):
            d = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")) or k == 2 and not (13 <= len(d) <= 19 and luhn(d)) or k == 3 and not 9 <= len(d) <= 15:
                continue
            out.append((k, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    alphabet = "ab@@..--++ ()0123456789_%é\n"
    for _ in range(4000):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(0, 60)))
        assert pii.base_spans(t) == brute_base(t), repr(t)
    t = "ü 4111 1111 1111 1111, 10.0.0.255 x.y@z.co_a@b.cd +1 (988) 555-2485 " + "9" * 3000 + " a@" * 200
    assert pii.base_spans(t) == brute_base(t)


def pii_docs(n=240):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 8)))
    out = []
    for i in range(n):
        card = "".join(str(r.randrange(10)) for _ in range(15))
        card += next(str(x) for x in range(10) if luhn(card + str(x)))
        one = [f"{word()}.{r.randrange(99):02d}@mail{r.randrange(9)}.example.com", ".".join(str(r.randrange(10, 200)) for _ in range(4)), card,
               f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"][i % 4]
        out.append(" ".join([word() for _ in range(15)] + [one] + [word() for _ in range(12)]))
    return out


def test_pii_query_columns_and_added_spans(spark, docs_of):
    train = docs_of(pii_docs())
    model = pii.train(train)
    assert model is not None
    extra = ["call us at (988) 555-2485 any day please", "mail bob.smith.11 @ mail3.example.com today", *ODD]
    docs = docs_of(extra + pii_docs(8))
    rows = {r["doc_id"]: r for r in pii.find(docs, model).collect()}
    for i, t in enumerate(extra + pii_docs(8)):
        base = brute_base(t or "")
        said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert rows[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == j for x in base) for j in range(4)]
        assert set(filter(None, said.split(","))) <= set(rows[i]["spans"].split(","))
    assert rows[0]["n_added"] + rows[1]["n_added"] >= 1
    assert pii.find(docs_of([]), None).collect() == [] and pii.train(docs_of(["no data here", None])) is None


def test_windows_cover_every_place_and_spans_cross_them():
    t = "x" * 100 + " 1 2 3 4 5 6 7 8 9 0 " * 12 + "y" * 100
    (a, b), = pii.places(t, [])
    starts = pii.windows((a, b))
    assert starts[0] == a and starts[-1] + pii.WINDOW >= b and all(y - x == pii.STRIDE for x, y in zip(starts, starts[1:]))
    marks = {w: np.full((pii.WINDOW, pii.TAGS), w - a, dtype=np.float32) for w in starts}
    origin = pii.reconciled((a, b), marks)[:, 0]
    assert len(origin) == b - a and set(origin) == {w - a for w in starts} and (np.diff(origin) >= 0).all()
    assert all(abs(i - (w + pii.WINDOW / 2)) <= pii.STRIDE / 2 + 1 for i, w in enumerate(origin) if 64 < i < b - a - 64)
    whole = np.concatenate([[7], np.full(b - a - 1, 8)])
    assert pii.spans_of(whole) == [(3, 0, b - a)]
    assert pii.added("é" * 300, [], [(0, 10)], [np.zeros(10, dtype=np.int64)]) == []


def test_crf_gradients_and_viterbi():
    from itertools import product

    from funnelforge.llm.bilstm_crf import Tagger

    m = Tagger(5, 3, 4, 3)
    r = np.random.default_rng(1)
    m.p["trans"] = r.standard_normal((3, 3)).astype(np.float32)
    x, y = r.integers(0, 5, (2, 6)), r.integers(0, 3, (2, 6))
    _, grads = m.loss(x, y)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, e = m.p[k][at], 1e-2
        m.p[k][at] = keep + e
        up = m.loss(x, y)[0]
        m.p[k][at] = keep - e
        down = m.loss(x, y)[0]
        m.p[k][at] = keep
        assert (up - down) / (2 * e) == pytest.approx(float(g[at]), abs=2e-3), k
    e = m.emissions(x)
    for b, path in enumerate(m.decode(x)):
        value = lambda s: m.p["first"][s[0]] + m.p["last"][s[-1]] + sum(e[t, b, s[t]] for t in range(6)) + sum(m.p["trans"][s[t], s[t + 1]] for t in range(5))
        assert value(tuple(path)) == pytest.approx(max(map(value, product(range(3), repeat=6))), abs=1e-4)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_unigram.load()


def brute_viterbi(text, p):
    """Best score of a text, character by character over a dictionary of pieces."""
    t = " " + text
    vocab = {bytes(p.blob[p.first[i] : p.first[i + 1]]).decode("utf-8", "replace"): p.score[i] for i in range(259, len(p.score))}
    best = [0.0] + [-np.inf] * len(t)
    for j in range(1, len(t) + 1):
        for i in range(max(0, j - 24), j):
            s = vocab.get(t[i:j])
            if s is None and j == i + 1:
                s = p.unknown
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def test_sentencepiece_round_trip_and_best_score(spark, docs_of, pieces):
    texts = [*ODD, " lead and  trail  ", "naïve café №5", "tab\tend\n", "a" * 70, "𝒳𝒴 mixed 漢字 text"]
    docs = docs_of(texts)
    rows = {r["doc_id"]: r for r in sentencepiece_unigram.decode(sentencepiece_unigram.encode(docs, pieces), pieces).collect()}
    ids_of_bytes = set(pieces.byte_id.tolist())
    for i, t in enumerate(texts):
        assert rows[i]["decoded"] == t
        if t and "▁" not in t and len(t) < 400:
            ids, k, score = rows[i]["ids"], 0, 0.0
            while k < len(ids):
                if ids[k] in ids_of_bytes:
                    raw = [int(np.flatnonzero(pieces.byte_id == ids[k])[0])]
                    n = 1 if raw[0] < 0x80 else 2 if raw[0] < 0xE0 else 3 if raw[0] < 0xF0 else 4
                    score, k = score + pieces.unknown, k + n
                else:
                    score, k = score + pieces.score[ids[k]], k + 1
            assert score == pytest.approx(brute_viterbi(t, pieces), abs=1e-6), t
    assert rows[0]["ids"] is None and rows[1]["ids"] == []
    assert sentencepiece_unigram.encode(docs_of([]), pieces).collect() == []


def test_segments_are_compared_by_their_bytes(spark, docs_of, pieces):
    word = "".join("b" if bin(i).count("1") % 2 else "a" for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = docs_of([word, other, word + " " + other])
    rows = sentencepiece_unigram.decode(sentencepiece_unigram.encode(docs, pieces), pieces).collect()
    assert all(r["decoded"] == r["text"] for r in rows) and rows[0]["ids"] != rows[1]["ids"]


def test_sentencepiece_equals_the_library_on_its_scores(pieces):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(sentencepiece_unigram.default_model(), "rb").read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for i, x in enumerate(model.pieces):
        x.score = float(pieces.score[i])
    own = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["The quick brown fox jumps", "  two  blanks", "Élan vital 日本", "one\ntwo", "x"]
    ids, first = sentencepiece_unigram.encode_column(*tc.buffers(pa.array(texts)), pieces)
    for i, t in enumerate(texts):
        want, got = own.encode(t), ids[first[i] : first[i + 1]].tolist()
        score = lambda z: sum(pieces.unknown / 3 if k in pieces.byte_id else pieces.score[k] for k in z)
        assert got == want or score(got) == pytest.approx(score(want), abs=1e-3)


def test_double_array_finds_exactly_its_keys():
    r = random.Random(2)
    keys = sorted({bytes(r.randrange(256) for _ in range(r.randrange(1, 6))) for _ in range(2000)})
    base, check, value = sentencepiece_unigram.double_array([(k, i) for i, k in enumerate(keys)])

    def find(key):
        at = 0
        for c in key:
            to = base[at] + c
            if not base[at] or check[to] != at:
                return None
            at = to
        return value[at] - 1 if value[at] else None

    assert all(find(k) == i for i, k in enumerate(keys))
    other = {bytes(r.randrange(256) for _ in range(r.randrange(1, 6))) for _ in range(2000)} - set(keys)
    assert all(find(k) is None for k in other)


def test_token_counts_after_edits_equal_a_full_count():
    c = token_counts.Counter(token_counts.default_ranks())
    r = random.Random(3)
    rnd = lambda k: "".join(r.choice(" \n\tab're's l9,.é  日'") for _ in range(k))
    for _ in range(400):
        text = rnd(r.choice([0, 3, 40, 400, 2000]))
        edits = [(s := r.randrange(0, len(text) + 1), min(len(text), s + r.choice([0, 0, 1, 3, 50])), rnd(r.choice([0, 1, 2, 10]))) for _ in range(r.randrange(0, 5))]
        new, tree, again, skipped = token_counts.edited(text, token_counts.Tree.build(text, c), edits, c)
        use, skip = token_counts.usable(edits, len(text))
        for s, e, t in reversed(use):
            text = text[:s] + t + text[e:]
        assert new == text and skipped == skip
        assert (int(tree.tokens[0]) if len(tree.tokens) else 0) == len(c.encoding.encode_ordinary(text))
        assert (token_counts.Tree.of(*tree.leaf_values()).tokens == tree.tokens).all()


def test_an_edit_of_a_long_text_cuts_a_few_leaves_again():
    c = token_counts.Counter(token_counts.default_ranks())
    text = "some words here and there, " * 3000
    _, tree, again, _ = token_counts.edited(text, token_counts.Tree.build(text, c), [(40000, 40003, "new")], c)
    assert 0 < again <= 4 * token_counts.LEAF


def test_an_edit_touches_few_sums_even_if_it_changes_the_number_of_pre_tokens(monkeypatch):
    c = token_counts.Counter(token_counts.default_ranks())
    text = "some words here and there, " * 20000
    tree = token_counts.Tree.build(text, c)
    monkeypatch.setattr(token_counts, "_sums", lambda leaves: pytest.fail("the heap was made anew"))
    for edit in [(40000, 40000, "a few more words. " * 9), (90000, 94000, ""), (200000, 200100, "x")]:
        before = [tree.chars.copy(), tree.tokens.copy()]
        text, tree, again, _ = token_counts.edited(text, tree, [edit], c)
        touched = max(int((x != y).sum()) for x, y in zip(before, (tree.chars, tree.tokens)))
        assert 0 < touched <= 12 * np.log2(len(tree.chars)) + 2 * (edit[1] - edit[0]) / 64 and again < 20 * token_counts.LEAF
        assert int(tree.tokens[0]) == len(c.encoding.encode_ordinary(text)) and int(tree.chars[0]) == len(text)


def test_stored_sums_are_what_edits_start_from(spark, docs_of):
    docs = token_counts.build(docs_of(["some words here and there, " * 50]))
    wrong = docs.withColumn("tree", F.col("tree").withField("sums", F.transform("tree.sums", lambda x: x + 1000)))
    edits = spark.createDataFrame([(0, 0, 1, "zz")], "doc_id long, start int, stop int, text string")
    right, off = (token_counts.apply_edits(token_counts.with_edits(t, edits)).first()["tree"]["n_tokens"] for t in (docs, wrong))
    assert off - right >= 1000


def test_token_trees_as_columns(spark, docs_of):
    docs = docs_of(ODD)
    trees = token_counts.build(docs)
    edits = spark.createDataFrame([(5, 0, 1, "zz"), (5, 2, 2, " q "), (6, 999, 1000, "x"), (3, None, 2, "x")], "doc_id long, start int, stop int, text string")
    rows = {r["doc_id"]: r for r in token_counts.apply_edits(token_counts.with_edits(trees, edits)).collect()}
    c = token_counts.Counter(token_counts.default_ranks())
    assert rows[5]["text"] == "zz  q b c" and rows[6]["n_skipped"] == 1 and rows[3]["n_skipped"] == 1
    for i, r in rows.items():
        assert r["tree"]["n_tokens"] == len(c.encoding.encode_ordinary(r["text"])), i


def test_warc_round_trip_against_a_dictionary(spark, tmp_path):
    long = "é" * 60 + "<p>\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(1, "http://a.b/c?d#e", long), (2, None, long), (3, "http://x y\r\n", "short"), (4, "http://z/", "short"), (5, "u", None), (6, "u", ""),
            (7, "u", long), (7, "u", long), (8, "u", "q" * 100), (None, "u", long)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "w")
    warc.write(pages, path)
    got = sorted((tuple(r) for r in warc.captures(warc.records(spark, path)).collect()), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = []
    for i, _, t in rows:
        first = min(r[0] for r in rows if r[2] == t and r[0] is not None) if len((t or "").encode()) >= 100 else i
        want.append((i, len((t or "").encode()), sha(t), "response" if first == i else "revisit", None if first == i else first, True))
    assert got == sorted(want, key=str)
    nested = warc.transactions(warc.records(spark, path)).collect()
    assert all(r["request"]["concurrent_to"] == r["response"]["record_id"] == r["metadata"]["concurrent_to"] for r in nested)
    by = {r["metadata"]["fields"].get("page-id"): r for r in nested}
    assert bytes(by["1"]["response"]["payload"]).decode() == long and by["2"]["response"]["target_uri"] == "urn:page:2"
    warc.write(pages.limit(0), path)
    assert warc.captures(warc.records(spark, path)).collect() == []


def test_warc_parser_rejects_damage_and_reads_members():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(head * 2)] == [b"abc", b"abc"]
    assert [b for _, b in warc.parse(gzip.compress(head) + gzip.compress(head))] == [b"abc", b"abc"]
    for bad in (b"junk", head[:20], head.replace(b": 3", b": 9"), head.replace(b": 3", b": 2")):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_equals_smith_waterman():
    r = random.Random(1)
    a = [[r.randrange(6) for _ in range(r.randrange(1, 30))] for _ in range(60)]
    b = [[r.randrange(6) for _ in range(r.randrange(1, 20))] for _ in range(60)]
    score, start, end = decontamination.align([np.array(x, np.uint64) for x in a], [np.array(x, np.uint64) for x in b])
    assert score.tolist() == [smith_waterman(x, y) for x, y in zip(a, b)]
    assert all(smith_waterman(x[s:e], y) == v for x, y, v, s, e in zip(a, b, score.tolist(), start.tolist(), end.tolist()))


def test_every_kind_of_edit_is_aligned(spark, docs_of):
    item = [f"q{i}" for i in range(40)]
    edits = {
        "a word after every second": [w for i, x in enumerate(item) for w in ([x] if i % 2 == 0 else [x, f"a{i}"])],
        "a word after every word": [w for i, x in enumerate(item) for w in (x, f"b{i}")],
        "every third replaced": [f"c{i}" if i % 3 == 2 else x for i, x in enumerate(item)],
        "every third missing": [x for i, x in enumerate(item) if i % 3 != 2],
        "other words": [f"d{i}" for i in range(40)],
    }
    copied = " ".join(item[:24])  # 60 % word for word in a third of the documents, the rest in none
    docs = [" ".join(["x", *v, "y"]) for v in edits.values()] + [copied if i % 3 == 0 else f"plain text number {i}" for i in range(3000)]
    got = {x["doc_id"]: x["score"] for x in decontamination.leaks(docs_of(docs), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    score = [smith_waterman(t.split(), item) / 80 for t in docs[:5]]
    want = {i: x for i, x in enumerate(score) if x >= 0.5} | {i + 5: 0.6 for i in range(0, 3000, 3)}
    assert len(want) == 1004 and got == pytest.approx(want)


def test_short_items_match_whole_texts(spark, docs_of):
    items = spark.createDataFrame([(1, "Yes"), (2, "new york"), (3, ""), (4, None), (5, "yes")], "item_id long, text string")
    got = decontamination.leaks(docs_of(["yes", " YES ", "yes it is", "New  York", "york new", None, "new york city"]), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"], r["start_word"], r["end_word"]) for r in got) == [
        (0, 1, 1.0, 0, 1), (0, 5, 1.0, 0, 1), (1, 1, 1.0, 0, 1), (1, 5, 1.0, 0, 1), (3, 2, 1.0, 0, 2)]


@pytest.mark.parametrize("expand", [8, 1 << 21])
@pytest.mark.parametrize("leak", [0.5, 0.6, 0.8])
def test_seeds_miss_no_leak(monkeypatch, expand, leak):
    monkeypatch.setattr(decontamination, "EXPAND", expand)
    r = random.Random(9)
    items = [[f"w{r.randrange(r.choice([4, 30, 200]))}" for _ in range(n)] for n in (1, 2, 3, 4, 5, 7, 10, 16, 25)]
    docs = [["alone"], []]
    for _ in range(250):
        out = [f"w{r.randrange(200)}" for _ in range(r.randrange(0, 40))]
        rate = r.choice([0.1, 0.3, 0.5])
        for w in r.choice(items):
            kind = r.random() if r.random() < rate else 1
            out += [w] if kind == 1 else ["new"] if kind < 0.3 else [w, f"w{r.randrange(200)}"] if kind < 0.7 else []
        docs.append(out + [f"w{r.randrange(200)}" for _ in range(r.randrange(0, 40))])
    block = decontamination.Block(list(range(len(items))), tc.pa.array([" ".join(x) for x in items]), leak)
    words = tc.Words(*tc.buffers(tc.pa.array([" ".join(x) for x in docs])), lower=True)
    got = {}
    for d, i, score, start, end in decontamination.leaks_of(words, block, leak):
        assert smith_waterman(docs[d][start:end], items[i]) == round(score * 2 * len(items[i]))
        got[d, i] = max(score, got.get((d, i), 0))
    best = {(d, i): smith_waterman(x, y) / (2 * len(y)) for d, x in enumerate(docs) for i, y in enumerate(items) if len(y) >= 3}
    want = {k: v for k, v in best.items() if v >= leak}
    assert len(want) > 60 and got == pytest.approx(want)
    assert decontamination.leaks_of(words, decontamination.Block([1], tc.pa.array(["a b"])), leak) == []


def test_leaks_equal_brute_force_scores(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 150)  # several blocks
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [[r.choice(vocab) for _ in range(r.choice([15, 30, 60]))] for _ in range(10)]
    docs = []
    for k in range(60):
        words = [r.choice(vocab) for _ in range(r.randrange(0, 120))]
        if k % 3 == 0:
            passage = list(r.choice(items))
            for _ in range(r.randrange(0, 5)):
                passage[r.randrange(len(passage))] = "edited"
            at = r.randrange(len(words) + 1)
            words[at:at] = passage[: r.choice([len(passage), len(passage) * 2 // 3])]
        docs.append(" ".join(words).upper() if k % 2 else " ".join(words))
    docs += [None, "", "w1 w2"]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(20, None), (21, "w1"), (22, "")], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["score"] for x in decontamination.leaks(docs_of(docs), bench).collect()}
    want = {}
    for d, t in enumerate(docs):
        for i, item in enumerate(items):
            score = smith_waterman((t or "").lower().split(), item) / (2 * len(item)) if t else 0
            if score >= decontamination.LEAK:
                want[d, i] = score
    assert got == pytest.approx(want) and len(want) >= 15
    kept = {x["doc_id"] for x in decontamination.clean(docs_of(docs), bench).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in want}
    assert decontamination.leaks(docs_of([]), bench).collect() == [] and decontamination.leaks(docs_of(docs), bench.limit(0)).collect() == []
