"""Added personal-data spans: precision and recall on planted respelled data, and what must be left alone."""

import random

import numpy as np
import pytest

from funnelforge.llm import pii
from tests.llm.test_models_and_tokens import luhn

WORDS = "the of and to in for that with on as by this from at order call mail host number page line item section year".split()


def value(kind, r):
    if kind == 0:
        return f"{r.choice(['ann', 'bob', 'jean'])}.{r.choice(['smith', 'lee', 'roy'])}{r.randrange(99)}@{r.choice(['mail', 'post', 'srv'])}{r.randrange(9)}.example.{r.choice(['com', 'org'])}"
    if kind == 1:
        return ".".join(str(r.randrange(1, 255)) for _ in range(4))
    if kind == 2:
        body = "".join(str(r.randrange(10)) for _ in range(15))
        return body + next(str(x) for x in range(10) if luhn(body + str(x)))
    return f"+{r.randrange(1, 99)} {r.randrange(200, 999)} {r.randrange(200, 999)}-{r.randrange(1000, 9999)}"


def filler(r, n):
    return " ".join(str(r.randrange(10000)) if r.random() < 0.08 else r.choice(WORDS) for _ in range(n))


def planted(seed, n, respell):
    """Texts and, for each, the spans planted into them."""
    r, g, out = random.Random(seed), np.random.default_rng(seed), []
    for i in range(n):
        t, spans = filler(r, 12), []
        for _ in range(r.choice([1, 1, 2])):
            k = r.randrange(4)
            body = value(k, r)
            if respell:
                body = pii._respelled(k, body, g)
            t += " " + r.choice(["at ", "is ", "to ", ": "])
            spans.append((k, len(t), len(t) + len(body)))
            t += body + " " + r.choice(WORDS) + " " + filler(r, r.randrange(3, 12))
        out.append((t, spans))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t) for i, (t, _) in enumerate(planted(1, 900, False))]
    return pii.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_respelled_data_are_found_with_precision(model):
    rows = planted(2, 400, True)
    found = pii._all_spans([t for t, _ in rows], model)
    right = wrong = missed = 0
    for (t, spans), (base, extra) in zip(rows, found):
        want = {x for x in spans if x not in base}
        # The blank edges of a respelled value ("+" left out, a leading "00") belong to it; digits and names must agree.
        core = lambda x: (x[0], pii._digits(t[x[1] : x[2]]) if x[0] else t[x[1] : x[2]].replace(" ", ""))
        got, aim = {core(x) for x in extra}, {core(x) for x in want}
        right, wrong, missed = right + len(got & aim), wrong + len(got - aim), missed + len(aim - got)
    print("added spans: right", right, "wrong", wrong, "missed", missed)
    assert right / max(1, right + wrong) >= 0.95 and right / (right + missed) >= 0.5


def test_clean_texts_and_failing_numbers_are_left_alone(model):
    r = random.Random(5)
    texts = [filler(r, 60) for _ in range(200)]
    bad = []
    for _ in range(200):
        d = "".join(str(r.randrange(10)) for _ in range(r.choice([14, 15, 16, 17, 21, 24])))
        if not luhn(d):
            bad.append(f"order {d} of the {r.choice(WORDS)}")
            bad.append(f"number {' '.join(d[i : i + 4] for i in range(0, len(d), 4))} in line")
    texts += bad + ["host 300.1.2.3 and 1.2.3.4.5 are not", "version 2123465659789240 and 5731080387325255", "see 10.20.30 or 1999-2001"]
    extra = [(t, [t[s:e] for _, s, e in x]) for t, (_, x) in zip(texts, pii._all_spans(texts, model)) if x]
    assert len(extra) <= 0.01 * len(texts), extra[:10]
    for t, some in extra:
        for x in some:
            i = t.find(x)
            assert not t[i - 1 : i].isalnum() and not t[i + len(x) : i + len(x) + 1].isalnum()


@pytest.mark.parametrize("t,kind,part", [
    ("id 2123465659789240 x", 2, "12346565978924"), ("no 5731080387325255 x", 2, "7310803873252"), ("a 1234 5678 9012 3456 7 b", 2, "1234 5678 9012 3456"),
    ("ip 1.2.3.4.5 z", 1, "1.2.3.4"), ("mail bob @ mail.example.com", 0, "ob @ mail.example.com"), ("mail bob @ mail.example.com", 0, "bob @ mail.exam"),
    ("bob @ mail . example . com", 0, "bob @ mail . example"), ("tel 555 010 2030 44", 3, "555 010 2030")])
def test_a_part_of_a_run_is_cut(t, kind, part):
    s = t.find(part)
    assert pii.cuts(kind, t, s, s + len(part))
    tag = np.zeros(len(t), dtype=np.int64)
    tag[s : s + len(part)] = 2 + 2 * kind
    tag[s] = 1 + 2 * kind
    assert pii.added(t, [], [(0, len(t))], [tag]) == []


@pytest.mark.parametrize("t", ["write to alice @ department.university.example.org today", "a.very.long.name.of.somebody.else.who.writes @ x.example.org",
                               "write to bob @ one . two . three . four . five . six . seven . example . org now"])
def test_stretches_reach_to_where_names_end(t):
    (a, b), = pii.places(t, pii.base_spans(t))
    assert a <= t.find(t.split("@")[0].split()[-1]) and b >= t.rfind("org") + 3


def test_long_runs_take_linear_time():
    t = ("x" * 97 + "@ 1") * 3000
    assert sum(b - a for a, b in pii.places(t, [])) <= len(t)


def test_windows_with_several_spans_are_labelled():
    r = np.random.default_rng(0)
    t = "mail ann.lee@mail.example.com or bob@post.example.org and 10.20.30.40 x"
    made = pii.training_windows(t, r)
    kinds = [len({y for y in tags.tolist() if y % 2}) for _, tags in made]
    assert max(kinds) == 2 and max(sum(y % 2 for y in tags.tolist()) for _, tags in made) >= 2
    long = "x" * 90 + "@mail.example.com"
    assert pii.training_windows("see " + long, r)


def test_viterbi_respects_transitions_across_windows():
    from funnelforge.llm.bilstm_crf import Tagger

    m = Tagger(5, 3, 4, 3)
    m.p["trans"] = np.array([[0, 0, -50], [0, -50, 3], [0, -50, 3]], dtype=np.float32)  # 2 only after 1 or 2
    e = np.random.default_rng(2).standard_normal((300, 3)).astype(np.float32) * 2
    tags = m.viterbi(e)
    assert all(x in (1, 2) for x, y in zip(tags, tags[1:]) if y == 2) and (tags == 2).any()
