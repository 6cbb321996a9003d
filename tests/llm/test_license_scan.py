"""License scan against brute force, and its plan."""

import random
import re

import duckdb

from funnelforge.llm import license_scan as ls
from tests.llm.conftest import ODD, SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(text):
    """(n_words, sorted spans) by comparing every place with every template place."""
    ws = WORD.findall(lower(text or ""))
    spans = []
    for notice, some in ((False, ls.PHRASES), (True, ls.NOTICES)):
        for label, template in some:
            t = template.split()
            met = {}
            for j in range(len(t) - 1):
                for i in range(len(ws) - 1):
                    if ws[i] == t[j] and ws[i + 1] == t[j + 1]:
                        met.setdefault(i - j, set()).add(j)
            need = ls.VOTES if notice else len(t) - 1
            groups = []
            for d in sorted(d for d in met if len(met[d]) >= need):
                if notice and groups and d - groups[-1][-1] <= ls.NEAR:
                    groups[-1].append(d)
                else:
                    groups.append([d])
            for g in groups:
                covered = {p for d in g for j in met[d] for p in (j, j + 1)}
                first, end = min(d + min(met[d]) for d in g), max(d + max(met[d]) for d in g) + 1
                if len(covered) / len(t) >= ls.SHARE and end - first < 2 * len(t):
                    spans.append((first, end, label, notice, len(covered) / len(t)))
    return len(ws), sorted(spans)


def planted(seed):
    r = random.Random(seed)
    filler = ["of", "the", "software", "license", "copy", "x1", "née", "this", "mit", "cc", "by", "gnu", "free"]
    out = []
    for _ in range(60):
        ws = [r.choice(filler) for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(0, 3)):
            copy = r.choice(ls.NOTICES + ls.PHRASES)[1].split()
            for _ in range(r.randrange(0, 6)):
                at = r.randrange(len(copy))
                copy[at : at + r.randrange(0, 2)] = r.choice([[], ["edit"], ["two", "more"]])
                copy = copy or ["gone"]
            ws += copy + [r.choice(filler) for _ in range(r.randrange(0, 30))]
        out.append(r.choice([" ", ", ", "\n\n", " - "]).join(w.upper() if r.random() < 0.3 else w for w in ws))
    return out


def test_spans_equal_brute_force(spark, docs_of):
    texts = ODD + planted(1) + planted(2)[:30] + ["MIT License MIT license", "mit", "the mıt lİcense", "GNU\x00General (Public) License", "cc by" * 2, "K license mit K"]
    ids = [None, 5, 5] + list(range(3, len(texts)))
    docs = docs_of(texts, ids).withColumnRenamed("tkey", "license_spans").withColumnRenamed("score", "ROW")
    got = ls.scan(docs).collect()
    key = lambda r: r["n_chars"]  # noqa: E731  (the place in the list)
    assert sorted(map(key, got)) == list(range(len(texts)))
    for r in got:
        n, spans = brute(texts[r["n_chars"]])
        assert r["n_words"] == n and r["doc_id"] == ids[r["n_chars"]] and r["license_spans"] == "mine" and r["ROW"] == 1.5
        assert [tuple(s) for s in r["license_spans_"]] == spans, texts[r["n_chars"]]


def test_notices_are_found_without_their_names(spark, docs_of):
    mit = ls.NOTICES[0][1]
    cut = mit.split()
    del cut[20:23]
    cut[40:40] = ["freely"]
    rows = ls.scan(docs_of(["x y " + mit.upper(), "z " + " ".join(cut), "the software is free of charge and the license of the software"])).orderBy("doc_id").collect()
    assert [{s["label"] for s in r["license_spans"]} for r in rows] == [{"mit"}, {"mit"}, set()]
    assert rows[0]["license_spans"][0]["score"] == 1.0 and 0.9 < rows[1]["license_spans"][0]["score"] < 1.0


def test_empty_table_and_no_templates(spark, docs_of):
    docs = docs_of(["mit license", None])
    assert ls.scan(docs.limit(0)).count() == 0
    assert [(r["n_words"], r["license_spans"]) for r in ls.scan(docs, notices=[], phrases=[("mit", "mit")]).orderBy("doc_id").collect()] == [(2, []), (0, [])]
    three = ls.scan(docs_of(["a b gnu general public license", "gnu general", "mit license"]), k=3).orderBy("doc_id").collect()
    assert [[(s["label"], s["first_word"]) for s in r["license_spans"]] for r in three] == [[("gpl", 2)], [], []]


def test_plan_is_native_with_one_exchange_of_hits(spark):
    plan = ls.op12_license_scans(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoop"))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 1


def test_query_equals_its_sql(spark):
    got = sorted(map(tuple, ls.op12_license_scans(spark, SF).collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got == sorted(db.execute(ls.OP12_SQL).fetchall()) and sum(r[2] for r in got) > 0
