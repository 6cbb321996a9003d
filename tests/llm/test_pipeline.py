"""Every pipeline stage against a brute-force version on a small planted corpus."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import brute_lines, brute_near, near_corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    texts = near_corpus(9)[:120]
    line = "One line that a good many of the documents hold"
    texts = [t + "\n" + line if i % 5 == 0 else t for i, t in enumerate(texts)] + [None, "", "grobian " + texts[3]]
    toxic = {i for i in range(0, 60, 6)} | {len(texts) - 1}
    texts = [(t or "") + " grobian widerling" if i in toxic and t is not None else t for i, t in enumerate(texts)]
    item = " ".join(f"quiz{i}" for i in range(25))
    texts += ["before " + item + " after", "nothing to see"]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(len(texts) - 4)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), texts, toxic, item


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_in_order(spark, folder):
    sf, texts, toxic, item = folder
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash_near_dedup", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)

    calm = corpus_pipeline.written(stage["toxicity"](spark, docs, sf), "t")
    kept = rows(calm)
    assert calm.columns == docs.columns and not any("grobian" in (t or "") for t in kept.values())
    assert len(kept) >= len(texts) - len(toxic) - 1

    cut = corpus_pipeline.written(stage["line_dedup"](spark, calm, sf), "t")
    want = brute_lines(sorted(kept.items()))
    assert rows(cut) == {i: (None if kept[i] is None else t) for i, (_, _, t) in want.items()}
    assert cut.where(F.col("n_chars") != F.char_length(F.coalesce("text", F.lit("")))).count() == 0

    one = corpus_pipeline.written(stage["minhash_near_dedup"](spark, cut, sf), "t")
    before = sorted(rows(cut).items())
    comp = brute_near([t for _, t in before], 5, 80)
    assert set(rows(one)) == {before[i][0] for i, (_, c) in comp.items() if c == i}

    clean = corpus_pipeline.written(stage["decontamination"](spark, one, sf), "t")
    assert rows(clean) == {i: t for i, t in rows(one).items() if item not in (t or "")} and len(rows(clean)) == len(rows(one)) - 1

    out = stage["sentencepiece"](spark, clean, sf)
    assert out.where("not round_trip").count() == 0 and out.count() == clean.count()
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()) == sorted(rows(clean))


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    sf = folder[0]
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
