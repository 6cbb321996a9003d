"""Corpus pipeline: five stages over ``documents``, each one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the
folder named by spark.checkpoint.dir and reads it back as the next stage's docs, so a lost
executor costs a read and no stage is computed twice. All stages but the last return the columns
of ``documents`` (n_chars follows the text).

1. toxicity: documents scored 0.5 or more by the classifier go.
2. line dedup: lines that three documents or more hold stay in the one with the largest id only.
   A document that loses all its lines stays, with an empty text.
3. near-dedup: of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays.
4. decontamination: documents that leak a benchmark item go.
5. SentencePiece: token ids of every document, and whether they decode to its text.

Null texts count as empty up to the last stage, which gives them no ids. Rows without a doc_id pass all
stages (they are in no group). Repeated rows of stages 1, 2, 4 and 5 are treated alike; in stage 3 rows that share the
smallest id of a group stay together. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelforge.llm import decontamination, line_dedup, sentencepiece_unigram, setsketch_dedup, toxicity
from funnelforge.llm.shared import fresh, long_rows, read, written

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_rows(spark)
    score = fresh(docs, "score")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col(score) < TOXIC).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_rows(spark)
    cut = line_dedup.apply(line_dedup.build(docs), docs)
    return cut.withColumns({"text": F.when(F.col("text").isNotNull(), F.col("kept_text")),
                            "n_chars": F.char_length("kept_text").cast("long")}).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_rows(spark)
    return setsketch_dedup.dedup(docs, shingle=5, percent=80).where("kept").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_rows(spark)
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_rows(spark)
    pieces = sentencepiece_unigram.load()
    tokens = sentencepiece_unigram.encode(docs.select("doc_id", "lang", "source", "text"), pieces)
    return (sentencepiece_unigram.decode(tokens, pieces)
            .select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids",
                    F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: No stage order is expressible in SQL (a trained classifier comes first); tests hold every stage against brute force.
ORACLE_SQL = None
