"""License scan by diagonal voting, in DataFrame functions only.

1. *Grams.* Every text becomes words (A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``) and each word with the ``K`` - 1 that follow it one row with a
   rolling hash. The templates - phrases that name a license, and notices - go through the same function.
2. *Join.* All grams are joined to the templates' gram positions by hash; the words themselves decide (a collision is no hit). The
   template side is a few hundred rows and broadcast while its text is below ``SMALL`` characters. Only hits and one row per document leave the map
   tasks, and everything after is grouped under the document's row number, so there is a single exchange, of those rows.
3. *Votes.* A hit votes for the diagonal (place in the text minus place in the template). A phrase needs all its grams on one
   diagonal. A notice needs ``VOTES`` of them, which leaves chance hits of common words behind.
4. *Merging.* Diagonals of a notice at most ``NEAR`` apart are one span: a word put in or left out moves the copy to a diagonal beside.
5. *Verification.* A span's score is the share of the template's words that its hits cover. Spans of ``SHARE`` or more,
   at most twice as long as the template, stand.

A document of any length is one row number of its own; the most a task holds of it are its hits. Repeated rows and rows without an id are
rows like others; null texts are empty and have no words; an empty table gives no rows. The other columns pass through, whatever their names; the text stays behind.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import fresh, read

K, VOTES, NEAR, SHARE, SMALL = 2, 4, 12, 0.6, 1 << 20
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Customary notices, in lower case and without punctuation.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation either version 3 of the license or at your option any later version"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
            "this file you can obtain one at"),
]


def words(text: Column) -> Column:
    """The words of a text. lower() is exact and fast on ASCII; other texts have only A-Z replaced."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, APART), "")


def grams(df: DataFrame, text_col: str, k: int) -> DataFrame:
    """df without the text, one row per word: pos, w0 .. w(k-1) (null past the end) and the hash of whole grams. A text without
    words gives one row with a null pos."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    cut = df.select(*rest, words(F.col(f"`{text_col}`")).alias("ws"))
    shifted = [F.slice("ws", i + 1, F.greatest(F.size("ws") - i, F.lit(0))).alias(f"w{i}") for i in range(k)]
    rows = cut.select(*rest, F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "gram"))
    return rows.select(*rest, "pos", *[F.col(f"gram.w{i}").alias(f"w{i}") for i in range(k)]).withColumn(
        "hash", F.when(F.col(f"w{k - 1}").isNotNull(), F.xxhash64(*[f"w{i}" for i in range(k)])))


def template_grams(spark: SparkSession, phrases: list, notices: list, k: int) -> DataFrame:
    """(template, label, notice, size in words, need, t_pos, t_hash, t0 .. t(k-1)) of every gram of every template."""
    rows = [(n, label, notice, text) for n, (label, notice, text) in
            enumerate([(a, False, b) for a, b in phrases] + [(a, True, b) for a, b in notices])] or [(0, "", False, "")]
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    table = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({n}, {quoted(a)}, {str(b).lower()}, {quoted(t)})" for n, a, b, t in rows)
                      + " AS t(template, label, notice, text)")
    table = table.withColumn("size", F.size(words(F.col("text")))).where(F.col("size") >= k)
    cut = grams(table, "text", k).where("hash IS NOT NULL").withColumnsRenamed({"pos": "t_pos", "hash": "t_hash", **{f"w{i}": f"t{i}" for i in range(k)}})
    cut = cut.withColumn("need", F.when(F.col("notice"), F.least(F.lit(VOTES), F.col("size") - (k - 1))).otherwise(F.col("size") - (k - 1)))
    return F.broadcast(cut) if sum(len(r[3]) for r in rows) <= SMALL else cut


def scan(docs: DataFrame, text_col: str = "text", phrases: list = PHRASES, notices: list = NOTICES, k: int = K) -> DataFrame:
    """docs without the text plus n_words and license_spans: array of (first_word, last_word, label, notice, score), sorted; the last word
    is the last covered one. Phrases and notices shorter than k words find nothing."""
    if k < 2:
        raise ValueError("grams have two words at least")
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("kept"),
                       F.col(f"`{text_col}`").alias("text"))
    cut = grams(rows, "text", k)
    table = template_grams(docs.sparkSession, phrases, notices, k)
    same = [cut[f"w{i}"] == table[f"t{i}"] for i in range(k)]
    met = cut.join(table, [cut["hash"] == table["t_hash"], *same], "left")
    last = F.col("w1").isNull()  # one row of each document stays, whatever it hits
    hits = (met.where(F.col("t_pos").isNotNull() | last)
            .select("row", F.when(last, F.col("kept")).alias("kept"), F.when(last, F.coalesce(F.col("pos") + 1, F.lit(0)).cast("long")).alias("n_words"), "pos",
                    "template", "label", "notice", "size", "need", "t_pos", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
            .repartition("row"))
    voted = hits.groupBy("row", "template", "label", "notice", "size", "need", "diagonal").agg(
        F.first("kept", ignorenulls=True).alias("kept"), F.max("n_words").alias("n_words"), F.min("pos").alias("first"), F.max("pos").alias("end"),
        F.collect_set("t_pos").alias("at"))
    voted = voted.where(F.col("template").isNull() | (F.size("at") >= F.col("need")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.when(F.col("notice") & (F.col("diagonal") - F.lag("diagonal").over(order) <= NEAR), 0).otherwise(1)
    merged = (voted.withColumn("apart", apart).withColumn("span", F.sum("apart").over(order))
              .groupBy("row", "template", "label", "notice", "size", "span")
              .agg(F.first("kept", ignorenulls=True).alias("kept"), F.max("n_words").alias("n_words"), F.min("first").alias("first"),
                   (F.max("end") + k - 1).alias("end"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda j: F.sequence(j, j + k - 1)))))
    merged = merged.withColumn("score", covered / F.col("size"))
    stands = (F.col("score") >= SHARE) & (F.col("end") - F.col("first") < 2 * F.col("size"))
    span = F.struct(F.col("first").cast("long").alias("first_word"), F.col("end").cast("long").alias("last_word"), "label", "notice", "score")
    per = (merged.withColumn("span", F.when(F.col("template").isNotNull() & stands, span)).groupBy("row")
           .agg(F.first("kept", ignorenulls=True).alias("kept"), F.max("n_words").alias("n"), F.sort_array(F.collect_list("span")).alias("spans")))
    return per.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(others)], F.col("n").alias(fresh(docs, "n_words")),
                      F.col("spans").alias(fresh(docs, "license_spans")))


def op12_license_scans(spark, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("license_spans", lambda s: ~s["notice"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["first_word"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names("license_spans").alias("labels"),
                        F.coalesce(F.array_max(F.transform("license_spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))


def _values() -> str:
    rows = [(a, "false", b) for a, b in PHRASES] + [(a, "true", b) for a, b in NOTICES]
    return ", ".join(f"({n}, '{a}', {notice}, string_split('{text}', ' '))" for n, (a, notice, text) in enumerate(rows))


#: The same rows in DuckDB SQL: word pairs compared as text, diagonals counted, sorted and chained.
OP12_SQL = rf"""
WITH t(template, label, notice, ws) AS (VALUES {_values()}),
tg AS (SELECT template, label, notice, len(ws) AS size, unnest(range(len(ws) - 1)) AS j, ws FROM t),
tp AS (SELECT template, label, notice, size, j, ws[j + 1] AS a, ws[j + 2] AS b, CASE WHEN notice THEN {VOTES} ELSE size - 1 END AS need FROM tg),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{APART}'), lambda x: x <> '') AS ws FROM documents),
dg AS (SELECT doc_id, ws, unnest(range(len(ws) - 1)) AS i FROM d),
dp AS (SELECT doc_id, i, ws[i + 1] AS a, ws[i + 2] AS b FROM dg),
hit AS (SELECT doc_id, template, label, notice, size, need, i, j, i - j AS diagonal FROM dp JOIN tp USING (a, b)),
vote AS (SELECT doc_id, template, label, notice, size, diagonal, min(i) AS f, max(i) AS e, list(j) AS js FROM hit
         GROUP BY doc_id, template, label, notice, size, need, diagonal HAVING count(*) >= need),
cut AS (SELECT *, CASE WHEN notice AND diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {NEAR} THEN 0 ELSE 1 END AS new FROM vote),
part AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM cut),
each_j AS (SELECT doc_id, template, span, unnest(js) AS j FROM part),
share AS (SELECT doc_id, template, span, count(DISTINCT p) AS covered FROM (SELECT doc_id, template, span, unnest([j, j + 1]) AS p FROM each_j) GROUP BY ALL),
spans AS (SELECT doc_id, template, span, label, notice, size, min(f) AS f, max(e) + 1 AS e FROM part GROUP BY ALL),
good AS (SELECT s.*, covered / CAST(size AS DOUBLE) AS score FROM spans s JOIN share USING (doc_id, template, span)
         WHERE covered / CAST(size AS DOUBLE) >= {SHARE} AND e - f < 2 * size),
found AS (SELECT doc_id, count(*) FILTER (NOT notice) AS n_base, min(f) FILTER (NOT notice) AS first_word, max(f) FILTER (NOT notice) AS last_word,
          string_agg(DISTINCT label, ',' ORDER BY label) FILTER (NOT notice) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
          FROM good GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN found USING (doc_id)
"""
