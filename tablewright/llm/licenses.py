"""License scan by diagonal voting.

The rolling word k-grams of every whole text are joined by their hash to the
places where they occur in license templates.  A match at word ``p`` of a text
and word ``q`` of a template votes for the diagonal ``p - q``: a faithful copy
puts all its votes on one diagonal, an edited one on a few neighbours.  Votes
are summed by diagonal, neighbouring diagonals merged, and the spans verified:
the votes compare the words themselves, not only hashes, so all votes of a
template on one diagonal prove the template word for word, and a merged span
counts if it holds most of the template within little more than its length.

The templates are fixed and small, so they are broadcast; the k-grams of the
texts are hashed and tested against their hashes within the row, and only
k-grams that have a partner become rows of the join, keyed by document.
Everything is a DataFrame expression.

Defined results: null and empty texts have no words and no labels (empty
strings, score 0, null places); repeated rows are found alike and each kept;
ties can't arise, labels are sorted; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import materialize, table

GRAM = 3
#: Diagonals at most so far apart belong to one span; share of a template's k-grams and of its length that verify it.
NEAR, COVERAGE, STRETCH = 4, 0.7, 1.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters between words (fixed value).
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that stand for a license wherever they occur, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Public license notices, lower case, without punctuation.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
                 "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
                 "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def _template_rows(phrases, notices) -> str:
    """The k-grams of the templates as rows of SQL."""
    rows = []
    for t, (label, text) in enumerate((*phrases, *notices)):
        words = text.split()
        whole = len(words) - GRAM + 1
        rows += [f"('{' '.join(words[q:q + GRAM])}', {t}, '{label}', CAST({q} AS BIGINT), CAST({whole} AS BIGINT), "
                 f"{str(t < len(phrases)).lower()})" for q in range(whole)]
    return ", ".join(rows)


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per k-gram of a template: its hash ``h``, its words, template ``t``, ``label``, place ``q``, ``whole`` k-grams."""
    grams = spark.sql(f"SELECT * FROM VALUES {_template_rows(phrases, notices)} AS g(words, t, label, q, whole, phrase)")
    return grams.withColumn("h", F.xxhash64(*(F.split("words", " ")[k] for k in range(GRAM))))


def _grams(words: Column, known: list[int]) -> Column:
    """The k-grams (word place, hash, words) of a list of words whose hash is in
    ``known``, and one entry without words that holds their number."""
    def with_words(places: Column) -> Column:
        return F.transform(places, lambda p: F.struct(
            p.cast("long").alias("p"), F.xxhash64(*(F.get(words, p + k) for k in range(GRAM))).alias("h"),
            F.concat_ws(" ", *(F.get(words, p + k) for k in range(GRAM))).alias("words")))

    rolling = F.transform(words, lambda x, i: F.when(
        F.xxhash64(x, *(F.get(words, i + k) for k in range(1, GRAM))).isin(known), i))
    count = F.struct(F.size(words).cast("long").alias("p"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("string").alias("words"))
    return F.concat(F.transform(F.array(F.array_compact(rolling)), with_words)[0], F.array(count))


def votes(docs: DataFrame, text: str = "text", key: str = "doc_id", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``key``, hash of the text, place ``p`` and, for each k-gram found in a
    template, that template's ``t``, ``label``, ``q``, ``whole``, ``phrase``;
    besides a row without template for every text, with its number of words as ``p``."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    words = F.filter(F.split(low, BREAK), lambda w: w != "")
    known = template_grams(docs.sparkSession, phrases, notices)  # fixed size
    # The join's keys, some 400 numbers, are tested where the hashes are made: only k-grams with a partner become rows.
    hashes = sorted({r.h for r in known.select("h").collect()})
    grams = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"),
                        F.explode(F.transform(F.array(words), lambda w: _grams(w, hashes))[0]).alias("g"))
    grams = grams.select("key", "text_hash", "g.p", F.col("g.words").alias("gram"), F.col("g.h").alias("hash"))
    known = F.broadcast(known)
    found = grams.join(known, (F.col("hash") == known["h"]) & (F.col("gram") == known["words"]), "left")
    return found.where("t is not null or gram is null").select("key", "text_hash", "p", "t", "label", "q", "whole", "phrase")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words``, ``spans`` (label,
    first and last word, share of the template, whether a phrase) and the
    number, first and last place of phrases."""
    found = materialize(votes(docs, text, key, phrases, notices), "votes")  # three steps read them, the texts are read once
    texts = found.where("t is null").groupBy("key", "text_hash").agg(F.max("p").alias("n_words"), F.count("*").alias("copies"))
    diagonal = (found.where("t is not null").select("*", (F.col("p") - F.col("q")).alias("diagonal")).distinct()
                .groupBy("key", "text_hash", "t", "label", "whole", "phrase", "diagonal")
                .agg(F.collect_set("q").alias("places"), F.min("p").alias("first"), (F.max("p") + GRAM).alias("behind")))
    by = Window.partitionBy("key", "text_hash", "t").orderBy("diagonal")
    exact = diagonal.where("phrase and size(places) = whole").select(
        "key", "text_hash", "label", "phrase", "first", "behind", F.lit(1.0).alias("share"))
    # Neighbouring diagonals merge only where their words are near each other, too.
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > NEAR)
                       | (F.col("first") - F.lag("behind").over(by) > F.col("whole")), F.lit(True))
    merged = (diagonal.where("not phrase").withColumn("run", F.sum(F.when(apart, 1).otherwise(0)).over(by))
              .groupBy("key", "text_hash", "t", "label", "phrase", "whole", "run")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("held"),
                   F.min("first").alias("first"), F.max("behind").alias("behind"))
              .withColumn("share", F.col("held") / F.col("whole"))
              .where((F.col("share") >= COVERAGE) & (F.col("behind") - F.col("first") <= STRETCH * (F.col("whole") + GRAM))))
    spans = exact.unionByName(merged.select(*exact.columns))
    per = spans.groupBy(F.col("key").alias("k"), F.col("text_hash").alias("x")).agg(
        F.array_sort(F.collect_list(F.struct("label", "first", "behind", "share", "phrase"))).alias("spans"),
        F.count(F.when(F.col("phrase"), 1)).alias("n_base"), F.min(F.when(F.col("phrase"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).alias("last_word"))
    out = texts.join(per, F.col("key").eqNullSafe(F.col("k")) & F.col("text_hash").eqNullSafe(F.col("x")), "left")
    return out.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "key", "n_words", F.coalesce("spans", F.array()).alias("spans"), F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word", "last_word")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    best = F.array_max(F.transform("spans", lambda s: s["share"]))
    return found.select(F.col("key").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
                        names(F.filter("spans", lambda s: s["phrase"])).alias("base_labels"), names(F.col("spans")).alias("labels"),
                        F.coalesce(best, F.lit(0.0)).alias("score"))


QUERIES = {"op9_licenses": op9_licenses}
#: The same method over word lists.
OP9_SQL = rf"""
WITH g(gram, t, label, q, whole, phrase) AS (VALUES {_template_rows(PHRASES, NOTICES)}),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BREAK}'),
                                 lambda x: x <> '') AS w FROM documents),
grams AS (SELECT doc_id, p, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS gram
          FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS p FROM d)),
votes AS (SELECT doc_id, t, label, whole, phrase, p - q AS diagonal, q, p FROM grams JOIN g USING (gram)),
diagonals AS (SELECT doc_id, t, label, whole, phrase, diagonal, list(DISTINCT q) AS places, min(p) AS first, max(p) + {GRAM} AS behind
              FROM votes GROUP BY ALL),
turns AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER o > {NEAR} OR first - lag(behind) OVER o > whole, true)::INT AS new
          FROM diagonals WHERE NOT phrase WINDOW o AS (PARTITION BY doc_id, t ORDER BY diagonal)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS run FROM turns),
merged AS (SELECT doc_id, label, phrase, whole, min(first) AS first, max(behind) AS behind,
                  len(list_distinct(flatten(list(places)))) / whole AS share FROM runs GROUP BY doc_id, t, label, phrase, whole, run),
spans AS (SELECT doc_id, label, phrase, first, 1.0::DOUBLE AS share FROM diagonals WHERE phrase AND len(places) = whole
          UNION ALL SELECT doc_id, label, phrase, first, share FROM merged
          WHERE share >= {COVERAGE} AND behind - first <= {STRETCH} * (whole + {GRAM})),
per AS (SELECT doc_id, count(*) FILTER (WHERE phrase) AS n_base, min(first) FILTER (WHERE phrase) AS first_word,
               max(first) FILTER (WHERE phrase) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM spans GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN per USING (doc_id)"""

SQL = {"op9_licenses": OP9_SQL}
