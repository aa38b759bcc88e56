"""Licence scan by diagonal voting.

Templates (short phrases that prove a licence, and licence notices) are cut
into rolling word k-grams with their positions. All rolling k-grams of all
documents are joined to them by hash, their words compared in the same join.
A hit votes for a diagonal, document position minus template position; a
diagonal's votes are the template positions found on it, each once however
often the row is repeated. A phrase stands wherever one diagonal has all its
votes. A notice may have words added or left out, which shifts the diagonal:
neighbouring diagonals (at most ``shift`` apart) are merged, and the merged
span is verified by the share of the notice's k-grams found in it.

The templates are a fixed short list; only they are broadcast. A document's
hits are grouped by document, so a phrase that a third of all documents hold
spreads with them. Main path: DataFrame functions only.

Defined cases. Null text has no words. Documents of fewer than k words match
nothing. Rows that repeat an id are told apart by their text; repeated rows
get the same answer each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laketide.llm.common import documents, real_id
from laketide.llm.url_filter import LOWERED, UPPER

# The phrases of the contract, and openings of public licence notices.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWERED)


def template_grams(spark: SparkSession, phrases, notices, k: int) -> DataFrame:
    rows = []
    for t, (label, text) in enumerate([*phrases, *notices]):
        w = text.split()
        if len(w) < k:
            raise ValueError(f"a template needs {k} words: {text}")
        rows += [(t, label, t < len(phrases), len(w) - k + 1, i, w[i:i + k]) for i in range(len(w) - k + 1)]
    grams = spark.createDataFrame(rows, "template int, label string, phrase boolean, need int, t_pos int, "
                                        "gram array<string>")
    return grams.withColumn("t_hash", F.xxhash64(*[F.col("gram")[j] for j in range(k)]))


def diagonals(rows: DataFrame, templates: DataFrame, k: int) -> DataFrame:
    """Votes per (row, template, diagonal) for ``rows`` (doc_id, text, text_key)."""
    words = rows.select("doc_id", "text_key", F.array_remove(F.split(_lower(F.col("text")), BETWEEN, -1), "").alias("w"))
    shifted = [F.slice("w", j + 1, F.greatest(F.size("w"), F.lit(1))) for j in range(k)]
    grams = words.where(F.size("w") >= k).select("doc_id", "text_key", F.posexplode(F.arrays_zip(*shifted)))
    grams = grams.select("doc_id", "text_key", F.col("pos"), *[F.col(f"col.{j}").alias(f"g{j}") for j in range(k)])
    own = grams.withColumn("hash", F.xxhash64(*[f"g{j}" for j in range(k)]))
    same = F.col("hash") == F.col("t_hash")
    for j in range(k):
        same = same & (F.col(f"g{j}") == F.col("gram")[j])
    return (own.join(F.broadcast(templates), same)
            .groupBy("doc_id", "text_key", "template", "label", "phrase", "need",
                     (F.col("pos") - F.col("t_pos")).alias("diagonal"))
            .agg(F.collect_set("t_pos").alias("found"), F.min("pos").alias("first"), F.max("pos").alias("last")))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases=None, notices=None, k: int = 3,
                 shift: int = 3, coverage: float = 0.7) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` and ``spans`` (label, first word, words, share of the template)."""
    spark = docs.sparkSession
    templates = template_grams(spark, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices, k)
    rows = documents(docs, doc_id, text).withColumn("text_key", F.xxhash64("text"))
    votes = diagonals(rows, templates, k)
    row = ["doc_id", "text_key"]

    # Neighbouring diagonals of one template whose spans are near each other are one match.
    near = W.partitionBy(*row, "template").orderBy("first", "diagonal")
    reach = F.max("last").over(near.rowsBetween(W.unboundedPreceding, -1))
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(near)) > shift) | (F.col("first") > reach + shift + k)
    islands = (votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
               .withColumn("island", F.sum("new").over(near.rowsBetween(W.unboundedPreceding, 0))))
    spans = (islands.groupBy(*row, "template", "label", "phrase", "need", "island")
             .agg(F.min("first").alias("first"), F.max("last").alias("last"),
                  F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("seen"))
             .withColumn("share", F.col("seen") / F.col("need"))
             .where(~F.col("phrase") & (F.col("share") >= coverage))
             .select(*row, "label", F.lit(False).alias("base"), F.col("first").cast("long").alias("start"),
                     (F.col("last") - F.col("first") + k).cast("long").alias("words"), "share"))
    places = (votes.where("phrase AND size(found) = need")
              .select(*row, "label", F.lit(True).alias("base"), F.col("diagonal").cast("long").alias("start"),
                      (F.col("need") + k - 1).cast("long").alias("words"), F.lit(1.0).alias("share")))
    found = (places.unionByName(spans).groupBy(*row)
             .agg(F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
                  F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
                  F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_set"),
                  F.collect_set("label").alias("label_set"), F.max("share").alias("score"),
                  F.array_sort(F.collect_list(F.struct("start", "words", "label", "share"))).alias("spans"))
             .withColumnsRenamed({"doc_id": "f_id", "text_key": "f_key"}))
    every = rows.select("doc_id", "text_key", F.regexp_count(_lower(F.col("text")), F.lit(WORD)).cast("long").alias("n_words"))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.coalesce(c, F.array().cast("array<string>"))))
    return (every.join(found, (F.col("doc_id") == F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left")
            .select(real_id(), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
                    joined(F.col("base_set")).alias("base_labels"), joined(F.col("label_set")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"), "spans"))
