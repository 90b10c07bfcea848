"""License scans by diagonal voting.

Rolling word k-gram hashes of every text are joined to the k-gram positions of the
license templates. A match of text position p with template position t votes for
the diagonal p - t. Votes are summed per diagonal, diagonals at most ``drift``
apart are merged into one run, a run of more than two template lengths is cut into
overlapping parts of two, and a span is verified by the share of template
words that its votes cover. Phrases are templates of two-word
grams whose words must all stand on one diagonal.

The template table has as many rows as the templates have words, whatever the
corpus; it is counted before it is broadcast.

Defined cases: a null or empty text has no word and no label; rows that repeat an
id and a text are scanned as one and reported each; an empty table has no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patrona.llm import text as T
from patrona.scale import fits_broadcast
from patrona.session import materialize

#: Phrases that are looked for word by word, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Public license notices, by label. Parts in order, words only.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0"],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ],
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "released under the mit license",
    ],
}

_PHRASE_K, _TEMPLATE_K = 2, 3


def _grams_of(words: list[str], k: int) -> list[int]:
    return [T.gram_hash(words[i:i + k]) for i in range(len(words) - k + 1)]


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: dict[str, list[str]]) -> DataFrame:
    """(k, gram, template, label, base, t, words): one row per k-gram of each template."""
    entries = [(_PHRASE_K, text, label, True) for text, label in phrases.items()]
    entries += [(_TEMPLATE_K, text, label, False) for label, texts in templates.items() for text in texts]
    rows = [(k, gram, number, label, base, t, len(text.split()))
            for number, (k, text, label, base) in enumerate(entries)
            for t, gram in enumerate(_grams_of(text.split(), k))]
    return spark.createDataFrame(rows, "k int, gram long, template int, label string, base boolean, t int, words int")


def _gram_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in T.chunks(batches):
        words = T.Words(T.LOWER[data], offsets, T.ALNUM)
        two, has_two = words.grams(_PHRASE_K)
        three, has_three = words.grams(_TEMPLATE_K)
        text = words.text_of()
        place = np.arange(len(two)) - words.first[text]
        index = pa.array(text)
        own = [rows.column(c).take(index) for c in ("doc_id", "version")]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(place.astype(np.int32)), pa.array(two.view(np.int64), mask=~has_two),
             pa.array(three.view(np.int64), mask=~has_three)], names=["doc_id", "version", "p", "g2", "g3"])


def votes(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc_id, version, template, diagonal, hits): template positions met on each diagonal of each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rolled = (docs.mapInArrow(_gram_task, f"doc_id {kind}, version long, p int, g2 long, g3 long")
              .select("doc_id", "version", "p", F.expr(
                  f"inline(array(struct({_PHRASE_K} as k, g2 as gram), struct({_TEMPLATE_K} as k, g3 as gram)))")))
    met = rolled.join(F.broadcast(grams) if fits_broadcast(grams) else grams, ["k", "gram"])
    return (met.groupBy("doc_id", "version", "template", "label", "base", "words", "k",
                        (F.col("p") - F.col("t")).alias("diagonal"))
            .agg(F.collect_set("t").alias("hits")))


def spans(voted: DataFrame, drift: int, least: float) -> DataFrame:
    """(doc_id, version, label, base, start, score): verified spans; phrases need every word in place."""
    exact = (voted.where("base and size(hits) = words - k + 1")
             .select("doc_id", "version", "label", "base", F.col("diagonal").alias("start"), F.lit(1.0).alias("score")))
    text = ["doc_id", "version", "template"]
    along = W.partitionBy(*text).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along) > drift
    runs = (voted.where("not base").withColumn("new", F.coalesce(gap, F.lit(True)).cast("int"))
            .withColumn("run", F.sum("new").over(along)))
    # A run of more than two template lengths is cut into parts of two, which overlap by one.
    first = F.min("diagonal").over(W.partitionBy(*text, "run"))
    last = F.max("diagonal").over(W.partitionBy(*text, "run"))
    place = (F.col("diagonal") - F.col("first")) / F.col("words")
    runs = runs.withColumns({"first": first, "last": last}).withColumn("part", F.explode(
        F.when(F.col("last") - F.col("first") <= 2 * F.col("words"), F.array(F.lit(-1).cast("long")))
        .otherwise(F.array(F.floor(place), F.floor(place) + 1))))
    merged = (runs.groupBy(*text, "label", "base", "words", "run", "part")
              .agg(F.min("diagonal").alias("start"),
                   F.array_distinct(F.flatten(F.collect_list(F.flatten(F.transform(
                       "hits", lambda t: F.sequence(t, t + _TEMPLATE_K - 1)))))).alias("covered")))
    score = F.size("covered") / F.col("words")
    verified = merged.where(score >= least).groupBy(*text, "label", "base", "start").agg(F.max(score).alias("score"))
    verified = verified.withColumn("score", F.least("score", F.lit(1.0)))
    return exact.unionByName(verified.select("doc_id", "version", "label", "base", "start", "score"))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES,
                  drift: int = 3, least: float = 0.8) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans) for every document.

    ``score`` is the largest covered share of a verified span, 0 without one.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    grams = template_grams(docs.sparkSession, phrases, templates)
    found = spans(materialize(votes(docs, grams), "license-votes"), drift, least)
    base = F.col("base")
    found = found.groupBy("doc_id", "version").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"), F.max("score").alias("score"), F.count("*").alias("n_spans"))
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]++")), F.lit(0)).cast("long")
    every = docs.select("doc_id", "version", n_words.alias("n_words"))
    same = every["doc_id"].eqNullSafe(found["doc_id"]) & (every["version"] == found["version"])

    def joined(name: str):
        return F.concat_ws(",", F.array_sort(F.coalesce(name, F.array().cast("array<string>")))).alias(name)

    zero = F.lit(0).cast("long")
    return every.join(found, same, "left").select(
        every["doc_id"], "n_words", F.coalesce("n_base", zero).alias("n_base"), "first_word", "last_word",
        joined("base_labels"), joined("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_spans", zero).alias("n_spans"))
