"""License scans by diagonal voting.

Templates (short phrases and passages of license notices) and documents are cut into words; every rolling pair of words of
every document is hash-joined with the template pairs.  A hit at word i of the document and word j of the template votes for
the diagonal i - j.  A *phrase* stands consecutively where one diagonal has all its votes.  For a *notice*, neighbouring
diagonals (words lost or put in between) are merged into a span, and the span is verified by the share of the template's
pairs that it holds.

The templates are a fixed table of a few hundred pairs, which is broadcast; the words of a pair are compared besides their
hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Phrases that must stand consecutively, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Passages of well-known license notices, with their labels.
NOTICES = {
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """Words of a text column: runs without ASCII characters other than digits and letters, in lower case; NULL has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def template_pairs(spark, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    rows = []
    for k, (text, label, base) in enumerate([(t, x, True) for t, x in phrases.items()] + [(t, x, False) for t, x in notices.items()]):
        words = text.split()
        if len(words) < 2:
            raise ValueError(f"a template needs two words or more: {text!r}")
        rows += [(k, label, base, j, len(words) - 1, a, b) for j, (a, b) in enumerate(zip(words, words[1:]))]
    pairs = spark.createDataFrame(rows, "template int, label string, base boolean, place int, pairs int, w1 string, w2 string")
    return pairs.withColumn("hash", F.xxhash64("w1", "w2"))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None, coverage: float = 0.7, slack: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` and
    ``spans`` (array of label, first, last, share): one row for each row of ``docs``.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are their smallest and largest start (NULL
    without any).  ``labels`` adds those of notices of which ``coverage`` of the pairs stand on diagonals at most ``slack``
    apart.  ``score`` is the largest verified share (1 for a phrase, 0 for none).  NULL and empty texts have no words and no
    labels; repeated rows have equal results; a NULL id is kept."""
    spark = docs.sparkSession
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    templates = template_pairs(spark, phrases, notices)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text.cast("string")).alias("key"), words_of(text).alias("words"))
    each = rows.select("doc_id", "key", "words", F.posexplode("words").alias("at", "first"))
    each = each.where(F.col("at") + 1 < F.size("words")).withColumn("second", F.get("words", F.col("at") + 1))
    each = each.withColumn("hash", F.xxhash64("first", "second"))
    hits = each.join(F.broadcast(templates), "hash").where("first = w1 and second = w2")
    voted = hits.select("doc_id", "key", "template", "label", "base", "pairs", "place", (F.col("at") - F.col("place")).alias("diagonal"))
    per_diagonal = voted.groupBy("doc_id", "key", "template", "label", "base", "pairs", "diagonal").agg(F.collect_set("place").alias("places"))
    # neighbouring diagonals of one template in one document make a span
    own = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    apart = F.when(F.col("base") | F.lag("diagonal").over(own).isNull() | (F.col("diagonal") - F.lag("diagonal").over(own) > slack), 1).otherwise(0)
    spans = per_diagonal.where(~F.col("base") | (F.size("places") == F.col("pairs"))).withColumn("apart", apart).withColumn("span", F.sum("apart").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.col("diagonal") + F.array_min("places")
    last = F.col("diagonal") + F.array_max("places") + 1
    merged = spans.groupBy("doc_id", "key", "template", "label", "base", "pairs", "span").agg(F.min(first).alias("first"), F.max(last).alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"))
    found = merged.withColumn("share", F.col("n") / F.col("pairs")).where(F.col("share") >= coverage)
    span = F.struct("label", "first", "last", "share")
    per_doc = found.groupBy("doc_id", "key").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(span)).alias("spans"),
    )
    sizes = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"))
    joined = sizes.alias("a").join(per_doc.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.key") == F.col("b.key")), "left")
    return joined.select(
        "a.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )
