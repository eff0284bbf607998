"""License scans by diagonal voting, in column expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.text import count_between

#: What lies between words, in folded text and in text as it is.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: lower() folds this sign into "k", which only A-Z may become; another sign that it does not fold into A-Z.
KELVIN, ANGSTROM = "\u212a", "\u212b"
GRAM = 2
#: A diagonal takes part with this share of a notice's grams; a span counts with this one.
DIAGONAL_SHARE = 0.25
SPAN_SHARE = 0.8
#: Diagonals this near belong together: words put in or left out move a match from one to the other.
SHIFT = 3

# The phrases that are looked for word by word.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Wording of public licences, found also with some words changed.
NOTICES = (
    ("agpl", "gnu affero general public license version 3"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "this software is provided by the copyright holders and contributors as is"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
LONGEST = 64


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """A row per gram of each template: its words and place. As many rows as the templates have words.

    A template has 2 to 64 words, so that a bit of a long stands for each of its grams.
    """
    rows = []
    for base, templates in ((True, phrases), (False, notices)):
        for label, text in templates:
            words = text.split()
            if not GRAM <= len(words) <= LONGEST:
                raise ValueError(f"a template needs {GRAM} to {LONGEST} words: {text!r}")
            number = f"{label}: {text}"
            for place in range(len(words) - GRAM + 1):
                rows.append((number, label, base, len(words) - GRAM + 1, place, 1 << place, words[place], words[place + 1]))
    grams = spark.createDataFrame(
        rows, "template string, label string, base boolean, grams int, place int, bit long, first string, second string")
    return grams.withColumn("hash", F.xxhash64("first", "second"))


def license_spans(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Spans of templates in the texts: key (id, hash and length of the text), label, base, first, last, share.

    Every rolling word pair of every text is joined by hash to the places of the templates
    (a broadcast of at most the templates' words) and, where hashes meet, compared by its
    words. The difference of places is the diagonal; votes are the bits of the template's
    places it hits. A base phrase stands where one diagonal has all its bits. For a notice,
    diagonals with a quarter of its grams are merged with neighbours up to ``SHIFT`` apart,
    and the span is taken if together they hit ``SPAN_SHARE`` of its grams within a length
    that fits. Rows repeated in full share a key and so count as one; null texts have none.
    """
    key = [F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_bytes")]
    split = docs.where(F.col("text").isNotNull()).select(*key, F.split(F.lower(F.replace("text", F.lit(KELVIN), F.lit(ANGSTROM))), GAP).alias("words"))
    # The outer form, as Catalyst would else filter by the generator and split twice.
    last = F.size("words") - GRAM
    places = split.select("*", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at"))
    grams = places.select(
        "doc_id", "text_hash", "text_bytes", (F.col("at") - (F.get("words", F.lit(0)) == "").cast("int")).alias("at"),
        F.get("words", F.col("at")).alias("w0"), F.get("words", F.col("at") + 1).alias("w1"))
    templates = F.broadcast(template_grams(docs.sparkSession, phrases, notices))
    hits = grams.join(templates, (F.xxhash64("w0", "w1") == F.col("hash"))
                      & (F.col("w0") == F.col("first")) & (F.col("w1") == F.col("second")))
    same = ["doc_id", "text_hash", "text_bytes", "template", "label", "base", "grams"]
    votes = hits.groupBy(*same, (F.col("at") - F.col("place")).alias("diagonal")).agg(F.bit_or("bit").alias("bits"))
    least = F.when(F.col("base"), F.col("grams")).otherwise(
        F.greatest(F.lit(2), F.ceil(F.col("grams") * DIAGONAL_SHARE)))
    strong = votes.where(F.bit_count("bits") >= least)
    line = Window.partitionBy(*same).orderBy("diagonal")
    apart = F.col("base") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > SHIFT, F.lit(False))
    bands = strong.withColumn("apart", apart.cast("int")).withColumn("band", F.sum("apart").over(line))
    merged = bands.groupBy(*same, "band").agg(
        F.bit_or("bits").alias("bits"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    merged = merged.withColumn("share", F.bit_count("bits") / F.col("grams"))
    return merged.where((F.col("share") >= SPAN_SHARE) & (F.col("high") - F.col("low") <= F.col("grams"))).select(
        "doc_id", "text_hash", "text_bytes", "label", "base", F.greatest(F.col("low"), F.lit(0)).alias("first"),
        (F.col("high") + F.col("grams")).alias("last"), "share")


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest share of a template that was found (0 without). Null or empty
    text: no words, no labels (empty strings), null places. A null doc_id stays null and
    keeps its own labels. Rows that repeat a doc_id with other texts are told apart by them.
    """
    spans = license_spans(docs, phrases, notices)
    found = spans.groupBy(
        F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), F.col("text_bytes").alias("of_bytes")
    ).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_set"),
        F.collect_set("label").alias("label_set"),
        F.max("share").alias("score"),
    )
    joined = lambda name: F.coalesce(F.array_join(F.array_sort(name), ","), F.lit(""))
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_bytes"),
        count_between("text", GAP_ANY_CASE).alias("n_words"))
    same = (F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
            & (F.col("text_bytes") == F.col("of_bytes")))
    return rows.join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        joined("base_set").alias("base_labels"), joined("label_set").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
