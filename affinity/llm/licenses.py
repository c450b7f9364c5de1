"""License scan by diagonal voting, in DataFrame functions only.

Every pair of neighbouring words of every text is joined by its hash to the
template positions that begin with that pair.  A match at word ``pos`` of a
text and ``tpos`` of a template votes for the diagonal ``pos - tpos``, the
place where the template would begin.  Votes are counted per diagonal;
neighbouring diagonals of one template are merged (words put in or left
out), and the spans they give are verified against the template's length.

Two kinds of template: phrases of a few words, which vote by word pairs and
of which every word must stand in its place (one diagonal holds all votes),
and longer passages, whose words vote in runs of four and of which a share
must be found.  Phrases carry no version numbers, so any version is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

# The base phrases with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Names of further licenses, with labels that are no base labels.
NAMES = [
    ("cc by sa", "cc-by-sa"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("cc0 1 0", "cc0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
]

# Well-known sentences of public licenses (words only).
PASSAGES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to "
     "the warranties of merchantability fitness for a particular purpose and noninfringement", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this work is licensed under the creative commons attribution", "cc-by"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission", "bsd"),
    ("this software is provided by the copyright holders and contributors as is and any express or implied warranties "
     "including but not limited to the implied warranties of merchantability and fitness for a particular purpose "
     "are disclaimed", "bsd"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("the person who associated a work with this deed has dedicated the work to the public domain", "cc0"),
    ("in no event will the authors be held liable for any damages arising from the use of this software", "zlib"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
]

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RUN = 4              # words that vote together in a passage
SLACK = 3            # diagonals this near are merged
MIN_COVER = 0.6      # share of a passage's runs that must be found
MAX_STRETCH = 1.5    # span of a passage's votes, in lengths of the passage


def template_positions(spark: SparkSession, phrases=PHRASES, names=NAMES, passages=PASSAGES) -> DataFrame:
    """One row per voting position of a template: pair (hash of the first two
    words), run (hash of RUN words; null for phrases and names), template,
    label, phrase (all words must stand in place), base (its places and label
    count as base), tpos, votes_max, words.  Its size follows from the
    template lists alone."""
    kinds = [(t, lb, True, True) for t, lb in phrases] + [(t, lb, True, False) for t, lb in names] + [(t, lb, False, False) for t, lb in passages]
    rows = [(i, label, text.split(" "), phrase, base) for i, (text, label, phrase, base) in enumerate(kinds)]
    t = spark.createDataFrame(rows, "template int, label string, w array<string>, phrase boolean, base boolean")
    n = F.when(F.col("phrase"), F.lit(2)).otherwise(F.lit(RUN))
    t = t.withColumn("n", F.size("w") - n + 1).withColumn("tpos", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return t.select(_hash(F.col("w"), F.col("tpos"), 2).alias("t_pair"),
                    F.when(~F.col("phrase"), _hash(F.col("w"), F.col("tpos"), RUN)).alias("t_run"),
                    "template", "label", "phrase", "base", "tpos",
                    F.col("n").alias("votes_max"), F.size("w").alias("t_words"))


def _hash(words: Column, i: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(n)])


def scan(docs: DataFrame, phrases=PHRASES, names=NAMES, passages=PASSAGES, text: str = "text") -> DataFrame:
    """Verified spans of all texts, and one row with a null template per text:
    row, doc_id, n_words, template, label, phrase, base, first (word index), last,
    cover (share of the template's votes found)."""
    spark = docs.sparkSession
    # only A-Z is lower-cased: of other characters, only the Kelvin sign would become an ASCII letter
    lowered = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\u212a"), F.lit("\u212b")))
    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                    F.regexp_extract_all(lowered, F.lit(LICENSE_WORD), F.lit(0)).alias("w"))
    w, n = F.col("w"), F.size("w")
    hashes = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(
        _hash(w, i, 2).alias("pair"), _hash(w, i, RUN).alias("run"))))
    d = d.select("row", "doc_id", n.cast("long").alias("n_words"), F.posexplode_outer(hashes).alias("pos", "g"))
    t = template_positions(spark, phrases, names, passages)
    hit = (F.col("g.pair") == F.col("t_pair")) & (F.col("t_run").isNull() | (F.col("t_run") == F.col("g.run")))
    votes = d.join(F.broadcast(t), hit, "left")
    # every match, and one row for each text
    votes = votes.filter(F.col("template").isNotNull() | F.coalesce(F.col("pos") == 0, F.lit(True)))
    votes = votes.select("row", "doc_id", "n_words", "template", "label", "phrase", "base", "votes_max", "t_words",
                         (F.col("pos") - F.col("tpos")).alias("diagonal"), "pos")
    # what follows works text by text: one exchange of the few matching rows
    by_diagonal = votes.repartition("row").groupBy(
        "row", "doc_id", "n_words", "template", "label", "phrase", "base", "votes_max", "t_words", "diagonal").agg(
        F.count("template").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("phrase"), F.lit(True)) | (F.col("diagonal") - F.lag("diagonal").over(along) > SLACK)
    merged = by_diagonal.withColumn("far", F.coalesce(far, F.lit(True)).cast("int")).withColumn(
        "group", F.sum("far").over(along)).groupBy(
        "row", "doc_id", "n_words", "template", "label", "phrase", "base", "votes_max", "t_words", "group").agg(
        F.sum("votes").alias("votes"), F.min("lo").alias("first"), F.max("hi").alias("hi"))
    cover = F.least(F.lit(1.0), F.col("votes") / F.col("votes_max"))
    spans = merged.withColumn("cover", cover).withColumn(
        "last", F.col("hi") + F.when(F.col("phrase"), F.lit(1)).otherwise(F.lit(RUN - 1)))
    held = F.when(F.col("phrase"), F.col("votes") == F.col("votes_max")).otherwise(
        (F.col("cover") >= MIN_COVER) & (F.col("last") - F.col("first") + 1 <= MAX_STRETCH * F.col("t_words")))
    none = F.col("template").isNull()
    return spans.withColumn("held", F.coalesce(held, F.lit(False))).select(
        "row", "doc_id", "n_words",
        *[F.when(F.col("held"), F.col(c)).alias(c) for c in ("template", "label", "phrase", "base", "first", "last", "cover")],
        none.alias("no_match"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    Null and empty texts: no words, no labels, score 0.  Repeated rows: one
    result each.  Empty table: no rows.  Columns other than doc_id and text
    are not read."""
    s = scan(docs)
    place = F.when(F.col("base"), F.col("first").cast("long"))

    def joined(c: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(c)), ",")
    return s.groupBy("row", "doc_id", "n_words").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score")).drop("row")
