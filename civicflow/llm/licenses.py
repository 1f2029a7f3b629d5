"""License scan by diagonal voting.

Every text's rolling word k-grams are joined by hash with the positions of the
templates' k-grams.  A match at text position p and template position t votes
for the diagonal p - t; votes are aggregated per text, template and diagonal
as a bit set of template positions (a partial aggregation before the only
shuffle of matches).  A phrase stands where one diagonal has all its k-grams.
For the longer templates neighbouring diagonals are merged (an inserted or
lost word shifts the diagonal), and a merged span counts if its distinct
template positions cover enough of the template.

Built-in column functions only.  The template table is broadcast up to a size
that is checked; texts are never shuffled.

Rows are told apart by document id and a hash of the text, so repeated rows
each get the one result their text has.  Defined results: a null text is an
empty one; a text without a match has 0 places, null first and last word,
empty labels and score 0; null and repeated ids are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicflow.session import materialize

K = 2
#: Widest gap between diagonals that are merged.
NEIGHBOUR = 3
#: Least share of a template's k-grams in a merged span, and of a diagonal's votes.
COVERAGE = 0.6
LEAST_VOTES = 2
#: Template positions in one bit set, and the largest table of them that is broadcast.
BITS = 63
BROADCAST_POSITIONS = 200_000

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Sentences of public licences (lower case, words only).
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
)
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words with A-Z in lower case.  Beyond ASCII lower() may change letters,
    which no template has; the Kelvin sign alone would turn into an ASCII
    letter and is replaced by another word character first."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("å")))
    return F.array_remove(F.split(plain, NOT_A_WORD), "")


def template_grams(spark, entries) -> DataFrame:
    """(gram, w0, w1, template, label, is_phrase, t, n_grams): one row per template position."""
    split = [(number, text.split(), label, is_phrase) for number, (text, label, is_phrase) in enumerate(entries)]
    if any(len(w) < K for _, w, _, _ in split):
        raise ValueError(f"a template has {K} words or more")
    rows = [F.struct(F.lit(number).alias("template"), F.array(*map(F.lit, w)).alias("w") if len(w) < 200 else F.split(F.lit(" ".join(w)), " ").alias("w"),
                     F.lit(label).alias("label"), F.lit(is_phrase).alias("is_phrase")) for number, w, label, is_phrase in split]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    pairs = F.arrays_zip(F.expr("slice(w, 1, size(w) - 1)").alias("w0"), F.expr("slice(w, 2, size(w) - 1)").alias("w1"))
    table = table.select("template", "label", "is_phrase", (F.size("w") - 1).alias("n_grams"), F.posexplode(pairs).alias("t", "g"))
    return table.select("template", "label", "is_phrase", "n_grams", "t", "g.w0", "g.w1").withColumn("gram", F.xxhash64("w0", "w1"))


def spans(df: DataFrame, text: str = "text", keys=("doc_id",), phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Verified spans: keys, template, label, is_phrase, first_word, last_word, coverage.

    Templates may have any length, whole licences too.  A diagonal's votes are
    bit sets of ``BITS`` template positions each, as many as the longest
    template needs.  A merged span must cover the template and lie within as
    many words as the template could take with so much of it found.
    """
    entries = [(p, label, True) for p, label in phrases] + [(t, label, False) for t, label in templates]
    grams = template_grams(df.sparkSession, entries)
    n_positions = [len(e[0].split()) - K + 1 for e in entries]
    sets = [f"hits{i}" for i in range(-(-max(n_positions) // BITS))]
    found = lambda: sum((F.bit_count(c) for c in sets), F.lit(0))
    w = df.select(*keys, words(F.col(text)).alias("w"))
    rolling = w.select(*keys, F.posexplode(F.arrays_zip(F.col("w").alias("w0"), F.expr("slice(w, 2, size(w))").alias("w1"))).alias("p", "g"))
    rolling = rolling.select(*keys, "p", F.col("g.w0").alias("a"), F.col("g.w1").alias("b")).where("b IS NOT NULL")
    rolling = rolling.withColumn("gram", F.xxhash64("a", "b"))
    # Beyond the bound the table is joined as the planner sees fit.
    bounded = F.broadcast(grams) if sum(n_positions) <= BROADCAST_POSITIONS else grams
    votes = rolling.join(bounded, "gram").where("a = w0 AND b = w1")
    bits = [F.bit_or(F.expr(f"CASE WHEN t div {BITS} = {i} THEN shiftleft(1L, t % {BITS}) ELSE 0L END")).alias(c) for i, c in enumerate(sets)]
    diagonals = votes.withColumn("diagonal", F.col("p") - F.col("t")).groupBy(*keys, "template", "label", "is_phrase", "n_grams", "diagonal").agg(
        *bits, F.min("t").alias("first_t"), F.max("t").alias("last_t"))
    # Narrow, and read by both branches below: the texts are split into words once.
    diagonals = materialize(diagonals.where(F.when(F.col("is_phrase"), found() == F.col("n_grams")).otherwise(found() >= LEAST_VOTES)), "diagonals")
    first, last = F.col("diagonal").cast("long"), (F.col("diagonal") + F.col("n_grams") + K - 2).cast("long")
    whole = diagonals.where("is_phrase").select(
        *keys, "template", "label", "is_phrase", first.alias("first_word"), last.alias("last_word"), F.lit(1.0).alias("coverage"))
    in_text = W.partitionBy(*keys, "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(in_text) > NEIGHBOUR, F.lit(True))
    runs = diagonals.where("NOT is_phrase").withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(in_text))
    merged = runs.groupBy(*keys, "template", "label", "is_phrase", "n_grams", "run").agg(
        *[F.bit_or(c).alias(c) for c in sets], F.min("diagonal").cast("long").alias("first_word"),
        F.max(F.col("diagonal") + F.col("last_t") + K - 1).cast("long").alias("last_word"),
        F.min(F.col("diagonal") + F.col("first_t")).alias("first_hit"))
    width = F.col("last_word") - F.col("first_hit") + 1
    merged = merged.withColumn("coverage", found() / F.col("n_grams")).where(
        (F.col("coverage") >= COVERAGE) & (width * COVERAGE <= F.col("n_grams") + K - 1))
    return whole.unionByName(merged.select(whole.columns))


def scan(documents: DataFrame) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    keyed = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    found = spans(keyed, keys=("doc_id", "text_key"))
    base = F.col("is_phrase")
    joined = lambda label: F.array_join(F.sort_array(F.collect_set(label)), ",")  # noqa: E731  at most the constant labels
    per_text = found.groupBy("doc_id", "text_key").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    d = keyed.select("doc_id", "text_key", F.size(words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    m = per_text.alias("m")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key"))
    return d.join(m, same, "left").select(
        "d.doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
