"""License scan by diagonal voting (built-in functions only).

Every rolling pair of words of every document is joined to the positions of
the same pair in the license templates.  A hit votes for the diagonal
``document position - template position``; the votes of one diagonal are one
alignment of the template.  Neighbouring diagonals of the long templates are
merged, so that a few inserted or missing words do not break a span, and a
span counts when its votes, or those of the diagonals within ``max_shift`` of
one of its own, cover enough of the template.

The template index is built from the constants below, so it is broadcast: its
size is the number of their words, whatever the corpus.  Only hits are
shuffled, once, by document.

Two kinds of templates:

* phrases (``PHRASES``): all words must stand consecutively; diagonals are not
  merged, every place counts;
* passages (``PASSAGES``): at least ``min_cover`` of the pairs, within
  ``max_shift`` words of drift.  Pairs of two function words do not vote.

Defined results: null or empty text has no words and no labels (score 0);
equal rows (same id and text) each get the same row; a null id is kept; empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from servicelens.llm.text import KEY, keyed, plain_words

# The phrases of the contract and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Well-known sentences of public licenses and their labels.
PASSAGES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files": "mit-text",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
    " the license": "apache-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license": "gpl-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd-text",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the apache license version 2 0": "apache-notice",
    "licensed under the gnu general public license version 3": "gpl-notice",
    "released under the mit license": "mit-notice",
}

# Words whose pairs are too common to vote for a passage.
FUNCTION_WORDS = {"a", "and", "in", "is", "it", "of", "or", "that", "the", "this", "to", "under", "with", "you"}

MIN_COVER = 0.7  # share of a passage's voting pairs
MAX_SHIFT = 3  # words a diagonal may drift within one span

# A pair of spaces is no pair of words: its index row lets one row per
# document through the join, which carries the document's word count.
WHOLE = "#document"


def voting_pairs(template: str, passage: bool) -> list[tuple[str, str, int]]:
    """(word, next word, position) of the pairs that vote for a template."""
    words = template.split()
    pairs = [(a, b, i) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return [p for p in pairs if not (passage and {p[0], p[1]} <= FUNCTION_WORDS)]


def template_index(spark: SparkSession, phrases: dict[str, str], passages: dict[str, str]) -> DataFrame:
    """One row per voting pair: the two words, template, its position in it,
    voting pairs of the template, label, kind."""
    rows = [(" ", " ", WHOLE, 0, 1, None, False)]
    for kind, templates in ((False, phrases), (True, passages)):
        for template, label in templates.items():
            pairs = voting_pairs(template, kind)
            rows += [(a, b, template, i, len(pairs), label, kind) for a, b, i in pairs]
    schema = "w0 string, w1 string, template string, t_pos int, t_votes int, label string, passage boolean"
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64("w0", "w1"))


def pair_hits(docs: DataFrame, index: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per (document pair, equal template pair), and one of WHOLE per document."""
    df = keyed(docs, id_col, text_col)
    df = df.select(*KEY, plain_words(F.col("__text")).alias("words")).withColumn("n_words", F.size("words"))
    grams = F.when(
        F.col("n_words") >= 2,
        F.transform(
            F.sequence(F.lit(0), F.col("n_words") - 2),
            lambda i: F.xxhash64(F.get(F.col("words"), i), F.get(F.col("words"), i + 1)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    whole = F.array(F.xxhash64(F.lit(" "), F.lit(" ")))
    # outer: else the optimizer filters on the array's size first, below the
    # word list, and splits the text anew for every pair
    df = df.withColumn("grams", F.concat(whole, grams))
    df = df.select(*KEY, "n_words", "words", F.posexplode_outer("grams").alias("at", "gram"))
    hits = df.join(F.broadcast(index), "gram").withColumn("pos", F.col("at") - 1)
    # equal hashes are confirmed on the words themselves
    same = (F.get(F.col("words"), F.col("pos")) == F.col("w0")) & (F.get(F.col("words"), F.col("at")) == F.col("w1"))
    hits = hits.where((F.col("template") == WHOLE) | same)
    return hits.select(*KEY, "n_words", "template", "t_pos", "t_votes", "label", "passage", "pos")


def verified_spans(hits: DataFrame, min_cover: float = MIN_COVER, max_shift: int = MAX_SHIFT) -> DataFrame:
    """One row per span: key, template, label, start, cover (0 to 1); WHOLE
    spans stay, with the number of equal rows as ``copies``."""
    by_doc = hits.repartition(*KEY)
    diagonals = by_doc.groupBy(*KEY, "n_words", "template", "t_votes", "label", "passage", (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.collect_set("t_pos").alias("voted"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.count("*").alias("copies"),
    )
    order = Window.partitionBy(*KEY, "template").orderBy("first", "diagonal")
    apart = (
        ~F.col("passage")
        | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > max_shift)
        | (F.col("first") - F.lag("last").over(order) > max_shift + 1)
    )
    # a stray vote between two diagonals cuts the chain, but not the band around
    # one of them; a band cannot reach further than the template is long
    near = Window.partitionBy(*KEY, "template").orderBy("diagonal").rangeBetween(-max_shift, max_shift)
    band = F.when(F.col("passage"), F.size(F.array_distinct(F.flatten(F.collect_list("voted").over(near)))))
    spans = (
        diagonals.withColumn("band", band)
        .withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("apart").over(order))
        .groupBy(*KEY, "n_words", "template", "t_votes", "label", "passage", "span")
        .agg(
            F.greatest(F.size(F.array_distinct(F.flatten(F.collect_list("voted")))), F.max("band")).alias("votes"),
            F.min("diagonal").alias("start"),
            F.max("copies").alias("copies"),
        )
    )
    cover = F.col("votes") / F.col("t_votes")
    enough = F.when(F.col("passage"), cover >= min_cover).otherwise(F.col("votes") == F.col("t_votes"))
    return spans.withColumn("cover", cover).where(enough)


def _labels(condition: Column) -> Column:
    found = F.collect_set(F.when(condition, F.col("label")))
    return F.array_join(F.sort_array(found), ",")


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    passages: dict[str, str] = PASSAGES,
    min_cover: float = MIN_COVER,
    max_shift: int = MAX_SHIFT,
) -> DataFrame:
    """One row per input row: id, n_words, n_base (places of phrases),
    first_word and last_word (least and greatest start of a phrase),
    base_labels, labels, score (best cover; 1 for a phrase)."""
    index = template_index(docs.sparkSession, phrases, passages)
    spans = verified_spans(pair_hits(docs, index, id_col, text_col), min_cover, max_shift)
    base = ~F.col("passage") & (F.col("template") != WHOLE)
    found = spans.groupBy(*KEY, "n_words").agg(
        F.max(F.when(F.col("template") == WHOLE, F.col("copies"))).alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("label").isNotNull()).alias("labels"),
        F.coalesce(F.max(F.when(F.col("template") != WHOLE, F.col("cover"))), F.lit(0.0)).alias("score"),
    )
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return rows.select(
        F.col("__id").alias(id_col),
        F.col("n_words").cast("bigint").alias("n_words"),
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )


def op3_query(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
