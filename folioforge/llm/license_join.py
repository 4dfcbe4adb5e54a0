"""License scans: base phrases, and a set-similarity join with license templates.

DataFrame functions only.  Blocks are the runs of as many words as a template
has, across line ends too (a shorter text is one block); templates are token
sets.  A text gets a template's label where a block holds at least a threshold
share of the template's tokens.

Template tokens are ordered by document frequency over the whole corpus, rarest
first, all other words before them.  Words of the texts are joined with the
first |T| - need + 1 tokens of every template (prefix filter); a pair stays if
enough words are there for the template (length filter) and if the words around
the hit hold at least ``need`` tokens that do not precede it in the order
(positional filter).  Only then are blocks formed around the hit and counted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, read, stored

#: fixed values: base phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: templates; labels of the method's own
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2.0",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "lgpl": "licensed under the gnu lesser general public license version 3",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license version 2.0",
    "mit-short": "under the mit license",
    "reserved": "all rights reserved",
}
THRESHOLD = 0.8
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of already lower-cased text."""
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def _any_word(words: list[str]) -> str:
    """Regex on raw text: one of the words stands somewhere, in either case."""
    return rf"(?i:(?<!{_RAW_WORD[:-1]})(?:{'|'.join(map(re.escape, words))})(?!{_RAW_WORD[:-1]}))"


def _needed(size: int, threshold: float) -> int:
    return math.ceil(threshold * size - 1e-9)


def token_frequencies(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts of the corpus each token of the templates stands: at most one number per vocabulary word."""
    found = F.regexp_extract_all("text", F.lit(_any_word(vocabulary)), F.lit(0))
    each = rows.select(F.explode(F.array_distinct(F.transform(found, lower_ascii))).alias("word"))
    return {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix_table(spark: SparkSession, templates: Mapping[str, str], order: list[str], threshold: float) -> DataFrame:
    """One row per prefix token of each template: word, label, tokens, need, span (words of a block), after (tokens that do not precede the word)."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, text in sorted(templates.items()):
        listed = text.replace(".", " ").split()
        tokens = sorted(set(listed), key=rank.__getitem__)
        need = _needed(len(tokens), threshold)
        rows += [(w, label, tokens, need, len(listed), tokens[i:]) for i, w in enumerate(tokens[: len(tokens) - need + 1])]
    return spark.createDataFrame(rows, "word string, label string, tokens array<string>, need int, span int, after array<string>")


def template_matches(rows: DataFrame, prefixes: DataFrame, rare: list[str], widest: int) -> DataFrame:
    """rows (_row, words) joined with the templates: _row, matches (array of label, score).

    rare: the words of the prefixes; widest: the longest block.

    Only words around a hit travel; the table of prefixes has a few rows per
    template, a fixed number whatever the corpus.
    """
    spots = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda h: h["word"].isin(rare))
    near = F.transform(spots, lambda h: F.struct(h["word"].alias("word"), h["at"].alias("at"), F.slice("words", F.greatest(h["at"] - widest + 1, F.lit(0)) + 1, F.lit(2 * widest - 1)).alias("near")))
    hits = rows.select("_row", F.size("words").alias("n_words"), F.explode(near).alias("h")).select("_row", "n_words", "h.*")
    hits = hits.join(F.broadcast(prefixes), "word").filter("n_words >= need")  # length
    first, offset = F.greatest(F.col("at") - F.col("span") + 1, F.lit(0)), F.greatest(F.col("at") - widest + 1, F.lit(0))
    around = F.slice("near", first - offset + 1, F.col("at") - first + F.col("span"))
    hits = hits.select("_row", "label", "tokens", "need", "span", "at", "after", first.alias("first"), F.greatest(F.col("n_words") - F.col("span"), F.lit(0)).alias("last"), around.alias("around"))
    hits = hits.filter(F.size(F.array_intersect("around", "after")) >= F.col("need"))  # position
    starts = F.sequence("first", F.greatest(F.least("at", "last"), F.col("first")))
    counts = F.transform(starts, lambda s: F.size(F.array_intersect(F.slice("around", s - F.col("first") + 1, F.col("span")), F.col("tokens"))))
    best = hits.select("_row", "label", "need", F.size("tokens").alias("size"), F.array_max(counts).alias("n")).filter("n >= need")
    best = best.groupBy("_row", "label").agg(F.max(F.col("n") / F.col("size").cast("double")).alias("score"))
    return best.groupBy("_row").agg(F.collect_list(F.struct("label", "score")).alias("matches"))  # at most one entry per template


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the largest share of a template's tokens in one block among the
    labels found, 1 where only a base phrase stands, else 0.  Null text counts
    as empty (no words, no labels).  Null and repeated ids are kept row by row;
    other columns of docs are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    vocabulary = sorted({w for t in templates.values() for w in t.replace(".", " ").split()})
    counts = token_frequencies(rows, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    first = set()
    for t in templates.values():
        tokens = sorted(set(t.replace(".", " ").split()), key=rank.__getitem__)
        first.update(tokens[: len(tokens) - _needed(len(tokens), threshold) + 1])
    base = "|".join(_RAW_GAP.join(("", "+")).join(p.split()) for p in phrases)
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(_RAW_WORD)).cast("long").alias("n_words"), "text", F.col("text").rlike(f"(?i:{base})").alias("_base"), F.col("text").rlike(_any_word(sorted(first))).alias("_near"))
    rows = rows.select("doc_id", "n_words", "_base", "_near", F.when(F.col("_base") | F.col("_near"), words_of(lower_ascii(F.col("text")))).alias("words"))
    places = F.when(F.col("_base") & (F.size("words") > 0), F.concat(*(_places(p.split(), label) for p, label in phrases.items())))
    rows = rows.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "n_words", places.alias("places"), F.when(F.col("_near"), F.col("words")).alias("words"))
    rows = stored(rows, "license-rows")  # row numbers must not change between scans
    matches = template_matches(rows.filter("words is not null").select("_row", "words"), prefix_table(docs.sparkSession, templates, order, threshold), sorted(first), max(len(t.replace(".", " ").split()) for t in templates.values()))
    rows = rows.drop("words").join(matches, "_row", "left")
    none = F.array().cast("array<string>")
    mine = F.coalesce(F.transform("matches", lambda x: x["label"]), none)
    base_labels = F.array_sort(F.array_distinct(F.coalesce(F.transform("places", lambda x: x["label"]), none)))
    n_base = F.coalesce(F.when(F.col("places").isNotNull(), F.size("places")), F.lit(0)).cast("long")
    top = F.array_max(F.transform("matches", lambda x: x["score"]))
    return rows.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform("places", lambda x: x["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda x: x["at"])).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, mine)), ",").alias("labels"),
        F.greatest(F.coalesce(top, F.lit(0.0)), F.when(n_base > 0, 1.0).otherwise(0.0)).alias("score"),
    )


def _places(ws: list[str], label: str) -> Column:
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: _stand(i, ws))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def _stand(i: Column, ws: list[str]) -> Column:
    fits = F.lit(True)
    for k, w in enumerate(ws):
        fits = fits & F.coalesce(F.get("words", i + k) == w, F.lit(False))
    return fits


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))
