"""Occupations in free texts (O1, O2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.functions.dates import let

#: Phrases of notes after which an occupation stands.
PHRASES = [
    r"occupation[: ]+([a-z0-9 \-/,]+)", r"\bocc[: ]+([a-z0-9 \-/,]+)", r"employed as(?: an| a)? ([a-z0-9 \-]+)", r"worked as(?: an| a)? ([a-z0-9 \-]+)",
    r"worked .* as (?:an|a)? ?([a-z0-9 \-]+)", r"served as(?: an| a)? ([a-z0-9 \-]+)", r"was an? ([a-z0-9 \-]+)",
]


def word_text(c: Column) -> Column:
    """Lower-case letters, digits and single blanks, with a blank at either end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " ")), F.lit(" "))


def split_terms(c: Column) -> Column:
    """O2: the comma-separated terms, trimmed, in lower case, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.lower(c), ","), lambda x: F.trim(x)), lambda x: x != "")))


def note_terms(c: Column) -> Column:
    """O2: what a note says of someone's occupation, by fixed phrases."""
    t = F.lower(F.trim(c))
    said = F.flatten(F.array(*[F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in PHRASES]))
    terms = F.flatten(F.transform(said, lambda x: F.transform(F.split(x, ","), lambda y: F.trim(y))))
    return F.array_sort(F.array_distinct(F.filter(terms, lambda x: x != "")))


def occupations_in(texts: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """O1: ``(key, canonical)`` for every dictionary variant that stands in a text.
    ``dictionary``: ``(variant, canonical)``. Runs of words, as long as the longest
    variant has words, are joined with the variants, so the work follows the length
    of the texts, not the dictionary."""
    names = dictionary.select(F.trim(word_text(F.col("variant"))).alias("variant"), "canonical").filter("variant <> ''").distinct()
    most = names.agg(F.max(F.size(F.split("variant", " "))).alias("n")).first()["n"] or 1
    words = F.filter(F.split(word_text(F.col(text)), " "), lambda w: w != "")

    def runs(w: Column, k: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: i + k - 1 <= F.size(w))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(k)), " "))

    all_runs = let(words, lambda w: F.array_distinct(F.flatten(F.array(*[runs(w, k) for k in range(1, most + 1)]))))
    spots = texts.select(key, F.explode(all_runs).alias("variant"))
    return spots.join(names, "variant").select(key, "canonical").distinct()


def inferred_occupations(explicit: DataFrame, notes: DataFrame, key: str, dictionary: DataFrame) -> DataFrame:
    """O1: ``(key, explicit, inferred, all_found)``: sorted occupations found in the
    occupation fields, in the notes, and in either. ``explicit`` and ``notes``:
    ``(key, text)``."""
    e = occupations_in(explicit, key, "text", dictionary).withColumn("src", F.lit("e"))
    n = occupations_in(notes, key, "text", dictionary).withColumn("src", F.lit("n"))
    have = lambda s: F.array_sort(F.collect_set(F.when(F.col("src") == s, F.col("canonical"))))
    return e.unionByName(n).groupBy(key).agg(have("e").alias("explicit"), have("n").alias("inferred"), F.array_sort(F.collect_set("canonical")).alias("all_found"))
