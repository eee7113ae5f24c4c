"""Words that one slip parts, found by what is left of them without a letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer words have too many remains, and may lose more than two letters and still be alike enough.
LONGEST = 17


def _shorter(word: Column) -> Column:
    """All that is left of a word without one of its letters."""
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, F.length(word))))


def _remains(words: DataFrame, word: str, n: str) -> DataFrame:
    """(word, n, rest, out): the word as it is and without one letter, soft words without two as well; rest is a number."""
    c = F.col("word")
    rest = lambda texts, out: F.transform(F.array_distinct(texts), lambda t: F.struct(F.xxhash64(t).alias("rest"), F.lit(out).alias("out")))
    two = F.when(F.col("soft"), F.flatten(F.transform(_shorter(c), _shorter))).otherwise(F.array().cast("array<string>"))
    every = F.explode(F.concat(rest(F.array(c), 0), rest(_shorter(c), 1), rest(two, 2))).alias("r")
    return words.where(F.length("word") <= LONGEST + 2).select(c.alias(word), F.col("n").alias(n), every).select(word, n, F.col("r.rest").alias("rest"), F.col("r.out").alias(f"{word}_out"))


def near_words(ours: DataFrame, theirs: DataFrame, loss: float) -> DataFrame:
    """(v, u, ours) of different words v of ours and u of theirs, both (word, n, soft), that one slip parts: a letter more, less or another.

    Of soft words up to LONGEST letters, also those of which at most `loss` of all their letters have no counterpart in
    order: these are at most two of each. ours: v has no more names, of which it has n, than u.
    """
    both = _remains(ours, "v", "vn").join(_remains(theirs, "u", "un"), "rest").where("v <> u")
    alike = F.col("v_out") + F.col("u_out") <= loss * (F.length("v") + F.length("u")) + 1e-9
    slip = (F.col("v_out") <= 1) & (F.col("u_out") <= 1) & (F.levenshtein("v", "u") <= 1)
    return both.where(alike | slip).select("v", "u", (F.col("vn") <= F.col("un")).alias("ours")).distinct()
