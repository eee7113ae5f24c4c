"""Persons known by name only, matched with persons on record."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from string import ascii_lowercase

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import SOFT, name_similarity
from ..functions.text import name_tokens, slug
from ..runtime import cut, lookup
from .near_words import LONGEST, near_words

FUZZY, MOST_SLUGS = 0.96, 3
#: A key that more names hold is worked as pairs of sub-blocks of so many.
BLOCK = 1500
#: Names of more words may miss one and still be alike enough.
MOST_WORDS = 20
#: Names of more words are keyed by one word.
MOST_PAIRED = 6


def placeholders(kin: DataFrame) -> DataFrame:
    """(placeholder_key) of every edge end that is a name."""
    ends = kin.select(F.explode(F.array("source_key", "target_key")).alias("placeholder_key"))
    return ends.where(F.col("placeholder_key").startswith("nombre:")).distinct()


def _named(persons: DataFrame) -> DataFrame:
    """(candidate_key, cslug) of the persons with a name."""
    return persons.where("persona_key is not null and nombre is not null and nombre <> ''").select(F.col("persona_key").alias("candidate_key"), slug(F.col("nombre")).alias("cslug"))


def _exact(held: DataFrame, named: DataFrame) -> DataFrame:
    named = named.withColumnRenamed("cslug", "slug")
    counts = named.groupBy("slug").agg(F.count("*").alias("n"))
    held = held.withColumn("slug", F.substring("placeholder_key", len("nombre:") + 1, 10_000)).join(counts, "slug")
    one = F.col("n") == 1
    return held.join(named, "slug").select(
        "placeholder_key", "candidate_key", F.lit("slug_exacto").alias("metodo"), F.when(one, 1.0).otherwise(0.7).alias("score"), "slug",
        F.when(one, "alta").otherwise("media").alias("confianza"),
    )


def exact_candidates(kin: DataFrame, persons: DataFrame) -> DataFrame:
    """(placeholder_key, candidate_key, metodo, score, slug, confianza) of persons whose name has the placeholder's slug.

    The score is 1.0 for the only one (alta) and 0.7 for each of several (media).
    """
    return _exact(placeholders(kin), _named(persons))


def block_keys(words: list[str], least: float, own: bool) -> set[str]:
    """Keys of a name's distinct words: names that share a word and score `least` share a key. own: keys for the name's own spelling; the other
    side (own=False) has those of all words one slip away.

    Let two names of k words be so short that one word more or less costs too much. A score of `least` then leaves a loss of
    (1 - least) * k to all words together. A word without a counterpart one slip away loses 1 / (letters + 1) at least, so
    only so many can be without one. If these leave another word beside the one shared, the key is the shared word with a
    half of the other: of two words one slip apart, the first half is the same or what follows it. Otherwise, and for names
    of many words, the key is the shared word alone.
    """
    k = len(words)
    if k > MOST_PAIRED or any(0.5 + few / (few + many) >= least - 1e-6 for few, many in ((k - 1, k), (k, k + 1)) if few):
        return {f"*:{w}" for w in words}
    loss = accumulate(sorted(1 / (len(w) + 1) for w in words))
    lost = sum(x <= (1 - least + 1e-6) * k + 1e-9 for x in loss)
    out = {f"{k}:{w}" for w in words} if lost > k - 2 else set()
    tried = sorted(words, key=lambda v: (-len(v), v))
    for w in words:
        for v in [v for v in tried if v != w][: lost + 1 if own else None]:
            for n in (len(v),) if own else (len(v) - 1, len(v), len(v) + 1):
                h = n // 2
                out |= {f"{k}:{w}:{n}<{v[:h]}", f"{k}:{w}:{n}>{v[max(0, len(v) - n + h):]}"}
    return out


def _keyed(names: DataFrame, words: str, least: float, own: bool) -> DataFrame:
    """names' columns beside the words, and key: as a number; that two keys have one number only adds pairs, which are judged like all others."""
    kept = [c for c in ("id", "letters", "most") if c in names.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = [list(block_keys(list(ws), least, own)) for ws in pdf[words]]
            out = pdf[kept].assign(key=pd.Series(keys, index=pdf.index, dtype="object")).explode("key", ignore_index=True)
            yield out[out["key"].notna()]

    schema = "id long, letters long, most int, key string" if "most" in kept else "id long, letters long, key string"
    return names.select(*kept, words).mapInPandas(run, schema).withColumn("key", F.xxhash64("key"))


def _lost(words: Column, least: float) -> Column:
    """How many words of a name may be without a counterpart one slip away, as in block_keys."""
    most = (1 - least + 1e-6) * F.size(words) + 1e-9
    add = lambda a, x: F.struct((a["s"] + x).alias("s"), (a["n"] + F.when(a["s"] + x <= most, 1).otherwise(0)).alias("n"))
    losses = F.array_sort(F.transform(words, lambda w: 1 / (F.length(w) + F.lit(1.0))))
    return F.aggregate(losses, F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")), add, lambda a: a["n"])


def _letters(words: Column) -> Column:
    """A number with two bits a letter: whether the words have it, and whether more than once."""
    text = F.array_join(words, "")
    first = lambda c: F.position(F.lit(c), text)
    has = lambda at, bit: (at > 0).cast("long") * F.lit(1 << bit).cast("long")
    bits = (has(first(c), 2 * i) + has(F.position(F.lit(c), text, first(c) + 1), 2 * i + 1) for i, c in enumerate(ascii_lowercase))
    return sum(bits, F.lit(0).cast("long"))


def _most_apart(words: Column, least: float) -> Column:
    """By how many bits of _letters another name that scores `least` may differ, if both have up to five words; else 64.

    One word is shared. Of the others, one that has a counterpart one slip away differs by two letters at most. Those
    without lose (1 - least) * k together in one of the two directions, each the share of letters without a counterpart of
    the two words' letters, of which at least SOFT have one.
    """
    k = F.size(words)
    longest = F.array_max(F.transform(words, lambda w: F.length(w)))
    without = 2 * (k - 2) + F.floor((1 - least + 1e-6) * k * longest * 2 / SOFT + 1e-6)
    return F.when(k.between(2, 5) & F.lit(least >= FUZZY), F.greatest(2 * (k - 1), without)).otherwise(64).cast("int")


def _word_keys(held: DataFrame, slugs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(id, letters, most, key) of held and (id, letters, key) of slugs: names up to MOST_WORDS words of LONGEST letters that share a word and score `least` share a key.

    The key is two words of the name: the one shared, and another that is the same or one slip away, of which one of the
    two names takes the other's spelling: the one whose word has fewer names. So a given name is not spelt in all its slips
    by all its bearers. Of the words beside the shared one, so many of the longest are tried that one must have such a
    counterpart; where all may be without, near_words has those alike enough for names of two and three words. In a name of
    six or more another one always has: were none of them, each would lose 1 / (LONGEST + 1), which is too much. Names of up
    to five words score `least` only with as many words.
    """
    size = lambda words: F.least(F.size(words), F.lit(6))
    key = lambda words, w, x: F.xxhash64(size(words), F.least(w, x), F.greatest(w, x))
    single = lambda words, others: F.when(F.size(words) == 1, F.array(key(words, F.get(words, F.lit(0)), F.get(words, F.lit(0))))).otherwise(others)
    every = lambda keys: F.explode(F.array_distinct(keys)).alias("key")
    p, c = F.col("pt"), F.col("ct")
    slugs = slugs.where((F.size(c) > 0) & (F.size(c) <= MOST_WORDS + 2))
    tried = F.array_sort(F.transform(p, lambda w: F.struct((-F.length(w)).alias("letters"), w.alias("word"))))["word"]
    held = held.where(F.size(p) > 0).withColumn("tried", tried).withColumn("n", F.when(F.size(p) < 6, _lost(p, least) + 1).otherwise(F.size(p)))
    beside = lambda w: F.slice(F.filter("tried", lambda v: v != w), F.lit(1), F.col("n"))

    words = lambda df, col, free: df.select(F.explode(col).alias("word"), free.alias("free")).groupBy("word").agg(F.count("*").alias("n"), F.max("free").alias("free")).select("word", "n", (F.col("free") & (F.length("word") >= 12)).alias("soft"))
    near = cut(near_words(words(held, "pt", F.col("n") > F.size(p) - 1), words(slugs, "ct", F.size(c).between(2, 3)), 2 * (1 - least)))
    ours = held.select("id", "pt", "tried", "n", "letters", "most", F.explode("pt").alias("v")).join(near.where("ours").select("v", "u"), "v")
    theirs = slugs.select("id", "ct", "letters", F.explode("ct").alias("u")).join(near.where("not ours").select("v", "u"), "u")
    ours = ours.select("id", "letters", "most", every(F.transform(F.filter(p, lambda w: (w != F.col("v")) & F.array_contains(beside(w), F.col("v"))), lambda w: key(p, w, F.col("u")))))
    theirs = theirs.select("id", "letters", every(F.transform(F.filter(c, lambda w: w != F.col("u")), lambda w: key(c, w, F.col("v")))))
    as_typed = held.select("id", "letters", "most", every(single(p, F.flatten(F.transform(p, lambda w: F.transform(beside(w), lambda v: key(p, w, v)))))))
    on_record = slugs.select("id", "letters", every(single(c, F.flatten(F.transform(c, lambda w: F.transform(F.filter(c, lambda x: x > w), lambda x: key(c, w, x)))))))
    return as_typed.unionByName(ours), on_record.unionByName(theirs)


def _pairs(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(pid, cid), each pair once, of ours (id, key, letters, most) and theirs (id, key, letters) that share a key and differ by `most` letters at most."""
    ours = cut(ours)
    theirs = cut(theirs.join(ours.select("key"), "key", "left_semi"))
    count = lambda df, name: df.groupBy("key").agg(F.count("*").alias(name))
    most = lambda df: df.agg(F.coalesce(F.max("n"), F.lit(0))).collect()[0][0]
    rows = max(most(count(ours, "n")), most(count(theirs, "n")))
    left = ours.select("key", F.col("id").alias("pid"), F.col("letters").alias("pl"), "most")
    right = theirs.select("key", F.col("id").alias("cid"), F.col("letters").alias("cl"))
    keys = ["key"]
    if rows > BLOCK:
        split = cut(count(ours, "pn").join(count(theirs, "cn"), "key").select("key", *(F.ceil(F.col(n) / BLOCK).cast("int").alias(n) for n in ("pn", "cn"))))
        part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = lookup(left, split, "key", how="inner", rows=rows).select(*left.columns, part("pid", "pn").alias("x"), every("cn").alias("y"))
        right = lookup(right, split, "key", how="inner", rows=rows).select(*right.columns, every("pn").alias("x"), part("cid", "cn").alias("y"))
        keys = ["key", "x", "y"]
    return left.join(right, keys).where(F.bit_count(F.col("pl").bitwiseXOR(F.col("cl"))) <= F.col("most")).select("pid", "cid").distinct()


def fuzzy_candidates(kin: DataFrame, persons: DataFrame, least: float = FUZZY, most: int = MOST_SLUGS) -> DataFrame:
    """The same by similarity, for placeholders without an exact one: the best `most` slugs, all their persons."""
    held, named = cut(placeholders(kin)), cut(_named(persons))
    return _fuzzy(held, named, _exact(held, named), least, most)


def _fuzzy(held: DataFrame, named: DataFrame, exact: DataFrame, least: float = FUZZY, most: int = MOST_SLUGS) -> DataFrame:
    """fuzzy_candidates of the placeholders held and the named persons.

    Every pair that shares any word is a candidate, if the number of words differs by two at most and leaves room for a
    score of `least`: of the two coefficients that a score is the mean of, one cannot exceed that of the fewer words all
    found among the more. Of these, _word_keys leaves out most that cannot score `least`: else the pairs would grow with the
    square of a given name's bearers. Names of longer or more words than it takes, and those on record that can be as much
    like them, are keyed by block_keys. Before a pair is scored in Python, the JVM drops those that cannot reach `least`: of
    names of as many words, up to MOST_WORDS, every word needs a counterpart one slip away, or one at least SOFT alike,
    whose edit distance is then at most 1 - SOFT of both lengths.
    """
    numbered = lambda df: cut(df.withColumn("id", F.monotonically_increasing_id()))
    slugs = numbered(named.select("cslug").distinct().withColumn("ct", name_tokens(F.col("cslug"))).withColumn("letters", _letters(F.col("ct"))))
    held = numbered(held.join(exact.select("placeholder_key"), "placeholder_key", "left_anti").withColumn("pt", name_tokens(F.substring("placeholder_key", len("nombre:") + 1, 10_000))).withColumn("letters", _letters(F.col("pt"))).withColumn("most", _most_apart(F.col("pt"), least)))
    longer = lambda words, n: F.exists(words, lambda w: F.length(w) > n)
    odd = longer("pt", LONGEST) | (F.size("pt") > MOST_WORDS) if least >= FUZZY else F.lit(True)
    as_odd = longer("ct", LONGEST * SOFT / (2 - SOFT)) | (F.size("ct") > 5) if least >= FUZZY else F.lit(True)
    ours, theirs = _word_keys(held.where(~odd), slugs, least)
    both = _pairs(ours.unionByName(_keyed(held.where(odd), "pt", least, own=False)), theirs.unionByName(_keyed(slugs.where(as_odd), "ct", least, own=True)))
    both = both.join(held.select(F.col("id").alias("pid"), "placeholder_key", "pt"), "pid").join(slugs.select(F.col("id").alias("cid"), "cslug", "ct"), "cid")
    few, many = F.least(F.size("ct"), F.size("pt")), F.greatest(F.size("ct"), F.size("pt"))
    fits = (many - few <= 2) & (0.5 + few / (few + many) >= least - 1e-6) & F.arrays_overlap("pt", "ct")
    slips = lambda x, y: F.greatest(F.lit(1), F.floor((1 - SOFT) * (F.length(x) + F.length(y)) + 1e-9))
    matched = F.forall(F.array_except("pt", "ct"), lambda x: F.exists("ct", lambda y: F.levenshtein(x, y) <= slips(x, y)))
    may = matched if least > 1 - 1 / MOST_WORDS else F.lit(True)
    may = F.when((F.size("pt") == F.size("ct")) & (F.size("pt") <= MOST_WORDS), may).otherwise(True)
    pairs = both.where(fits & may).select("placeholder_key", "cslug")
    scored = pairs.withColumn("slug", F.substring("placeholder_key", len("nombre:") + 1, 10_000)).withColumn("score", name_similarity("slug", "cslug")).where(F.col("score") >= least)
    best = scored.withColumn("k", F.row_number().over(Window.partitionBy("placeholder_key").orderBy(F.desc("score"), "cslug"))).where(F.col("k") <= most)
    return best.join(named, "cslug").select(
        "placeholder_key", "candidate_key", F.lit("set_dice_typo_v1").alias("metodo"), F.bround("score", 3).alias("score"), "slug",
        F.when(F.col("score") >= 0.985, "media").otherwise("baja").alias("confianza"),
    )


def candidates(kin: DataFrame, persons: DataFrame) -> DataFrame:
    return candidates_of(cut(placeholders(kin)), persons)


def candidates_of(held: DataFrame, persons: DataFrame) -> DataFrame:
    """Exact and fuzzy candidates of placeholders that are a stored table."""
    named = cut(_named(persons))
    exact = cut(_exact(held, named))
    return exact.unionByName(_fuzzy(held, named, exact))
