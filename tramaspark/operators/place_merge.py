"""Places of one scope whose names differ by one slip, merged."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import merge_verdict
from ..runtime import cut


def slip_candidates(places: DataFrame) -> DataFrame:
    """(lugar_key_a, nombre_a, lugar_key_b, nombre_b), keys in order, of places of one scope that differ in one word alone.

    Two such names agree in all words but one and have as many; so places are joined on (scope, the name without one
    word, its position) and two letters in a row of that word: words at least 0.8 alike always share two, since their
    common part is longer than the number of gaps in it. They are not compared with all others of the scope.
    """
    words = places.where("lugar_key is not null and nombre is not null and scope is not null").withColumn("w", F.split("nombre", " "))
    holes = words.select("lugar_key", "nombre", "scope", F.posexplode("w").alias("i", "word"), "w")
    rest = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("i")), F.lit("\u0001"), F.slice("w", F.col("i") + 2, F.size("w")))
    pairs_of_letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1))), lambda k: F.substr("word", k, F.lit(2))))
    keyed = holes.select("lugar_key", "nombre", "scope", rest.alias("rest"), F.explode(pairs_of_letters).alias("edge"), F.size("w").alias("n"))
    a = keyed.select(*[F.col(c).alias(f"{c}_a") if c in ("lugar_key", "nombre") else F.col(c) for c in keyed.columns])
    b = keyed.select(*[F.col(c).alias(f"{c}_b") if c in ("lugar_key", "nombre") else F.col(c) for c in keyed.columns])
    return a.join(b, ["scope", "rest", "edge", "n"]).where("lugar_key_a < lugar_key_b and nombre_a <> nombre_b").select("lugar_key_a", "nombre_a", "lugar_key_b", "nombre_b").distinct()


def slip_pairs(places: DataFrame) -> DataFrame:
    """(a, b, score, reason), a < b, of places (lugar_key, nombre, scope) of one scope whose names differ by one slip."""
    pairs = slip_candidates(places)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for ka, na, kb, nb in pdf.itertuples(index=False):
                ok, score, why = merge_verdict(na, nb)
                if ok:
                    rows.append((ka, kb, score, why))
            yield pd.DataFrame(rows, columns=["a", "b", "score", "reason"])

    return pairs.mapInPandas(run, "a string, b string, score double, reason string")


def connected(pairs: DataFrame) -> DataFrame:
    """(key, root): the smallest key of each component, by labels that spread and jump until none changes."""
    edge = cut(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(edge.select(F.col("a").alias("key")).distinct().withColumn("root", F.col("key")))
    while True:
        near = edge.join(label.select(F.col("key").alias("b"), "root"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("near"))
        step = label.join(near, "key", "left").select("key", F.least("root", F.coalesce("near", "root")).alias("next"), "root")
        jump = step.select(F.col("key").alias("next"), F.col("next").alias("far"))
        new = cut(step.join(jump, "next", "left").select("key", F.least("next", F.coalesce("far", "next")).alias("root"), F.col("root").alias("old")))
        label = new.select("key", "root")
        if not new.where("root <> old").take(1):
            return label


def merges(places: DataFrame, alias_counts: DataFrame) -> DataFrame:
    """(source_key, target_key, score, reason): every place of a component but its target, the place of most aliases.

    alias_counts: (lugar_key, n). A pair that is only linked through others has the score 0.91 and the reason typo_cluster.
    """
    pairs = cut(slip_pairs(places))
    group = connected(pairs)
    sized = group.join(alias_counts.withColumnRenamed("lugar_key", "key"), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = sized.withColumn("k", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("n"), "key")))
    target = ranked.where("k = 1").select("root", F.col("key").alias("target_key"))
    rows = ranked.where("k > 1").join(target, "root").select(F.col("key").alias("source_key"), "target_key", F.least("key", "target_key").alias("a"), F.greatest("key", "target_key").alias("b"))
    return rows.join(pairs, ["a", "b"], "left").select("source_key", "target_key", F.bround(F.coalesce("score", F.lit(0.91)), 3).alias("score"), F.coalesce("reason", F.lit("typo_cluster")).alias("reason"))
