"""Mixing sources to target weights with capped repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 20
MOST_TARGETS = 10_000
SALTS = 64


def rates(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(mezcla_id, source, peso, maximo, disponible, objetivo, tasa): how often each source's documents are to be used.

    The wanted total of a mix is fraccion_corpus of all tokens (those of documents without source included), a source's
    target is peso of it, and the rate is target / tokens of the source, at most max_repeticiones. Repeated target rows
    of one (mezcla_id, source) add up their weights; rows without id or source, or with a weight of 0 or less, are left
    out. A target source that no document has gets the rate 0.
    """
    by_source = counts.groupBy("source").agg(F.sum("n_tokens").alias("disponible"))
    corpus = float(counts.agg(F.sum("n_tokens")).collect()[0][0] or 0)
    goal = (
        targets.where("mezcla_id is not null and source is not null and peso > 0")
        .groupBy("mezcla_id", "source")
        .agg(F.sum("peso").alias("peso"), F.max("max_repeticiones").alias("maximo"), F.max("fraccion_corpus").alias("fraccion"))
    )
    joined = goal.join(by_source, "source", "left")
    target = F.col("peso") * F.col("fraccion") * F.lit(corpus)
    has = F.coalesce("disponible", F.lit(0))
    rate = F.when(has > 0, F.least(target / has, F.coalesce("maximo", F.lit(1)).cast("double"))).otherwise(F.lit(0.0))
    return joined.select("mezcla_id", "source", "peso", "maximo", has.alias("disponible"), target.alias("objetivo"), rate.alias("tasa"))


def mix(counts: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """(mezcla_id, doc_id, source, n_tokens, copias), copias >= 1: the documents drawn for every mix.

    A document is used floor(rate) times, and once more with probability rate - floor(rate), decided by a hash of
    (doc_id, mezcla_id, seed): the same in every run and on any number of executors. Nothing of the documents is
    shuffled after the sums per source: the rates are a few rows, and their number is checked before they are broadcast.
    More than MOST_TARGETS of them are joined by a shuffle in which a source's documents are spread over SALTS tasks.
    """
    r = rates(counts, targets).where("tasa > 0").select("mezcla_id", "source", "tasa")
    if targets.count() > MOST_TARGETS:
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")
        spread = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        joined = counts.select("*", salt).join(spread, ["source", "salt"])
    else:
        joined = counts.join(F.broadcast(r), "source")
    draw = F.pmod(F.xxhash64("doc_id", "mezcla_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    whole = F.floor("tasa")
    copies = (whole + F.when(draw < F.col("tasa") - whole, 1).otherwise(0)).cast("int")
    return joined.withColumn("copias", copies).where("copias > 0").select("mezcla_id", "doc_id", "source", "n_tokens", "copias")


def mix_report(drawn: DataFrame, counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Of every mix and source: the target share and that reached, the tokens wanted and drawn, and whether the cap binds."""
    r = rates(counts, targets)
    got = drawn.groupBy("mezcla_id", "source").agg(
        F.sum(F.col("n_tokens") * F.col("copias")).alias("obtenido"), F.count("*").alias("documentos"), F.sum("copias").alias("copias")
    )
    total = got.groupBy("mezcla_id").agg(F.sum("obtenido").alias("total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = r.join(got, ["mezcla_id", "source"], "left").join(total, "mezcla_id", "left")
    return out.select(
        "mezcla_id", "source", "peso", (F.coalesce("obtenido", F.lit(0)) / F.col("total")).alias("peso_real"), "objetivo", zero("obtenido"),
        zero("documentos"), zero("copias"), (F.col("tasa") * F.col("disponible") < F.col("objetivo") * (1 - 1e-9)).alias("limitada"),
    )
