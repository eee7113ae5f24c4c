"""The newest row of every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hashable(df: DataFrame, name: str) -> Column:
    """A column xxhash64 accepts: maps, which it rejects, as JSON text."""
    kind = df.schema[name].dataType
    return F.to_json(F.col(f"`{name}`")) if "map" in kind.simpleString() else F.col(f"`{name}`")


def latest(df: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """One row (key, *cols) per non-null key: that with the greatest `ts`.

    A null ts counts as the oldest; among rows of the same ts the one with the greatest hash of its columns is taken, so
    the result is the same in every run. Rows without key are left out: nothing identifies them. max_by is combined
    before the shuffle, so that a key with a third of all rows sends one row per map task.
    """
    rest = [c for c in cols if c != key]
    order = F.struct(
        F.coalesce(F.col(ts), F.to_timestamp(F.lit("0001-01-01"))).alias("ts"),
        F.xxhash64(*[hashable(df, c) for c in rest]).alias("h") if rest else F.lit(0).alias("h"),
    )
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order) if rest else F.lit(None)
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("__row"))
    return out.select(key, *[F.col("__row").getField(c).alias(c) for c in rest])


def empty(df: DataFrame) -> bool:
    return not df.take(1)


__all__ = ["T", "empty", "hashable", "latest"]
