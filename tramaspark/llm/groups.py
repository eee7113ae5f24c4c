"""Pairwise matches as groups: connected components on a two-dimensional grid of vertex blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, stored

EDGES_PER_CELL = 20_000


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _local(pdf: pd.DataFrame) -> pd.DataFrame:
    """Union-find over one block pair's edges: every vertex with the smallest vertex it is linked to here."""
    both = pd.concat([pdf["a"], pdf["b"]], ignore_index=True)
    names = np.array(sorted(set(both)), dtype=object)
    at = {v: i for i, v in enumerate(names)}
    n = len(names)
    parent = list(range(n))
    for a, b in zip(pdf["a"].map(at), pdf["b"].map(at), strict=True):
        x, y = _find(parent, a), _find(parent, b)
        if x != y:
            # the smaller name stays the representative
            parent[max(x, y)] = min(x, y)
    return pd.DataFrame({"v": names, "rep": names[[_find(parent, i) for i in range(n)]]})


def components(pairs: DataFrame, a: Column, b: Column, edges_per_cell: int = EDGES_PER_CELL) -> DataFrame:
    """(record_key, group_key): every non-empty key of either column with the smallest key of its group.

    A row whose two keys are both non-empty is a match; one with an empty or null side only names a key, which is its
    own group if nothing links it. Repeated and turned pairs, and a key matched with itself, change nothing. Keys are
    text and compare by bytes.

    Vertices are hashed into B blocks, B growing with the square root of the edges, and each edge goes to the cell of
    its two blocks. A hot vertex with a third of all edges has them spread over the B cells of its row and column. Every
    cell runs union-find by itself; a vertex then gathers the representatives of its row and column (at most 2B - 1
    of them), takes the smallest as parent and links the others to it. Those links are the next round's edges, and
    rounds go on until all cells agree. The parents of all rounds are then followed back.
    """
    spark = pairs.sparkSession
    rows = pairs.select(F.nullif(a.cast("string"), F.lit("")).alias("a"), F.nullif(b.cast("string"), F.lit("")).alias("b"))
    keys = rows.select(F.explode(F.array("a", "b")).alias("record_key")).where("record_key is not null").distinct()
    edge = rows.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, path = stored(edge)
    rounds: list[DataFrame] = []
    while True:
        n = edges.count()
        if not n:
            break
        side = max(1, int(np.ceil(np.sqrt(2 * n / edges_per_cell))))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(side)).cast("int")  # noqa: E731, B023
        cell = edges.withColumn("row", F.least(block("a"), block("b"))).withColumn("col", F.greatest(block("a"), block("b")))
        local = cell.groupBy("row", "col").applyInPandas(_local, "v string, rep string")
        met, met_path = stored(local.groupBy("v").agg(F.array_sort(F.collect_set("rep")).alias("reps")))
        rounds.append(met.select("v", F.element_at("reps", 1).alias("rep")))
        onward = met.where(F.size("reps") > 1).select(
            F.element_at("reps", 1).alias("a"), F.explode(F.slice("reps", F.lit(2), F.size("reps") - 1)).alias("b")
        )
        old = path
        edges, path = stored(onward.distinct())
        discard(spark, old)
    label: DataFrame | None = None
    for parent in reversed(rounds):
        if label is None:
            label = parent
            continue
        top = label.select(F.col("v").alias("rep"), F.col("rep").alias("__top"))
        label = _follow(parent, top)
    if label is None:
        return keys.withColumn("group_key", F.col("record_key"))
    found = label.select(F.col("v").alias("record_key"), "rep")
    return keys.join(found, "record_key", "left").select("record_key", F.coalesce("rep", "record_key").alias("group_key"))


def _follow(parent: DataFrame, top: DataFrame) -> DataFrame:
    from ..runtime import lookup

    return lookup(parent, top, "rep").select("v", F.coalesce("__top", "rep").alias("rep"))
