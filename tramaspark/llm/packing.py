"""Filling containers of fixed capacity by conflict-constrained best fit."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, stored

PER_SHARD = 10_000
FULL = 0.97
MOST_KINDS = 1000


class Bins:
    """Bins of one capacity ordered by what is left in them, each with a bitmap of its sources and one of its clusters.

    A bit set of the residuals that occur gives the successor of a size; from there the search goes on to ever larger
    residuals until a bin is compatible, which is then the tightest that is.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.occupied = 0
        self.at: dict[int, list[int]] = {}
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _put(self, b: int, left: int) -> None:
        self.at.setdefault(left, []).append(b)
        self.occupied |= 1 << left

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin that takes an item; source and cluster are one-bit masks (0: none). No bin gets a cluster twice."""
        bits = self.occupied >> size
        base = size
        while bits:
            step = (bits & -bits).bit_length() - 1
            left = base + step
            here = self.at[left]
            for k in range(len(here) - 1, -1, -1):
                b = here[k]
                if not self.clusters[b] & cluster:
                    here[k] = here[-1]
                    here.pop()
                    if not here:
                        self.occupied &= ~(1 << left)
                    self.sources[b] |= source
                    self.clusters[b] |= cluster
                    self._put(b, left - size)
                    return b
            base = left + 1
            bits >>= step + 1
        b = len(self.sources)
        self.sources.append(source)
        self.clusters.append(cluster)
        self._put(b, self.capacity - size)
        return b


def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """Best fit, largest items first, of one shard's items (size, source, cluster, capacity); adds bin and filled."""
    pdf = pdf.sort_values(["size", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    again = pdf["cluster"].map(pdf["cluster"].value_counts()) > 1
    bit = {c: 1 << i for i, c in enumerate(pdf.loc[again, "cluster"].unique())}
    names = {s: 1 << i for i, s in enumerate(pdf["source"].fillna("").unique())}
    bins = Bins(int(pdf["capacity"].iat[0]))
    sizes, sources, clusters = pdf["size"].tolist(), pdf["source"].fillna("").map(names).tolist(), pdf["cluster"].tolist()
    pdf["bin"] = [bins.place(n, s, bit.get(c, 0)) for n, s, c in zip(sizes, sources, clusters, strict=True)]
    pdf["filled"] = pdf.groupby("bin")["size"].transform("sum")
    pdf["n_sources"] = [bins.sources[b].bit_count() for b in pdf["bin"]]
    return pdf


def pack(counts: DataFrame, containers: DataFrame, per_shard: int = PER_SHARD, full: float = FULL) -> DataFrame:
    """(contenedor, caja, doc_id, trozo, desde, n_tokens) of all documents in containers of every kind.

    counts: doc_id, source, cluster, n_tokens; containers: contenedor, capacidad_tokens (rows without a positive capacity
    are left out; of one name the largest counts). A document longer than the capacity fills whole containers with its
    first pieces, and its rest is an item like any other; no other document is cut. Documents of 0 tokens take no room
    and give no row. No container holds two copies of one text.

    Items are hashed into shards of about per_shard and each shard is packed by itself. What ends in a container filled
    less than `full` is taken out and packed again with the rests of the other shards, in ever fewer shards, until one
    shard has them all or no fewer shards do; only that last round leaves containers part empty for want of items.
    """
    spark = counts.sparkSession
    kinds = containers.where("capacidad_tokens > 0 and contenedor is not null").groupBy("contenedor").agg(F.max("capacidad_tokens").cast("long").alias("capacity"))
    counts, _ = stored(counts.where("n_tokens > 0"))
    kind_rows = kinds.limit(MOST_KINDS + 1).collect()
    if len(kind_rows) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    every = F.array(*[F.struct(F.lit(r["contenedor"]).alias("contenedor"), F.lit(r["capacity"]).cast("long").alias("capacity")) for r in kind_rows])
    each = counts.withColumn("kind", F.explode(every.cast("array<struct<contenedor:string,capacity:bigint>>"))).select("*", "kind.*").drop("kind")
    whole = F.floor(F.col("n_tokens") / F.col("capacity")).cast("long")
    each = each.withColumn("whole", whole).withColumn("rest", F.col("n_tokens") % F.col("capacity"))
    solid = each.where("whole > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))).select(
        "contenedor", F.concat_ws("-", F.lit("d"), "doc_id", "piece").alias("caja"), "doc_id", F.col("piece").cast("int").alias("trozo"),
        (F.col("piece") * F.col("capacity")).alias("desde"), F.col("capacity").alias("n_tokens"), F.lit(1).alias("n_sources"),
    )
    open_items, path = stored(
        each.where("rest > 0").select("contenedor", "capacity", "doc_id", F.col("whole").alias("piece"), F.col("rest").alias("size"), "source", "cluster")
    )
    parts, turn, before = [solid], 0, None
    while True:
        counted = {r["contenedor"]: r["n"] for r in open_items.groupBy("contenedor").agg(F.count("*").alias("n")).collect()}
        if not counted:
            break
        shards = {k: -(-n // per_shard) for k, n in counted.items()}
        last = sum(shards.values()) == len(shards) or (before is not None and sum(shards.values()) >= before)
        before = sum(shards.values())
        many = F.create_map(*[x for k, n in shards.items() for x in (F.lit(k), F.lit(n))])
        spread = open_items.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.element_at(many, F.col("contenedor"))).cast("int"))
        kind = "contenedor string, capacity long, doc_id long, piece long, size long, source string, cluster long, shard int, bin long, filled long, n_sources long"
        packed, packed_path = stored(spread.groupBy("contenedor", "shard").applyInPandas(pack_shard, kind))
        closed = packed if last else packed.where(F.col("filled") >= F.col("capacity") * full)
        parts.append(
            closed.select(
                "contenedor", F.concat_ws("-", F.lit(f"r{turn}"), "shard", "bin").alias("caja"), "doc_id", F.col("piece").cast("int").alias("trozo"),
                (F.col("piece") * F.col("capacity")).alias("desde"), F.col("size").alias("n_tokens"), F.col("n_sources").cast("int").alias("n_sources"),
            )
        )
        if last:
            break
        old = path
        open_items, path = stored(packed.where(F.col("filled") < F.col("capacity") * full).select(*open_items.columns))
        discard(spark, old)
        turn += 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """(contenedor, cajas, n_tokens, llenado): how full the containers are, by kind."""
    bins = packed.groupBy("contenedor", "caja").agg(F.sum("n_tokens").alias("n"))
    sums = bins.groupBy("contenedor").agg(F.count("*").alias("cajas"), F.sum("n").alias("n_tokens"))
    room = containers.groupBy("contenedor").agg(F.max("capacidad_tokens").alias("c"))
    return sums.join(room, "contenedor").select(
        "contenedor", "cajas", "n_tokens", (F.col("n_tokens") / (F.col("cajas") * F.col("c"))).alias("llenado")
    )


__all__ = ["Bins", "fill_report", "pack", "pack_shard"]
