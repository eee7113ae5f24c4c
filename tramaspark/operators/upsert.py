"""Merging rows into vertices and edges: last write wins, first known value wins, sets and bags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import lookup


def upsert(rows: DataFrame, keys: list[str], seq: Column, last: list[str] = (), known: list[str] = (), first: list[str] = ()) -> DataFrame:
    """One row per key. `last` columns are those of the latest row, null included; `known` the latest that is not null;
    `first` those of the earliest row. Rows with a null key are left out. Everything is one combined aggregation, so that
    a hot key sends one row per map task.
    """
    named = rows.dropna(subset=list(keys)).withColumn("__seq", seq)
    out = [F.max_by(F.struct(F.col(c)), "__seq").getField(c).alias(c) for c in last]
    out += [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__seq"))).alias(c) for c in known]
    out += [F.min_by(c, "__seq").alias(c) for c in first]
    return named.groupBy(*keys).agg(*out) if out else named.select(*keys).distinct()


def linked(edges: DataFrame, vertices: DataFrame, key: str, column: str) -> DataFrame:
    """The edges whose `column` is a vertex; repeated edges stay."""
    return lookup(edges, vertices.select(F.col(key).alias(column)).distinct(), column, how="inner")


def with_placeholders(vertices: DataFrame, key: str, edges: DataFrame, ends: list[tuple[str, str]], name: str = "nombre") -> DataFrame:
    """Vertices and, for every edge end that is none yet, a new one; a vertex without name takes the one an edge gives it.

    ends: (key column, name column) of each end.
    """
    said = None
    for end, label in ends:
        one = edges.select(F.col(end).alias(key), F.col(label).alias("__said")).dropna(subset=[key])
        said = one if said is None else said.unionByName(one)
    said = said.groupBy(key).agg(F.min("__said").alias("__said"))
    return vertices.join(said, key, "full").withColumn(name, F.coalesce(name, "__said")).drop("__said")


def edge_set(edges: DataFrame, columns: list[str]) -> DataFrame:
    return edges.select(*columns).distinct()


def redirect(edges: DataFrame, merges: DataFrame, columns: list[str]) -> DataFrame:
    """Edges whose ends in `columns` are replaced as merges (source_key, target_key) say, repeated ones once.

    All edge types are treated alike, so that none is lost with a merged vertex.
    """
    out = edges
    for c in columns:
        to = merges.select(F.col("source_key").alias(c), F.col("target_key").alias("__to"))
        out = lookup(out, to, c).withColumn(c, F.coalesce("__to", c)).drop("__to")
    return out.select(*edges.columns).distinct()


def without_merged(vertices: DataFrame, merges: DataFrame, key: str) -> DataFrame:
    return vertices.join(merges.select(F.col("source_key").alias(key)).distinct(), key, "left_anti")


def violations(df: DataFrame, table: str, unique: list[str], required: list[str], domains: dict[str, list[str]] | None = None) -> DataFrame:
    """(tabla, regla, columna, filas): keys on several rows, required values that are missing, and values outside their domain."""
    one = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    missing = one.select(F.explode(F.create_map(*[x for c in required for x in (F.lit(c), F.col(c))])).alias("columna", "filas")) if required else None
    parts = [] if missing is None else [missing.select(F.lit(table).alias("tabla"), F.lit("existencia").alias("regla"), "columna", "filas")]
    for c in unique:
        twice = df.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1").agg(F.count("*").alias("filas"))
        parts.append(twice.select(F.lit(table).alias("tabla"), F.lit("unicidad").alias("regla"), F.lit(c).alias("columna"), "filas"))
    if domains:
        one = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(values)).alias(c) for c, values in domains.items()])
        outside = one.select(F.explode(F.create_map(*[x for c in domains for x in (F.lit(c), F.col(c))])).alias("columna", "filas"))
        parts.append(outside.select(F.lit(table).alias("tabla"), F.lit("dominio").alias("regla"), "columna", "filas"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
