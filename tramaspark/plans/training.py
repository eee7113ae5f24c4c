"""Queries of the general data problems: nested records (p1), hierarchies (p3) and places (p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geo
from ..operators.hierarchy import descendants, hierarchy, paths
from ..operators.latest import latest
from ..operators.nested import flatten, parse_json_column
from ..runtime import cut, table


def nested_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The flat tables of victimas.sentencias, victimas.ccds and imputados.sentencias_y_victimas, by level path."""
    v = cut(latest(table(spark, d, "victimas"), "victima_id", "capturado_en", ["sentencias", "ccds"]))
    raw = latest(table(spark, d, "imputados"), "imputado_id", "capturado_en", ["sentencias_y_victimas"])
    i = cut(parse_json_column(cut(raw), "sentencias_y_victimas", "lista", frozenset({"delitos"})).select("imputado_id", "lista"))
    v, i = v.withColumnRenamed("victima_id", "clave"), i.withColumnRenamed("imputado_id", "clave")
    return (
        flatten(v, "clave", "sentencias", "victimas.sentencias")
        | flatten(v, "clave", "ccds", "victimas.ccds")
        | flatten(i, "clave", "lista", "imputados.sentencias_y_victimas")
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, t in nested_tables(spark, d).items():
        branch = F.lit(".".join(name.split(".")[:2]))
        one = t.select(branch.alias("rama"), "clave", F.col("sk").alias("ruta"))
        out = one if out is None else out.unionByName(one)
    return out


def p1_delitos(spark: SparkSession, d: str) -> DataFrame:
    """Every crime with the sentence and the accused above it: three of the flat tables joined by their keys."""
    t = nested_tables(spark, d)
    s = t["victimas.sentencias"].select("clave", F.col("sk").alias("s"), "sentencia_nombre")
    a = t["victimas.sentencias.imputados"].select("clave", F.col("sk").alias("a"), F.col("parent_sk").alias("s"), "imputado_nombre")
    c = t["victimas.sentencias.imputados.delitos"].select("clave", F.col("parent_sk").alias("a"), "ordinal", F.col("valor").alias("delito"))
    return c.join(a, ["clave", "a"]).join(s, ["clave", "s"]).select("clave", "sentencia_nombre", "imputado_nombre", "ordinal", "delito")


def _parte_de(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jerarquias").where(F.col("tipo_relacion") == "PARTE_DE")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    nodes, cyclic = hierarchy(_parte_de(spark, d), "child_key", "parent_key", "cargado_en", intervals=False)
    tree = nodes.select(F.col("node").alias("node_key"), "root_key", "depth")
    return tree.unionByName(cyclic.select(F.col("node").alias("node_key"), "root_key", F.col("depth").cast("int").alias("depth")))


def p3_rutas(spark: SparkSession, d: str) -> DataFrame:
    """Full path, depth, root and descendants (their number) of every node in a tree."""
    nodes, _ = hierarchy(_parte_de(spark, d), "child_key", "parent_key", "cargado_en")
    out = paths(nodes)
    return out.select(F.col("node").alias("node_key"), "root_key", "depth", F.col("path").alias("ruta"), (F.col("size") - 1).alias("n_descendientes"))


def p3_descendientes(spark: SparkSession, d: str) -> DataFrame:
    """Every node with each of its descendants."""
    nodes, _ = hierarchy(_parte_de(spark, d), "child_key", "parent_key", "cargado_en")
    nodes = cut(nodes)
    return descendants(nodes, nodes).select(F.col("ancestor").alias("node_key"), F.col("node").alias("descendiente"))


def located_points(spark: SparkSession, d: str) -> DataFrame:
    c = latest(table(spark, d, "ccds"), "id_ccd", "actualizado_en", ["lat", "lon"])
    e = latest(table(spark, d, "eaaf_lugares"), "sitio_id", "cargado_en", ["Lat", "Long"])
    return geo.located(c, F.concat(F.lit("c:"), "id_ccd"), F.col("lat"), F.col("lon")).unionByName(
        geo.located(e, F.concat(F.lit("e:"), F.col("sitio_id").cast("string")), geo.degrees(F.col("Lat")), geo.degrees(F.col("Long")))
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    points = cut(located_points(spark, d))
    near = geo.near_pairs(points, 500.0).select(F.col("key_a").alias("clave_a"), F.col("key_b").alias("clave_b"))
    areas = geo.regions(table(spark, d, "areas_militares").groupBy("area_id").agg(F.max("wkt").alias("wkt")), F.concat(F.lit("r:"), "area_id"), F.col("wkt"))
    held = geo.inside(points, areas).select(F.col("key").alias("clave_a"), F.col("area").alias("clave_b"))
    return near.unionByName(held)
