"""A whole load: sources to graph tables, in one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.place_merge import merges
from ..operators.reconcile import candidates
from ..operators.upsert import redirect, upsert, without_merged
from ..runtime import cut
from ..sources.files import direct_sources
from . import graph as G
from . import validation as V


#: Columns of which the last row counts, null included; of all others the last that is known.
LAST = ["nombre", "genero", "fuente", "tipoGeopolitico", "pais_code"]


def _added(df: DataFrame, direct: DataFrame | None) -> DataFrame:
    """df and, below it, a direct source's rows; columns that df lacks are left out."""
    if direct is None:
        return df
    return df.unionByName(direct.select(*[c for c in df.columns if c in direct.columns]), allowMissingColumns=True)


def _merged(df: DataFrame, direct: DataFrame | None, key: str) -> DataFrame:
    """The same by key: a direct source's row wins over the built one, a later file's over an earlier one's."""
    if direct is None:
        return df
    base = df.withColumn("_seq", F.struct(F.lit(-1).alias("f"), F.lit(-1).alias("p")))
    own = direct.select(*[c for c in df.columns if c in direct.columns], F.struct(F.col("_file").alias("f"), F.col("_pos").alias("p")).alias("_seq"))
    rows = base.unionByName(own, allowMissingColumns=True)
    rest = [c for c in df.columns if c != key]
    return upsert(rows, [key], F.col("_seq"), last=[c for c in rest if c in LAST], known=[c for c in rest if c not in LAST])


def tables(spark: SparkSession, d: str, options: G.Options | None = None, sources: str | None = None) -> dict[str, DataFrame]:
    """The graph's tables by name. Rows of direct sources come last and win; with skip_places there are no place tables."""
    o = options or G.Options()
    direct = {k: v for k, v in (direct_sources(spark, sources)[0] if sources else {}).items() if "_file" in v.columns}
    people = cut(_merged(G.vertices(spark, d, o), direct.get("personas"), "persona_key"))
    kin = cut(_added(G.kinship(spark, d, o.normalized_kin), direct.get("relaciones_interpersonales")))
    out = {"personas": people, "relaciones": kin}
    if not o.skip_candidates:
        out["candidatos"] = cut(candidates(kin, people.where(F.col("persona_key").startswith("registro:"))))
    if not o.skip_places:
        layer = G.place_layer(spark, d, o)
        more = lambda name, column, kind: direct[name].where(F.col(column) == kind) if name in direct else None
        centres = G.centres(spark, d)
        places = cut(_merged(layer.places.unionByName(centres, allowMissingColumns=True), more("lugares", "tipo_entidad", "Lugar"), "lugar_key"))
        parents = cut(_added(layer.parents.unionByName(G.anchors(spark, d, layer.places, o)), more("jerarquias", "tipo_relacion", "PARTE_DE")).distinct())
        events = cut(_added(layer.events.unionByName(G.centre_events(spark, d)), direct.get("eventos_espaciales")))
        addresses = cut(_added(layer.addresses.drop("direccion_norm").unionByName(G.centre_addresses(spark, d), allowMissingColumns=True), more("lugares", "tipo_entidad", "DireccionCCD")))
        aliases = cut(_added(layer.aliases, more("lugares", "tipo_entidad", "AliasLugar")))
        if o.apply_place_merges:
            scope = aliases.groupBy("lugar_key").agg(F.min("parent_key").alias("scope"), F.count("*").alias("n")).where("scope <> '__ROOT__'")
            cities = places.where("tipoGeopolitico = 'CIUDAD'").join(scope, "lugar_key").select("lugar_key", "nombre", "scope", "n")
            audit = cut(merges(cities.drop("n"), cities.select("lugar_key", "n")))
            out["fusiones"] = audit
            places = without_merged(places, audit, "lugar_key")
            parents, events = redirect(parents, audit, ["child_key", "parent_key"]), redirect(events, audit, ["lugar_key"])
            addresses, aliases = redirect(addresses, audit, ["lugar_key"]), redirect(aliases, audit, ["lugar_key"])
        out |= {"lugares": places, "parte_de": parents, "eventos": events, "direcciones": addresses, "alias": aliases}
    if not o.skip_report:
        none = lambda schema: spark.createDataFrame([], schema)
        out["informe"] = V.report(
            people, kin, out.get("eventos", none("tipo_relacion string")), out.get("lugares", none("lugar_key string")), out.get("direcciones", none("lugar_key string")), out.get("alias", none("alias_key string")), out.get("candidatos")
        )
    return out


def load(spark: SparkSession, d: str, target: str, options: G.Options | None = None, sources: str | None = None) -> list[str]:
    """Write the tables as parquet below target, replacing those of an earlier load; edges are kept by their type."""
    made = tables(spark, d, options, sources)
    for name, df in made.items():
        writer = df.write.mode("overwrite")
        (writer.partitionBy("tipo_relacion") if name == "eventos" else writer).parquet(f"{target}/{name}")
    return sorted(made)
