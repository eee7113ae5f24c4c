"""Queries of the problems that concern language-model data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest
from ..runtime import blank, cut, table
from .canonical import NOT_FOUND, mapped
from .groups import components
from .language import languages
from .linkage import link
from .mixing import mix, mix_report
from .packing import fill_report, pack
from .tokens import token_counts
from .variants import linked_pairs, members


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return components(table(spark, d, "candidatos"), F.col("placeholder_key"), F.col("candidate_key"))


def p2_tamanos(spark: SparkSession, d: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = p2_found(spark, d).groupBy("group_key").agg(F.count("*").alias("miembros"))
    return sizes.groupBy("miembros").agg(F.count("*").alias("grupos"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return languages(table(spark, d, "documents"), only_doubtful=True).select("doc_id", "segmento", "lang")


def p10_documentos(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its language and a confidence, beside the label as delivered."""
    return languages(table(spark, d, "documents"), per_document=True)


def p10_segmentos(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every document with its language and a confidence."""
    return languages(table(spark, d, "documents"))


def p8_contenedores(spark: SparkSession, d: str) -> DataFrame:
    """Which container of every kind each document, or piece of a too long one, is in."""
    return pack(token_counts(table(spark, d, "documents")), table(spark, d, "contenedores"))


def p8_llenado(spark: SparkSession, d: str) -> DataFrame:
    return fill_report(p8_contenedores(spark, d), table(spark, d, "contenedores"))


def p9_mezcla(spark: SparkSession, d: str) -> DataFrame:
    """The documents drawn for every mix, with how often each is used."""
    counts = cut(token_counts(table(spark, d, "documents")))
    return mix(counts, table(spark, d, "mezcla_objetivo"))


def p9_pesos(spark: SparkSession, d: str) -> DataFrame:
    """The shares wanted and reached."""
    counts = cut(token_counts(table(spark, d, "documents")))
    targets = table(spark, d, "mezcla_objetivo")
    return mix_report(mix(counts, targets), counts, targets)


def typed_places(spark: SparkSession, d: str) -> DataFrame:
    """(campo, clave, valor, provincia) of every non-blank typed place, of the newest row of each record."""
    born, died = "Lugar de nacimiento", "Lugar de asesinato"
    people = latest(table(spark, d, "detalles"), "registro", "actualizado_en", [born, died])
    sites = latest(table(spark, d, "eaaf_lugares"), "sitio_id", "cargado_en", ["LOCALIDAD", "PROVINCIA"])
    none = F.lit(None).cast("string").alias("provincia")
    out = sites.select(F.lit("eaaf_lugares.LOCALIDAD").alias("campo"), F.col("sitio_id").alias("clave"), F.col("LOCALIDAD").alias("valor"), F.col("PROVINCIA").alias("provincia"))
    for c in (born, died):
        out = out.unionByName(people.select(F.lit(f"detalles.{c}").alias("campo"), F.col("registro").alias("clave"), F.col(f"`{c}`").alias("valor"), none))
    return out.where(~blank(F.col("valor")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(typed_places(spark, d))
    return mapped(rows, table(spark, d, "georef_localidades")).select("campo", "clave", "georef_id")


def p5_cobertura(spark: SparkSession, d: str) -> DataFrame:
    """How many values of each field were found and how many not."""
    found = p5_found(spark, d)
    return found.groupBy("campo").agg(
        F.count("*").alias("valores"), F.count_if(F.col("georef_id") == NOT_FOUND).alias("no_hallados")
    )


def named_records(spark: SparkSession, d: str) -> DataFrame:
    """(clave, nombre) of relaciones, nietxs and victimas, of the newest row of each record."""
    r = latest(table(spark, d, "relaciones"), "relacion_id", "cargado_en", ["nombre_completo_relacion"])
    n = latest(table(spark, d, "nietxs"), "id_nietx", "cargado_en", ["nombre_completo"])
    v = latest(table(spark, d, "victimas"), "victima_id", "capturado_en", ["nombre"])
    out = None
    for prefix, t in (("r:", r), ("n:", n), ("v:", v)):
        key, name = t.columns
        one = t.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("clave"), F.col(name).alias("nombre"))
        out = one if out is None else out.unionByName(one)
    return out


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return linked_pairs(named_records(spark, d))


def p4_grupos(spark: SparkSession, d: str) -> DataFrame:
    """Every record with a readable name and its group: one row per record, whatever the groups' sizes."""
    return members(named_records(spark, d))


def person_records(spark: SparkSession, d: str) -> DataFrame:
    """Every victimas, detalles and nietxs record in one shape, of the newest row of each."""
    v = latest(table(spark, d, "victimas"), "victima_id", "capturado_en", ["nombre", "datos_personales"])
    own = ["nombre_completo", "descripcion_fecha_nacimiento", "descripcion_fecha_de_secuestro", "descripcion_lugar_de_secuestro", "Lugar de nacimiento", "Ocupaciones"]
    p = latest(table(spark, d, "detalles"), "registro", "actualizado_en", ["nombre", "apellido", *own])
    n = latest(table(spark, d, "nietxs"), "id_nietx", "cargado_en", ["nombre_completo", "detalle_data", "busqueda"])
    none = F.lit(None).cast("string")
    m = lambda k: F.try_element_at("datos_personales", F.lit(k))
    shape = ["clave", "tabla", "nombre", "nacimiento", "lugar", "secuestro", "lugar_secuestro", "ocupacion", "nota", "anio", "mes", "dia"]

    def row(prefix: str, key: str, *cols):
        first = [F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")), F.lit(prefix)]
        return [c.alias(name) for c, name in zip([*first, *cols], shape, strict=True)]

    typed = F.when(blank(F.col("apellido")) | blank(F.col("nombre")), F.col("nombre_completo")).otherwise(F.concat_ws(", ", "apellido", "nombre"))
    no = F.lit(None).cast("int")
    return (
        v.select(*row("v", "victima_id", F.col("nombre"), m("fecha_de_nacimiento"), F.coalesce(m("lugar_de_nacimiento"), m("nacido_en")), m("fecha_de_secuestro"), m("lugar_de_secuestro"), m("ocupación"), none, no, none, no))
        .unionByName(p.select(*row("d", "registro", typed, F.col("descripcion_fecha_nacimiento"), F.col("Lugar de nacimiento"), F.col("descripcion_fecha_de_secuestro"), F.col("descripcion_lugar_de_secuestro"), F.col("Ocupaciones"), none, no, none, no)))
        .unionByName(n.select(*row("n", "id_nietx", F.col("nombre_completo"), none, none, none, none, none, F.col("detalle_data"), F.col("busqueda")["año"], F.col("busqueda")["mes"], F.col("busqueda")["dia"])))
    )


def p6_enlaces(spark: SparkSession, d: str) -> DataFrame:
    """The linked pairs with a confidence."""
    return link(person_records(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_enlaces(spark, d).select("clave_a", "clave_b")
