"""The person and place graph from the domain tables: rows as built, and vertices and edges as merged.

Everything is lazy; a query that needs one table computes that one only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, kin
from ..functions import places as P
from ..functions.text import clean_text, name_key, scoped_key, slug
from ..operators import gazetteer
from ..operators.latest import latest
from ..operators.resolve import resolve_places
from ..operators.upsert import edge_set, linked, upsert, with_placeholders
from ..runtime import cut, lookup, table

UNKNOWN_DATE = "DESCONOCIDA"
FIELDS = (
    ("descripcion_lugar_de_secuestro", "descripcion_fecha_de_secuestro", "descripcion_lugar_de_secuestro", "SECUESTRADO_EN"),
    ("Lugar de nacimiento", "descripcion_fecha_nacimiento", "lugar_nacimiento", "NACIO_EN"),
    ("Lugar de asesinato", "descripcion_fecha_de_asesinato", "lugar_asesinato", "ASESINADO_EN"),
)


@dataclass(frozen=True)
class Options:
    """What a load does; the defaults load everything."""

    skip_places: bool = False
    skip_candidates: bool = False
    skip_report: bool = False
    apply_place_merges: bool = False
    use_gazetteer: bool = True
    min_score: float = gazetteer.MIN_SCORE
    ambiguity: float = gazetteer.AMBIGUITY
    #: kinship words with accents count as well
    normalized_kin: bool = False
    #: edges whose source is only a name keep it as a vertex; without, they are dropped
    keep_placeholders: bool = True
    extra: tuple = field(default_factory=tuple)


def gender(c: Column) -> Column:
    low = F.lower(clean_text(c))
    return F.when(low.contains("masc"), "MASCULINO").when(low.contains("fem"), "FEMENINO").otherwise("INDETERMINADO")


def people(spark: SparkSession, d: str) -> DataFrame:
    """Person rows of detalles: key, number, name, gender."""
    rows = latest(table(spark, d, "detalles"), "registro", "actualizado_en", ["nombre_completo", "Sexo", "descripcion_estado"])
    return rows.select(
        F.concat(F.lit("registro:"), F.col("registro").cast("string")).alias("persona_key"), "registro", clean_text(F.col("nombre_completo")).alias("nombre"),
        gender(F.col("Sexo")).alias("genero"), F.lit("detalles_personas").alias("fuente"), F.lit(False).alias("es_nietx"), clean_text(F.col("descripcion_estado")).alias("estado"),
    )


def grandchildren(spark: SparkSession, d: str) -> DataFrame:
    """Person rows of nietxs; adn_imputed marks the value that is only assumed."""
    rows = latest(table(spark, d, "nietxs"), "id_nietx", "cargado_en", ["nombre_completo", "restituido", "estado"])
    name = clean_text(F.col("nombre_completo"))
    dna = clean_text(F.col("restituido")["ADN"])
    number = F.col("id_nietx").cast("string")
    return rows.select(
        F.concat(F.lit("nietx:"), number).alias("persona_key"), name.alias("nombre"), F.lit("INDETERMINADO").alias("genero"), F.lit("nietxs_relacion").alias("fuente"),
        F.coalesce(name, F.concat(F.lit("Caso "), number)).alias("caso"), F.coalesce(dna, F.lit("SÍ")).alias("ADN"), dna.isNull().alias("adn_imputed"), F.lit(True).alias("es_nietx"),
        clean_text(F.col("estado")).alias("estado"), clean_text(F.col("restituido")["Restitución"]).alias("restitucion"),
    )


def persons(spark: SparkSession, d: str) -> DataFrame:
    return people(spark, d).unionByName(grandchildren(spark, d), allowMissingColumns=True)


def _kin_rows(rows: DataFrame, source: str, normalized: bool) -> DataFrame:
    """(source_key, source_nombre, target_key, target_nombre, tipo, fuente, fecha) of rows (key, name, other, other_name, word)."""
    typed = rows.withColumn("t", kin.edge_type(F.col("word"), normalized)).where("t is not null")
    turned = F.col("t")["turned"]
    pick = lambda a, b: F.when(turned, F.col(a)).otherwise(F.col(b))
    return typed.select(
        pick("other", "key").alias("source_key"), pick("other_name", "name").alias("source_nombre"), pick("key", "other").alias("target_key"), pick("name", "other_name").alias("target_nombre"),
        F.col("t")["tipo"].alias("tipo"), F.lit(source).alias("fuente"), F.lit(UNKNOWN_DATE).alias("fecha"),
    )


def _other_key(number: Column, name: Column) -> Column:
    return F.coalesce(F.concat(F.lit("registro:"), number.cast("string")), name_key(name))


def kin_of_grandchildren(spark: SparkSession, d: str, normalized: bool = False) -> DataFrame:
    rel = latest(table(spark, d, "relaciones"), "relacion_id", "cargado_en", ["id_nietx", "nombre_completo_relacion", "relacion", "id_persona"]).where("id_nietx is not null")
    own = grandchildren(spark, d).select(F.substring("persona_key", 7, 30).cast("long").alias("id_nietx"), "nombre")
    name = clean_text(F.col("nombre_completo_relacion"))
    number = F.col("id_nietx").cast("string")
    rows = lookup(rel, own, "id_nietx", how="inner", counted=table(spark, d, "relaciones")).where(name.isNotNull()).select(
        F.concat(F.lit("nietx:"), number).alias("key"), F.coalesce("nombre", F.concat(F.lit("Nietx "), number)).alias("name"), _other_key(F.col("id_persona"), name).alias("other"),
        name.alias("other_name"), clean_text(F.col("relacion")).alias("word"),
    )
    return _kin_rows(rows, "nietxs_relacion", normalized)


def kin_of_people(spark: SparkSession, d: str, normalized: bool = False) -> DataFrame:
    det = latest(table(spark, d, "detalles"), "registro", "actualizado_en", ["nombre_completo", "victimas_relacionadas_red"])
    one = det.select("registro", "nombre_completo", F.explode("victimas_relacionadas_red").alias("r"))
    name = clean_text(F.col("r")["nombre_completo"])
    number = F.col("registro").cast("string")
    rows = one.where(name.isNotNull()).select(
        F.concat(F.lit("registro:"), number).alias("key"), F.coalesce(clean_text(F.col("nombre_completo")), F.concat(F.lit("Registro "), number)).alias("name"),
        _other_key(F.col("r")["registro"], name).alias("other"), name.alias("other_name"), clean_text(F.col("r")["relacion"]).alias("word"),
    )
    return _kin_rows(rows, "detalles_personas", normalized)


def kinship(spark: SparkSession, d: str, normalized: bool = False) -> DataFrame:
    return kin_of_grandchildren(spark, d, normalized).unionByName(kin_of_people(spark, d, normalized))


def centres(spark: SparkSession, d: str) -> DataFrame:
    """Place rows of the detention centres that somebody is said to have been in."""
    cols = ["denominacion", "ubicacion", "zona", "subzona", "area", "jurisdiccion", "emplazamiento_propiedad", "lat", "lon"]
    own = latest(table(spark, d, "ccds").withColumn("id", clean_text(F.col("id_ccd"))), "id", "actualizado_en", cols)
    used = centre_references(spark, d).select("id").distinct()
    text = lambda c: clean_text(F.col(c)).alias(c)
    return own.join(used, "id").select(
        F.concat(F.lit("lugar:CCD:"), slug(F.col("id"))).alias("lugar_key"), F.upper(F.coalesce(clean_text(F.col("denominacion")), F.concat(F.lit("CCD "), "id"))).alias("nombre"),
        F.lit("CCD").alias("tipoGeopolitico"), F.lit("AR").alias("pais_code"), F.lit("ccds_json").alias("fuente"), dates.to_float(F.col("lat")).alias("lat"), dates.to_float(F.col("lon")).alias("lon"),
        F.col("id").alias("id_ccd"), text("zona"), text("subzona"), text("area"), text("jurisdiccion"), text("ubicacion"), text("emplazamiento_propiedad"),
    )


def centre_references(spark: SparkSession, d: str) -> DataFrame:
    """(registro, id, relacion, fecha list) of every centre a person's record names."""
    det = latest(table(spark, d, "detalles"), "registro", "actualizado_en", ["ccds"])
    one = det.select("registro", F.explode("ccds").alias("c"))
    return one.select("registro", clean_text(F.col("c")["id_ccd"]).alias("id"), clean_text(F.col("c")["relacion"]).alias("relacion"), F.col("c")["fecha"].alias("fechas")).where("id is not null")


def centre_events(spark: SparkSession, d: str) -> DataFrame:
    """(persona_key, lugar_key, tipo_relacion, fecha, origen): who was held or gave birth where."""
    known = table(spark, d, "ccds").select(clean_text(F.col("id_ccd")).alias("id")).where("id is not null").distinct()
    rows = lookup(centre_references(spark, d), known, "id", how="inner")
    birth = F.lower(F.trim(F.coalesce("relacion", F.lit("")))) == "pario_en"
    return rows.select(
        F.concat(F.lit("registro:"), F.col("registro").cast("string")).alias("persona_key"), F.concat(F.lit("lugar:CCD:"), slug(F.col("id"))).alias("lugar_key"),
        F.when(birth, "PARIO_EN").otherwise("PRESENTE_EN").alias("tipo_relacion"), F.coalesce(dates.earliest(F.col("fechas")), F.lit(UNKNOWN_DATE)).alias("fecha"), F.lit("ccds_json").alias("origen"),
    )


def centre_addresses(spark: SparkSession, d: str) -> DataFrame:
    c = centres(spark, d)
    return c.select(
        F.concat(F.lit("direccion_ccd:ccd:"), "id_ccd").alias("direccion_ccd_key"), dates.coordinates(F.col("lat"), F.col("lon")).alias("coordenadas"),
        F.coalesce("ubicacion", "nombre").alias("direccionExacta"), "lugar_key",
    )


def typed_places(spark: SparkSession, d: str) -> DataFrame:
    """(registro, campo, tipo_relacion, raw, fecha): the three typed places of every person in long form, in one pass."""
    det = latest(table(spark, d, "detalles"), "registro", "actualizado_en", [c for f in FIELDS for c in f[:2]])
    parts = F.array(
        *[
            F.struct(F.lit(label).alias("campo"), F.lit(kind).alias("tipo_relacion"), F.col(f"`{place}`").alias("raw"), dates.iso_from_dmy(clean_text(F.col(f"`{when}`"))).alias("fecha"))
            for place, when, label, kind in FIELDS
        ]
    )
    return det.select("registro", F.explode(parts).alias("p")).select("registro", "p.*").where("raw is not null")


@dataclass(frozen=True)
class PlaceLayer:
    places: DataFrame
    parents: DataFrame
    aliases: DataFrame
    addresses: DataFrame
    events: DataFrame
    own: DataFrame


def stub(key: Column) -> Column:
    """STRUCT<nombre, tipoGeopolitico, pais_code> of an ancestor that only its key tells of."""
    core = F.split(key, r"\|")[0]
    parts = F.split(core, ":", 3)
    whole = F.size(parts) == 3
    kind = F.when(whole, F.upper(F.get(parts, 1))).otherwise("INDETERMINADO")
    name = F.when(whole, F.upper(F.replace(F.get(parts, 2), F.lit("_"), F.lit(" ")))).otherwise(F.upper(core))
    code = F.when((kind == "PAIS") & (name != "ARGENTINA"), "XX").otherwise("AR")
    return F.struct(name.alias("nombre"), kind.alias("tipoGeopolitico"), code.alias("pais_code"))


def chain_edges(chain: Column) -> Column:
    """The neighbouring pairs of a chain of keys, child first."""
    n = F.size(chain) - 1
    return F.arrays_zip(F.slice(chain, F.lit(1), n).alias("child_key"), F.slice(chain, F.lit(2), n).alias("parent_key"))


def place_layer(spark: SparkSession, d: str, options: Options | None = None) -> PlaceLayer:
    options = options or Options()
    gaz = cut(gazetteer.from_table(table(spark, d, "georef_localidades"))) if options.use_gazetteer else None
    typed = cut(typed_places(spark, d))
    placed = cut(resolve_places(typed.select("raw"), gaz, options.min_score, options.ambiguity))
    rows = cut(lookup(typed, placed, "raw", how="inner", rows=typed.count()))
    chain = F.coalesce(F.when(F.size("hierarchy_keys") > 1, F.col("hierarchy_keys")), F.when(F.col("parent_key").isNotNull(), F.array_distinct(F.array("lugar_key", "parent_key", F.lit(P.COUNTRY)))))
    chains = placed.select("lugar_key", chain.alias("chain"))
    parents = chains.where("size(chain) > 1").select(F.explode(chain_edges(F.col("chain"))).alias("e")).select("e.child_key", "e.parent_key").distinct()
    own = placed.groupBy("lugar_key").agg(F.min("nombre").alias("nombre"), F.min("tipo").alias("tipoGeopolitico"), F.coalesce(F.max("pais_code"), F.lit("AR")).alias("pais_code"))
    above = chains.select(F.explode("chain").alias("lugar_key")).union(spark.range(1).select(F.lit(P.COUNTRY))).distinct().join(own.select("lugar_key"), "lugar_key", "left_anti")
    places = own.unionByName(above.select("lugar_key", stub(F.col("lugar_key")).alias("s")).select("lugar_key", "s.*")).withColumn("fuente", F.lit("normalizacion_lugar"))
    number = F.col("registro").cast("string")
    aliases = rows.select(
        F.concat_ws(":", F.lit("alias"), "campo", number, slug(F.col("alias_norm"))).alias("alias_key"), "alias_norm", "alias_raw", F.lit("detalles_personas").alias("fuente"), F.col("campo").alias("campo_fuente"),
        "tipo", F.coalesce("parent_key", F.lit("__ROOT__")).alias("parent_key"), "lugar_key", "registro",
    )
    a = P.street_address(F.col("alias_raw"))
    found = rows.select("lugar_key", a.alias("a")).where("a is not null")
    addresses = found.groupBy(F.concat(F.lit("direccion_ccd:"), scoped_key(F.col("a.direccion_norm"), F.col("lugar_key"))).alias("direccion_ccd_key")).agg(
        F.lit("DESCONOCIDAS").alias("coordenadas"), F.min("a.direccion_raw").alias("direccionExacta"), F.min("a.direccion_norm").alias("direccion_norm"),
        F.min("lugar_key").alias("lugar_key"), F.min("a.confianza").alias("confianza_parseo"),
    )
    events = rows.select(
        F.concat(F.lit("registro:"), number).alias("persona_key"), "lugar_key", "tipo_relacion", F.coalesce("fecha", F.lit(UNKNOWN_DATE)).alias("fecha"), F.lit("detalles_personas").alias("origen")
    )
    return PlaceLayer(places, parents, aliases, addresses, events, own)


@dataclass(frozen=True)
class World:
    """Events, places and addresses of both sources: the places people typed, and the centres their records name."""

    events: DataFrame
    places: DataFrame
    addresses: DataFrame
    aliases: DataFrame


def world(spark: SparkSession, d: str, options: Options | None = None) -> World:
    layer = place_layer(spark, d, options)
    return World(
        layer.events.unionByName(centre_events(spark, d)), layer.places.unionByName(centres(spark, d), allowMissingColumns=True),
        layer.addresses.unionByName(centre_addresses(spark, d), allowMissingColumns=True), layer.aliases,
    )


def anchors(spark: SparkSession, d: str, places: DataFrame, options: Options | None = None) -> DataFrame:
    """(child_key, parent_key) of centres: the place their address resolves to, else their name's, if the graph has it.

    A resolved place counts unless it is INDETERMINADO; otherwise its parent, if that is in the graph.
    """
    options = options or Options()
    c = cut(centres(spark, d))
    gaz = cut(gazetteer.from_table(table(spark, d, "georef_localidades"))) if options.use_gazetteer else None
    texts = c.select("lugar_key", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("ubicacion").alias("raw")), F.struct(F.lit(1).alias("k"), F.col("nombre").alias("raw")))).alias("t")).select("lugar_key", "t.*").where("raw is not null")
    placed = resolve_places(texts.select("raw"), gaz, options.min_score, options.ambiguity).select("raw", F.col("lugar_key").alias("own"), "tipo", "parent_key")
    rows = lookup(texts, placed, "raw", how="inner")
    choice = rows.select("lugar_key", F.explode(F.array(F.struct((F.col("k") * 2).alias("k"), F.when(F.col("tipo") != "INDETERMINADO", F.col("own")).alias("to")), F.struct((F.col("k") * 2 + 1).alias("k"), F.col("parent_key").alias("to")))).alias("x")).select("lugar_key", "x.*").where("to is not null")
    real = choice.join(places.select(F.col("lugar_key").alias("to")).distinct(), "to", "left_semi")
    return real.groupBy("lugar_key").agg(F.min_by("to", "k").alias("parent_key")).select(F.col("lugar_key").alias("child_key"), "parent_key").where("child_key <> parent_key")


def vertices(spark: SparkSession, d: str, options: Options | None = None) -> DataFrame:
    """Persons and, for each edge end known by name only, a placeholder."""
    options = options or Options()
    base, edges = persons(spark, d), kinship(spark, d, options.normalized_kin)
    if not options.keep_placeholders:
        edges = linked(edges, base, "persona_key", "source_key").select("source_key", "source_nombre", "target_key", "target_nombre")
    return with_placeholders(base, "persona_key", edges, [("source_key", "source_nombre"), ("target_key", "target_nombre")])


__all__ = ["Options", "edge_set", "upsert"]
