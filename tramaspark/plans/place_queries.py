"""Named queries of place resolution and of the layer of places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import places as P
from ..functions.text import place_text
from ..operators import gazetteer
from ..operators.resolve import resolve_places
from ..runtime import cut, table
from . import graph as G

Query = Callable[[SparkSession, str], DataFrame]


def texts(s: SparkSession, d: str) -> DataFrame:
    """(texto) the normal form of every distinct typed place."""
    return G.typed_places(s, d).select(place_text(F.col("raw")).alias("texto")).where("texto <> ''").distinct()


def scalar(make: Callable[[Column], Column]) -> Query:
    return lambda s, d: texts(s, d).select("texto", make(F.col("texto")).alias("valor"))


def abroad(s: SparkSession, d: str) -> DataFrame:
    return texts(s, d).select("texto", P.abroad(F.col("texto")).alias("x")).select("texto", "x.city", "x.country", "x.code")


def exact_aliases(s: SparkSession, d: str) -> DataFrame:
    return texts(s, d).select("texto", P.exact_alias(F.col("texto")).alias("x")).select("texto", "x.city", "x.province")


def addresses(s: SparkSession, d: str) -> DataFrame:
    """The street address in every distinct typed place that has one."""
    found = G.typed_places(s, d).select("raw").distinct().select("raw", P.street_address(F.col("raw")).alias("x"))
    return found.where("x is not null").select("raw", "x.direccion_raw", "x.direccion_norm", "x.via", "x.numero", "x.confianza")


def resolved(s: SparkSession, d: str) -> DataFrame:
    gaz = cut(gazetteer.from_table(table(s, d, "georef_localidades")))
    return resolve_places(G.typed_places(s, d).select("raw"), gaz).select("raw", "alias_norm", "tipo", "nombre", "lugar_key", "parent_key", "pais_code")


def resolved_plain(s: SparkSession, d: str) -> DataFrame:
    return resolve_places(G.typed_places(s, d).select("raw"), None).select("raw", "alias_norm", "tipo", "nombre", "lugar_key", "parent_key", "pais_code")


def by_gazetteer(s: SparkSession, d: str) -> DataFrame:
    """What the gazetteer alone makes of the normal forms: key and the keys above it."""
    from ..operators.resolve import from_gazetteer

    hits = from_gazetteer(texts(s, d).select(F.col("texto").alias("alias")), cut(gazetteer.from_table(table(s, d, "georef_localidades"))))
    p = F.col("place")
    return hits.select("alias", p["tipo"].alias("tipo"), p["nombre"].alias("nombre"), p["parent_key"].alias("parent_key"), F.array_join(p["hierarchy_keys"], ";").alias("cadena"))


def stubs(s: SparkSession, d: str) -> DataFrame:
    """The places that only keys below them tell of."""
    p = G.place_layer(s, d)
    above = p.parents.select(F.explode(F.array("child_key", "parent_key")).alias("lugar_key")).distinct().where(F.col("lugar_key") != "")
    return above.join(p.own.select("lugar_key"), "lugar_key", "left_anti").select("lugar_key", G.stub(F.col("lugar_key")).alias("x")).select("lugar_key", "x.nombre", "x.tipoGeopolitico")


def key_parts(s: SparkSession, d: str) -> DataFrame:
    """What the keys of the hierarchy table, malformed ones included, tell of their places."""
    j = table(s, d, "jerarquias")
    keys = j.select(F.explode(F.array("child_key", "parent_key", "lugar_key", "direccion_ccd_key")).alias("clave")).where("clave <> ''").distinct()
    return keys.select("clave", G.stub(F.col("clave")).alias("x")).select("clave", "x.*")


def resolved_addresses(s: SparkSession, d: str) -> DataFrame:
    return G.place_layer(s, d).addresses.select("direccion_ccd_key", "direccion_norm", "lugar_key", "confianza_parseo")


def cities(s: SparkSession, d: str) -> DataFrame:
    """Pairs of typed cities of one scope, each pair once, that are compared for merging: they differ in one word."""
    from ..operators.place_merge import slip_candidates

    return slip_candidates(scoped(s, d))


def scoped(s: SparkSession, d: str) -> DataFrame:
    from .reference import scoped_places

    return scoped_places(s, d)


QUERIES: dict[str, Query] = {
    "ref_g1_identity": scalar(P.identity),
    "ref_g2_addresses": addresses,
    "ref_g3_place_key": scalar(lambda c: P.place_key("CIUDAD", c, P.place_key("PROVINCIA", F.lit("BUENOS AIRES"), F.lit(P.COUNTRY)))),
    "ref_g5_by_gazetteer": by_gazetteer,
    "ref_g6_caba_named": scalar(P.caba_named),
    "ref_g7_caba_hinted": scalar(P.caba_hinted),
    "ref_g8_without_caba": scalar(P.without_caba),
    "ref_g10_abroad": abroad,
    "ref_g11_says_province": scalar(P.says_province),
    "ref_g12_only_address": scalar(P.only_address),
    "ref_g13_default_province": scalar(P.may_be_buenos_aires),
    "ref_g14_province_said": scalar(P.province_said),
    "ref_g15_without_province": scalar(P.without_province),
    "ref_g18_institution_town": scalar(P.institution_town),
    "ref_g19_repeated_tail": scalar(P.repeated_tail),
    "ref_g20_resolve": resolved,
    "ref_g20_resolve_plain": resolved_plain,
    "ref_g21_exact_aliases": exact_aliases,
    "ref_p6_lugares": lambda s, d: G.place_layer(s, d).places.select("lugar_key", "nombre", "tipoGeopolitico", "pais_code"),
    "ref_p6_jerarquias": lambda s, d: G.place_layer(s, d).parents,
    "ref_p6_alias": lambda s, d: G.place_layer(s, d).aliases.select("alias_key", "alias_norm", "alias_raw", "tipo", "parent_key", "lugar_key", "registro"),
    "ref_p6_direcciones": resolved_addresses,
    "ref_p6_eventos": lambda s, d: G.place_layer(s, d).events,
    "ref_p7_stubs": stubs,
    "ref_p8_key_parts": key_parts,
    "ref_j13_scope_pairs": cities,
}
