"""Named queries over the domain tables: functions, builders, merges, joins, analyses and checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, kin, text
from ..functions.similarity import name_similarity, place_ratio
from ..operators import gazetteer
from ..operators.latest import latest
from ..operators.place_merge import merges, slip_pairs
from ..operators.reconcile import candidates_of, exact_candidates, fuzzy_candidates, placeholders
from ..operators.upsert import edge_set, linked, redirect, upsert, violations, with_placeholders
from ..runtime import cut, table
from . import analytics as A
from . import graph as G
from . import validation as V

Query = Callable[[SparkSession, str], DataFrame]


def _people(s: SparkSession, d: str) -> DataFrame:
    return latest(table(s, d, "detalles"), "registro", "actualizado_en", [c for c in table(s, d, "detalles").columns if c not in ("registro", "actualizado_en")])


def _function(column: str, make) -> Query:
    """A function of one text column of detalles, by record."""
    return lambda s, d: latest(table(s, d, "detalles"), "registro", "actualizado_en", [column]).select("registro", make(F.col(f"`{column}`")).alias("valor"))


def _dates(s: SparkSession, d: str) -> DataFrame:
    one = latest(table(s, d, "detalles"), "registro", "actualizado_en", ["ccds"]).select("registro", F.posexplode("ccds").alias("pos", "c"))
    return one.select("registro", "pos", F.posexplode("c.fecha").alias("k", "fecha")).where("fecha is not null")


def partial_dates(s: SparkSession, d: str) -> DataFrame:
    return _dates(s, d).withColumn("p", dates.partial(F.col("fecha"))).select("registro", "pos", "k", F.col("p.start").alias("desde"), F.col("p.end").alias("hasta"), F.col("p.grain").alias("grano"))


def earliest_dates(s: SparkSession, d: str) -> DataFrame:
    one = latest(table(s, d, "detalles"), "registro", "actualizado_en", ["ccds"]).select("registro", F.posexplode("ccds").alias("pos", "c"))
    return one.select("registro", "pos", dates.earliest(F.col("c.fecha")).alias("fecha"))


def long_dates(s: SparkSession, d: str) -> DataFrame:
    """Dates of birth of victimas written as "5 de mayo de 1976", read with the comma the long form has."""
    v = latest(table(s, d, "victimas"), "victima_id", "capturado_en", ["datos_personales"])
    raw = F.regexp_replace(F.try_element_at("datos_personales", F.lit("fecha_de_nacimiento")), r"^(\d{1,2} de \w+) de (\d{4})$", "$1, $2")
    return v.select("victima_id", dates.iso_from_long(raw).alias("valor"))


def pregnancies(s: SparkSession, d: str) -> DataFrame:
    return _people(s, d).withColumn("p", dates.pregnancy(F.col("Edad"))).select("registro", F.col("p.tipo").alias("tipo"), F.col("p.meses").alias("meses"))


def centre_coordinates(s: SparkSession, d: str) -> DataFrame:
    c = latest(table(s, d, "ccds"), "id_ccd", "actualizado_en", ["lat", "lon"])
    return c.select("id_ccd", dates.coordinates(F.col("lat"), F.col("lon")).alias("coordenadas"), (dates.coordinates(F.col("lat"), F.col("lon")) != "DESCONOCIDAS").alias("conocidas"), dates.to_float(F.col("lat")).alias("lat"))


def relation_kinds(s: SparkSession, d: str) -> DataFrame:
    r = latest(table(s, d, "relaciones"), "relacion_id", "cargado_en", ["relacion"])
    return r.select("relacion_id", kin.relation_kind(F.col("relacion")).alias("tipo"))


def crimes(s: SparkSession, d: str) -> DataFrame:
    """Crime lists typed as text, split at commas."""
    v = table(s, d, "imputados").where("mas_informacion is not null").groupBy("mas_informacion").agg(F.count("*").alias("n"))
    return v.select("mas_informacion", "n", F.array_join(text.split_list(F.col("mas_informacion"), keep_blank=False), "|").alias("partes"))


def labels(s: SparkSession, d: str) -> DataFrame:
    """Labels of the personal data as keys."""
    v = latest(table(s, d, "victimas"), "victima_id", "capturado_en", ["datos_personales"])
    return v.select(F.explode(F.map_keys("datos_personales")).alias("etiqueta")).groupBy(text.label_key(F.col("etiqueta")).alias("clave")).agg(F.count("*").alias("n"))


def upsert_people(s: SparkSession, d: str) -> DataFrame:
    """Every delivery of detalles merged: name and gender of the last, the nickname last known."""
    rows = table(s, d, "detalles").select(
        F.concat(F.lit("registro:"), F.col("registro").cast("string")).alias("persona_key"), text.clean_text(F.col("nombre_completo")).alias("nombre"), G.gender(F.col("Sexo")).alias("genero"),
        text.clean_text(F.col("descripcion_apodos")).alias("apodo"), F.col("actualizado_en").alias("seq"),
    )
    return upsert(rows, ["persona_key"], F.col("seq"), last=["nombre", "genero"], known=["apodo"])


def upsert_grandchildren(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "nietxs").select(F.concat(F.lit("nietx:"), F.col("id_nietx").cast("string")).alias("persona_key"), text.clean_text(F.col("nombre_completo")).alias("nombre"), text.clean_text(F.col("restituido")["ADN"]).alias("ADN"), "cargado_en")
    return upsert(rows, ["persona_key"], F.col("cargado_en"), last=["nombre"], known=["ADN"]).withColumn("roles", F.array_join(F.array_sort(F.array_union(F.array(F.lit("Persona")), F.array(F.lit("Nietx")))), ","))


def upsert_places(s: SparkSession, d: str) -> DataFrame:
    """Every delivery of ccds merged: name of the last; zone and coordinates last known, and whether these make a point."""
    rows = table(s, d, "ccds").select(
        F.concat(F.lit("lugar:CCD:"), text.slug(F.col("id_ccd"))).alias("lugar_key"), text.clean_text(F.col("denominacion")).alias("nombre"), text.clean_text(F.col("zona")).alias("zona"), "lat", "lon", "actualizado_en"
    )
    out = upsert(rows, ["lugar_key"], F.col("actualizado_en"), last=["nombre"], known=["zona", "lat", "lon"])
    return out.withColumn("con_punto", F.col("lat").isNotNull() & F.col("lon").isNotNull())


def family_edges(s: SparkSession, d: str) -> DataFrame:
    return G.kin_of_grandchildren(s, d)


def family_vertices(s: SparkSession, d: str) -> DataFrame:
    """Persons and placeholders after the family edges are linked."""
    return with_placeholders(G.persons(s, d), "persona_key", G.kinship(s, d), [("source_key", "source_nombre"), ("target_key", "target_nombre")]).select("persona_key", (F.col("persona_key").startswith("nombre:")).alias("es_placeholder"))


def strict_edges(s: SparkSession, d: str) -> DataFrame:
    """Family edges whose source is a person on record, with how often each is told."""
    return linked(G.kinship(s, d), G.persons(s, d), "persona_key", "source_key").groupBy("source_key", "target_key", "fuente", "tipo").agg(F.count("*").alias("n"))


def linked_events(s: SparkSession, d: str) -> DataFrame:
    """Events of both sources whose person and place are in the graph, with how often each is told."""
    w = G.world(s, d)
    e = linked(linked(w.events, G.people(s, d), "persona_key", "persona_key"), w.places, "lugar_key", "lugar_key")
    return e.groupBy("persona_key", "lugar_key", "tipo_relacion", "fecha", "origen").agg(F.count("*").alias("n"))


def _in_world(make: Callable[[G.World, SparkSession, str], DataFrame]) -> Query:
    """A query over the events, places and addresses of both sources."""
    return lambda s, d: make(G.world(s, d), s, d)


def parent_links(s: SparkSession, d: str) -> DataFrame:
    j = table(s, d, "jerarquias").where("tipo_relacion = 'PARTE_DE' and child_key <> '' and parent_key <> ''")
    nodes = j.select(F.explode(F.array("child_key", "parent_key")).alias("lugar_key"))
    both = edge_set(linked(linked(j, nodes, "lugar_key", "child_key"), nodes, "lugar_key", "parent_key"), ["child_key", "parent_key"])
    return both.withColumn("fecha", F.lit("ETERNA"))


def alias_merge(s: SparkSession, d: str) -> DataFrame:
    """Aliases merged by normal form and scope: the first key, and the place they stood for last."""
    e = table(s, d, "eaaf_lugares")
    norm = text.place_text(F.col("LOCALIDAD"))
    rows = e.select(norm.alias("alias_norm"), F.coalesce(text.geo_name(F.col("PROVINCIA")), F.lit("__ROOT__")).alias("parent_key"), F.col("sitio_id").alias("alias_key"), F.col("sitio_id").alias("lugar_key"), F.struct("cargado_en", "sitio_id").alias("seq"))
    return upsert(rows.where("alias_norm <> ''"), ["alias_norm", "parent_key"], F.col("seq"), last=["lugar_key"], first=["alias_key"])


def address_links(s: SparkSession, d: str) -> DataFrame:
    """The distinct addresses and places of the hierarchy table."""
    j = table(s, d, "jerarquias").where("tipo_relacion = 'UBICADA_EN' and direccion_ccd_key <> '' and lugar_key <> ''")
    return j.select("direccion_ccd_key", "lugar_key").distinct()


def upsert_addresses(s: SparkSession, d: str) -> DataFrame:
    j = table(s, d, "jerarquias").where("tipo_relacion = 'UBICADA_EN'")
    return upsert(j.withColumn("seq", F.struct("cargado_en", "fila_id")), ["direccion_ccd_key"], F.col("seq"), last=["lugar_key"])


def candidate_merge(s: SparkSession, d: str) -> DataFrame:
    """Candidates merged by pair and method; both ends must be named."""
    c = table(s, d, "candidatos").where("placeholder_key <> '' and candidate_key <> ''").withColumn("seq", F.struct("creado_en", "score", "confianza"))
    return upsert(c, ["placeholder_key", "candidate_key", "metodo"], F.col("seq"), last=["score", "confianza"])


def redirected(s: SparkSession, d: str) -> DataFrame:
    """The hierarchy after its typed duplicates (same name, other number) are merged into the smallest key."""
    edges = cut(parent_links(s, d).select("child_key", "parent_key"))
    keys = edges.select(F.explode(F.array("child_key", "parent_key")).alias("key")).distinct()
    name = F.regexp_replace("key", r"_\d+$", "")
    target = keys.groupBy(name.alias("name")).agg(F.min("key").alias("target_key"))
    merge = keys.withColumn("name", name).join(target, "name").where("key <> target_key").select(F.col("key").alias("source_key"), "target_key")
    return redirect(edges, merge, ["child_key", "parent_key"])


def exact_matches(s: SparkSession, d: str) -> DataFrame:
    return exact_candidates(G.kinship(s, d), G.people(s, d))


def fuzzy_matches(s: SparkSession, d: str) -> DataFrame:
    return fuzzy_candidates(G.kinship(s, d), G.people(s, d))


def quality_with_fuzzy(s: SparkSession, d: str) -> DataFrame:
    """A8 over exact and fuzzy candidates; its namesake of the exact ones alone is what its SQL statement counts."""
    held = cut(placeholders(G.kinship(s, d)))
    return A.placeholder_quality(held, candidates_of(held, G.people(s, d))).withColumn("score_promedio", F.round("score_promedio", 9))


def gazetteer_rows(s: SparkSession, d: str) -> DataFrame:
    return gazetteer.from_table(table(s, d, "georef_localidades")).select("name", "level", "province", "department")


def _localities(s: SparkSession, d: str) -> DataFrame:
    e = latest(table(s, d, "eaaf_lugares"), "sitio_id", "cargado_en", ["LOCALIDAD", "PROVINCIA"])
    return e.select("sitio_id", text.place_text(F.concat_ws(" ", "LOCALIDAD", "PROVINCIA")).alias("alias")).where("alias <> ''")


def gazetteer_hits(s: SparkSession, d: str) -> DataFrame:
    """All gazetteer entries that the typed localities name, by level."""
    m = gazetteer.matches(_localities(s, d).select("alias"), gazetteer.from_table(table(s, d, "georef_localidades")))
    return m.select("alias", "name", "level", "province", "department")


def gazetteer_best(s: SparkSession, d: str) -> DataFrame:
    best = gazetteer.resolve_names(_localities(s, d).select("alias"), cut(gazetteer.from_table(table(s, d, "georef_localidades"))))
    return best.select("alias", "name", "level", "province", "department", F.bround("score", 6).alias("score"))


def provinces_said(s: SparkSession, d: str) -> DataFrame:
    return gazetteer.provinces_said(_localities(s, d).select("alias").distinct(), gazetteer.from_table(table(s, d, "georef_localidades")))


def contexts(s: SparkSession, d: str) -> DataFrame:
    e = latest(table(s, d, "eaaf_lugares"), "sitio_id", "cargado_en", ["PROVINCIA"]).select(text.geo_name(F.col("PROVINCIA")).alias("context")).where("context <> ''").distinct()
    return gazetteer.resolve_context(e.withColumn("preferred", F.lit("BUENOS AIRES")), gazetteer.from_table(table(s, d, "georef_localidades")))


def anchored(s: SparkSession, d: str) -> DataFrame:
    return G.anchors(s, d, G.place_layer(s, d).places)


def scoped_places(s: SparkSession, d: str) -> DataFrame:
    e = latest(table(s, d, "eaaf_lugares"), "sitio_id", "cargado_en", ["LOCALIDAD", "PROVINCIA"])
    rows = e.select(text.place_text(F.col("LOCALIDAD")).alias("nombre"), text.geo_name(F.col("PROVINCIA")).alias("scope")).where("nombre <> '' and scope is not null")
    counted = rows.groupBy("nombre", "scope").agg(F.count("*").alias("n"))
    return counted.withColumn("lugar_key", F.concat_ws("|", F.concat(F.lit("lugar:CIUDAD:"), text.slug(F.col("nombre"))), "scope"))


def place_slips(s: SparkSession, d: str) -> DataFrame:
    return slip_pairs(scoped_places(s, d)).select("a", "b", F.bround("score", 6).alias("score"), "reason")


def place_merges(s: SparkSession, d: str) -> DataFrame:
    p = cut(scoped_places(s, d))
    return merges(p, p.select("lugar_key", "n"))


def name_scores(s: SparkSession, d: str) -> DataFrame:
    det = latest(table(s, d, "detalles"), "registro", "actualizado_en", ["nombre", "apellido", "nombre_completo"])
    return det.select("registro", name_similarity(F.concat_ws(" ", "nombre", "apellido"), F.coalesce("nombre_completo", F.lit(""))).alias("similitud"))


def name_ratios(s: SparkSession, d: str) -> DataFrame:
    det = latest(table(s, d, "detalles"), "registro", "actualizado_en", ["nombre", "apellido", "nombre_completo"])
    return det.select("registro", place_ratio(F.concat_ws(" ", "nombre", "apellido"), F.coalesce("nombre_completo", F.lit(""))).alias("razon"))


def _related(s: SparkSession, d: str) -> DataFrame:
    det = latest(table(s, d, "detalles"), "registro", "actualizado_en", ["victimas_relacionadas_red"])
    key = lambda c: F.concat(F.lit("registro:"), c.cast("string"))
    return det.select(key(F.col("registro")).alias("source"), F.explode("victimas_relacionadas_red").alias("r")).where("r.registro is not null").select("source", key(F.col("r.registro")).alias("target"))


def chain_edges(s: SparkSession, d: str) -> DataFrame:
    """Neighbouring pairs of the chains locality, department, province."""
    g = table(s, d, "georef_localidades")
    chain = F.array("georef_id", "departamento", "provincia")
    return g.select(F.explode(G.chain_edges(chain)).alias("e")).select("e.child_key", "e.parent_key").distinct()


def chain_shortcut(s: SparkSession, d: str) -> DataFrame:
    """Locality to province, and province to the country."""
    g = table(s, d, "georef_localidades")
    return g.select(F.col("georef_id").alias("child_key"), F.col("provincia").alias("parent_key")).union(g.select("provincia", F.lit("PAIS"))).distinct()


def tree_rollup(s: SparkSession, d: str) -> DataFrame:
    """Sites of eaaf by each level of their path."""
    e = latest(table(s, d, "eaaf_lugares"), "sitio_id", "cargado_en", ["LOCALIDAD", "PROVINCIA"]).where("LOCALIDAD is not null and PROVINCIA is not null")
    key = F.concat_ws("|", F.concat(F.lit("lugar:CIUDAD:"), text.slug(F.col("LOCALIDAD"))), F.concat(F.lit("lugar:PROVINCIA:"), text.slug(F.col("PROVINCIA"))), F.lit("lugar:PAIS"))
    return A.rollup(e.select(key.alias("lugar_key")))


def constraint_report(s: SparkSession, d: str) -> DataFrame:
    det = table(s, d, "detalles")
    return violations(det, "detalles", ["registro"], ["registro", "nombre", "Nacionalidad"])


def report(w: G.World, s: SparkSession, d: str) -> DataFrame:
    return V.report(G.persons(s, d), G.kinship(s, d), w.events, w.places, w.addresses, w.aliases, _pairs(s, d))


def domain_report(s: SparkSession, d: str) -> DataFrame:
    """Values outside their domain, in the tables that have one."""
    j = violations(table(s, d, "jerarquias"), "jerarquias", [], ["fila_id"], {"tipo_relacion": ["PARTE_DE", "UBICADA_EN"]})
    c = violations(table(s, d, "candidatos"), "candidatos", [], ["placeholder_key", "candidate_key"], {"confianza": ["alta", "media"]})
    return j.unionByName(c).unionByName(violations(table(s, d, "ccds"), "ccds", ["id_ccd"], ["id_ccd", "denominacion"]))


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "candidatos").where("placeholder_key <> '' and candidate_key <> ''")


NAME, PLACE = "nombre_completo", "Lugar de nacimiento"
QUERIES: dict[str, Query] = {
    "ref_f1_norm_space": _function(NAME, text.norm_space),
    "ref_f2_strip_accents": _function(NAME, text.strip_accents),
    "ref_f3_slug": _function(NAME, text.slug),
    "ref_f4_clean_text": _function("Sexo", text.clean_text),
    "ref_f5_name_key": _function(NAME, text.name_key),
    "ref_f6_iso_from_dmy": _function("descripcion_fecha_nacimiento", dates.iso_from_dmy),
    "ref_f7_long_date": long_dates,
    "ref_f8_partial_date": partial_dates,
    "ref_f9_earliest_date": earliest_dates,
    "ref_f10_to_float": _function("Edad", dates.to_float),
    "ref_f11_first_int": _function(PLACE, dates.first_int),
    "ref_f12_pregnancy": pregnancies,
    "ref_f13_relation_kind": relation_kinds,
    "ref_f14_geo_name": _function(PLACE, text.geo_name),
    "ref_f15_place_text": _function(PLACE, text.place_text),
    "ref_f16_coordinates": centre_coordinates,
    "ref_f17_scoped_key": _function(NAME, lambda c: text.scoped_key(c, F.lit("x"))),
    "ref_j14_name_tokens": _function(NAME, lambda c: F.array_join(text.name_tokens(c), " ")),
    "ref_h7_label_key": labels,
    "ref_h8_split_list": crimes,
    "ref_h9_plain_blanks": _function(NAME, text.plain_blanks),
    "ref_s4_gazetteer": gazetteer_rows,
    "ref_p1_personas": lambda s, d: G.people(s, d).select("persona_key", "registro", "nombre", "genero", "fuente"),
    "ref_p2_protagonistas": lambda s, d: G.grandchildren(s, d).select("persona_key", "nombre", "caso", "ADN", "adn_imputed"),
    "ref_p3_kin_nietxs": family_edges,
    "ref_p4_kin_detalles": lambda s, d: G.kin_of_people(s, d),
    "ref_p9_typed_places": lambda s, d: G.typed_places(s, d),
    "ref_p10_centros": lambda s, d: G.centres(s, d).select("lugar_key", "nombre", "id_ccd", "zona", "jurisdiccion", "lat", "lon"),
    "ref_p10_eventos": lambda s, d: G.centre_events(s, d),
    "ref_p11_anclas": anchored,
    "ref_k1_upsert_personas": upsert_people,
    "ref_k2_upsert_protagonistas": upsert_grandchildren,
    "ref_k3_vertices": family_vertices,
    "ref_k4_strict_edges": strict_edges,
    "ref_k5_eventos": linked_events,
    "ref_k6_upsert_lugares": upsert_places,
    "ref_k7_parte_de": parent_links,
    "ref_k8_alias": alias_merge,
    "ref_k9_direcciones": upsert_addresses,
    "ref_k10_ubicada_en": address_links,
    "ref_k11_candidatos": candidate_merge,
    "ref_k12_redirect": redirected,
    "ref_k14_constraints": constraint_report,
    "ref_k14_domains": domain_report,
    "ref_j1_gazetteer_hits": gazetteer_hits,
    "ref_j2_provinces_said": provinces_said,
    "ref_j3_gazetteer_best": gazetteer_best,
    "ref_j6_context": contexts,
    "ref_j10_exact_candidates": exact_matches,
    "ref_j11_fuzzy_candidates": fuzzy_matches,
    "ref_j12_placeholders": lambda s, d: placeholders(G.kinship(s, d)),
    "ref_j18_name_similarity": name_scores,
    "ref_j19_ratio": name_ratios,
    "ref_j20_place_slips": place_slips,
    "ref_j21_place_merges": place_merges,
    "ref_t1_chain_edges": chain_edges,
    "ref_t2_shortcut": chain_shortcut,
    "ref_t3_rollup": tree_rollup,
    "ref_a1_hotspots": _in_world(lambda w, s, d: A.hotspots(w.events, w.places)),
    "ref_a2_hotspots_by_type": _in_world(lambda w, s, d: A.hotspots_by_type(w.events, w.places)),
    "ref_a3_by_year": _in_world(lambda w, s, d: A.by_year(w.events)),
    "ref_a4_by_jurisdiction": _in_world(lambda w, s, d: A.by_year_and_jurisdiction(w.events, w.places)),
    "ref_a5_busiest_people": _in_world(lambda w, s, d: A.busiest_people(w.events, G.people(s, d))),
    "ref_a6_multi_site": _in_world(lambda w, s, d: A.multi_site(w.events, w.places, G.people(s, d)).withColumn("muestra_lugares", F.array_join("muestra_lugares", ";"))),
    "ref_a7_network": lambda s, d: A.related_network(_related(s, d), G.people(s, d)),
    "ref_a8_placeholder_quality": lambda s, d: A.placeholder_quality(placeholders(G.kinship(s, d)), exact_matches(s, d)).withColumn("score_promedio", F.round("score_promedio", 9)),
    "ref_a8_quality_with_fuzzy": quality_with_fuzzy,
    "ref_a9_ambiguous": lambda s, d: A.ambiguous_placeholders(_pairs(s, d)).withColumn("muestra_candidatos", F.array_join("muestra_candidatos", ";")),
    "ref_a10_address_coverage": _in_world(lambda w, s, d: A.address_coverage(w.events, w.addresses)),
    "ref_a11_addresses": _in_world(lambda w, s, d: A.top_addresses(w.events, w.addresses, w.places)),
    "ref_a12_anchor_coverage": lambda s, d: A.anchor_coverage(table(s, d, "jerarquias").where("tipo_relacion = 'PARTE_DE' and child_key <> ''").select(F.col("child_key").alias("lugar_key")).distinct(), parent_links(s, d)),
    "ref_a13_centres": lambda s, d: A.busiest_centres(G.centre_events(s, d), G.centres(s, d)),
    "ref_a14_density": _in_world(lambda w, s, d: A.density(w.events, w.places)),
    "ref_a15_states_by_year": _in_world(lambda w, s, d: A.states_by_year(w.events, G.people(s, d), ["SECUESTRADO_EN", "ASESINADO_EN", "PRESENTE_EN"])),
    "ref_a16_places_by_people": _in_world(lambda w, s, d: A.places_by_people(w.events, w.places)),
    "ref_a17_sequences": _in_world(lambda w, s, d: A.sequences(w.events, w.places, G.people(s, d)).withColumn("secuencia", F.array_join("secuencia", ";"))),
    "ref_v1_roles": lambda s, d: V.roles(G.persons(s, d)),
    "ref_v2_sources": lambda s, d: V.by_source(G.persons(s, d)),
    "ref_v3_kin_ends": lambda s, d: V.kin_ends(G.kin_of_grandchildren(s, d)),
    "ref_v4_kin_types_nietxs": lambda s, d: V.kin_types(G.kinship(s, d), "nietxs_relacion"),
    "ref_v5_kin_types_detalles": lambda s, d: V.kin_types(G.kinship(s, d), "detalles_personas"),
    "ref_v6_states": lambda s, d: V.count_by(G.grandchildren(s, d), "estado"),
    "ref_v7_event_types": _in_world(lambda w, s, d: V.count_by(w.events, "tipo_relacion")),
    "ref_v8_event_coverage": _in_world(lambda w, s, d: V.event_coverage(G.persons(s, d), w.events, "SECUESTRADO_EN")),
    "ref_v9_case_flags": lambda s, d: V.case_flags(G.grandchildren(s, d)),
    "ref_v10_candidates": lambda s, d: V.candidate_totals(_pairs(s, d)),
    "ref_v12_ambiguity": lambda s, d: V.ambiguity(_pairs(s, d)),
    "ref_v13_no_restitution": lambda s, d: V.without_restitution(G.grandchildren(s, d)),
    "ref_v14_alias_collisions": lambda s, d: V.alias_collisions(
        table(s, d, "eaaf_lugares").select(text.place_text(F.col("LOCALIDAD")).alias("alias_norm"), F.coalesce(text.geo_name(F.col("PROVINCIA")), F.lit("")).alias("scope"), "sitio_id").where("alias_norm <> ''"), ["alias_norm", "scope"], "sitio_id"
    ).withColumn("lista", F.array_join(F.transform("lista", lambda x: x.cast("string")), ";")),
    "ref_v15_orphan_addresses": _in_world(lambda w, s, d: V.orphans(w.addresses, "lugar_key", w.places, "lugar_key", "direcciones_huerfanas")),
    "ref_v16_address_no_place": _in_world(lambda w, s, d: V.orphans(linked(w.events, w.addresses, "lugar_key", "lugar_key"), "lugar_key", w.places, "lugar_key", "sin_lugar")),
    "ref_v17_event_no_place": _in_world(lambda w, s, d: V.orphans(w.events, "lugar_key", w.places, "lugar_key", "sin_lugar")),
    "ref_v18_no_parent": lambda s, d: V.orphans(table(s, d, "jerarquias").where("tipo_relacion = 'PARTE_DE' and parent_key <> ''").select("parent_key").distinct(), "parent_key", table(s, d, "jerarquias").where("tipo_relacion = 'PARTE_DE'"), "child_key", "sin_padre"),
    "ref_v19_misplaced_alias": lambda s, d: V.misplaced_alias(
        table(s, d, "ccds").select(text.place_text(F.col("ubicacion")).alias("alias_norm"), F.concat(F.lit("lugar:CCD:"), text.slug(F.col("id_ccd"))).alias("lugar_key")), G.centres(s, d), "CAPITAL FEDERAL", "FEDERAL"
    ),
    "ref_v20_link_coverage": lambda s, d: V.link_coverage(G.centre_references(s, d).select(F.concat(F.lit("lugar:CCD:"), text.slug(F.col("id"))).alias("lugar_key")), G.centres(s, d)),
    "ref_v21_roles_by_event": lambda s, d: V.roles_by_event(G.centre_references(s, d)),
    "ref_q1_report": _in_world(report),
}
