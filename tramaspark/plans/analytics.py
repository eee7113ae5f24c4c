"""Analyses over events (persona_key, lugar_key, tipo_relacion, fecha, origen), places, persons and candidates.

Every list that is cut ends with the keys in its order, so that a cut is the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import lookup


def at_places(events: DataFrame, places: DataFrame) -> DataFrame:
    """Events with their place's columns."""
    return lookup(events, places, "lugar_key", how="inner")


def year(c: Column) -> Column:
    return F.year(F.try_to_date(c, "yyyy-MM-dd"))


def hotspots(events: DataFrame, places: DataFrame, most: int = 50) -> DataFrame:
    counted = events.groupBy("lugar_key").agg(F.count("*").alias("eventos_total"))
    named = counted.join(places.select("lugar_key", F.col("nombre").alias("lugar"), F.col("tipoGeopolitico").alias("tipo")), "lugar_key")
    return named.orderBy(F.desc("eventos_total"), "lugar_key").limit(most)


def hotspots_by_type(events: DataFrame, places: DataFrame, most: int = 100) -> DataFrame:
    counted = events.groupBy("tipo_relacion", "lugar_key").agg(F.count("*").alias("n"))
    named = counted.join(places.select("lugar_key", F.col("nombre").alias("lugar"), F.col("tipoGeopolitico").alias("tipo_lugar")), "lugar_key")
    out = named.groupBy(F.col("tipo_relacion").alias("tipo_evento"), "lugar", "tipo_lugar").agg(F.sum("n").alias("eventos_total"))
    return out.orderBy(F.desc("eventos_total"), "tipo_evento", "lugar").limit(most)


def by_year(events: DataFrame) -> DataFrame:
    """Events of each year, all and by type."""
    e = events.withColumn("anio", year(F.col("fecha"))).where("anio is not null")
    n = lambda kind, name: F.count_if(F.col("tipo_relacion") == kind).alias(name)
    return e.groupBy("anio").agg(
        F.count("*").alias("eventos_total"), n("SECUESTRADO_EN", "secuestros"), n("ASESINADO_EN", "asesinatos"), n("PRESENTE_EN", "presencias_ccd"), n("PARIO_EN", "partos_ccd")
    )


def by_year_and_jurisdiction(events: DataFrame, places: DataFrame) -> DataFrame:
    named = at_places(events, places.select("lugar_key", F.coalesce("jurisdiccion", "nombre").alias("jurisdiccion")))
    e = named.withColumn("anio", year(F.col("fecha"))).where("anio is not null and jurisdiccion is not null")
    return e.groupBy("anio", "jurisdiccion").agg(F.count("*").alias("eventos_total"))


def _named(rows: DataFrame, people: DataFrame) -> DataFrame:
    return rows.join(people.select("persona_key", "nombre"), "persona_key").withColumn("persona", F.coalesce("nombre", "persona_key")).drop("nombre")


def busiest_people(events: DataFrame, people: DataFrame, most: int = 100) -> DataFrame:
    counted = events.groupBy("persona_key").agg(F.count("*").alias("eventos_total"), F.countDistinct("tipo_relacion").alias("tipos_evento_distintos"))
    return _named(counted, people).orderBy(F.desc("eventos_total"), "persona_key").limit(most)


def multi_site(events: DataFrame, places: DataFrame, people: DataFrame, most: int = 100, sample: int = 10) -> DataFrame:
    """Persons by the number of places, with the first names of these in order."""
    e = at_places(events.select("persona_key", "lugar_key").distinct(), places.select("lugar_key", "nombre"))
    counted = e.groupBy("persona_key").agg(F.count("*").alias("lugares_distintos"), F.slice(F.array_sort(F.collect_set("nombre")), 1, sample).alias("muestra_lugares"))
    return _named(counted, people).orderBy(F.desc("lugares_distintos"), "persona_key").limit(most)


def related_network(links: DataFrame, people: DataFrame, most: int = 500) -> DataFrame:
    """Pairs of persons on record (source, target) with their names."""
    p = people.select("persona_key", "nombre")
    name = lambda k: p.select(F.col("persona_key").alias(k), F.coalesce("nombre", "persona_key").alias(f"{k}_nombre"))
    both = lookup(lookup(links.select("source", "target").distinct(), name("source"), "source", how="inner"), name("target"), "target", how="inner")
    return both.select("source", "target", "source_nombre", "target_nombre").orderBy("source", "target").limit(most)


def placeholder_quality(placeholders: DataFrame, candidates: DataFrame) -> DataFrame:
    per = candidates.groupBy("placeholder_key").agg(F.count("*").alias("n"), F.sum("score").alias("s"))
    j = placeholders.select("placeholder_key").distinct().join(per, "placeholder_key", "left")
    return j.agg(
        F.count("*").alias("placeholders_total"), F.count("n").alias("placeholders_con_candidato"), F.coalesce(F.sum("n"), F.lit(0)).alias("relaciones_candidato_total"),
        (F.sum("s") / F.sum("n")).alias("score_promedio"),
    )


def ambiguous_placeholders(candidates: DataFrame, most: int = 100, sample: int = 10) -> DataFrame:
    """The placeholders of most candidates; the sample is kept small while it is gathered, not after."""
    k = F.struct("candidate_key")
    out = candidates.groupBy("placeholder_key").agg(F.count("*").alias("candidatos"), F.max("score").alias("mejor_score"), F.min(k).getField("candidate_key").alias("primero"))
    top = out.orderBy(F.desc("candidatos"), F.desc("mejor_score"), "placeholder_key").limit(most)
    names = candidates.join(top.select("placeholder_key"), "placeholder_key", "left_semi").select("placeholder_key", "candidate_key").distinct()
    listed = names.groupBy("placeholder_key").agg(F.slice(F.array_sort(F.collect_list("candidate_key")), 1, sample).alias("muestra_candidatos"))
    return top.join(listed, "placeholder_key").select(F.col("placeholder_key").alias("placeholder"), "candidatos", "mejor_score", "muestra_candidatos")


def address_coverage(events: DataFrame, addresses: DataFrame) -> DataFrame:
    """Events whose place has an exact address, and their share in percent."""
    known = addresses.select("lugar_key").distinct().withColumn("con", F.lit(True))
    j = lookup(events, known, "lugar_key")
    return j.agg(F.count("*").alias("eventos_total"), F.count("con").alias("eventos_con_direccion")).withColumn(
        "pct_eventos_con_direccion", F.round(100.0 * F.col("eventos_con_direccion") / F.col("eventos_total"), 2)
    )


def top_addresses(events: DataFrame, addresses: DataFrame, places: DataFrame, most: int = 100) -> DataFrame:
    counted = events.groupBy("lugar_key").agg(F.count("*").alias("n"))
    j = addresses.join(counted, "lugar_key").join(places.select("lugar_key", F.col("nombre").alias("lugar"), F.col("tipoGeopolitico").alias("tipo_lugar")), "lugar_key")
    out = j.groupBy(F.col("direccionExacta").alias("direccion"), "lugar", "tipo_lugar").agg(F.sum("n").alias("eventos_total"))
    return out.orderBy(F.desc("eventos_total"), "direccion", "lugar").limit(most)


def anchor_coverage(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """nodes: lugar_key; parents: child_key, parent_key."""
    per = parents.groupBy(F.col("child_key").alias("lugar_key")).agg(F.countDistinct("parent_key").alias("n"))
    return nodes.select("lugar_key").join(per, "lugar_key", "left").agg(
        F.count("*").alias("total"), F.count_if(F.col("n").isNull()).alias("sin_parent"), F.count("n").alias("con_parent")
    )


def busiest_centres(events: DataFrame, centres: DataFrame, most: int = 100) -> DataFrame:
    counted = events.groupBy("lugar_key").agg(F.count("*").alias("eventos_total"), F.count_if(F.col("fecha") != "DESCONOCIDA").alias("fechados"), F.count_if(F.col("fecha") == "DESCONOCIDA").alias("sin_fecha"))
    return counted.join(centres.select("lugar_key", "id_ccd", F.col("nombre").alias("ccd")), "lugar_key").orderBy(F.desc("eventos_total"), "id_ccd").limit(most)


def density(events: DataFrame, places: DataFrame, most: int = 500) -> DataFrame:
    """Places with coordinates by their events."""
    counted = events.groupBy("lugar_key").agg(F.count("*").alias("eventos_total"))
    located = places.where("lat is not null and lon is not null").select("lugar_key", "lat", "lon", F.col("nombre").alias("lugar"), F.col("tipoGeopolitico").alias("tipo"))
    return counted.join(located, "lugar_key").orderBy(F.desc("eventos_total"), "lugar_key").limit(most)


def states_by_year(events: DataFrame, people: DataFrame, kinds: list[str]) -> DataFrame:
    e = events.where(F.col("tipo_relacion").isin(kinds)).withColumn("anio", year(F.col("fecha"))).where("anio is not null")
    j = lookup(e, people.select("persona_key", "estado"), "persona_key", how="inner").where("estado is not null")
    return j.groupBy("estado", "anio").agg(F.countDistinct("persona_key").alias("personas"))


def places_by_people(events: DataFrame, places: DataFrame, most: int = 100) -> DataFrame:
    counted = events.groupBy("lugar_key").agg(F.countDistinct("persona_key").alias("personas_distintas"))
    named = counted.join(places.select("lugar_key", F.col("nombre").alias("lugar"), F.col("tipoGeopolitico").alias("tipo")), "lugar_key")
    return named.orderBy(F.desc("personas_distintas"), "lugar_key").limit(most)


def sequences(events: DataFrame, places: DataFrame, people: DataFrame, most: int = 200, steps: int = 50) -> DataFrame:
    """The dated events of the first persons by key, each a list in order of time: at most `steps` of them."""
    dated = events.withColumn("dia", F.try_to_date("fecha", "yyyy-MM-dd")).where("dia is not null")
    chosen = dated.select("persona_key").distinct().join(people.select("persona_key"), "persona_key", "left_semi").orderBy("persona_key").limit(most)
    e = at_places(dated.join(F.broadcast(chosen), "persona_key", "left_semi"), places.select("lugar_key", F.col("nombre").alias("lugar")))
    text = F.concat_ws(" ", "fecha", "tipo_relacion", "lugar")
    listed = e.groupBy("persona_key").agg(F.slice(F.array_sort(F.collect_list(text)), 1, steps).alias("secuencia"))
    return _named(listed, people)


def rollup(events: DataFrame) -> DataFrame:
    """(ancestro, eventos_total): events of every place and of all places above it, by the path in its key."""
    counted = events.groupBy("lugar_key").agg(F.count("*").alias("n"))
    parts = F.split("lugar_key", r"\|")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts) - k + 1), "|"))
    return counted.select(F.explode(above).alias("ancestro"), "n").groupBy("ancestro").agg(F.sum("n").alias("eventos_total"))
