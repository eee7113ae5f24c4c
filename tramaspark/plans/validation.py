"""Counts and checks of a loaded graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roles(people: DataFrame) -> DataFrame:
    """Persons by their set of roles; nobody is given a role that the source does not state."""
    label = F.concat(F.array(F.lit("Persona")), F.when(F.coalesce("es_nietx", F.lit(False)), F.array(F.lit("Nietx"))).otherwise(F.array().cast("array<string>")))
    return people.groupBy(F.array_join(F.array_sort(label), ",").alias("labels")).agg(F.count("*").alias("c"))


def by_source(people: DataFrame) -> DataFrame:
    return people.groupBy(F.coalesce("fuente", F.lit("(sin_fuente)")).alias("fuente")).agg(F.count("*").alias("c"))


def kin_ends(kin: DataFrame) -> DataFrame:
    """Family edges of grandchildren: all, those to a person on record, those to a name."""
    other = F.when(F.col("source_key").startswith("nietx:"), F.col("target_key")).otherwise(F.col("source_key"))
    return kin.where("fuente = 'nietxs_relacion'").agg(
        F.count("*").alias("total_rel"), F.count_if(other.startswith("registro:")).alias("rel_con_registro"), F.count_if(other.startswith("nombre:")).alias("rel_placeholder")
    )


def kin_types(kin: DataFrame, source: str) -> DataFrame:
    return kin.where(F.col("fuente") == source).groupBy("tipo").agg(F.count("*").alias("c"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("c"))


def event_coverage(people: DataFrame, events: DataFrame, kind: str) -> DataFrame:
    """Persons, and those with an event of the kind: persons, not joined rows, are counted."""
    has = events.where(F.col("tipo_relacion") == kind).select("persona_key").distinct().withColumn("con", F.lit(True))
    return people.select("persona_key").join(has, "persona_key", "left").agg(F.count("*").alias("total_personas"), F.count("con").alias("personas_con_evento"))


def case_flags(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("total_casos"), F.count_if(~F.col("adn_imputed")).alias("casos_con_adn"), F.count("restitucion").alias("casos_con_restitucion"))


def candidate_totals(candidates: DataFrame) -> DataFrame:
    return candidates.agg(
        F.count("*").alias("total_candidatos"), F.countDistinct("placeholder_key").alias("placeholders_con_candidato"), F.countDistinct("candidate_key").alias("personas_candidatas")
    )


def ambiguity(candidates: DataFrame, most: int = 25) -> DataFrame:
    return candidates.groupBy(F.col("placeholder_key").alias("placeholder")).agg(F.count("*").alias("candidatos")).orderBy(F.desc("candidatos"), "placeholder").limit(most)


def without_restitution(cases: DataFrame) -> DataFrame:
    return cases.where("restitucion is null").select("persona_key", "caso")


def alias_collisions(aliases: DataFrame, scope: list[str], target: str, most: int = 50) -> DataFrame:
    """Aliases that stand for several things within one scope; to be run before aliases are merged."""
    out = aliases.groupBy(*scope).agg(F.countDistinct(target).alias("distintos"), F.array_sort(F.collect_set(target)).alias("lista")).where("distintos > 1")
    return out.orderBy(F.desc("distintos"), *scope).limit(most)


def orphans(rows: DataFrame, key: str, others: DataFrame, other_key: str, name: str) -> DataFrame:
    """How many rows have no counterpart."""
    return rows.join(others.select(F.col(other_key).alias(key)).distinct(), key, "left_anti").agg(F.count("*").alias(name))


def misplaced_alias(aliases: DataFrame, places: DataFrame, text: str, name: str) -> DataFrame:
    """Aliases that contain a text and stand for a place of that name: a regression guard that should count 0."""
    return aliases.where(F.col("alias_norm").contains(text)).join(places.where(F.col("nombre") == name), "lugar_key", "left_semi").agg(F.count("*").alias("mal_ubicados"))


def link_coverage(events: DataFrame, places: DataFrame) -> DataFrame:
    known = places.select("lugar_key").distinct().withColumn("con", F.lit(True))
    return events.join(known, "lugar_key", "left").agg(F.count("*").alias("eventos"), F.count("con").alias("con_lugar")).withColumn("pct", F.round(100.0 * F.col("con_lugar") / F.col("eventos"), 2))


def roles_by_event(references: DataFrame) -> DataFrame:
    """Events at centres by their type and the role as typed in the record that tells of them."""
    role = F.lower(F.col("relacion"))
    kind = F.when(role == "pario_en", "PARIO_EN").otherwise("PRESENTE_EN")
    return references.groupBy(kind.alias("tipo_relacion"), F.coalesce(role, F.lit("(sin_rol)")).alias("rol")).agg(F.count("*").alias("c"))


def report(people: DataFrame, kin: DataFrame, events: DataFrame, places: DataFrame, addresses: DataFrame, aliases: DataFrame, candidates: DataFrame | None) -> DataFrame:
    """(indicador, valor): the counters of a load; every table is read once.

    Victims, accomplices and perpetrators are counted by their marks, which no source of these tables sets: they are 0.
    """
    family = "HIJE_DE PADRE_DE MADRE_DE NIETX_DE ABUELX_DE HERMANX_DE PAREJA_DE CUÑADX_DE SUEGRX_DE YERNX_NUERX_DE".split()
    counts = [
        people.agg(
            F.count("*").alias("personas_total"), F.count_if(F.col("es_nietx")).alias("nietxs_total"),
            *[F.count_if(F.col(f"es_{one}") if f"es_{one}" in people.columns else F.lit(False)).alias(f"{many}_total") for one, many in (("victima", "victimas"), ("complice", "complices"), ("represor", "represores"))],
        ),
        kin.agg(F.count_if(F.col("tipo").isin(family)).alias("rel_familiares_total")),
        events.agg(*[F.count_if(F.col("tipo_relacion") == k).alias(f"rel_{k.lower()}_total") for k in ("SECUESTRADO_EN", "ASESINADO_EN", "NACIO_EN", "PRESENTE_EN", "PARIO_EN", "MURIO_EN", "LIBERADO_EN")]),
        places.agg(F.count("*").alias("lugares_total")),
        addresses.agg(F.count("*").alias("direcciones_ccd_total")),
        aliases.agg(F.count("*").alias("alias_lugar_total")),
    ]
    if candidates is not None:
        counts.append(candidates.agg(F.count("*").alias("candidatos_merge_total")))
    out = None
    for c in counts:
        one = c.select(F.explode(F.create_map(*[x for n in c.columns for x in (F.lit(n), F.col(n))])).alias("indicador", "valor"))
        out = one if out is None else out.unionByName(one)
    return out
