"""A gazetteer of provinces, departments, municipalities and localities, and place names found in text with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import padded, tokens
from ..functions.text import geo_name

LEVELS = ["LOCALIDAD", "MUNICIPIO", "DEPARTAMENTO", "PROVINCIA"]
MIN_SCORE, AMBIGUITY = 0.76, 0.02
LONGEST = 6
#: Provinces from the most to the least populous (a weak tie-break), and words before a street's name.
PRIORITY = (
    "BUENOS AIRES", "CORDOBA", "SANTA FE", "CIUDAD AUTONOMA DE BUENOS AIRES", "MENDOZA", "TUCUMAN", "ENTRE RIOS", "SALTA", "MISIONES", "CHACO", "CORRIENTES", "SANTIAGO DEL ESTERO",
    "SAN JUAN", "JUJUY", "RIO NEGRO", "NEUQUEN", "FORMOSA", "CHUBUT", "SAN LUIS", "CATAMARCA", "LA RIOJA", "LA PAMPA", "SANTA CRUZ", "TIERRA DEL FUEGO",
)
STREET_WORDS = "CALLE AV AVENIDA RUTA PASAJE PJE NRO NUMERO".split()
#: Score of a match by level: base, most that its length adds, bonus if its province is named.
SCORES = {"LOCALIDAD": (0.80, 0.15, 0.06), "MUNICIPIO": (0.76, 0.12, 0.06), "DEPARTAMENTO": (0.71, 0.12, 0.05), "PROVINCIA": (0.75, 0.10, None)}


def prior(province: Column) -> Column:
    rank = F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), province)
    return F.when(rank > 0, F.greatest(F.lit(0.0), F.lit(0.14) - (rank - 1) * F.lit(0.004))).otherwise(F.lit(0.0))


def from_catalog(catalog: DataFrame) -> DataFrame:
    """(name, level, province, department, seq) of a catalogue with the arrays provincias, departamentos, municipios, localidades.

    Rows without id or name, and of an unknown province, are left out; a department's name is known only if the
    department itself is in the catalogue.
    """
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""

    def level(column: str, label: str) -> DataFrame:
        rows = catalog.select(F.posexplode(column).alias("pos", "r")).select("pos", "r.*")
        extra = F.col("departamento_id") if "departamento_id" in rows.columns else F.lit(None).cast("string")
        own = F.col("id") if label == "DEPARTAMENTO" else F.nullif(extra, F.lit(""))
        province = F.col("provincia_id") if label != "PROVINCIA" else F.col("id")
        return rows.where(has("id") & has("nombre")).select(
            geo_name(F.col("nombre")).alias("name"), F.lit(label).alias("level"), F.col("id").alias("id"), province.alias("provincia_id"), own.alias("dep"), F.col("pos").alias("seq")
        )

    provinces = level("provincias", "PROVINCIA")
    rest = level("departamentos", "DEPARTAMENTO").unionByName(level("municipios", "MUNICIPIO")).unionByName(level("localidades", "LOCALIDAD"))
    known = provinces.groupBy("id").agg(F.max_by("name", "seq").alias("province")).withColumnRenamed("id", "provincia_id")
    inside = rest.join(known, "provincia_id")
    departments = inside.where("level = 'DEPARTAMENTO'").groupBy("dep").agg(F.max_by("name", "seq").alias("department"))
    out = inside.join(departments, "dep", "left").select("name", "level", "province", "department", "seq")
    return out.unionByName(provinces.select("name", "level", F.col("name").alias("province"), F.lit(None).cast("string").alias("department"), "seq"))


def from_table(localities: DataFrame) -> DataFrame:
    """The same from rows (georef_id, localidad, departamento, provincia); records of one name are in the order of their ids."""
    seq = F.regexp_extract("georef_id", r"(\d+)", 1).try_cast("int")
    rows = localities.where("georef_id is not null and localidad is not null and provincia is not null").select(
        geo_name(F.col("localidad")).alias("l"), geo_name(F.col("departamento")).alias("d"), geo_name(F.col("provincia")).alias("p"), seq.alias("seq")
    )
    places = rows.select(F.col("l").alias("name"), F.lit("LOCALIDAD").alias("level"), F.col("p").alias("province"), F.col("d").alias("department"), "seq")
    departments = rows.where("d is not null").groupBy("d", "p").agg(F.min("seq").alias("seq")).select(
        F.col("d").alias("name"), F.lit("DEPARTAMENTO").alias("level"), F.col("p").alias("province"), F.col("d").alias("department"), "seq"
    )
    provinces = rows.groupBy("p").agg(F.min("seq").alias("seq")).select(
        F.col("p").alias("name"), F.lit("PROVINCIA").alias("level"), F.col("p").alias("province"), F.lit(None).cast("string").alias("department"), "seq"
    )
    return places.unionByName(departments).unionByName(provinces)


def ngrams(words: Column, longest: int = LONGEST) -> Column:
    """All runs of at most `longest` words as ARRAY<STRUCT<gram, size, start>>; single words of under 4 letters are left out."""
    n = F.size(words)
    sizes = F.when(n > 0, F.sequence(F.lit(1), F.least(F.lit(longest), n))).otherwise(F.array().cast("array<int>"))
    runs = F.flatten(
        F.transform(
            sizes,
            lambda k: F.transform(
                F.sequence(F.lit(1), n - k + 1),
                lambda i: F.struct(F.array_join(F.slice(words, i, k), " ").alias("gram"), k.alias("size"), (i - 1).alias("start")),
            ),
        )
    )
    return F.filter(runs, lambda r: (r["size"] > 1) | (F.length(r["gram"]) >= 4))


def matches(aliases: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(alias, name, level, province, department, score) of every gazetteer entry named in an alias, the best of each.

    An alias that names provinces in full matches inside these only. Names right behind a street word, or before a
    number, score less. Equal scores keep the order: longer runs first, then from the left, by level, as in the gazetteer.
    """
    words = aliases.select("alias").distinct().withColumn("w", tokens(F.col("alias")))
    grams = words.select("alias", "w", F.explode(ngrams(F.col("w"))).alias("g")).select("alias", "w", "g.*")
    said = provinces_said(aliases, gazetteer).groupBy("alias").agg(F.collect_set("province").alias("said"))
    hit = grams.join(gazetteer.withColumnRenamed("name", "gram"), "gram").join(said, "alias", "left")
    hit = hit.where((F.col("level") == "PROVINCIA") | F.col("said").isNull() | F.array_contains("said", F.col("province")))
    before = F.get("w", F.col("start") - 1)
    behind = F.get("w", F.col("start") + F.col("size"))
    penalty = F.when((F.col("start") > 0) & before.isin(STREET_WORDS), 0.12).otherwise(F.lit(0.0)) + F.when(behind.rlike(r"^\d+$"), 0.10).otherwise(F.lit(0.0))
    score = F.when(F.lit(False), F.lit(0.0))
    for level, (base, most, bonus) in SCORES.items():
        own = F.lit(base) + F.least(F.lit(most), F.col("size") * F.lit(0.02))
        if bonus is not None:
            own = own + F.when(F.col("said").isNotNull(), F.lit(bonus)).otherwise(prior(F.col("province"))) - penalty
        score = score.when(F.col("level") == level, own)
    rank = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.col("level"))
    place = F.struct(-F.col("size"), F.col("start"), rank, F.col("seq"))
    scored = hit.select("alias", F.col("gram").alias("name"), "level", "province", F.coalesce("department", F.lit("")).alias("department"), score.alias("score"), rank.alias("r"), place.alias("place"))
    w = Window.partitionBy("alias", "name", "province", "department")
    best = scored.withColumn("first", F.min("place").over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc("score"), "r", "place")))
    return best.where("k = 1").select("alias", "name", "level", "province", F.nullif("department", F.lit("")).alias("department"), "score", "first")


def resolve_names(aliases: DataFrame, gazetteer: DataFrame, min_score: float = MIN_SCORE, ambiguity: float = AMBIGUITY) -> DataFrame:
    """(alias, name, level, province, department, score): the entry each alias means, if its best match is good and clear.

    The best match must reach min_score, and lead the next by `ambiguity` unless both lie in one province.
    """
    w = Window.partitionBy("alias").orderBy(F.desc("score"), F.desc(F.length("name")), "first")
    m = matches(aliases, gazetteer)
    ranked = m.select("*", F.row_number().over(w).alias("k"), F.lead("score").over(w).alias("s2"), F.lead("province").over(w).alias("p2"))
    clear = F.col("s2").isNull() | (F.col("score") - F.col("s2") >= ambiguity) | (F.col("province") == F.col("p2"))
    return ranked.where((F.col("k") == 1) & (F.col("score") >= min_score) & clear).select("alias", "name", "level", "province", "department", "score")


def resolve_context(contexts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(context, preferred, level, name, province, department) of administrative contexts (context, preferred province).

    The preferred province decides if it has such a name; then municipalities precede departments and provinces, and
    populous provinces the others.
    """
    wanted = contexts.select("context", "preferred").distinct().withColumn("name", geo_name(F.col("context")))
    order = F.array_position(F.array(*[F.lit(x) for x in ("MUNICIPIO", "DEPARTAMENTO", "PROVINCIA")]), F.col("level"))
    w = Window.partitionBy("context", "preferred").orderBy(F.desc(F.coalesce(F.col("province") == F.col("preferred"), F.lit(False))), order, F.desc(prior(F.col("province"))), "seq")
    found = wanted.join(gazetteer.where("level <> 'LOCALIDAD'"), "name").withColumn("k", F.row_number().over(w))
    return found.where("k = 1").select("context", "preferred", "level", "name", "province", "department")


def provinces_said(aliases: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(alias, province) of every province an alias names in full words, names of under 4 letters aside.

    Runs are as long as the longest province name, however many words that has, so that a join on them finds whatever
    the alias contains.
    """
    names = gazetteer.where("level = 'PROVINCIA' and length(name) >= 4").select("name", "province").distinct()
    longest = names.agg(F.max(F.size(F.split("name", " ")))).collect()[0][0] or 1
    grams = aliases.select("alias").distinct().select("alias", F.explode(ngrams(tokens(F.col("alias")), longest)["gram"]).alias("name"))
    return grams.distinct().join(names, "name").select("alias", "province").distinct()


__all__ = ["from_catalog", "from_table", "matches", "ngrams", "padded", "prior", "provinces_said", "resolve_context", "resolve_names"]
