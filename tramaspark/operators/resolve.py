"""Free-text places as entries of the place graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import places as P
from ..functions.text import clean_text, place_text
from ..runtime import lookup, stored
from .gazetteer import AMBIGUITY, MIN_SCORE, resolve_context, resolve_names

PLACE = "struct<tipo:string,nombre:string,parent_key:string,hierarchy_keys:array<string>,pais_code:string>"


def _place(kind: Column | str, name: Column, parent: Column, chain: Column | None = None, code: Column | None = None) -> Column:
    """What a text means; the place's own key follows from kind, name and parent and is made once, in the end."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(
        kind.alias("tipo"), name.alias("nombre"), parent.alias("parent_key"),
        (F.lit(None) if chain is None else chain).cast("array<string>").alias("hierarchy_keys"), (F.lit(None).cast("string") if code is None else code).alias("pais_code"),
    ).cast(PLACE)


def _province(name: Column) -> Column:
    return P.place_key("PROVINCIA", name, F.lit(P.COUNTRY))


def _with_place(hits: DataFrame) -> DataFrame:
    """(alias, place) of gazetteer matches. Keys are made step by step, so that no expression holds another several times."""
    c = F.col
    out = hits.select("alias", "name", "level", "department", _province(c("province")).alias("pk"))
    out = out.withColumn("dk", F.when(c("department").isNotNull(), P.place_key("DEPARTAMENTO", c("department"), c("pk"))))
    kind = F.when(c("level").isin("PROVINCIA", "DEPARTAMENTO"), c("level")).otherwise("CIUDAD")
    parent = F.when(c("level") == "PROVINCIA", F.lit(P.COUNTRY)).when(c("level") == "DEPARTAMENTO", c("pk")).otherwise(F.coalesce("dk", "pk"))
    out = out.withColumn("kind", kind).withColumn("parent", parent).withColumn("key", P.place_key(c("kind"), c("name"), c("parent")))
    above = F.when(c("kind") == "PROVINCIA", F.array().cast("array<string>")).when((c("kind") == "CIUDAD") & c("dk").isNotNull(), F.array("dk", "pk")).otherwise(F.array("pk"))
    chain = F.concat(F.array("key"), above, F.array(F.lit(P.COUNTRY)))
    return out.select("alias", _place(c("kind"), c("name"), c("parent"), chain).alias("place"))


def from_gazetteer(aliases: DataFrame, gazetteer: DataFrame, min_score: float = MIN_SCORE, ambiguity: float = AMBIGUITY) -> DataFrame:
    """(alias, place) of the aliases that the gazetteer knows."""
    return _with_place(resolve_names(aliases, gazetteer, min_score, ambiguity))


def _segmented(aliases: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(alias, seg): city and administrative context in one text of 2 to 5 words, the shortest context that is known."""
    a = F.col("alias")
    base = P.without_province(a)
    rows = aliases.select("alias", P.tokens(base).alias("t"), P.says_province(a).alias("said"), P.province_said(a).alias("preferred"), base.alias("base"))
    foreign = "|".join(name for name, _ in P.COUNTRIES)
    rows = rows.where(F.size("t").between(2, 5) & ~a.rlike(r"\d") & ~F.col("base").rlike(foreign))
    n = F.size("t")
    cut = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.lit(3), n - 1))))
    city = F.array_join(F.slice("t", F.lit(1), F.size("t") - F.col("k")), " ")
    context = F.array_join(F.slice("t", F.size("t") - F.col("k") + 1, F.col("k")), " ")
    general = (F.col("preferred") == "BUENOS AIRES") & context.isin("SAN MARTIN", "GRAL SAN MARTIN")
    cut = cut.select("alias", "said", "preferred", "k", city.alias("city"), F.when(general, "GENERAL SAN MARTIN").otherwise(context).alias("context"))
    cut = cut.where(~P.only_address(F.col("city")))
    admin = resolve_context(cut, gazetteer)
    found = cut.join(admin, ["context", "preferred"]).where(F.col("said") | (F.col("province") == "BUENOS AIRES"))
    best = found.groupBy("alias").agg(F.min_by(F.struct("city", "level", "name", "province", "department"), "k").alias("b")).select("alias", "b.*")
    inside = F.when(F.col("level") != "PROVINCIA", F.coalesce("department", "name"))
    return _with_place(best.select("alias", F.col("city").alias("name"), F.lit("CIUDAD").alias("level"), inside.alias("department"), "province")).withColumnRenamed("place", "seg")


def resolve_places(raw: DataFrame, gazetteer: DataFrame | None, min_score: float = MIN_SCORE, ambiguity: float = AMBIGUITY) -> DataFrame:
    """(raw, alias_raw, alias_norm, tipo, nombre, lugar_key, parent_key, hierarchy_keys, pais_code) of every distinct text.

    raw: one column of texts. Texts that say nothing (null, blank, unknown, a bare address) have no row. The decision list:
    exact alias, capital with a quarter, another country, gazetteer, city with context, capital, province at the end,
    Buenos Aires by default, else INDETERMINADO. Without a gazetteer (None) its steps are skipped. Only distinct texts are
    resolved, so a text on a third of all rows costs one resolution.
    """
    column = raw.columns[0]
    texts = raw.select(F.col(f"`{column}`").alias("raw")).where("raw is not null").distinct().withColumn("text", clean_text(F.col("raw"))).where("text is not null")
    # every step is a generator of one row, past which no filter is pushed: what it makes is worked out once
    step = lambda df, name, made: df.select(*[c for c in df.columns if c != name], F.explode(F.array(made)).alias(name))
    texts = step(texts, "n", P.identity(place_text(F.col("text"))))
    aside = P.identity(place_text(F.regexp_extract("text", r".*\(([^)]{4,})\)", 1)))
    texts = step(texts, "n", F.when(F.col("n") != "", F.col("n")).otherwise(aside))
    texts = texts.where((F.col("n") != "") & ~F.col("n").isin(P.UNKNOWN))
    texts = step(texts, "n", F.coalesce(P.institution_town(F.col("n")), "n"))
    texts = step(texts, "alias", P.repeated_tail(F.col("n"))).drop("n")
    texts = texts.where(~F.col("alias").isin("SU", "DE SU", "DE LA") & ~P.only_address(F.col("alias")))
    texts, _ = stored(texts)
    a = F.col("alias")
    null = F.lit(None).cast("string")
    hinted = P.caba_hinted(a)
    aliases = texts.select("alias").distinct()
    named_caba = F.when(P.caba_named(a), _place("CIUDAD", F.lit(P.CABA), null))

    if gazetteer is not None:
        quarter = P.without_caba(a)
        quarters = aliases.where(hinted).select("alias", quarter.alias("q")).where((F.col("q") != "") & ~F.col("q").rlike(r"\d") & (F.size(P.tokens(F.col("q"))) <= 5))
        every = aliases.unionByName(quarters.select(F.col("q").alias("alias"))).distinct()
        hits, _ = stored(from_gazetteer(every, gazetteer, min_score, ambiguity))
        seg, _ = stored(_segmented(aliases.select("alias"), gazetteer))
        ok = (F.col("place.tipo") == "CIUDAD") & F.col("place.parent_key").contains("ciudad_autonoma_de_buenos_aires")
        in_caba = quarters.join(hits.where(ok).select(F.col("alias").alias("q"), F.col("place").alias("quarter")), "q").select("alias", "quarter")
        aliases, _ = stored(
            aliases.join(in_caba, "alias", "left").join(hits.withColumnRenamed("place", "gaz"), "alias", "left").join(seg, "alias", "left")
        )
        capital = F.when(hinted, F.coalesce(F.col("quarter"), named_caba))
        steps = [F.col("gaz"), F.col("seg")]
    else:
        capital, steps = F.when(hinted, named_caba), []

    for name, made in (("x", P.abroad(a)), ("e", P.exact_alias(a)), ("p", P.province_ending(a))):
        aliases = step(aliases, name, made)
    exact = F.when(F.col("e").isNotNull(), _place("CIUDAD", F.col("e.city"), F.when(F.col("e.province").isNotNull(), _province(F.col("e.province")))))
    alone = F.col("x.city").isNull()
    country = F.when(~alone, P.place_key("PAIS", F.col("x.country")))
    away = F.when(F.col("x").isNotNull(), _place(F.when(alone, "PAIS").otherwise("CIUDAD"), F.coalesce("x.city", "x.country"), country, None, F.col("x.code")))
    ending = F.when(F.col("p").isNotNull(), _place("CIUDAD", F.col("p.city"), _province(F.col("p.province"))))
    default = F.when(P.may_be_buenos_aires(a), _place("CIUDAD", a, _province(F.lit("BUENOS AIRES"))))
    unknown = _place("INDETERMINADO", a, null)

    placed = step(aliases.drop("out"), "out", F.coalesce(exact, capital, away, *steps, named_caba, ending, default, unknown)).select("alias", "out.*")
    keyed = placed.withColumn("lugar_key", P.place_key(F.col("tipo"), F.col("nombre"), F.col("parent_key")))
    chain = F.when(F.col("pais_code").isNotNull(), F.array_compact(F.array("lugar_key", "parent_key")))
    out = lookup(texts, keyed.withColumn("hierarchy_keys", F.coalesce("hierarchy_keys", chain)), "alias", rows=texts.count())
    return out.select("raw", F.col("text").alias("alias_raw"), F.col("alias").alias("alias_norm"), "tipo", "nombre", "lugar_key", "parent_key", "hierarchy_keys", "pais_code")
