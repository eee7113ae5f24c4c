"""Dates and numbers from typed text, as column expressions. Nothing here fails on bad input: it gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, norm_space, strip_accents

#: Month names.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()


def _iso(year: Column, month: Column, day: Column) -> Column:
    """yyyy-MM-dd, or null if there is no such day; the year 0 has none."""
    text = F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))
    return F.when((year.try_cast("int") > 0) & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), text)


def iso_from_dmy(c: Column) -> Column:
    """dd/MM/yyyy, with exactly these digits, as yyyy-MM-dd."""
    t = F.trim(c)
    p = r"^(\d{2})/(\d{2})/(\d{4})$"
    return F.when(t.rlike(p), _iso(F.regexp_extract(t, p, 3), F.regexp_extract(t, p, 2), F.regexp_extract(t, p, 1)))


def iso_from_long(c: Column) -> Column:
    """"5 de mayo, 1976" as 1976-05-05."""
    t = strip_accents(F.lower(F.trim(c)))
    p = r"^(\d{1,2})\s+de\s+([a-z]+),\s*(\d{4})$"
    name = F.replace(F.regexp_extract(t, p, 2), F.lit("setiembre"), F.lit("septiembre"))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    return F.when(t.rlike(p) & (month > 0), _iso(F.regexp_extract(t, p, 3), month.cast("string"), F.regexp_extract(t, p, 1)))


def partial(c: Column) -> Column:
    """yyyy/MM/dd, yyyy/MM or yyyy as STRUCT<start, end, grain>; null members if it is none of these."""
    t = F.trim(c)
    y, m, d = F.substring(t, 1, 4), F.substring(t, 6, 2), F.substring(t, 9, 2)
    day = F.when(t.rlike(r"^\d{4}/\d{2}/\d{2}$"), _iso(y, m, d))
    first = F.when(t.rlike(r"^\d{4}/\d{2}$"), _iso(y, m, F.lit("01")))
    year = F.when(t.rlike(r"^\d{4}$") & (y.try_cast("int") > 0), y)
    last = F.last_day(F.try_to_date(first, "yyyy-MM-dd")).cast("string")
    return F.struct(
        F.coalesce(day, first, F.concat(year, F.lit("-01-01"))).alias("start"),
        F.coalesce(day, last, F.concat(year, F.lit("-12-31"))).alias("end"),
        F.when(day.isNotNull(), "DAY").when(first.isNotNull(), "MONTH").when(year.isNotNull(), "YEAR").alias("grain"),
    )


def earliest(c: Column) -> Column:
    """Of a list of partial dates the earliest start; if none can be read, the texts joined by " | "; null if all are blank."""
    texts = F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != "")
    starts = F.filter(F.transform(texts, lambda x: partial(x)["start"]), lambda x: x.isNotNull())
    return F.when(F.size(texts) > 0, F.coalesce(F.array_min(starts), F.array_join(texts, " | ")))


def to_float(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def first_int(c: Column) -> Column:
    """The first run of digits as a number."""
    return F.regexp_extract(clean_text(c), r"\d+", 0).try_cast("int")


def pregnancy(c: Column) -> Column:
    """STRUCT<tipo, meses>: NO_INFO, SI, MESES with their number, or OTRO."""
    t = clean_text(c)
    n = first_int(c)
    yes = strip_accents(F.lower(t)) == "si"
    kind = F.when(t.isNull(), "NO_INFO").when(yes, "SI").when(n.isNotNull(), "MESES").otherwise("OTRO")
    return F.struct(kind.alias("tipo"), F.when(kind == "MESES", n).alias("meses"))


def coordinates(lat: Column, lon: Column) -> Column:
    """"lat,lon", or DESCONOCIDAS if one is missing."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat_ws(",", lat.cast("string"), lon.cast("string"))).otherwise("DESCONOCIDAS")


__all__ = ["coordinates", "earliest", "first_int", "iso_from_dmy", "iso_from_long", "norm_space", "partial", "pregnancy", "to_float"]
