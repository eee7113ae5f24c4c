"""Free-text place descriptions: normal forms, hints, addresses. Column expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, norm_space, place_text, slug, strip_accents

COUNTRY = "lugar:PAIS:argentina"
CABA = "CIUDAD AUTONOMA DE BUENOS AIRES"

#: The rewriting of place descriptions, in this order (pattern, replacement). The first applies only where FRANCIA is not named.
IDENTITY = (
    (r"\bBOULOGNE\b(?!\s+SUR\s+MER)", "BOULOGNE SUR MER"),
    (r"\bCAPITAL\s+FFDERAL\b", "CAPITAL FEDERAL"),
    (r"\bCDAD\b", "CIUDAD"),
    (r"\bCAP\s+FED\b", "CAPITAL FEDERAL"),
    (r"\bSTA\b", "SANTA"),
    (r"\bSECUETRADO\b", "SECUESTRADO"),
    (r"\bSECUESTRAD[OA]S?\b", "SECUESTRADO"),
    (r"\bFUE\s+SECUESTRADO\b", "SECUESTRADO"),
    (r"^SU\s+DOMICILIO\s+UBICADO\s+EN\s+", ""),
    (r"^SU\s+DOMICILIO\s+", ""),
    (r"^EN\s+SU\s+DOMICILIO\s+", ""),
    (r"\bDE\s+SU\s+DOMICILIO\b", ""),
    (r"\bEN\s+SU\s+DOMICILIO\b", ""),
    (r"\bVIA\s+PUBLICA\b", ""),
    (r"\bDOMICILIO\s+PARTICULAR\b", ""),
    (r"\bSECUESTRADO\b", ""),
    (r"\bASESINAD[OA]S?\b", ""),
    (r"\bNO\s+CONSTA\b", ""),
    (r"\bSE\s+DESCONOCE\b", ""),
    (r"\bSIN\s+DETERMINAR\b", ""),
    (r"^O\s+\d{1,2}\s\d{1,2}\s\d{2,4}\s*", ""),
    (r"\bSDH\b", ""),
    (r"\bSU\s+DOMICILIO\b.*$", ""),
    (r"\bVIVIENDA\s+DE\b.*$", ""),
    (r"\bVIVIENDA\s+PARTICULAR\b.*$", ""),
    (r"\bCASA\s+DE\b.*$", ""),
    (r"\bLUGAR\s+DE\s+TRABAJO\b.*$", ""),
    (r"\bINMEDIACIONES\s+DE\b.*$", ""),
    (r"^([A-Z\s]{3,}?)\s+BS\s+AS\b.*$", "$1 BS AS"),
    (r"\bEN\s+LA\b$", ""),
    (r"\bEN\s+EL\b$", ""),
)
#: Exact aliases (alias, city, province or empty for none).
ALIASES = (
    ("CAPITAL", CABA, ""), ("CAPITAL FEDERAL", CABA, ""), ("FEDERAL", CABA, ""), ("CABA", CABA, ""), ("CIUDAD DE BS AS", CABA, ""), ("CIUDAD DE BUENOS AIRES", CABA, ""),
    ("CORDOBA CAPITAL", "CORDOBA", "CORDOBA"), ("MENDOZA CAPITAL", "MENDOZA", "MENDOZA"), ("SAN MIGUEL DE TUCUMAN", "SAN MIGUEL DE TUCUMAN", "TUCUMAN"),
    ("JOSE LEON SUAREZ SAN MARTIN", "VILLA JOSE LEON SUAREZ", "BUENOS AIRES"), ("LIBERTADOR GENERAL SAN MARTIN", "SAN MARTIN", "BUENOS AIRES"),
)
#: How provinces are written, in the order in which endings are tried.
PROVINCES = (
    ("BS AS", "BUENOS AIRES"), ("BSAS", "BUENOS AIRES"), ("BS A S", "BUENOS AIRES"), ("BUENOS AIRES", "BUENOS AIRES"), ("BSA", "BUENOS AIRES"),
    ("SANTA FE", "SANTA FE"), ("TUCUMAN", "TUCUMAN"), ("CORDOBA", "CORDOBA"), ("MENDOZA", "MENDOZA"),
)
#: Countries with their codes, in the order in which endings are tried.
COUNTRIES = (
    ("PARAGUAY", "PY"), ("CHILE", "CL"), ("ITALIA", "IT"), ("BOLIVIA", "BO"), ("ESPANA", "ES"), ("BRASIL", "BR"), ("URUGUAY", "UY"), ("FRANCIA", "FR"), ("MEXICO", "MX"), ("COLOMBIA", "CO"),
    ("VENEZUELA", "VE"), ("ALEMANIA", "DE"), ("BELGICA", "BE"), ("AUSTRIA", "AT"), ("HONDURAS", "HN"), ("PERU", "PE"), ("ESTADOS UNIDOS", "US"), ("CUBA", "CU"), ("CHECOSLOVAQUIA", "CS"),
    ("PORTUGAL", "PT"), ("SUECIA", "SE"), ("SUIZA", "CH"), ("MARRUECOS", "MA"), ("GRECIA", "GR"), ("POLONIA", "PL"), ("GUATEMALA", "GT"), ("CROACIA", "HR"), ("YUGOSLAVIA", "YU"),
)
#: Phrases that name a city abroad (phrase, city, country).
CITIES_ABROAD = (
    ("ASUNCION PARAGUAY", "ASUNCION", "PARAGUAY"), ("RIO DE JANEIRO BRASIL", "RIO DE JANEIRO", "BRASIL"), ("SANTIAGO DE CHILE", "SANTIAGO", "CHILE"),
    ("SANTIAGO DE CHILE CHILE", "SANTIAGO", "CHILE"), ("BARCELONA ESPANA", "BARCELONA", "ESPANA"), ("SAN PABLO BRASIL", "SAN PABLO", "BRASIL"),
    ("LA PAZ BOLIVIA", "LA PAZ", "BOLIVIA"), ("ORURO BOLIVIA", "ORURO", "BOLIVIA"), ("ANTOFAGASTA CHILE", "ANTOFAGASTA", "CHILE"), ("PARIS FRANCIA", "PARIS", "FRANCIA"),
    ("MADRID ESPANA", "MADRID", "ESPANA"), ("KALLITHEA ATTICA GRECIA", "KALLITHEA ATTICA", "GRECIA"), ("MARRAKECH MARRUECOS", "MARRAKECH", "MARRUECOS"),
    ("SAN ESTEBAN DE LA SIERRA SALAMANCA ESPANA", "SAN ESTEBAN DE LA SIERRA", "ESPANA"), ("WOLIN POMERANIA POLONIA", "WOLIN POMERANIA", "POLONIA"),
    ("ZURICH SUIZA", "ZURICH", "SUIZA"), ("ASUNCION PARAGUAY SDH", "ASUNCION", "PARAGUAY"),
)
UNKNOWN = ["SE DESCONOCE", "NO HAY INFORMACION", "SIN DATOS", "DESCONOCIDO"]
CABA_WORDS = ["CAPITAL FEDERAL", "CAP FED", "CABA", "CIUDAD DE BS AS", "CIUDAD DE BUENOS AIRES", CABA]
STREETS = "AV(?:ENIDA)?|CALLE|PJE|PASAJE|RUTA|DIAGONAL|BLVD|BOULEVARD"
INSTITUTIONS = "COMISARIA|SUBCOMISARIA|REGIMIENTO|UNIDAD PENAL|ALCAIDIA|DESTACAMENTO"
NOT_A_PLACE = "CAMARA REGIMIENTO DESCAMPADO TRAYECTO SE DESCONOCE SIN DETERMINAR DOMICILIO".split()
TAIL_NOISE = "EN LA EL DE DEL AL Y E LAS LOS".split()


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def padded(c: Column) -> Column:
    return F.concat(F.lit(" "), c, F.lit(" "))


def identity(c: Column) -> Column:
    """The core of a description in normal form: typing errors mended, narrative and tails cut."""

    def rewritten(x: Column) -> Column:
        (first, to), *rest = IDENTITY
        out = F.when(x.contains("FRANCIA"), x).otherwise(F.regexp_replace(x, first, to))
        for pattern, to in rest:
            out = F.regexp_replace(out, pattern, to)
        return norm_space(out)

    # within an array's function, which is not compiled: thirty rewritings in a row make code that takes long to compile
    return F.get(F.transform(F.array(c), rewritten), 0)


def place_key(kind: Column | str, name: Column, parent: Column | None = None) -> Column:
    """A place's key: kind and slug of the name, then the parent's key behind a bar."""
    own = F.concat(F.lit("lugar:"), F.lit(kind) if isinstance(kind, str) else kind, F.lit(":"), slug(name))
    return own if parent is None else F.concat_ws("|", own, parent)


def institution_town(c: Column) -> Column:
    """The town a police station or barracks is said to be in, else null."""
    town = norm_space(F.regexp_extract(c, rf"^(?:{INSTITUTIONS})\s*(?:\d{{1,4}})?\s*(?:DE|DEL|EN)\s+(.+)$", 1))
    return F.when(town != "", town)


def without_province(c: Column) -> Column:
    """The text without a province at its end; the longest way to write one counts."""
    t = norm_space(c)
    ends = "|".join(sorted((p for p, _ in PROVINCES), key=lambda p: -len(p)))
    return norm_space(F.regexp_replace(t, rf"(?: (?:{ends}))$", ""))


def repeated_tail(c: Column) -> Column:
    """The last word, if it is said twice at the end of a long or noisy text; else the text."""
    t = tokens(without_province(c))
    n = F.size(t)
    last, before = F.try_element_at(t, F.lit(-1)), F.try_element_at(t, F.lit(-2))
    noisy = F.arrays_overlap(F.slice(t, F.lit(1), F.greatest(n - 2, F.lit(0))), F.array(*[F.lit(w) for w in TAIL_NOISE]))
    return F.when((n >= 4) & (last == before) & (F.length(last) >= 4) & ((n >= 7) | noisy), last).otherwise(c)


def only_address(c: Column) -> Column:
    return c.rlike(r"\b\d{1,5}\b") & c.rlike(rf"^({STREETS})\b")


def says_province(c: Column) -> Column:
    hints = [p for p, _ in PROVINCES] + ["CAPITAL FEDERAL", "CABA", CABA]
    return padded(c).rlike("|".join(f" {h} " for h in hints))


def province_said(c: Column) -> Column:
    """The province a text names, the longest way to write one first; BUENOS AIRES if it names none."""
    out = F.when(F.lit(False), F.lit(""))
    for hint, province in sorted(PROVINCES, key=lambda p: -len(p[0])):
        out = out.when(padded(c).contains(f" {hint} "), province)
    return out.otherwise("BUENOS AIRES")


def may_be_buenos_aires(c: Column) -> Column:
    t = tokens(c)
    return ~says_province(c) & ~c.rlike(r"\d") & (F.size(t) <= 5) & ~F.arrays_overlap(t, F.array(*[F.lit(w) for w in NOT_A_PLACE]))


def caba_named(c: Column) -> Column:
    """Whether the capital is named in full words."""
    return padded(c).rlike("CAPITAL FEDERAL| CABA |CIUDAD DE BUENOS AIRES|" + CABA)


def caba_hinted(c: Column) -> Column:
    return padded(c).rlike("|".join(CABA_WORDS))


def without_caba(c: Column) -> Column:
    """What a text says besides the capital's name."""
    out = padded(c)
    for w in CABA_WORDS:
        out = F.regexp_replace(out, r"\b" + w.replace(" ", r"\s+") + r"\b", " ")
    return norm_space(F.regexp_replace(F.regexp_replace(out, r"\b(CIUDAD|CDAD)\b", " "), r"\b(DE|DEL|EN|LA|EL)\b", " "))


def _lookup(table: dict[str, str], c: Column) -> Column:
    """A small table as a literal map: one look-up instead of a chain of conditions."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def exact_alias(c: Column) -> Column:
    """STRUCT<city, province> of an exact alias, province null if it has none; else null."""
    city = _lookup({a: city for a, city, _ in ALIASES}, c)
    return F.when(city.isNotNull(), F.struct(city.alias("city"), _lookup({a: p for a, _, p in ALIASES if p}, c).alias("province")))


def province_ending(c: Column) -> Column:
    """STRUCT<city, province> of a text that ends in a province; else null."""
    pattern = rf"^(.+) ({'|'.join(p for p, _ in PROVINCES)})$"
    city = F.trim(F.regexp_extract(c, pattern, 1))
    return F.when(city != "", F.struct(city.alias("city"), _lookup(dict(PROVINCES), F.regexp_extract(c, pattern, 2)).alias("province")))


def abroad(c: Column) -> Column:
    """STRUCT<city, country, code> of a place in another country (city null: the country itself), else null.

    The country alone counts first, then a known phrase, then a country at the end of a short text.
    """
    codes = dict(COUNTRIES)
    clean = norm_space(F.regexp_replace(F.regexp_replace(c, r"\bSDH\b", ""), r"\bNO\s+CONSTA\b", ""))
    pattern = rf"^(.+) ({'|'.join(codes)})$"
    head = F.trim(F.regexp_extract(clean, pattern, 1))
    behind = F.when((F.size(tokens(clean)) <= 7) & (head != "") & (head != "DE"), head)
    alone = _lookup(codes, c).isNotNull()
    known = _lookup({p: city for p, city, _ in CITIES_ABROAD}, clean)
    country = F.when(alone, c).when(known.isNotNull(), _lookup({p: land for p, _, land in CITIES_ABROAD}, clean)).when(behind.isNotNull(), F.regexp_extract(clean, pattern, 2))
    made = F.struct(F.when(~alone, F.coalesce(known, behind)).alias("city"), country.alias("country"), _lookup(codes, country).alias("code"))
    return F.when(country.isNotNull() & ~c.rlike("CAPITAL FEDERAL|BS AS|BUENOS AIRES|CABA"), made)


#: The expressions by which a street address is told from a story.
ADDRESS_PREFIXES = (
    r"^SECUESTRAD[OA]\s+",
    r"^FUE\s+SECUESTRAD[OA]\s+",
    r"^EN\s+LAS\s+CERCANIAS\s+DE\s+",
    r"^EN\s+LA\s+VIA\s+PUBLICA\s+",
    r"^DE\s+SU\s+",
    r"^SU\s+",
    r"^LUGAR\s+DE\s+TRABAJO\s+",
)
ADDRESS_REFUSED = (
    r"^(COMISARIA|SUBCOMISARIA|REGIMIENTO|UNIDAD PENAL|ALCAIDIA|DESTACAMENTO)\b",
    r"^ASESINAD[OA]\s+\d{1,2}[\-/]\d{1,2}[\-/]\d{2,4}",
    r"^SEC\s+EN\s+CAP\s+FED\s+EL\s+\d{1,2}[\-/]\d{1,2}[\-/]\d{2,4}",
    r"^SEGUN\s+DENUNCIA",
    r"^SE\s+DESCONOCE",
    r"^SIN\s+DETERMINAR",
    r"^NO\s+CONSTA",
)
ADDRESS_FRAGMENT = r"\b([A-Z]{3,}(?:\s+[A-Z]{2,}){0,5}\s+\d{1,5}(?:\s*(?:DTO|DEPTO|PISO|N)\s*[A-Z0-9\"']{1,6})?)\b"
ADDRESS_GENERIC = ("SU DOMICILIO", "SU LUGAR DE TRABAJO", "SE DESCONOCE", "SIN DETERMINAR", "NO CONSTA", "VIA PUBLICA")
ADDRESS_NUMBER = r"\b(\d{1,5})\b"
ADDRESS_CORNER = r"\b[A-Z]{2,}\s+Y\s+[A-Z]{2,}\b"
ADDRESS_STREET = r"^(AV(?:ENIDA)?|CALLE|PJE|PASAJE|RUTA|DIAGONAL|BLVD|BOULEVARD)\s+(.+)$"
ADDRESS_ASIDE = (r"\([^)]*\)", r"[^A-Z0-9\s,\-\./]")
#: Confidence with street word and number, with a number only, and with a corner.
ADDRESS_TRUST = (0.95, 0.85, 0.65)


def address_text(raw: Column) -> Column:
    """The part of a description that may be an address: null where it tells a story or names an institution."""
    out = strip_accents(F.upper(clean_text(raw)))
    for pattern in ADDRESS_ASIDE:
        out = F.regexp_replace(out, pattern, " ")
    out = norm_space(out)
    for pattern in ADDRESS_PREFIXES:
        out = F.regexp_replace(out, pattern, "")
    return F.when(~out.rlike("|".join(ADDRESS_REFUSED)), norm_space(out))


def address_chunk(text: Column) -> Column:
    """The first piece between separators with a number or a street corner; of a long text only its street and number."""
    fragment = norm_space(F.regexp_extract(text, ADDRESS_FRAGMENT, 1))
    pieces = F.split(F.when((F.length(text) > 35) & (fragment != ""), fragment).otherwise(text), "[,;-]")
    numbered = lambda x: x.rlike(ADDRESS_NUMBER)
    corner = lambda x: x.rlike(ADDRESS_CORNER) & (F.size(tokens(x)) <= 8)
    good = F.filter(F.transform(pieces, lambda x: norm_space(x)), lambda x: (numbered(x) | corner(x)) & ~x.isin(*ADDRESS_GENERIC))
    return F.when(F.length(F.get(good, 0)) >= 5, F.get(good, 0))


def street_address(raw: Column) -> Column:
    """STRUCT<direccion_raw, direccion_norm, via, numero, confianza> of the street address in a description, else null."""
    chunk = address_chunk(address_text(raw))

    def made(x: Column) -> Column:
        via = F.nullif(F.regexp_extract(x, ADDRESS_STREET, 1), F.lit(""))
        number = F.nullif(F.regexp_extract(x, ADDRESS_NUMBER, 1), F.lit(""))
        both, one, neither = ADDRESS_TRUST
        trust = F.when(number.isNull(), neither).when(via.isNull(), one).otherwise(both)
        return F.struct(clean_text(raw).alias("direccion_raw"), x.alias("direccion_norm"), via.alias("via"), number.alias("numero"), trust.alias("confianza"))

    # through an array of one, so that the piece is worked out once however often it is named
    return F.get(F.transform(F.filter(F.array(chunk), lambda x: x.isNotNull()), made), 0)
