"""Named queries of the sources: the records of the tables, written in each source's own form, read by its reader.

Files go to the shared folder. Pages are rendered from the records in the JVM, as the sites write them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html
from ..functions.text import split_list
from ..operators import gazetteer
from ..operators.latest import latest
from ..runtime import cut, shared_dir, table
from ..sources import files
from . import graph as G

Query = Callable[[SparkSession, str], DataFrame]
ROWS_PER_FILE = 5_000


def _place(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/trama/{name}-{uuid.uuid4().hex}"


def _cases(s: SparkSession, d: str) -> DataFrame:
    n = latest(table(s, d, "nietxs"), "id_nietx", "cargado_en", ["nombre_completo", "estado", "restituido", "busqueda"])
    return n.select("id_nietx", "nombre_completo", "estado", "restituido", F.col("busqueda")["mes"].alias("mes"))


def json_arrays(s: SparkSession, d: str) -> DataFrame:
    """Files that are one JSON array of records."""
    where = _place(s, "arreglos")
    files.write_arrays(_cases(s, d), where)
    back = files.read_records(s, where, "id_nietx long, nombre_completo string, estado string, restituido struct<ADN:string, `Restitución`:string>, mes string")
    return back.select("id_nietx", "nombre_completo", "estado", F.col("restituido")["ADN"].alias("ADN"), F.col("restituido")["Restitución"].alias("restitucion"), "mes")


def direct(s: SparkSession, d: str) -> DataFrame:
    """Direct source files, each with a part of the persons and of the family edges."""
    where = _place(s, "fuentes")
    people = G.grandchildren(s, d).select("persona_key", "nombre", "caso", "ADN")
    parts = max(1, -(-people.count() // ROWS_PER_FILE))
    bucket = F.pmod(F.xxhash64("persona_key"), F.lit(parts)).alias("b")
    one = people.groupBy(bucket).agg(F.collect_list(F.struct("persona_key", "nombre", "caso", "ADN")).alias("personas"))
    one.select(F.concat(F.lit("f"), F.col("b").cast("string")).alias("source_id"), F.lit(1).alias("version"), "personas").write.option("maxRecordsPerFile", 1).json(where)
    return files.direct_sources(s, where)[0]["personas"].select("persona_key", "nombre", "caso", "ADN")


def nothing(s: SparkSession, d: str) -> DataFrame:
    """The empty tables, by the number of their rows."""
    out = None
    for name, t in files.empty_tables(s).items():
        one = t.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        out = one if out is None else out.unionByName(one)
    return out


def from_catalog(s: SparkSession, d: str) -> DataFrame:
    """The gazetteer from a catalogue of nested lists, as the site delivers it; the list of places is of fixed length."""
    g = table(s, d, "georef_localidades").distinct()
    dep = F.concat_ws("/", "provincia", "departamento")
    provinces = g.select(F.col("provincia").alias("id"), F.col("provincia").alias("nombre")).distinct()
    departments = g.select(dep.alias("id"), F.col("departamento").alias("nombre"), F.col("provincia").alias("provincia_id")).distinct()
    places = g.select(F.col("georef_id").alias("id"), F.col("localidad").alias("nombre"), F.col("provincia").alias("provincia_id"), dep.alias("departamento_id"), F.lit(None).cast("string").alias("municipio_id"))
    whole = lambda t, name: t.agg(F.collect_list(F.struct(*t.columns)).alias(name))
    towns = departments.limit(0)
    doc = whole(provinces, "provincias").join(whole(departments, "departamentos")).join(whole(towns, "municipios")).join(whole(places, "localidades"))
    return gazetteer.from_catalog(doc).select("name", "level", "province", "department")


def flat_catalog(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "georef_localidades")
    raw = g.select(F.col("georef_id").alias("id"), F.col("localidad").alias("nombre"), F.struct(F.col("provincia").alias("id")).alias("provincia"), F.struct(F.col("departamento").alias("id")).alias("departamento"))
    return files.catalog(raw)


def _sites(s: SparkSession, d: str, encoding: str) -> DataFrame:
    cols = [c for c in table(s, d, "eaaf_lugares").columns if c not in ("sitio_id", "cargado_en")]
    rows = latest(table(s, d, "eaaf_lugares"), "sitio_id", "cargado_en", cols).select(*[f"`{c}`" for c in cols])
    if encoding != "UTF-8":
        rows = rows.where(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in cols]).rlike(r"^[\x00-\xFF]*$"))
    where = _place(s, "sitios")
    out = rows.write.option("sep", ";").option("header", True).option("encoding", encoding).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("escape", '"')
    out.csv(where)
    back = files.sites_csv(s, where, encoding)
    return back.select("PROVINCIA", "LOCALIDAD", F.col("Lat").alias("lat"), F.col("Long").alias("lon"), F.col("Suma de CASOS").alias("casos"))


def saved(s: SparkSession, d: str) -> DataFrame:
    """Records saved twice: the second save replaces the first."""
    where = _place(s, "guardado")
    rows = cut(_cases(s, d).select("id_nietx", "nombre_completo"))
    files.write_records(rows.limit(1), where)
    files.write_records(rows, where)
    return files.read_records(s, where, "id_nietx long, nombre_completo string", lines=True)


def merged(s: SparkSession, d: str) -> DataFrame:
    """Persons of both sources in one table."""
    return G.persons(s, d).select("persona_key", "nombre", "fuente", F.coalesce("es_nietx", F.lit(False)).alias("es_nietx"))


def parted(s: SparkSession, d: str) -> DataFrame:
    """How many rows each of the load's partitions has."""
    p = merged(s, d).groupBy(F.concat_ws("/", F.lit("personas"), "fuente", F.col("es_nietx").cast("string")).alias("parte")).agg(F.count("*").alias("filas"))
    j = table(s, d, "jerarquias").groupBy(F.concat_ws("/", F.lit("jerarquias"), F.coalesce("tipo_relacion", F.lit("-"))).alias("parte")).agg(F.count("*").alias("filas"))
    return p.unionByName(j)


def known_keys(s: SparkSession, d: str) -> DataFrame:
    """Parents that are themselves placed under another."""
    j = table(s, d, "jerarquias").where("tipo_relacion = 'PARTE_DE'")
    up, own = j.select(F.col("parent_key").alias("clave")).where("clave <> ''").distinct(), j.where("child_key <> ''").select(F.col("child_key").alias("clave"))
    return up.join(own, "clave", "left_semi")


def crime_lists(s: SparkSession, d: str) -> DataFrame:
    """The crimes of every accused as the pages write them, in one text, split again: blanks kept, and blanks dropped."""
    v = latest(table(s, d, "victimas"), "victima_id", "capturado_en", ["sentencias"]).select("victima_id", F.posexplode("sentencias").alias("k", "s"))
    i = v.select("victima_id", "k", F.posexplode("s.imputados").alias("j", "i")).select("victima_id", "k", "j", F.array_join("i.delitos", " , ", " ").alias("t")).where("t is not null")
    kept, dropped = F.array_join(split_list(F.col("t")), "|"), F.array_join(split_list(F.col("t"), keep_blank=False), "|")
    return i.select("victima_id", "k", "j", kept.alias("con_blancos"), dropped.alias("sin_blancos"))


def _html(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _a(cls: str, href: Column, text: Column) -> Column:
    return F.concat(F.lit(f'<a class="lesahumanidad-{cls}" href="'), _html(href), F.lit('">'), _html(text), F.lit("</a>"))


def _list(c: Column, make: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.array_join(F.transform(F.filter(c, lambda x: x.isNotNull()), make), ""), F.lit(""))


def _td(cls: str, inner: Column) -> Column:
    return F.concat(F.lit(f'<td class="lesahumanidad-{cls}">'), inner, F.lit("</td>"))


def _card(m: Column, cls: str) -> Column:
    rows = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(F.lit("<li><strong>"), _html(e["key"]), F.lit(":</strong>"), _html(e["value"]), F.lit("</li>"))), "")
    return F.concat(F.lit(f'<div class="lesahumanidad-{cls}"><ul>'), F.coalesce(rows, F.lit("")), F.lit("</ul></div>"))


def _crimes(c: Column) -> Column:
    return _html(F.array_join(c, ", "))


def _victims(s: SparkSession, d: str) -> DataFrame:
    return latest(table(s, d, "victimas"), "victima_id", "capturado_en", ["source_url", "nombre", "imagen_url", "relato_hechos", "datos_personales", "ccds", "sentencias"]).withColumn("url", F.concat(F.lit("https://h.example/victima/"), "victima_id"))


def victim_pages(s: SparkSession, d: str) -> DataFrame:
    v = _victims(s, d)
    block = lambda x: F.concat(
        F.lit('<div class="lesahumanidad-agrupamiento-tabla-sentencia">'), _a("link-sentencia", x["sentencia_url"], x["sentencia_nombre"]), F.lit('</div><table class="lesahumanidad-tabla"><tbody>'),
        _list(x["imputados"], lambda i: F.concat(F.lit("<tr>"), _td("tabla-victimas-sentencias-imputados-campo-imputado", _a("link-imputado", i["imputado_url"], i["imputado_nombre"])), _td("tabla-victimas-sentencias-imputados-campo-delitos", _crimes(i["delitos"])), F.lit("</tr>"))),
        F.lit("</tbody></table>"),
    )
    page = F.concat(
        F.lit('<html><article class="victima"><h1>'), _html(F.col("nombre")), F.lit('</h1><div class="lesahumanidad-contenedor-img"><img src="'), _html(F.col("imagen_url")), F.lit('"></div>'),
        _card(F.col("datos_personales"), "ficha-items"), F.lit('<h4 class="lesahumanidad-victima-subtitulo">Relato</h4><p>'), _html(F.col("relato_hechos")),
        F.lit('</p><div class="lesahumanidad-ccds-de-una-victima"><ul>'), _list(F.col("ccds"), lambda c: F.concat(F.lit("<li>"), _a("link-ccd", c["url"], c["nombre"]), F.lit("</li>"))), F.lit("</ul></div>"),
        _list(F.col("sentencias"), block), F.lit("</article></html>"),
    )
    return v.select("url", page.alias("html"))


def victims_read(s: SparkSession, d: str) -> DataFrame:
    r = html.extract(victim_pages(s, d), html.victim)
    card = F.array_join(F.array_sort(F.transform(F.map_entries("datos_personales"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    sentence = lambda x: F.concat_ws(
        "~", x["sentencia_nombre"], x["sentencia_url"], F.array_join(F.transform(x["imputados"], lambda i: F.concat_ws("^", i["imputado_nombre"], i["imputado_url"], F.array_join(i["delitos"], ","))), "+")
    )
    return r.select(
        F.col("source_url").alias("url"), "nombre", "imagen_url", "relato_hechos", card.alias("datos"), F.array_join(F.transform("centros_clandestinos", lambda c: F.concat_ws("^", c["nombre"], c["url"])), "+").alias("centros"),
        F.array_join(F.transform("sentencias", sentence), "!").alias("sentencias"),
    )


def accused_read(s: SparkSession, d: str) -> DataFrame:
    i = latest(table(s, d, "imputados"), "imputado_id", "capturado_en", ["nombre", "imagen_url", "mas_informacion", "condenas_recibidas"])
    row = lambda c: F.concat(F.lit("<tr>"), _td("tabla-imputados-condenas-campo-sentencias", _a("link-sentencia", c["sentencia_url"], c["sentencia_nombre"])), _td("tabla-imputados-condenas-campo-sanciones", _html(c["sancion"])), F.lit("</tr>"))
    page = F.concat(
        F.lit('<article class="imputado"><h1>'), _html(F.col("nombre")), F.lit('</h1><div class="lesahumanidad-imputado-contenedor-img"><img src="'), _html(F.col("imagen_url")),
        F.lit('"></div><h4 class="lesahumanidad-imputado-subtitulo">Más</h4><p>'), _html(F.col("mas_informacion")), F.lit('</p><table class="lesahumanidad-tabla-imputados-condenas"><tbody>'),
        _list(F.col("condenas_recibidas"), row), F.lit("</tbody></table></article>"),
    )
    r = html.extract(i.select(F.concat(F.lit("https://h.example/imputado/"), "imputado_id").alias("url"), page.alias("html")), html.accused)
    return r.select(F.col("source_url").alias("url"), "nombre", "imagen_url", "mas_informacion", F.array_join(F.transform("condenas_recibidas", lambda c: F.concat_ws("^", c["sentencia_nombre"], c["sentencia_url"], c["sancion"])), "+").alias("condenas"))


def centres_read(s: SparkSession, d: str) -> DataFrame:
    c = latest(table(s, d, "ccds"), "id_ccd", "actualizado_en", ["denominacion", "ubicacion", "zona", "area"])
    card = F.create_map(F.lit("Zona"), F.coalesce("zona", F.lit("")), F.lit("Área militar"), F.coalesce("area", F.lit("")))
    page = F.concat(
        F.lit('<article class="centrodetencion"><h1>'), _html(F.col("denominacion")), F.lit("</h1>"), _card(card, "ficha-items-ccd"),
        F.lit('<div class="lesahumanidad-datos-ccd"><h4 class="lesahumanidad-ccd-subtitulo">Ubicación</h4><p>'), _html(F.col("ubicacion")), F.lit("</p></div></article>"),
    )
    r = html.extract(c.select(F.concat(F.lit("https://h.example/centro/"), "id_ccd").alias("url"), page.alias("html")), html.centre)
    return r.select(F.col("source_url").alias("url"), "titulo", F.col("metadatos")["Zona"].alias("zona"), F.col("metadatos")["Área militar"].alias("area"), F.col("secciones")["Ubicación"].alias("ubicacion"))


def sentences_read(s: SparkSession, d: str) -> DataFrame:
    """One page per victim and sentence."""
    v = _victims(s, d).select("victima_id", "nombre", F.posexplode("sentencias").alias("k", "x")).where("x is not null")
    row = lambda i: F.concat(
        F.lit("<tr>"), _td("tabla-sentencias-victimas-imputados-campo-imputado", F.concat(F.lit('<a href="'), _html(i["imputado_url"]), F.lit('">'), _html(i["imputado_nombre"]), F.lit("</a>"))),
        _td("tabla-sentencias-victimas-imputados-campo-delitos", _crimes(i["delitos"])), F.lit("</tr>"),
    )
    page = F.concat(
        F.lit('<article class="sentencia"><h1>'), _html(F.col("x.sentencia_nombre")), F.lit('</h1><div class="lesahumanidad-ficha-items-sentencia"><ul><li><strong>Tribunal:</strong> A</li></ul></div>'),
        F.lit('<div class="lesahumanidad-agrupamiento-tabla-sentencia">'), _a("link-victima", F.lit("/v"), F.col("nombre")), F.lit('</div><table class="lesahumanidad-tabla-sentencias-victimas-imputados"><tbody>'),
        _list(F.col("x.imputados"), row), F.lit("</tbody></table></article>"),
    )
    r = html.extract(v.select(F.concat(F.lit("https://h.example/sentencia/"), "victima_id", F.lit("-"), "k").alias("url"), page.alias("html")), html.sentence)
    one = F.col("victimas_e_imputados")[0]
    return r.select(F.col("url_detalle").alias("url"), "titulo", F.col("datos_tecnicos")["tribunal"].alias("tribunal"), one["victima_nombre"].alias("victima"), one["victima_url"].alias("victima_url"), F.array_join(F.transform(one["imputados"], lambda i: F.concat_ws("^", i["imputado_nombre"], i["imputado_url"], F.array_join(i["delitos"], ","))), "+").alias("imputados"))


PER_LIST = 20


def list_pages(s: SparkSession, d: str) -> DataFrame:
    """(url, html) of list pages, each with the links of a block of records, one of them twice, and a link to the next."""
    ids = table(s, d, "victimas").where("victima_id is not null").select("victima_id").distinct()
    block = F.floor(F.col("victima_id") / PER_LIST)
    per = ids.groupBy(block.alias("b")).agg(F.array_sort(F.collect_list("victima_id")).alias("ids"))
    last = ids.agg(F.max(block).alias("m")).collect()[0]["m"] or 0
    link = lambda i: F.concat(F.lit('<a class="lesahumanidad-link-btn-ver-mas" href="/victima/'), i.cast("string"), F.lit('">Ver más</a>'))
    every = s.range(0, last + 1).withColumnRenamed("id", "b").join(per, "b", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<bigint>")))
    following = F.when(F.col("b") < last, F.concat(F.lit('<a class="next" href="/lista?p='), (F.col("b") + 1).cast("string"), F.lit('">'))).otherwise(F.lit(""))
    page = F.concat(F.lit("<div>"), F.array_join(F.transform(F.concat("ids", F.slice("ids", 1, 1)), link), ""), F.lit("</div>"), following)
    return every.select(F.concat(F.lit("https://h.example/lista?p="), F.col("b").cast("string")).alias("url"), page.alias("html"))


def links_read(s: SparkSession, d: str) -> DataFrame:
    pages = list_pages(s, d)
    r = pages.select("url", "html")
    return html.extract(r, html.list_links).select(F.array_join("enlaces", ";").alias("enlaces"), "siguiente")


def crawled(s: SparkSession, d: str) -> DataFrame:
    """From the last ten list pages' first one on: every detail page they lead to, with its name."""
    lists = cut(list_pages(s, d))
    start = lists.orderBy(F.regexp_extract("url", r"(\d+)$", 1).cast("long").desc()).limit(10).orderBy(F.regexp_extract("url", r"(\d+)$", 1).cast("long")).limit(1).select("url")
    pages = cut(lists.unionByName(victim_pages(s, d)))
    return html.crawl(pages, start, html.victim).select(F.col("source_url").alias("url"), "nombre")


def edit_distances(s: SparkSession, d: str) -> DataFrame:
    from ..functions.text import slug

    det = latest(table(s, d, "detalles"), "registro", "actualizado_en", ["nombre", "apellido", "nombre_completo"])
    a, b = slug(F.coalesce("nombre_completo", F.lit(""))), slug(F.concat_ws(" ", "nombre", "apellido"))
    return det.select("registro", F.levenshtein(a, b, 1).alias("distancia"))


def cleaned(s: SparkSession, d: str) -> DataFrame:
    """A graph table loaded, and loaded again from fewer rows: nothing of the first load stays."""
    where = _place(s, "grafo")
    p = cut(merged(s, d))
    p.write.mode("overwrite").parquet(where)
    p.where("es_nietx").write.mode("overwrite").parquet(where)
    return s.read.schema(p.schema).parquet(where)


QUERIES: dict[str, Query] = {
    "ref_s1_json_arrays": json_arrays,
    "ref_s2_direct_sources": direct,
    "ref_s3_empty": nothing,
    "ref_s4_from_catalog": from_catalog,
    "ref_s6_flat_catalog": flat_catalog,
    "ref_s7_latin1_csv": lambda s, d: _sites(s, d, "ISO-8859-1"),
    "ref_s8_sites_csv": lambda s, d: _sites(s, d, "UTF-8"),
    "ref_s10_crawl": crawled,
    "ref_h1_centres": centres_read,
    "ref_h2_victims": victims_read,
    "ref_h3_accused": accused_read,
    "ref_h4_sentences": sentences_read,
    "ref_h5_links": links_read,
    "ref_h8_crime_lists": crime_lists,
    "ref_k13_clean": cleaned,
    "ref_k15_save": saved,
    "ref_p13_merge": merged,
    "ref_p14_partitions": parted,
    "ref_j8_known_keys": known_keys,
    "ref_j15_edit_distance": edit_distances,
}
