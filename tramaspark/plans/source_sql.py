"""The queries of source_queries.py in SQL: what each source's reader should find."""

from __future__ import annotations

from .reference_sql import BASE, DET, EAA, GAZ, NIE, VIC, newest, slug

WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]+"


def said(x: str) -> str:
    """The text of an element: without white space at its ends."""
    return f"regexp_replace(coalesce({x}, ''), '^{WS}|{WS}$', '', 'g')"


def href(x: str) -> str:
    return said(x)


def crimes(x: str, keep: bool) -> str:
    parts = f"list_transform(string_split(coalesce(array_to_string({x}, ', '), ''), ','), lambda t: {said('t')})"
    return parts if keep else f"list_filter({parts}, lambda t: t <> '')"


def people(x: str, keep: bool, crime: str = "delitos") -> str:
    shown = f"array_to_string({crimes(f'coalesce(i.{crime}, [])', keep)}, ',')"
    return f"array_to_string(list_transform(list_filter(coalesce({x}, []), lambda i: i IS NOT NULL), lambda i: {said('i.imputado_nombre')} || '^' || {href('i.imputado_url')} || '^' || {shown}), '+')"


IMP = newest("imp", "imputados", "imputado_id", "capturado_en")
CEN = newest("c", "ccds", "id_ccd", "actualizado_en")
LISTS = """ids AS (SELECT DISTINCT victima_id AS i FROM victimas WHERE victima_id IS NOT NULL), l AS (SELECT b, (SELECT max(i // 20) FROM ids) AS m FROM range(0, (SELECT max(i // 20) + 1 FROM ids)) r(b)),
    e AS (SELECT b, m, (SELECT string_agg('https://h.example/victima/' || i, ';' ORDER BY i) FROM ids WHERE i // 20 = b) AS enlaces FROM l)"""

SQL: dict[str, str] = {
    "ref_s1_json_arrays": f"WITH {NIE} SELECT id_nietx, nombre_completo, estado, restituido.ADN AS \"ADN\", restituido.\"Restitución\" AS restitucion, busqueda.mes AS mes FROM nie",
    "ref_s2_direct_sources": BASE + 'SELECT persona_key, nombre, caso, ADN AS "ADN" FROM gra',
    "ref_s3_empty": "SELECT unnest(['personas', 'lugares', 'relaciones_interpersonales', 'eventos_espaciales', 'jerarquias']) AS tabla, 0 AS filas",
    "ref_s4_from_catalog": f"WITH {GAZ} SELECT name, level, province, department FROM gaz",
    "ref_s6_flat_catalog": "SELECT georef_id AS id, localidad AS nombre, provincia AS provincia_id, departamento AS departamento_id FROM georef_localidades",
    "ref_s7_latin1_csv": f"""WITH {EAA} SELECT nullif("PROVINCIA", '') AS "PROVINCIA", nullif("LOCALIDAD", '') AS "LOCALIDAD", nullif("Lat", '') AS lat, nullif("Long", '') AS lon, "Suma de CASOS" AS casos FROM eaa WHERE regexp_full_match(concat("PROVINCIA", "LOCALIDAD", "CEM - CCD - EP", "LUGAR DE HALLAZGO", "HOJA DE REFERENCIA", "Lat", "Long"), '[\\x{{00}}-\\x{{FF}}]*', 's')""",
    "ref_s8_sites_csv": f"""WITH {EAA} SELECT nullif("PROVINCIA", '') AS "PROVINCIA", nullif("LOCALIDAD", '') AS "LOCALIDAD", nullif("Lat", '') AS lat, nullif("Long", '') AS lon, "Suma de CASOS" AS casos FROM eaa""",
    "ref_s10_crawl": f"WITH {VIC} SELECT 'https://h.example/victima/' || victima_id AS url, {said('nombre')} AS nombre FROM vic WHERE victima_id // 20 >= (SELECT greatest(max(victima_id // 20) - 9, 0) FROM vic)",
    "ref_h1_centres": f"WITH {CEN} SELECT 'https://h.example/centro/' || id_ccd AS url, {said('denominacion')} AS titulo, {said('zona')} AS zona, {said('area')} AS area, {said('ubicacion')} AS ubicacion FROM c",
    "ref_h2_victims": f"""WITH {VIC} SELECT 'https://h.example/victima/' || victima_id AS url, {said('nombre')} AS nombre, coalesce(imagen_url, '') AS imagen_url, {said('relato_hechos')} AS relato_hechos,
        coalesce(array_to_string(list_sort(list_transform(map_entries(datos_personales), lambda e: replace(lower({said('e.key')}), ' ', '_') || '=' || {said('e.value')})), ';'), '') AS datos,
        array_to_string(list_transform(list_filter(coalesce(ccds, []), lambda c: c IS NOT NULL), lambda c: {said('c.nombre')} || '^' || {href('c.url')}), '+') AS centros,
        array_to_string(list_transform(list_filter(coalesce(sentencias, []), lambda x: x IS NOT NULL), lambda x: {said('x.sentencia_nombre')} || '~' || {href('x.sentencia_url')} || '~' || {people('x.imputados', True)}), '!') AS sentencias FROM vic""",
    "ref_h3_accused": f"""WITH {IMP} SELECT 'https://h.example/imputado/' || imputado_id AS url, {said('nombre')} AS nombre, coalesce(imagen_url, '') AS imagen_url, {said('mas_informacion')} AS mas_informacion,
        array_to_string(list_transform(list_filter(coalesce(condenas_recibidas, []), lambda c: c IS NOT NULL), lambda c: {said('c.sentencia_nombre')} || '^' || {href('c.sentencia_url')} || '^' || {said('c.sancion')}), '+') AS condenas FROM imp""",
    "ref_h4_sentences": f"""WITH {VIC}, p AS (SELECT victima_id, nombre, k, sentencias[k + 1] AS x FROM (SELECT victima_id, nombre, sentencias, unnest(range(len(sentencias))) AS k FROM vic))
        SELECT 'https://h.example/sentencia/' || victima_id || '-' || k AS url, {said('x.sentencia_nombre')} AS titulo, 'A' AS tribunal, {said('nombre')} AS victima, 'https://h.example/v' AS victima_url, {people('x.imputados', False)} AS imputados FROM p WHERE x IS NOT NULL""",
    "ref_h5_links": f"WITH {LISTS} SELECT coalesce(enlaces, '') AS enlaces, CASE WHEN b < m THEN 'https://h.example/lista?p=' || (b + 1) END AS siguiente FROM e",
    "ref_h8_crime_lists": f"""WITH {VIC}, s AS (SELECT victima_id, k, sentencias[k + 1].imputados AS im FROM (SELECT victima_id, sentencias, unnest(range(len(sentencias)))::INT AS k FROM vic)), i AS (SELECT victima_id, k, j, im[j + 1].delitos AS d FROM (SELECT victima_id, k, im, unnest(range(len(im)))::INT AS j FROM s)),
        t AS (SELECT victima_id, k, j, list_transform(string_split(array_to_string(list_transform(d, lambda x: coalesce(x, ' ')), ' , '), ','), lambda x: trim(x)) AS p FROM i WHERE d IS NOT NULL)
        SELECT victima_id, k, j, array_to_string(p, '|') AS con_blancos, array_to_string(list_filter(p, lambda x: x <> ''), '|') AS sin_blancos FROM t""",
    "ref_k13_clean": BASE + "SELECT persona_key, nombre, fuente, es_nietx FROM todos WHERE es_nietx",
    "ref_k15_save": f"WITH {NIE} SELECT id_nietx, nombre_completo FROM nie",
    "ref_p13_merge": BASE + "SELECT persona_key, nombre, fuente, es_nietx FROM todos",
    "ref_p14_partitions": BASE + "SELECT 'personas/' || fuente || '/' || es_nietx AS parte, count(*) AS filas FROM todos GROUP BY 1 UNION ALL SELECT 'jerarquias/' || coalesce(tipo_relacion, '-'), count(*) FROM jerarquias GROUP BY 1",
    "ref_j8_known_keys": "SELECT DISTINCT parent_key AS clave FROM jerarquias WHERE tipo_relacion = 'PARTE_DE' AND parent_key <> '' AND parent_key IN (SELECT child_key FROM jerarquias WHERE tipo_relacion = 'PARTE_DE' AND child_key <> '')",
    "ref_j15_edit_distance": f"WITH {DET}, t AS (SELECT registro, {slug("coalesce(nombre_completo, '')")} AS a, {slug("concat_ws(' ', nombre, apellido)")} AS b FROM det) SELECT registro, CASE WHEN levenshtein(a, b) <= 1 THEN levenshtein(a, b) ELSE -1 END AS distancia FROM t",
}
