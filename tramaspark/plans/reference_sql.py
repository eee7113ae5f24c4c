"""The queries of reference.py in SQL, as a second statement of each."""

from __future__ import annotations

WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]+"


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def plain(x: str) -> str:
    several = f"replace(replace(replace(strip_accents({x}), '½', '1⁄2'), '¼', '1⁄4'), '¾', '3⁄4')"
    return f"translate({several}, 'ªº¹²³µ¨¯´¸', 'ao123μ    ')"


def slug(x: str) -> str:
    inner = f"regexp_replace({plain(f'lower({x})')}, '[^a-z0-9\\s]', ' ', 'g')"
    return f"replace({norm(inner)}, ' ', '_')"


def clean(x: str) -> str:
    return f"CASE WHEN {norm(x)} NOT IN ('', '-', 'No hay informacion.', 'No hay información.') THEN {norm(x)} END"


def geo(x: str) -> str:
    inner = f"regexp_replace({plain(f'upper({x})')}, '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g')"
    return norm(inner)


def place(x: str) -> str:
    inner = f"regexp_replace({plain(f'upper({x})')}, '[^A-Z0-9\\s]', ' ', 'g')"
    return norm(inner)


def newest(name: str, table: str, key: str, ts: str) -> str:
    return f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ts} DESC) rn FROM {table} WHERE {key} IS NOT NULL) WHERE rn = 1)"


DET = newest("det", "detalles", "registro", "actualizado_en")
NIE = newest("nie", "nietxs", "id_nietx", "cargado_en")
REL = newest("rel", "relaciones", "relacion_id", "cargado_en")
VIC = newest("vic", "victimas", "victima_id", "capturado_en")
EAA = newest("eaa", "eaaf_lugares", "sitio_id", "cargado_en")
CCD = newest("ccd", f"(SELECT *, {clean('id_ccd')} AS id FROM ccds)", "id", "actualizado_en")


def iso(text: str, fmt: str) -> str:
    return f"strftime(try_strptime({text}, '{fmt}'), '%Y-%m-%d')"


def start(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '\\d{{4}}/\\d{{2}}/\\d{{2}}') THEN {iso(x, '%Y/%m/%d')} WHEN regexp_full_match({x}, '\\d{{4}}/\\d{{2}}') THEN {iso(x + " || '/01'", '%Y/%m/%d')} "
        f"WHEN regexp_full_match({x}, '\\d{{4}}') AND {x} > '0000' THEN {x} || '-01-01' END"
    )


def earliest(x: str) -> str:
    texts = f"list_filter(list_transform({x}, lambda v: trim(v)), lambda v: v <> '')"
    starts = f"list_filter(list_transform({texts}, lambda v: {start('v')}), lambda v: v IS NOT NULL)"
    return f"CASE WHEN len({texts}) > 0 THEN coalesce(list_min({starts}), array_to_string({texts}, ' | ')) END"


PER = f"""
per AS (SELECT 'registro:' || registro AS persona_key, registro, {clean('nombre_completo')} AS nombre,
    CASE WHEN lower({clean('Sexo')}) LIKE '%masc%' THEN 'MASCULINO' WHEN lower({clean('Sexo')}) LIKE '%fem%' THEN 'FEMENINO' ELSE 'INDETERMINADO' END AS genero,
    'detalles_personas' AS fuente, {clean('descripcion_estado')} AS estado FROM det)"""
GRA = f"""
gra AS (SELECT 'nietx:' || id_nietx AS persona_key, id_nietx, {clean('nombre_completo')} AS nombre, coalesce({clean('nombre_completo')}, 'Caso ' || id_nietx) AS caso,
    coalesce({clean('restituido.ADN')}, 'SÍ') AS ADN, {clean('restituido.ADN')} IS NULL AS adn_imputed, {clean('estado')} AS estado, {clean('restituido."Restitución"')} AS restitucion FROM nie)"""
ALL = "todos AS (SELECT persona_key, nombre, fuente, false AS es_nietx FROM per UNION ALL SELECT persona_key, nombre, 'nietxs_relacion', true FROM gra)"
RULE = """CASE WHEN word = 'madre' THEN 'MADRE_DE' WHEN word = 'padre' THEN 'PADRE_DE' WHEN word IN ('hijo', 'hija') THEN 'HIJE_DE' WHEN word LIKE '%abuela%' THEN 'ABUELX_DE'
    WHEN word IN ('hermano', 'hermana', 'hermanx') THEN 'HERMANX_DE' WHEN word IN ('esposo', 'esposa', 'conyuge', 'pareja', 'companero', 'companera', 'novio', 'novia', 'ex esposo', 'ex esposa') THEN 'PAREJA_DE'
    WHEN word IN ('cunado', 'cunada', 'cuñado', 'cuñada') THEN 'CUÑADX_DE' WHEN word IN ('suegro', 'suegra') THEN 'SUEGRX_DE' WHEN word IN ('yerno', 'nuera') THEN 'YERNX_NUERX_DE' END"""


def kin(rows: str, source: str) -> str:
    turned = "tipo IN ('MADRE_DE', 'PADRE_DE', 'HIJE_DE', 'ABUELX_DE', 'SUEGRX_DE', 'YERNX_NUERX_DE')"
    pick = lambda a, b: f"CASE WHEN {turned} THEN {a} ELSE {b} END"
    return (
        f"SELECT {pick('other', 'k')} AS source_key, {pick('other_name', 'name')} AS source_nombre, {pick('k', 'other')} AS target_key, {pick('name', 'other_name')} AS target_nombre, tipo, "
        f"'{source}' AS fuente, 'DESCONOCIDA' AS fecha FROM (SELECT *, {RULE} AS tipo FROM ({rows})) WHERE tipo IS NOT NULL"
    )


KIN_N = f"""kn AS ({kin(f'''SELECT 'nietx:' || r.id_nietx AS k, coalesce(g.nombre, 'Nietx ' || r.id_nietx) AS name, coalesce('registro:' || id_persona, 'nombre:' || {slug(clean('nombre_completo_relacion'))}) AS other,
    {clean('nombre_completo_relacion')} AS other_name, lower({clean('relacion')}) AS word FROM rel r JOIN gra g ON r.id_nietx = g.id_nietx WHERE {clean('nombre_completo_relacion')} IS NOT NULL''', 'nietxs_relacion')})"""
KIN_D = f"""kd AS ({kin(f'''SELECT 'registro:' || registro AS k, coalesce({clean('nc')}, 'Registro ' || registro) AS name, coalesce('registro:' || r.registro, 'nombre:' || {slug(clean('r.nombre_completo'))}) AS other,
    {clean('r.nombre_completo')} AS other_name, lower({clean('r.relacion')}) AS word FROM (SELECT registro, nombre_completo AS nc, unnest(victimas_relacionadas_red) r FROM det) WHERE {clean('r.nombre_completo')} IS NOT NULL''', 'detalles_personas')})"""
KIN = f"{REL}, {KIN_N}, {KIN_D}, kin AS (SELECT * FROM kn UNION ALL SELECT * FROM kd)"
REF = f"ref AS (SELECT registro, {clean('c.id_ccd')} AS id, {clean('c.relacion')} AS relacion, c.fecha AS fechas FROM (SELECT registro, unnest(ccds) c FROM det) WHERE {clean('c.id_ccd')} IS NOT NULL)"
CEN = f"""cen AS (SELECT 'lugar:CCD:' || {slug('id')} AS lugar_key, upper(coalesce({clean('denominacion')}, 'CCD ' || id)) AS nombre, 'CCD' AS tipo, id AS id_ccd, {clean('zona')} AS zona, {clean('jurisdiccion')} AS jurisdiccion,
    {clean('ubicacion')} AS ubicacion, lat, lon FROM ccd WHERE id IN (SELECT id FROM ref))"""
EVE = f"""eve AS (SELECT 'registro:' || registro AS persona_key, 'lugar:CCD:' || {slug('id')} AS lugar_key, CASE WHEN lower(relacion) = 'pario_en' THEN 'PARIO_EN' ELSE 'PRESENTE_EN' END AS tipo_relacion,
    coalesce({earliest('fechas')}, 'DESCONOCIDA') AS fecha, 'ccds_json' AS origen FROM ref WHERE id IN (SELECT {clean('id_ccd')} FROM ccds))"""
ADR = "adr AS (SELECT 'direccion_ccd:ccd:' || id_ccd AS k, coalesce(ubicacion, nombre) AS direccion, lugar_key FROM cen)"
BASE = f"WITH {DET}, {NIE}, {PER}, {GRA}, {ALL}, {KIN}, {CCD}, {REF}, {CEN}, {EVE}, {ADR}, exa AS (SELECT k.p AS placeholder_key, n.persona_key AS candidate_key, 'slug_exacto' AS metodo, CASE WHEN n.c = 1 THEN 1.0 ELSE 0.7 END::DOUBLE AS score, n.slug, CASE WHEN n.c = 1 THEN 'alta' ELSE 'media' END AS confianza FROM (SELECT DISTINCT p FROM (SELECT source_key p FROM kin UNION ALL SELECT target_key FROM kin) WHERE p LIKE 'nombre:%') k JOIN (SELECT persona_key, {slug('nombre')} AS slug, count(*) OVER (PARTITION BY {slug('nombre')}) AS c FROM per WHERE nombre <> '') n ON k.p = 'nombre:' || n.slug) "
CAN = "WITH can AS (SELECT * FROM candidatos WHERE placeholder_key <> '' AND candidate_key <> '') "
YEAR = "year(try_strptime(fecha, '%Y-%m-%d'))"
PAR = "par AS (SELECT DISTINCT child_key, parent_key FROM jerarquias WHERE tipo_relacion = 'PARTE_DE' AND child_key <> '' AND parent_key <> '')"


def function(column: str, expression: str) -> str:
    return f'WITH {DET} SELECT registro, {expression.replace("@", f"{chr(34)}{column}{chr(34)}")} AS valor FROM det'


def tokens(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in "de del la las el los y mr mrs miss ms da junior jr das di van der dos filho do".split())
    return f"array_to_string(list_sort(list_distinct(list_filter(string_split(replace({slug(x)}, '_', ' '), ' '), lambda w: length(w) > 1 AND w NOT IN ({stop})))), ' ')"


GAZ = f"""gaz AS (SELECT DISTINCT {geo('localidad')} AS name, 'LOCALIDAD' AS level, {geo('provincia')} AS province, {geo('departamento')} AS department, georef_id FROM georef_localidades
    UNION ALL SELECT DISTINCT {geo('departamento')}, 'DEPARTAMENTO', {geo('provincia')}, {geo('departamento')}, '' FROM georef_localidades UNION ALL SELECT DISTINCT {geo('provincia')}, 'PROVINCIA', {geo('provincia')}, NULL, '' FROM georef_localidades)"""
LOC = f"loc AS (SELECT DISTINCT {place("concat_ws(' ', LOCALIDAD, PROVINCIA)")} AS alias FROM eaa)"
GRAM = """w AS (SELECT alias, string_split(alias, ' ') AS t FROM loc WHERE alias <> ''), pos AS (SELECT alias, t, unnest(range(len(t))) AS i FROM w), gr AS (SELECT alias, t, i, k, array_to_string(t[i + 1 : i + k], ' ') AS gram FROM pos, range(1, 7) r(k) WHERE i + k <= len(t)),
g AS (SELECT * FROM gr WHERE k > 1 OR length(gram) >= 4)"""
HITS = f"WITH {EAA}, {GAZ}, {LOC}, {GRAM}, said AS (SELECT DISTINCT alias, name AS province FROM loc JOIN gaz ON ' ' || alias || ' ' LIKE '% ' || name || ' %' WHERE level = 'PROVINCIA' AND length(name) >= 4) "
FAM = "'HIJE_DE','PADRE_DE','MADRE_DE','NIETX_DE','ABUELX_DE','HERMANX_DE','PAREJA_DE','CUÑADX_DE','SUEGRX_DE','YERNX_NUERX_DE'"

SQL: dict[str, str] = {
    "ref_f1_norm_space": function("nombre_completo", norm("@")),
    "ref_f2_strip_accents": function("nombre_completo", plain("@")),
    "ref_f3_slug": function("nombre_completo", slug("@")),
    "ref_f4_clean_text": function("Sexo", clean("@")),
    "ref_f5_name_key": function("nombre_completo", "'nombre:' || " + slug("@")),
    "ref_f6_iso_from_dmy": function("descripcion_fecha_nacimiento", f"CASE WHEN regexp_full_match(trim(@), '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN {iso('trim(@)', '%d/%m/%Y')} END"),
    "ref_f7_long_date": f"""WITH {VIC}, t AS (SELECT victima_id, lower(datos_personales['fecha_de_nacimiento']) AS x FROM vic), m AS (SELECT victima_id, regexp_extract(x, '^(\\d{{1,2}}) de ([a-z]+) de (\\d{{4}})$', ['d', 'm', 'y']) AS p FROM t)
        SELECT victima_id, CASE WHEN p.d <> '' THEN {iso("p.y || '-' || list_position(['enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre'], p.m) || '-' || p.d", '%Y-%m-%d')} END AS valor FROM m""",
    "ref_f8_partial_date": f"""WITH {DET}, c AS (SELECT registro, pos, ccds[pos + 1].fecha AS f FROM (SELECT registro, ccds, unnest(range(len(ccds)))::INT pos FROM det)), f AS (SELECT registro, pos, k, trim(f[k + 1]) AS x FROM (SELECT registro, pos, f, unnest(range(len(f)))::INT k FROM c) WHERE f[k + 1] IS NOT NULL)
        SELECT registro, pos, k, {start('x')} AS desde, CASE WHEN length(x) = 10 THEN {start('x')} WHEN length(x) = 7 THEN strftime(last_day(try_strptime(x || '/01', '%Y/%m/%d')), '%Y-%m-%d') WHEN {start('x')} IS NOT NULL THEN x || '-12-31' END AS hasta,
        CASE WHEN {start('x')} IS NOT NULL THEN CASE length(x) WHEN 10 THEN 'DAY' WHEN 7 THEN 'MONTH' ELSE 'YEAR' END END AS grano FROM f""",
    "ref_f9_earliest_date": f"WITH {DET}, c AS (SELECT registro, pos, ccds[pos + 1].fecha AS f FROM (SELECT registro, ccds, unnest(range(len(ccds)))::INT pos FROM det)) SELECT registro, pos, {earliest('f')} AS fecha FROM c",
    "ref_f10_to_float": function("Edad", "try_cast(trim(@) AS DOUBLE)"),
    "ref_f11_first_int": function("Lugar de nacimiento", f"try_cast(nullif(regexp_extract({clean('@')}, '\\d+'), '') AS INT)"),
    "ref_f12_pregnancy": f"WITH {DET}, t AS (SELECT registro, {clean('Edad')} AS x FROM det) SELECT registro, CASE WHEN x IS NULL THEN 'NO_INFO' WHEN {plain('lower(x)')} = 'si' THEN 'SI' WHEN x SIMILAR TO '.*\\d.*' THEN 'MESES' ELSE 'OTRO' END AS tipo, CASE WHEN {plain('lower(x)')} <> 'si' THEN try_cast(nullif(regexp_extract(x, '\\d+'), '') AS INT) END AS meses FROM t",
    "ref_f13_relation_kind": f"""WITH {REL}, t AS (SELECT relacion_id, {norm(f"regexp_replace({plain('lower(relacion)')}, '[.,;:_-]+', ' ', 'g')")} AS w FROM rel) SELECT relacion_id, CASE WHEN w = 'madre' THEN 'MADRE' WHEN w = 'padre' THEN 'PADRE' WHEN w IN ('hermanx', 'hermano', 'hermana') THEN 'HERMANO'
        WHEN w = 'abuela materna' THEN 'ABUELA_MATERNA' WHEN w = 'abuela paterna' THEN 'ABUELA_PATERNA' WHEN w IN ('hijo', 'hija') THEN 'HIJO' WHEN w IN ('esposo', 'esposa', 'conyuge', 'pareja', 'ex esposo', 'ex esposa', 'companero', 'companera', 'novio', 'novia') THEN 'PAREJA' ELSE 'OTRA' END AS tipo FROM t""",
    "ref_f14_geo_name": function("Lugar de nacimiento", geo("@")),
    "ref_f15_place_text": function("Lugar de nacimiento", place("@")),
    "ref_f16_coordinates": f"WITH {newest('c', 'ccds', 'id_ccd', 'actualizado_en')} SELECT id_ccd, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat || ',' || lon ELSE 'DESCONOCIDAS' END AS coordenadas, lat IS NOT NULL AND lon IS NOT NULL AS conocidas, lat FROM c",
    "ref_f17_scoped_key": function("nombre_completo", "substr(sha1(concat_ws('|', @, 'x')), 1, 20)"),
    "ref_j14_name_tokens": function("nombre_completo", tokens("@")),
    "ref_h7_label_key": f"WITH {VIC} SELECT replace(lower(trim(replace(e, ':', ''))), ' ', '_') AS clave, count(*) AS n FROM (SELECT unnest(map_keys(datos_personales)) e FROM vic) GROUP BY 1",
    "ref_h8_split_list": "SELECT mas_informacion, count(*) AS n, array_to_string(list_filter(list_transform(string_split(mas_informacion, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS partes FROM imputados WHERE mas_informacion IS NOT NULL GROUP BY mas_informacion",
    "ref_h9_plain_blanks": function("nombre_completo", "trim(replace(@, chr(160), ' '))"),
    "ref_s4_gazetteer": f"WITH {GAZ} SELECT name, level, province, department FROM gaz",
    "ref_p1_personas": BASE + "SELECT persona_key, registro, nombre, genero, fuente FROM per",
    "ref_p2_protagonistas": BASE + "SELECT persona_key, nombre, caso, ADN, adn_imputed FROM gra",
    "ref_p3_kin_nietxs": BASE + "SELECT * FROM kn",
    "ref_p4_kin_detalles": BASE + "SELECT * FROM kd",
    "ref_p9_typed_places": f"""WITH {DET}, t AS (SELECT registro, 'descripcion_lugar_de_secuestro' AS campo, 'SECUESTRADO_EN' AS tipo_relacion, descripcion_lugar_de_secuestro AS raw, {clean('descripcion_fecha_de_secuestro')} AS f FROM det
        UNION ALL SELECT registro, 'lugar_nacimiento', 'NACIO_EN', "Lugar de nacimiento", {clean('descripcion_fecha_nacimiento')} FROM det UNION ALL SELECT registro, 'lugar_asesinato', 'ASESINADO_EN', "Lugar de asesinato", {clean('descripcion_fecha_de_asesinato')} FROM det)
        SELECT registro, campo, tipo_relacion, raw, CASE WHEN regexp_full_match(f, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN {iso('f', '%d/%m/%Y')} END AS fecha FROM t WHERE raw IS NOT NULL""",
    "ref_p10_centros": BASE + "SELECT lugar_key, nombre, id_ccd, zona, jurisdiccion, lat, lon FROM cen",
    "ref_p10_eventos": BASE + "SELECT * FROM eve",
    "ref_k1_upsert_personas": f"""WITH t AS (SELECT 'registro:' || registro AS persona_key, {clean('nombre_completo')} AS nombre, {clean('Sexo')} AS s, {clean('descripcion_apodos')} AS apodo, actualizado_en AS q FROM detalles WHERE registro IS NOT NULL), z AS (SELECT *, row_number() OVER (PARTITION BY persona_key ORDER BY q DESC) rn FROM t)
        SELECT persona_key, max(nombre) FILTER (WHERE rn = 1) AS nombre, max(CASE WHEN lower(s) LIKE '%masc%' THEN 'MASCULINO' WHEN lower(s) LIKE '%fem%' THEN 'FEMENINO' ELSE 'INDETERMINADO' END) FILTER (WHERE rn = 1) AS genero, arg_max(apodo, q) AS apodo FROM z GROUP BY persona_key""",
    "ref_k2_upsert_protagonistas": f"""WITH t AS (SELECT 'nietx:' || id_nietx AS persona_key, {clean('nombre_completo')} AS nombre, {clean('restituido.ADN')} AS ADN, cargado_en AS q FROM nietxs WHERE id_nietx IS NOT NULL), z AS (SELECT *, row_number() OVER (PARTITION BY persona_key ORDER BY q DESC) rn FROM t)
        SELECT persona_key, max(nombre) FILTER (WHERE rn = 1) AS nombre, arg_max(ADN, q) AS ADN, 'Nietx,Persona' AS roles FROM z GROUP BY persona_key""",
    "ref_k3_vertices": BASE + "SELECT DISTINCT k AS persona_key, k LIKE 'nombre:%' AS es_placeholder FROM (SELECT persona_key k FROM todos UNION SELECT source_key FROM kin UNION SELECT target_key FROM kin)",
    "ref_k4_strict_edges": BASE + "SELECT fuente, tipo, count(*) AS n FROM kin WHERE source_key IN (SELECT persona_key FROM todos) GROUP BY fuente, tipo",
    "ref_k5_eventos": BASE + "SELECT tipo_relacion, lugar_key, count(*) AS n FROM eve WHERE persona_key IN (SELECT persona_key FROM per) AND lugar_key IN (SELECT lugar_key FROM cen) GROUP BY tipo_relacion, lugar_key",
    "ref_k6_upsert_lugares": f"""WITH t AS (SELECT 'lugar:CCD:' || {slug('id_ccd')} AS lugar_key, {clean('denominacion')} AS nombre, {clean('zona')} AS zona, lat, lon, actualizado_en AS q FROM ccds WHERE id_ccd IS NOT NULL), z AS (SELECT *, row_number() OVER (PARTITION BY lugar_key ORDER BY q DESC) rn FROM t)
        SELECT lugar_key, max(nombre) FILTER (WHERE rn = 1) AS nombre, arg_max(zona, q) AS zona, arg_max(lat, q) AS lat, arg_max(lon, q) AS lon, arg_max(lat, q) IS NOT NULL AND arg_max(lon, q) IS NOT NULL AS con_punto FROM z GROUP BY lugar_key""",
    "ref_k7_parte_de": f"WITH {PAR} SELECT child_key, parent_key, 'ETERNA' AS fecha FROM par",
    "ref_k8_alias": f"WITH t AS (SELECT {place('LOCALIDAD')} AS alias_norm, coalesce({geo('PROVINCIA')}, '__ROOT__') AS parent_key, sitio_id, (cargado_en, sitio_id) AS q FROM eaaf_lugares) SELECT alias_norm, parent_key, arg_max(sitio_id, q) AS lugar_key, arg_min(sitio_id, q) AS alias_key FROM t WHERE alias_norm <> '' GROUP BY alias_norm, parent_key",
    "ref_k9_direcciones": "SELECT direccion_ccd_key, lugar_key FROM (SELECT *, row_number() OVER (PARTITION BY direccion_ccd_key ORDER BY cargado_en DESC, fila_id DESC) rn FROM jerarquias WHERE tipo_relacion = 'UBICADA_EN' AND direccion_ccd_key IS NOT NULL) WHERE rn = 1",
    "ref_k10_ubicada_en": "SELECT DISTINCT direccion_ccd_key, lugar_key FROM jerarquias WHERE tipo_relacion = 'UBICADA_EN' AND direccion_ccd_key <> '' AND lugar_key <> ''",
    "ref_k11_candidatos": CAN + "SELECT placeholder_key, candidate_key, metodo, score, confianza FROM (SELECT *, row_number() OVER (PARTITION BY placeholder_key, candidate_key, metodo ORDER BY creado_en DESC, score DESC, confianza DESC) rn FROM can WHERE metodo IS NOT NULL) WHERE rn = 1",
    "ref_k12_redirect": f"WITH {PAR}, k AS (SELECT DISTINCT key, regexp_replace(key, '_\\d+$', '') AS n FROM (SELECT child_key key FROM par UNION SELECT parent_key FROM par)), m AS (SELECT key, min(key) OVER (PARTITION BY n) AS t FROM k) SELECT DISTINCT a.t AS child_key, b.t AS parent_key FROM par JOIN m a ON child_key = a.key JOIN m b ON parent_key = b.key",
    "ref_k14_constraints": "SELECT 'detalles' AS tabla, 'existencia' AS regla, c AS columna, n AS filas FROM (SELECT 'registro' c, count(*) FILTER (WHERE registro IS NULL) n FROM detalles UNION ALL SELECT 'nombre', count(*) FILTER (WHERE nombre IS NULL) FROM detalles UNION ALL SELECT 'Nacionalidad', count(*) FILTER (WHERE Nacionalidad IS NULL) FROM detalles) UNION ALL SELECT 'detalles', 'unicidad', 'registro', count(*) FROM (SELECT registro FROM detalles WHERE registro IS NOT NULL GROUP BY registro HAVING count(*) > 1)",
    "ref_j1_gazetteer_hits": HITS + "SELECT DISTINCT alias, name, arg_min(level, CASE level WHEN 'LOCALIDAD' THEN 1 WHEN 'DEPARTAMENTO' THEN 2 ELSE 3 END) OVER (PARTITION BY alias, name, province, department) AS level, province, department FROM g JOIN gaz ON gram = name WHERE level = 'PROVINCIA' OR alias NOT IN (SELECT alias FROM said) OR (alias, province) IN (SELECT alias, province FROM said)",
    "ref_j2_provinces_said": HITS + "SELECT alias, province FROM said",
    "ref_j3_gazetteer_best": HITS
    + """, m AS (SELECT g.alias, gram AS name, level, z.province, department, georef_id, k, i,
        CASE level WHEN 'LOCALIDAD' THEN 0.80::DOUBLE + least(0.15::DOUBLE, k * 0.02::DOUBLE) WHEN 'DEPARTAMENTO' THEN 0.71::DOUBLE + least(0.12::DOUBLE, k * 0.02::DOUBLE) ELSE 0.75::DOUBLE + least(0.10::DOUBLE, k * 0.02::DOUBLE) END
        + CASE WHEN level = 'PROVINCIA' OR g.alias NOT IN (SELECT alias FROM said) THEN 0::DOUBLE WHEN level = 'LOCALIDAD' THEN 0.06::DOUBLE ELSE 0.05::DOUBLE END
        - CASE WHEN level <> 'PROVINCIA' AND i > 0 AND t[i] IN ('CALLE', 'AV', 'AVENIDA', 'RUTA', 'PASAJE', 'PJE', 'NRO', 'NUMERO') THEN 0.12::DOUBLE ELSE 0::DOUBLE END
        - CASE WHEN level <> 'PROVINCIA' AND regexp_full_match(t[i + k + 1], '[0-9]+') THEN 0.10::DOUBLE ELSE 0::DOUBLE END AS score,
        CASE level WHEN 'LOCALIDAD' THEN 1 WHEN 'DEPARTAMENTO' THEN 3 ELSE 4 END AS r FROM g JOIN gaz z ON gram = z.name
        WHERE level = 'PROVINCIA' OR g.alias NOT IN (SELECT alias FROM said) OR (g.alias, z.province) IN (SELECT alias, province FROM said)),
    b AS (SELECT alias, name, province, department, max(score) AS score, arg_max(level, (round(score, 9), -r)) AS level, min((-k, i, r, coalesce(try_cast(regexp_extract(georef_id, '([0-9]+)', 1) AS INT), 0))) AS first FROM m GROUP BY ALL),
    o AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS s2, lead(province) OVER w AS p2 FROM b WINDOW w AS (PARTITION BY alias ORDER BY round(score, 9) DESC, length(name) DESC, first))
    SELECT alias, name, level, province, department, round(score, 6) AS score FROM o WHERE n = 1 AND score >= 0.76 AND (s2 IS NULL OR score - s2 >= 0.02 OR province = p2)""",
    "ref_j6_context": f"WITH {EAA}, {GAZ}, c AS (SELECT DISTINCT {geo('PROVINCIA')} AS context FROM eaa WHERE {geo('PROVINCIA')} <> '') SELECT context, 'BUENOS AIRES' AS preferred, level, name, province, department FROM (SELECT *, row_number() OVER (PARTITION BY context ORDER BY CASE level WHEN 'DEPARTAMENTO' THEN 1 ELSE 2 END) rn FROM c JOIN gaz ON context = name WHERE level <> 'LOCALIDAD') WHERE rn = 1",
    "ref_j10_exact_candidates": BASE + "SELECT * FROM exa",
    "ref_j12_placeholders": BASE + "SELECT DISTINCT p AS placeholder_key FROM (SELECT source_key p FROM kin UNION ALL SELECT target_key FROM kin) WHERE p LIKE 'nombre:%'",
    "ref_t1_chain_edges": "SELECT georef_id AS child_key, departamento AS parent_key FROM georef_localidades UNION SELECT departamento, provincia FROM georef_localidades",
    "ref_t2_shortcut": "SELECT georef_id AS child_key, provincia AS parent_key FROM georef_localidades UNION SELECT provincia, 'PAIS' FROM georef_localidades",
    "ref_t3_rollup": f"""WITH {EAA}, k AS (SELECT 'lugar:CIUDAD:' || {slug('LOCALIDAD')} AS a, 'lugar:PROVINCIA:' || {slug('PROVINCIA')} AS b FROM eaa WHERE LOCALIDAD IS NOT NULL AND PROVINCIA IS NOT NULL)
        SELECT ancestro, count(*) AS eventos_total FROM (SELECT a || '|' || b || '|lugar:PAIS' AS ancestro FROM k UNION ALL SELECT b || '|lugar:PAIS' FROM k UNION ALL SELECT 'lugar:PAIS' FROM k) GROUP BY ancestro""",
    "ref_a1_hotspots": BASE + "SELECT e.lugar_key, nombre AS lugar, tipo, count(*) AS eventos_total FROM eve e JOIN cen c ON e.lugar_key = c.lugar_key GROUP BY ALL ORDER BY eventos_total DESC, e.lugar_key LIMIT 50",
    "ref_a2_hotspots_by_type": BASE + "SELECT tipo_relacion AS tipo_evento, nombre AS lugar, tipo AS tipo_lugar, count(*) AS eventos_total FROM eve e JOIN cen c ON e.lugar_key = c.lugar_key GROUP BY ALL ORDER BY eventos_total DESC, tipo_evento, lugar LIMIT 100",
    "ref_a3_by_year": BASE + f"SELECT {YEAR}::INT AS anio, count(*) AS eventos_total, count(*) FILTER (WHERE tipo_relacion = 'SECUESTRADO_EN') AS secuestros, count(*) FILTER (WHERE tipo_relacion = 'ASESINADO_EN') AS asesinatos, count(*) FILTER (WHERE tipo_relacion = 'PRESENTE_EN') AS presencias_ccd, count(*) FILTER (WHERE tipo_relacion = 'PARIO_EN') AS partos_ccd FROM eve WHERE {YEAR} IS NOT NULL GROUP BY 1",
    "ref_a4_by_jurisdiction": BASE + f"SELECT {YEAR}::INT AS anio, coalesce(jurisdiccion, nombre) AS jurisdiccion, count(*) AS eventos_total FROM eve e JOIN cen c ON e.lugar_key = c.lugar_key WHERE {YEAR} IS NOT NULL GROUP BY ALL",
    "ref_a5_busiest_people": BASE + "SELECT e.persona_key, coalesce(nombre, e.persona_key) AS persona, count(*) AS eventos_total, count(DISTINCT tipo_relacion) AS tipos_evento_distintos FROM eve e JOIN per p ON e.persona_key = p.persona_key GROUP BY ALL ORDER BY eventos_total DESC, e.persona_key LIMIT 100",
    "ref_a6_multi_site": BASE + "SELECT e.persona_key, coalesce(p.nombre, e.persona_key) AS persona, count(DISTINCT e.lugar_key) AS lugares_distintos, array_to_string(list_sort(list(DISTINCT c.nombre))[1:10], ';') AS muestra_lugares FROM eve e JOIN per p ON e.persona_key = p.persona_key JOIN cen c ON e.lugar_key = c.lugar_key GROUP BY e.persona_key, p.nombre ORDER BY lugares_distintos DESC, e.persona_key LIMIT 100",
    "ref_a7_network": BASE + "SELECT DISTINCT s.persona_key AS source, t.persona_key AS target, coalesce(s.nombre, s.persona_key) AS source_nombre, coalesce(t.nombre, t.persona_key) AS target_nombre FROM (SELECT 'registro:' || registro AS a, 'registro:' || r.registro AS b FROM (SELECT registro, unnest(victimas_relacionadas_red) r FROM det)) x JOIN per s ON a = s.persona_key JOIN per t ON b = t.persona_key ORDER BY source, target LIMIT 500",
    "ref_a8_placeholder_quality": BASE + "SELECT count(*) AS placeholders_total, count(n) AS placeholders_con_candidato, coalesce(sum(n), 0)::BIGINT AS relaciones_candidato_total, round(sum(s) / sum(n), 9) AS score_promedio FROM (SELECT DISTINCT p FROM (SELECT source_key p FROM kin UNION ALL SELECT target_key FROM kin) WHERE p LIKE 'nombre:%') h LEFT JOIN (SELECT placeholder_key, count(*) n, sum(score) s FROM exa GROUP BY placeholder_key) ON p = placeholder_key",
    "ref_a9_ambiguous": CAN + "SELECT placeholder_key AS placeholder, count(*) AS candidatos, max(score) AS mejor_score, array_to_string(list_sort(list(DISTINCT candidate_key))[1:10], ';') AS muestra_candidatos FROM can GROUP BY placeholder_key ORDER BY candidatos DESC, mejor_score DESC, placeholder LIMIT 100",
    "ref_a10_address_coverage": BASE + "SELECT count(*) AS eventos_total, count(*) FILTER (WHERE lugar_key IN (SELECT lugar_key FROM adr)) AS eventos_con_direccion, round(100.0 * count(*) FILTER (WHERE lugar_key IN (SELECT lugar_key FROM adr)) / count(*), 2) AS pct_eventos_con_direccion FROM eve",
    "ref_a11_addresses": BASE + "SELECT direccion, nombre AS lugar, tipo AS tipo_lugar, count(*) AS eventos_total FROM eve e JOIN adr a ON e.lugar_key = a.lugar_key JOIN cen c ON e.lugar_key = c.lugar_key GROUP BY ALL ORDER BY eventos_total DESC, direccion, lugar LIMIT 100",
    "ref_a12_anchor_coverage": f"WITH {PAR}, n AS (SELECT DISTINCT child_key FROM jerarquias WHERE tipo_relacion = 'PARTE_DE' AND child_key <> '') SELECT count(*) AS total, count(*) FILTER (WHERE child_key NOT IN (SELECT child_key FROM par)) AS sin_parent, count(*) FILTER (WHERE child_key IN (SELECT child_key FROM par)) AS con_parent FROM n",
    "ref_a13_centres": BASE + "SELECT e.lugar_key, id_ccd, nombre AS ccd, count(*) AS eventos_total, count(*) FILTER (WHERE fecha <> 'DESCONOCIDA') AS fechados, count(*) FILTER (WHERE fecha = 'DESCONOCIDA') AS sin_fecha FROM eve e JOIN cen c ON e.lugar_key = c.lugar_key GROUP BY ALL ORDER BY eventos_total DESC, id_ccd LIMIT 100",
    "ref_a14_density": BASE + "SELECT e.lugar_key, lat, lon, nombre AS lugar, tipo, count(*) AS eventos_total FROM eve e JOIN cen c ON e.lugar_key = c.lugar_key WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY ALL ORDER BY eventos_total DESC, e.lugar_key LIMIT 500",
    "ref_a15_states_by_year": BASE + f"SELECT estado, {YEAR}::INT AS anio, count(DISTINCT e.persona_key) AS personas FROM eve e JOIN per p ON e.persona_key = p.persona_key WHERE estado IS NOT NULL AND {YEAR} IS NOT NULL GROUP BY 1, 2",
    "ref_a16_places_by_people": BASE + "SELECT e.lugar_key, nombre AS lugar, tipo, count(DISTINCT persona_key) AS personas_distintas FROM eve e JOIN cen c ON e.lugar_key = c.lugar_key GROUP BY ALL ORDER BY personas_distintas DESC, e.lugar_key LIMIT 100",
    "ref_a17_sequences": BASE + "SELECT e.persona_key, coalesce(p.nombre, e.persona_key) AS persona, array_to_string(list_sort(list(fecha || ' ' || tipo_relacion || ' ' || c.nombre))[1:50], ';') AS secuencia FROM eve e JOIN per p ON e.persona_key = p.persona_key JOIN cen c ON e.lugar_key = c.lugar_key WHERE try_strptime(fecha, '%Y-%m-%d') IS NOT NULL GROUP BY e.persona_key, p.nombre ORDER BY e.persona_key LIMIT 200",
    "ref_v1_roles": BASE + "SELECT CASE WHEN es_nietx THEN 'Nietx,Persona' ELSE 'Persona' END AS labels, count(*) AS c FROM todos GROUP BY 1",
    "ref_v2_sources": BASE + "SELECT fuente, count(*) AS c FROM todos GROUP BY fuente",
    "ref_v3_kin_ends": BASE + "SELECT count(*) AS total_rel, count(*) FILTER (WHERE o LIKE 'registro:%') AS rel_con_registro, count(*) FILTER (WHERE o LIKE 'nombre:%') AS rel_placeholder FROM (SELECT CASE WHEN source_key LIKE 'nietx:%' THEN target_key ELSE source_key END o FROM kn)",
    "ref_v4_kin_types_nietxs": BASE + "SELECT tipo, count(*) AS c FROM kn GROUP BY tipo",
    "ref_v5_kin_types_detalles": BASE + "SELECT tipo, count(*) AS c FROM kd GROUP BY tipo",
    "ref_v6_states": BASE + "SELECT estado, count(*) AS c FROM gra GROUP BY estado",
    "ref_v7_event_types": BASE + "SELECT tipo_relacion, count(*) AS c FROM eve GROUP BY tipo_relacion",
    "ref_v8_event_coverage": BASE + "SELECT count(*) AS total_personas, count(*) FILTER (WHERE persona_key IN (SELECT persona_key FROM eve WHERE tipo_relacion = 'PRESENTE_EN')) AS personas_con_evento FROM todos",
    "ref_v9_case_flags": BASE + "SELECT count(*) AS total_casos, count(*) FILTER (WHERE NOT adn_imputed) AS casos_con_adn, count(restitucion) AS casos_con_restitucion FROM gra",
    "ref_v10_candidates": CAN + "SELECT count(*) AS total_candidatos, count(DISTINCT placeholder_key) AS placeholders_con_candidato, count(DISTINCT candidate_key) AS personas_candidatas FROM can",
    "ref_v12_ambiguity": CAN + "SELECT placeholder_key AS placeholder, count(*) AS candidatos FROM can GROUP BY 1 ORDER BY candidatos DESC, placeholder LIMIT 25",
    "ref_v13_no_restitution": BASE + "SELECT persona_key, caso FROM gra WHERE restitucion IS NULL",
    "ref_v14_alias_collisions": f"WITH t AS (SELECT {place('LOCALIDAD')} AS alias_norm, coalesce({geo('PROVINCIA')}, '') AS scope, sitio_id FROM eaaf_lugares) SELECT alias_norm, scope, count(DISTINCT sitio_id) AS distintos, array_to_string(list_sort(list(DISTINCT sitio_id)), ';') AS lista FROM t WHERE alias_norm <> '' GROUP BY ALL HAVING count(DISTINCT sitio_id) > 1 ORDER BY distintos DESC, alias_norm, scope LIMIT 50",
    "ref_v15_orphan_addresses": BASE + "SELECT count(*) AS direcciones_huerfanas FROM adr WHERE lugar_key NOT IN (SELECT lugar_key FROM eve)",
    "ref_v16_address_no_place": f"WITH {PAR} SELECT count(*) AS sin_lugar FROM (SELECT DISTINCT direccion_ccd_key, lugar_key FROM jerarquias WHERE tipo_relacion = 'UBICADA_EN' AND direccion_ccd_key <> '' AND lugar_key <> '') WHERE lugar_key NOT IN (SELECT child_key FROM par)",
    "ref_v17_event_no_place": BASE + "SELECT count(*) AS sin_lugar FROM eve WHERE lugar_key NOT IN (SELECT lugar_key FROM cen)",
    "ref_v18_no_parent": "SELECT count(*) AS sin_padre FROM (SELECT DISTINCT parent_key FROM jerarquias WHERE tipo_relacion = 'PARTE_DE' AND parent_key <> '') WHERE parent_key NOT IN (SELECT child_key FROM jerarquias WHERE tipo_relacion = 'PARTE_DE' AND child_key IS NOT NULL)",
    "ref_v19_misplaced_alias": BASE + f"SELECT count(*) AS mal_ubicados FROM ccds WHERE {place('ccds.ubicacion')} LIKE '%CAPITAL FEDERAL%' AND 'lugar:CCD:' || {slug('ccds.id_ccd')} IN (SELECT lugar_key FROM cen WHERE nombre = 'FEDERAL')",
    "ref_v20_link_coverage": BASE + f"SELECT count(*) AS eventos, count(*) FILTER (WHERE k IN (SELECT lugar_key FROM cen)) AS con_lugar, round(100.0 * count(*) FILTER (WHERE k IN (SELECT lugar_key FROM cen)) / count(*), 2) AS pct FROM (SELECT 'lugar:CCD:' || {slug('id')} AS k FROM ref)",
    "ref_v21_roles_by_event": BASE + "SELECT tipo_relacion, origen, count(*) AS c FROM eve GROUP BY ALL",
    "ref_q1_report": BASE
    + f"""SELECT 'personas_total' AS indicador, count(*) AS valor FROM todos UNION ALL SELECT 'nietxs_total', count(*) FROM gra UNION ALL SELECT 'rel_familiares_total', count(*) FROM kin WHERE tipo IN ({FAM}) UNION ALL SELECT 'lugares_total', count(*) FROM cen
        UNION ALL SELECT 'direcciones_ccd_total', count(*) FROM adr UNION ALL SELECT 'candidatos_merge_total', count(*) FROM candidatos WHERE placeholder_key <> '' AND candidate_key <> ''
        UNION ALL SELECT 'rel_' || k || '_total', (SELECT count(*) FROM eve WHERE lower(tipo_relacion) = k) FROM (SELECT unnest(['secuestrado_en', 'asesinado_en', 'nacio_en', 'presente_en', 'pario_en', 'murio_en', 'liberado_en']) AS k)""",
}
