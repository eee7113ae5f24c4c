"""The same results in plain SQL over the same tables (a second, independent statement used as a check)."""

P1_LATEST = """
WITH v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY victima_id ORDER BY capturado_en DESC NULLS LAST) rn FROM victimas WHERE victima_id IS NOT NULL) WHERE rn = 1),
i AS (SELECT imputado_id, CASE WHEN trim(sentencias_y_victimas) <> '' THEN sentencias_y_victimas::JSON END j FROM (SELECT *, row_number() OVER (PARTITION BY imputado_id ORDER BY capturado_en DESC NULLS LAST) rn FROM imputados WHERE imputado_id IS NOT NULL) WHERE rn = 1),
s AS (SELECT victima_id, k, sentencias[k + 1] e FROM (SELECT victima_id, sentencias, unnest(range(len(sentencias))) k FROM v) WHERE sentencias[k + 1] IS NOT NULL),
a AS (SELECT victima_id, k, k2, e.imputados[k2 + 1] e2, e FROM (SELECT victima_id, k, e, unnest(range(len(e.imputados))) k2 FROM s) WHERE e.imputados[k2 + 1] IS NOT NULL),
x AS (SELECT victima_id, k, k2, k3, e, e2, e2.delitos[k3 + 1] d FROM (SELECT victima_id, k, k2, e, e2, unnest(range(len(e2.delitos))) k3 FROM a) WHERE trim(e2.delitos[k3 + 1]) <> ''),
"""
P1_FOUND = (
    P1_LATEST
    + """
c AS (SELECT victima_id, k, ccds[k + 1] e FROM (SELECT victima_id, ccds, unnest(range(len(ccds))) k FROM v) WHERE ccds[k + 1] IS NOT NULL),
f AS (SELECT victima_id, k, k2 FROM (SELECT victima_id, k, e, unnest(range(len(e.fecha))) k2 FROM c) WHERE trim(e.fecha[k2 + 1]) <> ''),
l AS (SELECT imputado_id, CASE json_type(j) WHEN 'ARRAY' THEN j WHEN 'OBJECT' THEN json_array(j) END j FROM i),
js AS (SELECT imputado_id, k, json_extract(j, '$[' || k || ']') e FROM (SELECT imputado_id, j, unnest(range(json_array_length(j)::BIGINT)) k FROM l)),
js2 AS (SELECT imputado_id, k, e, CASE json_type(e -> 'victimas_asociadas') WHEN 'ARRAY' THEN e -> 'victimas_asociadas' WHEN 'OBJECT' THEN json_array(e -> 'victimas_asociadas') END va FROM js WHERE json_type(e) <> 'NULL'),
jv AS (SELECT imputado_id, k, k2, json_extract(va, '$[' || k2 || ']') e FROM (SELECT imputado_id, k, va, unnest(range(json_array_length(va)::BIGINT)) k2 FROM js2)),
jv2 AS (SELECT imputado_id, k, k2, e, e -> 'delitos' d FROM jv WHERE json_type(e) <> 'NULL'),
jd AS (SELECT imputado_id, k, k2, unnest(CASE json_type(d) WHEN 'ARRAY' THEN list_transform(range(json_array_length(d)::BIGINT), lambda n: json_extract_string(d, '$[' || n || ']')) WHEN 'VARCHAR' THEN string_split(d ->> '$', ',') END) t,
  unnest(range(CASE json_type(d) WHEN 'ARRAY' THEN json_array_length(d)::BIGINT WHEN 'VARCHAR' THEN len(string_split(d ->> '$', ',')) END)) k3 FROM jv2)
SELECT 'victimas.sentencias' AS rama, victima_id AS clave, k::VARCHAR AS ruta FROM s
UNION ALL SELECT 'victimas.sentencias', victima_id, k || '.' || k2 FROM a
UNION ALL SELECT 'victimas.sentencias', victima_id, k || '.' || k2 || '.' || k3 FROM x
UNION ALL SELECT 'victimas.ccds', victima_id, k::VARCHAR FROM c
UNION ALL SELECT 'victimas.ccds', victima_id, k || '.' || k2 FROM f
UNION ALL SELECT 'imputados.sentencias_y_victimas', imputado_id, k::VARCHAR FROM js2
UNION ALL SELECT 'imputados.sentencias_y_victimas', imputado_id, k || '.' || k2 FROM jv2
UNION ALL SELECT 'imputados.sentencias_y_victimas', imputado_id, k || '.' || k2 || '.' || k3 FROM jd WHERE trim(t) <> ''
"""
)
P1_DELITOS = (
    P1_LATEST
    + """
z AS (SELECT 1)
SELECT victima_id AS clave, e.sentencia_nombre AS sentencia_nombre, e2.imputado_nombre AS imputado_nombre, k3::INT AS ordinal, d AS delito FROM x
"""
)
P3_BASE = """
WITH RECURSIVE r AS (SELECT child_key c, nullif(parent_key, '') p, cargado_en t FROM jerarquias WHERE tipo_relacion = 'PARTE_DE'),
own AS (SELECT c, p FROM (SELECT c, p, row_number() OVER (PARTITION BY c ORDER BY t DESC NULLS LAST) rn FROM r WHERE c <> '') WHERE rn = 1),
base AS (SELECT c AS node, p AS parent FROM own UNION ALL SELECT DISTINCT p, NULL FROM r WHERE p IS NOT NULL AND p NOT IN (SELECT c FROM own)),
tree AS (SELECT node, node AS root, 0 AS depth, node AS ruta FROM base WHERE parent IS NULL
  UNION ALL SELECT b.node, t.root, t.depth + 1, t.ruta || ' > ' || b.node FROM base b JOIN tree t ON b.parent = t.node),
"""
P3_FOUND = (
    P3_BASE
    + """
rest AS (SELECT * FROM base WHERE node NOT IN (SELECT node FROM tree)),
reach AS (SELECT node AS a, parent AS b FROM rest UNION SELECT reach.a, rest.parent FROM reach JOIN rest ON reach.b = rest.node),
ring AS (SELECT a AS node FROM reach WHERE a = b),
low AS (SELECT a, min(b) AS root FROM reach WHERE b IN (SELECT node FROM ring) GROUP BY a)
SELECT node AS node_key, root AS root_key, depth::INT AS depth FROM tree
UNION ALL SELECT a, root, CASE WHEN a IN (SELECT node FROM ring) THEN -1 ELSE -2 END FROM low
"""
)
P3_RUTAS = (
    P3_BASE
    + """
anc AS (SELECT node, parent AS above FROM base WHERE parent IS NOT NULL AND node IN (SELECT node FROM tree)
  UNION ALL SELECT anc.node, base.parent FROM anc JOIN base ON anc.above = base.node WHERE base.parent IS NOT NULL),
n AS (SELECT above, count(*) AS k FROM anc GROUP BY above)
SELECT node AS node_key, root AS root_key, depth::INT AS depth, ruta, coalesce(k, 0)::BIGINT AS n_descendientes FROM tree LEFT JOIN n ON n.above = tree.node
"""
)
P3_DESCENDIENTES = (
    P3_BASE
    + """
anc AS (SELECT node, parent AS above FROM base WHERE parent IS NOT NULL AND node IN (SELECT node FROM tree)
  UNION ALL SELECT anc.node, base.parent FROM anc JOIN base ON anc.above = base.node WHERE base.parent IS NOT NULL)
SELECT above AS node_key, node AS descendiente FROM anc
"""
)
SQL = {"p3_descendientes": P3_DESCENDIENTES, "p1_found": P1_FOUND, "p1_delitos": P1_DELITOS, "p3_found": P3_FOUND, "p3_rutas": P3_RUTAS}

_NUM = r"^-?[0-9]+([.,][0-9]+)?(E[+-]?[0-9]+)? ?°?$"
_DMS = r"^([0-9]+)°([0-9]+)''([0-9.,]+)\"([NSEWO])$"


def _degrees(t: str) -> str:
    x = f"trim(replace({t}, chr(160), ' '))"
    m = f"regexp_extract({x}, '{_DMS}', ['d', 'm', 's', 'h'])"
    value = f"({m}.d::DOUBLE + {m}.m::DOUBLE / 60 + replace({m}.s, ',', '.')::DOUBLE / 3600)"
    return f"CASE WHEN regexp_matches({x}, '{_NUM}') THEN try_cast(replace(replace(replace({x}, ',', '.'), '°', ''), ' ', '') AS DOUBLE) WHEN regexp_matches({x}, '{_DMS}') THEN CASE WHEN {m}.h IN ('S', 'W', 'O') THEN -{value} ELSE {value} END END"


P7_FOUND = f"""
WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_ccd ORDER BY actualizado_en DESC) rn FROM ccds WHERE id_ccd IS NOT NULL) WHERE rn = 1),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sitio_id ORDER BY cargado_en DESC) rn FROM eaaf_lugares WHERE sitio_id IS NOT NULL) WHERE rn = 1),
p0 AS (SELECT 'c:' || id_ccd AS k, lat, lon FROM c UNION ALL SELECT 'e:' || sitio_id, {_degrees('"Lat"')}, {_degrees('"Long"')} FROM e),
p AS (SELECT *, radians(lat) AS y, radians(lon) AS x FROM p0 WHERE abs(lat) <= 90 AND abs(lon) <= 180 AND NOT (lat = 0 AND lon = 0)),
near AS (SELECT a.k AS clave_a, b.k AS clave_b FROM p a JOIN p b ON a.k < b.k AND abs(a.lat - b.lat) < 0.01
  WHERE 2 * 6371008.8 * asin(sqrt(least(1, pow(sin((b.y - a.y) / 2), 2) + cos(a.y) * cos(b.y) * pow(sin((b.x - a.x) / 2), 2)))) <= 500),
ring AS (SELECT area_id, string_split(r, ',') AS v FROM (SELECT area_id, unnest(regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)) AS r FROM (SELECT DISTINCT ON (area_id) area_id, wkt FROM areas_militares))),
seg AS (SELECT area_id, string_split(trim(v[i]), ' ') AS f, string_split(trim(v[i + 1]), ' ') AS g FROM (SELECT area_id, v, unnest(range(1, len(v))) AS i FROM ring)),
s AS (SELECT area_id, f[1]::DOUBLE AS x1, f[2]::DOUBLE AS y1, g[1]::DOUBLE AS x2, g[2]::DOUBLE AS y2 FROM seg),
held AS (SELECT k AS clave_a, 'r:' || area_id AS clave_b FROM p JOIN s ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT clave_a, clave_b FROM near UNION ALL SELECT clave_a, clave_b FROM held
"""
SQL["p7_found"] = P7_FOUND
