"""Place resolution and the layer of places in SQL, built from the same fixed tables as functions/places.py."""

from __future__ import annotations

from ..functions import places as P
from . import reference_sql as R
from .reference_sql import DET, GAZ, clean, iso, norm, place, plain, slug

HOME = "lugar:PROVINCIA:buenos_aires|lugar:PAIS:argentina"


def quoted(*words: str) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def identity(x: str) -> str:
    # the first rewriting, which looks ahead, in two steps
    out = f"CASE WHEN {x} LIKE '%FRANCIA%' THEN {x} ELSE " + sub(sub(x, r"\bBOULOGNE\b", "BOULOGNE SUR MER"), r"BOULOGNE SUR MER(\s+SUR\s+MER)", r"BOULOGNE\1") + " END"
    for pattern, to in P.IDENTITY[1:]:
        out = sub(out, pattern, to.replace("$1", r"\1"))
    return norm(out)


def without_province(x: str) -> str:
    ends = "|".join(sorted((p for p, _ in P.PROVINCES), key=lambda p: -len(p)))
    return norm(f"regexp_replace({norm(x)}, '(?: (?:{ends}))$', '')")


def institution_town(x: str) -> str:
    return f"nullif({norm(f"regexp_extract({x}, '^(?:{P.INSTITUTIONS})\\s*(?:\\d{{1,4}})?\\s*(?:DE|DEL|EN)\\s+(.+)$', 1)")}, '')"


def repeated_tail(x: str) -> str:
    noise = quoted(*P.TAIL_NOISE)
    return (
        f"(SELECT CASE WHEN len(t) >= 4 AND t[-1] = t[-2] AND length(t[-1]) >= 4 AND (len(t) >= 7 OR list_has_any(t[1:len(t) - 2], [{noise}])) THEN t[-1] ELSE {x} END FROM (SELECT {words(without_province(x))} AS t))"
    )


def only_address(x: str) -> str:
    return f"(regexp_matches({x}, '\\b\\d{{1,5}}\\b') AND regexp_matches({x}, '^({P.STREETS})\\b'))"


def padded(x: str) -> str:
    return f"(' ' || {x} || ' ')"


def says_province(x: str) -> str:
    return f"list_bool_or([{padded(x)} LIKE '% ' || h || ' %' FOR h IN [{quoted(*[p for p, _ in P.PROVINCES], 'CAPITAL FEDERAL', 'CABA', P.CABA)}]])"


def province_said(x: str) -> str:
    whens = " ".join(f"WHEN {padded(x)} LIKE '% {h} %' THEN '{p}'" for h, p in sorted(P.PROVINCES, key=lambda p: -len(p[0])))
    return f"CASE {whens} ELSE 'BUENOS AIRES' END"


def may_be_buenos_aires(x: str) -> str:
    return f"(NOT {says_province(x)} AND NOT regexp_matches({x}, '\\d') AND len({words(x)}) <= 5 AND NOT list_has_any({words(x)}, [{quoted(*P.NOT_A_PLACE)}]))"


def caba_named(x: str) -> str:
    return f"(' ' || {x} || ' ' LIKE '%CAPITAL FEDERAL%' OR ' ' || {x} || ' ' LIKE '% CABA %' OR {x} LIKE '%CIUDAD DE BUENOS AIRES%' OR {x} LIKE '%{P.CABA}%')"


def caba_hinted(x: str) -> str:
    return "(" + " OR ".join(f"{x} LIKE '%{w}%'" for w in P.CABA_WORDS) + ")"


def without_caba(x: str) -> str:
    out = padded(x)
    for w in P.CABA_WORDS:
        out = sub(out, r"\b" + w.replace(" ", r"\s+") + r"\b", " ")
    return norm(sub(sub(out, r"\b(CIUDAD|CDAD)\b", " "), r"\b(DE|DEL|EN|LA|EL)\b", " "))


def abroad(x: str) -> str:
    """{city, country, code} or null."""
    codes = ", ".join(f"'{n}': '{c}'" for n, c in P.COUNTRIES)
    clean_x = norm(sub(sub(x, r"\bSDH\b", ""), r"\bNO\s+CONSTA\b", ""))
    made = lambda city, country: f"{{'city': {city}, 'country': {country}, 'code': MAP {{{codes}}}[{country}]}}"
    out = f"CASE WHEN regexp_matches({x}, 'CAPITAL FEDERAL|BS AS|BUENOS AIRES|CABA') THEN NULL WHEN {x} IN ({quoted(*[n for n, _ in P.COUNTRIES])}) THEN {made('NULL::VARCHAR', x)} "
    for phrase, city, country in P.CITIES_ABROAD:
        out += f"WHEN {clean_x} = '{phrase}' THEN {made(quoted(city), quoted(country))} "
    for name, _ in P.COUNTRIES:
        head = f"trim(left({clean_x}, length({clean_x}) - {len(name)}))"
        out += f"WHEN suffix({clean_x}, ' {name}') AND len({words(clean_x)}) <= 7 AND {head} NOT IN ('', 'DE') THEN {made(head, quoted(name))} "
    return out + "END"


def address(raw: str) -> str:
    """{chunk, via, numero, trust} of a street address, or null."""
    up = plain(f"upper({clean(raw)})")
    for pattern in P.ADDRESS_ASIDE:
        up = sub(up, pattern, " ")
    up = norm(up)
    for pattern in P.ADDRESS_PREFIXES:
        up = f"regexp_replace({up}, '{pattern}', '')"
    refused = "|".join(P.ADDRESS_REFUSED)
    fragment = P.ADDRESS_FRAGMENT.replace("'", "''")
    good = f"(regexp_matches(c, '{P.ADDRESS_NUMBER}') OR (regexp_matches(c, '{P.ADDRESS_CORNER}') AND len({words('c')}) <= 8)) AND c NOT IN ({quoted(*P.ADDRESS_GENERIC)})"
    both, one, neither = P.ADDRESS_TRUST
    return f"""(SELECT CASE WHEN length(k) >= 5 THEN {{'norm': k, 'via': nullif(regexp_extract(k, '{P.ADDRESS_STREET}', 1), ''), 'numero': nullif(regexp_extract(k, '{P.ADDRESS_NUMBER}', 1), ''),
        'trust': CASE WHEN regexp_extract(k, '{P.ADDRESS_NUMBER}', 1) = '' THEN {neither}::DOUBLE WHEN regexp_extract(k, '{P.ADDRESS_STREET}', 1) = '' THEN {one}::DOUBLE ELSE {both}::DOUBLE END}} END
        FROM (SELECT list_filter(list_transform(string_split_regex(CASE WHEN length(u) > 35 AND f <> '' THEN f ELSE u END, '[,;-]'), lambda c: {norm('c')}), lambda c: {good})[1] AS k
        FROM (SELECT u, {norm(f"regexp_extract(u, '{fragment}', 1)")} AS f FROM (SELECT CASE WHEN NOT regexp_matches(u, '{refused}') THEN {norm('u')} END AS u FROM (SELECT {up} AS u)))))"""


TYPED = f"""typ AS (SELECT registro, 'descripcion_lugar_de_secuestro' AS campo, 'SECUESTRADO_EN' AS tipo_relacion, descripcion_lugar_de_secuestro AS raw, {clean('descripcion_fecha_de_secuestro')} AS f FROM det
    UNION ALL SELECT registro, 'lugar_nacimiento', 'NACIO_EN', "Lugar de nacimiento", {clean('descripcion_fecha_nacimiento')} FROM det
    UNION ALL SELECT registro, 'lugar_asesinato', 'ASESINADO_EN', "Lugar de asesinato", {clean('descripcion_fecha_de_asesinato')} FROM det),
    typed AS (SELECT registro, campo, tipo_relacion, raw, CASE WHEN regexp_full_match(f, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN {iso('f', '%d/%m/%Y')} END AS fecha FROM typ WHERE raw IS NOT NULL)"""


def aliases(source: str) -> str:
    """al: (raw, text, alias) of every distinct text of `source` (column raw) that may name a place."""
    return f"""t0 AS MATERIALIZED (SELECT raw, {clean('raw')} AS text FROM (SELECT DISTINCT raw FROM {source} WHERE raw IS NOT NULL)),
    t1 AS MATERIALIZED (SELECT raw, text, {place('text')} AS w, {place("regexp_extract(text, '.*\\(([^)]{4,})\\)', 1)")} AS a FROM t0 WHERE text IS NOT NULL),
    t2 AS MATERIALIZED (SELECT raw, text, {identity('w')} AS w, {identity('a')} AS a FROM t1),
    t3 AS MATERIALIZED (SELECT raw, text, CASE WHEN w <> '' THEN w ELSE a END AS n FROM t2 WHERE (w <> '' OR a <> '') AND CASE WHEN w <> '' THEN w ELSE a END NOT IN ({quoted(*P.UNKNOWN)})),
    t4 AS MATERIALIZED (SELECT raw, text, coalesce({institution_town('n')}, n) AS n FROM t3),
    t5 AS MATERIALIZED (SELECT raw, text, {repeated_tail('n')} AS alias FROM t4),
    al AS MATERIALIZED (SELECT * FROM t5 WHERE alias NOT IN ('SU', 'DE SU', 'DE LA') AND NOT {only_address('alias')}), loc AS MATERIALIZED (SELECT DISTINCT alias FROM al)"""


GRAMS = """w AS (SELECT alias, string_split(alias, ' ') AS t FROM loc WHERE alias <> ''), pos AS (SELECT alias, t, unnest(range(len(t))) AS i FROM w),
    gr AS (SELECT alias, t, i, k, array_to_string(t[i + 1 : i + k], ' ') AS gram FROM pos, range(1, 7) r(k) WHERE i + k <= len(t)), g AS (SELECT * FROM gr WHERE k > 1 OR length(gram) >= 4)"""
BEST = """said AS (SELECT DISTINCT alias, name AS province FROM loc JOIN gaz ON ' ' || alias || ' ' LIKE '% ' || name || ' %' WHERE level = 'PROVINCIA' AND length(name) >= 4),
    hit AS (SELECT g.alias, gram AS name, level, z.province, department, georef_id, k, i,
        CASE level WHEN 'LOCALIDAD' THEN 0.80::DOUBLE + least(0.15::DOUBLE, k * 0.02::DOUBLE) WHEN 'DEPARTAMENTO' THEN 0.71::DOUBLE + least(0.12::DOUBLE, k * 0.02::DOUBLE) ELSE 0.75::DOUBLE + least(0.10::DOUBLE, k * 0.02::DOUBLE) END
        + CASE WHEN level = 'PROVINCIA' OR g.alias NOT IN (SELECT alias FROM said) THEN 0::DOUBLE WHEN level = 'LOCALIDAD' THEN 0.06::DOUBLE ELSE 0.05::DOUBLE END
        - CASE WHEN level <> 'PROVINCIA' AND i > 0 AND t[i] IN ('CALLE', 'AV', 'AVENIDA', 'RUTA', 'PASAJE', 'PJE', 'NRO', 'NUMERO') THEN 0.12::DOUBLE ELSE 0::DOUBLE END
        - CASE WHEN level <> 'PROVINCIA' AND regexp_full_match(t[i + k + 1], '[0-9]+') THEN 0.10::DOUBLE ELSE 0::DOUBLE END AS score,
        CASE level WHEN 'LOCALIDAD' THEN 1 WHEN 'DEPARTAMENTO' THEN 3 ELSE 4 END AS r FROM g JOIN gaz z ON gram = z.name
        WHERE level = 'PROVINCIA' OR g.alias NOT IN (SELECT alias FROM said) OR (g.alias, z.province) IN (SELECT alias, province FROM said)),
    one AS (SELECT alias, name, province, department, max(score) AS score, arg_max(level, (round(score, 9), -r)) AS level, min((-k, i, r, coalesce(try_cast(regexp_extract(georef_id, '([0-9]+)', 1) AS INT), 0))) AS first FROM hit GROUP BY ALL),
    ordered AS (SELECT *, row_number() OVER o AS n, lead(score) OVER o AS s2, lead(province) OVER o AS p2 FROM one WINDOW o AS (PARTITION BY alias ORDER BY round(score, 9) DESC, length(name) DESC, first)),
    best AS (SELECT alias, name, level, province, department FROM ordered WHERE n = 1 AND score >= 0.76 AND (s2 IS NULL OR score - s2 >= 0.02 OR province = p2))"""


def placed(gazetteer: bool) -> str:
    """res: (raw, alias_raw, alias_norm, tipo, nombre, lugar_key, parent_key, chain, pais_code)."""
    key = lambda kind, name: f"'lugar:{kind}:' || {slug(name)}"
    province = lambda x: f"{key('PROVINCIA', x)} || '|{P.COUNTRY}'"
    row = lambda kind, name, parent="NULL::VARCHAR", chain="NULL::VARCHAR[]", code="NULL::VARCHAR": f"{{'tipo': {kind}, 'nombre': {name}, 'parent': {parent}, 'chain': {chain}, 'code': {code}}}"
    exact = " ".join(f"WHEN alias = '{a}' THEN {row(quoted('CIUDAD'), quoted(city), province(quoted(p)) if p else 'NULL::VARCHAR')}" for a, city, p in P.ALIASES)
    caba = row(quoted("CIUDAD"), quoted(P.CABA))
    ending = " ".join(
        f"WHEN suffix(alias, ' {h}') AND trim(left(alias, length(alias) - {len(h)})) <> '' THEN {row(quoted('CIUDAD'), f'trim(left(alias, length(alias) - {len(h)}))', province(quoted(p)))}" for h, p in P.PROVINCES
    )
    away = f"WHEN x IS NOT NULL THEN {row("CASE WHEN x.city IS NULL THEN 'PAIS' ELSE 'CIUDAD' END", 'coalesce(x.city, x.country)', f'CASE WHEN x.city IS NOT NULL THEN {key("PAIS", "x.country")} END', code='x.code')}"
    extra, found, joins = "", "", ""
    if gazetteer:
        pk, dk = province("province"), f"{key('DEPARTAMENTO', 'department')} || '|' || {province('province')}"
        extra = f"""{GAZ}, {GRAMS}, {BEST}, far AS (SELECT alias, name, CASE level WHEN 'LOCALIDAD' THEN 'CIUDAD' ELSE level END AS kind, {pk} AS pk, CASE WHEN department IS NOT NULL THEN {dk} END AS dk FROM best),
        gz AS (SELECT alias AS ga, kind AS gk, name AS gn, CASE kind WHEN 'PROVINCIA' THEN '{P.COUNTRY}' WHEN 'DEPARTAMENTO' THEN pk ELSE coalesce(dk, pk) END AS gp, CASE kind WHEN 'CIUDAD' THEN list_filter([dk, pk], lambda v: v IS NOT NULL) WHEN 'DEPARTAMENTO' THEN [pk] ELSE [] END AS above FROM far),
        cut AS (SELECT alias, {province_said('alias')} AS preferred, {says_province('alias')} AS said, {words(without_province('alias'))} AS t FROM loc WHERE NOT regexp_matches(alias, '\\d')),
        ctx AS (SELECT alias, said, preferred, k, array_to_string(t[1 : len(t) - k], ' ') AS city, CASE WHEN preferred = 'BUENOS AIRES' AND array_to_string(t[len(t) - k + 1 : len(t)], ' ') IN ('SAN MARTIN', 'GRAL SAN MARTIN') THEN 'GENERAL SAN MARTIN' ELSE array_to_string(t[len(t) - k + 1 : len(t)], ' ') END AS context
            FROM cut, range(1, 4) r(k) WHERE len(t) BETWEEN 2 AND 5 AND k < len(t) AND NOT regexp_matches(array_to_string(t, ' '), '{"|".join(n for n, _ in P.COUNTRIES)}')),
        adm AS (SELECT name, level, province, department, row_number() OVER (PARTITION BY name ORDER BY CASE level WHEN 'DEPARTAMENTO' THEN 2 ELSE 3 END, province) AS n FROM gaz WHERE level <> 'LOCALIDAD'),
        sg AS (SELECT c.alias AS sa, arg_min({{'city': c.city, 'inside': CASE WHEN a.level <> 'PROVINCIA' THEN coalesce(a.department, a.name) END, 'province': a.province}}, c.k) AS s FROM ctx c JOIN adm a ON a.name = c.context AND a.n = 1
            WHERE NOT {only_address('c.city')} AND (c.said OR a.province = 'BUENOS AIRES') GROUP BY c.alias),"""
        segmented = "s.province"
        sdk = f"CASE WHEN s.inside IS NOT NULL THEN {key('DEPARTAMENTO', 's.inside')} || '|' || {province(segmented)} END"
        found = (
            f"WHEN ga IS NOT NULL THEN {row('gk', 'gn', 'gp', f"list_concat([{"'lugar:' || gk || ':' || " + slug('gn')} || '|' || gp], above, ['{P.COUNTRY}'])")} "
            f"WHEN sa IS NOT NULL THEN {row(quoted('CIUDAD'), 's.city', f'coalesce({sdk}, {province(segmented)})', f"list_concat([{key('CIUDAD', 's.city')} || '|' || coalesce({sdk}, {province(segmented)})], list_filter([{sdk}, {province(segmented)}], lambda v: v IS NOT NULL), ['{P.COUNTRY}'])")} "
        )
        joins = "LEFT JOIN gz ON ga = alias LEFT JOIN sg ON sa = alias"
    home = row(quoted("CIUDAD"), "alias", f"'{HOME}'")
    return f"""{extra} far0 AS MATERIALIZED (SELECT alias, {abroad('alias')} AS x FROM loc),
    dec AS MATERIALIZED (SELECT alias, CASE {exact} WHEN {caba_hinted('alias')} AND {caba_named('alias')} THEN {caba} {away} {found} WHEN {caba_named('alias')} THEN {caba} {ending} WHEN {may_be_buenos_aires('alias')} THEN {home} ELSE {row(quoted('INDETERMINADO'), 'alias')} END AS p FROM far0 {joins}),
    key AS MATERIALIZED (SELECT alias, p, 'lugar:' || p.tipo || ':' || {slug('p.nombre')} || coalesce('|' || p.parent, '') AS lugar_key FROM dec),
    res AS MATERIALIZED (SELECT raw, text AS alias_raw, al.alias AS alias_norm, p.tipo AS tipo, p.nombre AS nombre, lugar_key, p.parent AS parent_key, CASE WHEN p.code IS NOT NULL THEN list_filter([lugar_key, p.parent], lambda v: v IS NOT NULL) ELSE p.chain END AS chain, p.code AS pais_code FROM al JOIN key ON al.alias = key.alias)"""


TYPED_BASE = f"WITH {DET}, {TYPED}, "
RESOLVED = TYPED_BASE + aliases("typed") + ", "
PLACES = f"""lay AS MATERIALIZED (SELECT registro, campo, tipo_relacion, fecha, res.* FROM typed JOIN res ON typed.raw = res.raw),
    chn AS (SELECT DISTINCT lugar_key, CASE WHEN len(chain) > 1 THEN chain WHEN parent_key IS NOT NULL THEN list_filter([lugar_key, parent_key, CASE WHEN parent_key <> '{P.COUNTRY}' THEN '{P.COUNTRY}' END], lambda v: v IS NOT NULL) END AS c FROM res),
    jer AS (SELECT DISTINCT c[i] AS child_key, c[i + 1] AS parent_key FROM (SELECT c, unnest(range(1, len(c))) AS i FROM chn WHERE len(c) > 1)),
    own AS (SELECT lugar_key, min(nombre) AS nombre, min(tipo) AS tipo, coalesce(max(pais_code), 'AR') AS pais_code FROM res GROUP BY lugar_key),
    abo AS (SELECT DISTINCT k FROM (SELECT unnest(c) AS k FROM chn UNION SELECT '{P.COUNTRY}') WHERE k NOT IN (SELECT lugar_key FROM own)),
    stb AS (SELECT k AS lugar_key, upper(replace(string_split(string_split(k, '|')[1], ':')[3], '_', ' ')) AS nombre, upper(string_split(k, ':')[2]) AS tipo FROM abo),
    lug AS (SELECT lugar_key, nombre, tipo, pais_code FROM own UNION ALL SELECT lugar_key, nombre, tipo, CASE WHEN tipo = 'PAIS' AND nombre <> 'ARGENTINA' THEN 'XX' ELSE 'AR' END FROM stb),
    evp AS (SELECT 'registro:' || registro AS persona_key, lugar_key, tipo_relacion, coalesce(fecha, 'DESCONOCIDA') AS fecha, 'detalles_personas' AS origen FROM lay)"""
LAYER = RESOLVED + placed(True) + ", " + PLACES + " "


def scalar(expression: str) -> str:
    """A function of the normal form of every distinct typed place."""
    return TYPED_BASE + f"src AS (SELECT DISTINCT {place('raw')} AS texto FROM typed) SELECT texto, {expression} AS valor FROM src WHERE texto <> ''"


def struct(expression: str, *fields: str) -> str:
    return TYPED_BASE + f"src AS (SELECT DISTINCT {place('raw')} AS texto FROM typed), v AS (SELECT texto, {expression} AS x FROM src WHERE texto <> '') SELECT texto, {', '.join(f'x.{f} AS {f}' for f in fields)} FROM v"


SQL = {
    "ref_g1_identity": scalar(identity("texto")),
    "ref_g2_addresses": f"""WITH {DET}, {TYPED}, src AS (SELECT DISTINCT raw FROM typed), v AS (SELECT raw, {clean('raw')} AS t, {address('raw')} AS x FROM src) SELECT raw, t AS direccion_raw, x.norm AS direccion_norm, x.via AS via, x.numero AS numero, x.trust AS confianza FROM v WHERE x IS NOT NULL""",
    "ref_g3_place_key": scalar(f"'lugar:CIUDAD:' || {slug('texto')} || '|{HOME}'"),
    "ref_g6_caba_named": scalar(caba_named("texto")),
    "ref_g7_caba_hinted": scalar(caba_hinted("texto")),
    "ref_g8_without_caba": scalar(without_caba("texto")),
    "ref_g10_abroad": struct(abroad("texto"), "city", "country", "code"),
    "ref_g11_says_province": scalar(says_province("texto")),
    "ref_g12_only_address": scalar(only_address("texto")),
    "ref_g13_default_province": scalar(may_be_buenos_aires("texto")),
    "ref_g14_province_said": scalar(province_said("texto")),
    "ref_g15_without_province": scalar(without_province("texto")),
    "ref_g18_institution_town": scalar(institution_town("texto")),
    "ref_g19_repeated_tail": scalar(repeated_tail("texto")),
    "ref_g20_resolve": RESOLVED + placed(True) + " SELECT raw, alias_norm, tipo, nombre, lugar_key, parent_key, pais_code FROM res",
    "ref_g20_resolve_plain": RESOLVED + placed(False) + " SELECT raw, alias_norm, tipo, nombre, lugar_key, parent_key, pais_code FROM res",
    "ref_p6_lugares": LAYER + "SELECT lugar_key, nombre, tipo AS \"tipoGeopolitico\", pais_code FROM lug",
    "ref_p6_jerarquias": LAYER + "SELECT child_key, parent_key FROM jer",
    "ref_p6_alias": LAYER + f"SELECT 'alias:' || campo || ':' || registro || ':' || {slug('alias_norm')} AS alias_key, alias_norm, alias_raw, tipo, coalesce(parent_key, '__ROOT__') AS parent_key, lugar_key, registro FROM lay",
    "ref_p6_direcciones": LAYER + f"SELECT DISTINCT 'direccion_ccd:' || substr(sha1(x.norm || '|' || lugar_key), 1, 20) AS direccion_ccd_key, x.norm AS direccion_norm, lugar_key, x.trust AS confianza_parseo FROM (SELECT lugar_key, {address('alias_raw')} AS x FROM (SELECT DISTINCT lugar_key, alias_raw FROM lay)) WHERE x IS NOT NULL",
    "ref_p6_eventos": LAYER + "SELECT * FROM evp",
    "ref_p7_stubs": LAYER + "SELECT lugar_key, nombre, tipo AS \"tipoGeopolitico\" FROM stb",
}

ADDRESSES = f"""dir AS (SELECT 'direccion_ccd:' || substr(sha1(x.norm || '|' || lugar_key), 1, 20) AS k, min(alias_raw) AS direccion, lugar_key FROM (SELECT lugar_key, alias_raw, {address('alias_raw')} AS x FROM (SELECT DISTINCT lugar_key, alias_raw FROM lay)) WHERE x IS NOT NULL GROUP BY 1, 3)"""
#: The graph of both sources: events, places (cen) and addresses of the centres as in reference_sql, and those of the typed places.
BOTH = (
    LAYER + f", {ADDRESSES}, {R.NIE}, {R.PER}, {R.GRA}, {R.ALL}, {R.KIN}, {R.CCD}, {R.REF}, {R.CEN.replace('cen AS', 'cec AS', 1)}, {R.EVE.replace('eve AS', 'evc AS', 1)}, "
    "eve AS (SELECT * FROM evc UNION ALL SELECT * FROM evp), "
    "cen AS (SELECT lugar_key, nombre, tipo, jurisdiccion, lat, lon FROM cec UNION ALL SELECT lugar_key, nombre, tipo, NULL, NULL, NULL FROM lug), "
    "adr AS (SELECT coalesce(ubicacion, nombre) AS direccion, lugar_key FROM cec UNION ALL SELECT direccion, lugar_key FROM dir) "
)
for name in """ref_a1_hotspots ref_a2_hotspots_by_type ref_a3_by_year ref_a4_by_jurisdiction ref_a5_busiest_people ref_a6_multi_site ref_a10_address_coverage ref_a11_addresses ref_a14_density
    ref_a15_states_by_year ref_a16_places_by_people ref_a17_sequences ref_v7_event_types ref_v8_event_coverage ref_q1_report""".split():
    SQL[name] = BOTH + R.SQL[name].removeprefix(R.BASE)
SQL["ref_a15_states_by_year"] = SQL["ref_a15_states_by_year"].replace("WHERE estado IS NOT NULL", "WHERE tipo_relacion IN ('SECUESTRADO_EN', 'ASESINADO_EN', 'PRESENTE_EN') AND estado IS NOT NULL")
SQL["ref_v8_event_coverage"] = SQL["ref_v8_event_coverage"].replace("PRESENTE_EN')", "SECUESTRADO_EN')")
SQL["ref_q1_report"] += " UNION ALL SELECT unnest(['victimas_total', 'complices_total', 'represores_total']), 0 UNION ALL SELECT 'alias_lugar_total', count(*) FROM lay"
SQL |= {
    "ref_v15_orphan_addresses": BOTH + "SELECT count(*) AS direcciones_huerfanas FROM adr WHERE lugar_key NOT IN (SELECT lugar_key FROM cen)",
    "ref_v16_address_no_place": BOTH + "SELECT count(*) AS sin_lugar FROM eve WHERE lugar_key IN (SELECT lugar_key FROM adr) AND lugar_key NOT IN (SELECT lugar_key FROM cen)",
    "ref_v17_event_no_place": BOTH + "SELECT count(*) AS sin_lugar FROM eve WHERE lugar_key NOT IN (SELECT lugar_key FROM cen)",
    "ref_v21_roles_by_event": R.BASE + "SELECT CASE WHEN lower(relacion) = 'pario_en' THEN 'PARIO_EN' ELSE 'PRESENTE_EN' END AS tipo_relacion, coalesce(lower(relacion), '(sin_rol)') AS rol, count(*) AS c FROM ref GROUP BY ALL",
    "ref_k4_strict_edges": R.BASE + "SELECT source_key, target_key, fuente, tipo, count(*) AS n FROM kin WHERE source_key IN (SELECT persona_key FROM todos) GROUP BY ALL",
    "ref_k5_eventos": BOTH + "SELECT persona_key, lugar_key, tipo_relacion, fecha, origen, count(*) AS n FROM eve WHERE persona_key IN (SELECT persona_key FROM per) AND lugar_key IN (SELECT lugar_key FROM cen) GROUP BY ALL",
    "ref_k14_domains": """SELECT 'jerarquias' AS tabla, 'dominio' AS regla, 'tipo_relacion' AS columna, count(*) FILTER (WHERE tipo_relacion NOT IN ('PARTE_DE', 'UBICADA_EN')) AS filas FROM jerarquias UNION ALL SELECT 'jerarquias', 'existencia', 'fila_id', count(*) FILTER (WHERE fila_id IS NULL) FROM jerarquias
        UNION ALL SELECT 'candidatos', 'dominio', 'confianza', count(*) FILTER (WHERE confianza NOT IN ('alta', 'media')) FROM candidatos UNION ALL SELECT 'candidatos', 'existencia', 'placeholder_key', count(*) FILTER (WHERE placeholder_key IS NULL) FROM candidatos
        UNION ALL SELECT 'candidatos', 'existencia', 'candidate_key', count(*) FILTER (WHERE candidate_key IS NULL) FROM candidatos UNION ALL SELECT 'ccds', 'existencia', 'id_ccd', count(*) FILTER (WHERE id_ccd IS NULL) FROM ccds
        UNION ALL SELECT 'ccds', 'existencia', 'denominacion', count(*) FILTER (WHERE denominacion IS NULL) FROM ccds UNION ALL SELECT 'ccds', 'unicidad', 'id_ccd', (SELECT count(*) FROM (SELECT id_ccd FROM ccds WHERE id_ccd IS NOT NULL GROUP BY id_ccd HAVING count(*) > 1))""",
    "ref_g5_by_gazetteer": TYPED_BASE + f"""src AS (SELECT DISTINCT {place('raw')} AS texto FROM typed), loc AS MATERIALIZED (SELECT texto AS alias FROM src WHERE texto <> ''), {GAZ}, {GRAMS}, {BEST},
        k AS (SELECT alias, name, CASE level WHEN 'LOCALIDAD' THEN 'CIUDAD' ELSE level END AS kind, 'lugar:PROVINCIA:' || {slug('province')} || '|{P.COUNTRY}' AS pk, 'lugar:DEPARTAMENTO:' || {slug('department')} || '|lugar:PROVINCIA:' || {slug('province')} || '|{P.COUNTRY}' AS dk FROM best),
        p AS (SELECT *, CASE kind WHEN 'PROVINCIA' THEN '{P.COUNTRY}' WHEN 'DEPARTAMENTO' THEN pk ELSE coalesce(dk, pk) END AS parent FROM k)
        SELECT alias, kind AS tipo, name AS nombre, parent AS parent_key, 'lugar:' || kind || ':' || {slug('name')} || '|' || parent || CASE WHEN kind = 'CIUDAD' AND dk IS NOT NULL THEN ';' || dk ELSE '' END || CASE WHEN kind <> 'PROVINCIA' THEN ';' || pk ELSE '' END || ';{P.COUNTRY}' AS cadena FROM p""",
    "ref_g21_exact_aliases": struct("CASE " + " ".join(f"WHEN texto = '{a}' THEN {{'city': '{c}', 'province': {quoted(p) if p else 'NULL'}}}" for a, c, p in P.ALIASES) + " END", "city", "province"),
    "ref_p8_key_parts": """WITH k AS (SELECT DISTINCT unnest([child_key, parent_key, lugar_key, direccion_ccd_key]) AS clave FROM jerarquias), c AS (SELECT clave, string_split(clave, '|')[1] AS core FROM k WHERE clave <> ''),
        q AS (SELECT clave, core, string_split(core, ':') AS t FROM c), n AS (SELECT clave, CASE WHEN len(t) >= 3 THEN upper(t[2]) ELSE 'INDETERMINADO' END AS kind, CASE WHEN len(t) >= 3 THEN upper(replace(array_to_string(t[3:], ':'), '_', ' ')) ELSE upper(core) END AS name FROM q)
        SELECT clave, name AS nombre, kind AS "tipoGeopolitico", CASE WHEN kind = 'PAIS' AND name <> 'ARGENTINA' THEN 'XX' ELSE 'AR' END AS pais_code FROM n""",
    "ref_j13_scope_pairs": f"""WITH {R.EAA}, p AS (SELECT DISTINCT 'lugar:CIUDAD:' || {slug(place('LOCALIDAD'))} || '|' || {R.geo('PROVINCIA')} AS k, {place('LOCALIDAD')} AS n, {R.geo('PROVINCIA')} AS scope FROM eaa WHERE {place('LOCALIDAD')} <> '' AND PROVINCIA IS NOT NULL),
        w AS (SELECT k, n, scope, string_split(n, ' ') AS t FROM p), x AS (SELECT a.k AS ka, a.n AS na, b.k AS kb, b.n AS nb, list_filter(range(1, len(a.t) + 1), lambda i: a.t[i] <> b.t[i]) AS d, a.t AS ta, b.t AS tb FROM w a JOIN w b ON a.scope = b.scope AND len(a.t) = len(b.t) AND a.k < b.k)
        SELECT ka AS lugar_key_a, na AS nombre_a, kb AS lugar_key_b, nb AS nombre_b FROM x WHERE len(d) = 1 AND list_has_any(list_transform(range(1, greatest(length(ta[d[1]]) - 1, 1) + 1), lambda i: substr(ta[d[1]], i, 2)), list_transform(range(1, greatest(length(tb[d[1]]) - 1, 1) + 1), lambda i: substr(tb[d[1]], i, 2)))""",
}
CENTRE_TEXTS = f'txt AS (SELECT lugar_key, 0 AS k, ubicacion AS raw FROM cec WHERE ubicacion IS NOT NULL UNION ALL SELECT lugar_key, 1, nombre FROM cec WHERE nombre IS NOT NULL), "both" AS (SELECT raw FROM typed UNION SELECT raw FROM txt)'
SQL["ref_p11_anclas"] = (
    f"WITH {DET}, {TYPED}, {R.CCD}, {R.REF}, {R.CEN.replace('cen AS', 'cec AS', 1)}, {CENTRE_TEXTS}, " + aliases('"both"') + ", " + placed(True).replace("res AS MATERIALIZED", "every AS MATERIALIZED")
    + f""", res AS (SELECT * FROM every WHERE raw IN (SELECT raw FROM typed)), {PLACES}, tries AS (SELECT txt.lugar_key AS c, txt.k * 2 AS o, e.lugar_key AS t FROM txt JOIN every e ON e.raw = txt.raw WHERE e.tipo <> 'INDETERMINADO' UNION ALL SELECT txt.lugar_key, txt.k * 2 + 1, e.parent_key FROM txt JOIN every e ON e.raw = txt.raw)
    SELECT c AS child_key, arg_min(t, o) AS parent_key FROM tries WHERE t IN (SELECT lugar_key FROM lug) GROUP BY c HAVING c <> arg_min(t, o)"""
)
