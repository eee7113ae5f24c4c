"""The subpackage's queries by name, with their SQL statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": queries.p2_found,
    "p2_tamanos": queries.p2_tamanos,
    "p4_found": queries.p4_found,
    "p4_grupos": queries.p4_grupos,
    "p5_found": queries.p5_found,
    "p5_cobertura": queries.p5_cobertura,
    "p6_found": queries.p6_found,
    "p6_enlaces": queries.p6_enlaces,
    "p8_contenedores": queries.p8_contenedores,
    "p8_llenado": queries.p8_llenado,
    "p9_mezcla": queries.p9_mezcla,
    "p9_pesos": queries.p9_pesos,
    "p10_found": queries.p10_found,
    "p10_documentos": queries.p10_documentos,
    "p10_segmentos": queries.p10_segmentos,
}
P2 = """
WITH RECURSIVE e AS (SELECT nullif(placeholder_key, '') a, nullif(candidate_key, '') b FROM candidatos),
k AS (SELECT a AS v FROM e WHERE a IS NOT NULL UNION SELECT b FROM e WHERE b IS NOT NULL),
l AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
r AS (SELECT v, v AS w FROM k UNION SELECT r.v, l.b FROM r JOIN l ON r.w = l.a),
g AS (SELECT v AS record_key, min(w) AS group_key FROM r GROUP BY v)
"""
SQL: dict[str, str] = {
    "p2_found": P2 + "SELECT record_key, group_key FROM g",
    "p2_tamanos": P2 + "SELECT miembros, count(*) AS grupos FROM (SELECT count(*) AS miembros FROM g GROUP BY group_key) GROUP BY miembros",
}
