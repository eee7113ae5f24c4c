"""All queries of the core by name, with their SQL statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import place_queries, places_sql, reference, reference_sql, source_queries, source_sql, training, training_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": training.p1_found,
    "p1_delitos": training.p1_delitos,
    "p3_found": training.p3_found,
    "p3_rutas": training.p3_rutas,
    "p3_descendientes": training.p3_descendientes,
    "p7_found": training.p7_found,
    **reference.QUERIES,
    **place_queries.QUERIES,
    **source_queries.QUERIES,
}
SQL: dict[str, str] = training_sql.SQL | reference_sql.SQL | places_sql.SQL | source_sql.SQL
