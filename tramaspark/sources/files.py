"""Files as DataFrames, with declared schemas."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "personas": "persona_key string, registro long, nombre string, genero string, fuente string, es_nietx boolean, caso string, ADN string",
    "lugares": "lugar_key string, tipo_entidad string, nombre string, tipoGeopolitico string, pais_code string, fuente string, lat double, lon double, id_ccd string, zona string, subzona string, area string, jurisdiccion string, "
    "ubicacion string, emplazamiento_propiedad string, alias_key string, alias_norm string, alias_raw string, campo_fuente string, tipo string, parent_key string, direccion_ccd_key string, coordenadas string, direccionExacta string",
    "relaciones_interpersonales": "source_key string, source_nombre string, target_key string, target_nombre string, tipo string, fuente string, fecha string",
    "eventos_espaciales": "persona_key string, lugar_key string, tipo_relacion string, fecha string, origen string",
    "jerarquias": "tipo_relacion string, child_key string, parent_key string, direccion_ccd_key string, lugar_key string",
}
#: Keys of a source file that only describe it, and files that have builders of their own.
ABOUT = {"source_id", "description", "version"}
BUILT = {"ccds.json", "nietos_y_nietas.json", "parque_de_la_memoria.json", "listado_paginas.json", "georef_catalog.json"}
SITES = "PROVINCIA string, LOCALIDAD string, `CEM - CCD - EP` string, `LUGAR DE HALLAZGO` string, `HOJA DE REFERENCIA` string, Lat string, Long string, `Suma de CASOS` int, `Suma de EXHUMADOS` int, `Suma de ID CON CUERPO` int, `Suma de ID SIN CUERPO` int, `Suma de ID` int, `Suma de NO ID` int"


def read_records(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """A JSON file that is one array of records (or one record); with lines, one record a line, as write_records writes it."""
    return spark.read.schema(schema).json(path, multiLine=not lines)


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


class BadSource(ValueError):
    """A source file of the wrong shape."""


def checked(name: str, text: str) -> list[str]:
    """The tables a source file has; BadSource if it is no object of lists of objects under known keys."""
    data = json.loads(text)
    if not isinstance(data, dict):
        raise BadSource(f"{name}: not a JSON object")
    for key, rows in data.items():
        if key in ABOUT or (key in TABLES and rows is None):
            continue
        if key not in TABLES:
            raise BadSource(f"{name}: unknown key {key}; known are {', '.join(sorted(TABLES))}")
        if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
            raise BadSource(f"{name}: {key} is no list of objects")
    return [k for k, v in data.items() if k in TABLES and v]


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """The JSON files of a folder of any file system, in the order of their names; none if there is no such folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(f"{folder}/*.json")
    found = where.getFileSystem(conf).globStatus(where) or []
    return sorted((f.getPath().toString() for f in found if f.getPath().getName() not in BUILT), key=lambda p: p.rsplit("/", 1)[1])


def direct_sources(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of all source files in a folder, in the order of their names, and the files read.

    Files are checked where they are read, by executors; the driver learns which tables each has. Rows keep the file's
    rank and their position (_file, _pos), by which the last write wins. A missing folder has none.
    """
    tables, paths = empty_tables(spark), _listed(spark, folder)
    if not paths:
        return tables, []

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, text in zip(pdf["path"], pdf["value"], strict=True):
                name = path.rsplit("/", 1)[1]
                try:
                    out.append((name, ",".join(checked(name, text)), None))
                except ValueError as e:
                    out.append((name, None, str(e)))
            yield pd.DataFrame(out, columns=["name", "has", "error"])

    texts = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    said = {r["name"]: r for r in texts.mapInPandas(check, "name string, has string, error string").collect()}
    names = [p.rsplit("/", 1)[1] for p in paths]
    if bad := [said[n]["error"] for n in names if said[n]["error"]]:
        raise BadSource("; ".join(bad))
    rank = F.create_map(*[F.lit(x) for k, n in enumerate(names) for x in (n, k)])
    for table in TABLES:
        having = [p for p, n in zip(paths, names, strict=True) if table in said[n]["has"].split(",")]
        if having:
            raw = spark.read.schema(f"{table} array<struct<{_struct(TABLES[table])}>>").json(having, multiLine=True).select(table, F.col("_metadata.file_name").alias("f"))
            tables[table] = raw.select(F.posexplode(table).alias("_pos", "r"), "f").select("r.*", F.element_at(rank, F.col("f")).alias("_file"), "_pos")
    return tables, names


def _struct(schema: str) -> str:
    return ",".join(":".join(c.strip().split(" ", 1)) for c in schema.split(","))


def sites_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The semicolon table of exhumation sites; coordinates stay text, for some are corrupt. An empty field is null."""
    return spark.read.schema(SITES).option("sep", ";").option("header", True).option("encoding", encoding).option("escape", '"').csv(path)


def catalog(raw: DataFrame) -> DataFrame:
    """Catalogue rows (id, nombre and nested provincia, departamento, municipio) as flat ones."""
    flat = [F.col("id"), F.col("nombre")]
    for level in ("provincia", "departamento", "municipio"):
        if level in raw.columns:
            flat.append(F.col(f"{level}.id").alias(f"{level}_id"))
    return raw.select(*flat)


def write_records(df: DataFrame, path: str) -> None:
    """One JSON object a line; a later run replaces the folder."""
    df.write.mode("overwrite").json(path)


def write_arrays(df: DataFrame, path: str) -> None:
    """JSON files that are one array of records each, one per partition, written line by line; a later run replaces them."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = "["
        for pdf in batches:
            yield pd.DataFrame({"value": [(before if k == 0 else ",") + x for k, x in enumerate(pdf["value"])]})
            before = "," if len(pdf) or before == "," else "["
        yield pd.DataFrame({"value": ["]" if before == "," else "[]"]})

    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInPandas(lines, "value string").write.mode("overwrite").text(path)
