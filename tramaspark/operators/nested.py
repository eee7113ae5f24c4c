"""Deeply nested records as related flat tables.

Every array level becomes a table of its own. A row carries the record's key, its own surrogate key (the record key and
the 0-based positions from the top), the surrogate key of its parent and its ordinal, so that the tables join without
any further shuffle to make keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Shape:
    """What a JSON position may hold: scalars, an object with fields, or a list of elements."""

    kinds: set[str] = field(default_factory=set)
    fields: dict[str, Shape] = field(default_factory=dict)
    element: Shape | None = None


def _census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[str, str]] = set()

    def walk(x: object, path: list) -> None:
        kind = "o" if isinstance(x, dict) else "a" if isinstance(x, list) else "n" if x is None else "s"
        seen.add((json.dumps(path), kind))
        if isinstance(x, dict):
            for k, v in x.items():
                walk(v, [*path, k])
        elif isinstance(x, list):
            for v in x:
                walk(v, [*path, 0])

    for b in batches:
        for text in b.column(0).to_pylist():
            if text:
                try:
                    walk(json.loads(text), [])
                except (ValueError, RecursionError):
                    seen.add(("[]", "bad"))
    rows = sorted(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["path", "kind"]
    )


def merged_shape(df: DataFrame, column: str) -> Shape:
    """The merged shape of all JSON texts in a column, in one pass.

    Each task reduces its texts to the distinct (path, kind) pairs before anything moves; what reaches the driver is
    the schema, whose size depends on the fields that exist and not on the rows.
    """
    found = df.select(F.col(column)).mapInArrow(_census, "path string, kind string").distinct().collect()
    top = Shape()
    for r in sorted(found):
        if r["kind"] == "bad":
            continue
        at = top
        for step in json.loads(r["path"]):
            if isinstance(step, str):
                at = at.fields.setdefault(step, Shape())
            else:
                at.element = at.element or Shape()
                at = at.element
        at.kinds.add(r["kind"])
    return top


def _merge(a: Shape, b: Shape | None) -> Shape:
    if b is None:
        return a
    out = Shape(a.kinds | b.kinds, dict(a.fields), a.element)
    for k, v in b.fields.items():
        out.fields[k] = _merge(out.fields[k], v) if k in out.fields else v
    out.element = _merge(a.element, b.element) if a.element else b.element
    return out


def _listed(shape: Shape) -> Shape:
    """The element shape of a position that is a list, or a lone element standing for one."""
    lone = Shape(shape.kinds - {"a"}, shape.fields)
    return _merge(lone, shape.element)


def _is_kind(v: Column, kind: str) -> Column:
    return F.schema_of_variant(v).startswith(kind)


def _typed(v: Column, shape: Shape, split: frozenset[str], name: str) -> Column:
    """A column of the merged type from a variant; text of a field in `split` is the list between its commas."""
    if "a" in shape.kinds or name in split:
        inner = _listed(shape)
        items = F.coalesce(
            F.try_variant_get(v, "$", "array<variant>"),
            F.when(_is_kind(v, "OBJECT"), F.array(v)),
        )
        if not inner.fields:
            texts = F.transform(items, lambda x: F.try_variant_get(x, "$", "string"))
            text = F.try_variant_get(v, "$", "string")
            if name in split:
                return F.coalesce(texts, F.transform(F.split(text, ","), lambda x: F.trim(x)))
            return F.coalesce(texts, F.when(text.isNotNull() & ~F.is_variant_null(v), F.array(text)))
        return F.transform(items, lambda x: _typed(x, Shape({"o"}, inner.fields), split, ""))
    if shape.fields:
        made = F.struct(
            *[
                _typed(F.try_variant_get(v, f"$[{json.dumps(k, ensure_ascii=False)}]", "variant"), s, split, k).alias(k)
                for k, s in sorted(shape.fields.items())
            ]
        )
        return F.when(v.isNotNull() & ~F.is_variant_null(v), made)
    return F.try_variant_get(v, "$", "string")


def parse_json_column(df: DataFrame, column: str, into: str, split: frozenset[str] = frozenset()) -> DataFrame:
    """Add `into`: the JSON texts of `column` as one nested type, inferred over all rows.

    A lone object where other rows have a list counts as a list of one; so does a lone object or scalar at the top.
    Null, empty, blank and unreadable texts give null. Fields that only some rows have are null elsewhere.
    """
    shape = merged_shape(df, column)
    shape.kinds.add("a")
    v = F.try_parse_json(F.when(F.trim(F.col(column)) != "", F.col(column)))
    made = _typed(v, shape, split, "")
    if not shape.fields and not (shape.element and shape.element.fields):
        made = F.lit(None).cast("array<struct<valor:string>>")
    return df.withColumn(into, made)


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.StructType))


def flatten(df: DataFrame, key: str, column: str, name: str | None = None) -> dict[str, DataFrame]:
    """Tables by level, from the nested column: {level path: DataFrame}.

    Columns of each: the record key `key`, `sk` (0-based positions from the top joined by dots: with the key, the
    surrogate key), `parent_sk` (null at the top level), `ordinal`, then the scalar fields of the element (of nested
    structs: joined by _), or `valor` for an array of scalars. Null elements, and null or blank scalars, give no row but
    keep their ordinal. Null and empty arrays give none. Field names that clash with these get a trailing underscore.
    Every level is one posexplode in the projection of the scan: nothing is shuffled.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{column} is no array")
    out: dict[str, DataFrame] = {}
    top = df.select(F.col(key), F.lit(None).cast("string").alias("__up"), F.col(column).alias("__list"))
    _level(top, key, kind, name or column, out)
    return out


def _level(df: DataFrame, key: str, kind: T.ArrayType, name: str, out: dict[str, DataFrame]) -> None:
    one = df.select(key, "__up", F.posexplode("__list").alias("__pos", "__el"))
    own = F.when(F.col("__up").isNull(), F.col("__pos").cast("string")).otherwise(
        F.concat_ws(".", F.col("__up"), F.col("__pos").cast("string"))
    )
    real = F.col("__el").isNotNull()
    if isinstance(kind.elementType, T.StringType):
        real = real & (F.trim(F.regexp_replace("__el", r"(?U)\s+", " ")) != "")
    one = one.where(real).withColumn("__sk", own)
    head = [F.col(key), F.col("__sk").alias("sk"), F.col("__up").alias("parent_sk"), F.col("__pos").alias("ordinal")]
    taken = {key.lower(), "sk", "parent_sk", "ordinal"}
    scalars: list[Column] = []
    lists: list[tuple[str, Column, T.ArrayType]] = []

    def fields(at: Column, struct: T.StructType, prefix: str) -> None:
        for f in struct.fields:
            label = f"{prefix}{f.name}"
            if isinstance(f.dataType, T.ArrayType):
                lists.append((label, at.getField(f.name), f.dataType))
            elif isinstance(f.dataType, T.StructType):
                fields(at.getField(f.name), f.dataType, f"{label}_")
            else:
                while label.lower() in taken:
                    label += "_"
                taken.add(label.lower())
                scalars.append(at.getField(f.name).alias(label))

    if isinstance(kind.elementType, T.StructType):
        fields(F.col("__el"), kind.elementType, "")
    elif isinstance(kind.elementType, T.ArrayType):
        lists.append(("elemento", F.col("__el"), kind.elementType))
    else:
        scalars.append(F.col("__el").alias("valor"))
    out[name] = one.select(*head, *scalars)
    for label, at, inner in lists:
        _level(one.select(key, F.col("__sk").alias("__up"), at.alias("__list")), key, inner, f"{name}.{label}", out)
