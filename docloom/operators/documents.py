"""Documents between Python and columns: the projection onto a schema, and values in stored form and back."""

from __future__ import annotations

import json
from datetime import datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.operands import instant, iso
from ..plans.schema import FREE_TYPES, UNSTORED_TYPES, Field, children, flatten

# Keys that every document may have beside its fields, and those of a version row.
RESERVED = ("id", "createdAt", "updatedAt", "_status", "globalType")
VERSION_RESERVED = ("id", "parent", "version", "createdAt", "updatedAt", "latest", "autosave", "snapshot", "publishedLocale")


def project(data: Any, fields: dict[str, Field], extra: tuple[str, ...] = ()) -> Any:
    """What the schema knows of a document, at every depth. A localized value and an unknown kind of block stay whole."""
    if not isinstance(data, dict):
        return data
    out = {k: data[k] for k in extra if k in data}
    for name, f in fields.items():
        if name not in data or f.type in UNSTORED_TYPES:
            continue
        value = data[name]
        if f.localized:
            pass
        elif f.type == "group":
            value = project(value, flatten(f.fields))
        elif f.type == "array" and isinstance(value, list):
            value = [project(x, flatten(f.fields), ("id",)) for x in value]
        elif f.type == "blocks" and isinstance(value, list):
            known = dict(f.blocks)
            value = [project(x, flatten(known[x["blockType"]]), ("id", "blockType")) if isinstance(x, dict) and x.get("blockType") in known else x for x in value]
        out[name] = value
    return out


def project_version(row: dict, fields: dict[str, Field]) -> dict:
    """What a version row may hold: its metadata and the projected snapshot."""
    out = {k: row[k] for k in VERSION_RESERVED if k in row}
    if isinstance(out.get("version"), dict):
        out["version"] = project(out["version"], fields, RESERVED)
    return out


def stored(value: Any, kind: T.DataType, field: Field | None = None) -> Any:
    """A value in the form of its column; what does not fit the column is null."""
    if value is None:
        return None
    if field is not None and field.type in FREE_TYPES and isinstance(kind, T.StringType):
        return json.dumps(value, default=str)
    if isinstance(kind, T.StructType):
        below = children(field) if field is not None and field.type in ("group", "array", "blocks") else {}
        if not isinstance(value, dict):
            return None
        return {f.name: stored(value.get(f.name), f.dataType, below.get(f.name, field if field is not None and field.localized else None)) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [stored(x, kind.elementType, field) for x in value] if isinstance(value, (list, tuple)) else None
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return instant(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value else None
    if isinstance(kind, (T.IntegralType)):
        return int(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else iso(value) if isinstance(value, datetime) else str(value)
    return value


def presented(value: Any, field: Field | None = None) -> Any:
    """A stored value as callers see it: times as text, JSON parsed, absent keys left out."""
    if isinstance(value, datetime):
        return iso(value)
    if isinstance(value, dict):
        below = children(field) if field is not None and field.type in ("group", "array", "blocks") else {}
        return {k: presented(v, below.get(k)) for k, v in value.items() if v is not None}
    if isinstance(value, list):
        return [presented(x, field) for x in value]
    if field is not None and field.type in FREE_TYPES and isinstance(value, str):
        try:
            return json.loads(value)
        except ValueError:
            return value
    return value


def document(row: dict, fields: dict[str, Field]) -> dict:
    """A collected row as a document: internal columns and absent fields left out."""
    return {k: presented(v, fields.get(k)) for k, v in row.items() if v is not None and k != "_rev" and not k.startswith("_supplement")}


def shown(column: Column, kind: T.DataType, field: Field | None = None) -> Column:
    """`presented` as a column that `to_json` writes; it leaves absent keys out itself."""
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        text = column.cast("string")
        return F.concat(F.translate(F.substring_index(text, ".", 1), " ", "T"), F.lit("."), F.rpad(F.substring(F.split_part(text, F.lit("."), F.lit(2)), 1, 3), 3, "0"), F.lit("Z"))
    if isinstance(kind, T.StructType):
        below = children(field) if field is not None and field.type in ("group", "array", "blocks") else {}
        return F.when(column.isNotNull(), F.struct(*(shown(column.getField(f.name), f.dataType, below.get(f.name)).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: shown(x, kind.elementType, field))
    if field is not None and field.type in FREE_TYPES and isinstance(kind, T.StringType):
        return F.coalesce(F.try_parse_json(column), column.cast("variant"))
    return column


def document_json(kind: T.StructType, fields: dict[str, Field]) -> Column:
    """`document` as a column: a row's document as JSON text."""
    kept = [f for f in kind.fields if f.name != "_rev" and not f.name.startswith("_supplement")]
    return F.to_json(F.struct(*(shown(F.col(f"`{f.name}`"), f.dataType, fields.get(f.name)).alias(f.name) for f in kept)), {"ignoreNullFields": "true"})
