"""Dotted paths: where a value lies in a document, and how to reach it in a column.

Lists are transparent: a path that crosses one stands for all values below it. A value inside `json` is reached through
Spark's VARIANT type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import FREE_TYPES, RELATION_TYPES, Catalog, Field, children


@dataclass(frozen=True)
class Scope:
    """What paths are resolved against: a frame, the fields it stores, its id and the request's locale."""

    frame: DataFrame
    fields: dict[str, Field]
    catalog: Catalog
    id: str = "id"
    id_type: str = "text"
    locale: str | None = None


@dataclass(frozen=True)
class Hop:
    """A path that steps through a relationship into another collection."""

    prefix: str
    to: str
    rest: str


@dataclass(frozen=True)
class Target:
    """A resolved path. kind: value, list, json or missing.

    value: `column` of type `type`. list: `column` is the array of what lies below (elements of type `type`), `lists` are
    whole lists met at the end of the path, as an array of arrays, or None. json: `column` is an array of variants.
    """

    kind: str
    field: Field | None
    column: Column | None = None
    type: T.DataType | None = None
    lists: Column | None = None
    raw: Column | None = None
    raw_type: T.DataType | None = None


MISSING = "missing"


def stored_path(scope: Scope, path: str) -> tuple[list[str], Field | None]:
    """The path as stored, with a locale behind each localized field, and the field that it ends on."""
    segments, out = path.split("."), []
    current: dict[str, Field] | None = scope.fields
    localization, localized, found = scope.catalog.localization, False, None
    k = 0
    while k < len(segments):
        name = segments[k]
        out.append(name)
        found = current.get(name) if current is not None else None
        k += 1
        if found is None:
            current = None
            continue
        if localization and found.localized and not localized:
            localized = True
            if k < len(segments) and segments[k] in localization.locales:
                out.append(segments[k])
                k += 1
            else:
                out.append(localization.effective(scope.locale))
        current = children(found) if found.type in ("group", "array", "blocks") else None
    return out, found


def find_hop(scope: Scope, path: str) -> Hop | None:
    """The first step of a path through a relationship to one collection, if there is one."""
    segments, current = path.split("."), scope.fields
    for k, name in enumerate(segments[:-1]):
        f = current.get(name)
        if f is None:
            return None
        if f.type in RELATION_TYPES:
            return Hop(".".join(segments[:k + 1]), f.relation_to, ".".join(segments[k + 1:])) if isinstance(f.relation_to, str) else None
        if f.type not in ("group", "array", "blocks"):
            return None
        current = children(f)
    return None


def _flat(lists: Column) -> Column:
    """One list of all elements; absent inner lists count as empty."""
    return F.flatten(F.filter(lists, lambda x: x.isNotNull()))


def _part(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def _at(path: str) -> Callable[[Column], Column]:
    return lambda x: F.try_variant_get(x, path, "variant")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def resolve(scope: Scope, path: str) -> Target:
    """Where a path leads in the frame of the scope."""
    segments, field = stored_path(scope, path)
    if segments[0] == "id" and "id" not in scope.frame.columns:
        segments[0] = scope.id
    kind: T.DataType = scope.frame.schema
    column: Column | None = None
    many = False
    above: Field | None = None
    for k, name in enumerate(segments):
        if isinstance(kind, T.ArrayType):
            column, kind, many = (_flat(column) if many else column), kind.elementType, True
        if isinstance(kind, T.StructType):
            if name not in kind.names:
                return Target(MISSING, field)
            if column is None:
                column = F.col(_quoted(name))
            else:
                column = F.transform(column, _part(name)) if many else column[name]
            kind = kind[name].dataType
            if k == 0:
                above = scope.fields.get(name)
        if _is_json(kind, field if k == len(segments) - 1 else above, scope, segments[:k + 1]):
            return _in_json(column, kind, many, segments[k + 1:], field)
        if not isinstance(kind, (T.StructType, T.ArrayType)) and k < len(segments) - 1:
            return Target(MISSING, field)
    raw = None if many else column
    if field is not None and field.type == "point" and not field.has_many:
        return Target("list", field, column, kind) if many else Target("value", field, column, kind, raw=raw, raw_type=kind)
    if isinstance(kind, T.ArrayType):
        return Target("list", field, _flat(column) if many else column, kind.elementType, column if many else F.array(column), raw, kind)
    if many:
        return Target("list", field, column, kind)
    return Target("value", field, column, kind, raw=raw, raw_type=kind)


def _is_json(kind: T.DataType, field: Field | None, scope: Scope, walked: list[str]) -> bool:
    if isinstance(kind, T.VariantType):
        return True
    if not isinstance(kind, T.StringType):
        return False
    current, found = scope.fields, None
    for name in walked:
        found = current.get(name) if current else None
        if found is None:
            break
        current = children(found) if found.type in ("group", "array", "blocks") else {}
    return found is not None and found.type in FREE_TYPES


def is_list(x: Column) -> Column:
    return F.schema_of_variant(x).startswith("ARRAY<")


def elements(x: Column) -> Column:
    """The elements of a variant that is a list."""
    return F.try_variant_get(x, "$", "array<variant>")


def _in_json(column: Column, kind: T.DataType, many: bool, rest: list[str], field: Field | None) -> Target:
    """All values at a path inside JSON: each step goes through lists."""
    one = (lambda x: x) if isinstance(kind, T.VariantType) else (lambda x: F.try_parse_json(x))
    values = F.filter(F.transform(column, one) if many else F.array(one(column)), lambda x: x.isNotNull())

    def spread(found: Column) -> Column:
        return F.flatten(F.transform(found, lambda x: F.when(is_list(x), elements(x)).otherwise(F.array(x))))

    for name in rest:
        key = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        values = F.filter(F.transform(spread(values), _at(key)), lambda x: x.isNotNull())
    return Target("json", field, values, T.VariantType())
