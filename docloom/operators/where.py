"""Filters: a tree of clauses becomes one boolean column.

`{"path": {"operator": operand}}`, sibling keys are all required, `and` / `or` nest. A filter is checked as a whole
before anything is planned. Positive clauses stay plain comparisons and negative ones have the shape
`c IS NULL OR c <> v`, both of which reach the Parquet reader; a clause that the types decide is a constant.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..functions.operands import caster, instant, iso, members, number_text, truthy
from ..plans.errors import QueryError
from ..plans.schema import RELATION_TYPES, TEXT_TYPES, Field
from .paths import Scope, Target, find_hop, is_list, elements, resolve

# The operators of the filter language.
OPERATORS = ("equals", "not_equals", "greater_than", "greater_than_equal", "less_than", "less_than_equal", "exists", "in", "not_in",
             "all", "like", "not_like", "contains", "near", "within", "intersects")
_ORDER: dict[str, Callable[[Column, Any], Column]] = {
    "greater_than": lambda x, v: x > v, "greater_than_equal": lambda x, v: x >= v,
    "less_than": lambda x, v: x < v, "less_than_equal": lambda x, v: x <= v,
}
_NEVER, _ALWAYS = object(), object()
#: A clause under construction: a column, or one of the two constants.
Clause = Any
Related = Callable[[str], tuple[DataFrame, Scope]]


def _decided(c: Clause) -> bool:
    return c is _NEVER or c is _ALWAYS


def _column(c: Clause) -> Column:
    return F.lit(c is _ALWAYS) if _decided(c) else c


def _any(clauses: list[Clause]) -> Clause:
    real = [c for c in clauses if c is not _NEVER]
    if any(c is _ALWAYS for c in real):
        return _ALWAYS
    return reduce(lambda a, b: a | b, real) if real else _NEVER


def _all(clauses: list[Clause]) -> Clause:
    real = [c for c in clauses if c is not _ALWAYS]
    if any(c is _NEVER for c in real):
        return _NEVER
    return reduce(lambda a, b: a & b, real) if real else _ALWAYS


def _not(c: Clause) -> Clause:
    if _decided(c):
        return _ALWAYS if c is _NEVER else _NEVER
    return ~F.coalesce(c, F.lit(False))


# ------------------------------------------------------------------ one value

def _literal(v: Any) -> Column:
    if isinstance(v, datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(v, int) and not isinstance(v, bool) and not -(1 << 63) <= v < 1 << 63:
        return F.lit(_double(v))
    return F.lit(v)


def _double(v: float) -> float:
    """A number as a double; one beyond the doubles is infinite."""
    try:
        return float(v)
    except OverflowError:
        return float("inf") if v > 0 else float("-inf")


def _is_number(v: Any) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool) and v == v


def _is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))


def time_text(x: Column) -> Column:
    """A time column in the text form of times."""
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _comparable(x: Column, kind: T.DataType, v: Any) -> tuple[Column, Column] | None:
    """(value, literal) of one type, or None where the types rule out a match."""
    if isinstance(v, (datetime, date)) and not _is_time(kind):
        v = iso(instant(v))
    if isinstance(kind, T.StringType):
        return (x, F.lit(v)) if isinstance(v, str) else None
    if isinstance(kind, T.BooleanType):
        return (x, F.lit(v)) if isinstance(v, bool) else None
    if isinstance(kind, T.NumericType):
        return (x, _literal(v)) if _is_number(v) else None
    if _is_time(kind):
        if isinstance(v, (datetime, date)):
            return x, _literal(instant(v))
        return (time_text(x), F.lit(v)) if isinstance(v, str) else None
    return None


def _equal(x: Column, kind: T.DataType, v: Any) -> Clause:
    """Deep equality of a value and an operand."""
    if v is None:
        return x.isNull()
    if isinstance(kind, T.StructType):
        if not isinstance(v, dict) or any(k not in kind.names and v[k] is not None for k in v):
            return _NEVER
        return _all([x.isNotNull(), *(_equal(x[f.name], f.dataType, v.get(f.name)) for f in kind.fields)])
    if isinstance(kind, T.ArrayType):
        if not isinstance(v, (list, tuple)):
            return _NEVER
        return _all([F.size(x) == len(v), *(_equal(F.get(x, F.lit(k)), kind.elementType, e) for k, e in enumerate(v))])
    pair = _comparable(x, kind, v)
    return pair[0] == pair[1] if pair else _NEVER


def _ordered(x: Column, kind: T.DataType, operator: str, v: Any) -> Clause:
    if isinstance(v, bool) or isinstance(kind, T.BooleanType):
        return _NEVER
    pair = _comparable(x, kind, v)
    return _ORDER[operator](*pair) if pair else _NEVER


def _text(x: Column, kind: T.DataType, numbers: bool) -> Column | None:
    """A value as text to search; None if it has none."""
    if isinstance(kind, T.StringType):
        return x
    if _is_time(kind):
        return time_text(x)
    if numbers and isinstance(kind, T.IntegralType):
        return x.cast("string")
    if numbers and isinstance(kind, T.NumericType):
        whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
        return F.when(whole, x.cast("bigint").cast("string")).otherwise(x.cast("string"))
    return None


def _has(x: Column, kind: T.DataType, needle: str, numbers: bool) -> Clause:
    text = _text(x, kind, numbers)
    if text is None:
        return _NEVER
    return F.contains(F.lower(text), F.lit(needle.lower())) if needle else text.isNotNull()


# ------------------------------------------------------------------ values inside JSON

_JSON_NUMBER = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _canonical(v: Any) -> str:
    def plain(x: Any) -> Any:
        if isinstance(x, dict):
            return {k: plain(y) for k, y in x.items()}
        if isinstance(x, (list, tuple)):
            return [plain(y) for y in x]
        if isinstance(x, float) and x.is_integer() and abs(x) < 1e15:
            return int(x)
        return iso(instant(x)) if isinstance(x, (datetime, date)) else x
    return json.dumps(plain(v), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _json_equal(x: Column, v: Any) -> Column:
    kind = F.schema_of_variant(x)
    if v is None:
        return F.is_variant_null(x)
    if isinstance(v, (datetime, date)):
        v = iso(instant(v))
    if isinstance(v, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(x, "$", "boolean") == v)
    if _is_number(v):
        return kind.rlike(_JSON_NUMBER) & (F.try_variant_get(x, "$", "double") == float(v))
    if isinstance(v, str):
        return (kind == "STRING") & (F.try_variant_get(x, "$", "string") == v)
    start = "ARRAY<" if isinstance(v, (list, tuple)) else "OBJECT<"
    return kind.startswith(start) & (F.to_json(x) == _canonical(v))


def _json_ordered(x: Column, operator: str, v: Any) -> Clause:
    if isinstance(v, (datetime, date)):
        v = iso(instant(v))
    kind = F.schema_of_variant(x)
    if _is_number(v):
        return kind.rlike(_JSON_NUMBER) & _ORDER[operator](F.try_variant_get(x, "$", "double"), F.lit(_double(v)))
    if isinstance(v, str):
        return (kind == "STRING") & _ORDER[operator](F.try_variant_get(x, "$", "string"), F.lit(v))
    return _NEVER


def _json_has(x: Column, needle: str, numbers: bool) -> Column:
    kind = F.schema_of_variant(x)
    searched = (kind == "STRING") | kind.rlike(_JSON_NUMBER) if numbers else kind == "STRING"
    return searched & F.contains(F.lower(F.try_variant_get(x, "$", "string")), F.lit(needle.lower()))


# ------------------------------------------------------------------ one target

class _Values:
    """The candidates of a target, and clauses that one of them must meet."""

    def __init__(self, target: Target):
        self.target = target
        if target.kind == "json":
            self.values = F.flatten(F.transform(target.column, lambda x: F.when(is_list(x), F.concat(F.array(x), elements(x))).otherwise(F.array(x))))

    def some(self, test: Callable[[Column, T.DataType], Clause], json_test: Callable[[Column], Clause] | None = None) -> Clause:
        t = self.target
        if t.kind == "missing":
            return _NEVER
        if t.kind == "value":
            return test(t.column, t.type)
        if t.kind == "json":
            return _exists(self.values, json_test) if json_test else _NEVER
        return _exists(t.column, lambda x: test(x, t.type))

    def equal(self, v: Any) -> Clause:
        t = self.target
        found = [self.some(lambda x, k: _equal(x, k, v), lambda x: _json_equal(x, v))]
        if t.kind == "list" and t.lists is not None and (v is None or isinstance(v, (list, tuple))):
            found.append(_exists(t.lists, lambda x: _equal(x, T.ArrayType(t.type), v)))
        if t.kind == "missing" and v is None:
            return _NEVER
        return _any(found)


def _exists(values: Column, test: Callable[[Column], Clause]) -> Clause:
    probe = test(F.lit(None))
    if probe is _NEVER:
        return _NEVER
    return F.exists(values, lambda x: F.coalesce(_column(test(x)), F.lit(False)))


def _leaf(target: Target, operator: str, operand: Any) -> Clause:
    v = _Values(target)
    kind = target.kind
    if operator == "equals":
        return v.equal(operand)
    if operator == "not_equals":
        found = v.equal(operand)
        if kind == "value" and not _decided(found) and operand is not None and not isinstance(target.type, (T.StructType, T.ArrayType)):
            x, literal = _comparable(target.column, target.type, operand)
            return target.column.isNull() | (x != literal)
        return _not(found)
    if operator in _ORDER:
        return v.some(lambda x, k: _ordered(x, k, operator, operand), lambda x: _json_ordered(x, operator, operand))
    if operator == "exists":
        if kind == "missing":
            there: Clause = _NEVER
        elif kind == "value":
            there = target.column.isNotNull()
        elif kind == "json":
            there = F.exists(v.values, lambda x: F.coalesce(~F.is_variant_null(x), F.lit(False)))
        elif target.lists is not None:
            there = F.exists(target.lists, lambda x: x.isNotNull())
        else:
            there = F.exists(target.column, lambda x: x.isNotNull())
        if operand:
            return there
        return target.column.isNull() if kind == "value" else _not(there)
    if operator in ("in", "not_in"):
        wanted = list(operand) if isinstance(operand, (list, tuple, set)) else [operand]
        found = _any_of(v, target, wanted)
        if operator == "in":
            return found
        if kind == "value" and not _decided(found) and None not in wanted and not isinstance(target.type, (T.StructType, T.ArrayType)):
            return target.column.isNull() | ~found
        return _not(found)
    if operator == "all":
        wanted = list(operand) if isinstance(operand, (list, tuple, set)) else [operand]
        return _all([v.equal(x) for x in wanted])
    if operator in ("like", "not_like"):
        if not isinstance(operand, str) or operand == "":
            return _ALWAYS if operator == "like" else _NEVER
        found = v.some(lambda x, k: _has(x, k, operand, False), lambda x: _json_has(x, operand, False))
        if operator == "like":
            return found
        return target.column.isNull() | ~found if kind == "value" and found is not _NEVER else _not(found)
    if operator == "contains":
        needles = operand if isinstance(operand, (list, tuple)) else [operand]
        texts = [n if isinstance(n, str) else number_text(n) for n in needles if isinstance(n, str) or _is_number(n)]
        return _any([v.some(lambda x, k, n=n: _has(x, k, n, True), lambda x, n=n: _json_has(x, n, True)) for n in texts])
    point = geo.coordinates(target.raw, target.raw_type) if target.raw is not None else None
    return {"near": geo.near, "within": geo.within, "intersects": geo.intersects}[operator](point, operand)


def _any_of(v: _Values, target: Target, wanted: list) -> Clause:
    """One of the wanted values; plain values of one column become an IN list."""
    if target.kind == "value" and not isinstance(target.type, (T.StructType, T.ArrayType)) and not _is_time(target.type):
        plain = [x for x in wanted if x is not None and _comparable(target.column, target.type, x)]
        plain = [iso(instant(x)) if isinstance(x, (datetime, date)) else x for x in plain]
        found = [target.column.isin([_literal(x) if _is_number(x) else x for x in plain])] if plain else []
        return _any(found + ([target.column.isNull()] if None in wanted else []))
    return _any([v.equal(x) for x in wanted])


# ------------------------------------------------------------------ the tree

def check(where: Any) -> None:
    """Raises QueryError if any clause of the filter has an unknown operator."""
    if not isinstance(where, dict):
        return
    for key, clause in where.items():
        if key in ("and", "or"):
            for sub in clause if isinstance(clause, (list, tuple)) else []:
                check(sub)
        elif isinstance(clause, dict):
            for operator in clause:
                if operator not in OPERATORS:
                    raise QueryError(f"operator '{operator}' on field '{key}' is not supported; supported are {', '.join(OPERATORS)}")


def compile_where(where: dict | None, scope: Scope, related: Related) -> Column:
    """The filter as a column over the scope's frame. related: the frame and scope of another collection."""
    check(where)
    return _column(_tree(where, scope, related))


def _tree(where: Any, scope: Scope, related: Related) -> Clause:
    if not isinstance(where, dict):
        return _ALWAYS
    clauses: list[Clause] = []
    for key, clause in where.items():
        if key in ("and", "or"):
            subs = [_tree(x, scope, related) for x in clause if isinstance(x, dict)] if isinstance(clause, (list, tuple)) else []
            clauses.append(_ALWAYS if not subs else _all(subs) if key == "and" else _any(subs))
        elif isinstance(clause, dict):
            hop = find_hop(scope, key)
            if hop and hop.rest != "id":
                clauses.append(_through(hop, clause, scope, related))
            else:
                clauses.append(_clause(hop.prefix if hop else key, clause, scope))
    return _all(clauses)


def _discrete(f: Field) -> bool:
    return f.type in RELATION_TYPES or (f.type == "select" and f.has_many)


def _text_ids(target: Target, path: str, scope: Scope) -> bool:
    """Whether ids of collections with number ids and with text ids stand as text in one column, so that operands must too."""
    f = target.field or resolve(scope, path.rpartition(".")[0]).field if "." in path else target.field
    if f is None or not f.polymorphic:
        return False
    kind = target.type["value"].dataType if isinstance(target.type, T.StructType) and "value" in target.type.names else target.type
    return isinstance(kind, T.StringType)


def _clause(path: str, operators: dict, scope: Scope) -> Clause:
    """All operators on one path, their operands cast to the type of its field."""
    target = resolve(scope, path)
    f = target.field
    cast = caster(f, scope.catalog, scope.id_type if path in ("id", scope.id) else None)

    texts = _text_ids(target, path, scope)

    def one(v: Any) -> Any:
        v = cast(v)
        if texts and _is_number(v):
            return number_text(v)
        return {**v, "value": number_text(v["value"])} if texts and isinstance(v, dict) and _is_number(v.get("value")) else v

    def cast_all(v: Any) -> Any:
        return [one(x) for x in v] if isinstance(v, (list, tuple)) else one(v)

    out: list[Clause] = []
    for operator, operand in operators.items():
        if operator == "exists":
            wanted = truthy(operand)
            clause = _leaf(target, "exists", wanted)
            if f is not None and f.type in TEXT_TYPES and not f.has_many:
                clause = _all([clause, _leaf(target, "not_equals", "")]) if wanted else _any([clause, _leaf(target, "equals", "")])
            out.append(clause)
        elif operator == "contains" and f is not None and _discrete(f):
            value = cast_all(operand)
            out.append(_leaf(target, "in" if isinstance(value, list) else "equals", value))
        elif operator in ("like", "not_like", "contains", "near", "within", "intersects"):
            out.append(_leaf(target, operator, operand))
        elif operator in ("in", "not_in", "all"):
            out.append(_leaf(target, operator, cast_all(members(operand))))
        else:
            out.append(_leaf(target, operator, cast_all(operand)))
    return _all(out)


def _through(hop: Any, clause: dict, scope: Scope, related: Related) -> Clause:
    """Documents whose relationship names one of the related documents that meet the rest of the path."""
    frame, there = related(hop.to)
    inner = _tree({hop.rest: clause}, there, related)
    if inner is _NEVER:
        return _NEVER
    ids = frame.filter(_column(inner)).select(F.col(f"`{there.id}`").alias("_hop_id"))
    target = resolve(scope, hop.prefix)
    if target.kind == "missing" or target.kind == "json":
        return _NEVER
    id_kind = ids.schema[0].dataType
    if target.kind == "value":
        ids = ids if target.type == id_kind else ids.select(F.col("_hop_id").cast(target.type))
        return target.column.isin(ids)
    pairs = scope.frame.select(F.col(f"`{scope.id}`").alias("_hop_doc"), F.explode(target.column).alias("_hop_ref"))
    if target.type != id_kind:
        ids = ids.select(F.col("_hop_id").cast(target.type).alias("_hop_id"))
    owners = pairs.join(ids, F.col("_hop_ref") == F.col("_hop_id"), "left_semi").select("_hop_doc")
    return F.col(f"`{scope.id}`").isin(owners)
