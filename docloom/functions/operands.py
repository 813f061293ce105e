"""Operands of filters, cast at plan time to the type of their field.

A string that does not read as the field's type stays a string, so that it compares with nothing instead of failing.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from typing import Any

from ..plans.schema import RELATION_TYPES, Catalog, Field

_DECIMAL = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\Z")
_RADIX = re.compile(r"0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)\Z")
_DAY = re.compile(r"[+-]?\d{4,6}(-\d{2}(-\d{2})?)?\Z")
_SHAPES = ("%m/%d/%Y", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y", "%a, %d %b %Y %H:%M:%S GMT", "%Y/%m/%d", "%m/%d/%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S")


def number(text: str) -> float | int | None:
    """The number that a text is: decimal, hexadecimal, octal or binary; white space around it is allowed."""
    t = text.strip()
    if _RADIX.match(t):
        return int(t, 0)
    if not _DECIMAL.match(t):
        return None
    value = float(t)
    if value in (float("inf"), float("-inf")):
        return None
    return int(value) if value.is_integer() and abs(value) < 2 ** 53 else value


def instant(value: Any) -> datetime | None:
    """The UTC time, to the millisecond, that a text, epoch milliseconds or a date stands for."""
    if isinstance(value, bool):
        return None
    try:
        if isinstance(value, (int, float)):
            at = datetime(1970, 1, 1) + timedelta(milliseconds=int(value))
        elif isinstance(value, datetime):
            at = value
        elif isinstance(value, date):
            at = datetime(value.year, value.month, value.day)
        else:
            at = _parsed(value.strip())
    except (ValueError, OverflowError):
        return None
    if at is None:
        return None
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return at.replace(microsecond=at.microsecond // 1000 * 1000)


def _parsed(t: str) -> datetime | None:
    if not t:
        return None
    if _DAY.match(t):  # a day alone is UTC
        parts = [int(x) for x in t.split("-")]
        return datetime(*parts, *([1] * (3 - len(parts))))
    try:
        return datetime.fromisoformat(t)
    except ValueError:
        pass
    for shape in _SHAPES:
        try:
            return datetime.strptime(t, shape)
        except ValueError:
            continue
    return None


def iso(at: datetime) -> str:
    """The text form of a time: 24 characters, UTC."""
    return at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{at.microsecond // 1000:03d}Z"


def number_text(value: float | int) -> str:
    """A number as text, without a fraction where it is whole."""
    return str(int(value)) if float(value).is_integer() and abs(value) < 1e15 else repr(float(value))


def truthy(value: Any) -> bool:
    return value is True or (isinstance(value, str) and value.lower() == "true")


def members(operand: Any) -> Any:
    """A comma-separated text as a list."""
    return [x.strip() for x in operand.split(",")] if isinstance(operand, str) else operand


def cast_id(value: Any, id_type: str) -> Any:
    """An id operand in the type of the ids: a number for numeric ids, else text."""
    if id_type == "number":
        return (number(value) if number(value) is not None else value) if isinstance(value, str) else value
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return number_text(value)
    return value


def caster(f: Field | None, catalog: Catalog, id_type: str | None = None) -> Callable[[Any], Any]:
    """How an operand for field f is cast; id_type is given for a document's own id."""
    if f is None:
        return (lambda v: cast_id(v, id_type)) if id_type else (lambda v: v)
    if f.type == "checkbox":
        return lambda v: {"true": True, "false": False}.get(v.lower(), v) if isinstance(v, str) else v
    if f.type == "number":
        return lambda v: (n if (n := number(v)) is not None else v) if isinstance(v, str) else v
    if f.type == "date":
        return lambda v: v if v is None or isinstance(v, bool) or isinstance(v, (list, dict)) else (instant(v) or v)
    if f.type in RELATION_TYPES:
        def relation(v: Any) -> Any:
            if v == "null":
                return None
            if isinstance(f.relation_to, str):
                return cast_id(v, catalog.id_type(f.relation_to))
            if isinstance(v, dict) and isinstance(v.get("relationTo"), str) and "value" in v:
                return {**v, "value": cast_id(v["value"], catalog.id_type(v["relationTo"]))}
            return v
        return relation
    return lambda v: v
