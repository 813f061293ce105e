"""Geometry predicates as column expressions; a point is [longitude, latitude] or a struct of coordinates."""

from __future__ import annotations

import math
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operands import number

#: Mean radius of the earth in metres; a fixed value.
EARTH = 6_371_008.8


def coordinates(c: Column, kind: T.DataType) -> tuple[Column, Column] | None:
    """(longitude, latitude) of a stored point; None if the column cannot hold one."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        whole = F.size(c) >= 2
        return F.when(whole, F.get(c, F.lit(0))), F.when(whole, F.get(c, F.lit(1)))
    if isinstance(kind, T.StructType):
        if {"lng", "lat"} <= set(kind.names):
            return c["lng"], c["lat"]
        if "coordinates" in kind.names:
            return coordinates(c["coordinates"], kind["coordinates"].dataType)
    return None


def distance(lng: Column, lat: Column, to: tuple[float, float]) -> Column:
    """Great-circle metres by the haversine formula."""
    a, b = F.radians(lat), F.radians(F.lit(float(to[1])))
    half = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(F.lit(float(to[0]))) - F.radians(lng)) / 2), 2)
    return 2 * EARTH * F.asin(F.least(F.lit(1.0), F.sqrt(half)))


def _finite(value: Any) -> float | None:
    """A finite number, given as one or as text; None for anything else."""
    if isinstance(value, str):
        value = number(value)
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    try:
        value = float(value)
    except OverflowError:
        return None
    return value if math.isfinite(value) else None


def position(value: Any) -> tuple[float, float] | None:
    """(longitude, latitude) of an operand: a list of two numbers or more, or an object with such `coordinates`."""
    pair = value.get("coordinates") if isinstance(value, dict) else value
    if not isinstance(pair, (list, tuple)) or len(pair) < 2:
        return None
    lng, lat = _finite(pair[0]), _finite(pair[1])
    return None if lng is None or lat is None else (lng, lat)


def near(point: tuple[Column, Column] | None, operand: Any) -> Column:
    """Within a distance: [longitude, latitude, most metres, least metres], both bounds inclusive and optional."""
    parts = operand.split(",") if isinstance(operand, str) else operand
    if point is None or not isinstance(parts, (list, tuple)) or len(parts) < 2:
        return F.lit(False)
    values = [_finite(x) for x in parts]
    if values[0] is None or values[1] is None:
        return F.lit(False)
    d = distance(*point, (values[0], values[1]))
    tests = [point[0].isNotNull() & point[1].isNotNull()]
    if len(values) > 2 and values[2] is not None:
        tests.append(d <= values[2])
    if len(values) > 3 and values[3] is not None:
        tests.append(d >= values[3])
    return reduce(lambda x, y: x & y, tests)


def _in_ring(x: Column, y: Column, ring: Any) -> Column:
    """Whether a ray to the right crosses the ring an odd number of times; edges at a vertex that is no point do not count."""
    crossings = []
    vertices = [position(v) for v in ring] if isinstance(ring, (list, tuple)) else []
    for a, b in zip(vertices, vertices[-1:] + vertices[:-1]):
        if a is not None and b is not None and a[1] != b[1]:
            (x1, y1), (x2, y2) = a, b
            edge = (x2 - x1) * (y - F.lit(y1)) / (y2 - y1) + F.lit(x1)
            crossings.append((((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < edge)).cast("int"))
    return (reduce(lambda a, b: a + b, crossings) % 2 == 1) if crossings else F.lit(False)


def within(point: tuple[Column, Column] | None, geometry: Any) -> Column:
    """Inside a GeoJSON Polygon or MultiPolygon: in the first ring of a polygon and in none of the others.

    Anything else, malformed shapes included, holds no point.
    """
    if point is None or not isinstance(geometry, dict) or geometry.get("type") not in ("Polygon", "MultiPolygon"):
        return F.lit(False)
    shape = geometry.get("coordinates")
    polygons = [shape] if geometry["type"] == "Polygon" else shape
    x, y = point
    tests = []
    for rings in polygons if isinstance(polygons, (list, tuple)) else []:
        if not isinstance(rings, (list, tuple)) or not rings:
            continue
        inside = _in_ring(x, y, rings[0])
        for hole in rings[1:]:
            inside = inside & ~_in_ring(x, y, hole)
        tests.append(F.coalesce(inside, F.lit(False)))
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def intersects(point: tuple[Column, Column] | None, geometry: Any) -> Column:
    """A GeoJSON Point is met by an equal point; an area as by `within`."""
    if point is not None and isinstance(geometry, dict) and geometry.get("type") == "Point":
        other = position(geometry)
        return F.coalesce((point[0] == other[0]) & (point[1] == other[1]), F.lit(False)) if other else F.lit(False)
    return within(point, geometry)
