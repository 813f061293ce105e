"""Sorting and paging: a total order, and the numbers that describe a page."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import Scope, resolve

Sort = str | list[str] | tuple[str, ...] | None


def sort_keys(sort: Sort) -> list[tuple[str, bool]]:
    """(path, descending) of each sort key."""
    keys = [sort] if isinstance(sort, str) else list(sort or [])
    return [(k[1:], True) if k.startswith("-") else (k, False) for k in keys if k]


def order_columns(scope: Scope, sort: Sort) -> list[tuple[Column, bool]]:
    """(column, descending) of a total order: the keys, then the id's text in the direction of the first key.

    Lists are not entered: a path through one counts as absent and does not order.
    """
    keys = sort_keys(sort)
    tie = F.col(f"`{scope.id}`").cast("string")
    return [(c, down) for path, down in keys for c in _values(scope, path)] + [(tie, bool(keys and keys[0][1]))]


def order_by(scope: Scope, sort: Sort, *, before: list[Column] | None = None) -> list[Column]:
    """The order as sort columns: absent values first when ascending. `before` stands in front if there are no keys."""
    out = [c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in order_columns(scope, sort)]
    return out if sort_keys(sort) else [*(before or []), *out]


def _values(scope: Scope, path: str) -> list[Column]:
    target = resolve(scope, path)
    if target.kind == "json":
        first = F.get(target.column, F.lit(0))
        return [F.try_variant_get(first, "$", "double"), F.try_variant_get(first, "$", "string")]
    if target.kind != "value" or isinstance(target.type, (T.ArrayType, T.StructType, T.MapType)):
        return []
    return [target.column]


def bounds(limit: int, page: int) -> tuple[int, int, int | None]:
    """(page, rows to skip, rows to take): no limit means one page of all rows."""
    if limit <= 0:
        return 1, 0, None
    page = max(1, page)
    return page, (page - 1) * limit, limit


def page_info(total: int, limit: int, page: int, pagination: bool) -> dict[str, Any]:
    """What a page tells about itself beside its documents."""
    page, skip, take = bounds(limit, page)
    pages = max(1, math.ceil(total / limit)) if pagination and take else 1
    later, earlier = pagination and bool(take) and page < pages, pagination and bool(take) and page > 1
    return {"hasNextPage": later, "hasPrevPage": earlier, "limit": limit if take else total, "nextPage": page + 1 if later else None, "page": page,
            "pagingCounter": skip + 1, "prevPage": page - 1 if earlier else None, "totalDocs": total, "totalPages": pages}
