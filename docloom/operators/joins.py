"""Join fields: for each parent the ids of the documents that point at it, one page of them, in order.

The children are cut down to those that name a parent of the page before anything is ranked; ranks up to the page's end
come from a window that Spark limits while it sorts; totals, if wanted, from a separate aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import Field
from .paths import Scope, resolve
from .sort import order_columns
from .where import compile_where

Related = Callable[[str], tuple[DataFrame, Scope]]


def narrowed(targets: list[str], where: dict | None) -> tuple[list[str], dict | None]:
    """A clause on `relationTo` picks the targets of a polymorphic join; the rest of the filter is for each of them."""
    clause = (where or {}).get("relationTo")
    if not isinstance(clause, dict):
        return targets, where
    wanted = clause["in"] if isinstance(clause.get("in"), (list, tuple)) else [clause["equals"]] if "equals" in clause else None
    rest = {k: v for k, v in where.items() if k != "relationTo"}
    return [t for t in targets if wanted is None or t in wanted], rest or None


def _owned(frame: DataFrame, scope: Scope, on: str, parent_slug: str, keep: list) -> DataFrame:
    """(_owner, ...): the parents that each child names, once each."""
    target = resolve(scope, on)
    if target.kind not in ("value", "list"):
        return frame.select(F.lit(None).cast("string").alias("_owner"), *keep).filter(F.lit(False))
    if isinstance(target.type, T.StructType):
        if not {"relationTo", "value"} <= set(target.type.names):
            return frame.select(F.lit(None).cast("string").alias("_owner"), *keep).filter(F.lit(False))
        named = F.array(target.column) if target.kind == "value" else target.column
        owners = F.transform(F.filter(named, lambda x: x["relationTo"] == parent_slug), lambda x: x["value"])
        return frame.select(F.explode(F.array_distinct(owners)).alias("_owner"), *keep)
    if target.kind == "list":
        return frame.select(F.explode(F.array_distinct(target.column)).alias("_owner"), *keep)
    return frame.select(target.column.alias("_owner"), *keep)


def join_rows(parents: DataFrame, parent: Scope, parent_slug: str, field: Field, query: dict[str, Any], related: Related, default_sort: Callable[[str], str | None]) -> tuple[DataFrame, DataFrame | None]:
    """(rows, totals): rows (_owner, _rank, relationTo, _id) up to one behind the page; totals (_owner, totalDocs) if counted."""
    limit = query.get("limit", field.default_limit if field.default_limit is not None else 10)
    skip = (max(1, query.get("page", 1)) - 1) * limit
    targets = [field.collection] if isinstance(field.collection, str) else list(field.collection)
    where = query.get("where")
    if not isinstance(field.collection, str):
        targets, where = narrowed(targets, where)
    ids = parents.select(F.col(f"`{parent.id}`").alias("_parent")).distinct()
    id_kind = ids.schema[0].dataType
    ranked, counted = [], []
    for place, slug in enumerate(targets):
        frame, scope = related(slug)
        frame = frame.filter(compile_where(where, scope, related)) if where else frame
        sort = query.get("sort") or field.default_sort or default_sort(slug) or "-createdAt"
        order = order_columns(scope, sort)
        names = [f"_s{k}" for k in range(len(order))]
        keys = [c.alias(n) for (c, _), n in zip(order, names)]
        children = _owned(frame, scope, field.on, parent_slug, [F.col(f"`{scope.id}`").alias("_id"), *keys])
        kind = children.schema["_owner"].dataType
        if kind != id_kind and isinstance(kind, T.NumericType) and isinstance(id_kind, T.NumericType):
            children, kind = children.withColumn("_owner", F.col("_owner").cast(id_kind)), id_kind
        if kind != id_kind:
            children = children.withColumn("_owner", F.col("_owner").cast("string")).join(ids.select(F.col("_parent"), F.col("_parent").cast("string").alias("_text")), F.col("_owner") == F.col("_text")).withColumn("_owner", F.col("_parent")).drop("_parent", "_text")
        else:
            children = children.join(ids, F.col("_owner") == F.col("_parent"), "left_semi")
        w = Window.partitionBy("_owner").orderBy(*(F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_first() for n, (_, down) in zip(names, order)))
        rows = children.select("_owner", "_id", F.row_number().over(w).alias("_n"))
        if limit:
            rows = rows.filter(F.col("_n") <= skip + limit + 1)
        ranked.append(rows.select("_owner", F.lit(place).alias("_place"), "_n", F.lit(slug).alias("relationTo"), F.col("_id").cast("string") if len(targets) > 1 else F.col("_id")))
        if query.get("count"):
            counted.append(children.select("_owner"))
    if not ranked:
        none = ids.select(F.col("_parent").alias("_owner"), F.lit(0).alias("_rank"), F.lit("").alias("relationTo"), F.lit("").alias("_id")).filter(F.lit(False))
        return none, none.groupBy("_owner").agg(F.count(F.lit(1)).alias("totalDocs")) if query.get("count") else None
    if len(ranked) == 1:
        rows = ranked[0].select("_owner", F.col("_n").alias("_rank"), "relationTo", "_id")
    else:
        union = ranked[0]
        for r in ranked[1:]:
            union = union.unionByName(r)
        w = Window.partitionBy("_owner").orderBy("_place", "_n")
        rows = union.select("_owner", F.row_number().over(w).alias("_rank"), "relationTo", "_id")
        if limit:
            rows = rows.filter(F.col("_rank") <= skip + limit + 1)
    totals = None
    if counted:
        union = counted[0]
        for c in counted[1:]:
            union = union.unionByName(c)
        totals = union.groupBy("_owner").agg(F.count(F.lit(1)).alias("totalDocs"))
    return rows, totals


def page_of(query: dict[str, Any], field: Field) -> tuple[int, int]:
    """(rows to skip, rows to take; 0 for all) of a join."""
    limit = query.get("limit", field.default_limit if field.default_limit is not None else 10)
    return (max(1, query.get("page", 1)) - 1) * limit, limit


def with_join(parents: DataFrame, parent: Scope, parent_slug: str, path: str, field: Field, query: dict[str, Any], related: Related, default_sort: Callable[[str], str | None]) -> DataFrame:
    """The parents with a struct of docs, hasNextPage and, if counted, totalDocs at the path of the join field."""
    skip, limit = page_of(query, field)
    rows, totals = join_rows(parents, parent, parent_slug, field, query, related, default_sort)
    poly = not isinstance(field.collection, str)
    entry = F.struct("_rank", F.struct(F.col("relationTo"), F.col("_id").alias("value")).alias("doc")) if poly else F.struct("_rank", F.col("_id").alias("doc"))
    on_page = (F.col("_rank") > skip) & (F.col("_rank") <= skip + limit) if limit else F.lit(True)
    listed = rows.groupBy("_owner").agg(F.array_sort(F.collect_list(F.when(on_page, entry))).alias("_list"), F.max("_rank").alias("_most"))
    listed = listed.select("_owner", F.transform("_list", lambda x: x["doc"]).alias("_docs"), ((F.col("_most") > skip + limit) if limit else F.lit(False)).alias("_more"))
    kind = listed.schema["_docs"].dataType
    out = parents.join(listed, F.col(f"`{parent.id}`") == F.col("_owner"), "left").drop("_owner")
    parts = [F.coalesce("_docs", F.array().cast(kind)).alias("docs"), F.coalesce("_more", F.lit(False)).alias("hasNextPage")]
    if totals is not None:
        out = out.join(totals, F.col(f"`{parent.id}`") == F.col("_owner"), "left").drop("_owner")
        parts.append(F.coalesce("totalDocs", F.lit(0)).alias("totalDocs"))
    value = F.struct(*parts)
    if field.localized and parent.catalog.localization:
        value = F.struct(value.alias(parent.catalog.localization.effective(parent.locale)))
    out = out.withColumn("_joined", value)
    head, *rest = path.split(".")
    if rest and head in parents.columns and isinstance(parents.schema[head].dataType, T.StructType):
        kind = parents.schema[head].dataType
        if kind.names:  # an absent group becomes one without values
            empty = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields))
            joined = F.coalesce(F.col(f"`{head}`"), empty.cast(kind)).withField(".".join(rest), F.col("_joined"))
        else:
            joined = F.col("_joined")
            for name in reversed(rest):
                joined = F.struct(joined.alias(name))
    else:
        joined = F.col("_joined")
        for name in reversed(rest):
            joined = F.struct(joined.alias(name))
    return out.withColumn(head, joined).select(*(f"`{c}`" for c in dict.fromkeys([*parents.columns, head])))
