"""The engine: queries and writes over the collections and globals of a catalog.

Every query has a lazy form that returns a DataFrame (`find_df`, ...) and one that collects a page with its numbers
(`find`, ...). Only pages are collected.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.operands import cast_id
from .functions.shape import fit
from .operators import documents, drafts, joins
from .operators.paths import Scope, resolve
from .operators.sort import Sort, bounds, order_by, page_info
from .operators.where import compile_where
from .plans.errors import ConflictError, ValidationError
from .plans.schema import Catalog, Collection, Field, Global, Localization, document_type, flatten, version_fields, version_type
from .sources.tables import Conflict, Store, Tables

ATTEMPTS = 10
JOBS = "jobs"


def _now() -> datetime:
    t = datetime.now(timezone.utc).replace(tzinfo=None)
    return t.replace(microsecond=t.microsecond // 1000 * 1000)


def _strip_version(where: Any) -> Any:
    """A filter on drafts in terms of the document: `version.x` is x, `parent` is the id."""
    if not isinstance(where, dict):
        return where
    out = {}
    for key, value in where.items():
        if key in ("and", "or"):
            out[key] = [_strip_version(x) for x in value if x] if isinstance(value, (list, tuple)) else value
        elif key.startswith("version."):
            out[key[8:]] = value
        else:
            out["id" if key == "parent" else key] = value
    return out


class Engine:
    """Collections and globals over Spark. `root` is the folder that writes go to; reading alone needs none."""

    def __init__(self, spark: SparkSession, collections: Iterable[Collection] = (), globals: Iterable[Global] = (), localization: Localization | None = None, root: str | None = None):
        self.spark = spark
        self.catalog = Catalog({c.slug: c for c in collections}, {g.slug: g for g in globals}, localization)
        self.tables = Tables(spark, root)

    # -------------------------------------------------------------- sources

    def put(self, slug: str, frame: DataFrame | Callable[[], DataFrame]) -> Engine:
        """Give the documents of a collection or global (`<slug>`) or its versions (`<slug>_versions`)."""
        self.tables.put(slug, frame)
        return self

    def load(self, slug: str, docs: Iterable[dict]) -> Engine:
        """Give documents as dictionaries."""
        kind, fields = self._type(slug), self._fields(slug)
        return self.put(slug, self._rows(list(docs), kind, fields))

    def _rows(self, docs: list[dict], kind: T.StructType, fields: dict[str, Field]) -> DataFrame:
        rows = [[documents.stored(d.get(f.name), f.dataType, fields.get(f.name)) for f in kind.fields] for d in docs]
        return self.spark.createDataFrame([tuple(_as_row(v, f.dataType) for v, f in zip(r, kind.fields)) for r in rows], kind)

    def _owner(self, slug: str) -> tuple[Collection | Global, bool]:
        """(collection or global, whether the name is that of its versions)."""
        for name, versions in ((slug, False), (slug.removesuffix("_versions"), True)):
            if name in self.catalog.collections:
                return self.catalog.collections[name], versions and name != slug
            if name in self.catalog.globals:
                return self.catalog.globals[name], versions and name != slug
        raise KeyError(f"no collection or global '{slug}'")

    def _type(self, slug: str) -> T.StructType:
        owner, versions = self._owner(slug)
        return version_type(owner, self.catalog) if versions else document_type(owner, self.catalog)

    def _fields(self, slug: str) -> dict[str, Field]:
        owner, versions = self._owner(slug)
        return version_fields(owner) if versions else owner.flat()

    def frame(self, slug: str) -> DataFrame:
        """All rows of a table; a declared table without rows is empty."""
        if not self.tables.has(slug):
            if self.tables.root is None:
                return self.spark.createDataFrame([], self._type(slug))
            self._store(slug)
        return self.tables.read(slug)

    def scope(self, slug: str, frame: DataFrame, locale: str | None) -> Scope:
        owner, versions = self._owner(slug)
        if versions or isinstance(owner, Global):
            return Scope(frame, self._fields(slug), self.catalog, "id", "text", locale)
        return Scope(frame, owner.flat(), self.catalog, owner.id, owner.id_type, locale)

    def _related(self, locale: str | None) -> Callable[[str], tuple[DataFrame, Scope]]:
        def related(slug: str) -> tuple[DataFrame, Scope]:
            frame = self.frame(slug)
            return frame, self.scope(slug, frame, locale)
        return related

    def condition(self, slug: str, frame: DataFrame, where: dict | None, locale: str | None = None) -> Column:
        return compile_where(where, self.scope(slug, frame, locale), self._related(locale))

    def matching(self, slug: str, where: dict | None = None, locale: str | None = None) -> DataFrame:
        """The rows of a table that meet a filter."""
        frame = self.frame(slug)
        return frame.filter(self.condition(slug, frame, where, locale)) if where else frame

    # -------------------------------------------------------------- reading

    def _with_drafts(self, slug: str) -> bool:
        c = self.catalog.collections.get(slug)
        return bool(c and c.drafts)

    def _matched(self, slug: str, where: dict | None, locale: str | None) -> DataFrame:
        """Matches of a collection; with drafts, also latest versions of documents that are not among them."""
        found = self.matching(slug, where, locale)
        if not self._with_drafts(slug):
            return found
        c = self.catalog.collections[slug]
        new = drafts.lifted(drafts.latest(self.frame(f"{slug}_versions")), c.id)
        if where:
            new = new.filter(self.condition(slug, new, where, locale))
        return drafts.supplement(found, new, c.id)

    def _page(self, slug: str, found: DataFrame, sort: Sort, limit: int, page: int, locale: str | None) -> DataFrame:
        before = [F.col("_supplement").asc()] if "_supplement" in found.columns else None
        _, skip, take = bounds(limit, page)
        ordered = found.orderBy(*order_by(self.scope(slug, found, locale), sort, before=before))
        if take is None:
            return ordered
        return (ordered.offset(skip) if skip else ordered).limit(take)

    def _joined(self, slug: str, page: DataFrame, wanted: Any, locale: str | None) -> DataFrame:
        if not isinstance(wanted, dict):
            return page
        known = dict(self.catalog.collections[slug].joins())
        for path, query in wanted.items():
            if isinstance(query, dict) and path in known:
                page = joins.with_join(page, self.scope(slug, page, locale), slug, path, known[path], query, self._related(locale), lambda s: self.catalog.collections[s].default_sort)
        return page

    def find_df(self, collection: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, joins: Any = None, locale: str | None = None) -> DataFrame:
        """One page of matches, in order. Joins are resolved for the page only."""
        out = self._joined(collection, self._page(collection, self._matched(collection, where, locale), sort, limit, page, locale), joins, locale)
        return out.drop("_rev", "_supplement")

    def documents_df(self, collection: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, joins: Any = None, locale: str | None = None) -> DataFrame:
        """The documents of `find` as rows, in their order: `id` and `document`, both text, the latter JSON. Nothing is collected, so a page may have all."""
        rows = self._joined(collection, self._page(collection, self._matched(collection, where, locale), sort, limit, page, locale), joins, locale)
        if joins:
            rows = self._in_order(collection, rows, sort, locale)
        return rows.select(F.col(f"`{self.catalog.collections[collection].id}`").cast("string").alias("id"), documents.document_json(rows.schema, self._fields(collection)).alias("document"))

    def find(self, collection: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, pagination: bool = True, joins: Any = None, locale: str | None = None) -> dict[str, Any]:
        """A page of documents with its numbers. Without pagination nothing is counted: the total is the page's size.

        The page is collected: with limit 0 all matches, which `documents_df` gives without that.
        """
        found = self._matched(collection, where, locale)
        return self._collected(collection, found, sort, limit, page, pagination, joins, locale)

    def _collected(self, slug: str, found: DataFrame, sort: Sort, limit: int, page: int, pagination: bool, wanted: Any, locale: str | None) -> dict[str, Any]:
        number, _, take = bounds(limit, page)
        rows = self._page(slug, found, sort, limit, page, locale)
        docs = self._documents(slug, self._joined(slug, rows, wanted, locale), sort, locale)
        total = found.count() if pagination and take else len(docs)
        return {"docs": docs, **page_info(total, limit, number, pagination)}

    def _in_order(self, slug: str, rows: DataFrame, sort: Sort, locale: str | None) -> DataFrame:
        """A page in its order, which joins may have disturbed."""
        before = [F.col("_supplement").asc()] if "_supplement" in rows.columns else None
        return rows.orderBy(*order_by(self.scope(slug, rows, locale), sort, before=before))

    def _documents(self, slug: str, rows: DataFrame, sort: Sort = None, locale: str | None = None) -> list[dict]:
        """Collected documents; joins may have disturbed the order, so it is made again."""
        return [self._document(slug, r) for r in self._in_order(slug, rows, sort, locale).collect()]

    def _document(self, slug: str, row: Row) -> dict:
        return documents.document(row.asDict(recursive=True), self._fields(slug))

    def first_df(self, slug: str, where: dict | None = None, locale: str | None = None) -> DataFrame:
        """The first match in the order of the ids' texts."""
        return self._page(slug, self.matching(slug, where, locale), None, 1, 1, locale)

    def find_one(self, collection: str, where: dict | None = None, joins: Any = None, locale: str | None = None) -> dict | None:
        """The first match; of a collection with drafts the first matching draft if no document matches."""
        row = self.first_df(collection, where, locale)
        docs = self._documents(collection, self._joined(collection, row, joins, locale))
        if not docs and self._with_drafts(collection):
            row = self._page(collection, self._matched(collection, where, locale), None, 1, 1, locale)
            docs = self._documents(collection, self._joined(collection, row, joins, locale))
        return docs[0] if docs else None

    def find_by_id(self, collection: str, id: Any) -> dict | None:
        return self.find_one(collection, {"id": {"equals": id}})

    def distinct_df(self, collection: str, field: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, locale: str | None = None) -> DataFrame:
        """One page of the distinct values of a field (column `value`); the path is taken as stored, lists are not entered, absent values left out."""
        found = self.matching(collection, where, locale)
        target = resolve(Scope(found, flatten(()), Catalog(), self.scope(collection, found, locale).id), field)
        if target.kind == "missing":
            return found.select(F.lit(None).alias("value")).filter(F.lit(False))
        values = found.select((target.raw if target.raw is not None else target.column).alias("value")).filter("value is not null").distinct()
        key = sort if isinstance(sort, str) else (sort or [""])[0]
        _, skip, take = bounds(limit, page)
        ordered = values.orderBy(F.col("value").desc_nulls_last() if key.startswith("-") else F.col("value").asc_nulls_first())
        return ordered if take is None else (ordered.offset(skip) if skip else ordered).limit(take)

    def find_distinct(self, collection: str, field: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, locale: str | None = None) -> dict[str, Any]:
        number, _, _ = bounds(limit, page)
        whole = self.distinct_df(collection, field, where, sort, 0, 1, locale)
        rows = self.distinct_df(collection, field, where, sort, limit, page, locale).collect()
        info = page_info(whole.count(), limit, number, True)
        return {"values": [{field: documents.presented(_plain(r["value"]))} for r in rows], **info}

    def count_df(self, slug: str, where: dict | None = None, locale: str | None = None) -> DataFrame:
        """totalDocs of a table; drafts are not counted."""
        return self.matching(slug, where, locale).agg(F.count(F.lit(1)).alias("totalDocs"))

    def count(self, collection: str, where: dict | None = None, locale: str | None = None) -> dict[str, int]:
        return {"totalDocs": self.count_df(collection, where, locale).first()["totalDocs"]}

    def count_versions(self, collection: str, where: dict | None = None, locale: str | None = None) -> dict[str, int]:
        return self.count(f"{collection}_versions", where, locale)

    count_global_versions = count_versions

    def find_versions_df(self, slug: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, locale: str | None = None) -> DataFrame:
        """One page of version rows; the filter is in their terms (`parent`, `latest`, `version.x`)."""
        name = f"{slug}_versions"
        return self._page(name, self.matching(name, where, locale), sort, limit, page, locale).drop("_rev")

    def find_versions(self, slug: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, pagination: bool = True, locale: str | None = None) -> dict[str, Any]:
        name = f"{slug}_versions"
        return self._collected(name, self.matching(name, where, locale), sort, limit, page, pagination, None, locale)

    find_global_versions = find_versions

    def latest_version_df(self, slug: str, parent: Any = None) -> DataFrame:
        """The latest version row of each parent, of one parent, or of a global."""
        rows = drafts.latest(self.frame(f"{slug}_versions"))
        if parent is None:
            return rows
        return rows.filter(F.col("parent") == cast_id(parent, self.catalog.id_type(slug)))

    def find_global(self, slug: str, where: dict | None = None, locale: str | None = None) -> dict | None:
        """The one document of a global, if it meets the filter."""
        rows = self.matching(slug, where, locale).limit(1).collect()
        return self._document(slug, rows[0]) if rows else None

    def drafts_df(self, collection: str, where: dict | None = None, locale: str | None = None) -> DataFrame:
        """The newest state of all documents that meet a filter: the latest version, or the document where there is none."""
        c = self.catalog.collections[collection]
        newest = drafts.lifted(drafts.latest(self.frame(f"{collection}_versions")), c.id)
        rows = drafts.overlay(self.frame(collection), newest, c.id)
        where = _strip_version(where)
        return rows.filter(self.condition(collection, rows, where, locale)) if where else rows

    def query_drafts_df(self, collection: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, joins: Any = None, locale: str | None = None) -> DataFrame:
        return self._joined(collection, self._page(collection, self.drafts_df(collection, where, locale), sort, limit, page, locale), joins, locale).drop("_rev")

    def query_drafts(self, collection: str, where: dict | None = None, sort: Sort = None, limit: int = 10, page: int = 1, pagination: bool = True, joins: Any = None, locale: str | None = None) -> dict[str, Any]:
        return self._collected(collection, self.drafts_df(collection, where, locale), sort, limit, page, pagination, joins, locale)

    def join_rows_df(self, collection: str, path: str, query: dict[str, Any] | None = None, where: dict | None = None, locale: str | None = None) -> DataFrame:
        """A join field in flat form: parent, rank, relationTo, child (as text) of each document on the join's page."""
        query = query or {}
        parents = self.matching(collection, where, locale)
        field = dict(self.catalog.collections[collection].joins())[path]
        rows, _ = joins.join_rows(parents, self.scope(collection, parents, locale), collection, field, query, self._related(locale), lambda s: self.catalog.collections[s].default_sort)
        skip, limit = joins.page_of(query, field)
        if limit:
            rows = rows.filter((F.col("_rank") > skip) & (F.col("_rank") <= skip + limit))
        return rows.select(F.col("_owner").alias("parent"), F.col("_rank").alias("rank"), "relationTo", F.col("_id").cast("string").alias("child"))

    # -------------------------------------------------------------- writing

    def _store(self, slug: str) -> Store:
        owner, versions = self._owner(slug)
        key = owner.id if isinstance(owner, Collection) and not versions else "id"
        return self.tables.store(slug, self._type(slug), key)

    def _retried(self, slug: str, attempt: Callable[[Store, int, DataFrame], Any]) -> Any:
        """Run attempt(store, commit number, rows) until no other writer comes between its reading and its commit."""
        store = self._store(slug)
        for k in range(ATTEMPTS):
            n = store.version()
            try:
                return attempt(store, n, store.read(n))
            except Conflict:
                time.sleep(0.01 * (k + 1))
        raise ConflictError(f"writing '{slug}' met other writers {ATTEMPTS} times")

    def _unique(self, slug: str) -> list[tuple[str, ...]]:
        """Stored paths that must be unique: plain unique fields at the top, in groups and in named tabs, by locale."""
        locales = self.catalog.localization.locales if self.catalog.localization else ()

        def walk(fields: dict[str, Field], above: tuple[str, ...], localized: bool) -> list[tuple[str, ...]]:
            out: list[tuple[str, ...]] = []
            for name, f in fields.items():
                here = [(*above, name, code) for code in locales] if f.localized and locales and not localized else [(*above, name)]
                if f.type == "group":
                    out += [p for h in here for p in walk(flatten(f.fields), h, localized or f.localized)]
                elif f.unique and not f.has_many and name != "id" and f.type not in ("array", "blocks", "join", "ui"):
                    out += here
            return out
        return walk(self.catalog.collections[slug].flat(), (), False)

    def _check_unique(self, slug: str, rows: DataFrame, docs: list[dict], key: str) -> None:
        """Raises ValidationError if a value of the documents is taken by another row, or by another of them."""
        taken = []
        for path in self._unique(slug):
            column = reduce(lambda c, n: c[n], path[1:], F.col(path[0]))
            values: dict[Any, Any] = {}
            for d in docs:
                value = reduce(lambda x, n: x.get(n) if isinstance(x, dict) else None, path, d)
                if value is None or value == "" or not isinstance(value, (str, int, float, bool)):
                    continue
                if value in values and values[value] != d[key]:
                    taken.append(".".join(path))
                values[value] = d[key]
            if values:
                hits = rows.filter(column.isin(list(values))).select(column.alias("v"), F.col(key).alias("k")).limit(len(values) * 2 + 1).collect()
                if any(values.get(r["v"]) != r["k"] for r in hits):
                    taken.append(".".join(path))
        if taken:
            raise ValidationError(f"values must be unique: {', '.join(dict.fromkeys(taken))}", list(dict.fromkeys(taken)))

    def _projected(self, slug: str, doc: dict) -> dict:
        """A document in stored form, cut down to what its schema knows."""
        owner, versions = self._owner(slug)
        kind, fields = self._type(slug), self._fields(slug)
        cut = documents.project_version(doc, owner.flat()) if versions else documents.project(doc, fields, (*documents.RESERVED, *((owner.id,) if isinstance(owner, Collection) else ())))
        return {f.name: documents.stored(cut.get(f.name), f.dataType, fields.get(f.name)) for f in kind.fields}

    def _frame_of(self, slug: str, docs: list[dict]) -> DataFrame:
        kind = self._type(slug)
        return self.spark.createDataFrame([tuple(_as_row(d.get(f.name), f.dataType) for f in kind.fields) for d in docs], kind)

    def _given_id(self, c: Collection, value: Any) -> Any:
        return cast_id(value, c.id_type) if value is not None else (None if c.id_type == "number" else str(uuid.uuid4()))

    def create(self, collection: str, data: dict, custom_id: Any = None, returning: bool = True) -> dict | None:
        """Insert a document; an id or unique value that is taken raises ValidationError."""
        c = self.catalog.collections[collection]
        given = custom_id if custom_id is not None else data.get("id", data.get(c.id))
        now = _now()
        doc = {**data, c.id: self._given_id(c, given), "createdAt": data.get("createdAt") or now, "updatedAt": data.get("updatedAt") or now}

        def attempt(store: Store, n: int, rows: DataFrame) -> dict:
            row = {**self._projected(collection, doc), "_rev": 1}
            if rows.filter(F.col(f"`{c.id}`") == row[c.id]).limit(1).count():
                raise ValidationError("id must be unique", ["id"])
            self._check_unique(collection, rows, [row], c.id)
            store.change(self._frame_of(collection, [row]), None, n)
            return row
        return self._returned(collection, self._retried(collection, attempt), returning)

    def create_many(self, collection: str, frame: DataFrame) -> int:
        """Insert a frame of documents at once; ids or unique values that are taken or repeated raise ValidationError."""
        c = self.catalog.collections[collection]

        def attempt(store: Store, n: int, rows: DataFrame) -> int:
            new = store.shaped(frame.withColumn("_rev", F.lit(1).cast("bigint")))
            for path in [(c.id,), *self._unique(collection)]:
                get = reduce(lambda x, name: x[name], path[1:], F.col(path[0]))
                key = get.alias("v")
                values = new.select(key).filter("v is not null")
                values = values.filter("v <> ''") if isinstance(values.schema["v"].dataType, T.StringType) else values
                twice = values.groupBy("v").count().filter("count > 1").limit(1).count()
                if twice or values.join(rows.select(key), "v", "left_semi").limit(1).count():
                    raise ValidationError(f"{'.'.join(path)} must be unique", [".".join(path)])
            return store.change(new, None, n)
        return self._retried(collection, attempt)

    def _returned(self, slug: str, row: dict | None, returning: bool) -> dict | None:
        return documents.document(row, self._fields(slug)) if row is not None and returning else None

    def _first(self, slug: str, rows: DataFrame, id: Any, where: dict | None, locale: str | None) -> dict | None:
        """The row of an id, or the first match, as stored."""
        owner, versions = self._owner(slug)
        key = owner.id if isinstance(owner, Collection) and not versions else "id"
        if id is not None:
            kind = owner.id_type if isinstance(owner, Collection) and not versions else "text"
            found = rows.filter(F.col(f"`{key}`") == cast_id(id, kind))
        elif where is not None:
            found = rows.filter(self.condition(slug, rows, where, locale)).orderBy(F.col(f"`{key}`").cast("string"))
        else:
            return None
        got = found.limit(1).collect()
        return got[0].asDict(recursive=True) if got else None

    def _merged(self, slug: str, row: dict, data: dict, stamp: Any = None) -> dict:
        """The stored row with the given keys replaced whole; the id stays."""
        owner, versions = self._owner(slug)
        key = owner.id if isinstance(owner, Collection) and not versions else "id"
        patch = {k: v for k, v in data.items() if k not in (key, "id")}
        new = self._projected(slug, {**{k: None for k in patch}, **patch, **({"updatedAt": stamp} if stamp is not None else {})})
        names = {*patch, *(["updatedAt"] if stamp is not None else [])}
        return {**row, **{k: v for k, v in new.items() if k in names}, key: row[key], "_rev": (row.get("_rev") or 0) + 1}

    def update_one(self, collection: str, data: dict, id: Any = None, where: dict | None = None, locale: str | None = None, returning: bool = True) -> dict | None:
        """Merge data into one document, by id or the first match; None if there is none."""
        c = self.catalog.collections[collection]

        def attempt(store: Store, n: int, rows: DataFrame) -> dict | None:
            found = self._first(collection, rows, id, where, locale)
            if found is None:
                return None
            row = self._merged(collection, found, data, data.get("updatedAt") or _now())
            self._check_unique(collection, rows, [row], c.id)
            store.change(self._frame_of(collection, [row]), None, n)
            return row
        return self._returned(collection, self._retried(collection, attempt), returning)

    def _patched(self, slug: str, rows: DataFrame, data: dict, stamp: Any) -> DataFrame:
        """The rows with the given keys replaced; as one plan, nothing is collected."""
        owner, versions = self._owner(slug)
        key = owner.id if isinstance(owner, Collection) and not versions else "id"
        names = [k for k in {**data, "updatedAt": stamp} if k not in (key, "id") and k in rows.columns]
        new = self._projected(slug, {**data, "updatedAt": stamp})
        columns = {k: _constant(new.get(k), rows.schema[k].dataType) for k in names}
        return rows.withColumns({**columns, "_rev": F.coalesce("_rev", F.lit(0)) + 1})

    def update_many_df(self, collection: str, rows: DataFrame, data: dict, where: dict | None = None, sort: Sort = None, limit: int = 0, locale: str | None = None, stamp: Any = None) -> DataFrame:
        """The documents that an update of many would write, in order."""
        found = rows.filter(self.condition(collection, rows, where, locale)) if where else rows
        scope = self.scope(collection, found, locale)
        if limit and limit > 0:
            found = found.orderBy(*order_by(scope, sort)).limit(limit)
        return self._patched(collection, found, data, data.get("updatedAt") or stamp or _now())

    def update_many_rows(self, collection: str, data: dict, where: dict | None = None, sort: Sort = None, limit: int = 0, locale: str | None = None, returning: bool = True) -> DataFrame | None:
        """Merge data into all matches (the first `limit` in order), with one time stamp; the rows as written, in order."""
        stamp = _now()
        c = self.catalog.collections[collection]

        def attempt(store: Store, n: int, rows: DataFrame) -> DataFrame:
            changed = self.update_many_df(collection, rows, data, where, sort, limit, locale, stamp)
            given = self._projected(collection, data)
            for path in self._unique(collection):
                value = reduce(lambda x, name: x.get(name) if isinstance(x, dict) else None, path, given)
                if path[0] in data and value not in (None, ""):
                    column = reduce(lambda x, name: x[name], path[1:], F.col(path[0]))
                    ids = changed.select(F.col(c.id).alias("_c"))
                    if changed.limit(2).count() > 1 or rows.filter(column == value).join(ids, F.col(c.id) == F.col("_c"), "left_anti").limit(1).count() and changed.limit(1).count():
                        raise ValidationError(f"{'.'.join(path)} must be unique", [".".join(path)])
            done = store.change(changed, None, n)
            return store.delta(done).drop("_rev").orderBy(*order_by(self.scope(collection, rows, locale), sort))
        rows = self._retried(collection, attempt)
        return rows if returning else None

    def update_many(self, collection: str, data: dict, where: dict | None = None, sort: Sort = None, limit: int = 0, locale: str | None = None, returning: bool = True) -> Iterator[dict] | None:
        """`update_many_rows` as documents, which come to the driver a partition at a time."""
        rows = self.update_many_rows(collection, data, where, sort, limit, locale, returning)
        return self._streamed(collection, rows) if rows is not None else None

    def _streamed(self, slug: str, rows: DataFrame) -> Iterator[dict]:
        return (self._document(slug, r) for r in rows.toLocalIterator())

    def upsert(self, collection: str, data: dict, where: dict | None = None, locale: str | None = None, returning: bool = True) -> dict | None:
        """Merge data into the first match, or insert it."""
        c = self.catalog.collections[collection]
        new_id = self._given_id(c, data.get("id", data.get(c.id)))

        def attempt(store: Store, n: int, rows: DataFrame) -> dict:
            found = self._first(collection, rows, None, where or {}, locale)
            now = _now()
            if found is not None:
                row = self._merged(collection, found, data, data.get("updatedAt") or now)
            else:
                row = {**self._projected(collection, {**data, c.id: new_id, "createdAt": data.get("createdAt") or now, "updatedAt": data.get("updatedAt") or now}), "_rev": 1}
                if rows.filter(F.col(f"`{c.id}`") == row[c.id]).limit(1).count():
                    raise ValidationError("id must be unique", ["id"])
            self._check_unique(collection, rows, [row], c.id)
            store.change(self._frame_of(collection, [row]), None, n)
            return row
        return self._returned(collection, self._retried(collection, attempt), returning)

    def delete_one(self, collection: str, where: dict | None = None, locale: str | None = None, returning: bool = True) -> dict | None:
        """Remove the first match and return it; None if there is none."""
        def attempt(store: Store, n: int, rows: DataFrame) -> dict | None:
            found = self._first(collection, rows, None, where or {}, locale)
            if found is not None:
                store.change(None, self._frame_of(collection, [found]).select(store.key), n)
            return found
        return self._returned(collection, self._retried(collection, attempt), returning)

    def delete_many(self, slug: str, where: dict | None = None, locale: str | None = None) -> None:
        """Remove all matches."""
        def attempt(store: Store, n: int, rows: DataFrame) -> None:
            found = rows.filter(self.condition(slug, rows, where, locale)) if where else rows
            store.change(None, found.select(f"`{store.key}`"), n)
        self._retried(slug, attempt)

    def delete_versions(self, collection: str | None = None, global_slug: str | None = None, where: dict | None = None, locale: str | None = None) -> None:
        if not (collection or global_slug):
            raise ValueError("delete_versions needs a collection or a global")
        self.delete_many(f"{collection or global_slug}_versions", where, locale)

    def create_version(self, slug: str, version: dict, parent: Any = None, autosave: bool = False, created_at: Any = None, updated_at: Any = None, snapshot: bool = False, published_locale: str | None = None, returning: bool = True) -> dict | None:
        """Add a version as the latest of its parent (of a global: of all); the one that was the latest is not any more."""
        name, owner = f"{slug}_versions", self._owner(slug)[0]
        now = _now()
        item = {"id": str(uuid.uuid4()), "version": version, "createdAt": created_at or now, "updatedAt": updated_at or now, "latest": True, "autosave": autosave,
                **({"parent": cast_id(parent, owner.id_type)} if isinstance(owner, Collection) else {}), **({"snapshot": True} if snapshot else {}), **({"publishedLocale": published_locale} if published_locale is not None else {})}

        def attempt(store: Store, n: int, rows: DataFrame) -> dict:
            row = {**self._projected(name, item), "_rev": 1}
            before = rows.filter("latest")
            if isinstance(owner, Collection):
                before = before.filter(F.col("parent") == row["parent"])
            demoted = before.withColumns({"latest": F.lit(False), "_rev": F.coalesce("_rev", F.lit(0)) + 1})
            store.change(self._frame_of(name, [row]).unionByName(demoted), None, n)
            return row
        return self._returned(name, self._retried(name, attempt), returning)

    create_global_version = create_version

    def update_version(self, slug: str, version_data: dict, id: Any = None, where: dict | None = None, locale: str | None = None, returning: bool = True) -> dict | None:
        """Merge data into one version row; marks of other versions stay."""
        name = f"{slug}_versions"

        def attempt(store: Store, n: int, rows: DataFrame) -> dict | None:
            found = self._first(name, rows, id, where, locale)
            if found is None:
                return None
            row = self._merged(name, found, version_data)
            store.change(self._frame_of(name, [row]), None, n)
            return row
        return self._returned(name, self._retried(name, attempt), returning)

    update_global_version = update_version

    def create_global(self, slug: str, data: dict, returning: bool = True) -> dict | None:
        """Write the one document of a global; its id is the slug."""
        now = _now()
        doc = {**data, "id": slug, "globalType": slug, "createdAt": data.get("createdAt") or now, "updatedAt": data.get("updatedAt") or now}

        def attempt(store: Store, n: int, rows: DataFrame) -> dict:
            row = {**self._projected(slug, doc), "_rev": 1}
            store.change(self._frame_of(slug, [row]), None, n)
            return row
        return self._returned(slug, self._retried(slug, attempt), returning)

    def update_global(self, slug: str, data: dict, returning: bool = True) -> dict | None:
        """Merge data into a global; None if it was never created. Its time stamp changes only if given."""
        def attempt(store: Store, n: int, rows: DataFrame) -> dict | None:
            found = self._first(slug, rows, slug, None, None)
            if found is None:
                return None
            row = self._merged(slug, found, data)
            store.change(self._frame_of(slug, [row]), None, n)
            return row
        return self._returned(slug, self._retried(slug, attempt), returning)

    def update_jobs_rows(self, data: dict, id: Any = None, where: dict | None = None, sort: Sort = None, limit: int = 0, collection: str = JOBS) -> DataFrame:
        """Claim jobs: merge data into a job by id or the first matches in order; the rows as written, in order.

        `log: {"$push": entry}` appends to the log, a non-empty list replaces it, anything else leaves it. A missing
        `updatedAt` means now.
        """
        c = self.catalog.collections[collection]
        log, rest = data.get("log"), {k: v for k, v in data.items() if k not in ("log", "updatedAt")}
        stamp = data.get("updatedAt") or _now()

        def attempt(store: Store, n: int, rows: DataFrame) -> DataFrame:
            order = order_by(self.scope(collection, rows, None), sort or c.default_sort or "-createdAt")
            if id is not None:
                found = rows.filter(F.col(f"`{c.id}`") == cast_id(id, c.id_type))
            else:
                found = rows.filter(self.condition(collection, rows, where)) if where else rows
                found = found.orderBy(*order).limit(limit) if limit and limit > 0 else found
            changed = self._patched(collection, found, rest, stamp)
            kind = rows.schema["log"].dataType if "log" in rows.columns else None
            if kind is not None and isinstance(log, list) and log:
                changed = changed.withColumn("log", _constant(self._projected(collection, {"log": log})["log"], kind))
            elif kind is not None and isinstance(log, dict) and "$push" in log:
                pushed = log["$push"] if isinstance(log["$push"], list) else [log["$push"]]
                more = _constant(self._projected(collection, {"log": pushed})["log"] or [], kind)
                changed = changed.withColumn("log", F.concat(F.coalesce("log", F.array().cast(kind)), more))
            return store.delta(store.change(changed, None, n)).drop("_rev").orderBy(*order)
        return self._retried(collection, attempt)

    def update_jobs(self, data: dict, id: Any = None, where: dict | None = None, sort: Sort = None, limit: int = 0, returning: bool = True, collection: str = JOBS) -> Iterator[dict] | None:
        """`update_jobs_rows` as documents, which come to the driver a partition at a time."""
        rows = self.update_jobs_rows(data, id, where, sort, limit, collection)
        return self._streamed(collection, rows) if returning else None

    # -------------------------------------------------------------- maintenance

    def unique_conflicts_df(self, collection: str) -> DataFrame:
        """Values of unique fields that several documents hold: path, value (as text), count."""
        rows = self.frame(collection)
        parts = []
        for path in self._unique(collection):
            column = reduce(lambda c, n: c[n], path[1:], F.col(path[0]))
            values = rows.select(column.cast("string").alias("value")).filter("value is not null and value <> ''")
            parts.append(values.groupBy("value").agg(F.count(F.lit(1)).alias("count")).filter("count > 1").select(F.lit(".".join(path)).alias("path"), "value", "count"))
        if not parts:
            return self.spark.createDataFrame([], "path string, value string, count bigint")
        return reduce(DataFrame.unionByName, parts)

    def backfill(self) -> dict[str, Any]:
        """A report on unique fields of all collections: conflicts, and which paths are free of them.

        `conflicts` has a DataFrame of all conflicts (`unique_conflicts_df`) for each collection with any.
        """
        report: dict[str, Any] = {"conflicts": {}, "ready": []}
        for slug in self.catalog.collections:
            if not self._unique(slug):
                continue
            found = self.unique_conflicts_df(slug)
            if broken := {r["path"] for r in found.select("path").distinct().collect()}:
                report["conflicts"][slug] = found
            report["ready"] += [f"{slug}.{'.'.join(p)}" for p in self._unique(slug) if ".".join(p) not in broken]
        return report

    def compact(self, slug: str, deltas_only: bool = False) -> None:
        """Fold the changes of a written table into its base, or into one change set; see `Store.compact`."""
        self._store(slug).compact(deltas_only)

    def clean(self, slug: str, keep: int = 10, older_than: float = 24 * 3600) -> None:
        """Remove what old commits of a written table left; see `Store.clean`."""
        self._store(slug).clean(keep, older_than)

    def scrub(self, slug: str, raw: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """Cut raw rows down to the schema: (rows in stored form, how many were scanned and modified)."""
        kind = self._type(slug)
        json_of = raw.select(F.struct("*").alias("_raw"), F.to_json(F.struct("*")).alias("_text"))
        cut = json_of.select("_raw", "_text", F.from_json("_text", kind, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSS]['Z']"}).alias("_doc"))
        marked = cut.select("_doc", (F.to_json(F.from_json("_text", raw.schema)) != F.to_json(fit(F.col("_doc"), kind, raw.schema))).alias("_modified"))
        report = marked.agg(F.count(F.lit(1)).alias("scanned"), F.coalesce(F.sum(F.col("_modified").cast("int")), F.lit(0)).alias("modified")).first().asDict()
        return marked.select("_doc.*"), report


def _plain(value: Any) -> Any:
    return value.asDict(recursive=True) if isinstance(value, Row) else value


def _as_row(value: Any, kind: T.DataType) -> Any:
    """Dictionaries as rows of a struct."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(_as_row(value.get(f.name), f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return [_as_row(x, kind.elementType) for x in value]
    return value


def _constant(value: Any, kind: T.DataType) -> Column:
    """A collected value as a constant column of a type."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*(_constant(value[f.name], f.dataType).alias(f.name) for f in kind.fields))
    if isinstance(kind, T.ArrayType):
        return F.array(*(_constant(x, kind.elementType) for x in value)).cast(kind)
    if isinstance(value, datetime):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)
    return F.lit(value).cast(kind)
