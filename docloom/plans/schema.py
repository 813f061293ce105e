"""Schemas of collections and globals, and what queries ask of them.

A schema is a list of fields. Rows, collapsibles and unnamed tabs only lay fields out, so they vanish when a schema is
flattened; a named tab is a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Field types by what they store.
TEXT_TYPES = frozenset({"text", "textarea", "email", "code", "radio", "select"})
LAYOUT_TYPES = frozenset({"row", "collapsible"})
RELATION_TYPES = frozenset({"relationship", "upload"})
FREE_TYPES = frozenset({"json", "richText"})
UNSTORED_TYPES = frozenset({"join", "ui"})


@dataclass(frozen=True)
class Field:
    """One field. `fields` are those of a group, array, tab or layout; `blocks` maps block names to fields."""

    name: str = ""
    type: str = "text"
    fields: tuple[Field, ...] = ()
    blocks: tuple[tuple[str, tuple[Field, ...]], ...] = ()
    has_many: bool = False
    relation_to: str | tuple[str, ...] | None = None
    localized: bool = False
    unique: bool = False
    index: bool = False
    #: of a join field: the collection(s) joined, the path there that points here, and defaults
    collection: str | tuple[str, ...] | None = None
    on: str | None = None
    default_limit: int | None = None
    default_sort: str | None = None

    @property
    def polymorphic(self) -> bool:
        return isinstance(self.relation_to, (tuple, list))


def flatten(fields: Iterable[Field]) -> dict[str, Field]:
    """The fields by name, layout fields replaced by what they hold."""
    out: dict[str, Field] = {}
    for f in fields:
        if f.type in LAYOUT_TYPES:
            out |= flatten(f.fields)
        elif f.type == "tabs":
            for tab in f.fields:
                out |= {tab.name: replace(tab, type="group")} if tab.name else flatten(tab.fields)
        else:
            out[f.name] = f
    return out


def children(f: Field) -> dict[str, Field]:
    """The fields below f; those of all blocks together."""
    if f.type == "blocks":
        return {k: v for _, fields in f.blocks for k, v in flatten(fields).items()}
    return flatten(f.fields)


@dataclass(frozen=True)
class Collection:
    """A set of documents. `id` is the column that holds their id; `id_type` is text or number."""

    slug: str
    fields: tuple[Field, ...] = ()
    id: str = "id"
    id_type: str = "text"
    versions: bool = False
    drafts: bool = False
    default_sort: str | None = None

    def flat(self) -> dict[str, Field]:
        return flatten(self.fields)

    def joins(self) -> Iterator[tuple[str, Field]]:
        """(dotted path, field) of the join fields."""
        def walk(fields: dict[str, Field], prefix: str) -> Iterator[tuple[str, Field]]:
            for name, f in fields.items():
                if f.type == "join":
                    yield prefix + name, f
                elif f.type == "group":
                    yield from walk(flatten(f.fields), f"{prefix}{name}.")
        return walk(self.flat(), "")


@dataclass(frozen=True)
class Global:
    """A single document."""

    slug: str
    fields: tuple[Field, ...] = ()
    versions: bool = False

    def flat(self) -> dict[str, Field]:
        return flatten(self.fields)


@dataclass(frozen=True)
class Localization:
    locales: tuple[str, ...]
    default: str

    def effective(self, locale: str | None) -> str:
        return locale if locale and locale not in ("all", "*") else self.default


#: Columns of a version row beside `version`, with their types.
VERSION_META = (("id", "text"), ("parent", "text"), ("createdAt", "date"), ("updatedAt", "date"), ("latest", "checkbox"),
                ("autosave", "checkbox"), ("snapshot", "checkbox"), ("publishedLocale", "text"))


def version_fields(owner: Collection | Global) -> dict[str, Field]:
    """Fields of the version rows of a collection or a global: metadata and the snapshot as a group."""
    out = {n: Field(n, t) for n, t in VERSION_META if n != "parent"}
    if isinstance(owner, Collection):
        out["parent"] = Field("parent", "relationship", relation_to=owner.slug)
    out["version"] = Field("version", "group", fields=owner.fields)
    return out


@dataclass
class Catalog:
    """All collections and globals, by slug."""

    collections: dict[str, Collection] = field(default_factory=dict)
    globals: dict[str, Global] = field(default_factory=dict)
    localization: Localization | None = None

    def id_type(self, slug: str) -> str:
        c = self.collections.get(slug)
        return c.id_type if c else "text"


# ------------------------------------------------------------------ Spark types

def spark_type(f: Field, catalog: Catalog, localized_above: bool = False) -> T.DataType:
    """The column type that stores field f."""
    inner = _inner(f, catalog, localized_above or f.localized)
    if f.localized and not localized_above and catalog.localization:
        return T.StructType([T.StructField(code, inner) for code in catalog.localization.locales])
    return inner


def _inner(f: Field, catalog: Catalog, localized: bool) -> T.DataType:
    if f.type in ("group", "array"):
        body = struct_type(flatten(f.fields), catalog, localized)
        return body if f.type == "group" else T.ArrayType(T.StructType([T.StructField("id", T.StringType()), *(x for x in body.fields if x.name != "id")]))
    if f.type == "blocks":
        body = struct_type(children(f), catalog, localized)
        return T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("blockType", T.StringType()), *(x for x in body.fields if x.name not in ("id", "blockType"))]))
    if f.type in RELATION_TYPES:
        ids = {catalog.id_type(s) for s in ([f.relation_to] if isinstance(f.relation_to, str) else f.relation_to or ())}
        leaf: T.DataType = T.LongType() if ids == {"number"} else T.StringType()
        if f.polymorphic:
            leaf = T.StructType([T.StructField("relationTo", T.StringType()), T.StructField("value", leaf)])
    else:
        leaf = {"number": T.DoubleType(), "checkbox": T.BooleanType(), "date": T.TimestampNTZType(), "point": T.ArrayType(T.DoubleType())}.get(f.type, T.StringType())
    return T.ArrayType(leaf) if f.has_many else leaf


def struct_type(fields: dict[str, Field], catalog: Catalog, localized: bool = False) -> T.StructType:
    return T.StructType([T.StructField(n, spark_type(f, catalog, localized)) for n, f in fields.items() if f.type not in UNSTORED_TYPES])


def document_type(owner: Collection | Global, catalog: Catalog) -> T.StructType:
    """The columns of a stored document: id, the fields, and what every document has."""
    fields = owner.flat()
    key = owner.id if isinstance(owner, Collection) else "id"
    number = isinstance(owner, Collection) and owner.id_type == "number"
    body = [x for x in struct_type(fields, catalog).fields if x.name != key]
    meta = [T.StructField(n, t) for n, t in (("createdAt", T.TimestampNTZType()), ("updatedAt", T.TimestampNTZType()), ("_status", T.StringType()), ("_rev", T.LongType())) if n not in fields]
    if isinstance(owner, Global):
        meta.append(T.StructField("globalType", T.StringType()))
    return T.StructType([T.StructField(key, T.LongType() if number else T.StringType()), *body, *meta])


def version_type(owner: Collection | Global, catalog: Catalog) -> T.StructType:
    """The columns of a version row."""
    snapshot = T.StructType([x for x in document_type(owner, catalog).fields if x.name != "_rev"])
    kinds = {"text": T.StringType(), "date": T.TimestampNTZType(), "checkbox": T.BooleanType()}
    meta = [T.StructField(n, kinds[t]) for n, t in VERSION_META if n != "parent" or isinstance(owner, Collection)]
    if isinstance(owner, Collection) and owner.id_type == "number":
        meta = [T.StructField("parent", T.LongType()) if x.name == "parent" else x for x in meta]
    return T.StructType([*meta, T.StructField("version", snapshot), T.StructField("_rev", T.LongType())])
