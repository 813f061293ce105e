"""Nested values in another shape: fields by name, at every depth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fit(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type `have` as one of type `want`: absent fields are null, unknown ones go, the others are cast."""
    if have == want:
        return c
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        parts = [(fit(c[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: fit(x, have.elementType, want.elementType))
    return c.cast(want)
