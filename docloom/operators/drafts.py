"""Views over versions: the latest of each document, drafts that were never published, and the newest state of all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(versions: DataFrame) -> DataFrame:
    """The latest version of each parent: by the `latest` mark, or by time where there is none."""
    if "latest" in versions.columns:
        return versions.filter("latest")
    w = Window.partitionBy("parent").orderBy(F.desc_nulls_last("updatedAt"), F.desc(F.col("id").cast("string")))
    return versions.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def lifted(versions: DataFrame, id_col: str) -> DataFrame:
    """Version rows as documents: the snapshot's fields at the top, the parent as id. Rows without a snapshot go."""
    inner = versions.schema["version"].dataType.names
    fields = [F.col("version")[n].alias(n) for n in inner if n != id_col]
    return versions.filter("version is not null").select(F.col("parent").alias(id_col), *fields)


def supplement(matched: DataFrame, drafts: DataFrame, id_col: str) -> DataFrame:
    """The matched documents (_supplement 0) and the drafts of documents that are not among them (1)."""
    seen = matched.select(F.col(f"`{id_col}`").alias("_seen"))
    extra = drafts.join(seen, F.col(f"`{id_col}`") == F.col("_seen"), "left_anti")
    return matched.withColumn("_supplement", F.lit(0)).unionByName(extra.withColumn("_supplement", F.lit(1)), allowMissingColumns=True)


def overlay(main: DataFrame, newest: DataFrame, id_col: str) -> DataFrame:
    """The newest version of each document, and documents that have no version as they are."""
    seen = newest.select(F.col(f"`{id_col}`").alias("_seen"))
    rest = main.join(seen, F.col(f"`{id_col}`") == F.col("_seen"), "left_anti")
    return newest.unionByName(rest, allowMissingColumns=True)
