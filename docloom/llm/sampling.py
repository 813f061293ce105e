"""Bounded samples of labelled texts for fitting a classifier. Nothing else may use them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most texts of one class, and most bytes of text of one class, that are sent to the driver to fit a classifier.
PER_CLASS = 2500
CLASS_BYTES = 12_000_000
#: Most classes; more raise ValueError.
CLASSES = 500


def bounded_sample(labelled: DataFrame, docs: DataFrame, *, id_col: str = "doc_id", label_col: str, text_col: str = "text", per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES, classes: int = CLASSES) -> list[tuple]:
    """(label, text) of at most `per_class` documents and `class_bytes` bytes of each label, chosen by a hash of the id.

    The choice depends on ids, labels and texts alone, so it is the same in every run and process. Rows with a null id,
    label or text are left out, as are texts above `class_bytes`; texts are whole. Ids come in the order of their hash,
    and texts of a class are taken until they would exceed its bytes. Rows that repeat an id and a label count once
    among the ids; documents that repeat an id are all candidates. Only the sample itself reaches the driver; more than
    `classes` labels raise ValueError. No labels give an empty sample.
    """
    rows = labelled.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).dropna().withColumn("_h", F.pmod(F.xxhash64("_id"), F.lit(1 << 40)))
    counts = rows.groupBy("_label").agg(F.approx_count_distinct("_id", 0.03).alias("n")).limit(classes + 1).collect()
    if len(counts) > classes:
        raise ValueError(f"more than {classes} different labels")
    if not counts:
        return []
    # of each class about as many ids as wanted and a margin that chance does not use up; then exactly the least hashes
    margin = 1.2 * per_class + 6 * per_class ** 0.5 + 20
    near = reduce(lambda a, b: a | b, ((F.col("_label") == F.lit(r["_label"])) & (F.col("_h") < int(min(1.0, margin / max(r["n"], 1)) * (1 << 40))) for r in counts))
    by_hash = Window.partitionBy("_label").orderBy("_h", "_id")
    picked = rows.filter(near).distinct().withColumn("_r", F.row_number().over(by_hash)).filter(F.col("_r") <= per_class).drop("_r")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.octet_length(text_col).alias("_n")).filter(F.col("_n") <= class_bytes)
    order = Window.partitionBy("_label").orderBy("_h", "_id", F.xxhash64("_text"))
    found = texts.join(F.broadcast(picked), "_id").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= per_class)
    running = found.withColumn("_sum", F.sum("_n").over(Window.partitionBy("_label").orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return sorted((r["_label"], r["_text"]) for r in running.filter(F.col("_sum") <= class_bytes).select("_label", "_text").collect())


def split_of(text: str, parts: int = 5) -> int:
    """Which part of a sample a text belongs to, for calibration apart from fitting."""
    import zlib

    return zlib.crc32(text.encode()) % parts
