"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Equal texts are found in three stages, and each compares the full normalised text as a grouping key:
1. every task combines the equal texts that it reads (the partial aggregation of the first group-by);
2. groups of (digest, salt, text) are merged, so that a text that a third of all rows hold is spread over
   `salts` reducers and reaches each as one row for a task;
3. the salt winners of a text are merged into its global winner.
Rows learn their winner by a join on the 256-bit digest and the salt, so that no key of that join holds more than one
`salts`-th of a group. That a digest stands for one text only is not taken for granted: the third stage counts the texts
of each digest and fails if there are two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What separates words; runs of it count as one space.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def normalised(text):
    """Null counts as empty; each run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _fresh(name: str, taken: list[str]) -> str:
    """A column name that no caller's column has, whatever its case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def _digest(text):
    """SHA-256. It is never null, but only so Spark knows: else joins would compute it once more to filter by it."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def winners(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """(_sha, _salt, keep_id, group_size) of each distinct normalised text and each salt that a row of it has."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), normalised(F.col(f"`{text_col}`")).alias("_text"))
    rows = rows.select("_id", "_text", _digest(F.col("_text")).alias("_sha"), _salt(F.col("_id"), salts).alias("_salt"))
    salted = rows.groupBy("_sha", "_salt", "_text").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    whole = salted.repartition("_sha").groupBy("_sha", "_text").agg(F.min("_id").alias("keep_id"), F.sum("_n").alias("group_size"))
    one = whole.groupBy("_sha").agg(F.count(F.lit(1)).alias("_texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    sure = one.select("_sha", "keep_id", F.when(F.col("_texts") > 1, F.raise_error(F.lit("two texts have one digest")).cast("bigint")).otherwise(F.col("group_size")).alias("group_size"))
    # reads all that `salted` holds, so that its rows are made and sent once for both uses
    used = salted.filter("_n > 0 or _id is null").select("_sha", "_salt")
    return used.join(sure, "_sha")


def _salt(id_, salts: int):
    return F.coalesce(F.pmod(F.xxhash64(id_), F.lit(salts)).cast("int"), F.lit(0))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """All rows and columns of docs with keep_id, group_size, kept and text_sha256 (columns of these names are replaced).

    Texts are equal when they are identical after each run of `[\\x20\\x09-\\x0D]` became one space; null counts as
    empty, and empty texts are equal to each other. Of equal texts the smallest id stays. A null id is larger than
    any other: such a row stays only if no row of its group has an id (keep_id is null then). Rows that repeat an id
    and a text are alike, so all of them are marked as kept. An empty table gives an empty result. Very long texts are
    compared whole.
    """
    own = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    sha, salt = _fresh("_sha", own.columns), _fresh("_salt", own.columns)
    keyed = own.withColumns({sha: _digest(normalised(F.col(f"`{text_col}`"))), salt: _salt(F.col(f"`{id_col}`"), salts)})
    best = winners(docs, id_col=id_col, text_col=text_col, salts=salts).withColumnsRenamed({"_sha": sha, "_salt": salt})
    joined = keyed.join(best, [sha, salt], "left")
    return joined.withColumns({"kept": F.col(f"`{id_col}`").eqNullSafe(F.col("keep_id")), "text_sha256": F.lower(F.hex(sha))}).drop(sha, salt)


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of docs that stay, with the columns of docs: exactly one of each group of equal texts.

    The same three stages, but the winning row itself is carried along, so the texts are not joined again. The text as
    it was is carried only where normalising changed it. Of rows with one id, the one with the least hash of its
    columns (but maps and variants) stays; a null id is larger than any other.
    """
    text, others = F.col(text_col), [c for c in docs.columns if c != text_col]
    norm = normalised(text)
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    rows = docs.select(
        F.sha2(norm, 256).alias("_sha"), F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("_salt"), norm.alias("_text"),
        F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(*hashed).alias("mark")).alias("_rank"),
        F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)), text.isNull().alias("null_text"), F.when(text != norm, text).alias("raw_text")).alias("_row"))

    def best(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.min_by("_row", "_rank").alias("_row"), F.min("_rank").alias("_rank"))

    whole = best(best(rows, "_sha", "_salt", "_text"), "_sha", "_text")
    back = F.when(~F.col("_row.null_text"), F.coalesce("_row.raw_text", "_text"))
    return whole.select(*(back.alias(c) if c == text_col else F.col(f"_row.c{others.index(c)}").alias(c) for c in docs.columns))
