"""A corpus pipeline of five stages: toxicity, exact copies, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and returns a DataFrame; all but
the last return the columns of documents. Stages that fit a model learn from the labelled documents in sf_dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import decontaminate, exact_dedup, jaccard_join, spm, toxicity
from docloom.llm.common import materialize
from docloom.llm.queries import MODEL, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression calls toxic go."""
    model = toxicity.fit_on(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space apart) the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity 0.8 on five-word shingles connect, the smallest doc_id stays."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and round_trip of each document."""
    return spm.encode(docs, MODEL)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies), ("decontaminate", drop_leaks), ("sentencepiece", tokenize)]

#: No stage but the second can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
