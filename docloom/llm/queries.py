"""The queries of this subpackage, each an operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, jaccard_join, langid, pii, quality, spm, substring_dedup, toxicity, warc

#: A public model file, a parameter of op4's operator.
MODEL = os.environ.get("SPM_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = langid.fit_on(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, models, reject=False).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "fits")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode(table(spark, sf_dir, "documents"), MODEL)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.best_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.predict(docs, toxicity.fit_on(docs, table(spark, sf_dir, "labels")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_on(docs, table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id"))))
    return quality.predict(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES: dict[str, Query] = {
    "op1_langid": op1_langid,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
        w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos, ws FROM d),
        g AS (SELECT doc_id, pos, word, CASE WHEN pos + 12 <= len(ws) THEN array_to_string(ws[pos:pos + 12], ' ') END AS gram FROM w),
        o AS (SELECT doc_id, pos, word, gram IS NOT NULL AND min(doc_id) OVER (PARTITION BY gram) < doc_id AS hit FROM g),
        c AS (SELECT doc_id, pos, word, max(hit::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS gone FROM o),
        a AS (SELECT doc_id, count(*) AS n_words, sum(gone::INT)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)""",
    "op7_jaccard_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, gram FROM (
            SELECT doc_id, array_to_string(ws[p:p + 3], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS p FROM d WHERE len(ws) >= 4)
            UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
        f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT f.b, r.c FROM r JOIN f ON f.a = r.doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id, n""",
    "op3_warc": r"""
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, url, octet_length(encode(h)) AS payload_bytes, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS best FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
               list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + (((('0x' || substr(s, 1 + 5 * (i // 4)::INT, 5))::BIGINT) >> ((3 - (i % 4)) * 5)::INT) & 31)::INT, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to, url
        FROM d""",
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        k AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM k""",
}
