"""Queries that apply each operator to its whole table, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, ngram_join, passages, secrets, sharding, suffix_dedup, warc
from . import pieces as piece_model
from ._common import table
from .fingerprint import compare_neighbours


#: A public vocabulary; it stays where it is.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_learned(table(spark, sf_dir, "documents")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.near_equal(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pieces(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    return piece_model.round_trip(table(spark, sf_dir, "documents"), piece_model.read_model(model))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


WARC_SQL = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
             CASE WHEN strlen(html) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY html) THEN max(page_id) OVER (PARTITION BY html) END AS refers_to
      FROM pages)
"""

#: Windows as 200 hexadecimal digits; all but the first of each are removed.
DEDUP_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
marked AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS fresh FROM gone),
runs AS (SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM runs GROUP BY doc_id, run),
parts AS (SELECT doc_id, s, substr(h, 2 * before + 1, 2 * (s - before)) AS part
          FROM (SELECT doc_id, h, s, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before
                FROM (SELECT doc_id, h, s, e FROM spans JOIN d USING (doc_id) UNION ALL SELECT doc_id, h, length(h) // 2, NULL FROM d))),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY s) AS h FROM parts GROUP BY doc_id),
sums AS (SELECT doc_id, sum(e - s) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

LINKS_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles FROM w),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b
          FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secrets, op2_sharding, op3_decontamination, op4_pieces, op5_passages, op6_langid, op7_fingerprint, op8_suffix_dedup, op9_ngram_join, op10_warc)}


def oracle_sql() -> dict[str, str]:
    return {"op8_suffix_dedup": DEDUP_SQL, "op9_ngram_join": LINKS_SQL, "op10_warc": WARC_SQL}
