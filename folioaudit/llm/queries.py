"""One query per operator over its whole table, and SQL for those SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bilinear, decontaminate, language, linededup, merkle, minmax, packing, pii, qualitynet, rules, secretscan, sharding, whitening
from .common import table

# Key of the registered pseudonym query; a job passes its own secret.
PSEUDONYM_KEY = "registered query, not a secret"


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def op2_byte_convolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualitynet.qualities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_segmentation_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages_of(table(spark, sf_dir, "documents"))


def op6_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeated_text(table(spark, sf_dir, "documents"), "doc_id")


def op7_linked_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secrets(table(spark, sf_dir, "documents"))


def op8_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), PSEUDONYM_KEY, "doc_id")


def op10_line_first_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"), "doc_id").drop("clean_text")


def op11_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.scores_of(table(spark, sf_dir, "documents"))


def op12_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_persistent_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_breaks())


_ALL = (
    op1_bounded_ring,
    op2_byte_convolutions,
    op3_minmax_near_dedup,
    op4_template_decontamination,
    op5_segmentation_unigrams,
    op6_winnowed_lines,
    op7_linked_credentials,
    op8_certified_packing,
    op9_feistel_pseudonyms,
    op10_line_first_rules,
    op11_log_bilinear,
    op12_chebyshev_whitening,
    op13_persistent_manifest,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

ORACLES: dict[str, str] = {
    # All pairs that share a shingle, compared exactly.
    "op3_minmax_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(ws) = 0 THEN []
         WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * hits >= 75 * (x.n + y.n - hits)
), reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
  least(w.doc_id, coalesce(min(r.other), w.doc_id)) AS component_id,
  w.doc_id = least(w.doc_id, coalesce(min(r.other), w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach r ON r.doc_id = w.doc_id
GROUP BY w.doc_id, n.n
""",
    # Windows by position, lines one by one; the rules' patterns written out.
    "op10_line_first_rules": r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM t
), grams AS (
  SELECT row, k, array_to_string(ws[k:k + 7], ' ') AS g
  FROM (SELECT row, ws, unnest(range(1, len(ws) - 6)) AS k FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT row, k FROM (SELECT row, k, count(*) OVER (PARTITION BY row, g) AS n FROM grams) WHERE n > 1
), repeated AS (
  SELECT row, count(DISTINCT k + j) AS n FROM (SELECT row, k, unnest(range(0, 8)) AS j FROM twice) GROUP BY row
), lines AS (SELECT row, unnest(ls) AS l FROM w),
failing AS (
  SELECT row, l FROM lines
  WHERE NOT regexp_matches(l, '[.!?:;…。！？]["''”’»)\]]*[ \t-\r]*$')
    OR regexp_matches(l, '[|»›·•][^|»›·•]+[|»›·•]')
    OR regexp_matches(l, '!!(?:.*?[^!]!!){2}')
    OR regexp_matches(l, '(?i)^[ \t-\r]*(?:home|menu|search|login|log in|sign in|sign up|register|next|previous|back to top|read more|share|contact(?: us)?|about(?: us)?|sitemap|skip to content)[ \t-\r]*[.!:>»]*[ \t-\r]*$')
    OR 10 * len(regexp_extract_all(l, '[#*$%&|<>]')) > length(l)
    OR regexp_matches(l, '(?i)all rights reserved|licensed under the|released under the|copyright (?:\(c\)|©|\d{4})|©|cookie policy|privacy policy|terms of (?:use|service)|subscribe to our|accept (?:all )?cookies|powered by')
), lost AS (
  SELECT row, sum(len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) AS n FROM failing GROUP BY row
), counted AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS lost_words
  FROM w LEFT JOIN repeated ON repeated.row = w.row LEFT JOIN lost ON lost.row = w.row
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND 100 * lost_words <= 50 * n_words AS kept FROM based
""",
}
