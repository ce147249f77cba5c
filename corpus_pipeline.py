"""From raw documents to packed training sequences, one operator per stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that its
predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioaudit.llm import decontaminate, language, linededup, minmax, packing
from folioaudit.llm.common import checkpointed, checkpointed_lean, rows_of, table
from folioaudit.llm.rules import HAS_WORD


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a known language. The rows left are stored, so that texts go out in small batches."""
    return checkpointed_lean(language.accepted(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated lines; ``n_chars`` follows the text.

    A document of which nothing is left was a copy throughout and goes.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = linededup.without_repeats(docs, *others, "n_chars")
    left = cut.filter((F.col("n_removed") == 0) | F.col("text").rlike(HAS_WORD))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group. Rows without an id name no group and stay."""
    decided = minmax.near_duplicates(docs)
    kept = checkpointed(decided.filter("kept").select("doc_id").distinct())
    return rows_of(docs.filter(F.col("doc_id").isNotNull()), kept).unionByName(docs.filter(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left, without repeated passages, into token sequences: one row per piece.

    What is left is stored: cut and encoded in one task, a text would take two workers per core.
    """
    cut = linededup.without_passages(docs, "doc_id")
    return packing.pack(checkpointed_lean(cut.filter((F.col("n_removed") == 0) | F.col("text").rlike(HAS_WORD))))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# The stages learn, hash and pack: SQL can't state them; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES) and stage is not identify_language:
            docs = checkpointed(docs)
    return docs
