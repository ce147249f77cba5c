"""Bring landed documents to the candidates and take fields from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields
from ..functions.folding import fold
from ..functions.payload import http_ok
from ..schema import LANDED_AT, LANDED_COLUMNS, LANDED_KEY
from .joins import newest_by_key, only_keys


def distinct_links(candidates: DataFrame) -> DataFrame:
    """Addresses to look at. Work on a document is done once, however many rows name it."""
    return candidates.select("link").filter(F.col("link").isNotNull()).distinct()


def newest_landed(landed: DataFrame, columns: Sequence[str] = LANDED_COLUMNS) -> DataFrame:
    return newest_by_key(landed, LANDED_KEY, columns, LANDED_AT)


def acquire(links: DataFrame, landed: DataFrame, bucketed: bool = False) -> DataFrame:
    """Landed content per address, with ``landed`` and ``obtained``; content is NULL unless obtained.

    Rows of other addresses are dropped before versions are compared.
    ``bucketed``: the landed rows are stored in buckets of their address.
    """
    found = newest_landed(only_keys(landed, links, LANDED_KEY, bucketed))
    joined = links.join(found.withColumn("landed", F.lit(True)), "link", "left")
    obtained = http_ok(F.col("http_status"))
    content = [F.when(obtained, F.col(c)).alias(c) for c in LANDED_COLUMNS if c != "http_status"]
    landed_ = F.coalesce("landed", F.lit(False))
    return joined.select("link", landed_.alias("landed"), obtained.alias("obtained"), *content)


def clean_metadata(docs: DataFrame) -> DataFrame:
    """Metadata values as text, ``''`` where there is none."""
    names = {
        "creator": "metadata_creator",
        "producer": "metadata_producer",
        "creation_date": "metadata_creadate",
        "mod_date": "metadata_moddate",
    }
    kept = [F.col(c) for c in docs.columns if c not in names]
    return docs.select(*kept, *[fields.clean_value(docs, old).alias(new) for old, new in names.items()])


def extract_fields(docs: DataFrame) -> DataFrame:
    """Fields of each document; defaults where its text could not be read.

    Each step is a select of its own that later steps refer to more than once,
    so the planner keeps them apart and no pattern runs twice on a text.
    """
    text, afp = F.col("text"), F.col("afp")
    docs = docs.withColumn("text", fold(text))
    docs = docs.select(
        "*",
        F.coalesce(fields.detect_afp(text), F.lit("")).alias("afp"),
        F.coalesce(fields.is_certificate(text), F.lit(False)).alias("es_cert_cot"),
        F.coalesce(fields.extract_rut(text), F.lit("")).alias("rut"),
    )
    return docs.select(
        "*",
        fields.extract_codver(afp, text).alias("codver"),
        fields.rut_l11(F.col("rut")).alias("rut_l11"),
        fields.producer_matches(afp, F.col("metadata_producer")).alias("es_metadata"),
    )
