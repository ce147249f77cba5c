"""The outcome of each document and the rows of the result table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reasons import outcome_reason

# Fixed values of RES_AFP; an outcome that needs no issuer is ''.
NOT_OBTAINED = "error_origen"
REJECTED = "error"
RETURNED = "ok"


def res_afp(obtained: Column, gated: Column, copy_text: Column) -> Column:
    """``ok`` says that the issuer returned a copy, not that it is the same."""
    return (
        F.when(~obtained, NOT_OBTAINED)
        .when(~gated, "")
        .when(copy_text.isNull(), REJECTED)
        .otherwise(RETURNED)
    )


def outcomes(docs: DataFrame) -> DataFrame:
    """One narrow row per address: texts end here."""
    status = res_afp(F.col("obtained"), F.col("gated"), F.col("copy_text"))
    return docs.select(
        "link",
        "metadata_creator",
        "metadata_producer",
        "metadata_creadate",
        "metadata_moddate",
        "es_metadata",
        "afp",
        "es_cert_cot",
        "codver",
        "rut",
        "rut_l11",
        status.alias("res_afp"),
        "es_dif",
        F.coalesce("res_dif", F.lit("")).alias("res_dif"),
        outcome_reason().alias("reason"),
    )


def result_rows(joined: DataFrame, processed_at: dt.datetime | None = None, reasons: bool = False) -> DataFrame:
    """Result columns with their defaults: ``''`` for text, NULL for unknown truth.

    ``reasons`` adds the column ``REASON``.
    """
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    # As text, a time without a zone is read in the session's zone.
    now = F.current_timestamp() if processed_at is None else F.lit(processed_at.isoformat(" ")).cast("timestamp")
    return joined.select(
        F.col("doc_idn").alias("DOC_IDN"),
        F.col("link").alias("LINK"),
        F.col("periodo_produccion").alias("PERIODO_PRODUCCION"),
        F.col("fecha_ingreso").alias("FECHA_INGRESO"),
        text("metadata_creator").alias("METADATA_CREATOR"),
        text("metadata_producer").alias("METADATA_PRODUCER"),
        text("metadata_creadate").alias("METADATA_CREADATE"),
        text("metadata_moddate").alias("METADATA_MODDATE"),
        F.col("es_metadata").alias("ES_METADATA"),
        text("afp").alias("AFP"),
        F.coalesce("es_cert_cot", F.lit(False)).alias("ES_CERT_COT"),
        text("codver").alias("CODVER"),
        text("rut").alias("RUT"),
        text("rut_l11").alias("RUT_L11"),
        # A row without a link has no outcome: nothing could be obtained.
        F.coalesce("res_afp", F.lit(NOT_OBTAINED)).alias("RES_AFP"),
        F.col("es_dif").alias("ES_DIF"),
        text("res_dif").alias("RES_DIF"),
        now.alias("FECHA_PROCESO"),
        *([F.coalesce("reason", F.lit("no_link")).alias("REASON")] if reasons else []),
    )
