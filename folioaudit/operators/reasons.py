"""Why a document has its outcome: one code per document, beside the result columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ISSUERS

# In the order in which they are decided; the first that holds counts.
DOCUMENT_REASONS = (
    "no_link", "not_landed", "document_status", "unreadable_text", "not_certificate",
    "no_issuer", "unknown_issuer", "no_rut", "no_code", "malformed_code",
)
ANSWER_REASONS = (
    "no_response", "response_status", "malformed_answer", "refused", "empty_answer",
    "malformed_payload", "no_copy_path", "copy_not_landed", "copy_status", "unreadable_copy",
)
COMPARED = ("same", "different")
REASONS = DOCUMENT_REASONS + ANSWER_REASONS + COMPARED


def first_of(**conditions: Column) -> Column:
    """The name of the first condition that holds, or NULL."""
    chain = F
    for name, condition in conditions.items():
        if name not in REASONS:
            raise ValueError(f"no such reason: {name}")
        chain = chain.when(condition, F.lit(name))
    return chain


def document_reason() -> Column:
    """What keeps a document from being asked about; NULL where nothing does."""
    afp = F.col("afp")
    return first_of(
        not_landed=~F.col("landed"),
        document_status=~F.col("obtained"),
        unreadable_text=F.col("text").isNull(),
        not_certificate=~F.col("es_cert_cot"),
        no_issuer=afp == "",
        unknown_issuer=~afp.isin(*ISSUERS),
        no_rut=F.col("rut") == "",
        no_code=F.col("codver") == "",
    )


def outcome_reason() -> Column:
    """The reason of a compared document."""
    copy = F.col("copy_text")
    asked = (
        F.when(F.col("request_key").isNull(), F.lit("malformed_code"))
        .when(copy.isNull(), F.coalesce("copy_reason", F.lit("no_response")))
        .otherwise(F.when(F.col("es_dif"), F.lit("different")).otherwise(F.lit("same")))
    )
    return F.coalesce("document_reason", asked)


def reason_rows(results: DataFrame) -> DataFrame:
    """The side table of a run: which document has which outcome, and why."""
    return results.select("DOC_IDN", "LINK", "AFP", "RES_AFP", "REASON", "FECHA_PROCESO")
