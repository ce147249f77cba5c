"""Issuer rules: fixed values and their use as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IssuerRule:
    afp: str
    codver: str
    producer: str
    domain: str = ""


# Issuer names, code patterns (group 1 is the code), producer
# patterns and the site that serves one issuer's copies.
RULES = (
    IssuerRule("modelo", r"Folio.*:\s+([a-z\d]+)", r"Powered By Crystal"),
    IssuerRule(
        "habitat",
        r"([a-z\d]{8}-(?:[a-z\d]{4}-){3}[a-z\d]{12})",
        r"iText1.3.1",
        "https://www.afphabitat.cl",
    ),
    IssuerRule("cuprum", r"FOLIO\s+N.?\s+CU(\d+)", r"null"),
    IssuerRule("capital", r"certificacion:\s+([a-z|\d|-]+)", r"PDFsharp"),
    IssuerRule("provida", r"certificado:\s+([\d|\.]+)", r"iText"),
    IssuerRule("planvital", r"Folio\s+([\d-]+)", r"Telerik Reporting"),
    IssuerRule("uno", r"Certificacion\s+N.?:\s+([a-z|\d]+)", r"Powered By Crystal"),
)
ISSUER_LINE = r"\nA\.?F\.?P\.? +(\w+)"
ISSUER_SITE = r"afphabitat\.cl"
SITE_ISSUER = "habitat"
RUT = r"\d{1,2}(?:\.\d{3}){2}-[\dkK]"
CERTIFICATE = r"certificado(?:\s+\w+){0,2}\s+cotizaciones"

ISSUERS = tuple(rule.afp for rule in RULES)
SITE = next(rule.domain for rule in RULES if rule.afp == SITE_ISSUER)

# The patterns were written for Python, whose \s also takes these controls.
_SPACE = r"[\s\x0b\x1c-\x1f]"


def java_pattern(pattern: str) -> str:
    """For folded text: any case, and a dot stops at a line feed only."""
    return "(?id)" + pattern.replace(r"\s", _SPACE)


def java_unicode_pattern(pattern: str) -> str:
    """The same for text that was not folded to ASCII."""
    return "(?idu)" + pattern.replace(r"\s", _SPACE)


def re2_pattern(pattern: str) -> str:
    """The same for engines with RE2; the caller asks for any case."""
    return pattern.replace(r"\s", _SPACE)


def per_issuer(afp: Column, branch: Callable[[IssuerRule], Column]) -> Column:
    """One CASE branch per issuer; NULL when the issuer has no rule.

    Patterns stay literals this way, so each is compiled once per task.
    """
    chain = F
    for rule in RULES:
        chain = chain.when(afp == rule.afp, branch(rule))
    return chain


def rules_frame(spark: SparkSession) -> DataFrame:
    """The rules as a seven-row dimension."""
    return spark.createDataFrame(
        [(r.afp, r.codver, r.producer, r.domain) for r in RULES],
        "afp string, codver_pattern string, producer_pattern string, domain string",
    )


def with_rules(df: DataFrame, afp: str = "afp") -> DataFrame:
    """Attach rule attributes; an unknown issuer gets NULLs. Seven rows: broadcast."""
    rules = F.broadcast(rules_frame(df.sparkSession))
    return df.join(rules.withColumnRenamed("afp", afp), afp, "left")
