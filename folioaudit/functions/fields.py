"""Typed fields out of folded certificate text, and metadata checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rules as R


def detect_afp(text: Column) -> Column:
    """Issuer named on a line of its own, else by its site, else ``''``."""
    named = F.lower(F.regexp_extract(text, R.java_pattern(R.ISSUER_LINE), 1))
    by_site = text.rlike(R.java_pattern(R.ISSUER_SITE))
    return F.when(named != "", named).when(by_site, R.SITE_ISSUER).otherwise("")


def extract_rut(text: Column) -> Column:
    """First national id in the text, as printed, else ``''``."""
    return F.regexp_extract(text, R.RUT, 0)


def extract_codver(afp: Column, text: Column) -> Column:
    """Verification code by the issuer's pattern; ``''`` without a rule or hit."""
    code = R.per_issuer(afp, lambda rule: F.regexp_extract(text, R.java_pattern(rule.codver), 1))
    return F.coalesce(code, F.lit(""))


def is_certificate(text: Column) -> Column:
    """True for a contribution certificate."""
    return text.rlike(R.java_pattern(R.CERTIFICATE))


def producer_matches(afp: Column, producer: Column) -> Column:
    """Does the file's producer fit the issuer? NULL when it has no rule."""
    value = F.coalesce(producer, F.lit(""))
    return R.per_issuer(afp, lambda rule: value.rlike(R.java_unicode_pattern(rule.producer)))


def rut_l11(rut: Column) -> Column:
    """Id without dots, zero-filled to 11 and never cut; ``''`` stays ``''``."""
    plain = F.replace(rut, F.lit("."), F.lit(""))
    filled = F.when(F.length(plain) < 11, F.lpad(plain, 11, "0")).otherwise(plain)
    return F.when(rut == "", F.lit("")).otherwise(filled)


def clean_value(df: DataFrame, name: str) -> Column:
    """Metadata value as text: NULL and invalid UTF-8 become ``''``."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.BinaryType):
        value = F.try_validate_utf8(value.cast("string"))
    return F.coalesce(value.cast("string"), F.lit(""))


def required_fields(es_cert: Column, afp: Column, rut: Column, codver: Column) -> Column:
    """Gate: only a certificate with issuer, id and code can be verified."""
    return F.coalesce(es_cert & (afp != "") & (rut != "") & (codver != ""), F.lit(False))
