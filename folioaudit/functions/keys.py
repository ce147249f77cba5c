"""Request keys: what each issuer is asked for, as one string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a code for this issuer has four blocks of five and a check digit.
CAPITAL_CODE = r"^([A-Z0-9]{5})-([A-Z0-9]{5})-([A-Z0-9]{5})-([A-Z0-9]{5})-([0-9])"


def _without(value: Column, *parts: str) -> Column:
    for part in parts:
        value = F.replace(value, F.lit(part), F.lit(""))
    return value


def provida_key(rut: Column, codver: Column) -> Column:
    return F.concat(_without(codver, "."), F.lit("-"), _without(rut, ".", "-"))


def uno_key(rut: Column, codver: Column) -> Column:
    return F.concat_ws(":", _without(rut, ".", "-"), codver)


def planvital_key(rut: Column, codver: Column) -> Column:
    return F.concat_ws(":", _without(codver, "-"), _without(rut, "-", "."))


def habitat_key(rut: Column, codver: Column) -> Column:
    return codver


def modelo_key(rut: Column, codver: Column) -> Column:
    return F.concat_ws(":", rut, codver)


def cuprum_key(rut: Column, codver: Column) -> Column:
    return F.concat_ws(":", rut, _without(codver, "CU"))


def capital_parts(codver: Column) -> list[Column]:
    """The five parts of a code; all ``''`` when it is malformed."""
    return [F.regexp_extract(codver, CAPITAL_CODE, group) for group in range(1, 6)]


def capital_key(rut: Column, codver: Column) -> Column:
    """NULL for a malformed code: no such request can be made."""
    return F.when(codver.rlike(CAPITAL_CODE), F.concat_ws(":", *capital_parts(codver)))


_KEYS = {
    "modelo": modelo_key,
    "habitat": habitat_key,
    "cuprum": cuprum_key,
    "capital": capital_key,
    "provida": provida_key,
    "planvital": planvital_key,
    "uno": uno_key,
}


def request_key(afp: Column, rut: Column, codver: Column) -> Column:
    """Key by issuer. No id or code holds a colon, so parts cannot run together."""
    chain = F
    for name, build in _KEYS.items():
        chain = chain.when(afp == name, build(rut, codver))
    return chain
