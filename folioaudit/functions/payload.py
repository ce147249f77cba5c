"""Read issuer responses: JSON verdicts and base64 payloads, never raising.

Every function gives NULL or false where a response is no good, so one bad
row cannot stop a job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"
_STRICT_BASE64 = r"\A[A-Za-z0-9+/]*={0,2}\z"


# The JSON reader refuses long strings and numbers unless it is told otherwise.
# What it would accept beyond JSON is turned off.
_UNLIMITED = {
    "maxStringLen": "2147483647",
    "maxNumLen": "2147483647",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def parse(body: Column) -> Column:
    """The body as a variant, for verdicts and types; NULL unless all of it is one JSON document.

    The reader stops behind the first document, whatever follows. So it gets the
    body and the body's digest as the two items of a list: what follows a
    document would be further items, an error, or cut off the digest.
    """
    def listed(digest: Column) -> Column:
        return F.from_json(F.concat(F.lit("["), body, F.lit(',"'), digest, F.lit('"]')), "variant", _UNLIMITED)

    def checked(found: Column, digest: Column) -> Column:
        whole = (F.try_variant_get(found, "$[1]", "string") == digest) & _field(found, "$[2]").isNull()
        return F.when(whole, _field(found, "$[0]"))

    return bound(F.sha2(body, 256), lambda digest: bound(listed(digest), lambda found: checked(found, digest)))


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _field(json: Column, path: str) -> Column:
    return F.try_variant_get(json, path, "variant")


def _kind(json: Column, path: str) -> Column:
    return F.schema_of_variant(_field(json, path))


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _is_object(kind: Column) -> Column:
    return kind.startswith("OBJECT")


def http_ok(status: Column) -> Column:
    return _true(status == 200)


def habitat_accepts(json: Column) -> Column:
    """``resultado`` equals zero as a number; false counts, text does not."""
    kind = _kind(json, "$.resultado")
    number = F.try_variant_get(json, "$.resultado", "double")
    truth = F.try_variant_get(json, "$.resultado", "boolean")
    return _true(F.when(kind == "BOOLEAN", ~truth).when(kind.rlike(_NUMBER), number == 0))


def habitat_path(json: Column) -> Column:
    """``mensaje``: ``''`` when absent, NULL when it is not text."""
    return _text_or_default(json, "$.mensaje", F.try_variant_get(json, "$.mensaje", "string"))


def provida_accepts(body: Column) -> Column:
    return _true(F.length(body) > 0)


def uno_accepts(json: Column) -> Column:
    """``codigo`` is the text ``0``; the number does not count."""
    value = F.try_variant_get(json, "$.codigo", "string")
    return _true((_kind(json, "$.codigo") == "STRING") & (value == "0"))


def planvital_accepts(json: Column) -> Column:
    """``valid`` is anything but false, zero, empty, null or absent."""
    path = "$.valid"
    kind = _kind(json, path)
    truthy = (
        F.when(kind == "BOOLEAN", F.try_variant_get(json, path, "boolean"))
        .when(kind.rlike(_NUMBER), F.try_variant_get(json, path, "double") != 0)
        .when(kind == "STRING", F.try_variant_get(json, path, "string") != "")
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(json, path, "array<variant>")) > 0)
        .when(_is_object(kind), kind != "OBJECT<>")
    )
    return _true(truthy)


def _text_or_default(json: Column, path: str, text: Column) -> Column:
    """``text`` where ``path`` holds text; ``''`` when absent from an object, NULL otherwise."""
    absent = _field(json, path).isNull() & _is_object(F.schema_of_variant(json))
    return F.when(absent, F.lit("")).when(_kind(json, path) == "STRING", text)


def uno_payload(json: Column, body: Column) -> Column:
    data = _field(json, "$.data")
    absent = data.isNull() & _is_object(F.schema_of_variant(json))
    text = F.from_json(body, "data struct<bytes:string>", _UNLIMITED)["data"]["bytes"]
    return F.when(absent, F.lit("")).otherwise(_text_or_default(data, "$.bytes", text))


def planvital_payload(json: Column, body: Column) -> Column:
    return _text_or_default(json, "$.data", F.from_json(body, "data string", _UNLIMITED)["data"])


def decode_base64(text: Column) -> Column:
    """Bytes of lenient base64; NULL when the padding is wrong.

    Foreign characters are skipped. Equals signs end the data only where they
    complete a group of four; anywhere else they are skipped too. The text is
    cut at equals signs. The fold has a step per sign and keeps numbers only:
    how much data there is and how many runs it takes. Text as encoders write it
    needs none of this and is decoded as it is.
    """
    strict = text.rlike(_STRICT_BASE64) & (F.length(text) % 4 == 0)
    runs = F.split(F.regexp_replace(text, "[^A-Za-z0-9+/=]", ""), "=")

    def step(state: Column, run: Column) -> Column:
        partial = state["size"] % 4
        pads = F.when(partial >= 2, state["pads"] + 1).otherwise(state["pads"])
        closed = state["closed"] | ((partial >= 2) & (partial + pads >= 4))
        return F.struct(
            F.when(closed, state["size"]).otherwise(state["size"] + F.length(run)).alias("size"),
            F.when(closed, state["taken"]).otherwise(state["taken"] + 1).alias("taken"),
            F.when(F.length(run) == 0, pads).otherwise(0).alias("pads"),
            closed.alias("closed"),
        )

    def finish(state: Column) -> Column:
        data, size = F.array_join(F.slice(runs, 1, state["taken"]), ""), state["size"]
        whole = F.when(size % 4 == 0, data).when(
            state["closed"], F.rpad(data, (size + 4 - size % 4).cast("int"), "=")
        )
        return F.try_to_binary(whole, F.lit("base64"))

    # The first run follows no sign, so it is the state to start from.
    head = F.struct(
        F.length(runs[0]).alias("size"), F.lit(1).alias("taken"), F.lit(0).alias("pads"), F.lit(False).alias("closed")
    )
    lenient = F.aggregate(F.slice(runs, 2, F.size(runs)), head, step, finish)
    return F.when(strict, F.try_to_binary(text, F.lit("base64"))).otherwise(lenient)


def decoded_text(payload: Column) -> Column:
    """Payload bytes as UTF-8 text; NULL when they are not."""
    return F.try_validate_utf8(decode_base64(payload).cast("string"))
