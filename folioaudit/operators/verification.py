"""Find the issuer's own copy of each document among landed responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.folding import fold
from ..functions.keys import request_key
from ..functions.fields import required_fields
from ..functions.lines import differs, with_line_diff
from ..functions.rules import ISSUERS, SITE, SITE_ISSUER
from ..schema import LANDED_KEY, RESPONSE_COLUMNS, RESPONSE_KEY, LANDED_AT
from .joins import lookup, newest_by_key, only_keys
from .landing import newest_landed
from .reasons import document_reason, first_of

Store = Callable[[DataFrame], DataFrame]


def with_request(docs: DataFrame) -> DataFrame:
    """Add ``document_reason``, ``gated`` and the ``request_key`` of gated documents.

    Text is dropped where no comparison will follow, so it is not shuffled.
    """
    docs = docs.select(
        "*",
        required_fields(F.col("es_cert_cot"), F.col("afp"), F.col("rut"), F.col("codver")).alias("gated"),
        document_reason().alias("document_reason"),
    )
    gated = F.col("gated")
    docs = docs.withColumn("text", F.when(gated, F.col("text")))
    return docs.withColumn(
        "request_key", F.when(gated, request_key(F.col("afp"), F.col("rut"), F.col("codver")))
    )


def newest_responses(responses: DataFrame) -> DataFrame:
    return newest_by_key(responses, RESPONSE_KEY, RESPONSE_COLUMNS, LANDED_AT)


def direct_copies(responses: DataFrame) -> DataFrame:
    """Copies that came with the response itself; NULL text and a reason where rejected."""
    afp, body, text = F.col("afp"), F.col("body"), F.col("document_text")
    others = responses.filter(afp.isin(*[a for a in ISSUERS if a != SITE_ISSUER]))
    newest = newest_responses(others)
    in_json = afp.isin("uno", "planvital")
    parsed = newest.withColumn("json", F.when(in_json & P.http_ok(F.col("http_status")), P.parse(body)))
    json = F.col("json")
    judged = parsed.withColumn(
        "accepted", F.when(afp == "uno", P.uno_accepts(json)).when(afp == "planvital", P.planvital_accepts(json))
    )
    read = judged.withColumn(
        "payload",
        F.when(F.col("accepted"), F.when(afp == "uno", P.uno_payload(json, body)).otherwise(P.planvital_payload(json, body))),
    )
    decoded = read.withColumn("decoded", P.decode_base64(F.col("payload")))
    content = F.col("decoded")
    as_text = F.try_validate_utf8(content.cast("string"))
    unpacked = F.when(F.length(content) == 0, F.lit("")).when(content.isNotNull(), F.coalesce(text, as_text))
    plain = F.coalesce(text, F.when(body == "", F.lit("")))
    copy = (
        F.when(in_json, unpacked)
        .when(afp == "provida", F.when(P.provida_accepts(body), text))
        .otherwise(plain)
    )
    copied = decoded.withColumn("copy_text", F.when(P.http_ok(F.col("http_status")), copy))
    reason = first_of(
        response_status=~P.http_ok(F.col("http_status")),
        malformed_answer=in_json & json.isNull(),
        refused=~F.col("accepted"),
        empty_answer=(afp == "provida") & ~P.provida_accepts(body),
        malformed_payload=in_json & content.isNull(),
        unreadable_copy=F.col("copy_text").isNull(),
    )
    return copied.select("afp", "request_key", "copy_text", reason.alias("copy_reason"))


def followed_copies(responses: DataFrame, landed: DataFrame, store: Store | None = None) -> DataFrame:
    """Copies behind a path named in the response: a second lookup, by address.

    Only addresses of the issuer's site can match, and that filter reaches the
    scan of the landed documents. ``store`` keeps the narrow verdicts, which are
    used twice; without it responses are read, reduced and parsed for each use.
    """
    newest = newest_responses(responses.filter(F.col("afp") == SITE_ISSUER))
    answered = P.http_ok(F.col("http_status"))

    def verdict(json: Column) -> Column:
        accepts, path = P.habitat_accepts(json), P.habitat_path(json)
        reason = first_of(response_status=~answered, malformed_answer=json.isNull(), refused=~accepts, no_copy_path=path.isNull())
        return F.struct(F.when(accepts, F.concat(F.lit(SITE), path)).alias("url"), reason.alias("answer_reason"))

    # One expression: the planner copies it into filters, where a chain of
    # columns would be written out once per use.
    judged = newest.select(
        "afp", "request_key", P.bound(F.when(answered, P.parse(F.col("body"))), verdict).alias("verdict")
    )
    judged = judged if store is None else store(judged)
    named = judged.select("afp", "request_key", "verdict.*")
    on_site = landed.filter(F.col("link").startswith(SITE))
    wanted = named.select(F.col("url").alias("link")).filter(F.col("link").isNotNull())
    content = newest_landed(only_keys(on_site, wanted, LANDED_KEY), ("http_status", "text")).select(
        "link", P.http_ok(F.col("http_status")).alias("fetched"), F.when(P.http_ok(F.col("http_status")), F.col("text")).alias("copy_text")
    )
    found = lookup(named, content, F.col("url"), F.col("link"), F.col("request_key"))
    copy_reason = first_of(
        copy_not_landed=F.col("link").isNull(), copy_status=~F.col("fetched"), unreadable_copy=F.col("copy_text").isNull()
    )
    return found.select("afp", "request_key", "copy_text", F.coalesce("answer_reason", copy_reason).alias("copy_reason"))


def issuer_copies(responses: DataFrame, landed: DataFrame, store: Store | None = None) -> DataFrame:
    """One folded copy per request; NULL text means the request failed, for ``copy_reason``."""
    copies = direct_copies(responses).unionByName(followed_copies(responses, landed, store))
    return copies.withColumn("copy_text", fold(F.col("copy_text")))


def _joint_key(afp: Column, key: Column) -> Column:
    # Issuer names hold no slash, so the two parts stay distinct.
    return F.concat(afp, F.lit("/"), key)


def verify(docs: DataFrame, responses: DataFrame, landed: DataFrame, store: Store | None = None) -> DataFrame:
    """Attach ``copy_text`` to each document; NULL where there is no good copy.

    Only responses that some document asks for are reduced, parsed and decoded.
    ``docs`` is used twice: store it first where it is dear. ``store``: see
    ``followed_copies``.
    """
    copies = issuer_copies(only_keys(responses, docs, RESPONSE_KEY), landed, store)
    copies = copies.select(
        F.col("afp").alias("_afp"), F.col("request_key").alias("_key"), "copy_text", "copy_reason"
    )
    found = lookup(
        docs,
        copies,
        _joint_key(F.col("afp"), F.col("request_key")),
        _joint_key(F.col("_afp"), F.col("_key")),
        F.col("link"),
    )
    return found.drop("_afp", "_key")


def compare(docs: DataFrame) -> DataFrame:
    """Add ``es_dif`` and ``res_dif`` of the copy against the document."""
    docs = with_line_diff(docs, "copy_text", "text", "res_dif")
    return docs.withColumn("es_dif", differs(F.col("copy_text"), F.col("text")))
