"""One query per operator, over whole tables derived from the given ones."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioaudit.config import AuditOptions
from folioaudit.functions import fields, keys, payload
from folioaudit.functions.folding import fold
from folioaudit.functions.lines import differs, with_line_diff
from folioaudit.functions.rules import with_rules
from folioaudit.operators import candidates as C
from folioaudit.operators import landing as L
from folioaudit.operators import verification as V
from folioaudit.operators.diagnostics import diagnostics
from folioaudit.operators.joins import lookup
from folioaudit.operators.reasons import reason_rows
from folioaudit.operators.status import result_rows
from folioaudit.plans.audit import audit, run
from folioaudit.schema import RESULT_SCHEMA
from folioaudit.session import stored
from folioaudit.sources import tables as S

from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]

OPTIONS = AuditOptions(as_of=X.AS_OF, processed_at=X.PROCESSED_AT)
CUTOFF = OPTIONS.cutoff()
TABLES = ("orders", "lineitem", "documents", "pages")


class Data:
    """The derived tables of one scale factor, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str, base: str = "orders") -> None:
        for table in TABLES:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
        self.spark, self.base = spark, base

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.sql(f"{X.spark_ctes(self.base)} SELECT * FROM {name}")
        setattr(self, name, frame)
        return frame

    @property
    def ids(self) -> DataFrame:
        return self.processed.select(F.col("DOC_IDN").cast("long").alias("doc_idn"))

    @property
    def source(self) -> DataFrame:
        return C.normalize(self.certificates)

    @property
    def recent(self) -> DataFrame:
        return C.lookback(self.source, CUTOFF)

    @property
    def obtained(self) -> DataFrame:
        return L.acquire(L.distinct_links(self.source), self.landed_documents)

    @property
    def extracted(self) -> DataFrame:
        return L.extract_fields(L.clean_metadata(self.obtained))

    @property
    def folded(self) -> DataFrame:
        """Folded text of every paper, without any join."""
        return self.papers.select("k", "c", "id", "code", "issuer", fold(F.col("paper")).alias("text"))

    @property
    def fields(self) -> DataFrame:
        text = F.col("text")
        named = self.folded.withColumn("afp", fields.detect_afp(text))
        return named.select(
            "k",
            "afp",
            fields.extract_rut(text).alias("rut"),
            fields.extract_codver(F.col("afp"), text).alias("codver"),
            fields.is_certificate(text).alias("es_cert_cot"),
        )


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that every engine shows them alike."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(field) for field in df.schema])


def _query(build: Callable[[Data], DataFrame], base: str = "orders") -> Query:
    return lambda spark, sf_dir: portable(build(Data(spark, sf_dir, base)))


def _fields_by_row(*names: str) -> Callable[[Data], DataFrame]:
    return lambda d: d.fields.select("k", *names)


def _key(name: str, build: Callable) -> Callable[[Data], DataFrame]:
    """Request keys of one issuer's documents."""
    return lambda d: (
        d.fields.filter((F.col("afp") == name) & (F.col("rut") != "") & (F.col("codver") != ""))
        .select("k", build(F.col("rut"), F.col("codver")).alias("request_key"))
    )


def _habitat_modelo_cuprum(d: Data) -> DataFrame:
    wanted = d.fields.filter(F.col("afp").isin("habitat", "modelo", "cuprum"))
    wanted = wanted.filter((F.col("rut") != "") & (F.col("codver") != ""))
    return wanted.select(
        "k", "afp", keys.request_key(F.col("afp"), F.col("rut"), F.col("codver")).alias("request_key")
    )


def _capital(d: Data) -> DataFrame:
    codes = d.fields.filter((F.col("afp") == "capital") & (F.col("codver") != ""))
    parts = [p.alias(f"p{n}") for n, p in enumerate(keys.capital_parts(F.col("codver")), 1)]
    return codes.select("k", *parts, keys.capital_key(F.col("rut"), F.col("codver")).alias("request_key"))


def _responses(name: str, *columns: Callable) -> Callable[[Data], DataFrame]:
    """Verdicts over every response of one issuer, older ones included."""
    def build(d: Data) -> DataFrame:
        rows = d.issuer_responses.filter(F.col("afp") == name)
        rows = rows.withColumn("json", payload.parse(F.col("body")))
        return rows.select("request_key", "http_status", *[make() for make in columns])

    return build


def _issuers_by_rule(d: Data) -> DataFrame:
    return with_rules(d.fields.select("k", "afp"))


def _clean_values(d: Data) -> DataFrame:
    """Text and raw bytes, whole and broken, as metadata values."""
    raw = d.landed_documents.select(
        "link",
        F.col("landed_at"),
        F.col("creator"),
        F.encode(F.col("text"), "UTF-8").alias("producer"),
        F.concat(F.unhex(F.lit("FF")), F.encode(F.col("link"), "UTF-8")).alias("creation_date"),
        F.col("mod_date"),
    )
    return L.clean_metadata(raw)


def _line_diff(d: Data) -> DataFrame:
    folded = d.copies.select("k", fold(F.col("copy")).alias("verified"), fold(F.col("paper")).alias("original"))
    flagged = folded.withColumn("es_dif", differs(F.col("verified"), F.col("original")))
    return with_line_diff(flagged, "verified", "original", "res_dif").select("k", "es_dif", "res_dif")


def _inequality(d: Data) -> DataFrame:
    return d.copies.select("k", differs(fold(F.col("copy")), fold(F.col("paper"))).alias("es_dif"))


def _acquired(d: Data) -> DataFrame:
    """Each candidate with its document, or the status of one not obtained."""
    found = d.obtained.withColumnRenamed("link", "found")
    joined = lookup(d.source, found, F.col("link"), F.col("found"), F.col("doc_idn"))
    return joined.select(
        "doc_idn",
        "link",
        F.when(F.coalesce("obtained", F.lit(False)), "").otherwise("error_origen").alias("res_afp"),
        "text",
        "producer",
    )


_TEXT_OUTCOMES = (
    "metadata_creator", "metadata_producer", "metadata_creadate", "metadata_moddate",
    "afp", "codver", "rut", "rut_l11", "res_dif",
)


def _base_result(d: Data) -> DataFrame:
    """Candidates with every default, before anything is known of them."""
    blank = d.source.select("*", *[F.lit(None).cast("string").alias(c) for c in _TEXT_OUTCOMES])
    blank = blank.withColumns({c: F.lit(None).cast("boolean") for c in ("es_metadata", "es_cert_cot", "es_dif")})
    return result_rows(blank.withColumn("res_afp", F.lit("")), X.PROCESSED_AT)


def _verified(d: Data) -> DataFrame:
    docs = stored(V.with_request(d.extracted))
    found = V.verify(docs, d.issuer_responses, d.landed_documents)
    return found.filter("gated").select("link", "afp", "request_key", "copy_text")


def _followed(d: Data) -> DataFrame:
    return V.followed_copies(d.issuer_responses, d.landed_documents).drop("copy_reason")


def _audit(row_limit: int, since: dt.date = CUTOFF) -> Callable[[Data], DataFrame]:
    def build(d: Data) -> DataFrame:
        batch = C.candidates(d.certificates, d.ids, since, row_limit)
        return audit(batch, d.landed_documents, d.issuer_responses, X.PROCESSED_AT)

    return build


# Early enough for every row to be recent.
ALWAYS = dt.date(1990, 1, 1)


def _audit_everything(d: Data) -> DataFrame:
    batch = C.candidates(d.certificates, None, ALWAYS, 0)
    return audit(batch, d.landed_documents, d.issuer_responses, X.PROCESSED_AT)


def _reasons(d: Data) -> DataFrame:
    """Every document with the reason of its outcome."""
    batch = C.candidates(d.certificates, None, ALWAYS, 0)
    results = audit(batch, d.landed_documents, d.issuer_responses, X.PROCESSED_AT, reasons=True)
    return reason_rows(results).drop("FECHA_PROCESO")


def _newest_files(*by: str) -> Callable[[Data], DataFrame]:
    return lambda d: S.newest_files(d.landed_files, d.seen_files, *by)


def _named(d: Data, *names: str) -> dict[str, str]:
    """Derived tables under names that the session's catalog knows."""
    found = {name: f"derived_{d.base}_{name}" for name in names}
    for name, view in found.items():
        getattr(d, name).createOrReplaceTempView(view)
    return found


def _scanned(d: Data) -> DataFrame:
    source = S.scan(d.spark, _named(d, "certificates")["certificates"])
    S.validate_source(source)
    return source


def _processed(d: Data) -> DataFrame:
    return S.processed_ids(d.spark, _named(d, "processed")["processed"])


def _from_text(d: Data) -> DataFrame:
    """Normalization of text columns, with values that do not convert."""
    k = F.col("DOC_IDN")
    text = d.certificates.select(
        F.when(k % 7 == 0, F.concat(F.lit("id "), k)).otherwise(k.cast("string")).alias("DOC_IDN"),
        "LINK",
        F.date_format("PERIODO_PRODUCCION", "yyyyMM").alias("PERIODO_PRODUCCION"),
        F.when(k % 5 == 0, "sin fecha").otherwise(F.col("FECHA_INGRESO").cast("string")).alias("FECHA_INGRESO"),
    )
    return C.normalize(text)


def _run_batch(d: Data) -> DataFrame:
    """The job itself: one batch audited, appended to a target and read back.

    The target starts with the processed ids, as an earlier run leaves it. Its
    new rows are stored and the target is dropped.
    """
    names = _named(d, "certificates", "landed_documents", "issuer_responses")
    target = f"run_target_{uuid.uuid4().hex}"
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA if f.name not in ("DOC_IDN", "FECHA_PROCESO")]
    done = d.ids.select(F.col("doc_idn").alias("DOC_IDN"), *blank, F.lit(dt.datetime(1999, 1, 1)).alias("FECHA_PROCESO"))
    S.conform(done).write.saveAsTable(target)
    options = dataclasses.replace(
        OPTIONS,
        source_table=names["certificates"],
        landed_table=names["landed_documents"],
        responses_table=names["issuer_responses"],
        target_table=target,
        lookback_days=(X.AS_OF - ALWAYS).days,
    )
    try:
        run(d.spark, options)
        new = d.spark.table(target).filter(F.col("FECHA_PROCESO") == F.lit(X.PROCESSED_AT.isoformat(" ")).cast("timestamp"))
        return stored(new)
    finally:
        d.spark.sql(f"DROP TABLE IF EXISTS {target}")


def _pending_by_index(d: Data) -> DataFrame:
    """Pending documents by a stored index of processed ids, which is dropped in the end."""
    index = f"run_index_{uuid.uuid4().hex}"
    S.index_ids(d.ids, index, OPTIONS.index_buckets)
    try:
        known = stored(C.processed_among(d.source, d.spark.table(index)))
    finally:
        d.spark.sql(f"DROP TABLE IF EXISTS {index}")
    return C.pending(d.source, known)


def _counts(d: Data) -> DataFrame:
    return diagnostics(d.source, d.ids, CUTOFF).select(
        "total_source", "recent_source", "already_processed", "pending_after_dedup"
    )


QUERIES: dict[str, Query] = {
    # Scans, sources
    "s1_table_scan": _query(_scanned),
    "s3_processed_ids": _query(_processed),
    "s4_document_acquisition": _query(_acquired),
    "s5_newest_landed_file": _query(_newest_files()),
    "s5_newest_landed_file_per_site": _query(_newest_files("site")),
    # Projections, filters
    "p1_source_normalization": _query(lambda d: d.source),
    "p1_source_normalization_of_text": _query(_from_text),
    "p2_lookback_window": _query(lambda d: d.recent),
    "p3_required_fields_gate": _query(lambda d: V.with_request(d.extracted).select("link", "gated", "request_key")),
    "p4_base_result": _query(_base_result),
    "p5_processing_timestamp": _query(lambda d: _base_result(d).select("DOC_IDN", "FECHA_PROCESO")),
    # Joins
    "j1_pending_documents": _query(lambda d: C.pending(d.source, d.ids)),
    "j1_pending_documents_by_index": _query(_pending_by_index),
    "j2_already_processed_documents": _query(lambda d: C.already_processed(d.source, d.ids)),
    "j3_issuer_rule_lookup": _query(_issuers_by_rule),
    "j4_verified_document_lookup": _query(_verified),
    "j5_followed_copy_lookup": _query(_followed),
    # Aggregations
    "a1_distinct_processed_ids": _query(lambda d: C.distinct_ids(d.ids)),
    "a2_source_counts": _query(_counts),
    "a3_ingest_range": _query(
        lambda d: diagnostics(d.source, None, CUTOFF).select("min_fecha_ingreso", "max_fecha_ingreso")
    ),
    "a4_zero_candidate_diagnostics": _query(lambda d: diagnostics(d.source, d.ids, CUTOFF)),
    "a4_diagnostics_filter_off": _query(lambda d: diagnostics(d.source, None, CUTOFF, filter_on=False)),
    "a4_diagnostics_no_target": _query(lambda d: diagnostics(d.source, None, CUTOFF)),
    # Top-k
    "t1_first_documents_by_id": _query(lambda d: C.first_by_id(d.source, OPTIONS.row_limit)),
    # A limit far above what one task orders.
    "t1_many_documents_by_id": _query(lambda d: C.first_by_id(d.source, X.LARGE_LIMIT, X.ORDERED_ROWS)),
    "t1_no_limit": _query(lambda d: C.first_by_id(d.source, 0)),
    # Text and scalar functions
    "f1_text_folding": _query(
        lambda d: d.spark.table("documents").select("doc_id", fold(F.col("text")).alias("folded"))
    ),
    "f2_issuer_detection": _query(_fields_by_row("afp"), "documents"),
    "f3_rut_extraction": _query(_fields_by_row("rut"), "documents"),
    "f4_codver_extraction": _query(_fields_by_row("afp", "codver"), "documents"),
    "f5_certificate_classifier": _query(_fields_by_row("es_cert_cot"), "documents"),
    "f6_producer_check": _query(
        lambda d: L.extract_fields(L.clean_metadata(d.obtained)).select("link", "afp", "metadata_producer", "es_metadata")
    ),
    "f7_rut_l11": _query(lambda d: d.fields.select("k", "rut", fields.rut_l11(F.col("rut")).alias("rut_l11"))),
    "f8_metadata_cleaning": _query(_clean_values),
    "f9_text_inequality": _query(_inequality, "documents"),
    "f10_line_diff": _query(_line_diff, "documents"),
    "f10_line_diff_short_texts": _query(_line_diff),
    "f11_provida_request_key": _query(_key("provida", keys.provida_key)),
    "f12_uno_request_key": _query(_key("uno", keys.uno_key)),
    "f13_planvital_request_key": _query(_key("planvital", keys.planvital_key)),
    "f14_habitat_modelo_cuprum_request_keys": _query(_habitat_modelo_cuprum),
    "f15_capital_code_split": _query(_capital),
    # Responses
    "r1_status_gate": _query(
        lambda d: d.issuer_responses.select(
            "afp", "request_key", "http_status", payload.http_ok(F.col("http_status")).alias("accepted")
        )
    ),
    "r2_habitat_verdict": _query(
        _responses("habitat", lambda: payload.habitat_accepts(F.col("json")).alias("accepted"))
    ),
    "r3_provida_verdict": _query(
        _responses("provida", lambda: payload.provida_accepts(F.col("body")).alias("accepted"))
    ),
    "r4_uno_verdict": _query(_responses("uno", lambda: payload.uno_accepts(F.col("json")).alias("accepted"))),
    "r5_planvital_verdict": _query(
        _responses("planvital", lambda: payload.planvital_accepts(F.col("json")).alias("accepted"))
    ),
    "r6_uno_payload": _query(_responses("uno", lambda: payload.uno_payload(F.col("json"), F.col("body")).alias("payload"))),
    "r6_planvital_payload": _query(
        _responses("planvital", lambda: payload.planvital_payload(F.col("json"), F.col("body")).alias("payload"))
    ),
    "r7_base64_decode": _query(
        _responses(
            "planvital",
            lambda: payload.decoded_text(payload.planvital_payload(F.col("json"), F.col("body"))).alias("decoded"),
        )
    ),
    "r7_base64_decode_uno": _query(
        _responses("uno", lambda: payload.decoded_text(payload.uno_payload(F.col("json"), F.col("body"))).alias("decoded"))
    ),
    "r8_audit_status": _query(
        lambda d: _audit_everything(d).groupBy("RES_AFP", "ES_DIF", "ES_CERT_COT").agg(F.count(F.lit(1)).alias("documents"))
    ),
    "r8_outcome_reasons": _query(_reasons),
    "r8_outcome_reasons_of_documents": _query(_reasons, "documents"),
    # The whole audit
    "certificate_run_batch": _query(_run_batch),
    "certificate_audit": _query(_audit(OPTIONS.row_limit, ALWAYS)),
    "certificate_audit_recent": _query(_audit(0)),
    "certificate_audit_everything": _query(_audit_everything),
    "document_audit_everything": _query(_audit_everything, "documents"),
}
