"""The audit as one plan, and the job that runs it."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AuditOptions
from ..functions.keys import capital_key
from ..operators import candidates as C
from ..operators.diagnostics import diagnostics
from ..operators.joins import lookup
from ..operators.landing import acquire, clean_metadata, distinct_links, extract_fields
from ..operators.status import REJECTED, RETURNED, outcomes, result_rows
from ..operators.verification import compare, verify, with_request
from ..session import Scratch, exclusive, scratch, stored
from ..sources import tables as S

LOGGER = logging.getLogger(__name__)


def audit(
    candidates: DataFrame,
    landed: DataFrame,
    responses: DataFrame,
    processed_at: dt.datetime | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
    bucketed: bool = False,
    reasons: bool = False,
    store_verdicts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One result row per candidate row.

    The audit itself is done once per address: fields, copy and difference
    depend on nothing else. The plan is the same for every number of
    candidates. ``store`` keeps the extracted documents, which are used twice:
    to choose the responses they ask for, and to be compared with them. Unless
    it is given they are checkpointed, and so are, without ``store_verdicts``,
    the verdicts that name a path. ``bucketed``: see ``acquire``. ``reasons``
    adds the column ``REASON``.
    """
    store = stored if store is None else store
    docs = acquire(distinct_links(candidates), landed, bucketed)
    docs = store(with_request(extract_fields(clean_metadata(docs))))
    checked = outcomes(compare(verify(docs, responses, landed, store_verdicts or stored)))
    checked = checked.withColumnRenamed("link", "_link")
    joined = lookup(candidates, checked, F.col("link"), F.col("_link"), F.col("doc_idn"))
    return result_rows(joined, processed_at, reasons)


def landed_documents(spark: SparkSession, options: AuditOptions) -> DataFrame:
    """The landed table, and the files of the landed folder where one is named."""
    landed = S.scan(spark, options.landed_table)
    if options.landed_folder:
        landed = landed.unionByName(S.read_landed_files(spark, options.landed_folder), allowMissingColumns=True)
    return landed


# The issuer whose copies are downloaded as files.
FILE_ISSUER = "capital"


def issuer_responses(spark: SparkSession, options: AuditOptions, seen: DataFrame | None = None) -> DataFrame:
    """The response table, and the newest downloaded copies of one issuer that no run has ``seen``."""
    responses = S.scan(spark, options.responses_table)
    if options.capital_folder:
        copies = S.read_copy_files(spark, options.capital_folder, FILE_ISSUER, seen)
        responses = responses.unionByName(copies, allowMissingColumns=True)
    return responses


def run(spark: SparkSession, options: AuditOptions) -> int:
    """Audit the documents that are due and append them; returns their number.

    Stages are stored, so that nothing is chosen or audited anew when a second
    use or a lost executor asks for it. Rows are published by one run at a time,
    which leaves out documents that others have published meanwhile.
    """
    source = S.scan(spark, options.source_table)
    S.validate_source(source)
    with scratch(spark, options.job_id) as held:
        batch = held.store(lambda: _batch(source, options, held), "batch")
        span = batch.agg(F.count(F.lit(1)).alias("n"), F.min("doc_idn").alias("low"), F.max("doc_idn").alias("high")).first()
        if not span.n:
            LOGGER.info("no new documents to audit")
            if options.enable_candidate_diagnostics:
                report = diagnose(spark, options).first()
                LOGGER.warning("no candidates: %s", report.asDict())
            return 0
        LOGGER.info("auditing %s documents", span.n)
        seen = S.seen_files(spark, options.seen_files_table)
        if seen is not None:
            seen = held.store(seen.distinct, "seen")  # fixed: the ledger grows at the end
        results = held.store(lambda: _results(spark, batch, options, seen, held), "results")
        with exclusive(spark, options.target_table, options.lease_seconds):
            resumed = held.holds("fresh")
            counts = _publish(spark, batch, results, options, held, (span.low, span.high), resumed)
        if options.capital_folder and options.seen_files_table:
            # Behind the append: a run that ends between the two takes a file
            # again, for other documents, rather than losing it.
            S.remember_files(taken_copies(spark, options, results, seen), options.seen_files_table, options.table_format)
    LOGGER.info("appended to %s: %s", options.target_table, {name: n for name, n in counts.items() if n or not name.startswith("reason_")})
    if options.index_table and options.filter_already_processed and not counts["rows"] and not resumed:
        # All were in the target but not in the index, which holds them now.
        return run(spark, options)
    return counts["rows"]


def _batch(source: DataFrame, options: AuditOptions, held: Scratch) -> DataFrame:
    """The documents of one run: four narrow columns."""
    spark = source.sparkSession
    ids = None
    if options.index_table and options.filter_already_processed:
        with exclusive(spark, options.target_table, options.lease_seconds):
            index = S.id_index(spark, options.index_table, options.target_table, options.index_buckets)
        if index is not None:
            recent = C.lookback(C.normalize(source), options.cutoff())
            ids = held.store(lambda: C.processed_among(recent, index), "processed")
    else:
        ids = S.processed_ids(spark, options.target_table, options.filter_already_processed)
    return C.candidates(source, ids, options.cutoff(), options.row_limit)


def _results(spark: SparkSession, batch: DataFrame, options: AuditOptions, seen: DataFrame | None, held: Scratch) -> DataFrame:
    responses = issuer_responses(spark, options, seen)
    documents = lambda df: held.store(df, "documents")
    # Under a name of its own: a resumed job judges the responses anew.
    verdicts = lambda df: held.store(df, f"verdicts-{uuid.uuid4().hex}")
    return audit(
        batch,
        landed_documents(spark, options),
        responses,
        options.processed_at,
        documents,
        options.bucketed,
        reasons=True,
        store_verdicts=verdicts,
    )


def _publish(
    spark: SparkSession,
    batch: DataFrame,
    results: DataFrame,
    options: AuditOptions,
    held: Scratch,
    between: tuple[int, int],
    resumed: bool,
) -> dict[str, int]:
    """Append results and reasons, then index the ids. To be called by one run at a time.

    What is to be appended is stored first. A job ``resumed`` after that leaves
    out the rows that it appended before.
    """
    def fresh() -> DataFrame:
        known = S.processed_ids(
            spark, options.target_table, options.filter_already_processed, refresh=True, between=between
        )
        return C.pending(results, known)

    rows = held.store(fresh, "fresh")
    missing = (lambda table: S.not_appended(rows, table, between)) if resumed else (lambda table: rows)
    counts = S.append_results(missing(options.target_table), options.target_table, options.table_format)
    if options.reasons_table:
        S.append_reasons(missing(options.reasons_table), options.reasons_table, options.table_format)
    if options.index_table:
        S.index_ids(batch, options.index_table, options.index_buckets)
    return counts


def taken_copies(spark: SparkSession, options: AuditOptions, results: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The downloaded files that documents of ``results`` asked for: ``path, request_key``."""
    files = S.newest_copies(S.read_landed_files(spark, options.capital_folder), seen)
    asked = results.filter((F.col("AFP") == FILE_ISSUER) & F.col("RES_AFP").isin(RETURNED, REJECTED))
    asked = asked.select(capital_key(F.col("RUT"), F.col("CODVER")).alias("request_key")).distinct()
    return files.join(asked, "request_key", "left_semi").select("path", "request_key")


def diagnose(spark: SparkSession, options: AuditOptions) -> DataFrame:
    """The counts that explain an empty batch, as one row."""
    source = S.scan(spark, options.source_table)
    S.validate_source(source)
    ids = S.processed_ids(spark, options.target_table, options.filter_already_processed)
    return diagnostics(C.normalize(source), ids, options.cutoff(), options.filter_already_processed)
