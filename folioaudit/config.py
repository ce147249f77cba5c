"""Options of one audit job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class AuditOptions:
    source_table: str = "certificates"
    target_table: str = "audit_results"
    landed_table: str = "landed_documents"
    responses_table: str = "issuer_responses"
    # The landed table was written by ``save_bucketed`` and has no hot address.
    bucketed: bool = False
    # Folders with landed text files, read beside the tables. Documents are
    # named by their path; copies by their code, and the newest file counts.
    landed_folder: str | None = None
    capital_folder: str | None = None
    # Ledger of the copies that runs took, so that no later run takes them
    # again; created on first use. None keeps no ledger.
    seen_files_table: str | None = None
    # Why each document has its outcome, one row per appended row; created on
    # first use. None keeps no reasons.
    reasons_table: str | None = None
    # Processed ids in buckets, kept by every run, so that choosing a batch
    # reads no row of the target; created on first use. None reads the target.
    index_table: str | None = None
    index_buckets: int = 64
    # Name of a run. Its stages stay in the shared folder if it fails, and the
    # next run of that name goes on from them. Never use one name twice at a time.
    job_id: str | None = None
    # A run whose lock on the target is older is taken for dead: more than the
    # longest append takes.
    lease_seconds: int = 600
    lookback_days: int = 30
    # Zero or less means no limit.
    row_limit: int = 240
    # False audits documents again that are in the target already.
    filter_already_processed: bool = True
    enable_candidate_diagnostics: bool = True
    # None means today and now; a fixed value makes a run repeatable.
    as_of: dt.date | None = None
    processed_at: dt.datetime | None = None
    # Format of a target table that does not exist yet, e.g. "delta".
    table_format: str = "parquet"

    def cutoff(self) -> dt.date:
        """First day inside the lookback window."""
        as_of = self.as_of or dt.datetime.now(dt.timezone.utc).date()
        return as_of - dt.timedelta(days=self.lookback_days)
