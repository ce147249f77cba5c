"""Why a run found nothing to do: all counts from one pass over the source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .candidates import distinct_ids, in_lookback

# Which deduplication applied.
DEDUP_DONE = "done"
DEDUP_OFF = "filter_off"
DEDUP_NO_TARGET = "no_target"


def _sum(column: Column | str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def diagnostics(normalized: DataFrame, ids: DataFrame | None, cutoff: dt.date, filter_on: bool = True) -> DataFrame:
    """One row of counts over the normalized source.

    Rows are first reduced to one per recent id. Old rows share one group, so
    they are never shuffled one by one to the processed ids.
    """
    recent = F.coalesce(in_lookback(cutoff), F.lit(False))
    reduced = (
        normalized.select(
            F.when(recent, F.col("doc_idn")).alias("doc_idn"),
            recent.cast("long").alias("recent"),
            F.col("doc_idn").isNull().cast("long").alias("null_id"),
            "fecha_ingreso",
        )
        .groupBy("doc_idn")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum("recent").alias("recent"),
            F.sum("null_id").alias("null_ids"),
            F.min("fecha_ingreso").alias("first"),
            F.max("fecha_ingreso").alias("last"),
        )
    )
    if ids is None:
        already = pending = F.lit(None).cast("long")
        state = DEDUP_NO_TARGET if filter_on else DEDUP_OFF
    else:
        known = distinct_ids(ids).withColumn("known", F.lit(True))
        reduced = reduced.join(known, "doc_idn", "left")
        already = _sum(F.when(F.col("known"), F.col("recent")))
        pending = _sum(F.when(F.col("known").isNull(), F.col("recent")))
        state = DEDUP_DONE
    return reduced.agg(
        _sum("total").alias("total_source"),
        _sum("recent").alias("recent_source"),
        _sum("null_ids").alias("null_ids"),
        F.lit(cutoff).alias("cutoff_date"),
        F.min("first").alias("min_fecha_ingreso"),
        F.max("last").alias("max_fecha_ingreso"),
        already.alias("already_processed"),
        pending.alias("pending_after_dedup"),
        F.lit(state).alias("dedup_state"),
    )
