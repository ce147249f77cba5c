"""Tables and files the audit reads, and the table it appends to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.reasons import REASONS, reason_rows
from ..operators.status import NOT_OBTAINED, REJECTED, RETURNED
from ..schema import REQUIRED_SOURCE_COLUMNS, RESULT_SCHEMA

# Fixed value: suffix of a download still in progress.
PARTIAL_SUFFIX = ".crdownload"

# What the outcomes are called in a report.
OUTCOMES = {"verified": RETURNED, "rejected": REJECTED, "not_obtained": NOT_OBTAINED, "not_asked": ""}


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def validate_source(df: DataFrame) -> None:
    """Raise when a required column is absent, whatever its case."""
    present = {name.upper() for name in df.columns}
    missing = sorted(set(REQUIRED_SOURCE_COLUMNS) - present)
    if missing:
        raise ValueError(f"required source columns are missing: {missing}")


def processed_ids(
    spark: SparkSession,
    target_table: str,
    enabled: bool = True,
    refresh: bool = False,
    between: tuple[int, int] | None = None,
) -> DataFrame | None:
    """Ids in the target, or None when it is absent or the filter is off.

    ``refresh`` drops the session's remembered list of the target's files.
    ``between`` reads ids in that range only; the filter reaches the scan.
    """
    if not enabled or not spark.catalog.tableExists(target_table):
        return None
    if refresh:
        spark.catalog.refreshTable(target_table)
    target = spark.table(target_table)
    if between is not None:
        target = target.filter(F.col("DOC_IDN").between(*between))
    return target.select(F.col("DOC_IDN").cast("long").alias("doc_idn"))


def id_index(spark: SparkSession, table: str, target_table: str, buckets: int) -> DataFrame | None:
    """The index of processed ids; made from the target where there is none yet."""
    if not spark.catalog.tableExists(table):
        ids = processed_ids(spark, target_table, refresh=True)
        if ids is None:
            return None
        index_ids(ids, table, buckets)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def index_ids(ids: DataFrame, table: str, buckets: int) -> None:
    """Add ids to the index; an id that it holds twice does no harm."""
    save_bucketed(ids.select("doc_idn").distinct(), table, ["doc_idn"], buckets)


def newest_files(files: DataFrame, seen: DataFrame | None, *keys: str) -> DataFrame:
    """Newest complete file per key among those not seen before.

    ``files`` has ``path``, ``modificationTime`` and the keys; no key means one
    row in all. Equal times go to the greater path.
    """
    fresh = files.filter(~F.col("path").endswith(PARTIAL_SUFFIX))
    if seen is not None:
        fresh = fresh.join(seen.select("path").distinct(), "path", "left_anti")
    newest = F.max(F.struct("modificationTime", "path")).alias("_newest")
    return (
        fresh.groupBy(*keys)
        .agg(newest)
        .filter(F.col("_newest").isNotNull())
        .select(*keys, F.col("_newest.path").alias("path"), F.col("_newest.modificationTime").alias("modificationTime"))
    )


def read_landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """A folder of landed text files as landed documents, keyed by path.

    Content that is not UTF-8 gives NULL text: obtained, but unreadable. File
    sources list no empty files; an empty document has to land as a table row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    absent = F.lit(None).cast("string")
    return files.filter(~F.col("path").endswith(PARTIAL_SUFFIX)).select(
        F.col("path").alias("link"),
        F.lit(200).alias("http_status"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("text"),
        absent.alias("creator"),
        absent.alias("producer"),
        absent.alias("creation_date"),
        absent.alias("mod_date"),
        F.col("modificationTime").alias("landed_at"),
    )


def newest_copies(files: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """``path, modificationTime, request_key``: the newest landed file per code among those not ``seen``.

    A file's name up to its first dot, dashes read as colons, is the request key.
    """
    code = F.replace(F.regexp_extract("link", r"([^/.]+)[^/]*$", 1), F.lit("-"), F.lit(":"))
    keyed = files.select(F.col("link").alias("path"), F.col("landed_at").alias("modificationTime"), code.alias("request_key"))
    return newest_files(keyed, seen, "request_key")


def read_copy_files(spark: SparkSession, path: str, afp: str, seen: DataFrame | None = None) -> DataFrame:
    """A folder of downloaded copies as issuer responses: the newest file per code.

    Files still being downloaded don't count, nor do those that were ``seen``.
    """
    files = read_landed_files(spark, path)
    newest = newest_copies(files, seen)
    found = newest.join(files, (F.col("path") == F.col("link")) & (F.col("modificationTime") == F.col("landed_at")))
    return found.select(
        F.lit(afp).alias("afp"),
        "request_key",
        F.lit(200).alias("http_status"),
        F.lit("file").alias("body"),
        F.col("text").alias("document_text"),
        "landed_at",
    )


def seen_files(spark: SparkSession, table: str | None) -> DataFrame | None:
    """Paths that earlier runs took, or None where no run has kept any."""
    if table is None or not spark.catalog.tableExists(table):
        return None
    spark.catalog.refreshTable(table)
    return spark.table(table).select("path")


def remember_files(taken: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Add the files that a run took (``path, request_key``) to the ledger; none twice."""
    known = seen_files(taken.sparkSession, table)
    fresh = taken.select("path", "request_key").distinct()
    if known is not None:
        fresh = fresh.join(known.distinct(), "path", "left_anti")
    fresh = fresh.withColumn("taken_at", F.current_timestamp())
    fresh.write.format(table_format).mode("append").saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Store landed rows hashed and sorted by key.

    The reduction to the newest row per key and the join on that key then read
    matching buckets in place, so document text is not shuffled for them. All
    versions of a key share a bucket: keep few of them, or a plain table.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("append")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def conform(df: DataFrame) -> DataFrame:
    """The result columns, in order and by type; extra columns are dropped."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA])


def append_results(df: DataFrame, target_table: str, table_format: str = "parquet") -> dict[str, int]:
    """Append; returns ``rows`` and the rows per outcome, counted by the write itself."""
    written = Observation("appended")
    outcome = F.col("RES_AFP")
    counts = [F.count_if(outcome == value).alias(name) for name, value in OUTCOMES.items()]
    if "REASON" in df.columns:
        counts += [F.count_if(F.col("REASON") == name).alias(f"reason_{name}") for name in REASONS]
    rows = conform(df.observe(written, F.count(F.lit(1)).alias("rows"), *counts))
    rows.write.format(table_format).mode("append").saveAsTable(target_table)
    return {name: int(n or 0) for name, n in written.get.items()}


def append_reasons(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    reason_rows(df).write.format(table_format).mode("append").saveAsTable(table)


def not_appended(df: DataFrame, table: str, between: tuple[int, int]) -> DataFrame:
    """Rows of one run, named by id and time of processing, that ``table`` does not hold."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return df
    spark.catalog.refreshTable(table)
    held = spark.table(table).filter(F.col("DOC_IDN").between(*between)).select("DOC_IDN", "FECHA_PROCESO").distinct()
    # By shuffle: the files' size says little of their ids' number.
    return df.join(held.hint("merge"), ["DOC_IDN", "FECHA_PROCESO"], "left_anti").select(*df.columns)
