"""Time the audit and its heavy parts; prints one JSON line.

The derived tables are landed as Parquet first, untimed, since the audit reads
stored tables. Every timed query writes all its rows to a no-op sink. A first,
untimed pass of each warms the JVM.
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioaudit.functions.folding import fold
from folioaudit.functions.lines import with_line_diff
from folioaudit.operators import candidates as C
from folioaudit.operators import landing as L
from folioaudit.operators import verification as V
from folioaudit.operators.diagnostics import diagnostics
from folioaudit.plans.audit import audit
from folioaudit.plans.audit import run as run_job
from folioaudit.schema import RESULT_SCHEMA
from folioaudit.session import build_session
from folioaudit.sources import tables as S
from workload import fixtures as X
from workload.queries import ALWAYS, CUTOFF, OPTIONS, Data

STORED = ("certificates", "landed_documents", "issuer_responses", "processed", "copies")


def land(spark: SparkSession, sf_dir: str, base: str, folder: str) -> dict[str, DataFrame]:
    data, stored = Data(spark, sf_dir, base), {}
    for name in STORED:
        path = f"{folder}/{base}/{name}"
        # As many files as a stored table would have, so that every core reads.
        getattr(data, name).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
        stored[name] = spark.read.parquet(path)
    return stored


def workloads(tables: dict[str, DataFrame], prefix: str) -> dict:
    t = tables
    ids = t["processed"].select(F.col("DOC_IDN").cast("long").alias("doc_idn"))

    def whole(row_limit: int, known: DataFrame | None):
        batch = C.candidates(t["certificates"], known, ALWAYS, row_limit)
        return audit(batch, t["landed_documents"], t["issuer_responses"], X.PROCESSED_AT)

    def extracted():
        docs = L.acquire(L.distinct_links(C.normalize(t["certificates"])), t["landed_documents"])
        return V.with_request(L.extract_fields(L.clean_metadata(docs)))

    def diffs():
        folded = t["copies"].select("k", fold(F.col("copy")).alias("v"), fold(F.col("paper")).alias("o"))
        return with_line_diff(folded, "v", "o", "res_dif").select("k", "res_dif")

    return {
        f"{prefix}_audit_everything": lambda: whole(0, None),
        f"{prefix}_audit_batch": lambda: whole(OPTIONS.row_limit, ids),
        f"{prefix}_run_batch": lambda: job(t, prefix),
        f"{prefix}_candidates": lambda: C.candidates(t["certificates"], ids, CUTOFF, OPTIONS.row_limit),
        f"{prefix}_extraction": extracted,
        f"{prefix}_issuer_copies": lambda: V.issuer_copies(t["issuer_responses"], t["landed_documents"]),
        f"{prefix}_line_diff": diffs,
        f"{prefix}_diagnostics": lambda: diagnostics(C.normalize(t["certificates"]), ids, CUTOFF),
    }


def job(tables: dict[str, DataFrame], prefix: str) -> DataFrame:
    """The whole job on stored tables: the next batch, appended to its target."""
    spark = tables["certificates"].sparkSession
    names = {name: f"{prefix}_{name}" for name in ("certificates", "landed_documents", "issuer_responses")}
    for name, view in names.items():
        tables[name].createOrReplaceTempView(view)
    target = f"{prefix}_target"
    if not spark.catalog.tableExists(target):
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA if f.name not in ("DOC_IDN", "FECHA_PROCESO")]
        done = tables["processed"].select("DOC_IDN", *others, F.lit(X.PROCESSED_AT).alias("FECHA_PROCESO"))
        S.conform(done).write.saveAsTable(target)
    options = dataclasses.replace(
        OPTIONS,
        source_table=names["certificates"],
        landed_table=names["landed_documents"],
        responses_table=names["issuer_responses"],
        target_table=target,
        lookback_days=(X.AS_OF - ALWAYS).days,
    )
    return spark.range(run_job(spark, options))


def run(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    seconds: dict[str, float] = {}
    with tempfile.TemporaryDirectory(prefix="audit-bench-") as folder:
        spark = build_session(
            "bench",
            f"local[{cpus}]",
            **{
                "spark.sql.shuffle.partitions": cpus,
                "spark.sql.warehouse.dir": f"{folder}/warehouse",
                "spark.checkpoint.dir": f"{folder}/checkpoint",
                "spark.driver.memory": "16g",
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
            },
        )
        spark.sparkContext.setLogLevel("ERROR")
        counts = {}
        for base in ("orders", "documents"):
            tables = land(spark, sf_dir, base, folder)
            counts[base] = tables["certificates"].count()
            for name, build in workloads(tables, base).items():
                run(build)
                seconds[name] = round(run(build), 3)
        spark.stop()
    rate = {b: round(n / seconds[f"{b}_audit_everything"], 1) for b, n in counts.items()}
    print(
        json.dumps(
            {
                "metric": "certificate audit, total seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "documents": counts,
                "documents_per_sec": rate,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
