"""Run each query on Spark and its oracle on DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .oracles import ORACLES
from .queries import QUERIES

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in ALL_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """'' when equal, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    got = rows_of(frame.columns, frame.collect())
    want = rows_of(columns, result.fetchall())
    if got == want:
        return ""
    first = next((pair for pair in zip(got, want) if pair[0] != pair[1]), None)
    return f"{len(got)} rows against {len(want)}; first difference {first}"


def main(sf_dir: str, names: list[str]) -> int:
    from folioaudit.session import build_session

    spark = build_session(
        "check",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            fault = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(fault)
        print(f"{'FAIL' if fault else 'ok  '} {name} {time.time() - start:.1f}s {fault[:1500]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
