"""Source checks, normalization, lookback, joins on processed ids, top-k, counts."""

import datetime as dt

import pytest

from folioaudit.operators import candidates as C
from folioaudit.operators.diagnostics import diagnostics
from folioaudit.sources import tables as S

CUTOFF = dt.date(2024, 5, 1)


def ids_of(df):
    return sorted((r.doc_idn for r in df.collect()), key=lambda x: (x is not None, x))


def test_required_columns(spark):
    row = spark.createDataFrame([(1, "a", "b", "c")], "doc_idn long, Link string, PERIODO_PRODUCCION string, fecha_ingreso string")
    S.validate_source(row)
    with pytest.raises(ValueError, match=r"\['FECHA_INGRESO', 'LINK'\]"):
        S.validate_source(row.drop("Link", "fecha_ingreso"))


def test_normalize_text_columns(spark):
    rows = [("7", "a", "202401", "2024-05-01 10:00:00", 1), ("x", None, "2024-02", "bad", 1),
            (None, "b", "2024-03-04", None, 1), (" 8 ", "c", "nonsense", "2024-05-02", 1)]
    df = spark.createDataFrame(rows, "DOC_IDN string, LINK string, PERIODO_PRODUCCION string, FECHA_INGRESO string, extra int")
    got = [tuple(r) for r in C.normalize(df).collect()]
    assert got == [
        (7, "a", dt.date(2024, 1, 1), dt.datetime(2024, 5, 1, 10)),
        (None, None, dt.date(2024, 2, 1), None),
        (None, "b", dt.date(2024, 3, 4), None),
        (8, "c", None, dt.datetime(2024, 5, 2)),
    ]


def test_normalize_number_period(spark):
    df = spark.createDataFrame([(1, "a", 202402, dt.datetime(2024, 5, 1))], "doc_idn int, link string, periodo_produccion int, fecha_ingreso timestamp")
    assert C.normalize(df).first().periodo_produccion == dt.date(2024, 2, 1)


def test_lookback_edge(spark):
    rows = [(1, dt.datetime(2024, 5, 1)), (2, dt.datetime(2024, 4, 30, 23, 59, 59, 999999)), (3, None)]
    df = spark.createDataFrame(rows, "doc_idn long, fecha_ingreso timestamp")
    assert ids_of(C.lookback(df, CUTOFF)) == [1]


def test_pending_and_processed(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (2,), (2,)], "doc_idn long")
    ids = spark.createDataFrame([(2,), (2,), (None,)], "doc_idn long")
    assert ids_of(C.pending(df, ids)) == [None, 1, 1]
    assert ids_of(C.already_processed(df, ids)) == [2, 2]
    assert ids_of(C.pending(df, None)) == [None, 1, 1, 2, 2]
    assert ids_of(C.distinct_ids(ids)) == [None, 2]


def test_first_by_id(spark):
    df = spark.createDataFrame([(n, dt.datetime(2024, 5, 1), "l", None) for n in (5, 3, 9, 1, 3)],
                               "doc_idn long, fecha_ingreso timestamp, link string, periodo_produccion date")
    assert ids_of(C.first_by_id(df, 3)) == [1, 3, 3]
    for none in (0, -1):
        assert ids_of(C.first_by_id(df, none)) == [1, 3, 3, 5, 9]


def test_selection_equals_sorting(spark):
    """Every limit against a plain sort: an id with a third of all rows, NULL ids, equal rows, gaps."""
    at = lambda n: dt.datetime(2024, 5, 1) + dt.timedelta(minutes=n)
    rows = [(n * n * 37 % 100_003, at(n % 7), f"l{n % 11}", None) for n in range(1500)]
    rows += [(40_000, at(n % 5), f"l{n % 40}", dt.date(2024, 1, 1 + n % 3)) for n in range(900)]
    rows += [(None, None, f"l{n % 3}", None) for n in range(120)] + [(-5, at(1), None, None)] * 300
    df = spark.createDataFrame(rows, "doc_idn long, fecha_ingreso timestamp, link string, periodo_produccion date").repartition(5).cache()
    first = lambda v: (v is not None, v)
    key = lambda r: (*first(r[0]), *first(r[1] and r[1].timestamp()), *first(r[2]), *first(r[3] and str(r[3])))
    wanted = sorted(rows, key=key)
    for limit in (1, 60, 120, 121, 250, 420, 421, 1000, 1400, 2000, len(rows) - 1, len(rows), len(rows) + 1):
        got = sorted((tuple(r) for r in C.first_by_id(df, limit, ordered_rows=50).collect()), key=key)
        assert got == wanted[:limit], limit
    assert C.first_by_id(df.filter("false"), 3, ordered_rows=1).count() == 0
    df.unpersist()


def test_selection_orders_a_small_part_only(spark):
    df = C.normalize(
        spark.range(200_000).selectExpr("id * 3 AS doc_idn", "'l' AS link", "NULL AS periodo_produccion", "timestamp '2024-05-01' AS fecha_ingreso")
        .withColumnRenamed("doc_idn", "DOC_IDN")
    )
    cut = C.first_by_id(df, 150_000)
    text = cut._jdf.queryExecution().executedPlan().toString()
    assert "Union" in text  # rows below the open range are taken unsorted
    assert cut.agg({"doc_idn": "max"}).first()[0] == 149_999 * 3 and cut.count() == 150_000


def source(spark):
    recent, old = dt.datetime(2024, 5, 9), dt.datetime(2020, 1, 1)
    rows = [(1, recent), (1, recent), (2, recent), (None, recent), (3, old), (1, old), (None, old), (4, None)]
    return spark.createDataFrame([(i, "l", None, t) for i, t in rows],
                                 "doc_idn long, link string, periodo_produccion date, fecha_ingreso timestamp")


def test_diagnostics(spark):
    df, ids = source(spark), spark.createDataFrame([(1,), (1,), (3,)], "doc_idn long")
    got = diagnostics(df, ids, CUTOFF).first().asDict()
    assert got == {
        "total_source": 8, "recent_source": 4, "null_ids": 2, "cutoff_date": CUTOFF,
        "min_fecha_ingreso": dt.datetime(2020, 1, 1), "max_fecha_ingreso": dt.datetime(2024, 5, 9),
        "already_processed": 2, "pending_after_dedup": 2, "dedup_state": "done",
    }
    assert got["already_processed"] + got["pending_after_dedup"] == got["recent_source"]
    recent = C.lookback(df, CUTOFF)
    assert got["already_processed"] == C.already_processed(recent, ids).count()
    assert got["pending_after_dedup"] == C.pending(recent, ids).count()


def test_diagnostics_without_ids(spark):
    off = diagnostics(source(spark), None, CUTOFF, filter_on=False).first()
    assert (off.dedup_state, off.already_processed, off.total_source) == ("filter_off", None, 8)
    assert diagnostics(source(spark), None, CUTOFF).first().dedup_state == "no_target"
    empty = diagnostics(source(spark).filter("false"), None, CUTOFF).first()
    assert (empty.total_source, empty.recent_source, empty.min_fecha_ingreso) == (0, 0, None)


def test_newest_files(spark):
    at = lambda hour: dt.datetime(2024, 1, 1, hour)
    rows = [("a", "a/1", at(1)), ("a", "a/2", at(3)), ("a", "a/3.crdownload", at(9)), ("a", "a/4", at(8)),
            ("b", "b/1", at(2)), ("b", "b/2", at(2)), ("c", "c/1", at(1))]
    files = spark.createDataFrame(rows, "key string, path string, modificationTime timestamp")
    seen = spark.createDataFrame([("a/4",), ("c/1",)], "path string")
    got = {tuple(r)[:2] for r in S.newest_files(files, seen, "key").collect()}
    assert got == {("a", "a/2"), ("b", "b/2")}
    assert [r.path for r in S.newest_files(files, None).collect()] == ["a/4"]
    assert S.newest_files(files.filter("key = 'c'"), seen).count() == 0


def test_landed_files(spark, tmp_path):
    (tmp_path / "one.txt").write_bytes("Año\nA.F.P. Uno".encode())
    (tmp_path / "two.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "three.crdownload").write_bytes(b"part")
    got = {r.link.rsplit("/", 1)[1]: r.text for r in S.read_landed_files(spark, str(tmp_path)).collect()}
    assert got == {"one.txt": "Año\nA.F.P. Uno", "two.txt": None}
