"""The audit as a whole: every outcome, the job, reruns, duplicates."""

import base64
import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioaudit import AuditOptions
from folioaudit.plans.audit import audit, diagnose, run
from folioaudit.schema import RESULT_SCHEMA
from folioaudit.sources import tables as S

NOW = dt.datetime(2024, 5, 10, 8, 30)
OLD, NEW = dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)
LANDED = "link string, http_status int, text string, creator string, producer string, creation_date string, mod_date string, landed_at timestamp"
RESPONSES = "afp string, request_key string, http_status int, body string, document_text string, landed_at timestamp"
CAPITAL = "AB1CD-EF2GH-IJ3KL-MN4OP-7"


def paper(issuer, code_line, phrase="Certificado de cotizaciones", rut="RUT 1.234.567-8"):
    return f"Señores\nA.F.P. {issuer} S.A.\n{phrase}\n{rut}\n{code_line}\nfin"


def plain(text):
    return text.replace("ñ", "n").replace("ó", "o")


def encoded(text):
    return base64.b64encode(text.encode()).decode()


MODELO = paper("Modelo", "Folio: abc1")
UNO = paper("Uno", "Certificación N: u1")
PLANVITAL = paper("PlanVital", "Folio 12-3")
PROVIDA = paper("Provida", "certificado: 1.2")
HABITAT = paper("Habitat", "codigo 00000001-aaaa-bbbb-cccc-0123456789ab")
CUPRUM = paper("Cuprum", "FOLIO No CU55")
CAP = paper("Capital", f"certificación: {CAPITAL}")
CAP_BAD = paper("Capital", f"certificación: {CAPITAL.lower()}")

# link: (landed text, status) or None, then RES_AFP, ES_DIF, RES_DIF.
CASES = {
    "absent": (None, "error_origen", None, ""),
    "status": ((MODELO, 404), "error_origen", None, ""),
    "unreadable": ((None, 200), "", None, ""),
    "empty": (("", 200), "", None, ""),
    "not_certificate": ((paper("Modelo", "Folio: abc1", "Liquidacion"), 200), "", None, ""),
    "no_rut": ((paper("Modelo", "Folio: abc1", rut=""), 200), "", None, ""),
    "unknown_issuer": ((paper("Andina", "Folio: abc1"), 200), "", None, ""),
    "modelo": ((MODELO, 200), "ok", False, ""),
    "uno": ((UNO, 200), "ok", True, "- extra"),
    "planvital": ((PLANVITAL, 200), "ok", False, ""),
    "provida": ((PROVIDA, 200), "error", None, ""),
    "habitat": ((HABITAT, 200), "ok", True, "- FIN | + fin"),
    "cuprum": ((CUPRUM, 200), "error", None, ""),
    "capital": ((CAP, 200), "ok", True, ""),
    "capital_bad": ((CAP_BAD, 200), "error", None, ""),
}


REASONS = {
    "absent": "not_landed", "status": "document_status", "unreadable": "unreadable_text", "empty": "not_certificate",
    "not_certificate": "not_certificate", "no_rut": "no_rut", "unknown_issuer": "unknown_issuer", "modelo": "same",
    "uno": "different", "planvital": "same", "provida": "empty_answer", "habitat": "different",
    "cuprum": "unreadable_copy", "capital": "different", "capital_bad": "malformed_code",
}


def tables(spark):
    rows = [(n, link, dt.date(2024, 4, 1), NEW) for n, link in enumerate(CASES)]
    rows += [(100, None, None, NEW), (101, "modelo", None, NEW), (101, "modelo", None, NEW), (None, "modelo", None, NEW)]
    source = spark.createDataFrame(rows, "DOC_IDN long, LINK string, PERIODO_PRODUCCION date, FECHA_INGRESO timestamp")
    landed = [(k, v[0][1], v[0][0], "c", "Powered By Crystal", None, "m", NEW) for k, v in CASES.items() if v[0]]
    landed += [(k, 500, "stale", "", "", "", "", OLD) for k in CASES if k != "absent"]
    landed += [("https://www.afphabitat.cl/x", 200, HABITAT[:-3] + "FIN", None, None, None, None, NEW)]
    answers = [
        ("modelo", "1.234.567-8:abc1", 200, "file", MODELO, NEW),
        ("modelo", "1.234.567-8:abc1", 500, "", None, OLD),
        ("uno", "12345678:u1", 200, f'{{"codigo":"0","data":{{"bytes":"{encoded(UNO + chr(10) + "extra")}"}}}}', None, NEW),
        ("planvital", "123:12345678", 200, f'{{"valid":1,"data":"{encoded(PLANVITAL)}"}}', None, NEW),
        ("provida", "12-12345678", 200, "", PROVIDA, NEW),
        ("habitat", "00000001-aaaa-bbbb-cccc-0123456789ab", 200, '{"resultado":0,"mensaje":"/x"}', None, NEW),
        ("cuprum", "1.234.567-8:55", 200, "file", None, NEW),
        ("capital", CAPITAL.replace("-", ":"), 200, "file", CAP + "\n", NEW),
        ("capital", None, 200, "file", CAP, NEW),
        (None, "x", 200, "file", CAP, NEW),
    ]
    return source, spark.createDataFrame(landed, LANDED), spark.createDataFrame(answers, RESPONSES)


@pytest.fixture(scope="module")
def options(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS audit_test")
    names = dict(zip(("source_table", "landed_table", "responses_table"), ("source", "landed", "responses")))
    for (key, name), df in zip(names.items(), tables(spark)):
        names[key] = f"audit_test.{name}"
        df.write.mode("overwrite").saveAsTable(names[key])
    return AuditOptions(**names, target_table="audit_test.results", as_of=dt.date(2024, 5, 10), row_limit=0, processed_at=NOW)


def check_outcomes(rows):
    by_id = {r.DOC_IDN: r for r in rows if r.DOC_IDN is not None and r.DOC_IDN < 100}
    for n, (link, (_, res_afp, es_dif, res_dif)) in enumerate(CASES.items()):
        assert (by_id[n].RES_AFP, by_id[n].ES_DIF, by_id[n].RES_DIF) == (res_afp, es_dif, res_dif), link
    return {link: by_id[n] for n, link in enumerate(CASES)}


@pytest.mark.parametrize("as_files", [False, True])
def test_outcomes(spark, as_files, tmp_path):
    source, landed, responses = tables(spark)
    columns = [F.col(c).alias(c.lower()) for c in source.columns]

    def as_parquet(docs):
        docs.write.parquet(f"{tmp_path}/docs")
        return spark.read.schema(docs.schema).parquet(f"{tmp_path}/docs")

    df = audit(source.select(*columns), landed, responses, NOW, as_parquet if as_files else None)
    assert df.columns == [f.name for f in RESULT_SCHEMA]
    got = df.collect()
    assert len(got) == source.count()
    named = check_outcomes(got)
    assert (named["absent"].METADATA_MODDATE, named["absent"].ES_CERT_COT, named["absent"].ES_METADATA) == ("", False, None)
    assert (named["unreadable"].METADATA_MODDATE, named["unreadable"].AFP, named["unreadable"].ES_METADATA) == ("m", "", None)
    assert (named["modelo"].METADATA_CREADATE, named["modelo"].ES_METADATA, named["modelo"].RUT_L11) == ("", True, "001234567-8")
    assert (named["unknown_issuer"].AFP, named["unknown_issuer"].CODVER, named["unknown_issuer"].ES_METADATA) == ("andina", "", None)
    assert (named["provida"].ES_METADATA, named["capital_bad"].CODVER) == (False, CAPITAL.lower())
    assert all(r.FECHA_PROCESO == NOW for r in got)
    assert [r.RES_AFP for r in got if r.DOC_IDN == 100] == ["error_origen"]
    assert [r.RES_AFP for r in got if r.DOC_IDN == 101] == ["ok", "ok"]
    assert all(r.RES_DIF == "" for r in got if r.ES_DIF is False)


def test_reasons(spark):
    source, landed, responses = tables(spark)
    columns = [F.col(c).alias(c.lower()) for c in source.columns]
    df = audit(source.select(*columns), landed, responses, NOW, reasons=True)
    assert df.columns == [f.name for f in RESULT_SCHEMA] + ["REASON"]
    got = {r.DOC_IDN: r.REASON for r in df.collect()}
    assert {link: got[n] for n, link in enumerate(CASES)} == REASONS
    assert (got[100], got[101]) == ("no_link", "same")


# Issuer, answer (status, body, text) or None, the reason.
ANSWERS = [
    ("modelo", None, "no_response"), ("modelo", (500, "file", "x"), "response_status"), ("modelo", (None, "file", "x"), "response_status"),
    ("uno", (200, "{", None), "malformed_answer"), ("uno", (200, None, None), "malformed_answer"), ("uno", (200, '{"codigo":0}', None), "refused"),
    ("uno", (200, '{"codigo":"0","data":{"bytes":"A"}}', None), "malformed_payload"), ("uno", (200, '{"codigo":"0","data":1}', None), "malformed_payload"),
    ("planvital", (200, '{"valid":1,"data":"/w=="}', None), "unreadable_copy"), ("planvital", (200, '{"valid":1}', None), "different"),
    ("provida", (200, None, "x"), "empty_answer"), ("provida", (200, "file", None), "unreadable_copy"),
    ("habitat", (200, "[", None), "malformed_answer"), ("habitat", (200, '{"resultado":1}', None), "refused"),
    ("habitat", (200, '{"resultado":0,"mensaje":5}', None), "no_copy_path"), ("habitat", (200, '{"resultado":0,"mensaje":"/none"}', None), "copy_not_landed"),
    ("habitat", (200, '{"resultado":0,"mensaje":"/gone"}', None), "copy_status"), ("habitat", (200, '{"resultado":0,"mensaje":"/raw"}', None), "unreadable_copy"),
]


def test_reasons_of_answers(spark):
    code = {"modelo": "Folio: abc{}", "uno": "Certificación N: u{}", "planvital": "Folio 12-{}", "provida": "certificado: 1.{}",
            "habitat": "codigo 00000001-aaaa-bbbb-cccc-{:012d}"}
    key = {"modelo": "1.234.567-8:abc{}", "uno": "12345678:u{}", "planvital": "12{}:12345678", "provida": "1{}-12345678",
           "habitat": "00000001-aaaa-bbbb-cccc-{:012d}"}
    batch = [(n, f"a{n}", None, NEW) for n in range(len(ANSWERS))]
    landed = [(f"a{n}", 200, paper(a, code[a].format(n)), None, None, None, None, NEW) for n, (a, _, _) in enumerate(ANSWERS)]
    landed += [(f"https://www.afphabitat.cl/{p}", s, None, None, None, None, None, NEW) for p, s in (("gone", 404), ("raw", 200))]
    answers = [(a, key[a].format(n), *v, NEW) for n, (a, v, _) in enumerate(ANSWERS) if v]
    df = audit(spark.createDataFrame(batch, "doc_idn long, link string, periodo_produccion date, fecha_ingreso timestamp"),
               spark.createDataFrame(landed, LANDED), spark.createDataFrame(answers, RESPONSES), NOW, reasons=True)
    got = {r.DOC_IDN: (r.REASON, r.RES_AFP) for r in df.collect()}
    for n, (_, _, reason) in enumerate(ANSWERS):
        assert got[n] == (reason, "ok" if reason == "different" else "error"), ANSWERS[n]


def test_run_and_rerun(spark, options):
    spark.sql("DROP TABLE IF EXISTS audit_test.results")
    # All but the row without an id; both copies of a repeated id.
    assert run(spark, options) == len(CASES) + 3
    target = spark.table(options.target_table)
    assert [(f.name, f.dataType) for f in target.schema] == [(f.name, f.dataType) for f in RESULT_SCHEMA]
    check_outcomes(target.collect())
    assert run(spark, options) == 0
    assert spark.table(options.target_table).count() == len(CASES) + 3
    state = diagnose(spark, options).first()
    assert (state.already_processed, state.pending_after_dedup, state.null_ids) == (len(CASES) + 3, 1, 1)
    again = dataclasses.replace(options, filter_already_processed=False, row_limit=4)
    assert run(spark, again) == 4
    assert spark.table(options.target_table).count() == len(CASES) + 7


def test_run_in_batches(spark, options):
    spark.sql("DROP TABLE IF EXISTS audit_test.batches")
    small = dataclasses.replace(options, target_table="audit_test.batches", row_limit=7)
    assert [run(spark, small) for _ in range(3)] == [7, 7, 4]
    rows = spark.table(small.target_table).collect()
    check_outcomes(rows)
    assert run(spark, small) == 0


def test_nothing_is_left_in_the_shared_folder(spark, options, caplog):
    """Stored texts are removed after a run, and outcomes are counted on the write."""
    from pathlib import Path

    spark.sql("DROP TABLE IF EXISTS audit_test.counted")
    with caplog.at_level("INFO"):
        run(spark, dataclasses.replace(options, target_table="audit_test.counted", row_limit=9))
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    assert not list(folder.glob("job-*"))
    assert "'rows': 9" in caplog.text and "'not_obtained': 2" in caplog.text


def test_landed_folders_reach_the_result(spark, options, tmp_path):
    """A document that landed as a file, and the newest file as Capital's copy."""
    import os

    (tmp_path / "in").mkdir()
    (tmp_path / "copies").mkdir()
    paper_file = tmp_path / "in" / "one.txt"
    paper_file.write_text(CAP)
    for name, text, at in (("a", CAP + "\nstale", 1), ("b", CAP + "\nnewest", 2), ("c.crdownload", "partial", 3)):
        path = tmp_path / "copies" / f"{CAPITAL}.{name}"
        path.write_text(text)
        os.utime(path, (1_700_000_000 + at,) * 2)
    link = S.read_landed_files(spark, str(tmp_path / "in")).first().link
    spark.createDataFrame([(1, link, dt.date(2024, 4, 1), NEW)], "DOC_IDN long, LINK string, PERIODO_PRODUCCION date, FECHA_INGRESO timestamp").createOrReplaceTempView("file_source")
    spark.sql("DROP TABLE IF EXISTS audit_test.from_files")
    spark.table(options.responses_table).filter("afp <> 'capital'").createOrReplaceTempView("other_responses")
    folders = dataclasses.replace(
        options,
        source_table="file_source",
        responses_table="other_responses",
        target_table="audit_test.from_files",
        landed_folder=str(tmp_path / "in"),
        capital_folder=str(tmp_path / "copies"),
    )
    assert run(spark, folders) == 1
    row = spark.table("audit_test.from_files").first()
    assert (row.RES_AFP, row.ES_DIF, row.RES_DIF) == ("ok", True, "- newest")


def test_a_copy_is_taken_once(spark, options, tmp_path):
    """A second run does not take the copy that the first took; a newer one it does."""
    import os

    other = CAPITAL.replace("AB1CD", "ZZ1CD")
    texts = {1: CAP, 2: CAP, 3: CAP.replace(CAPITAL, other), 4: CAP}

    def copy(code, name, text, at):
        path = tmp_path / f"{code}.{name}"
        path.write_text(text)
        os.utime(path, (1_700_000_000 + at,) * 2)

    copy(CAPITAL, "a", CAP, 1)
    landed = [(f"ledger{k}", 200, t, "", "", "", "", NEW) for k, t in texts.items()]
    spark.createDataFrame(landed, LANDED).createOrReplaceTempView("ledger_landed")
    spark.table(options.responses_table).filter("afp <> 'capital'").createOrReplaceTempView("ledger_responses")
    for table in ("ledger_results", "ledger_seen"):
        spark.sql(f"DROP TABLE IF EXISTS audit_test.{table}")
    ledger = dataclasses.replace(
        options, source_table="ledger_source", landed_table="ledger_landed", responses_table="ledger_responses",
        target_table="audit_test.ledger_results", capital_folder=str(tmp_path), seen_files_table="audit_test.ledger_seen",
    )

    def audited(*ids):
        rows = [(k, f"ledger{k}", dt.date(2024, 4, 1), NEW) for k in ids]
        spark.createDataFrame(rows, "DOC_IDN long, LINK string, PERIODO_PRODUCCION date, FECHA_INGRESO timestamp").createOrReplaceTempView("ledger_source")
        assert run(spark, ledger) == len(ids)
        return [r.RES_AFP for r in spark.table(ledger.target_table).filter(F.col("DOC_IDN").isin(*ids)).orderBy("DOC_IDN").collect()]

    # Taken once by a run, for all documents of it that ask; the other code has none.
    assert audited(1, 3) == ["ok", "error"]
    assert audited(2) == ["error"]
    copy(CAPITAL, "b", CAP + "\nnewer", 5)
    copy(other, "c", texts[3], 2)
    assert audited(4) == ["ok"]
    seen = sorted(r.path.rsplit(".", 1)[1] for r in spark.table(ledger.seen_files_table).collect())
    assert seen == ["a", "b"]  # nobody asked for the other code's file
    # Without a ledger a copy is there for every run.
    again = dataclasses.replace(ledger, seen_files_table=None, filter_already_processed=False)
    assert run(spark, again) == 1
    assert {r.RES_AFP for r in spark.table(ledger.target_table).filter("DOC_IDN = 4").collect()} == {"ok"}


def test_nothing_recent_makes_no_table(spark, options):
    late = dataclasses.replace(options, target_table="audit_test.never", as_of=dt.date(2030, 1, 1))
    assert run(spark, late) == 0
    assert not spark.catalog.tableExists(late.target_table)
    assert diagnose(spark, late).first().dedup_state == "no_target"


def test_missing_column_stops_before_any_job(spark, options):
    spark.sql("CREATE OR REPLACE TEMP VIEW narrow AS SELECT 1 AS doc_idn")
    with pytest.raises(ValueError, match="FECHA_INGRESO"):
        run(spark, dataclasses.replace(options, source_table="narrow"))


def test_bucketed_tables_give_the_same(spark, options):
    for name, key, table in (("landed_b", ["link"], options.landed_table),
                             ("responses_b", ["afp", "request_key"], options.responses_table)):
        spark.sql(f"DROP TABLE IF EXISTS audit_test.{name}")
        S.save_bucketed(spark.table(table), f"audit_test.{name}", key, 4)
    spark.sql("DROP TABLE IF EXISTS audit_test.from_buckets")
    bucketed = dataclasses.replace(options, target_table="audit_test.from_buckets", bucketed=True,
                                   landed_table="audit_test.landed_b", responses_table="audit_test.responses_b")
    assert run(spark, bucketed) == len(CASES) + 3
    check_outcomes(spark.table(bucketed.target_table).collect())


def fresh_tables(spark, options, prefix, **more):
    """Options with targets of their own, none of which exists yet."""
    for name in ("results", "reasons", "index"):
        spark.sql(f"DROP TABLE IF EXISTS audit_test.{prefix}_{name}")
    return dataclasses.replace(options, target_table=f"audit_test.{prefix}_results", reasons_table=f"audit_test.{prefix}_reasons", **more)


def test_reasons_are_kept_beside_the_results(spark, options, caplog):
    kept = fresh_tables(spark, options, "kept")
    with caplog.at_level("INFO"):
        assert run(spark, kept) == len(CASES) + 3
    rows = spark.table(kept.reasons_table).collect()
    assert {r.DOC_IDN: r.REASON for r in rows if r.DOC_IDN < 100} == {n: REASONS[k] for n, k in enumerate(CASES)}
    assert len(rows) == len(CASES) + 3 and "'reason_not_certificate': 2" in caplog.text
    assert "REASON" not in spark.table(kept.target_table).columns


def stopped(monkeypatch, spark, options, place):
    """Run until the function at ``place``, which fails as a lost driver would."""
    with monkeypatch.context() as patch:
        def lost(*_, **__):
            raise KeyboardInterrupt

        patch.setattr(place, lost)
        with pytest.raises(KeyboardInterrupt):
            run(spark, options)


def job_folders(spark):
    from pathlib import Path

    from folioaudit.session import shared_folder

    return list(Path(shared_folder(spark).removeprefix("file:")).glob("audit-job-*"))


def test_a_job_goes_on_from_its_stored_stages(spark, options, monkeypatch):
    """Stopped after extraction; the documents that landed are gone when it is started again."""
    spark.table(options.landed_table).write.mode("overwrite").saveAsTable("audit_test.going")
    job = fresh_tables(spark, options, "job", job_id="resumed", landed_table="audit_test.going")
    stopped(monkeypatch, spark, job, "folioaudit.plans.audit.verify")
    assert job_folders(spark) and not spark.catalog.tableExists(job.target_table)
    only_copies = spark.table(options.landed_table).filter(F.col("link").startswith("https"))
    only_copies.write.mode("overwrite").saveAsTable("audit_test.going")
    assert run(spark, job) == len(CASES) + 3
    check_outcomes(spark.table(job.target_table).collect())
    assert not job_folders(spark)


@pytest.mark.parametrize("filtered", [True, False])
def test_a_job_lost_behind_its_append_adds_no_row_twice(spark, options, monkeypatch, filtered):
    job = fresh_tables(spark, options, "lost", job_id="lost", filter_already_processed=filtered, row_limit=8)
    stopped(monkeypatch, spark, job, "folioaudit.sources.tables.append_reasons")
    assert spark.table(job.target_table).count() == 8 and not spark.catalog.tableExists(job.reasons_table)
    assert run(spark, job) == 0
    assert (spark.table(job.target_table).count(), spark.table(job.reasons_table).count()) == (8, 8)
    # The name is free again: the next run is a new one.
    assert run(spark, job) == 8
    assert spark.table(job.target_table).count() == 16


def test_a_lost_job_without_a_name_leaves_nothing(spark, options, monkeypatch):
    job = fresh_tables(spark, options, "unnamed")
    before = job_folders(spark)
    stopped(monkeypatch, spark, job, "folioaudit.plans.audit.verify")
    assert job_folders(spark) == before


def test_two_runs_at_once_add_each_document_once(spark, options):
    from concurrent.futures import ThreadPoolExecutor

    both = fresh_tables(spark, options, "both")
    with ThreadPoolExecutor(2) as pool:
        added = list(pool.map(lambda _: run(spark, both), range(2)))
    assert sum(added) == spark.table(both.target_table).count() == len(CASES) + 3
    assert spark.table(both.reasons_table).count() == len(CASES) + 3


def test_a_lock_left_by_a_lost_run_is_taken_over(spark):
    import os
    from pathlib import Path

    from folioaudit.session import exclusive, shared_folder

    lock = Path(shared_folder(spark).removeprefix("file:")) / "audit-lock-old"
    lock.touch()
    os.utime(lock, (1_700_000_000,) * 2)
    with exclusive(spark, "old", 3600):
        assert lock.exists()
    assert not lock.exists()


def test_batches_by_index(spark, options, monkeypatch):
    """The index alone chooses: the target's ids are read in the batch's range only."""
    indexed = fresh_tables(spark, options, "by", row_limit=7, index_table="audit_test.by_index", index_buckets=4)
    ranges = []
    read = S.processed_ids
    monkeypatch.setattr(S, "processed_ids", lambda *a, **k: (ranges.append(k.get("between")), read(*a, **k))[1])
    assert run(spark, indexed) == 7
    ranges.clear()
    assert [run(spark, indexed) for _ in range(2)] == [7, 4]
    assert None not in ranges
    assert run(spark, dataclasses.replace(indexed, enable_candidate_diagnostics=False)) == 0
    check_outcomes(spark.table(indexed.target_table).collect())
    ids = {r.DOC_IDN for r in spark.table(indexed.target_table).collect()}
    assert {r.doc_idn for r in spark.table(indexed.index_table).collect()} == ids


def test_an_index_that_lags_or_comes_late(spark, options):
    """Made from a target that has none; rows that others appended are found, and then indexed."""
    late = fresh_tables(spark, options, "late", row_limit=5)
    assert run(spark, late) == 5
    late = dataclasses.replace(late, index_table="audit_test.late_index", index_buckets=4)
    assert run(spark, late) == 5
    assert run(spark, dataclasses.replace(late, index_table=None)) == 5
    # The five of the last run are chosen, left out and indexed; then the next are due.
    assert run(spark, late) == 3
    ids = [r.DOC_IDN for r in spark.table(late.target_table).collect()]
    assert len(ids) == len(CASES) + 3 and sorted(set(ids)) == sorted([*range(len(CASES)), 100, 101])
