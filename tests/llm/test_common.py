"""What Python workers keep, and arrays added up in tasks."""

import time

import numpy as np
from pyspark.sql import functions as F

from folioaudit.llm import common as C


class Table(dict):
    pass


def test_idle_workers_let_go(monkeypatch):
    monkeypatch.setattr(C, "IDLE_SECONDS", 0.4)
    made = []

    def make():
        made.append(1)
        return Table(a=1)

    first = C.kept("one", make, lambda _: False)
    time.sleep(1.2)
    assert C.kept("one", make, lambda _: False) is first, "a task still holds it"
    del first
    time.sleep(0.1)
    C.kept("one", make, lambda _: False)
    assert len(made) == 1
    time.sleep(1.5)
    assert not C._kept
    C.kept("one", make, lambda _: False)
    assert len(made) == 2
    C.kept("two", make, lambda _: False)
    assert list(C._kept) == ["two"] and len(made) == 3
    C.kept("two", make, lambda t: len(t) > 0)
    assert len(made) == 4
    C._kept.clear()


def test_blocks_are_added(spark):
    rows = spark.range(0, 300, 1, 150)

    def blocks(batches):
        import pyarrow as pa

        total = np.zeros(6)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                total += i
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["block"])

    found = C.summed_blocks(rows.mapInArrow(blocks, "block binary"), 150, (2, 3))
    assert np.array_equal(found, np.full((2, 3), 300 * 299 / 2))
    assert C.summed_blocks(rows.filter(F.col("id") < 0).mapInArrow(blocks, "block binary"), 150, (2, 3)).sum() == 0


def test_texts_go_to_workers_in_small_batches(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 3000, 1, 1).withColumn("text", F.repeat(F.lit("words "), 1000))

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["n", "rows"])

    def seen():
        return C.checkpointed_lean(docs.mapInArrow(sizes, "n long, rows long")).agg(F.max("n"), F.sum("rows"), F.count("n")).first()

    before = spark.conf.get(setting)
    most, rows, _ = seen()
    assert rows == 3000 and most < 1.5 * C.BATCH_BYTES
    assert spark.conf.get(setting) == before
    spark.conf.set(setting, "64m")  # a session's own size holds
    try:
        assert seen()[2] == 1
        assert spark.conf.get(setting) == "64m"
    finally:
        spark.conf.unset(setting)


def test_lean_tasks_give_memory_back(monkeypatch):
    called = []
    monkeypatch.setattr(C, "_given_back", lambda: called.append(1))

    @C.lean
    def twice(batches):
        for x in batches:
            yield 2 * x

    run = twice(iter([1, 2]))
    assert next(run) == 2 and not called
    assert list(run) == [4] and called == [1]
