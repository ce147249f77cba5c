"""What the operators share: reading tables, shipping code, sized joins."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import math
import os
import sys
import tempfile
import threading
import time
import weakref
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# White space that ends a word, as in ``[^\x20\x09-\x0D]+``. It is what
# ``bytes.split()`` cuts at; the pattern is for Spark's own functions.
SPACE_PATTERN = "[ \\t-\\r]+"
# Broadcast sides may hold this many narrow rows; beyond it they are shuffled.
BROADCAST_ROWS = 200_000

# A worker without a task for so long gives its table back.
IDLE_SECONDS = 2.0

# Bytes of the rows that go to a Python worker at once, where texts do.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()
_kept: dict[object, object] = {}
_lock = threading.RLock()
_used = 0.0


def kept(name: object, make: Callable[[], object], full: Callable[[object], bool]) -> object:
    """A Python worker's table of words, kept from task to task until it is full.

    Workers outlive a stage: only one table is held, and none by a worker that
    has had nothing to do for ``IDLE_SECONDS``, so that the operators of a
    pipeline don't add theirs up.
    """
    global _used
    with _lock:
        if name not in _kept or full(_kept[name]):
            _kept.clear()
            _given_back()
            _kept[name] = make()
            threading.Thread(target=_watch, args=(weakref.ref(_kept[name]),), daemon=True).start()
        _used = time.monotonic()
        return _kept[name]


def _given_back() -> None:
    """Return freed memory to the system: allocators would hold it for the worker's life."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for tasks whose worker gives back at their end what they have freed."""

    @functools.wraps(run)
    def task(batches):
        yield from run(batches)
        _given_back()

    return task


def _watch(held: weakref.ref) -> None:
    """Let go of a table once no task holds it or has asked for it for a while."""
    names = 3  # this function's, the dictionary's and the call's own
    while True:
        time.sleep(IDLE_SECONDS / 2)
        with _lock:
            found = held()
            if found is None or all(found is not x for x in _kept.values()):
                return
            if time.monotonic() - _used > IDLE_SECONDS and sys.getrefcount(found) <= names:
                del found
                _kept.clear()
                _given_back()
                return
            del found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, through Spark."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def checkpointed(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def checkpointed_lean(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, for rows that Python workers make of whole texts.

    A batch of rows waits outside Spark's heap and, whole, in the worker; the
    default of 10,000 rows or 64 MB costs each core several times that. Batches of
    ``BATCH_BYTES`` are used here, unless the session sets a size of its own.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, None) is not None:
        return checkpointed(df)
    conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        return checkpointed(df)
    finally:
        conf.unset(_BATCH_SETTING)


def texts(docs: DataFrame) -> DataFrame:
    """The two columns that most operators read; the rest is pruned."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a long key, each side shuffled anew on an image of it.

    A side that an aggregate or window has already dealt out by ``key`` can't
    be split at run time. On the image both inputs are plain shuffles, the form
    in which adaptive execution splits a partition that one hot key fills.
    """
    image = "_image_of_key"
    left = left.withColumn(image, F.bitwise_not(key))
    right = right.withColumn(image, F.bitwise_not(key)).drop(key)
    return left.join(right, image, how).drop(image)


def rows_of(docs: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``key`` occurs in ``ids``, which has it once; or the others.

    A counted, small ``ids`` goes to where the texts are read; a larger one is
    joined by shuffle. Both give the same rows.
    """
    ids = ids.select(key)
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if small else ids, key, how)


DRIVER_BLOCKS = 64  # arrays that the driver adds up itself


def _added(batches):
    """One array of doubles: the sum of all that a task gets."""
    total = None
    for batch in batches:
        for block in batch.column(0).to_pylist():
            own = np.frombuffer(block, np.float64)
            total = own.copy() if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["block"])


def summed_blocks(blocks: DataFrame, parts: int, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the arrays in ``blocks(block binary)``, of which ``parts`` tasks return one each.

    Many are first added up in about as many tasks as each of them then gets, so
    that neither a task nor the driver holds an array per task.
    """
    while parts > DRIVER_BLOCKS:
        parts = max(DRIVER_BLOCKS, math.isqrt(parts))
        blocks = blocks.repartition(parts).mapInArrow(_added, "block binary")
    total = np.zeros(math.prod(shape))
    for row in blocks.collect():
        total += np.frombuffer(row["block"], np.float64)
    return total.reshape(shape)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row's document, also one without an id; never NULL.

    Rows without an id are told apart, and spread, by a hash of their text.
    """
    lone = F.concat(F.lit("!"), F.xxhash64(text).cast("string"))
    return F.when(F.col(doc_id).isNotNull(), F.concat(F.lit("="), F.col(doc_id).cast("string"))).otherwise(lone)
