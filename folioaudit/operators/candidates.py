"""Choose the documents of one run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored


def _as_long(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("long")
    return F.col(name).try_cast("long")


def _as_timestamp(df: DataFrame, name: str) -> Column:
    # A plain cast keeps the lookback filter pushable into the scan.
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return F.col(name).try_cast("timestamp")


def _as_date(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.to_date(F.col(name))
    text = F.trim(F.col(name).cast("string"))
    # Six digits are a year and month, not a very late year.
    dashed = F.regexp_replace(text, r"^(\d{4})(\d{2})$", "$1-$2-01")
    return dashed.try_cast("date")


def _actual_name(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.upper() == name)


def normalize(df: DataFrame) -> DataFrame:
    """Four typed columns; values that do not convert become NULL."""
    name = lambda wanted: _actual_name(df, wanted)
    return df.select(
        _as_long(df, name("DOC_IDN")).alias("doc_idn"),
        F.col(name("LINK")).cast("string").alias("link"),
        _as_date(df, name("PERIODO_PRODUCCION")).alias("periodo_produccion"),
        _as_timestamp(df, name("FECHA_INGRESO")).alias("fecha_ingreso"),
    )


def in_lookback(cutoff: dt.date) -> Column:
    return F.to_date(F.col("fecha_ingreso")) >= F.lit(cutoff)


def lookback(df: DataFrame, cutoff: dt.date) -> DataFrame:
    """Rows received on the cutoff day or later."""
    return df.filter(in_lookback(cutoff))


def distinct_ids(ids: DataFrame) -> DataFrame:
    """One row per id. Combines before the shuffle, so a repeated id costs little."""
    return ids.select("doc_idn").distinct()


_KEY = "_id_key"


def _keyed(df: DataFrame) -> DataFrame:
    # A one-to-one image of the id. Joined on it, both inputs are plain
    # shuffles, and adaptive execution can split the rows of one hot id.
    return df.withColumn(_KEY, F.bitwise_not("doc_idn"))


def _known(ids: DataFrame) -> DataFrame:
    """The distinct ids, to be joined by shuffle whatever their files' size.

    A target's ids are a sliver of its files, and repeats compress to nothing: an
    estimate by bytes would send any number of them through the driver, and a
    broadcast once planned is not given up at run time.
    """
    return _keyed(distinct_ids(ids)).select(_KEY).hint("merge")


def pending(df: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows whose id is not processed; a NULL id never is."""
    if ids is None:
        return df
    return _keyed(df).join(_known(ids), _KEY, "left_anti").drop(_KEY)


def processed_among(df: DataFrame, index: DataFrame) -> DataFrame:
    """Ids of ``df`` that the index holds, once each.

    The index is stored in buckets of its id and is joined in place; of ``df``
    only one row per id and task is shuffled, and once more one per id where the
    session's shuffle partitions are not as many as the buckets.
    """
    return distinct_ids(df).join(index, "doc_idn", "left_semi")


def already_processed(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is processed: the other half of ``pending``."""
    return _keyed(df).join(_known(ids), _KEY, "inner").drop(_KEY)


# Further keys make the choice among copies of an id repeatable.
_ORDER = ("doc_idn", "fecha_ingreso", "link", "periodo_produccion")

# A task may order this many rows; what a cut falls into is narrowed down to them.
ORDERED_ROWS = 50_000
# Marks that split the open range in parts of like size, and how exact they are.
_MARKS, _ACCURACY = 500, 20_000


def first_by_id(df: DataFrame, row_limit: int, ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """Lowest ids first, at most ``row_limit`` rows; no limit when it is <= 0.

    A selection, not a sort, alike for every limit. Marks of the open id range
    are taken, the rows below and between the two marks around the wanted place
    are counted, and the range between them is opened next, until a task can
    order what is left in it. All rows below it belong to the result as they
    are. Each step is one aggregate, and its id range reaches the scan. ``df``
    is read several times: its rows must be repeatable.
    """
    if row_limit <= 0:
        return df
    id_ = F.col("doc_idn")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(id_.isNull()).alias("nulls"), _marks(id_)).first()
    if found.n <= row_limit:
        return df
    if found.n <= ordered_rows:
        return _ordered(df, row_limit)
    if found.nulls >= row_limit:
        return _cut(df.filter(id_.isNull()), row_limit, found.nulls, ordered_rows)
    wanted, inside, marks = row_limit - found.nulls, found.n - found.nulls, found.marks
    low, high, margin = marks[0], marks[-1], 1
    while inside > ordered_rows and low < high:
        around = _around(marks, wanted / inside, margin)
        if around == (low, high):
            break  # few ids hold nearly all rows
        within = id_ >= around[0]
        part = df.filter(id_.between(low, around[1])).agg(
            F.count_if(~within).alias("below"), F.count_if(within).alias("n"), _marks(F.when(within, id_))
        ).first()
        if part.below >= wanted or part.below + part.n < wanted:
            margin *= 4  # marks are estimates, counts are not
            continue
        (low, high), margin = around, 1
        wanted, inside, marks = wanted - part.below, part.n, part.marks
    below = df.filter(id_.isNull() | (id_ < low))
    return below.unionByName(_cut(df.filter(id_.between(low, high)), wanted, inside, ordered_rows))


def _marks(ids: Column) -> Column:
    places = [n / _MARKS for n in range(_MARKS + 1)]
    return F.percentile_approx(ids, places, _ACCURACY).alias("marks")


def _around(marks: list[int], place: float, margin: int) -> tuple[int, int]:
    """The marks ``margin`` steps before and behind a place between 0 and 1."""
    step = int(place * _MARKS)
    return marks[max(step - margin, 0)], marks[min(step + 1 + margin, _MARKS)]


def _ordered(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(*_ORDER).limit(n)


def _cut(df: DataFrame, wanted: int, rows: int, ordered_rows: int) -> DataFrame:
    """The first ``wanted`` of ``rows`` rows, however many copies one id has.

    Equal rows are counted, the rest is dealt out in ranges of the whole order;
    ranges before the cut are kept, and only the one it falls into is ordered.
    """
    if wanted >= rows:
        return df
    if rows <= ordered_rows:
        return _ordered(df, wanted)
    names = df.columns
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = stored(counted.repartitionByRange(*_ORDER).withColumn("_range", F.spark_partition_id()))
    for size in ranged.groupBy("_range").agg(F.sum("_copies").alias("n")).orderBy("_range").collect():
        if size.n >= wanted:
            break
        wanted -= size.n
    before = F.sum("_copies").over(
        Window.partitionBy("_range").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    )
    last = ranged.filter(F.col("_range") == size._range).withColumn("_left", F.lit(wanted) - F.coalesce(before, F.lit(0)))
    last = last.filter(F.col("_left") > 0).withColumn("_copies", F.least("_copies", "_left")).drop("_left")
    return _repeated(ranged.filter(F.col("_range") < size._range).unionByName(last)).select(*names)


def _repeated(df: DataFrame, block: int = 4096) -> DataFrame:
    """Each row ``_copies`` times, by lists of at most ``block`` numbers, or their number."""
    copies = F.col("_copies")
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((copies - 1) / block))))
    size = F.least(F.lit(block), copies - F.col("_block") * block)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), size)))


def candidates(source: DataFrame, ids: DataFrame | None, cutoff: dt.date, row_limit: int) -> DataFrame:
    """Recent, not yet processed rows with an id, lowest ids first."""
    recent = lookback(normalize(source), cutoff)
    # The target takes no NULL id; the diagnostics count such rows.
    return first_by_id(pending(recent, ids).filter(F.col("doc_idn").isNotNull()), row_limit)
