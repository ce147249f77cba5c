"""Join and reduction forms that hold up when one key has much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def newest_by_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str) -> DataFrame:
    """The latest row per key.

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key with very many versions is not gathered anywhere. Equal
    times are settled by the values, which makes the choice repeatable.
    """
    latest = F.max(F.struct(order, *values)).alias("_latest")
    return (
        df.filter(_all_set(keys))
        .groupBy(*keys)
        .agg(latest)
        .select(*keys, *[F.col("_latest")[v].alias(v) for v in values])
    )


def _all_set(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        condition = condition & F.col(key).isNotNull()
    return condition


def only_keys(df: DataFrame, batch: DataFrame, keys: Sequence[str], bucketed: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``batch``, whatever the size of either.

    Spark picks the join by the sizes it measures. Both sides are dealt out on
    an image of the key, so that a key with very many rows can be split. Where
    ``df`` is stored in buckets of the key, the key itself joins them in place.
    """
    wanted = batch.filter(_all_set(keys)).select(*keys).distinct()
    if bucketed:
        return df.join(wanted, list(keys), "left_semi")
    image = "_wanted_key"
    key = F.to_json(F.struct(*keys))
    return df.withColumn(image, F.when(_all_set(keys), key)).join(wanted.select(key.alias(image)), image, "left_semi").drop(image)


def lookup(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, spread: Column) -> DataFrame:
    """Left join to a side with unique keys; left rows keep their number.

    Both sides are shuffled on a made-up key, for two reasons. Left rows
    without a key are spread by ``spread`` instead of meeting in one task. And
    both inputs of the join are plain shuffles, which is the form in which
    adaptive execution splits a partition made big by one key. The prefixes
    keep made-up keys and real keys apart.
    """
    key = "_lookup_key"
    left = left.withColumn(
        key,
        F.when(left_key.isNotNull(), F.concat(F.lit("="), left_key)).otherwise(
            F.concat(F.lit("!"), F.xxhash64(spread).cast("string"))
        ),
    )
    right = right.withColumn(key, F.concat(F.lit("="), right_key))
    return left.join(right, key, "left").drop(key)
