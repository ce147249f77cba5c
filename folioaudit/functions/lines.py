"""Line difference of two texts, as plain projections.

The difference is by multiset: the n-th copy of a line on one side pairs with
the n-th copy on the other, and unpaired copies are reported. Each row is
worked on alone: no shuffle, no explode, sort cost in the row's own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line ends of folded text, signs and separator of the report.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e]"
ONLY_VERIFIED = "-"
ONLY_ORIGINAL = "+"
SEPARATOR = " | "


def differs(verified: Column, original: Column) -> Column:
    return verified != original


def split_lines(text: Column) -> Column:
    """Lines without their ends; a final line end opens no further line."""
    closed = F.regexp_replace(text, f"(?:{LINE_END})\\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(closed, LINE_END))


def _entries(text: Column, side: int) -> Column:
    """(line, side, position) per line. Verified is side 0, original side 1."""
    return F.transform(
        split_lines(text),
        lambda line, at: F.struct(line.alias("line"), F.lit(side).alias("side"), at.alias("at")),
    )


def _unpaired(run: Column) -> Column:
    """Copies of one line left over on the side that has more of them."""
    verified = F.filter(run, lambda e: e["side"] == 0)
    spare = F.size(run) - 2 * F.size(verified)
    return (
        F.when(spare > 0, F.slice(run, F.size(run) - spare + 1, spare))
        .when(spare < 0, F.slice(verified, F.size(verified) + spare + 1, -spare))
        .otherwise(F.slice(run, 1, 0))
    )


def with_line_diff(df: DataFrame, verified: str, original: str, out: str) -> DataFrame:
    """Add ``out``: ``- line`` only in verified, ``+ line`` only in original.

    Equal texts give ``''``, a NULL side gives NULL. Every step is a column of
    its own, since a lambda would evaluate an inlined expression per element.
    """
    keep = df.columns
    work = ["_sorted", "_starts", "_runs"]
    sorted_, starts, runs = (F.col(name) for name in work)
    both = F.concat(_entries(F.col(verified), 0), _entries(F.col(original), 1))
    different = differs(F.col(verified), F.col(original))
    # Copies of a line stand together, verified before original, by position.
    df = df.select("*", F.when(different, F.sort_array(both)).alias("_sorted"))
    index = F.when(F.size(sorted_) > 0, F.sequence(F.lit(0), F.size(sorted_) - 1))
    df = df.select(
        "*",
        F.filter(
            index,
            lambda i: (i == 0) | (F.get(sorted_, i)["line"] != F.get(sorted_, i - 1)["line"]),
        ).alias("_starts"),
    )
    df = df.select(
        "*",
        F.transform(
            starts,
            lambda start, nth: F.slice(
                sorted_, start + 1, F.coalesce(F.get(starts, nth + 1), F.size(sorted_)) - start
            ),
        ).alias("_runs"),
    )
    spare = F.transform(
        F.flatten(F.transform(runs, _unpaired)),
        lambda e: F.struct(e["at"].alias("at"), e["side"].alias("side"), e["line"].alias("line")),
    )
    sign = lambda side: F.when(side == 0, ONLY_VERIFIED).otherwise(ONLY_ORIGINAL)
    report = F.array_join(
        F.transform(F.sort_array(spare), lambda e: F.concat(sign(e["side"]), F.lit(" "), e["line"])),
        SEPARATOR,
    )
    value = F.when(~different, F.lit("")).when(runs.isNotNull(), report)
    return df.select(*keep, value.alias(out))
