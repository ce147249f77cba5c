"""Line-first quality rules (operator 10).

Every line is judged on its own: by its punctuation, as navigation and as
boilerplate. Failing lines go, and a document that loses too much of its text
is rejected, as is one that fails the base statistics. DataFrame functions
only; every document is worked on in its own row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_PATTERN

SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8  # words of a window that may repeat
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
MOST_LOST = 50  # percent of the words that failing lines may hold

HAS_WORD = "[^ \\t-\\r]"
SYMBOLS = "[#*$%&|<>]"
# A sentence ends; closing quotes and brackets may follow.
ENDS_SENTENCE = "[.!?:;…。！？][\"'”’»)\\]]*[ \\t-\\r]*$"
# Shouting: three times two or more exclamation marks. Runs are counted, so a
# long one is read once.
SHOUT, SHOUTS = "!!++", 3
# Two or more separators with entries between them.
SEPARATED = "[|»›·•][^|»›·•]+[|»›·•]"
NAVIGATION = (
    "(?i)^[ \\t-\\r]*(?:home|menu|search|login|log in|sign in|sign up|register|next|previous|back to top|read more|"
    "share|contact(?: us)?|about(?: us)?|sitemap|skip to content)[ \\t-\\r]*[.!:>»]*[ \\t-\\r]*$"
)
BOILERPLATE = (
    "(?i)all rights reserved|licensed under the|released under the|copyright (?:\\(c\\)|©|\\d{4})|©|"
    "cookie policy|privacy policy|terms of (?:use|service)|subscribe to our|accept (?:all )?cookies|powered by"
)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_PATTERN))


def line_fails(line: Column) -> Column:
    """Does a line that has words fail one of the rules?"""
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    return (
        ~line.rlike(ENDS_SENTENCE)
        | line.rlike(SEPARATED)
        | (F.regexp_count(line, F.lit(SHOUT)) >= SHOUTS)
        | line.rlike(NAVIGATION)
        | (10 * symbols > F.length(line))
        | line.rlike(BOILERPLATE)
    )


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the base statistics of each row's whole text.

    Each step is a select of its own that later steps refer to, so that no
    split runs twice.
    """
    out = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    all_lines = F.split(text, "\n")
    out = out.select("*", words_of(text).alias("_words"), F.filter(all_lines, lambda x: x.rlike(HAS_WORD)).alias("_lines"))
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda k: F.xxhash64(F.slice(words, k, WINDOW)))
    out = out.select(
        *keep,
        "_text",
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, hashes).alias("_windows"),
    )
    windows = F.col("_windows")
    placed = F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    out = out.select("*", F.when(some, F.sort_array(placed)).alias("_sorted")).drop("_windows")
    sorted_ = F.col("_sorted")
    hash_at = lambda k: F.get(sorted_, k)["h"]
    repeated = F.filter(
        sorted_, lambda w, k: F.coalesce(w["h"] == hash_at(k - 1), F.lit(False)) | F.coalesce(w["h"] == hash_at(k + 1), F.lit(False))
    )
    out = out.select("*", F.sort_array(F.transform(repeated, lambda w: w["k"])).alias("_starts")).drop("_sorted")
    # Every start adds the words that the one before it doesn't reach.
    first = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
    covered = F.aggregate(
        F.col("_starts"),
        first,
        lambda s, k: F.struct(k.alias("at"), (s["n"] + F.least(F.lit(WINDOW), k - s["at"])).alias("n")),
        lambda s: s["n"],
    )
    return out.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("_starts")


def judged(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, statistics, ``lost_words``, ``base_failed``, ``kept`` and ``clean_text``.

    A NULL or empty text has no words and fails the base. ``clean_text`` has the
    lines that pass; lines without words stay. Rows are judged one by one, so
    repeated rows agree and an empty table gives no rows.
    """
    out = statistics(docs, *keep)
    # Line and verdict side by side: looked up by position in a lambda, the
    # verdicts would be worked out anew for every line.
    verdict = lambda line: line.rlike(HAS_WORD) & line_fails(line)
    marked = F.transform(F.split("_text", "\n"), lambda line: F.struct(line.alias("line"), verdict(line).alias("fails")))
    out = out.select("*", marked.alias("_marked"))
    failing = F.filter("_marked", lambda x: x["fails"])
    lost = F.aggregate(failing, F.lit(0), lambda n, x: n + F.size(words_of(x["line"])))
    out = out.select("*", lost.cast("long").alias("lost_words"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    passing = F.transform(F.filter("_marked", lambda x: ~x["fails"]), lambda x: x["line"])
    return out.select(
        *[c for c in out.columns if c not in ("_text", "_marked")],
        base.alias("base_failed"),
        (~base & (100 * F.col("lost_words") <= MOST_LOST * F.col("n_words"))).alias("kept"),
        F.array_join(passing, "\n").alias("clean_text"),
    )
