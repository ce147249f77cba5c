"""Fold text to ASCII: compatibility decomposition, then drop the rest."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"


@lru_cache(maxsize=1)
def fold_table() -> dict[str, str]:
    """Every non-ASCII character that leaves ASCII behind, and what it leaves.

    Folding works character by character: decomposition only ever reorders
    combining marks, none of which is ASCII.
    """
    table = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        left = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if left:
            table[char] = left
    return table


@lru_cache(maxsize=1)
def _split_table() -> tuple[str, str, dict[str, str]]:
    single = {k: v for k, v in fold_table().items() if len(v) == 1}
    wide = {k: v for k, v in fold_table().items() if len(v) > 1}
    return "".join(single), "".join(single.values()), wide


def _ranges(chars: list[str]) -> str:
    """A character class that lists neighbours as ranges."""
    codes = sorted(map(ord, chars))
    runs = [[codes[0], codes[0]]]
    for code in codes[1:]:
        if code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in runs) + "]"


def _widen(text: Column, wide: dict[str, str]) -> Column:
    """Replace characters that become several: cut at them, look each one up."""
    # The look-ahead passes over ASCII without trying every range.
    char_class = f"(?={NON_ASCII}){_ranges(list(wide))}"
    # One literal for the whole table keeps the plan small; it folds to a map.
    listed = "\x02".join(f"{char}\x01{left}" for char, left in wide.items())
    entries = F.str_to_map(F.lit(listed), F.lit("\x02"), F.lit("\x01"))
    pieces = F.arrays_zip(
        F.split(text, char_class).alias("piece"),
        F.regexp_extract_all(text, F.lit(char_class), F.lit(0)).alias("hit"),
    )
    joined = F.array_join(
        F.transform(pieces, lambda p: F.concat(p["piece"], F.coalesce(entries[p["hit"]], F.lit("")))),
        "",
    )
    return F.when(text.rlike(char_class), joined).otherwise(text)


def fold(text: Column) -> Column:
    """ASCII form of ``text``; NULL stays NULL. Pure ASCII passes untouched."""
    source, target, wide = _split_table()
    folded = F.regexp_replace(F.translate(_widen(text, wide), source, target), NON_ASCII, "")
    return F.when(text.rlike(NON_ASCII), folded).otherwise(text)
