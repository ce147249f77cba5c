"""Benchmark items in documents, re-parameterised ones included (operator 4).

Words are canonicalised: numbers, names and units become typed placeholders.
Windows of the resulting templates are joined by hash. Where a document's
windows line up with an item's, the values behind the placeholders must map to
each other one to one; then the item counts as found if enough of its windows
were matched.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, checkpointed_lean, lean, row_key, rows_of, ship
from .common import kept as kept_table

WINDOW = 8  # template words of a window
LITERALS = 4  # words of a window that must not be placeholders
COVERAGE = 0.5  # part of an item's windows that must be found
CACHE_WORDS = 300_000
GROUP_WORDS = 300_000
FILTER_BITS = 20  # the scan's filter is a table of 2 ** 20 marks, whatever the benchmark

# Units of measure and money that follow a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles mg g kg t lb lbs oz ml cl l s sec min h hr hrs hour hours day days week weeks"
    " month months year years hz khz mhz ghz b kb mb gb tb w kw mw v a k c f pa bar j kj cal kcal percent % usd eur gbp"
    " dollar dollars euro euros cent cents".split()
)
_SLOTS = {kind: np.uint64(xxhash.xxh3_64_intdigest(b"\0" + kind)) for kind in (b"number", b"name", b"unit")}
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/%-]*([^\W\d]{0,4})")
_STRIP = re.compile(r"^[^\w$€£+%-]+|[^\w%]+$")
_SKIP, _NUM, _CAP, _STOP, _UNIT = 1, 2, 4, 8, 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bare(word: str) -> str:
    """A word as slot value: lower case, without punctuation around it."""
    return _STRIP.sub("", word).lower()


class Words(dict):
    """Row of each distinct word; its hash and flags, worked out once."""

    def __init__(self):
        super().__init__()
        self.hashes, self.flags = array("Q"), array("B")

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        plain, flags = bare(word), 0
        number = _NUMBER.fullmatch(plain)
        if not plain:
            flags |= _SKIP
        elif number and (not number[1] or number[1] in UNITS):
            flags |= _NUM
        elif plain in UNITS:
            flags |= _UNIT
        letters = _STRIP.sub("", word)
        if letters[:1].isupper() and not letters[1:2].isupper():
            flags |= _CAP
        if word.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":"):
            flags |= _STOP
        self.hashes.append(xxhash.xxh3_64_intdigest(plain.encode("utf-8", "surrogatepass")))
        self.flags.append(flags)
        return at


def templates(texts: list[str | None], known: Words) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words, template hashes, placeholder marks and text numbers, all texts in a row."""
    words: list[str] = []
    sizes = []
    for text in texts:
        own = (text or "").split()
        sizes.append(len(own))
        words += own
    rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    hashes, flags = np.array(known.hashes, np.uint64)[rows], np.array(known.flags, np.uint8)[rows]
    owner = np.repeat(np.arange(len(texts)), sizes)
    kept = np.flatnonzero(flags & _SKIP == 0)
    hashes, flags, owner = hashes[kept], flags[kept], owner[kept]
    fresh = np.ones(len(kept), bool)
    fresh[1:] = owner[1:] != owner[:-1]
    behind = np.zeros(len(kept), np.uint8)
    behind[1:] = flags[:-1]
    number = flags & _NUM != 0
    unit = (flags & _UNIT != 0) & (behind & _NUM != 0) & ~fresh
    # A capital that no sentence start explains marks a name.
    name = (flags & _CAP != 0) & ~fresh & (behind & _STOP == 0) & ~number & ~unit
    out = np.select([number, name, unit], [_SLOTS[b"number"], _SLOTS[b"name"], _SLOTS[b"unit"]], hashes)
    return [words[k] for k in kept], out, number | name | unit, owner


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    total = np.full(max(0, len(hashes) - width + 1), width, np.uint64)
    for k in range(width if len(total) else 0):
        total = total * _ODD + hashes[k : len(hashes) - width + 1 + k]
    total = (total ^ (total >> np.uint64(32))) * _ODD
    return total ^ (total >> np.uint64(29))


def item_windows(item: object, text: str | None, known: Words) -> list[dict]:
    """Windows of one benchmark item; one of fewer words is one window.

    The first word may be a name or the start of a sentence in a document, so
    a window on a capital there has two forms. Windows with too few literal
    words are left out: they would match by chance.
    """
    words, hashes, slots, _ = templates([text], known)
    width = min(WINDOW, len(words))
    forms = [(hashes, slots)]
    if words and known.flags[known[words[0]]] & _CAP and not slots[0]:
        other, marked = hashes[:width].copy(), slots[:width].copy()
        other[0], marked[0] = _SLOTS[b"name"], True
        forms.append((other, marked))
    out = []
    for values, marked in forms if width else []:
        for at, hashed in enumerate(window_hashes(values, width)):
            inside = marked[at : at + width]
            if width - int(inside.sum()) >= LITERALS:
                values_in = [bare(words[at + k]) for k in np.flatnonzero(inside)]
                out.append({"item_id": item, "place": at, "width": width, "window": int(hashed.view(np.int64)), "slots": values_in})
    return out


_WINDOWS = "item_id long, place int, width int, window long, slots array<string>"


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("item_id", pa.int64()), ("place", pa.int32()), ("width", pa.int32()), ("window", pa.int64()), ("slots", pa.list_(pa.string()))]
    )
    for batch in batches:
        known, rows = Words(), []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows += item_windows(item, text, known)
        yield pa.RecordBatch.from_pylist(rows, schema)


def _words() -> Words:
    return kept_table("templates", Words, lambda words: len(words) > CACHE_WORDS)


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``GROUP_WORDS`` words, by their characters."""
    first, held = 0, 0
    for n, text in enumerate(texts):
        held += len(text or "")
        if held >= 6 * GROUP_WORDS:
            yield first, n + 1
            first, held = n + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _candidates(marks, widths: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        marked = np.unpackbits(np.frombuffer(marks.value, np.uint8)).astype(bool)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high in _groups(texts):
                words, hashes, slots, owner = templates(texts[low:high], _words())
                first = np.searchsorted(owner, np.arange(high - low))
                out: dict[str, list] = {"key": [], "at": [], "width": [], "window": [], "slots": []}
                for width in widths:
                    found = window_hashes(hashes, width)
                    hit = np.flatnonzero(marked[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
                    hit = hit[owner[hit] == owner[hit + width - 1]]
                    for at in hit.tolist():
                        out["key"].append(keys[low + owner[at]])
                        out["at"].append(at - int(first[owner[at]]))
                        out["width"].append(width)
                        out["window"].append(int(found[at].view(np.int64)))
                        out["slots"].append([bare(words[at + k]) for k in np.flatnonzero(slots[at : at + width])])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["key"], pa.string()),
                        pa.array(out["at"], pa.int32()),
                        pa.array(out["width"], pa.int32()),
                        pa.array(out["window"], pa.int64()),
                        pa.array(out["slots"], pa.list_(pa.string())),
                    ],
                    list(out),
                )

    return lean(run)


def found_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key, item_id, coverage``: items found in a document, named by ``row_key``.

    An item without text, or with too few literal words, has no windows and is
    found nowhere. A hot window is no problem: rows are one per place in a
    document and item, and groups are bounded by the document.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = checkpointed(items.filter(F.col("item_id").isNotNull()).mapInArrow(_item_rows, _WINDOWS).distinct())
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # at most WINDOW values
    # At most 2 ** FILTER_BITS marks, however large the benchmark.
    marks = windows.select(F.shiftrightunsigned("window", 64 - FILTER_BITS).alias("m")).distinct().toPandas()["m"]
    table = np.zeros(1 << FILTER_BITS, bool)
    table[marks.to_numpy(np.int64)] = True
    shared = spark.sparkContext.broadcast(np.packbits(table).tobytes())
    read = docs.select(row_key().alias("key"), F.col("text").cast("string").alias("text"))
    seen = read.mapInArrow(_candidates(shared, widths), "key string, at int, width int, window long, slots array<string>")
    sizes = windows.groupBy("item_id").agg(F.count_distinct("place").alias("n"))
    lined = seen.join(windows.withColumnRenamed("slots", "item_slots"), ["window", "width"]).filter(
        F.size("slots") == F.size("item_slots")
    )
    pair = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    aligned = (
        lined.groupBy("key", "item_id", (F.col("at") - F.col("place")).alias("shift"))
        .agg(F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs"))
        # One to one: as many pairs as values on either side.
        .filter(
            (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))))
            & (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["d"]))))
        )
    )
    covered = aligned.groupBy("key", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"))
    share = (F.col("found") / F.col("n")).alias("coverage")
    return checkpointed_lean(covered.join(sizes, "item_id").select("key", "item_id", share).filter(F.col("coverage") >= COVERAGE))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, kept, n_items, item_ids, coverage`` for every row of ``docs``.

    NULL and empty texts hold nothing. Rows that repeat a ``doc_id`` are one
    document and get one verdict; rows without an id are told apart by text.
    An empty benchmark contaminates nothing; an empty table gives no rows.
    """
    found = found_items(docs, benchmark).groupBy("key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"))
    return rows.join(found, "key", "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.col("item_ids").isNull().alias("kept"),
        F.when(F.col("item_ids").isNull(), 0).otherwise(F.size("item_ids")).alias("n_items"),
        "item_ids",
        "coverage",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows, all columns, in which no item was found."""
    flagged = checkpointed(found_items(docs, benchmark).select("key").distinct())
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), row_key().alias("key"))
    left = rows_of(keyed, flagged, "key", "left_anti")
    return left.select(*[F.col("_row").getField(n).alias(n) for n in names])
