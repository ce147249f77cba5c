"""Repeated runs of lines, found by winnowing over line hashes (operator 6).

A gram starts at each line that has words and takes lines until it holds
``GRAM_WORDS`` words. Of every ``WINDOW`` neighbouring grams the least hash is
a fingerprint, and so is every gram of a single line. Two guarantees follow:
a line of ``GRAM_WORDS`` words or more that repeats is found, and so is a part
of every repeated run in which ``WINDOW`` grams start.

Each fingerprint joins its first occurrence only (least doc_id, then position),
never all pairs. The match is extended line by line in both directions, and
the run is deleted where it occurs later. A line's first occurrence always stays.
A run that goes further with another document than with the first one keeps
the lines beyond, unless it has more than 50 words: ``passages`` finds those,
whatever document holds them first and wherever in its lines they lie.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, checkpointed, checkpointed_lean, lean, ship, spread_join, texts
from .passages import GROUP_BYTES, repeated_passages
from .wordhash import buffers_of, bytes_of, groups, line_heads, sequence_hashes, word_hashes

GRAM_WORDS = 20
WINDOW = 4
WORD = re.compile("[^ \\t-\\r]+")


def lines_of(text: str | None) -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
    """All lines; places, hashes and word counts of those that have words.

    Lines are equal if their words are, whatever white space lies between.
    """
    data, offsets = bytes_of([text])
    _, places, hashes, counts = _hashed_lines(data, offsets)
    return (text or "").split("\n"), places.tolist(), hashes, counts


def _hashed_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First bytes, places, hashes and word counts of the lines of neighbouring texts that have words."""
    starts, words = word_hashes(data, offsets)
    heads, places = line_heads(data, offsets, starts)
    ends = np.append(heads[1:], len(words)) if len(heads) else heads
    return starts[heads], places, sequence_hashes(words, heads, ends), ends - heads


def grams(hashes: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and length in lines of the gram at each line; a text's tail has none.

    ``edges`` are the first line of each text, and the end of the last one's.
    """
    ends = np.cumsum(counts)
    last = np.searchsorted(ends, ends - counts + GRAM_WORDS)
    starts = np.flatnonzero(last < np.repeat(edges[1:], np.diff(edges)))
    return starts, sequence_hashes(hashes, starts, last[starts] + 1), last[starts] - starts + 1


def chosen_grams(hashes: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines and hashes of window minima, the last of equals, and of long lines, text by text."""
    starts, found, sizes = grams(hashes, counts, edges)
    bounds = np.searchsorted(starts, edges)
    # For each gram the end of its text's grams: windows don't go beyond, and few grams are one window.
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(len(found))
    first = np.zeros(len(found), bool)
    first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    heads = at[first | (at + WINDOW <= ends)]
    best = heads
    for k in range(1, WINDOW):
        inside = heads + k < ends[heads]
        other = np.where(inside, heads + k, heads)
        best = np.where(inside & (found[other] <= found[best]), other, best)
    chosen = sizes == 1
    chosen[best] = True
    return starts[chosen], found[chosen]


def fingerprints(hashes: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """(gram hash, line position) of the fingerprints of one text."""
    lines, found = chosen_grams(hashes, counts, np.array([0, len(hashes)]))
    return list(zip(found.tolist(), lines.tolist()))


@lean
def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers_of(batch.column(1))
        for group in groups(offsets, GROUP_BYTES):
            own = offsets[group.start : group.stop + 1]
            starts, _, hashes, counts = _hashed_lines(data, own)
            edges = np.searchsorted(starts, own)
            lines, found = chosen_grams(hashes, counts, edges)
            bounds = np.searchsorted(lines, edges)
            places = lines - np.repeat(edges[:-1], np.diff(bounds))
            ends = pa.array(bounds.astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (found.view(np.int64), places.astype(np.int32))]
            images = pa.array([hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0)[group], batch.column(2)[group], images, *lists], ["doc", "digest", "hashes", "prints", "places"])


def extended(a: np.ndarray, b: np.ndarray, matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Positions in ``a`` of the longest equal runs around matches with ``b``.

    Matches on one diagonal that a run already covers are not extended again.
    """
    runs, diagonal, upto = [], None, 0
    for i, j in sorted(matches, key=lambda m: (m[0] - m[1], m[0])):
        if diagonal == i - j and i < upto:
            continue
        diagonal = i - j
        low, size = max(0, diagonal), min(len(a) - max(0, diagonal), len(b) - max(0, -diagonal))
        differ = np.flatnonzero(a[low : low + size] != b[low - diagonal : low - diagonal + size])
        at = np.searchsorted(differ, i - low)
        start = low + (int(differ[at - 1]) + 1 if at else 0)
        upto = low + (int(differ[at]) if at < len(differ) else size)
        runs.append((start, upto))
    return runs


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (doc, start, end) of the matches between a document and an earlier one."""
    for batch in batches:
        docs, starts, ends = [], [], []
        for doc, own, first, matches in zip(*(batch.column(n).to_pylist() for n in ("doc", "hashes", "first_hashes", "matches"))):
            pairs = [(m["place"], m["first_place"]) for m in matches]
            for start, end in extended(np.frombuffer(own, np.uint64), np.frombuffer(first, np.uint64), pairs):
                docs.append(doc)
                starts.append(start)
                ends.append(end)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["doc", "start", "end"]
        )


def _lines_with_words(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """All lines; places and word counts of those that have words."""
    lines = (text or "").split("\n")
    counts = [len(line.encode("utf-8", "surrogatepass").split()) for line in lines]
    places = [k for k, n in enumerate(counts) if n]
    return lines, places, [counts[k] for k in places]


def cut(text: str | None, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the lines of ``runs``, and how many of them had words.

    Lines without words stay unless they lie inside a run.
    """
    lines, places, _ = _lines_with_words(text)
    gone, n = set(), 0
    for start, end in runs:
        for k in range(start, end):
            n += places[k] not in gone
            gone.add(places[k])
        gone.update(range(places[start], places[end - 1]))
    return "\n".join(line for k, line in enumerate(lines) if k not in gone), n


def cut_words(text: str, runs: list[tuple[int, int]], spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the lines of ``runs`` and the words of ``spans``, and how many lines lost words.

    Lines that lose all their words go, and lines without words between deleted words.
    """
    lines, places, counts = _lines_with_words(text)
    ends = [0, *accumulate(counts)]
    gone = bytearray(ends[-1])
    for start, end in [(ends[a], ends[b]) for a, b in runs] + spans:
        gone[start:end] = b"\1" * (end - start)
    out, n, seen = [], 0, 0
    size = dict(zip(places, counts))
    for k, line in enumerate(lines):
        if k not in size:
            if not (0 < seen < len(gone) and gone[seen - 1] and gone[seen]):
                out.append(line)
            continue
        own = gone[seen : seen + size[k]]
        seen += size[k]
        lost = own.count(1)
        n += lost > 0
        if 0 < lost < size[k]:
            starts = [m.start() for m in WORD.finditer(line)]
            stops = [*starts[1:], len(line)]
            kept = line[: starts[0]] + "".join(line[a:b] for a, b, x in zip(starts, stops, own) if not x)
            out.append(kept.rstrip(" \t\v\f\r") if own[-1] else kept)
        elif not lost:
            out.append(line)
    return "\n".join(out), n


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, runs_at, spans_at = (batch.schema.get_field_index(n) for n in ("_cut_text", "_runs", "_spans"))
        texts, removed = [], []
        for text, runs, spans in zip(*(batch.column(n).to_pylist() for n in (at, runs_at, spans_at))):
            if spans:
                text, n = cut_words(text, [(r["start"], r["end"]) for r in runs or []], [(s["start"], s["end"]) for s in spans])
            elif runs:
                text, n = cut(text, _merged([(r["start"], r["end"]) for r in runs]))
            else:
                n = 0
            texts.append(text)
            removed.append(n)
        others = [n for n in batch.schema.names if n not in ("_cut_text", "_runs", "_spans")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in others), pa.array(texts, pa.string()), pa.array(removed, pa.int64())], [*others, "_text", "_removed"]
        )


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc, digest, start, end``: places, among lines with words, of later repeated runs.

    One row per distinct run. Of rows that repeat a ``doc_id`` with different
    texts one takes part, named by the text's ``digest``; a NULL ``doc_id`` none.
    """
    ship(docs.sparkSession)
    known = texts(docs).filter(F.col("doc_id").isNotNull()).withColumn("digest", F.xxhash64("text"))
    read = known.mapInArrow(_prints, "doc long, digest long, hashes binary, prints array<long>, places array<int>")
    # Distinct combines before the shuffle; then one text of a repeated doc_id is left.
    single = read.filter(F.size("prints") > 0).groupBy("doc").agg(F.min(F.struct("digest", "hashes", "prints", "places")).alias("x"))
    read = checkpointed_lean(single.select("doc", "x.digest", "x.hashes", "x.prints", "x.places"))
    marks = read.select("doc", F.explode(F.arrays_zip("prints", "places")).alias("m")).select(
        "doc", F.col("m.prints").alias("print"), F.col("m.places").alias("place")
    )
    first = (
        marks.groupBy("print")
        .agg(F.min(F.struct("doc", "place")).alias("least"), F.max(F.struct("doc", "place")).alias("most"))
        .filter(F.col("least") < F.col("most"))
        .select("print", F.col("least.doc").alias("first"), F.col("least.place").alias("first_place"))
    )
    later = (F.col("doc") > F.col("first")) | (F.col("place") > F.col("first_place"))
    matched = spread_join(marks, first, "print").filter(later).drop("print")
    # One row per two documents: line hashes travel once, whatever the matches.
    matched = matched.groupBy("doc", "first").agg(F.collect_list(F.struct("place", "first_place")).alias("matches"))
    hashes = read.select("doc", "hashes")
    own = spread_join(matched, hashes, "doc")
    both = spread_join(own, hashes.select(F.col("doc").alias("first"), F.col("hashes").alias("first_hashes")), "first")
    found = both.select("doc", "hashes", "first_hashes", "matches").mapInArrow(_runs, "doc long, start int, end int")
    return spread_join(found.distinct(), read.select("doc", "digest"), "doc")


def without_repeats(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, ``text`` without later repeated runs, and ``n_removed`` lines.

    Every row is returned. NULL and empty texts are returned as they are; so is
    a row without a ``doc_id``. Documents are ordered by ``doc_id``; within one
    document the earlier position stays. Rows that repeat a ``doc_id`` lose the
    same lines, those with another text none.
    """
    return _without(docs, keep, repeated_runs(docs), None)


def without_passages(docs: DataFrame, *keep: str) -> DataFrame:
    """As ``without_repeats``, for later copies of runs of more than 50 words only."""
    return _without(docs, keep, None, repeated_passages(docs))


def without_repeated_text(docs: DataFrame, *keep: str) -> DataFrame:
    """As ``without_repeats``, and also without later copies of runs of more than 50 words.

    A run of words that lies in deleted lines altogether is no first copy. ``n_removed`` counts the lines that
    lost words, also those of which a part is left.
    """
    runs = checkpointed(repeated_runs(docs))
    return _without(docs, keep, runs, repeated_passages(docs, runs))


def _without(docs: DataFrame, keep: tuple[str, ...], runs: DataFrame | None, spans: DataFrame | None) -> DataFrame:
    """``runs`` are places of lines, ``spans`` of words."""
    taken = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in keep]).alias("_row"),
        F.col("doc_id").cast("long").alias("_doc_id"),
        F.col("text").cast("string").alias("_cut_text"),
    )
    # The digest in the key spreads rows without an id, which match nothing.
    name = F.concat_ws("/", "_doc_id", F.xxhash64("_cut_text"))
    left = taken.withColumn("_key", F.when(F.col("_doc_id").isNotNull(), name).otherwise(F.concat(F.lit("!"), name)))
    found = [df.select("doc", "digest", F.struct("start", "end").alias("at"), F.lit(n).alias("part")) for n, df in enumerate((runs, spans)) if df is not None]
    gone = reduce(DataFrame.unionByName, found).groupBy("doc", "digest")
    lists = [F.collect_list(F.when(F.col("part") == n, F.col("at"))).alias(name) for n, name in enumerate(("_runs", "_spans"))]
    right = gone.agg(*lists).select(F.concat_ws("/", "doc", "digest").alias("_key"), "_runs", "_spans")
    row = dict(taken.dtypes)["_row"]
    shape = f"_row {row}, _text string, _removed long"
    right = checkpointed(right)
    names = right.select("_key")
    if names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # Only texts that lose something move; the others are read and returned.
        names = F.broadcast(names)
        some = left.join(names, "_key", "left_semi").join(right, "_key")
        done = some.select("_row", "_cut_text", "_runs", "_spans").mapInArrow(_cleaned, shape)
        whole = left.join(names, "_key", "left_anti").select("_row", F.col("_cut_text").alias("_text"), F.lit(0).cast("long").alias("_removed"))
        done = done.unionByName(whole)
    else:
        done = left.join(right, "_key", "left").select("_row", "_cut_text", "_runs", "_spans").mapInArrow(_cleaned, shape)
    return done.select(*[F.col("_row").getField(n).alias(n) for n in keep], F.col("_text").alias("text"), F.col("_removed").alias("n_removed"))
