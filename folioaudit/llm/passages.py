"""Repeated runs of more than 50 words, wherever in their lines they lie (operator 6).

Every window of ``PASSAGE`` words that an earlier place holds too is deleted.
Windows are compared themselves, so the result doesn't hang on which grams are
chosen: winnowed grams of ``GRAM`` words only tell which windows can be
repeated at all. Each window of ``PASSAGE`` words holds ``CHOICE`` grams, of
which the least hash is taken, so equal windows always share one.

Places are ordered by doc_id, digest of the text and position; a window's first
place is no reason to delete it. Where a window overlaps its own first place
only the words behind that are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, checkpointed_lean, lean, rows_of, ship, spread_join, texts
from .wordhash import BASE, buffers_of, bytes_of, groups, line_heads, sequence_hashes, word_hashes, words_per_text

PASSAGE = 51
GRAM = 11
CHOICE = PASSAGE - GRAM + 1
GROUP_BYTES = 1_500_000  # texts that are hashed together
CHUNK_WORDS = 400_000  # words whose windows are compared before the shuffle


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and how many each text has."""
    data, offsets = bytes_of(texts)
    starts, words = word_hashes(data, offsets)
    return words, words_per_text(starts, offsets)


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on."""
    at = np.arange(max(0, len(words) - width + 1))
    return sequence_hashes(words, at, at + width)


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``width`` neighbours, by doubling."""
    n, have = len(values) - width + 1, 1
    while have * 2 <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    return best(values[:n], values[width - have : width - have + n])


def fingerprints(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and places of the grams that are least in a window of ``PASSAGE`` words, and how many each text has."""
    found = run_hashes(words, GRAM)
    if len(found) < CHOICE:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(sizes), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    least = _sliding(found, CHOICE, np.minimum)
    # Windows across two texts choose nothing.
    least[owner[: len(least)] != owner[PASSAGE - 1 :]] = 0
    edge = np.zeros(CHOICE - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), CHOICE, np.maximum)
    chosen = np.flatnonzero((most == found) & (most > 0))
    begins = np.cumsum(sizes) - sizes
    return found[chosen], chosen - begins[owner[chosen]], np.bincount(owner[chosen], minlength=len(sizes))


@lean
def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers_of(batch.column(1))
        for group in groups(offsets, GROUP_BYTES):
            own = offsets[group.start : group.stop + 1]
            starts, words = word_hashes(data, own)
            found, at, numbers = fingerprints(words, words_per_text(starts, own))
            ends = pa.array(np.concatenate([[0], np.cumsum(numbers)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (found.view(np.int64), at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0)[group], *lists], ["doc", "prints", "places"])


def windows_at(size: int, places: np.ndarray) -> np.ndarray:
    """Places of the windows, of a text of ``size`` words, that hold a gram at one of ``places``."""
    last = size - PASSAGE
    if last < 0:
        return np.empty(0, np.int64)
    ends = np.zeros(last + 2, np.int64)
    places = places[places <= size - GRAM]
    np.add.at(ends, np.maximum(0, places - CHOICE + 1), 1)
    np.add.at(ends, np.minimum(last, places) + 1, -1)
    return np.flatnonzero(np.cumsum(ends[:-1]) > 0)


def _inside(ends: np.ndarray, runs: list[tuple[int, int]]) -> np.ndarray:
    """Whether all words of the window at each place lie in ``runs`` of lines, of which line k has the words up to ``ends[k + 1]``."""
    left = np.ones(int(ends[-1]), np.int64)
    for start, end in runs:
        left[ends[start] : ends[end]] = 0
    sums = np.concatenate([[0], np.cumsum(left)])
    return sums[PASSAGE:] == sums[:-PASSAGE]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_compared`` finds in one chunk of texts after the other, packed by document.

    Of a chunk's equal windows the first is left to be compared with other
    chunks; the others are repeated for ``sure``, and are joined to runs.
    """
    chunk: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        data, offsets = buffers_of(batch.column(batch.schema.get_field_index("text")))
        columns = [batch.column(batch.schema.get_field_index(n)) for n in ("doc", "digest", "places", "runs")]
        for group in groups(offsets, GROUP_BYTES):
            own = offsets[group.start : group.stop + 1]
            starts, words = word_hashes(data, own)
            edges = np.searchsorted(starts, own)
            heads = np.append(line_heads(data, own, starts)[0], len(words))
            marks, windows = run_hashes(words, GRAM), run_hashes(words, PASSAGE)
            least = _sliding(marks, CHOICE, np.minimum) if len(windows) else windows
            for low, high, *row in zip(edges[:-1], edges[1:], *(c[group].to_pylist() for c in columns)):
                doc, digest, places, runs = row
                places = np.array(places, np.int64)
                places = places[places <= high - low - GRAM]
                at = windows_at(high - low, places)
                # Equal windows have the same least gram, so that one is repeated too.
                at = at[np.isin(least[low + at], marks[low + places])]
                runs = [(r["start"], r["end"]) for r in runs or [] if r["digest"] == digest]
                if runs:
                    at = at[~_inside(heads[slice(*np.searchsorted(heads, [low, high + 1]))] - low, runs)[at]]
                chunk.append((doc, digest, at, windows[low + at]))
                size += len(at)
            if size >= CHUNK_WORDS:
                yield _packed(_compared(chunk))
                chunk, size = [], 0
    if chunk:
        yield _packed(_compared(chunk))


def _packed(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Windows as lists of one document each, then the sure runs, whose lists are empty."""
    window, doc, digest, start, end, sure = (c.to_numpy(zero_copy_only=False) for c in rows.columns)
    lone = int(len(sure) - sure.sum())
    fresh = np.flatnonzero((np.diff(doc[:lone], prepend=0) != 0) | (np.diff(digest[:lone], prepend=0) != 0) | (np.arange(lone) == 0))
    heads = np.concatenate([fresh, np.arange(lone, len(sure))])
    offsets = pa.array(np.concatenate([fresh, np.full(len(sure) - lone + 1, lone)]).astype(np.int32))
    packed = pa.array(np.arange(len(heads)) >= len(fresh))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[:lone])) for x in (start, window)]
    return pa.RecordBatch.from_arrays([pa.array(doc[heads]), pa.array(digest[heads]), *lists, packed, pa.array(start[heads]), pa.array(end[heads])], ["doc", "digest", "starts", "windows", "sure", "start", "end"])


def _compared(chunk: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    chunk = sorted({c[:2]: c for c in chunk}.values(), key=lambda c: c[:2])
    owner = np.repeat(np.arange(len(chunk)), [len(c[2]) for c in chunk])
    starts, windows = (np.concatenate([c[k] for c in chunk]) for k in (2, 3))
    docs, digests = (np.array([c[k] for c in chunk], np.int64)[owner] for k in (0, 1))
    # Rows are in the order of places, so the first of equals is the least.
    _, first, which = np.unique(windows, return_index=True, return_inverse=True)
    first = first[which]
    later = np.flatnonzero(first != np.arange(len(windows)))
    begin = np.where(owner[later] == owner[first[later]], np.maximum(starts[later], starts[first[later]] + PASSAGE), starts[later])
    end = starts[later] + PASSAGE
    own = owner[later]
    fresh = np.ones(len(later), bool)
    if len(later):
        fresh[1:] = (own[1:] != own[:-1]) | (begin[1:] > end[:-1])
    heads = np.flatnonzero(fresh)
    run_start = np.minimum.reduceat(begin, heads) if len(heads) else begin
    run_end = np.maximum.reduceat(end, heads) if len(heads) else end
    lone = np.flatnonzero(first == np.arange(len(windows)))
    # A run found here gets a key of its own place, for even shuffling.
    keys = [windows[lone], (docs[later][heads] ^ digests[later][heads]).view(np.uint64) * np.uint64(BASE) + run_start.astype(np.uint64)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(keys).view(np.int64)),
            pa.array(np.concatenate([docs[lone], docs[later][heads]])),
            pa.array(np.concatenate([digests[lone], digests[later][heads]])),
            pa.array(np.concatenate([starts[lone], run_start]).astype(np.int32)),
            pa.array(np.concatenate([starts[lone] + PASSAGE, run_end]).astype(np.int32)),
            pa.array(np.concatenate([np.zeros(len(lone), bool), np.ones(len(heads), bool)])),
        ],
        ["window", "doc", "digest", "start", "end", "sure"],
    )


def repeated_passages(docs: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """``doc, digest, start, end``: word places of later copies, one row per window or run.

    ``runs`` (doc, digest, start, end) are lines that are deleted anyway: windows
    that lie in them altogether don't count, neither as a copy nor as the first.

    Rows that repeat a ``doc_id`` with other texts are documents of their own,
    ordered by the text's ``digest``; equal rows are one. A NULL ``doc_id`` takes no part.
    """
    ship(docs.sparkSession)
    known = texts(docs).filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("doc"), "text")
    read = checkpointed_lean(known.mapInArrow(_prints, "doc long, prints array<long>, places array<int>").filter(F.size("prints") > 0))
    marks = read.select("doc", F.explode(F.arrays_zip("prints", "places")).alias("m")).select(
        "doc", F.col("m.prints").alias("print"), F.col("m.places").alias("place")
    )
    twice = marks.groupBy("print").count().filter("count > 1").select("print")
    hits = spread_join(marks, twice, "print", "left_semi").groupBy("doc").agg(F.collect_set("place").alias("places"))
    if runs is None:
        hits = hits.withColumn("runs", F.lit(None).cast("array<struct<digest:bigint,start:int,end:int>>"))
    else:
        lines = runs.groupBy("doc").agg(F.collect_list(F.struct("digest", "start", "end")).alias("runs"))
        hits = hits.join(lines, "doc", "left")
    hits = checkpointed(hits)
    # Texts move once: the narrow rows of a document meet before they join its text.
    wanted = rows_of(known, hits, "doc").withColumn("digest", F.xxhash64("text"))
    read = spread_join(wanted, hits, "doc").select("doc", "digest", "text", "places", "runs")
    shape = "doc long, digest long, starts array<int>, windows array<long>, sure boolean, start int, end int"
    spans = checkpointed(read.mapInArrow(_spans, shape))
    each = spans.filter(~F.col("sure")).select("doc", "digest", F.explode(F.arrays_zip("starts", "windows")).alias("w"))
    each = each.select("doc", "digest", F.col("w.starts").alias("start"), F.col("w.windows").alias("window"))
    # A chunk has each window once, whatever the number of copies. Only windows of
    # several chunks are compared, first by document, of which a long is the least.
    again = each.groupBy("window").agg(F.count("*").alias("n"), F.min("doc").alias("first")).filter("n > 1").select("window", "first")
    again = checkpointed(again)
    later = spread_join(each, again, "window").filter(F.col("doc") > F.col("first"))
    later = later.select("doc", "digest", "start", (F.col("start") + PASSAGE).cast("int").alias("end"))
    sure = spans.filter("sure").select("doc", "digest", "start", "end")
    return later.unionByName(sure).unionByName(_other_texts(spans, each, again))


def _other_texts(spans: DataFrame, each: DataFrame, again: DataFrame) -> DataFrame:
    """Windows of a ``doc_id`` with several texts that an earlier one of them holds first."""
    several = spans.groupBy("doc").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a < b").select("doc")
    own = spread_join(rows_of(each, checkpointed(several), "doc"), again, "window").filter(F.col("doc") == F.col("first")).drop("first")
    least = own.groupBy("window").agg(F.min("digest").alias("least"))
    later = spread_join(own, least, "window").filter(F.col("digest") > F.col("least"))
    return later.select("doc", "digest", "start", (F.col("start") + PASSAGE).cast("int").alias("end"))
