"""Best-fit packing with certified bin counts (operator 8).

Documents become token sequences and, where they are longer than a sequence,
pieces. Pieces are dealt into partitions of bounded size. Each partition packs
its pieces by best-fit decreasing and compares its number of bins with a lower
bound from dual-feasible functions. A partition that meets the bound is done.
The others put the pieces of their unfilled bins together, deal them anew and
pack again, as long as that saves bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, checkpointed_lean, kept, lean, ship, texts

CAPACITY = 2048
PARTITION_PIECES = 50_000  # what one task packs
ROUNDS = 4
DENOMINATORS = 24


def default_tokenizer() -> str:
    """The public tokenizer file's text."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def _tokenizer(tokenizer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        from .tokens import WordIds

        text = tokenizer.value
        encoder = kept(("tokens", hash(text)), lambda: WordIds(text), lambda _: False)  # it empties itself
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            out: list[list] = [[], [], [], [], []]
            for doc, found in zip(ids, encoder.encode(raw)):
                found = np.append(found, np.uint32(0)).astype("<u4")
                for piece, start in enumerate(range(0, len(found), CAPACITY)):
                    part = found[start : start + CAPACITY]
                    for column, value in zip(out, (doc, piece, start, len(part), zlib.crc32(part.tobytes()))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return lean(run)


def pieces(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a NULL text is the end token alone."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(default_tokenizer() if tokenizer is None else tokenizer)
    return texts(docs).mapInArrow(_tokenizer(shared), "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(sizes: np.ndarray) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    The first counts large sizes as whole bins and drops those that fit beside
    them. The second rounds sizes to k-ths of a bin. Integer arithmetic only.
    """
    counts = np.bincount(sizes, minlength=CAPACITY + 1)
    values = np.arange(CAPACITY + 1)
    number, content = np.cumsum(counts), np.cumsum(counts * values)
    best = 0
    for small in range(0, CAPACITY // 2 + 1):
        below = small - 1
        large = CAPACITY - small
        middle = int(content[large] - (content[below] if below >= 0 else 0))
        whole = int(number[CAPACITY] - number[large])
        best = max(best, -(-(CAPACITY * whole + middle) // CAPACITY))
    for k in range(1, DENOMINATORS + 1):
        scaled = (k + 1) * values
        exact = scaled % CAPACITY == 0
        kept = int((counts * values)[exact].sum())
        steps = int((counts * (scaled // CAPACITY))[~exact].sum())
        best = max(best, -(-(kept * k + steps * CAPACITY) // (CAPACITY * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each size, and how full each bin is. Ties by position."""
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
    open_rooms = 0  # bit r: a bin with room r exists
    for at, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, target = CAPACITY, len(fill)
            fill.append(0)
        bins[at], places[at] = target, fill[target]
        fill[target] += size
        if room > size:
            by_room[room - size].append(target)
            open_rooms |= 1 << (room - size)
    return bins, places, np.array(fill, np.int64)


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECE}, part long, bin long, offset long, fill long, gap long"


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by([(n, "ascending") for n in ("doc_id", "piece", "ids_crc32")])
    sizes = table.column("length").to_numpy()
    bins, places, fill = best_fit_decreasing(sizes)
    gap = len(fill) - lower_bound(sizes)
    columns = {n: table.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32", "part")}
    columns |= {"bin": pa.array(bins), "offset": pa.array(places), "fill": pa.array(fill[bins])}
    return pa.table({**columns, "gap": pa.array(np.full(len(sizes), gap, np.int64))})


def _dealt(rows: DataFrame, round_: int) -> DataFrame:
    """Rows packed in partitions of about ``PARTITION_PIECES``; another deal each round.

    Copies of one row take different partitions by a running number that the
    row's place in its task gives; the packing is stored at once, so a task that
    is run again changes nothing.
    """
    parts = max(1, -(-rows.count() // PARTITION_PIECES))
    salt = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(round_))
    return checkpointed(rows.withColumn("part", F.pmod(salt, F.lit(parts))).groupBy("part").applyInArrow(_pack, _PACKED))


def _bins(packed: DataFrame) -> int:
    return packed.filter(F.col("offset") == 0).count()


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece of every row.

    A NULL or empty text is packed as its end token. Repeated rows and rows
    without an id are packed each on its own. An empty table gives no rows.
    ``certified_gap`` tells by how many sequences the piece's last partition
    may exceed what any packing of that partition needs.
    """
    cut = checkpointed_lean(pieces(docs, tokenizer))
    name = lambda round_: F.lit(round_ << 58) + F.col("part") * F.lit(1 << 24) + F.col("bin")
    whole = cut.filter(F.col("length") == CAPACITY)
    whole = whole.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "certified_gap": F.lit(0).cast("long")})
    packed = _dealt(cut.filter(F.col("length") < CAPACITY), 0)
    done = []
    for round_ in range(ROUNDS + 1):
        finish = lambda rows, r=round_: rows.withColumn("sequence_id", name(r)).withColumnRenamed("gap", "certified_gap")
        loose = (F.col("gap") > 0) & (F.col("fill") < CAPACITY)
        again = packed.filter(loose)
        parts = again.select("part").distinct().limit(2).count()
        # One partition has nobody to exchange with.
        if round_ == ROUNDS or parts < 2:
            done.append(finish(packed))
            break
        after = _dealt(again.select(*[c.split()[0] for c in _PIECE.split(", ")]), round_ + 1)
        if _bins(after) >= _bins(again):
            done.append(finish(packed))
            break
        done.append(finish(packed.filter(~loose)))
        packed = after
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified_gap"]
    result = whole.select(*columns)
    for rows in done:
        result = result.unionByName(rows.select(*columns))
    return result
