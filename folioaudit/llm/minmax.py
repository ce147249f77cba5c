"""Near-duplicate documents by min-max hashing (operator 3).

Both the least and the greatest value under each permutation are kept, so one
pass of hashing gives two unbiased signature entries. Bands of the signature
propose links, full shingle sets confirm them.

No link is given up and no bucket is emitted as all its pairs:

1. Documents with equal sets form a class; its least ``doc_id`` stands for it.
2. In each bucket every member is compared with the least member. The links
   give first components.
3. A bucket whose other members still lie in several components is cut into
   blocks. Every two blocks meet in a task, which compares the members not yet
   connected and returns a spanning forest of its links: at most as many rows
   as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, checkpointed_lean, lean, rows_of, ship, spread_join, texts
from .components import components

WORDS = 5  # words of a shingle
SIMILAR = 75  # percent of the union that two sets must share
PERMUTATIONS = 120
BAND_ROWS = 5
# With 240 entries in 48 bands of 5, a pair of similarity 0.75 is missed with
# probability (1 - 0.75 ** 5) ** 48 = 2e-6.
BLOCK = 512  # members of a bucket that one side of a block pair holds
BLOCK_SHINGLES = 1_000_000  # and the shingles of their sets, about

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_random = np.random.default_rng(20_240_117)
_A = (_random.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A text of fewer than five words is one shingle, a text without words none.
    """
    words = (text or b"").lower().split()  # both touch ASCII only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _ODD + hashes[k : len(hashes) - width + 1 + k]
    return np.unique(_mixed(total))


def bands(found: np.ndarray) -> np.ndarray:
    """Band hashes of a set that isn't empty."""
    points = (found >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(points), 4096):  # bounds the table of values
        values = points[None, at : at + 4096] * _A[:, None]
        values ^= _B[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    rows = np.concatenate([low, high]).astype(np.uint64).reshape(-1, BAND_ROWS)
    keys = np.arange(len(rows), dtype=np.uint64)
    for k in range(BAND_ROWS):
        keys = _mixed(keys * _ODD + rows[:, k])
    return keys.view(np.int64)


@lean
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        raw = batch.column(1).cast(pa.binary()).to_pylist()
        counts, digests, keys = [], [], []
        for text in raw:
            found = shingles(text)
            counts.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            keys.append(bands(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "digest", "keys"],
        )


@lean
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [shingles(t).tobytes() for t in part.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["doc", "found"])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Does the intersection hold 75 of every 100 elements of the union?"""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < SIMILAR * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


@lean
def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(2), batch.column(3)
        keep = [
            alike(np.frombuffer(a[i].as_py(), np.uint64), np.frombuffer(b[i].as_py(), np.uint64))
            for i in range(batch.num_rows)
        ]
        chosen = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays(chosen.columns, ["a", "b"])


def forest(docs: list[int], parts: list[int], sides: list[int], found: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect the parts of a block pair, at most one per merge.

    ``sides`` says which block a member is of; members of one block are
    compared when the block meets itself.
    """
    root = {p: p for p in parts}

    def top(p: int) -> int:
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    links, same = [], len(set(sides)) == 1
    order = sorted(range(len(docs)), key=lambda i: len(found[i]))
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            if 100 * len(found[i]) < SIMILAR * len(found[j]):
                break  # all later sets are larger still
            if (same or sides[i] != sides[j]) and top(parts[i]) != top(parts[j]) and alike(found[i], found[j]):
                root[top(parts[i])] = top(parts[j])
                links.append((docs[i], docs[j]))
    return links


def _block_links(key: tuple, group: pa.Table) -> pa.Table:
    columns = {name: group.column(name).to_pylist() for name in ("doc", "component", "block", "found")}
    found = [np.frombuffer(x, np.uint64) for x in columns["found"]]
    links = forest(columns["doc"], columns["component"], columns["block"], found)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are alike."""
    left = spread_join(pairs.withColumnRenamed("a", "doc"), sets, "doc").select(
        F.col("doc").alias("a"), F.col("b").alias("doc"), F.col("found").alias("found_a")
    )
    both = spread_join(left, sets, "doc").select("a", F.col("doc").alias("b"), "found_a", F.col("found").alias("found_b"))
    return both.mapInArrow(_confirmed, "a long, b long")


def _unresolved(members: DataFrame, parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members, in blocks, of buckets that hold several components.

    The least member is left out: it was compared with all the others. Buckets
    with the same members, as copies make in many bands, count once.
    """
    placed = spread_join(members, parts.select(F.col("node").alias("doc"), "component"), "doc", "left")
    placed = spread_join(placed.withColumn("component", F.coalesce("component", "doc")), sizes, "doc")
    open_ = (
        placed.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("size"),
            F.sum(F.xxhash64("doc").cast("decimal(20,0)")).alias("content"),
            F.sum(F.xxhash64("doc", F.lit(1)).cast("decimal(20,0)")).alias("content2"),
        )
        .filter("low < high")
        .groupBy("n", "content", "content2")
        .agg(F.min("key").alias("key"), F.max("size").alias("size"))
        .select("key", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    return spread_join(placed.select("key", "doc", "component"), open_, "key").withColumn("block", block)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    A NULL or empty text has no shingles and is linked with nothing. Rows that
    repeat a ``doc_id`` count as one document with several texts and are each
    returned. A NULL ``doc_id`` can't name a component: it is linked with
    nothing, its component is NULL and it isn't kept. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    docs = texts(docs)
    signed = checkpointed_lean(
        docs.mapInArrow(_signed, "doc_id long, n_shingles long, digest binary, keys array<long>")
    )
    classes = (
        signed.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "keys")).alias("least"))
        .select("digest", F.col("least.doc_id").alias("doc"), F.col("least.keys").alias("keys"))
    )
    classes = checkpointed(classes)
    # Rows that repeat a doc_id bring several key lists, which are one member.
    banded = classes.select("doc", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("_most"))
    shared = buckets.filter(F.col("least") < F.col("_most")).select("key", "least")
    members = checkpointed(spread_join(banded, shared, "key").filter(F.col("doc") != F.col("least")).distinct())

    pairs = members.select(F.col("least").alias("a"), F.col("doc").alias("b")).distinct()
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = checkpointed_lean(rows_of(docs, involved).mapInArrow(_sets, "doc long, found binary"))
    links = checkpointed_lean(_confirm(pairs, sets))
    parts = components(links)

    sizes = sets.groupBy("doc").agg(F.max(F.octet_length("found") / 8).cast("long").alias("size"))
    blocks = checkpointed(_unresolved(members, parts, sizes))
    if not blocks.isEmpty():
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        paired = blocks.withColumn("_other", other).select(
            "key",
            F.least("block", "_other").alias("one"),
            F.greatest("block", "_other").alias("two"),
            "doc",
            "component",
            "block",
        )
        held = spread_join(paired, sets, "doc")
        more = held.groupBy("key", "one", "two").applyInArrow(_block_links, "a long, b long")
        # What was connected is one star per component by now: few rounds remain.
        known = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        parts = components(checkpointed_lean(known.unionByName(more)))

    named = spread_join(classes.select("digest", "doc"), parts.withColumnRenamed("node", "doc"), "doc", "left")
    named = named.select("digest", F.coalesce("component", "doc").alias("component_id"))
    # The digest as text with a prefix: both join inputs are plain shuffles.
    image = F.concat(F.lit("="), F.hex("digest"))
    lone = F.concat(F.lit("!"), F.xxhash64("doc_id").cast("string"))
    can_link = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    left = signed.select("doc_id", "n_shingles", F.when(can_link, image).otherwise(lone).alias("_image"))
    right = named.select(image.alias("_image"), "component_id")
    return left.join(right, "_image", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(False)).alias("kept"),
    )
