"""A Merkle manifest of a table, and the versions that altered rows lead to (operator 13).

Rows are leaves. Per group, leaves in order form a tree in which every three
neighbouring nodes become one; the groups' roots form one more such tree. A
tree is cut into aligned blocks of ``BLOCK_LEVELS`` levels. One task builds a block and
hands its root up, where the roots are leaves of the next, much smaller level
of blocks, until one is left.

The tree is persistent. An altered leaf makes a version of its own that shares
every node but the leaf's ancestors: these alone are copied, first inside the
block, then along the block's own path through the upper levels. Paths come
down from block to block, so that no task holds more than one block of nodes.

Places come from a range partition and one count per partition and group, so no
group is ever ordered in one task. Equal rows are one row with a number until
blocks are built, so that copies can't fill a partition either.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, ship

ARITY = 3
BLOCK_LEVELS = 6  # a block has 729 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "grp string, block long, start long, n long, total long, digest binary, doc_id long, changed binary, name string, path binary, subroot binary"
_NAMES = [part.split()[0] for part in _NODE.split(", ")]
# What every level passes up, and what it passes down.
_ROOT = "grp string, rank long, total long, digest binary"
_PATH = "grp string, rank long, name string, path binary, subroot binary"
_LEAF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, n_copied int"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Tree:
    """One block: its nodes level by level, digests as hex text.

    With ``levels`` it has as many above its leaves, a lone node counting as a
    run of one; without, it ends at its first lone node.
    """

    def __init__(self, leaves: list[str], levels: int | None = None):
        self.levels = [leaves]
        while len(self.levels) <= levels if levels is not None else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([digest("".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def beside(self, level: int, k: int) -> tuple[str, str]:
        """The siblings of a node to its left and to its right."""
        nodes, first = self.levels[level], k - k % ARITY
        return "".join(nodes[first:k]), "".join(nodes[k + 1 : first + ARITY])

    def path(self, k: int) -> list[tuple[str, str]]:
        """Siblings on the way from leaf ``k`` to the root."""
        return [self.beside(level, k // ARITY**level) for level in range(len(self.levels) - 1)]

    def version(self, k: int, changed: str) -> list[str]:
        """Copies of the ancestors of leaf ``k`` once it is ``changed``; all other nodes are shared."""
        return folded(changed, self.path(k))

    def proofs(self) -> list[str]:
        """For every leaf its siblings' digests, from the leaf up. Made from the top, each part once."""
        below = [""]
        for level in range(len(self.levels) - 2, -1, -1):
            below = ["".join(self.beside(level, k)) + below[k // ARITY] for k in range(len(self.levels[level]))]
        return below


def folded(leaf: str, path: list[tuple[str, str]]) -> list[str]:
    """The nodes that ``leaf`` leads to along ``path``, the last being the root."""
    out = []
    for left, right in path:
        leaf = digest(left + leaf + right)
        out.append(leaf)
    return out


def packed(path: list[tuple[str, str]]) -> bytes:
    """A path as bytes: per level the numbers of siblings on either side, then their digests."""
    return b"".join(bytes((len(a) // 64, len(b) // 64)) + bytes.fromhex(a + b) for a, b in path)


def unpacked(data: bytes) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(data):
        left, right = data[at], data[at + 1]
        both = data[at + 2 : at + 2 + 32 * (left + right)].hex()
        out.append((both[: 64 * left], both[64 * left :]))
        at += 2 + 32 * (left + right)
    return out


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with its number and their place among their group's rows there."""
    part, group, place = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        within = []
        for own, n in zip(batch.column("grp").to_pylist(), batch.column("n").to_pylist()):
            if own != group:
                group, place = own, 0
            within.append(place)
            place += n
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(within), pa.int32()), pa.array(within, pa.int64())], [*batch.schema.names, "part", "within"]
        )


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows(grp, n, ...)`` with ``rank``, the place of a row's first copy in its group, and the group's ``total``."""
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    dealt = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    dealt = checkpointed(dealt.mapInArrow(_numbered, f"{kinds}, part int, within long"))
    counts = dealt.groupBy("grp", "part").agg(F.sum("n").alias("own"))
    # One row per partition and group: a group has no more of them than partitions.
    group = Window.partitionBy("grp")
    before = F.sum("own").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("grp", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("own").over(group).alias("total"))
    placed = dealt.join(offsets, ["grp", "part"])
    return placed.withColumn("rank", F.col("before") + F.col("within")).drop("part", "within", "before")


def _in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Nodes by block, in order. A row that stands for copies is split where a block ends."""
    last = F.col("rank") + F.col("n") - 1
    block = F.col("block")
    spread = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("rank") / size), F.floor(last / size))))
    start = F.greatest(F.col("rank"), block * size)
    stop = F.least(last + 1, (block + 1) * size)
    spread = spread.select("*", start.alias("start"), (stop - start).alias("some")).drop("n").withColumnRenamed("some", "n")
    absent = {"doc_id": "long", "changed": "binary", "name": "string", "path": "binary", "subroot": "binary"}
    return spread.select(*[F.lit(None).cast(absent[c]).alias(c) if c not in spread.columns else F.col(c) for c in _NAMES])


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "start")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[tuple]]]:
    """Rows of one block after the other."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in _NAMES)):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield key, held


def _tree(rows: list[tuple], height: int) -> Tree:
    leaves = [row[5].hex() for row in rows for _ in range(row[3])]
    return Tree(leaves, height if rows[0][4] > ARITY**height else None)


def _table(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in kinds.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


_FLUSH = 10_000


def _up(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """The root of each block."""
    out = []
    for (group, block), rows in _runs(batches):
        total = -(-rows[0][4] // ARITY**height)
        out.append((group, block, total, bytes.fromhex(_tree(rows, height).root)))
        if len(out) >= _FLUSH:
            yield _table(out, _ROOT)
            out = []
    yield _table(out, _ROOT)


def _placed(rows: list[tuple], height: int) -> tuple[bytes, bytes | None, list[tuple], Tree]:
    """A block's own path and subroot, which stand before its nodes; the nodes; their tree."""
    above, nodes = rows[0], rows[1:]
    assert above[2] < 0 and nodes and nodes[0][2] >= 0, "a block has one path"
    return above[9], above[10], nodes, _tree(nodes, height)


def _down(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """The path of each node of a block: inside the block, then the block's own."""
    out = []
    for (group, _), rows in _runs(batches):
        path, subroot, nodes, tree = _placed(rows, height)
        for k, node in enumerate(nodes):  # above the leaves a row is one node
            out.append((group, node[2], node[8], packed(tree.path(k)) + path, subroot))
        if len(out) >= _FLUSH:
            yield _table(out, _PATH)
            out = []
    yield _table(out, _PATH)


def _leaves(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """Every leaf's proof, and the root of the version that an altered leaf makes."""
    out = []
    for _, rows in _runs(batches):
        path, subroot, nodes, tree = _placed(rows, height)
        above = unpacked(path)
        beyond, proofs, k = "".join(a + b for a, b in above), tree.proofs(), 0
        for _, _, _, n, _, leaf, doc_id, changed, *_ in nodes:
            for _ in range(n):
                copies: list[str] = []
                if changed is not None:
                    copies = tree.version(k, changed.hex())
                    copies += folded(copies[-1] if copies else changed.hex(), above)
                end = copies[-1] if copies else changed.hex() if changed is not None else None
                out.append((doc_id, leaf.hex(), subroot.hex(), digest(proofs[k] + beyond), end, len(copies)))
                k += 1
                if len(out) >= _FLUSH:
                    yield _table(out, _LEAF)
                    out = []
    yield _table(out, _LEAF)


def _built(rows: DataFrame, height: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Blocks of each level from the leaves up, and the roots of the groups that end there."""
    levels, ended = [], []
    while True:
        levels.append(checkpointed(_by_block(_in_blocks(rows, ARITY**height))))
        roots = checkpointed(levels[-1].mapInArrow(partial(_up, height=height), _ROOT))
        ended.append(roots.filter("total = 1"))
        rest = roots.filter("total > 1")
        if rest.isEmpty():
            return levels, ended
        rows = rest.withColumn("n", F.lit(1).cast("long"))


def _as_nodes(paths: DataFrame) -> DataFrame:
    """Paths as the first rows of the blocks they belong to."""
    cells = {"block": F.col("rank"), "start": F.lit(-1).cast("long"), "n": F.lit(0).cast("long"), "total": F.lit(0).cast("long")}
    cells |= {"digest": F.lit(None).cast("binary"), "doc_id": F.lit(None).cast("long"), "changed": F.lit(None).cast("binary")}
    return paths.select(*[cells[c].alias(c) if c in cells else F.col(c) for c in _NAMES])


def _paths(levels: list[DataFrame], tops: list[DataFrame], height: int) -> DataFrame:
    """Blocks of leaves, each behind its path. ``tops`` has the path of each group's root, by level."""
    handed: list[DataFrame] = []
    for at in range(len(levels) - 1, -1, -1):
        given = reduce(DataFrame.unionByName, [_as_nodes(p) for p in [tops[at], *handed]])
        joined = _by_block(levels[at].unionByName(given))
        if at == 0:
            return joined
        handed = [joined.mapInArrow(partial(_down, height=height), _PATH)]
    raise AssertionError("there is always a level of leaves")


def manifest(docs: DataFrame, tampered: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_copied`` for every row.

    A leaf is made of ``FIELDS``. Groups are sources, a NULL one first; a group's
    leaves ascend by doc_id (NULL first), then by digest. ``proof_sha256`` is the
    digest of the leaf's siblings, from its run up to the root.

    ``tampered`` is the text that a row has been found with, NULL included; rows
    for which it equals ``text`` are sound. ``folded_root`` is the root of the
    version that the text found leads to, ``verified`` whether it is the root.
    ``n_copied`` counts the nodes that this version does not share. The height of
    a block, ``block_levels``, changes nothing of this.

    NULLs in any column are values. Equal rows are leaves side by side, each with
    its own proof. An empty table gives no rows. Other columns play no part.
    """
    ship(docs.sparkSession)
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang")],
        F.col("n_chars").cast("long").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
        (F.col("text") if tampered is None else tampered).cast("string").alias("_found"),
    )
    found = [F.col("_found") if c == "text" else F.col(c) for c in FIELDS]
    # A NULL source sorts before every other, and joins like any.
    group = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    leaves = named.select(
        group.alias("grp"),
        "doc_id",
        _leaf([F.col(c) for c in FIELDS]).alias("digest"),
        F.when(~F.col("text").eqNullSafe(F.col("_found")), _leaf(found)).alias("changed"),
    )
    leaves = leaves.groupBy("grp", "doc_id", "digest", "changed").agg(F.count(F.lit(1)).alias("n"))
    levels, ended = _built(ranked(leaves, "doc_id", "digest", "changed"), block_levels)
    subroots = reduce(DataFrame.unionByName, ended).select("grp", "digest")
    above = subroots.select(F.lit("").alias("grp"), F.lit(1).cast("long").alias("n"), "digest", F.col("grp").alias("name"))
    top_levels, top_ended = _built(ranked(above, "name"), block_levels)
    last = reduce(DataFrame.unionByName, top_ended).select("digest").first()  # the one root
    root = bytes(last["digest"]).hex() if last else None
    start = docs.sparkSession.createDataFrame([("", 0, None, b"", b"")], _PATH)
    none = start.filter(F.lit(False))
    of_groups = _paths(top_levels, [none] * (len(top_levels) - 1) + [start if last else none], block_levels)
    of_groups = checkpointed(of_groups.mapInArrow(partial(_down, height=block_levels), _PATH))
    of_groups = of_groups.select(F.col("name").alias("grp"), "path")
    tops = [
        e.join(of_groups, "grp").select("grp", F.lit(0).cast("long").alias("rank"), F.lit(None).cast("string").alias("name"), "path", F.col("digest").alias("subroot"))
        for e in ended
    ]
    done = _paths(levels, tops, block_levels).mapInArrow(partial(_leaves, height=block_levels), _LEAF)
    end = F.coalesce("folded_root", F.lit(root))
    return done.select(
        "doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", end.alias("folded_root"), (end == F.lit(root)).alias("verified"), "n_copied"
    )


def without_breaks() -> Column:
    """The text without line breaks where 2 divides the checksum of doc_id; elsewhere the text."""
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    return F.when(F.coalesce(even, F.lit(False)), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
