"""The manifest against a plain tree over all rows at once."""

import zlib
from hashlib import sha256

import pytest

from folioaudit.llm import merkle as M
from folioaudit.llm import queries as Q
from folioaudit.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """All levels of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, k):
    out = []
    for nodes in levels[:-1]:
        first = k - k % 3
        out.append((nodes[first:k], nodes[k + 1 : first + 3]))
        k //= 3
    return out


def fold(node, path):
    for left, right in path:
        node = h(*left, node, *right)
    return node


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(by_source[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[source] = own, climb([leaf(r, r["text"]) for r in own])
    top = climb([trees[s][1][-1][0] for s in order]) if order else [[None]]
    root, out = top[-1][0], []
    for at, source in enumerate(order):
        own, levels = trees[source]
        for k, row in enumerate(own):
            path = siblings(levels, k) + siblings(top, at)
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            end = fold(leaf(row, text), path)
            proof = h(*[d for left, right in path for d in left + right])
            out.append((row["doc_id"], levels[0][k], levels[-1][0], root, proof, end, end == root))
    return sorted(out, key=str)


def run(df, *block_levels):
    got = M.manifest(df, M.without_breaks(), *block_levels)
    return sorted((tuple(r)[:7] for r in got.collect()), key=str)


def test_query_equals_one_tree(spark, sf_dir):
    rows = [r.asDict() for r in table(spark, sf_dir, "documents").collect()]
    got = Q.op13_persistent_manifest(spark, sf_dir)
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted((tuple(r)[:7] for r in got.collect()), key=str)
    assert found == brute(rows)
    assert {r[6] for r in found} == {True, False}


@pytest.mark.parametrize("size", [1, 4, 28, 100])
def test_blocks_of_any_size(spark, size):
    """Trees of one to five levels of blocks of three leaves, also with a last block of one."""
    rows = [(i, f"a\n{i}", "en", "s" if i % 4 else None, i) for i in range(size)] + [(7, "one", "en", f"t{k}", 1) for k in range(size % 5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert run(df, 1) == brute([r.asDict() for r in df.collect()])


def test_nulls_copies_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (None, "a\nb", "en", "s", 3), (1, None, "en", "s", 0), (2, "", "", "", 0),
        (4, "é\n" * 50_000, "fr", "s", 100_000), (6, "x\ny", "en", None, None), (8, "\n", "en", "ü", 1), (8, "other", "en", "ü", 5),
    ] + [(10, "same\ntext", "en", "s", 9)] * 2500 + [(12, "same\ntext", "en", "hot", 9)] * 800
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute([r.asDict() for r in df.collect()])
    assert run(df.repartition(5)) == want
    clash = df.selectExpr("*", "1 as grp", "2 as rank", "3 as digest", "4 as _found", "5 as n")
    assert run(clash) == want


def test_empty_and_untampered(spark):
    assert M.manifest(spark.createDataFrame([], SCHEMA), M.without_breaks()).collect() == []
    one = M.manifest(spark.createDataFrame([(1, "a\n", "en", "s", 2)], SCHEMA)).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"] and one["n_copied"] == 0
    assert one["proof_sha256"] == sha256(b"").hexdigest()


def test_a_version_shares_all_other_nodes():
    """A version holds copies of the ancestors only; with them in place of the old nodes the tree is right."""
    leaves = [h(str(k)) for k in range(20)]
    tree, new = M.Tree(leaves), h("new")
    for k in range(20):
        copies = tree.version(k, new)
        rebuilt = M.Tree(leaves[:k] + [new] + leaves[k + 1 :])
        for level, nodes in enumerate(rebuilt.levels):
            old = list(tree.levels[level])
            old[k // 3**level] = new if level == 0 else copies[level - 1]
            assert old == nodes
        assert tree.levels == M.Tree(leaves).levels
        assert M.unpacked(M.packed(tree.path(k))) == tree.path(k)
