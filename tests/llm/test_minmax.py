"""Min-max near duplicates against a comparison of all pairs."""

import random

import pytest

from folioaudit.llm import minmax
from folioaudit.llm.components import components


def brute(rows):
    """Component and set size per row by comparing every two sets of shingles."""

    def found(text):
        words = (text or "").encode().lower().split()
        if not words:
            return frozenset()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))

    sets = [found(t) for _, t in rows]
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, _) in enumerate(rows):
        for m in range(n):
            a, b = sets[n], sets[m]
            if i is not None and rows[m][0] is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(rows[m][0])))
                root[y] = x
    return sorted(
        ((i, len(s), None if i is None else top(i), i is not None and top(i) == i) for (i, _), s in zip(rows, sets)),
        key=str,
    )


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4)))
    shared = " ".join(word() for _ in range(30))
    rows, n = [], 0
    for size in (1, 3, 4, 5, 8, 40, 200):
        base = [word() for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rnd.choice((0, 0, 1, 2, 4))):
                copy[rnd.randrange(size)] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + k, shared + " " + " ".join(word() for _ in range(k))) for k in range(60)]
    rnd.shuffle(rows)
    return rows


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in minmax.near_duplicates(df).collect()), key=str)


@pytest.mark.parametrize("block", [3, 128])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minmax, "BLOCK", block)
    rows = corpus(block)
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    long = "x y z w v u " * 3000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (6, "a b c"), (None, "a b"), (7, long), (8, long + "q")]
    rows += [(9, "Été"), (10, "été"), (4, "A b")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 7, "k"), (2, "a b c d e f", 8, "q")], "doc_id int, text string, component_id int, key string")
    assert sorted(tuple(r) for r in minmax.near_duplicates(df).collect()) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_forest_spans_without_repeats():
    import numpy as np

    base = np.arange(100, dtype=np.uint64)
    found = [base[k : k + 90] for k in range(10)]
    links = minmax.forest(list(range(10)), list(range(10)), [0] * 10, found)
    assert len(links) == 9


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 140))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_second_search_starts_from_the_components_found(spark, monkeypatch):
    """Links that were followed once are not followed again, chain by chain."""
    seen = []

    def recorded(edges):
        seen.append({tuple(r) for r in edges.collect()})
        return components(edges)

    monkeypatch.setattr(minmax, "components", recorded)
    rows = corpus(3)
    assert result(spark, rows) == brute(rows)
    first, second = seen
    stars = {tuple(r) for r in components(spark.createDataFrame(list(first), "a long, b long")).collect()}
    assert stars <= second
