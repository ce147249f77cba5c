"""Tokens against the tokenizer itself, packings against their rules and bounds."""

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioaudit.llm import packing as P
from folioaudit.llm.tokens import WordIds

TEXT = P.default_tokenizer()
WORDS = WordIds(TEXT)


def whole(text):
    return WORDS.full.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcÉéßſKİΣσ'’s .,!|-_09\n\t\x1c\x85\xa0éñÑ<|>你"), st.characters(exclude_categories=["Cs"]))))
def test_ids_equal_the_tokenizers(text):
    assert next(WORDS.encode([text.encode()])).tolist() == whole(text)


def test_ids_of_real_texts(spark, sf_dir):
    rows = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    got = list(WORDS.encode([t.encode() for t in rows]))
    assert [g.tolist() for g in got] == [whole(t) for t in rows]
    assert whole("a<|endoftext|>b") == next(WORDS.encode([b"a<|endoftext|>b"])).tolist()


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r.asDict() for r in P.pack(df).collect()]
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    want = []
    for doc, text in rows:
        ids = np.array([*whole(text or ""), 0], "<u4")
        for n, start in enumerate(range(0, len(ids), P.CAPACITY)):
            part = ids[start : start + P.CAPACITY]
            want.append((doc, n, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    return bins, [w[3] for w in want]


@pytest.mark.parametrize("size", [30, 50_000])
def test_packing_is_whole_and_tight(spark, monkeypatch, size):
    monkeypatch.setattr(P, "PARTITION_PIECES", size)
    rnd = random.Random(4)
    rows = [(i, "alpha beta " * rnd.randint(0, 1300)) for i in range(150)]
    bins, sizes = check(spark, rows)
    bound = P.lower_bound(np.array(sizes))
    assert bound <= len(bins) <= bound + 1 + bound // (20 if size == 30 else 50)


def test_edges(spark):
    bins, _ = check(spark, [(1, None), (2, ""), (3, "a " * 2047), (4, "a " * 2048), (5, "b " * 9000), (5, "b"), (5, "b"), (None, "c"), (None, None)])
    assert bins
    assert check(spark, [])[0] == {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, P.CAPACITY), min_size=1, max_size=6))
def test_bound_holds_for_best_packing(sizes):
    def fits(order):
        bins, room = 0, 0
        for s in order:
            if s > room:
                bins, room = bins + 1, P.CAPACITY
            room -= s
        return bins

    best = min(map(fits, itertools.permutations(sizes)))
    used = len(P.best_fit_decreasing(np.array(sizes))[2])
    assert P.lower_bound(np.array(sizes)) <= best <= used


def test_bound_beats_the_sum():
    assert P.lower_bound(np.full(10, 1025)) == 10
    assert P.lower_bound(np.full(9, 700)) == 5
