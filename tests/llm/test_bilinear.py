"""The language model: exact counts, exact normalisation, gradients, and held-out scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folioaudit.llm import bilinear as B
from folioaudit.llm import queries as Q
from folioaudit.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    """doc_id, held_out, n_tokens, n_known, N and base score of each row."""
    counts, ends = Counter(), 0
    for i, t in rows:
        if not is_held_out(i):
            counts.update(words_of(t))
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for i, t in rows:
        own = [counts[w] for w in words_of(t)] + [ends]
        out.append((i, is_held_out(i), len(own), sum(c > 0 for c in own), total, sum(math.log10((c + 1) / (total + types + 1)) for c in own)))
    return out


def compare(got, rows):
    order = lambda r: (str(r[0]), r[2], r[5])
    found, want = sorted((tuple(r)[:6] for r in got), key=order), sorted(brute(rows), key=order)
    assert len(found) == len(want)
    for a, b in zip(found, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


@pytest.mark.parametrize("head_words", [B.HEAD_WORDS, 300, 0])
def test_query_against_brute_force(spark, sf_dir, head_words):
    """Whatever words executors hold, the rest is joined; held-out texts are predicted better than by counts."""
    docs = table(spark, sf_dir, "documents")
    if head_words == B.HEAD_WORDS:
        result = Q.op11_log_bilinear(spark, sf_dir)
        assert result.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    else:
        model = B.train(docs.filter(~B.held_out()), head_words=head_words)
        result = B.scored(docs, model, B.held_out())
    got = result.collect()
    compare(got, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    if head_words == B.HEAD_WORDS:
        held = [r for r in got if r["held_out"]]
        assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_equal_a_plain_model(spark):
    """Each token's probability worked out on its own, over all classes and words."""
    texts = ["the cat sat on the mat", "The dog\nsat on a log", "a cat and a dog", None, "", "unseen words here the cat", "the " * 50]
    rows = [(i, t) for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = B.train(docs.filter(~B.held_out()), head_words=6)
    v, net = model.vocabulary, model.network
    counts = {bytes(r["word"]): r["c"] for r in model.counts.collect()}
    rest = sum(c + 1 for w, c in counts.items() if w not in v.index) + 1
    assert rest == v.rest and 0 < len(v.index) <= 6

    def log_prob(before, word):
        hidden = net.position[0] * net.context[before[0]] + net.position[1] * net.context[before[1]]
        scores = (net.target @ hidden + net.bias).astype(float)
        logs = scores - np.log(np.exp(scores).sum())
        if word is None:
            return logs[B.END], B.END
        k = v.index.get(word.encode())
        cls = v.other if k is None else int(v.classes[k])
        mates = [n for n, c in enumerate(v.classes[:-2]) if c == cls]
        share = (counts.get(word.encode(), 0) + 1) / (rest if k is None else sum(v.counts[m] + 1 for m in mates))
        return logs[cls] + math.log(share), cls

    for r in B.scored(docs, model).collect():
        before, total = (B.END, B.END), 0.0
        for word in [*words_of(texts[r["doc_id"] % len(texts)]), None]:
            log, cls = log_prob(before, word)
            total, before = total + log / math.log(10), (before[1], cls)
        assert r["score"] == pytest.approx(total, rel=1e-5)
    for before in ((0, 0), (1, 2), (v.other, 1)):
        every = [*[w.decode() for w in v.index], *[w.decode() for w in counts if w not in v.index], "never seen", None]
        assert sum(math.exp(log_prob(before, w)[0]) for w in every) == pytest.approx(1, abs=1e-5)


def test_gradient_equals_differences():
    random = np.random.default_rng(3)
    net = B.Network.fresh(np.array([5.0, 9, 4, 2, 7]))
    net = B.Network(*(a.astype(np.float64) + random.normal(0, 0.3, a.shape) for a in net.arrays()))
    first, last, classes, noise = (random.integers(0, 5, n) for n in (40, 40, 40, 6))
    log_noise = np.log(6 * B.noise_of(np.array([5.0, 9, 4, 2, 7])))
    found = B.gradient(net, log_noise, first, last, classes, noise)
    for array, slope in zip(net.arrays(), found):
        for _ in range(12):
            at = tuple(random.integers(0, n) for n in array.shape)
            old, ends = array[at], []
            for step in (1e-5, -1e-5):
                array[at] = old + step
                ends.append(B.objective(net, log_noise, first, last, classes, noise))
            array[at] = old
            assert slope[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-5)


def test_long_texts_are_scored_in_parts(monkeypatch):
    """Cut anywhere between words, a text has the same tokens and contexts."""
    words = [f"w{k % 37}" for k in range(5000)]
    v = B.vocabulary_of([(f"w{k}".encode(), 100 - k) for k in range(30)], 4, 10, 3, singles=8, groups=3)
    whole = list(B.groups(iter([" ".join(words).encode(), None]), v))
    monkeypatch.setattr(B, "CHUNK_BYTES", 100)
    monkeypatch.setattr(B, "GROUP_WORDS", 64)
    others = {}
    parts = list(B.groups(iter(["\n".join(words).encode(), None]), v, others))
    assert len(whole) == 1 < len(parts)
    for name in ("owners", "first", "last", "classes", "words"):
        assert np.array_equal(getattr(whole[0], name), np.concatenate([getattr(p, name) for p in parts]))
    assert others == {0: Counter(w.encode() for w in words if int(w[1:]) >= 30)}
    assert int(v.classes.max()) == v.other == 12 and len(set(v.classes.tolist())) == 13


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "ÀÉ Ab\x0bAB\x1f x"), (3, "ÀÉ Ab\x0bAB\x1f x"), (None, "no id"), (4, "y" * 200_000), (5, "z " * 100_000), (6, " \n\t ")] + [(k, "same text") for k in range(100, 160)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as word", "2 as n", "3 as `row`", "'q' as c").repartition(5)
    compare(B.scores_of(df).collect(), rows)
    assert B.scores_of(spark.createDataFrame([], SCHEMA)).collect() == []
    only = next(k for k in range(100) if is_held_out(k))
    got = B.scores_of(spark.createDataFrame([(only, "nothing learned")], SCHEMA)).collect()
    assert [tuple(r)[:6] for r in got] == [(only, True, 3, 0, 0, 0.0)] and math.isfinite(got[0]["score"])
