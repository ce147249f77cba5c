"""Base statistics against plain counting; verdicts on planted lines."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from folioaudit.llm import rules as R

SPACES = "[ \t-\r]"
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    words = re.findall("[^ \t-\r]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    inside = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(8)}
    n, symbols = len(words), sum(c in "#*$%&|<>" for c in text or "")
    base = n < 20 or 100 * len(inside) > 30 * n
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)), base


def result(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in R.judged(df, "doc_id").collect()}


def test_statistics_equal_plain_counting(spark):
    texts = []

    @settings(max_examples=150, deadline=None, database=None)
    @given(st.lists(st.sampled_from(["a", "b", "é", "你|", "x.", "\n", " ", "\t", "\x0b", "\x1c", "\xa0", "##", "a b c d e f g h "]), max_size=60))
    def gather(parts):
        texts.append("".join(parts))

    gather()
    texts += [None, "", " ", "w " * 20_000, "a b c d e f g h " * 3, "\n".join(["same line"] * 50), "x" * 100_000]
    got = result(spark, texts)
    for k, text in enumerate(texts):
        counts, base = plain(text)
        assert tuple(got[k][n] for n in NAMES) == counts, repr(text)
        assert got[k]["base_failed"] == base and not (base and got[k]["kept"])


def test_lines_are_judged_first(spark):
    prose = " ".join(f"word{k}" for k in range(30)) + "."
    failing = ["Home | About | Contact.", "no end here", "Menu", "All rights reserved.", "BUY!! NOW!! HERE!! TODAY.", "a# b# c# d#."]
    got = result(spark, [prose, *(f"{prose}\n{x}" for x in failing), "\n".join(" ".join(f"w{n}x{k}" for n in range(30)) for k in range(3)) + "\nAn end."])
    assert got[0]["kept"] and got[0]["lost_words"] == 0 and got[0]["clean_text"] == prose
    for k, line in enumerate(failing, 1):
        assert got[k]["clean_text"] == prose and got[k]["lost_words"] == len(line.split()) and got[k]["kept"]
    last = got[len(failing) + 1]
    assert not last["base_failed"] and not last["kept"] and last["clean_text"] == "An end."


def test_rows_columns_and_plan(spark):
    df = spark.createDataFrame([(1, "a", 3, "z")] * 2 + [(None, "b", 4, "z")], "doc_id int, text string, n_words int, _lines string")
    out = R.judged(df, "doc_id")
    assert out.count() == 3 and R.judged(df.limit(0), "doc_id").count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_verdicts_follow_labels(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{root}/{n}.parquet") for n in ("documents", "labels"))
    both = R.judged(docs, "doc_id").select("doc_id", "base_failed", "kept").toPandas().merge(labels.toPandas(), on="doc_id")
    good = both[(both.quality == 1) & ~both.base_failed]
    assert good.kept.mean() > 0.99 and both[both.quality == 0].kept.mean() < 0.1


def test_hostile_texts_take_seconds(spark):
    """A megabyte of each form in one line."""
    import time

    forms = ["!", "!!a", "a-", "a.", "a", "1-", "|a", "'", ". ", "copyright ", "#", "log in"]
    df = spark.createDataFrame([(k, f * (1_000_000 // len(f))) for k, f in enumerate(forms)], "doc_id long, text string").repartition(8)
    began = time.perf_counter()
    assert len(R.judged(df, "doc_id").drop("clean_text").collect()) == len(forms)
    assert time.perf_counter() - began < 60
