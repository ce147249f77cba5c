"""Repeated runs of more than 50 words against a search that tries every place."""

import random

from folioaudit.llm import linededup as D
from folioaudit.llm import passages as P
from folioaudit.llm.common import table
from folioaudit.llm.queries import op6_winnowed_lines

SIZE = 51


def later_words(rows, cut={}):  # noqa: B006
    """Per (doc_id, text) the word places that an earlier run of SIZE words makes superfluous.

    Runs that lie altogether in the places that ``cut`` has do not count.
    """
    first, gone = {}, {}
    for i, t in sorted({(i, t) for i, t in rows if i is not None and t is not None}, key=lambda r: r[0]):
        words = t.encode().split()
        gone[i, t] = set()
        for k in range(len(words) - SIZE + 1):
            if set(range(k, k + SIZE)) <= cut.get(i, set()):
                continue
            j, m = first.setdefault(tuple(words[k : k + SIZE]), (i, k))
            if (j, m) != (i, k):
                gone[i, t] |= set(range(max(k, m + SIZE) if j == i else k, k + SIZE))
    return gone


def left(rows):
    gone = later_words(rows)
    return sorted(((i, t if t is None else [w for k, w in enumerate(t.split()) if k not in gone.get((i, t), ())]) for i, t in rows), key=str)


def result(spark, rows, how=D.without_passages):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return [tuple(r) for r in how(df, "doc_id").collect()]


def as_words(got):
    return sorted(((i, t if t is None else t.split()) for i, t, _ in got), key=str)


def broken(words, rnd, least, most):
    """The words in lines of ``least`` to ``most`` words."""
    out = []
    while words:
        n = rnd.randint(least, most)
        out.append(" ".join(words[:n]))
        words = words[n:]
    return "\n".join(out)


def test_equals_search_of_every_place(spark):
    rnd = random.Random(8)
    some = lambda n: [str(rnd.randint(0, 400)) for _ in range(n)]
    shared = [some(n) for n in (50, 51, 52, 57, 80, 200)]
    rows = []
    for i in range(90):
        words = []
        for p in rnd.sample(shared, rnd.randint(0, 3)):
            cut = rnd.choice([0, 0, 1, 20])
            words += some(rnd.randint(0, 40)) + p[cut:]
        rows.append((i, broken(words + some(rnd.randint(0, 30)), rnd, 1, 40)))
    rows += [(200, "one\n" * 300), (201, "one " * 70), (202, "a b c " * 60), rows[3], (None, rows[4][1]), (300, None), (301, "")]
    got = result(spark, rows)
    assert as_words(got) == left(rows)
    assert sum(n for _, _, n in got) > 100


def test_run_inside_lines_goes(spark):
    words = [f"w{k}" for k in range(54)]
    rows = [(1, "start of a " + " ".join(words) + " and its end"), (2, "keep\nother head " + " ".join(words[:30]) + "\n" + " ".join(words[30:]) + " other tail\n")]
    got = {i: (t, n) for i, t, n in result(spark, rows, D.without_repeated_text)}
    assert got[1] == (rows[0][1], 0)
    assert got[2] == ("keep\nother head\nother tail\n", 2)


def test_whole_job_on_documents(spark, sf_dir):
    """Line runs and passages go; no line run is spared for a passage."""
    docs = table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    runs = {}
    for r in D.repeated_runs(docs).collect():
        runs.setdefault(r["doc"], []).append((r["start"], r["end"]))
    cut = {}
    for i, t in rows:
        gone, at, line = set(), 0, 0
        for words in filter(None, (x.encode().split() for x in (t or "").split("\n"))):
            if any(a <= line < b for a, b in runs.get(i, ())):
                gone |= set(range(at, at + len(words)))
            at, line = at + len(words), line + 1
        cut[i] = gone
    passages = later_words(rows, cut)
    assert any(passages[r] - cut[r[0]] for r in passages)
    gone = {(i, t): passages.get((i, t), set()) | cut[i] for i, t in rows}
    want = [(i, t if t is None else [w.decode() for k, w in enumerate(t.encode().split()) if k not in gone[i, t]]) for i, t in rows]
    got = [(r["doc_id"], r["text"] if r["text"] is None else [w.decode() for w in r["text"].encode().split()]) for r in op6_winnowed_lines(spark, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_chunks_agree():
    """Equal windows of one chunk, and of two, name the same later places."""
    words = [f"v{k}" for k in range(60)]
    texts = ["x " + " ".join(words), "y z " + " ".join(words)]
    chunk = []
    for i, text in enumerate(texts):
        words, sizes = P.words_of([text])
        at = P.windows_at(len(words), P.fingerprints(words, sizes)[1])
        chunk.append((i, 7, at, P.run_hashes(words, P.PASSAGE)[at]))
    rows = P._compared(chunk).to_pylist()
    sure = [r for r in rows if r["sure"]]
    assert [(r["doc"], r["start"], r["end"]) for r in sure] == [(1, 2, 62)]
    assert {r["window"] for r in rows if r["doc"] == 1 and not r["sure"]}.isdisjoint(r["window"] for r in rows if r["doc"] == 0)


def test_passages_in_short_lines(spark):
    """Line grams alone miss many of these: only two or three of them lie in the run."""
    rnd = random.Random(4)
    some = lambda n: [str(rnd.random()) for _ in range(n)]
    rows, want = [], []
    for k in range(60):
        shared = broken(some(rnd.randint(51, 76)), rnd, 12, 19)
        for i in (2 * k, 2 * k + 1):
            head, tail = (broken(some(60), rnd, 12, 19) for _ in range(2))
            rows.append((i, f"{head}\n{shared}\n{tail}"))
            want.append((i, f"{head}\n{tail}" if i % 2 else rows[-1][1]))
    assert sorted((i, t) for i, t, _ in result(spark, rows, D.without_repeated_text)) == want


def test_longer_run_with_another_than_the_first_document(spark):
    p, q = (" ".join(f"{x}{k}" for k in range(n)) for x, n in (("p1x", 79), ("q1x", 8)))
    rows = [(1, f"one\n{p}\ntwo"), (2, f"three\n{q}\nq\n{p}\nfour"), (3, f"five\n{q}\nq\n{p}\nsix")]
    got = {i: t for i, t, _ in result(spark, rows, D.without_repeated_text)}
    assert got == {1: rows[0][1], 2: f"three\n{q}\nq\nfour", 3: "five\nsix"}


def test_other_texts_of_one_id(spark):
    """Chunks of one text each: the texts of an id, and their copies, meet only after the shuffle."""
    rnd = random.Random(6)
    some = lambda n: [str(rnd.randint(0, 10**6)) for _ in range(n)]
    shared = [some(n) for n in (51, 60, 90)]
    rows = [(rnd.choice([3, 3, 3, 4, 5]), " ".join(some(9) + shared[0] + some(5) + rnd.choice(shared) + some(3))) for _ in range(24)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(29)
    got = sorted((i, t.split()) for i, t, _ in D.without_passages(df, "doc_id").collect())
    digests = {r["text"]: r["d"] for r in df.selectExpr("text", "xxhash64(text) d").collect()}
    place = {row: k for k, row in enumerate(sorted(set(rows), key=lambda r: (r[0], digests[r[1]])))}
    gone = later_words([(k, t) for (_, t), k in place.items()])
    assert got == sorted((i, [w for k, w in enumerate(t.split()) if k not in gone[place[i, t], t]]) for i, t in rows)
    assert sum(map(len, gone.values())) > 1000


def test_texts_of_one_id_in_several_chunks(spark):
    """A window of two texts of one id goes from that of the greater digest; other ids are compared elsewhere."""
    rows = [(3, 10, 0, 77), (3, 20, 5, 77), (3, 20, 6, 78), (4, 5, 1, 77), (6, 1, 0, 79), (6, 2, 0, 79), (6, 2, 0, 79)]
    each = spark.createDataFrame(rows, "doc long, digest long, start int, window long")
    again = spark.createDataFrame([(77, 3), (78, 3), (79, 6)], "window long, first long")
    got = P._other_texts(each, each, again).distinct().collect()
    assert sorted(map(tuple, got)) == [(3, 20, 5, 56), (6, 2, 0, 51)]
    assert P._other_texts(each.filter("doc = 4"), each.filter("doc = 4"), again).count() == 0
