"""Line dedup against the same rules worked out with plain loops."""

import random

from folioaudit.llm import linededup as D


def brute(rows):
    """First occurrence of every gram by scanning; runs extended step by step."""
    docs = {}
    for i, t in sorted((i, t) for i, t in rows if i is not None and t is not None):
        docs.setdefault(i, t)
    parsed = {}
    for i, t in docs.items():
        lines = [(n, tuple(x.encode().split())) for n, x in enumerate(t.split("\n"))]
        parsed[i] = [x for x in lines if x[1]]
    prints, first = {}, {}
    for i, lines in parsed.items():
        _, _, hashes, counts = D.lines_of(docs[i])
        prints[i] = []
        for h, k in D.fingerprints(hashes, counts):
            words, gram = 0, []
            for _, line in lines[k:]:
                gram.append(line)
                words += len(line)
                if words >= D.GRAM_WORDS:
                    break
            prints[i].append((tuple(gram), k))
            first.setdefault(tuple(gram), (i, k))
    out = []
    for i, t in rows:
        if t is None or i is None:
            out.append((i, t, 0))
            continue
        own, gone = parsed[i], set()
        for gram, k in prints[i]:
            j, m = first[gram]
            if (j, m) == (i, k):
                continue
            other = parsed[j]
            while k and m and own[k - 1][1] == other[m - 1][1]:
                k, m = k - 1, m - 1
            run = []
            while k < len(own) and m < len(other) and own[k][1] == other[m][1]:
                run.append(own[k][0])
                k, m = k + 1, m + 1
            gone |= set(range(run[0], run[-1] + 1))
        with_words = {n for n, _ in own}
        out.append((i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone), len(gone & with_words)))
    return sorted(out, key=str)


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in D.without_repeats(df, "doc_id").collect()), key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    sentence = lambda n: " ".join(rnd.choice("abcdefghij") for _ in range(n))
    passages = ["\n".join(sentence(rnd.randint(1, 9)) for _ in range(9)) for _ in range(4)] + [sentence(60), sentence(25)]
    rows = []
    for i in range(80):
        parts = [sentence(rnd.randint(1, 30)) for _ in range(rnd.randint(0, 5))]
        parts += rnd.sample(passages, rnd.randint(0, 3)) + [""] * rnd.randint(0, 2)
        rnd.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    got = result(spark, rows)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 50
    long = [r for r in got if passages[4] in r[1]]
    assert len(long) == 1  # a long line is always found


def test_edges(spark):
    line = " ".join("abcdefghijklmnopqrstuvwxy")
    rows = [(1, None), (2, ""), (3, line), (3, line), (4, f"{line}\n\n{line}\nend"), (None, line), (5, "one\n" * 4000), (6, f"  {line}\t")]
    got = result(spark, rows)
    assert (4, "\nend", 2) in got and (6, "", 1) in got and (None, line, 0) in got
    assert got.count((3, line, 0)) == 2 and (1, None, 0) in got and (2, "", 0) in got
    left = next(r for r in got if r[0] == 5)
    assert 0 < left[2] < 4000 and left[1].startswith("one\n")
    assert result(spark, []) == []


def test_repeated_id_with_other_text_and_extra_columns(spark):
    line = " ".join("abcdefghijklmnopqrstuvwxy")
    df = spark.createDataFrame([(1, line, 3, "x"), (2, line, 4, "y"), (2, f"{line}\nz", 5, "y")], "doc_id int, text string, _runs int, digest string")
    got = {tuple(r) for r in D.without_repeats(df, "doc_id", "_runs", "digest").collect()}
    assert {r[1] for r in got} == {3, 4, 5} and (1, 3, "x", line, 0) in got
    assert sum(r[4] for r in got) == 1


def test_winnowing_guarantee():
    import numpy as np

    rnd = np.random.default_rng(3)
    shared = rnd.integers(0, 2**63, 12).astype(np.uint64)
    counts = np.full(12, 7)
    for _ in range(200):
        head, tail = (rnd.integers(0, 2**63, 5).astype(np.uint64) for _ in range(2))
        a = D.fingerprints(np.concatenate([head, shared, tail]), np.full(22, 7))
        b = {h for h, _ in D.fingerprints(shared, counts)}
        assert b & {h for h, _ in a}
