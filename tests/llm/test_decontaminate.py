"""Template windows with slot checks, against plain loops over all windows."""

import random

from pyspark.accumulators import AccumulatorParam

from folioaudit.llm import decontaminate as D


def brute(docs, items):
    """Every window of every document against every window of every item."""
    known = D.Words()
    windows = {i: D.item_windows(i, t, known) for i, t in items if i is not None}
    out = {}
    for doc, text in docs:
        words, hashes, slots, _ = D.templates([text], known)
        hits, places = {}, {}
        for width in {w["width"] for own in windows.values() for w in own}:
            for at, h in enumerate(D.window_hashes(hashes, width).view("int64").tolist()):
                places.setdefault((width, h), []).append(at)
        for i, own in windows.items():
            for w in own:
                width = w["width"]
                for at in places.get((width, w["window"]), []):
                    values = [D.bare(words[at + k]) for k in range(width) if slots[at + k]]
                    if len(values) == len(w["slots"]):
                        hits.setdefault((i, at - w["place"]), []).append((w["place"], tuple(zip(w["slots"], values))))
        found = {}
        for (i, _), lined in hits.items():
            pairs = {p for _, ps in lined for p in ps}
            if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                found.setdefault(i, set()).update(place for place, _ in lined)
        out[doc] = sorted(i for i, p in found.items() if len(p) >= D.COVERAGE * len({w["place"] for w in windows[i]}))
    return out


def result(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: r["item_ids"] or [] for r in D.contamination(d, b).collect()}


ITEM = "A train leaves Boston at 60 km per hour and after 60 minutes Anna sees 3 stations near Boston on the way"


def test_reparameterised_question_is_found(spark):
    items = [(1, ITEM)]
    docs = [
        (1, f"Read this. {ITEM} and answer."),
        (2, ITEM.replace("Boston", "Lyon").replace("60", "45").replace("Anna", "Bert").replace("3", "7")),
        (3, ITEM.replace("Boston", "Lyon", 1).replace("60", "45", 1)),  # slots contradict each other
        (4, "A train leaves the town and after some minutes a man sees stations near the river on the way"),
        (5, "so " + ITEM.lower()),
    ]
    got = result(spark, docs, items)
    assert got[1] == [1] and got[2] == [1] and got[3] == [] and got[4] == []


def test_equals_brute_force(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice(["alpha", "beta", "gamma", "delta", "Rome", "Oslo", "7", "12", "kg", "end.", "of", "the"])
    items = [(i, " ".join(word() for _ in range(rnd.choice([3, 5, 9, 14, 30])))) for i in range(25)]
    docs = []
    for d in range(60):
        text = [word() for _ in range(rnd.randint(0, 40))]
        for _, t in rnd.sample(items, rnd.randint(0, 2)):
            words = t.split()
            if rnd.random() < 0.4:
                swap = {"Rome": "Oslo", "Oslo": "Rome", "7": "99"}
                words = [swap.get(w, w) for w in words]
            text[rnd.randint(0, len(text)) :] = words[: rnd.choice([len(words), len(words) // 2 + 1])]
        docs.append((d, " ".join(text)))
    want = brute(docs, items)
    assert result(spark, docs, items) == want
    assert sum(map(bool, want.values())) > 10


def test_edges(spark):
    items = [(1, ITEM), (2, None), (3, ""), (None, ITEM), (1, ITEM)]
    docs = [(1, None), (2, ""), (3, ITEM), (3, ITEM), (None, ITEM), (None, "clean"), (4, "x " * 30_000 + ITEM)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = sorted(((r["doc_id"], r["contaminated"], r["n_items"]) for r in D.contamination(d, b).collect()), key=str)
    assert rows == sorted([(1, False, 0), (2, False, 0), (3, True, 1), (3, True, 1), (None, True, 1), (None, False, 0), (4, True, 1)], key=str)
    left = D.clean(d.selectExpr("*", "1 AS key", "2 AS window"), b)
    assert left.columns == ["doc_id", "text", "key", "window"] and left.count() == 3
    assert D.contamination(d.limit(0), b).count() == 0
    assert not any(r["contaminated"] for r in D.contamination(d, b.limit(0)).collect())


def test_texts_are_read_in_small_batches(spark, monkeypatch):
    """The scan's batches are bounded in bytes, for the pipeline's stage and the operator alike."""
    sizes = spark.sparkContext.accumulator(0, Most())
    scan = D._candidates

    def watched(marks, widths):
        run = scan(marks, widths)

        def counted(batches):
            def each():
                for batch in batches:
                    sizes.add(batch.nbytes)
                    yield batch

            return run(each())

        return counted

    monkeypatch.setattr(D, "_candidates", watched)
    d = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "concat(repeat('plain words ', 800), IF(id = 7, :item, '')) AS text".replace(":item", f"'{ITEM}'"))
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert D.clean(d, b).count() == 1999
    assert 0 < sizes.value < 8 << 20
    assert [r["doc_id"] for r in D.contamination(d, b).filter("contaminated").collect()] == [7]
    assert sizes.value < 8 << 20


class Most(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):  # noqa: N802
        return max(a, b)
