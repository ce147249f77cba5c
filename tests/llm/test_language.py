"""Forward sums against listing all segmentations; accuracy on held-out rows."""

import zlib

import numpy as np

from folioaudit.llm import language as L

VOCABULARY = "\n".join(f"{b} {n}" for n, b in enumerate(["YQ==", "Yg==", "YWI=", "YmE=", "YWJh", "IGE="]))


def listed(word, pieces, probs):
    """Sum over segmentations, written out, and each piece's uses weighted by probability."""
    total, uses = 0.0, np.zeros(len(probs))
    names = {}
    for size in range(1, L.PIECE_BYTES + 1):
        for k, key in enumerate(pieces.keys[size]):
            names[int(key).to_bytes(size, "big")] = pieces.first[size] + k

    def walk(rest, used):
        nonlocal total
        if not rest:
            p = np.prod([probs[u] for u in used])
            total += p
            for u in used:
                uses[u] += p
        for size in range(1, min(len(rest), L.PIECE_BYTES) + 1):
            if rest[:size] in names:
                walk(rest[size:], [*used, names[rest[:size]]])

    walk(word, [])
    return total, uses / total


def test_forward_and_expected_counts():
    pieces = L.Pieces(VOCABULARY)
    probs = np.random.default_rng(0).random((pieces.count + 1, 2))
    probs[-1] = 0
    for word in (b" a", b" abab", b"abaabba", b" xaby"):
        ids = pieces.ids(np.frombuffer(word, np.uint8)[None])
        got = L.forward(ids, probs)[-1][0]
        for lang in range(2):
            total, uses = listed(word, pieces, probs[:, lang])
            assert np.isclose(got[lang], total)
            assert np.allclose(L.expected(ids, probs[:, lang], np.array([3.0])), 3 * uses)
    parts = [b" ab", b" abab" * 20]
    scores = L.word_scores(parts, pieces, probs)
    assert np.isfinite(scores).all()


def test_batches_and_groups_agree(monkeypatch):
    pieces = L.Pieces(VOCABULARY)
    probs = np.random.default_rng(0).random((pieces.count + 1, 3)) / 100
    probs[-1] = 0
    model = L.Model(("x", "y", "z"), VOCABULARY, probs, "k")
    texts = ["ab aba ba", "", None, "12 !?", "ba " * 500, "Éa 9"]
    want = L.score_texts(texts, L._Words(model))
    monkeypatch.setattr(L, "GROUP_WORDS", 7)
    again = L.score_texts(texts, L._Words(model))
    assert want[0] == again[0] and np.allclose(want[1], again[1])
    assert want[0][1:4] == ["und"] * 3 and want[0][4] != "und"


def test_held_out_accuracy(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    out = L.languages_of(docs).toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    both = out.merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (both[both.held_out].lang == both[both.held_out].lang_pred).mean() > 0.98
    assert len(out) == docs.count() and out.score.between(0, 1).all()


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score int, _row string"
    rows = [(1, None, "en", 1, "x"), (2, "", "en", 1, "x"), (3, "12 34", "en", 1, "x"), (None, "the cat", None, 1, "x")]
    rows += [(k, "the cat sat on the mat " * k, "en", 1, "x") for k in range(4, 12)] + [(k, "le chat est sur la table", "fr", 1, "x") for k in range(12, 30)] * 2
    rows += [(50, "chat " * 60_000, None, 1, "x"), (51, "x" * 100_000, None, 1, "x")]
    docs = spark.createDataFrame(rows, schema)
    out = {r["doc_id"]: r for r in L.languages_of(docs).collect()}
    assert [out[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and out[50]["lang_pred"] == "fr" and out[None]["lang_pred"] == "en"
    kept = L.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert L.languages_of(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in L.languages_of(docs.withColumn("lang", docs["lang"].substr(9, 1)).filter("lang = 'q'").unionByName(docs.withColumn("lang", docs["_row"].substr(5, 0)).replace("", None, ["lang"]))).collect()} == {"und"}


def test_only_texts_go_to_the_workers(spark):
    """The stage's rows stay in Spark: texts are sent once and don't come back."""
    rows = [(k, "the cat sat on the mat " * 9, "en") for k in range(4)] + [(k, "le chat est sur la table " * 9, "fr") for k in range(4, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = L.accepted(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    assert sorted(map(tuple, kept.collect())) == rows
