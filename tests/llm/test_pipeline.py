"""The pipeline's stages, each against a brute-force version on its own input."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from folioaudit.llm import decontaminate, language, linededup, packing, tokens
from folioaudit.llm.common import table

from .test_decontaminate import Most
from .test_decontaminate import brute as items_in
from .test_linededup import brute as cut_lines
from .test_minmax import brute as near


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Each stage's rows, written and read again as the next one's input."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, sf_dir, "documents"), {}
    out["documents"] = docs
    for name, stage in C.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_columns_and_order(stages):
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, _ in C.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_stage(stages):
    found = language.languages_of(stages["documents"]).filter(F.col("lang_pred") != "und").filter(F.col("score") >= language.LEAST)
    assert {i for i, _ in pairs(stages["language_id"])} == {r["doc_id"] for r in found.collect()}


def test_line_stage(stages):
    before = pairs(stages["language_id"])
    want = sorted((i, t) for i, t, n in cut_lines(before) if n == 0 or t.strip(" \t\n\r\x0b\x0c"))
    assert pairs(stages["line_dedup"]) == want
    lengths = stages["line_dedup"].filter(F.length("text") != F.col("n_chars"))
    assert lengths.count() == 0


def test_near_duplicate_stage(stages):
    before = pairs(stages["line_dedup"])
    kept = {i for i, _, _, keep in near(before) if keep}
    assert pairs(stages["near_dedup"]) == [(i, t) for i, t in before if i in kept]


def test_decontamination_stage(spark, sf_dir, stages):
    before = pairs(stages["near_dedup"])
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    found = items_in(before, items)
    assert pairs(stages["decontamination"]) == [(i, t) for i, t in before if not found[i]]


def test_packing_stage(stages):
    before, rows = pairs(stages["decontamination"]), stages["packing"].collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in before}
    fill = {}
    for r in rows:
        fill.setdefault(r["sequence_id"], []).append(r["length"])
    assert max(map(sum, fill.values())) <= packing.CAPACITY
    bound = packing.lower_bound(np.array([r["length"] for r in rows]))
    assert bound <= len(fill) <= bound + 1 + bound // 50


def test_run_gives_the_stages_rows(spark, sf_dir, stages):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(tuple(r) for r in C.run(spark, sf_dir).select(names).collect())
    assert got == sorted(tuple(r) for r in stages["packing"].select(names).collect())


def test_rows_without_ids_and_empty_tables(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the of and that with from this was are for " * 6
    rows = [(1, text, "en", "s", 3), (2, text, "en", "s", 3), (None, text, None, None, None), (3, None, "en", None, 0), (4, "", "en", "s", 0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in C.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert "sequence_id" in docs.columns
        docs.collect()


def test_benchmark_windows_of_this_data(spark, sf_dir):
    """Every item that stands whole in a document is found, and nothing else is."""
    docs, items = (table(spark, sf_dir, n) for n in ("documents", "benchmark"))
    listed = [(r["item_id"], " ".join(r["text"].split())) for r in items.collect()]
    want = {r["doc_id"]: sorted(i for i, t in listed if t in " ".join(r["text"].split())) for r in docs.collect()}
    got = {r["doc_id"]: r["item_ids"] or [] for r in decontaminate.contamination(docs, items).collect()}
    assert got == want and any(want.values())


def test_line_window_is_the_documented_one():
    assert (linededup.GRAM_WORDS, linededup.WINDOW) == (20, 4)


def test_language_stage_reads_small_batches(spark, monkeypatch):
    """Its rows are stored under bounded batches; the learned model and the verdicts stay."""
    rows = [(k, "the cat sat on the mat " * 700, "en") for k in range(500)] + [(k, "le chat est sur la table " * 700, "fr") for k in range(500, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    sizes = spark.sparkContext.accumulator(0, Most())
    scored = language._scored

    def watched(texts, model):
        sizes.add(texts.nbytes)
        return scored(texts, model)

    def scorer(model):
        def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in columns:
                yield pa.StructArray.from_arrays(watched(texts, model.value), ["lang_pred", "score"])

        return run

    monkeypatch.setattr(language, "_column_scorer", scorer)
    kept = C.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 1000
    assert 0 < sizes.value < 8 << 20


def test_token_table_is_emptied_between_calls(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    encoder, whole = tokens.WordIds(packing.default_tokenizer()), tokens.WordIds(packing.default_tokenizer())
    texts = [" ".join(f"word{k}x{n}" for n in range(20)).encode() for k in range(30)]
    want = [x.tolist() for x in whole.encode(texts)]
    got, most = [], 0
    for k, text in enumerate(texts):  # calls of fewer words than a group
        got += [x.tolist() for _, x in zip([k], encoder.encode([text]))]
        most = max(most, len(encoder))
    assert got == want and most < 50 + 21


def test_packing_takes_one_worker_per_task(spark, monkeypatch):
    """Texts are encoded from stored rows, not behind another Python step of the same task."""
    plans = []
    monkeypatch.setattr(packing, "pack", lambda docs: plans.append(docs._jdf.queryExecution().executedPlan().toString()) or docs)
    docs = spark.createDataFrame([(1, "a b c " * 40), (2, None)], "doc_id long, text string")
    assert C.pack_sequences(spark, docs, "").count() == 2
    assert "MapInArrow" not in plans[0] and "Python" not in plans[0]
