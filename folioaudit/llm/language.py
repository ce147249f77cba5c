"""Language identification by segmentation-marginalised unigrams (operator 5).

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. Piece probabilities
come from expectation maximisation over a bounded sample of labelled texts.

Words are scored once per worker and looked up after that, so the cost follows
the number of different words, not of all words.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, kept, rows_of, ship

UNKNOWN = "und"
PIECE_BYTES = 8  # longer pieces of the vocabulary are left out
WORD_BYTES = 32  # longer words are scored in parts of this size
ROUNDS = 3
# Bound of the training sample: documents per language, chosen by hash.
SAMPLE_DOCS = 300
# Bound of the model: the languages with most labelled documents are learned.
LANGUAGES = 200
CACHE_WORDS = 300_000
GROUP_WORDS = 300_000
SCORED_PARTS = 4_000  # scored at once: every place of each holds sums for all languages
PRIOR = 0.01  # expected count added to each piece
LEAST = 0.5  # a document below this score is rejected


def default_vocabulary() -> str:
    """Text of the public piece list: a base64 piece and its rank per line."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), encoding="ascii") as file:
        return file.read()


class Pieces:
    """The vocabulary as sorted 64-bit keys per length, all single bytes included."""

    def __init__(self, text: str):
        listed = {base64.b64decode(line.split()[0]) for line in text.splitlines() if line.strip()}
        listed |= {bytes([b]) for b in range(256)}
        self.keys, self.first, total = [np.empty(0, np.uint64)], [0], 0
        for size in range(1, PIECE_BYTES + 1):
            keys = np.array(sorted(int.from_bytes(p, "big") for p in listed if len(p) == size), np.uint64)
            self.keys.append(keys)
            self.first.append(total)
            total += len(keys)
        self.count = total

    def ids(self, words: np.ndarray) -> list[list[np.ndarray]]:
        """``ids[end][size - 1]``: piece that ends there in each word, or ``count``."""
        length = words.shape[1]
        wide, out = words.astype(np.uint64), [[]]
        for end in range(1, length + 1):
            row, key = [], np.zeros(len(words), np.uint64)
            for size in range(1, min(PIECE_BYTES, end) + 1):
                key = key | (wide[:, end - size] << np.uint64(8 * (size - 1)))
                keys = self.keys[size]
                if not len(keys):
                    row.append(np.full(len(words), self.count))
                    continue
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                row.append(np.where(keys[at] == key, at + self.first[size], self.count))
            out.append(row)
        return out


def forward(ids: list[list[np.ndarray]], probs: np.ndarray) -> list[np.ndarray]:
    """Sums over segmentations of each prefix. ``probs`` has a last row of zeros."""
    n = len(ids[1][0])
    alpha = [np.ones((n, probs.shape[1]))]
    for end in range(1, len(ids)):
        alpha.append(sum(alpha[end - 1 - k] * probs[found] for k, found in enumerate(ids[end])))
    return alpha


def expected(ids: list[list[np.ndarray]], probs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each piece's expected number of uses in one language's counted words."""
    column = probs[:, None]
    alpha, length = [x[:, 0] for x in forward(ids, column)], len(ids) - 1
    beta = [np.zeros(len(counts)) for _ in range(length)] + [np.ones(len(counts))]
    for end in range(length, 0, -1):
        for k, found in enumerate(ids[end]):
            beta[end - 1 - k] += beta[end] * probs[found]
    weight = counts / alpha[length]
    pieces, uses = [], []
    for end in range(1, length + 1):
        for k, found in enumerate(ids[end]):
            pieces.append(found)
            uses.append(alpha[end - 1 - k] * probs[found] * beta[end] * weight)
    return np.bincount(np.concatenate(pieces), np.concatenate(uses), len(probs))


def normal(word: str) -> bytes:
    """Letters of a lower-cased word behind the space that starts it; b'' without any."""
    letters = word if word.isalpha() else "".join(filter(str.isalpha, word))
    return b" " + letters.encode() if letters else b""


def parts_of(word: bytes) -> list[bytes]:
    return [word[k : k + WORD_BYTES] for k in range(0, len(word), WORD_BYTES)]


def _by_length(parts: list[bytes], most: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and bytes of the parts of each length, in bounded groups."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    for length in np.unique(sizes):
        places = np.flatnonzero(sizes == length)
        for at in range(0, len(places), most):
            some = places[at : at + most]
            joined = b"".join(parts[k] for k in some)
            yield some, np.frombuffer(joined, np.uint8).reshape(len(some), length)


def word_scores(words: list[bytes], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    parts, owner = [], []
    for n, word in enumerate(words):
        for part in parts_of(word):
            parts.append(part)
            owner.append(n)
    logs = np.zeros((len(parts), probs.shape[1]))
    for places, matrix in _by_length(parts, SCORED_PARTS):
        logs[places] = np.log(forward(pieces.ids(matrix), probs)[-1])
    out = np.zeros((len(words), probs.shape[1]))
    np.add.at(out, np.array(owner, np.int64), logs)
    return out


@dataclass(frozen=True)
class Model:
    """Languages, the vocabulary's text, and probabilities (pieces x languages)."""

    languages: tuple[str, ...]
    vocabulary: str
    probs: np.ndarray
    key: str


@lru_cache(maxsize=2)
def _pieces(vocabulary: str) -> Pieces:
    return Pieces(vocabulary)


class _Words(dict):
    """Row of each word in a table of scores; new words queue up for scoring."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.table = np.zeros((1024, len(model.languages)), np.float32)
        self.letters = np.zeros(1024, bool)

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def settle(self) -> None:
        if not self.new:
            return
        if len(self) > len(self.table):
            more = 2 * len(self)
            table, letters = np.zeros((more, self.table.shape[1]), np.float32), np.zeros(more, bool)
            table[: len(self.table)], letters[: len(self.letters)] = self.table, self.letters
            self.table, self.letters = table, letters
        plain = [normal(w) for w in self.new]
        first = len(self) - len(self.new)
        self.table[first : len(self)] = word_scores(plain, _pieces(self.model.vocabulary), self.model.probs)
        self.letters[first : len(self)] = [bool(p) for p in plain]
        self.new = []


def _words_for(model: Model) -> _Words:
    return kept(model.key, lambda: _Words(model), lambda words: len(words) > CACHE_WORDS)


def score_texts(texts: list[str | None], known: _Words) -> tuple[list[str], list[float]]:
    """Best language and its posterior per text; ties go to the first language.

    Words are gathered over many texts and scored together, in groups of about
    ``GROUP_WORDS`` words whatever the texts' lengths.
    """
    totals = np.zeros((len(texts), len(known.model.languages)))
    letters = np.zeros(len(texts), bool)
    owners, places, held = [], [], 0

    def settle() -> None:
        known.settle()
        for n, found in zip(owners, places):
            totals[n] += known.table[found].sum(axis=0, dtype=np.float64)
            letters[n] |= known.letters[found].any()
        owners.clear()
        places.clear()

    for n, text in enumerate(texts):
        words = (text or "").lower().split()
        for at in range(0, len(words), GROUP_WORDS):
            part = words[at : at + GROUP_WORDS]
            owners.append(n)
            places.append(np.fromiter(map(known.__getitem__, part), np.int32, len(part)))
            held += len(part)
            if held >= GROUP_WORDS:
                settle()
                held = 0
    settle()
    langs, scores = [], []
    for total, any_letter in zip(totals, letters):
        if not any_letter or not len(total):
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        weights = np.exp(total - total.max())
        best = int(total.argmax())
        langs.append(known.model.languages[best])
        scores.append(float(weights[best] / weights.sum()))
    return langs, scores


def _scored(texts: pa.Array, model: Model) -> tuple[pa.Array, pa.Array]:
    """Language and score of each text of one batch."""
    langs, scores = [], []
    for at in range(0, len(texts), 1000):
        some = score_texts(texts.slice(at, 1000).to_pylist(), _words_for(model))
        langs += some[0]
        scores += some[1]
    return pa.array(langs, pa.string()), pa.array(scores, pa.float64())


def _scorer(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            found = _scored(batch.column(batch.schema.get_field_index("text")), model.value)
            names = [n for n in batch.schema.names if n != "text"]
            others = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*others, *found], [*names, "lang_pred", "score"])

    return run


def _column_scorer(model) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            yield pa.StructArray.from_arrays(_scored(texts, model.value), ["lang_pred", "score"])

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of labelled texts, counted per batch."""
    for batch in batches:
        counts: dict[tuple[str, bytes], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word in (text or "").lower().split():
                if plain := normal(word):
                    for part in parts_of(plain):
                        counts[lang, part] = counts.get((lang, part), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["lang", "part", "n"],
        )


def _counter(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One E-step: expected piece counts of the rows a task holds."""

    def run(batches):
        pieces, probs = _pieces(model.value.vocabulary), model.value.probs
        place = {lang: n for n, lang in enumerate(model.value.languages)}
        out = np.zeros(probs.shape)
        for batch in batches:
            langs = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            parts, counts = batch.column(1).to_pylist(), np.array(batch.column(2).to_pylist(), float)
            for lang in np.unique(langs):
                own = np.flatnonzero(langs == lang)
                for some, matrix in _by_length([parts[k] for k in own]):
                    out[:, lang] += expected(pieces.ids(matrix), probs[:, lang], counts[own[some]])
        piece, lang = np.nonzero(out[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(out[piece, lang], pa.float64())], ["piece", "lang", "n"]
        )

    return run


def train(docs: DataFrame, vocabulary: str | None = None, per_language: int = SAMPLE_DOCS) -> Model:
    """Learn from ``docs(doc_id, text, lang)``; rows without a lang or text don't count.

    The sample holds at most ``per_language`` documents of each of at most
    ``LANGUAGES`` languages, chosen by a hash of doc_id. What comes
    to the driver is piece counts, bounded by vocabulary times languages.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = default_vocabulary() if vocabulary is None else vocabulary
    pieces = _pieces(vocabulary)
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = tuple(sorted(r["lang"] for r in sizes))
    # A hash thins each language out to a few times its sample, whatever its
    # size, before its rows are ordered in one task.
    share = {r["lang"]: min(1.0, 4 * per_language / r["count"]) for r in sizes}
    shares = F.create_map(*[F.lit(x) for item in share.items() for x in item]) if share else F.lit(None).cast("map<string,double>")
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) <= F.try_element_at(shares, F.col("lang")) * (1 << 32)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.filter(drawn).select("doc_id", "lang").withColumn("_n", F.row_number().over(order))
    chosen = checkpointed(chosen.filter(F.col("_n") <= per_language).select("doc_id", "lang"))
    sample = rows_of(labelled, chosen.select("doc_id").distinct()).filter(F.col("lang").isin(*languages))
    tally = checkpointed(
        sample.select("lang", "text").mapInArrow(_tally, "lang string, part binary, n long").groupBy("lang", "part").agg(F.sum("n").alias("n"))
    )
    probs = np.full((pieces.count + 1, len(languages)), 1.0 / max(1, pieces.count))
    probs[-1] = 0
    for _ in range(ROUNDS if languages else 0):
        shared = spark.sparkContext.broadcast(Model(languages, vocabulary, probs, ""))
        counts = tally.mapInArrow(_counter(shared), "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        found = counts.toPandas()  # at most pieces x languages rows
        probs = np.full(probs.shape, PRIOR)
        np.add.at(probs, (found["piece"].to_numpy(np.int64), found["lang"].to_numpy(np.int64)), found["n"].to_numpy())
        probs[-1] = 0
        probs /= probs.sum(axis=0)
    key = f"{spark.sparkContext.applicationId}-{hash(probs.tobytes())}"
    return Model(languages, vocabulary, probs, key)


def identify(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` for every row's whole text.

    NULL, empty and letterless texts give ``und`` and 0.0. Texts of any length
    are scored in blocks of words. Repeated rows are each scored; an empty
    table gives no rows; a model without languages gives ``und`` throughout.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    taken = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kept = [f"`{n}` {t}" for n, t in taken.dtypes if n != "text"]
    return taken.mapInArrow(_scorer(shared), ", ".join([*kept, "lang_pred string", "score double"]))


def held_out() -> Column:
    """Rows that no label is learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def languages_of(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row, learned from the rest of the rows."""
    model = train(docs.filter(~held_out()))
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return identify(marked, model, "doc_id", "held_out")


def accepted(docs: DataFrame) -> DataFrame:
    """Rows, all columns, whose language is known with a score of ``LEAST`` or more.

    Only texts go to the workers and only outcomes return: the rows wait in Spark,
    which would otherwise hold batches of them outside its heap, twice each way.
    """
    model = train(docs.filter(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Not deterministic to the planner, lest it score once per use.
    score = F.arrow_udf(_column_scorer(shared), "lang_pred string, score double").asNondeterministic()
    row = F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row")
    found = docs.select(row, score(F.col("text").cast("string")).alias("_found"))
    good = (F.col("_found.lang_pred") != UNKNOWN) & (F.col("_found.score") >= LEAST)
    return found.filter(good).select(*[F.col("_row").getField(n).alias(n) for n in docs.columns])
