"""Language-model scores by a log-bilinear neural model (operator 11).

Every word of the corpus is counted. Frequent words are classes of their own,
less frequent ones share classes with words about as frequent, and all others,
unseen ones included, share the last. A log-bilinear network predicts the next
class: the vectors of the two classes before it, weighted by position, give a
vector whose products with the classes' target vectors are their scores.

The network is trained by noise-contrastive estimation over all training
texts: tasks start from the same weights, learn on their own rows, and return
weights that are averaged by numbers of tokens. Scores are normalised exactly,
by one matrix product over a batch of contexts and all classes; a context's sum
is kept, so it is worked out once. A word's probability is its class's, times
its smoothed share of the class. So all words and the unseen one add up to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, ship, summed_blocks

END = 0  # the class that ends a text, and stands before its first word
SINGLES = 960  # words with a class of their own, at most
GROUPS = 62  # classes that other frequent words share, at most
HEAD_WORDS = 200_000  # frequent words, at most: those that executors hold
DIMENSIONS = 24
NOISE = 128  # noise classes per batch, shared by its tokens
BATCH = 2048
ROUNDS = 1  # over all training tokens
RATE = 0.03
GROUP_WORDS = 300_000  # words that are worked on together
CHUNK_BYTES = 1 << 20  # of a long text
TALLY_WORDS = 300_000  # distinct words that a counting task holds
_SPACE = b" \t\n\x0b\x0c\r"
_STEPS = 8  # count buckets for each doubling


def chunks(text: bytes) -> Iterator[bytes]:
    """Parts of a text, cut at white space, of about ``CHUNK_BYTES``."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        end = at + CHUNK_BYTES
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out():
        table = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return table

    for batch in batches:
        for text in batch.column(0):
            for part in chunks(text.as_py() or b""):
                counts.update(part.lower().split())
                if len(counts) >= TALLY_WORDS:
                    yield out()
    yield out()


@dataclass
class Vocabulary:
    """Frequent words and what belongs to them. The entry before last stands for an end, the last for every other word."""

    index: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    shares: np.ndarray  # log10 of a word's share of its class
    weights: np.ndarray  # tokens per class
    tokens: int
    types: int
    rest: int  # sum of count and one over words that are not frequent, plus one for unseen ones

    @property
    def size(self) -> int:
        return len(self.weights)

    @property
    def other(self) -> int:
        return self.size - 1

    @property
    def log_total(self) -> float:
        return float(np.log10(self.tokens + self.types + 1))


def vocabulary_of(words: list[tuple[bytes, int]], ends: int, rest_tokens: int, rest_types: int, singles: int = SINGLES, groups: int = GROUPS) -> Vocabulary:
    """Classes of ``words`` (with counts): the first alone, the others in groups of like total count."""
    words = sorted(words, key=lambda x: (-x[1], x[0]))
    counts = np.array([n for _, n in words], np.int64)
    classes = np.arange(1, len(words) + 1)
    if len(words) > singles:
        shared = np.cumsum(counts[singles:])
        classes[singles:] = singles + 1 + np.unique((shared - 1) * groups // shared[-1], return_inverse=True)[1]
    size = int(classes.max(initial=0)) + 2
    sums = np.bincount(classes, counts + 1, size) if len(words) else np.ones(size)
    weights = np.bincount(classes, counts, size) if len(words) else np.zeros(size)
    weights[END], weights[size - 1] = ends, rest_tokens
    return Vocabulary(
        {w: k for k, (w, _) in enumerate(words)},
        np.append(counts, [ends, 0]),
        np.append(classes, [END, size - 1]).astype(np.int32),
        np.append(np.log10((counts + 1) / sums[classes]), [0.0, 0.0]),
        weights,
        int(counts.sum()) + rest_tokens + ends,
        len(words) + rest_types + (ends > 0),
        rest_tokens + rest_types + 1,
    )


@dataclass
class Network:
    """Context vectors, target vectors, position weights (before last, last) and biases."""

    context: np.ndarray
    target: np.ndarray
    position: np.ndarray
    bias: np.ndarray
    norms: dict = field(default_factory=dict, repr=False)

    @classmethod
    def fresh(cls, weights: np.ndarray, seed: int = 11) -> Network:
        """Small random vectors around the classes' own frequencies."""
        random, size = np.random.default_rng(seed), len(weights)
        vectors = lambda: random.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32)
        return cls(vectors(), vectors(), np.array([[0.5], [1.0]], np.float32) * np.ones(DIMENSIONS, np.float32), np.log(noise_of(weights)).astype(np.float32))

    def __getstate__(self) -> dict:
        return {**self.__dict__, "norms": {}}

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.target, self.position, self.bias]

    def hidden(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[first] * self.position[0] + self.context[last] * self.position[1]

    def log_sums(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log of the sum over all classes for each context; each context once."""
        size = len(self.bias)
        known = self.norms.setdefault("table", np.full(size * size, np.nan, np.float32))
        keys = first.astype(np.int64) * size + last
        new = np.unique(keys[np.isnan(known[keys])])
        for at in range(0, len(new), 2048):
            some = new[at : at + 2048]
            scores = self.hidden(some // size, some % size) @ self.target.T + self.bias
            most = scores.max(axis=1)
            known[some] = most + np.log(np.exp(scores - most[:, None]).sum(axis=1))
        return known[keys]

    def log_probs(self, first: np.ndarray, last: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Normalised natural logarithms of the classes' probabilities in their contexts."""
        scores = np.einsum("nd,nd->n", self.hidden(first, last), self.target[classes]) + self.bias[classes]
        return scores.astype(np.float64) - self.log_sums(first, last)


def noise_of(weights: np.ndarray) -> np.ndarray:
    return (weights + 1) / (weights + 1).sum()


def _scattered(rows: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``rows`` by place."""
    order = np.argsort(places.astype(np.int16) if size < 1 << 15 else places, kind="stable")
    ordered = places[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[ordered[starts]] = np.add.reduceat(rows[order], starts)
    return out


def _margins(net: Network, log_noise: np.ndarray, hidden: np.ndarray, classes: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds that a token, and each noise class in its place, is a token and no noise."""
    true = np.einsum("nd,nd->n", hidden, net.target[classes]) + net.bias[classes] - log_noise[classes]
    return true, hidden @ net.target[noise].T + (net.bias[noise] - log_noise[noise])


def objective(net: Network, log_noise: np.ndarray, first: np.ndarray, last: np.ndarray, classes: np.ndarray, noise: np.ndarray) -> float:
    """Mean log probability of telling a batch's tokens from noise; training makes it large."""
    true, false = _margins(net, log_noise, net.hidden(first, last), classes, noise)
    return float(-(np.logaddexp(0, -true).sum() + np.logaddexp(0, false).sum()) / len(classes))


def gradient(net: Network, log_noise: np.ndarray, first: np.ndarray, last: np.ndarray, classes: np.ndarray, noise: np.ndarray) -> list[np.ndarray]:
    """Gradient of ``objective`` by ``Network.arrays``.

    ``log_noise`` has the logarithm of each class's expected number among the noise.
    """
    size, n = len(net.bias), len(classes)
    hidden = net.hidden(first, last)
    own, others = net.target[classes], net.target[noise]
    true, false = _margins(net, log_noise, hidden, classes, noise)
    with np.errstate(over="ignore"):  # an infinite exponential gives the right zero
        up = 1 / (1 + np.exp(true)) / n
        down = -1 / (1 + np.exp(-false)) / n
    back = up[:, None] * own + down @ others
    target = _scattered(up[:, None] * hidden, classes, size)
    np.add.at(target, noise, down.T @ hidden)
    bias = np.bincount(classes, up, size).astype(np.float32)
    np.add.at(bias, noise, down.sum(axis=0))
    context = _scattered(back * net.position[0], first, size) + _scattered(back * net.position[1], last, size)
    position = np.stack([(back * net.context[first]).sum(axis=0), (back * net.context[last]).sum(axis=0)])
    return [context, target, position, bias]


class Learner:
    """Adaptive gradient steps from given weights."""

    def __init__(self, net: Network, weights: np.ndarray, seed: int):
        self.net = Network(*(a.copy() for a in net.arrays()))
        self.squares = [np.full(a.shape, 1e-8, np.float32) for a in net.arrays()]
        self.noise = noise_of(weights)
        self.random = np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * self.noise).astype(np.float32)
        self.ends, self.tokens = np.cumsum(self.noise), 0

    def learn(self, first: np.ndarray, last: np.ndarray, classes: np.ndarray) -> None:
        order = self.random.permutation(len(classes))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            noise = np.minimum(np.searchsorted(self.ends, self.random.random(NOISE), side="right"), len(self.noise) - 1)
            steps = gradient(self.net, self.log_noise, first[some], last[some], classes[some], noise)
            for weight, square, step in zip(self.net.arrays(), self.squares, steps):
                square += step * step
                weight += RATE * step / np.sqrt(square)
        self.tokens += len(order)


@dataclass
class Group:
    """Texts, or parts of long ones, as one row of tokens; each with the two classes before it."""

    owners: np.ndarray  # text of each token
    first: np.ndarray
    last: np.ndarray
    classes: np.ndarray
    words: np.ndarray  # place in the vocabulary, -1 for other words and -2 for an end


def groups(texts: Iterator[bytes | None], vocabulary: Vocabulary, others: dict[int, Counter] | None = None) -> Iterator[Group]:
    """All tokens of ``texts`` in groups of bounded size. ``others`` gets the words beside the vocabulary, by text."""
    find, classes = vocabulary.index.get, vocabulary.classes
    end = np.array([-2], np.int32)
    parts: list[tuple[int, np.ndarray, tuple[int, int]]] = []
    held = 0

    def together() -> Group:
        seqs, words, owners = [], [], []
        for owner, found, before in parts:
            seqs.append(np.concatenate([before, classes[found]]))
            words.append(found)
            owners.append(np.full(len(found), owner))
        sizes = np.array([len(w) for w in words])
        row = np.concatenate(seqs).astype(np.int32)
        # Two more places stand before each part.
        at = np.arange(int(sizes.sum())) + 2 * np.repeat(np.arange(1, len(parts) + 1), sizes)
        return Group(np.concatenate(owners), row[at - 2], row[at - 1], row[at], np.concatenate(words))

    for owner, text in enumerate(texts):
        before = (END, END)
        pieces = list(chunks(text or b""))
        for k, piece in enumerate(pieces):
            words = piece.lower().split()
            found = np.fromiter(map(find, words, repeat(-1)), np.int32, len(words))
            if others is not None:
                rare = np.flatnonzero(found == -1)
                if len(rare):
                    others.setdefault(owner, Counter()).update([words[r] for r in rare.tolist()])
            if k + 1 == len(pieces):
                found = np.concatenate([found, end])
            if not len(found):
                continue
            parts.append((owner, found, before))
            tail = np.concatenate([before, classes[found[-2:]]])
            before = (int(tail[-2]), int(tail[-1]))
            held += len(found)
            if held >= GROUP_WORDS:
                yield together()
                parts, held = [], 0
    if parts:
        yield together()


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for at in range(0, len(batch), 200):
        yield from batch.column(column).slice(at, 200).to_pylist()


def _learner(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        net, vocabulary, round_ = shared.value
        learner = Learner(net, vocabulary.weights, 1000 * TaskContext.get().partitionId() + round_)
        for batch in batches:
            for group in groups(_texts(batch, 0), vocabulary):
                learner.learn(group.first, group.last, group.classes)
        flat = np.concatenate([a.ravel() for a in learner.net.arrays()]).astype(np.float64) * learner.tokens
        yield pa.RecordBatch.from_arrays([pa.array([np.append(flat, learner.tokens).tobytes()], pa.binary())], ["block"])

    return run


@dataclass
class LanguageModel:
    vocabulary: Vocabulary
    network: Network
    counts: DataFrame  # word, c of all words of the corpus
    least: int  # bucket of counts from which words are frequent


def _bucket(count: Column) -> Column:
    return F.floor(F.log2(count) * _STEPS).cast("int")


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").cast("binary").alias("text"))


def counted(docs: DataFrame) -> DataFrame:
    """``word, c`` for every word of ``docs``, ends not included."""
    ship(docs.sparkSession)
    tally = _bytes(docs.filter(F.col("text").isNotNull())).mapInArrow(_tally, "word binary, n long")
    return checkpointed(tally.groupBy("word").agg(F.sum("n").alias("c")))


def train(docs: DataFrame, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> LanguageModel:
    """Count all words of ``docs`` and fit the network to all of them.

    Which words are frequent is decided by count alone: those from the least
    bucket of counts on that leaves no more than ``head_words``. They and the
    weights are all that the driver holds. Without rows only ends are known, and
    no weight moves.
    """
    spark = docs.sparkSession
    counts = counted(docs)
    ends = docs.count()
    # At most ``_STEPS`` rows for each doubling of the largest count.
    by_count = counts.groupBy(_bucket(F.col("c")).alias("bucket")).agg(F.count(F.lit(1)).alias("types"), F.sum("c").alias("tokens"))
    least, head, rest_types, rest_tokens = 1 << 30, 0, 0, 0
    for row in by_count.orderBy(F.desc("bucket")).collect():
        if rest_types == 0 and head + row["types"] <= head_words:
            least, head = row["bucket"], head + row["types"]
        else:
            rest_types, rest_tokens = rest_types + row["types"], rest_tokens + row["tokens"]
    frequent = counts.filter(_bucket(F.col("c")) >= least).collect()  # head_words at most
    vocabulary = vocabulary_of([(bytes(r["word"]), r["c"]) for r in frequent], ends, rest_tokens, rest_types)
    network = Network.fresh(vocabulary.weights)
    read = _bytes(docs)
    parts = read.rdd.getNumPartitions()
    for round_ in range(rounds if ends else 0):
        shared = spark.sparkContext.broadcast((network, vocabulary, round_))
        size = sum(a.size for a in network.arrays())
        total = summed_blocks(read.mapInArrow(_learner(shared), "block binary"), parts, (size + 1,))
        shared.destroy()
        flat, old = (total[:-1] / total[-1]).astype(np.float32), network.arrays()
        cuts = np.split(flat, np.cumsum([a.size for a in old])[:-1])
        network = Network(*(c.reshape(a.shape) for c, a in zip(cuts, old)))
    return LanguageModel(vocabulary, network, counts, least)


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<binary>, uses array<long>"


def _scorer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        net, vocabulary = shared.value
        logs = np.log10(vocabulary.counts + 1)
        for batch in batches:
            for at in range(0, len(batch), 2000):
                some = batch.slice(at, 2000)
                n = len(some)
                tokens, seen = np.zeros(n, np.int64), np.zeros(n, np.int64)
                base, score = np.zeros(n), np.zeros(n)
                others: dict[int, Counter] = {}
                for group in groups(_texts(some, 3), vocabulary, others):
                    add = lambda out, values, own=group.owners: np.add(out, np.bincount(own, values, n).astype(out.dtype), out=out)
                    add(tokens, None)
                    add(seen, vocabulary.counts[group.words] > 0)
                    add(base, logs[group.words] - vocabulary.log_total)
                    add(score, net.log_probs(group.first, group.last, group.classes) / np.log(10) + vocabulary.shares[group.words])
                lists = [others.get(k, {}) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(k) for k in range(3)),
                        pa.array(tokens), pa.array(seen), pa.array(base), pa.array(score),
                        pa.array([list(c) for c in lists], pa.list_(pa.binary())),
                        pa.array([list(c.values()) for c in lists], pa.list_(pa.int64())),
                    ],
                    [part.split()[0] for part in _SCORED.split(", ")],
                )

    return run


def scored(docs: DataFrame, model: LanguageModel, held_out: Column | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row's whole text.

    Executors know the frequent words. Each text's other words are joined to the
    corpus counts, one row per text and word, and their parts of the sums added.
    A NULL or empty text is its end alone. Repeated rows are each scored, an
    empty table gives no rows, other columns play no part.
    """
    spark, vocabulary = docs.sparkSession, model.vocabulary
    ship(spark)
    shared = spark.sparkContext.broadcast((model.network, vocabulary))
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    read = checkpointed(marked.mapInArrow(_scorer(shared), _SCORED))
    uses = read.select("row", F.explode(F.arrays_zip("words", "uses")).alias("u")).select("row", F.col("u.words").alias("word"), F.col("u.uses").alias("n"))
    rare = model.counts.filter(_bucket(F.col("c")) < model.least)
    c = F.coalesce("c", F.lit(0))
    found = uses.join(rare, "word", "left").groupBy("row").agg(
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("boolean").alias("held_out"),
        F.lit(None).cast("long").alias("n_tokens"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("n") * F.log10(c + 1)).alias("base"),
        F.sum(F.col("n") * (F.log10(c + 1) - F.log10(F.lit(float(vocabulary.rest))))).alias("score"),
    )
    both = read.select(*found.columns).unionByName(found)
    # One row of the text itself and the sums of its rare words.
    whole = both.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    )
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def held_out() -> Column:
    """Rows that nothing is learned from. A row without an id is learned from."""
    text = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(7)) == 2


def scores_of(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` by a model learned from those that are not held out."""
    return scored(docs, train(docs.filter(~held_out())), held_out())
