"""Whitening by Chebyshev-filtered subspace iteration (operator 12).

Entries become integers, so sums and deviations are exact. The covariance is
never built: it is only multiplied with a narrow block of vectors, ``V Q =
Xc'(Xc Q) / n``, in one pass over the distinct vectors, which are stored as blocks
of small integers. Tasks centre their rows, multiply twice and return a block;
blocks are added up in tasks before the driver gets them.

A Chebyshev polynomial of V, evaluated by its three-term recurrence of such
passes, damps the part of the spectrum below the block's last Ritz value. QR and
Rayleigh-Ritz follow. Rounds end when every wanted pair's residual is small and
a Lanczos run on what is left finds nothing larger than what is wanted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .common import ship, summed_blocks

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000  # x = floor(SCALE * c) + OFFSET
LARGEST = float(1 << 56)  # scaled entries beyond it count as it
DEGREE = 12  # of the polynomial, at most
GROWTH = 1e8  # by which the largest eigenvalue may outgrow the unwanted ones in a round
BOUND_STEPS = 10  # Lanczos steps for the ends of the spectrum
CHECK_STEPS = 8  # and to see that nothing was missed
RESIDUAL = 1e-13  # of a certified pair, in units of the largest eigenvalue
RANK = 1e-11  # components below this part of the largest eigenvalue don't count
ROUNDS = 40  # before the block is widened
_BLOCK_ROWS = 2048  # projected together
_BLOCK_BYTES = 1 << 20  # of a stored block, as 64-bit integers


def _usable(vector: Column) -> Column:
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, entry)


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, x``: integer entries of usable vectors of the commonest length (the longer of ties)."""
    read = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
    scaled = lambda c: F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    kept = read.filter(_usable(F.col("c"))).select("vec_id", F.transform("c", lambda c: F.floor(scaled(c)).cast("long") + OFFSET).alias("x"))
    lengths = kept.groupBy(F.size("x").alias("size")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return kept.filter(F.size("x") == (most["size"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Centre:
    """Number of vectors and the exact mean, as a whole part and a rest: ``mean = whole + rest / n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    exact: bool  # whether n times a centred entry, squared and summed, fits 64 bits
    kind: str  # of the integers that entries less ``whole`` are stored as

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact."""
        apart = x - self.whole
        if not self.exact:
            apart = apart.astype(object)
        return apart * self.n - self.rest

    def rows(self, block: bytes) -> np.ndarray:
        """Centred rows of a stored block."""
        apart = np.frombuffer(block, self.kind).reshape(-1, len(self.whole))
        return apart - (self.rest / self.n).astype(np.float64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension: rows, sums of high and low halves, least and greatest entry."""
    total = None
    for batch in batches:
        if not len(batch):
            continue
        x = _matrix(batch.column(0))
        own = [np.full(x.shape[1], len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), x.min(axis=0), x.max(axis=0)]
        if total is None:
            total = own
        else:
            total = [*(a + b for a, b in zip(total[:3], own[:3])), np.minimum(total[3], own[3]), np.maximum(total[4], own[4])]
    if total is not None:
        names = ["dim", "n", "high", "low", "least", "most"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (np.arange(len(total[0])), *total)], names)


def _centre(listed: DataFrame) -> Centre | None:
    rows = listed.mapInArrow(_tally, "dim long, n long, high long, low long, least long, most long")
    whole = lambda name: F.sum(F.col(name).cast("decimal(20,0)")).alias(name)
    found = rows.groupBy("dim").agg(F.sum("n").alias("n"), whole("high"), whole("low"), F.min("least").alias("least"), F.max("most").alias("most"))
    found = found.orderBy("dim").collect()  # one row per dimension
    if not found:
        return None
    n = found[0]["n"]
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in found]
    spread = max(max(abs(r["most"] - s // n), abs(r["least"] - s // n)) for r, s in zip(found, sums)) + 1
    exact = len(sums) * (n * spread) ** 2 < 1 << 63
    kind = np.int64 if exact else object
    stored = "<i4" if spread < 1 << 31 else "<i8"
    return Centre(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], kind), exact, stored)


def _packer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Vectors as blocks of bytes, which cost a pass next to nothing to read."""

    def run(batches):
        centre = shared.value
        rows = max(1, _BLOCK_BYTES // (8 * len(centre.whole)))
        for batch in batches:
            for at in range(0, len(batch), rows):
                apart = (_matrix(batch.column(0).slice(at, rows)) - centre.whole).astype(centre.kind)
                yield pa.RecordBatch.from_arrays([pa.array([apart.tobytes()], pa.binary())], ["rows"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], centre: Centre) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0).to_pylist():
            yield centre.rows(block)


def _multiplier(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        centre, q = shared.value
        out = np.zeros(q.shape)
        for rows in _blocks(batches, centre):
            out += rows.T @ (rows @ q)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["block"])

    return run


def _moments(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sum of squared entries, and sums and products of whitened rows."""

    def run(batches):
        centre, projection = shared.value
        k = projection.shape[1]
        out = np.zeros((k + 2, max(k, 1)))
        for rows in _blocks(batches, centre):
            white = rows @ projection
            out[:k, :k] += white.T @ white
            out[k, :k] += white.sum(axis=0)
            out[k + 1, 0] += (rows * rows).sum()
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["block"])

    return run


class Covariance:
    """V of the listed vectors, known by its products alone."""

    def __init__(self, listed: DataFrame, centre: Centre):
        self.listed, self.centre, self.passes = listed, centre, 0
        self.parts = listed.rdd.getNumPartitions()

    @property
    def size(self) -> int:
        return len(self.centre.whole)

    def _gathered(self, kernel: Callable, block: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        shared = self.listed.sparkSession.sparkContext.broadcast((self.centre, block))
        self.passes += 1
        out = summed_blocks(self.listed.mapInArrow(kernel(shared), "block binary"), self.parts, shape)
        shared.destroy()
        return out / self.centre.n

    def times(self, q: np.ndarray) -> np.ndarray:
        return self._gathered(_multiplier, q, q.shape)

    def moments(self, projection: np.ndarray) -> tuple[float, np.ndarray]:
        """V's trace, and the covariance of the rows times ``projection``."""
        k = projection.shape[1]
        out = self._gathered(_moments, projection, (k + 2, max(k, 1)))
        return out[k + 1, 0], out[:k, :k] - np.outer(out[k, :k], out[k, :k])


def lanczos(times: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int) -> tuple[float, float, np.ndarray]:
    """Bounds on the ends of a spectrum, and the vector that came nearest to its upper one."""
    basis, alpha, beta = [start / np.linalg.norm(start)], [], []
    for _ in range(min(steps, len(start))):
        w = times(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for _ in range(2):  # orthogonal to all before it, to double precision
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-14 * max(map(abs, alpha)) or len(basis) == len(start):
            break
        basis.append(w / beta[-1])
    k = len(alpha)
    values, inner = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: k - 1], 1) + np.diag(beta[: k - 1], -1))
    rest = beta[k - 1] * np.abs(inner[-1])
    return float(values[0] - rest[0]), float(values[-1]), np.array(basis[:k]).T @ inner[:, -1]


def chebyshev(times: Callable, block: np.ndarray, product: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The polynomial of V that is small on [low, high] and one at ``top``, times ``block``.

    ``product`` is V times ``block``. Scaled at every step, so nothing overflows.
    """
    half, mid = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - mid)
    before, now = block, (product - mid * block) * (sigma / half)
    for _ in range(degree - 1):
        scale = 1 / (2 / first - sigma)
        before, now = now, (times(now) - mid * now) * (2 * scale / half) - sigma * scale * before
        sigma = scale
    return now


@dataclass(frozen=True)
class Spectrum:
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    rounds: int


def leading(times: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 12) -> Spectrum:
    """The leading eigenpairs of a positive semidefinite matrix that only ``times`` knows.

    Every pair is certified: its residual is below ``RESIDUAL`` of the largest
    eigenvalue, and no larger eigenvalue is left. Where rounds don't get there,
    the block is widened; as wide as the matrix it gives all pairs at once.
    """
    random = np.random.default_rng(seed)
    wanted, width = min(wanted, size), min(size, 2 * wanted)
    low = 0.0 if width == size else max(0.0, lanczos(times, random.standard_normal(size), BOUND_STEPS)[0])
    block = np.linalg.qr(random.standard_normal((size, width)))[0]
    best, still = math.inf, 0
    for round_ in range(1, 1_000_000):
        product = times(block)
        values, turn = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        top = values[0]
        if top <= 0:
            return Spectrum(np.empty(0), np.empty((size, 0)), 0.0, round_)
        count = int((values[:wanted] > RANK * top).sum())
        residual = float(np.linalg.norm(product[:, :count] - block[:, :count] * values[:count], axis=0).max()) / top
        # Rounding may end progress a little above the goal, when there are very many rows.
        still = still + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if residual <= RESIDUAL or (still >= 3 and residual <= 100 * RESIDUAL) or width == size:
            found = block[:, :count]
            outside = lambda q, u=found: (lambda y: y - u @ (u.T @ y))(times(q - u @ (u.T @ q)))
            if width == size or count < wanted:
                return Spectrum(values[:count], found, residual, round_)
            start = random.standard_normal(size)
            _, most, vector = lanczos(outside, start - found @ (found.T @ start), CHECK_STEPS)
            if most <= values[count - 1] + 10 * RESIDUAL * top:
                return Spectrum(values[:count], found, residual, round_)
            block[:, -1], still, best = vector, 0, math.inf  # one was missed
            block = np.linalg.qr(block)[0]
            continue
        if still >= 5 or round_ % ROUNDS == 0:
            width, still, best = min(size, 2 * width), 0, math.inf
            more = random.standard_normal((size, width - block.shape[1]))
            block = np.linalg.qr(np.hstack([block, more]))[0]
            continue
        high = max(values[-1], 1e-9 * top)
        floor = min(low, high / 2)
        half, mid = (high - floor) / 2, (high + floor) / 2
        grows = math.log(max(1.01, (top - mid) / half + math.sqrt(max(0.0, ((top - mid) / half) ** 2 - 1))))
        degree = max(2, min(DEGREE, int(math.log(GROWTH) / grows)))
        if top - mid <= half * 1.0000001:  # a flat spectrum leaves nothing to damp
            block = np.linalg.qr(product)[0]
            continue
        block = np.linalg.qr(chebyshev(times, block, product, floor, high, top, degree))[0]
    raise AssertionError("unreachable")


@dataclass(frozen=True)
class Whitening:
    """What rows are projected with. ``vectors`` has a unit eigenvector per column."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    residual: float
    passes: int


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from each distinct vector of ``x`` once; None where there is none.

    Components of (numerically) no variance don't count, so there may be fewer
    than asked for: none at all for a single vector.
    """
    spark = x.sparkSession
    ship(spark)
    with scratch(spark) as held:
        listed = held.store(x.select("x").distinct())
        centre = _centre(listed)
        if centre is None:
            return None
        shared = spark.sparkContext.broadcast(centre)
        covariance = Covariance(held.store(listed.mapInArrow(_packer(shared), "rows binary")), centre)
        found = leading(covariance.times, covariance.size, components)
        signs = np.sign(found.vectors[np.abs(found.vectors).argmax(axis=0), np.arange(found.vectors.shape[1])])
        vectors = found.vectors * signs
        trace, white = covariance.moments(vectors / np.sqrt(found.values))
        error = float(np.abs(white - np.eye(len(white))).max()) if len(white) else 0.0
        explained = found.values / trace if trace else found.values
        return Whitening(centre, found.values, vectors, explained, error, found.residual, covariance.passes)


_ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"


def _projected(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        model = shared.value
        k, projection = len(model.values), model.vectors / np.sqrt(model.values)
        for batch in batches:
            for at in range(0, len(batch), _BLOCK_ROWS):
                some = batch.slice(at, _BLOCK_ROWS)
                numerators = model.centre.numerators(_matrix(some.column(1)))
                squares = (numerators * numerators).sum(axis=1)
                if not model.centre.exact:
                    squares = [s if s < 1 << 63 else None for s in squares]
                ids = some.column(0).take(pa.array(np.repeat(np.arange(len(some)), k)))
                white = (numerators / model.centre.n).astype(np.float64) @ projection
                each = lambda values: pa.array(np.tile(values, len(some)))
                deviations = pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        each(np.arange(1, k + 1, dtype=np.int32)),
                        each(np.full(k, model.centre.n, np.int64)),
                        deviations,
                        pa.array(white.ravel()),
                        each(model.explained),
                        each(np.full(k, model.identity_error)),
                        each(model.values),
                    ],
                    [part.split()[0] for part in _ROW.split(", ")],
                )

    return run


def whitened(x: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per row of ``x(vec_id, x)`` and component of ``model``; none without a model.

    ``deviation`` is NULL where it does not fit 64 bits.
    """
    spark = x.sparkSession
    if model is None:
        return spark.createDataFrame([], _ROW)
    shared = spark.sparkContext.broadcast(model)
    return x.select("vec_id", "x").mapInArrow(_projected(shared), _ROW)


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of all usable rows of ``vectors``, fitted to each distinct vector once.

    Rows go whose vector is NULL, empty, of another than the commonest length, or
    holds NULL, NaN or an infinity. Repeated rows and rows without an id are all
    returned. Scaled entries beyond ``LARGEST`` count as it. An empty table, or
    one whose vectors are all alike, gives no rows. Other columns play no part.
    """
    x = quantised(vectors, id_column, column)
    return whitened(x, fit(x, components))
