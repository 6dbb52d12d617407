"""Whitening of embeddings: leading components by Chebyshev-filtered subspace iteration.

The vectors to fit on are written once, as blocks of whole numbers. A pass multiplies the
centred covariance with a narrow block of columns: every task adds up its part of X'(XQ)
and sends as many numbers as the block has, however many rows it read. Between two
Rayleigh-Ritz steps a polynomial in the covariance, built by Chebyshev's recurrence from
such passes, damps what lies between a lower bound of the spectrum and the block's
smallest value. The iteration ends when the residuals are small against the gaps between
the values, and filtered random directions outside the block show nothing larger.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import extended, ship, written

COMPONENTS = 4
SCALE = 256
#: Columns of the block beyond the wanted ones, steps of the bound, and rounds at most.
GUARD, STEPS, ROUNDS = 12, 12, 60
#: Most that a filter may raise one direction over another, so that rounding hides none.
GAIN, DEGREE = 1e8, 20
#: Error of a component at which it is done, and what rounding leaves of a residual.
ERROR, ROUNDING = 1e-12, 3e-14
#: Shares of the variance below this are rounding: such a component has none.
LEAST_SHARE = 1e-13
_ROWS = 4096
_LONG = (1 << 63) - 1

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Fit:
    """What whitening needs: rows fitted, their sums, and the components with their variances."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None
    certified: bool

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def real(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > LEAST_SHARE * self.trace


# --- rows -----------------------------------------------------------------------


def scaled(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector has neither nulls nor infinite entries, with x, its whole numbers."""

    def finite(e: Column) -> Column:
        return e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))

    vector = F.col(column)
    rows = vectors.filter(vector.isNotNull() & F.forall(vector, lambda e: F.coalesce(finite(e.cast("double")), F.lit(False))))
    return rows.select("vec_id", F.transform(vector, lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("x"))


def even(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with zeros after the end of shorter vectors."""
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def blocks(rows: DataFrame, width: int) -> DataFrame:
    """Each distinct vector of ``rows`` once, in blocks of the narrowest whole numbers that hold them."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                x = _matrix(batch.column("x").slice(low, _ROWS), width)
                kind = np.result_type(np.min_scalar_type(x.min()), np.min_scalar_type(x.max()), np.int16)
                kind = kind if kind.kind == "i" else np.dtype(np.int64)
                yield pa.RecordBatch.from_pydict({"rows": [len(x)], "kind": [kind.str], "x": [x.astype(kind).tobytes()]})

    return rows.select("x").distinct().mapInArrow(run, "rows long, kind string, x binary")


def _blocks_of(batch: pa.RecordBatch, width: int):
    for kind, data in zip(batch.column("kind").to_pylist(), batch.column("x").to_pylist()):
        yield np.frombuffer(data, kind).reshape(-1, width)


# --- passes ---------------------------------------------------------------------


def _added(table: DataFrame, sums: Callable[[np.ndarray], np.ndarray], height: int, width: int, columns: int) -> np.ndarray:
    """The sum over all blocks of a matrix that is made from each, one matrix a task."""

    def run(batches):
        total = np.zeros((height, columns))
        for batch in batches:
            for x in _blocks_of(batch, width):
                total += sums(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(height)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "y"]
        )

    parts = table.select("kind", "x").mapInArrow(run, "i long, y array<double>")
    total = parts.groupBy("i").agg(F.array(*(F.sum(F.col("y")[j]) for j in range(columns))).alias("y"))
    out = np.zeros((height, columns))
    for row in total.collect():  # height rows
        out[row.i] = row.y
    return out


def sums_of(table: DataFrame, width: int) -> tuple[int, list[int]]:
    """Vectors in the blocks, and their exact sum."""

    def run(batches):
        for batch in batches:
            for x in _blocks_of(batch, width):
                x = x.astype(np.int64)
                # Halves, so that no sum of 64-bit numbers overflows.
                halves = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), *map(pa.array, halves)], names=["i", "high", "low"])

    halves = table.select("kind", "x").mapInArrow(run, "i long, high long, low long")
    whole = halves.groupBy("i").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
    sums = {r.i: (int(r.high) << 32) + int(r.low) for r in whole.collect()}  # width rows
    return table.agg(F.sum("rows")).first()[0] or 0, [sums.get(i, 0) for i in range(width)]


# --- components -----------------------------------------------------------------


def lower_bound(product: Product, size: int, rng: np.random.Generator, steps: int = STEPS) -> float:
    """Of all values, from a few Lanczos steps: the least that they show, less its residual; 0 at least."""
    basis = np.zeros((size, 0))
    v = rng.standard_normal(size)
    v /= np.linalg.norm(v)
    diagonal, beside = [], []
    for _ in range(min(steps, size)):
        basis = np.column_stack((basis, v))
        w = product(v[:, None])[:, 0]
        diagonal.append(v @ w)
        for _ in range(2):
            w -= basis @ (basis.T @ w)
        beside.append(np.linalg.norm(w))
        if beside[-1] <= ROUNDING * max(diagonal):
            return 0.0  # the start lies in part of the space only, which tells nothing of the rest
        v = w / beside[-1]
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1))
    return max(0.0, values[0] - beside[-1])


def filtered(product: Product, block: np.ndarray, image: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of the matrix times ``block``, whose product is ``image``: small from ``low``
    to ``high``, and scaled to about 1 at ``top``. Its degree keeps to ``GAIN``."""
    centre, half = (high + low) / 2, (high - low) / 2
    degree = min(DEGREE, max(2, int(math.acosh(GAIN) / math.acosh((top - centre) / half))))
    first = sigma = half / (top - centre)
    before, now = block, (image - centre * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (product(now) - centre * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def _gaps(values: np.ndarray, count: int) -> np.ndarray:
    """From each of the first values to the nearest that differs; equal ones span a space of their own."""
    apart = np.abs(values[:count, None] - values[None, :])
    apart[apart <= 1e-9 * values[0]] = values[0]
    return apart.min(axis=1)


def leading(product: Product, size: int, count: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """The largest eigenvalues of a positive semidefinite matrix that is known by its products, their
    eigenvectors, and whether they are certified."""
    rng = np.random.default_rng(12)
    width = min(size, count + GUARD)
    floor = lower_bound(product, size, rng) if width < size else 0.0
    block = np.linalg.qr(rng.standard_normal((size, width)))[0]
    last = math.inf
    for _ in range(ROUNDS):
        image = product(block)
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        if values[0] <= 0:
            return np.zeros(count), block[:, :count], True
        left = np.linalg.norm(image - block * values, axis=0)[:count]
        error = (left / _gaps(values, count)).max()
        small = left.max() <= ROUNDING * values[0] * math.sqrt(size)
        if error <= ERROR or small or (error <= 1e-8 and error > last / 2):
            if width == size:
                return values[:count], block[:, :count], True
            other, value = _beyond(product, block, floor, values, rng)
            if value <= values[count - 1] * (1 + 1e-9):
                return values[:count], block[:, :count], True
            block[:, -other.shape[1] :] = other  # a direction that the block had missed
            block = np.linalg.qr(block)[0]
            last = math.inf
            continue
        last = error
        low, high = floor, values[-1]
        if high <= low:
            low = floor = 0.0
        if high <= 1e-9 * values[0]:
            block = np.linalg.qr(image)[0]
        else:
            block = np.linalg.qr(filtered(product, block, image, low, high, values[0]))[0]
    warnings.warn(f"components are not certified: an error of {error:.1e} is left", stacklevel=2)
    return values[:count], block[:, :count], False


def _beyond(product: Product, block: np.ndarray, floor: float, values: np.ndarray, rng) -> tuple[np.ndarray, float]:
    """Filtered random directions outside a block, and an upper bound of the largest value they show."""
    other = rng.standard_normal((len(block), min(2, len(block) - block.shape[1])))

    def outside(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = np.linalg.qr(x - block @ (block.T @ x))[0]
        return x

    other = outside(other)
    low, high = (floor, values[-1]) if values[-1] > floor else (0.0, values[-1])
    if high > 1e-9 * values[0]:
        other = outside(filtered(product, other, product(other), low, high, values[0]))
    image = product(other)
    inner = other.T @ image
    shown, turn = np.linalg.eigh((inner + inner.T) / 2)
    # The block's own directions are no news; what is left of the image outside it is.
    rest = image @ turn - (other @ turn) * shown
    rest -= block @ (block.T @ rest)
    return other, float((shown + np.linalg.norm(rest, axis=0) ** 2 / max(values[0], 1e-300)).max())


def fit(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> Fit | None:
    """Fits on each distinct whole-number vector of ``vectors`` once; None if there is no vector with entries."""
    ship(vectors.sparkSession)
    rows = scaled(vectors, column)
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return None
    table = written(blocks(even(rows, width), width))
    n, sums = sums_of(table, width)
    context = vectors.sparkSession.sparkContext
    mean = np.array([s / n for s in sums])
    squares = _added(table, lambda x: np.square(x - mean).sum(axis=0)[:, None], width, width, 1)
    trace = float(squares.sum()) / n

    def product(block: np.ndarray) -> np.ndarray:
        given = context.broadcast(block)

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ given.value)

        found = _added(table, part, width, width, block.shape[1]) / n
        given.destroy()
        return found

    count = min(components, width)
    values, chosen, certified = leading(product, width, count)
    found = Fit(n, sums, trace, values, chosen, None, certified)
    real = found.real
    if not real.any():
        return found
    turn = chosen[:, real] / np.sqrt(values[real])

    def moments(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ turn
        return np.vstack((y.sum(axis=0), y.T @ y))

    kept = int(real.sum())
    sums_seen = _added(table, moments, kept + 1, width, kept) / n
    covariance = sums_seen[1:] - np.outer(sums_seen[0], sums_seen[0])
    return Fit(n, sums, trace, values, chosen, float(np.abs(covariance - np.eye(kept)).max()), certified)


def whitened(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """A row for each usable vector of ``vectors`` (vec_id, and an array column) and each component.

    Entries become x = floor(256 * entry) (out of a long's range: its end). Columns vec_id,
    component (from 1, by falling variance, of the covariance of the distinct x), n (distinct
    x), deviation (the sum of squares of n * x - the sums; null where no long holds it),
    whitened (the centred x along the component, over the root of its variance), explained
    (the component's share of the variance) and identity_error (how far whitened's
    covariance over the distinct x is from the identity).

    Rows whose vector is null or holds a null, NaN or infinite entry are left out. Vectors
    shorter than the longest are filled with zeros; repeated rows have rows of their own, and
    null or repeated vec_ids are kept. Components are as many as asked for or dimensions, if
    fewer; of equal variances any turn of their space is right. A component without variance
    has whitened null; without any variance explained and identity_error are null. An empty
    table, or one of empty vectors, gives no rows. Other columns are left out. There are no texts.
    """
    rows = scaled(vectors, column)
    schema = extended(rows.drop("x"), "component int, n long, deviation long, whitened double, explained double, identity_error double")
    found = fit(vectors, components, column)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width, count, n = len(found.sums), len(found.values), found.n
    mean, real = found.mean, found.real
    turn = np.where(real, found.vectors / np.sqrt(np.where(real, found.values, 1.0)), np.nan)
    explained = [float(v) / found.trace if found.trace > 0 else None for v in np.maximum(found.values, 0)]
    error, sums = found.identity_error, found.sums

    def deviations(x: np.ndarray) -> list[int | None]:
        most = max(abs(int(x.min())), abs(int(x.max())))
        if width * (n * most + max(map(abs, sums))) ** 2 <= _LONG:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
        return [d if d <= _LONG else None for d in exact]

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                x = _matrix(part.column("x"), width)
                size = len(x)
                along = ((x - mean) @ turn).ravel()
                each = np.repeat(np.arange(size), count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * count, n)),
                        pa.array(deviations(x), pa.int64()).take(pa.array(each)),
                        pa.array(along, mask=np.isnan(along)),
                        pa.array(explained * size, pa.float64()),
                        pa.array([error] * (size * count), pa.float64()),
                    ],
                    names=schema.names,
                )

    return even(rows, width).mapInArrow(run, schema)
