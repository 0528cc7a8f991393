"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.shared import ROWS_AT_ONCE, Staged, map_batches, ship_package
from lineledger.session import settings

_LONG = 2.0**63
_EPS = np.finfo(float).eps
_ROUNDING = 64 * _EPS  # of a diagonal entry, per column: what sums over the rows and the steps before may be off by
_SAFE = 2**31  # sums of squares of smaller numbers than this, few thousand of them, stay below what a long holds
_MOST_SWEEPS = 100  # of all pairs of columns; ten are enough for hundreds of them


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``g`` with ``g @ g.T == a`` for a symmetric matrix without negative eigenvalues; one column per unit of rank.

    The largest remaining diagonal entry is the next pivot, so that columns fall in size; rows stay in the order of
    ``a``. A diagonal entry of which no more than rounding remains is no pivot; each is held against its own size,
    so that directions of a small scale count, too.
    """
    left, columns = np.array(a, float), []
    least = _ROUNDING * len(a) * left.diagonal()
    for _ in range(len(a)):
        rest = np.where(left.diagonal() > least, left.diagonal(), 0.0)
        pivot = int(rest.argmax())
        if not rest[pivot]:
            break
        column = left[:, pivot] / np.sqrt(left[pivot, pivot])
        left -= np.outer(column, column)
        left[pivot, :] = left[:, pivot] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(len(a), len(columns))


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs below ``n`` in rounds of disjoint pairs, as in a tournament where one stays and the others move on."""
    players, rounds = list(range(n + n % 2)), []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:])) if max(a, b) < n]
        rounds.append(tuple(np.array(side, int) for side in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2)
        players.insert(1, players.pop())
    return rounds


def one_sided_jacobi(g: np.ndarray) -> np.ndarray:
    """``g`` times a rotation, with columns at right angles to each other, the longest first.

    Pairs of columns are rotated until every pair is orthogonal to rounding; the disjoint pairs of a round are
    rotated together. The squared lengths of the columns are the eigenvalues of ``g @ g.T``.
    """
    g = np.array(g, float)
    rounds, close = _rounds(g.shape[1]), len(g) * _EPS
    for _ in range(_MOST_SWEEPS if g.shape[1] > 1 else 0):
        turned = False
        for p, q in rounds:
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            off = np.abs(ab) > close * np.sqrt(aa * bb)
            if not off.any():
                continue
            turned, p, q, a, b = True, p[off], q[off], a[:, off], b[:, off]
            slope = (bb[off] - aa[off]) / (2 * ab[off])
            t = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1.0, slope))
            c = 1 / np.hypot(1.0, t)
            g[:, p], g[:, q] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    else:
        if g.shape[1] > 1:
            raise RuntimeError("the columns did not become orthogonal")
    return g[:, np.argsort(-(g * g).sum(axis=0), kind="stable")]


@dataclass(frozen=True)
class Model:
    """What whitens the vectors of one length: ``n`` distinct ones, their exact sums, the components and eigenvalues."""

    n: int
    sums: tuple[int, ...]
    mean: np.ndarray
    components: np.ndarray  # one per row, of length 1, the largest entry positive
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.components.T / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the entries of ``(n * x - S) ** 2``, exact; None where a long can't hold it."""
        largest = np.abs(x).max(initial=0).astype(float) * self.n + max(map(abs, self.sums), default=0)
        if largest < _SAFE and largest * largest * max(x.shape[1], 1) < _LONG:
            return (np.square(self.n * x - np.array(self.sums, np.int64)).sum(axis=1)).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d < _LONG else None for d in exact]


def factor(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components, eigenvalues and shares of the trace of the covariance ``scatter / n``."""
    covariance = scatter / n
    turned = one_sided_jacobi(pivoted_cholesky(covariance))[:, :components]
    lengths = np.sqrt((turned * turned).sum(axis=0))
    units = (turned / lengths).T
    signs = np.sign(units[np.arange(len(units)), np.abs(units).argmax(axis=1)]) if len(units) else np.zeros(0)
    trace = covariance.diagonal().sum()
    return units * signs[:, None], lengths**2, lengths**2 / trace if len(units) else lengths


def scaled(vector: Column, scale: int) -> Column:
    """The entries as ``floor(scale * c)``; null where an entry is null, not finite or beyond a long."""
    entries = F.transform(vector, lambda c: c.cast("double") * F.lit(float(scale)))
    good = F.forall(entries, lambda c: F.coalesce(F.abs(c) < F.lit(_LONG), F.lit(False)) & ~F.isnan(c))
    return F.when(good, F.transform(entries, lambda c: F.floor(c)))


def _matrix(rows: pa.Array, size: int) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)


def _by_size(rows: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length of the vectors, their places in the batch, and the vectors as rows of a matrix."""
    sizes = np.diff(rows.offsets.to_numpy())
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        yield size, places, _matrix(rows.take(pa.array(places)), size)


def _per_task(fit: DataFrame, moments, schema: str) -> DataFrame:
    """What ``moments(size, x)`` of each length adds up to over the rows of a task, as rows ``size, i, j, v``."""
    ship_package(fit.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _by_size(batch.column(0)):
                totals[size] = totals.get(size, 0) + moments(size, x)
        for size, total in sorted(totals.items()):
            i, j = np.indices(total.shape).reshape(2, -1) if total.ndim == 2 else (np.arange(len(total)),) * 2
            columns = [pa.array(np.full(total.size, size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))]
            kind = pa.decimal128(38, 0) if total.dtype == object else pa.float64()
            columns.append(pa.array(total.ravel().tolist(), kind))
            yield pa.RecordBatch.from_arrays(columns, names=["size", "i", "j", "v"])

    return fit.select("x").mapInArrow(run, schema)


def _added(moments: DataFrame) -> dict[int, np.ndarray]:
    """Sums over the tasks; an array for each length of the vectors, no larger than the square of that length."""
    spark, batch = moments.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    found: dict[int, dict] = {}
    with settings(spark, {batch: str(min(ROWS_AT_ONCE, int(spark.conf.get(batch))))}):
        for size, i, j, v in moments.groupBy("size", "i", "j").agg(F.sum("v")).collect():
            found.setdefault(size, {})[i, j] = v
    out = {}
    for size, entries in found.items():
        last = max(entries)
        square = np.empty((last[0] + 1, last[1] + 1), object)
        for place, v in entries.items():
            square[place] = v
        out[size] = square
    return out


def _count_and_sums(size: int, x: np.ndarray) -> np.ndarray:
    """How many, and their sums, in whole numbers of any size."""
    small = np.abs(x).max(initial=0) < 2**40  # a batch has some thousand rows
    sums = x.sum(axis=0).tolist() if small else [sum(column) for column in x.T.tolist()]
    return np.array([len(x), *sums], object)


def fit_models(fit: DataFrame, components: int) -> dict[int, Model]:
    """A model for each length of the distinct vectors ``fit.x``, which has to be a stored table.

    Three passes: counts and sums, the scatter around the mean, and the covariance of what the model whitens. A task
    adds up its rows and sends one matrix per length; the tasks' matrices are added by a shuffle on their places. What
    reaches the driver is at most the square of the longest vector for each length, whatever the number of rows.
    """
    counted = _added(_per_task(fit, _count_and_sums, "size int, i int, j int, v decimal(38,0)"))
    counts = {size: [int(v) for v in square.diagonal()] for size, square in counted.items()}
    means = {size: np.array([s / n for s in sums]) for size, (n, *sums) in counts.items()}

    def scatter(size: int, x: np.ndarray) -> np.ndarray:
        centred = x - means[size]
        return centred.T @ centred

    sized = fit.where(F.size("x") > 0)
    scatters = _added(_per_task(sized, scatter, "size int, i int, j int, v double"))
    models = {}
    for size, square in scatters.items():
        n, *sums = counts[size]
        units, values, explained = factor(square.astype(float), n, components)
        models[size] = Model(n, tuple(sums), means[size], units, values, explained, 0.0)
    models = {size: model for size, model in models.items() if len(model.values)}

    def whitened(size: int, x: np.ndarray) -> np.ndarray:
        out = models[size].project(x) if size in models else np.zeros((len(x), 1))
        out = np.column_stack([np.ones(len(x)), out - centres.get(size, 0.0)])
        return out.T @ out

    centres: dict[int, np.ndarray] = {}
    for _ in range(2):  # their mean, which is rounding, and then the products around it
        products = _added(_per_task(sized, whitened, "size int, i int, j int, v double"))
        centres = centres or {s: (p[0, 1:] / p[0, 0]).astype(float) for s, p in products.items()}
    for size, model in models.items():
        covariance = products[size][1:, 1:].astype(float) / model.n
        error = float(np.abs(covariance - np.eye(len(model.values))).max())
        models[size] = Model(**{**model.__dict__, "identity_error": error})
    return models


def whiten(
    vectors: DataFrame, *carried: Column, vector_col: str = "embedding", components: int = 4, scale: int = 256
) -> DataFrame:
    """Each vector on the leading components of all distinct vectors, with variance 1 along each of them.

    An entry ``c`` counts as ``floor(scale * c)``. The model is fitted to each distinct vector once, over all rows.
    Returns the ``carried`` columns with ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error`` (:class:`Model`). Repeated rows come back as often as they are
    there, and ties of eigenvalues are in any order.

    Left out are vectors that are null or have an entry that is null, not finite or too large for a long. Vectors of
    different lengths are of different spaces, each with its own model. A space whose vectors vary in fewer directions
    than ``components`` has only so many components, none where all are equal; ``deviation`` is null where a long
    can't hold it.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.struct(*carried).alias("__row"), scaled(F.col(vector_col), scale).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    fit = Staged(spark, "whitening")(rows.select("x").distinct(), "fit")
    shared = spark.sparkContext.broadcast(fit_models(fit, components))
    fields = rows.schema["__row"].dataType.simpleString()

    def batch(own, x):
        for size, places, matrix in _by_size(x):
            model = shared.value.get(size)
            if model is None:
                continue
            count = len(model.values)
            times = np.repeat(places, count)
            yield {
                "__row": own.take(pa.array(times)),
                "component": np.tile(np.arange(1, count + 1, dtype=np.int32), len(places)),
                "n": np.full(len(times), model.n),
                "deviation": [d for d in model.deviation(matrix) for _ in range(count)],
                "whitened": model.project(matrix).ravel(),
                "explained": np.tile(model.explained, len(places)),
                "identity_error": np.full(len(times), model.identity_error),
            }

    out = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    found = map_batches(rows, {"__row": fields, "x": "array<bigint>"}, batch, f"__row {fields}, {out}")
    return found.select("__row.*", *found.columns[1:])
