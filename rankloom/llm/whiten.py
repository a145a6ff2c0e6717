"""Whitening of embeddings by polarisation: covariances from variances of sums.

Entries become whole numbers, so every sum is exact. For each dimension and for the sum
of each two dimensions, tasks add up the squares of the centred values; the variance of
a sum less the variances of its terms is twice their covariance. These differences fill
the covariance matrix, whose eigenvectors the driver finds (it is dimensions squared,
whatever the rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.session import cleaned, stash

SCALE = 256.0
LIMB_BITS, LIMBS = 40, 4  # whole numbers below 2**182 travel as four longs, which tasks add up apart
_MASK = (1 << LIMB_BITS) - 1
_LIMB_NAMES = [f"{kind}{i}" for kind in ("a", "b") for i in range(LIMBS)]


def usable(vector: Column) -> Column:
    """True for a vector that is not null and whose entries are finite and, scaled, fit in a long."""
    entry = lambda c: c.isNotNull() & (F.abs(F.coalesce(c.cast("double"), F.lit(float("nan")))) < 2.0**63 / SCALE)
    return F.coalesce(F.forall(vector, entry), F.lit(False))


def whole(vector: Column) -> Column:
    """Entries as whole numbers: the floor of 256 times the entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def _limbs(number: int) -> list[int]:
    """Parts of 40 bits from the lowest; the last holds the rest and the sign."""
    return [*((number >> (LIMB_BITS * i)) & _MASK for i in range(LIMBS - 1)), number >> (LIMB_BITS * (LIMBS - 1))]


def _number(limbs: list[int]) -> int:
    return sum(int(v) << (LIMB_BITS * i) for i, v in enumerate(limbs))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() :][: len(column) * dims].reshape(-1, dims)


def _exact_sums(x: np.ndarray) -> tuple[list[int], list[int]]:
    """(sums, sums of squares) of the columns as Python numbers, whatever their size."""
    bound = int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))))
    if x.dtype != object and bound * bound * max(len(x), 1) >= 1 << 63:
        x = x.astype(object)
    return [int(v) for v in x.sum(axis=0)], [int(v) for v in (x * x).sum(axis=0)]


def pair_sums(u: np.ndarray) -> tuple[list[int], list[int]]:
    """Exact (sum, sum of squares) for every dimension and, in order (i, j > i), every sum of two dimensions."""
    dims = u.shape[1]
    if np.abs(u).max(initial=0) >= 1 << 61:
        u = u.astype(object)
    first, second = _exact_sums(u)
    for i in range(dims - 1):
        a, b = _exact_sums(u[:, i + 1 :] + u[:, i : i + 1])
        first += a
        second += b
    return first, second


def _added(rows: DataFrame, width: int) -> tuple[list[int], list[int]]:
    """Add the limbs of (k, a0.., b0..) over tasks; ``width`` numbers of each kind reach the driver."""
    totals = rows.groupBy("k").agg(*[F.sum(c).alias(c) for c in _LIMB_NAMES]).collect()
    a, b = [0] * width, [0] * width
    for row in totals:
        a[row["k"]] = _number([row[f"a{i}"] for i in range(LIMBS)])
        b[row["k"]] = _number([row[f"b{i}"] for i in range(LIMBS)])
    return a, b


@dataclass
class Whitening:
    """What a task needs to whiten vectors: some numbers a dimension."""

    n: int
    sums: list[int]
    axes: np.ndarray  # dimensions x components
    values: np.ndarray  # eigenvalues of the components
    explained: np.ndarray
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: the whole part of the mean first, so that large entries lose nothing."""
        whole_part = np.array([s // self.n for s in self.sums], object)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        near = x - whole_part.astype(np.int64) if np.abs(x).max(initial=0) < 1 << 61 else x.astype(object) - whole_part
        return near.astype(np.float64) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values, NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (self.centred(x) @ self.axes) / np.sqrt(self.values)
        out[:, ~(self.values > 0)] = np.nan
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n * x - sums)**2 of each row, null where a long cannot hold it."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        exact = bound * bound * max(x.shape[1], 1) < 1 << 63
        y = x * self.n - np.array(self.sums, np.int64) if exact else x.astype(object) * self.n - np.array(self.sums, object)
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def fit(vectors: DataFrame, dims: int, components: int = 4) -> Whitening | None:
    """Fit on ``vectors``, a stored table of different long arrays ``x`` of ``dims`` entries; None without rows.

    Two passes: sums, then squares of values from which the mean's whole part is taken
    off. What that leaves of the mean is less than one and is taken off the finished
    sums exactly, for the square of n * u - r is n * n * u * u - 2 * n * r * u + r * r.
    """

    def column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            x = _rows(batch.column(0), dims)
            n += len(x)
            total = [t + a for t, a in zip(total, _exact_sums(x)[0])]
        yield _limb_batch([*total, n], [0] * (dims + 1))

    schema = "k int, " + ", ".join(f"{c} long" for c in _LIMB_NAMES)
    sums, _ = _added(vectors.select("x").mapInArrow(column_sums, schema), dims + 1)
    n = sums.pop()
    if not n:
        return None
    middle = [s // n for s in sums]
    width = dims + dims * (dims - 1) // 2

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = [0] * width, [0] * width
        for batch in batches:
            x = _rows(batch.column(0), dims)
            for a in range(0, len(x), 4096):
                part = x[a : a + 4096]
                small = np.abs(part).max(initial=0) < 1 << 60 and max(map(abs, middle)) < 1 << 60
                u = part - np.array(middle, np.int64) if small else part.astype(object) - np.array(middle, object)
                one, two = pair_sums(u)
                first = [t + v for t, v in zip(first, one)]
                second = [t + v for t, v in zip(second, two)]
        yield _limb_batch(first, second)

    linear, square = _added(vectors.select("x").mapInArrow(squares, schema), width)
    rest = [s - n * m for s, m in zip(sums, middle)]
    pairs = [(i, i) for i in range(dims)] + [(i, j) for i in range(dims) for j in range(i + 1, dims)]
    spread = []  # exact sums of squared centred values, times n * n
    for (i, j), a, b in zip(pairs, linear, square):
        r = rest[i] if i == j else rest[i] + rest[j]
        spread.append(n * n * b - 2 * n * r * a + n * r * r)
    cov = np.zeros((dims, dims))
    for (i, j), q in zip(pairs, spread):
        cov[i, j] = cov[j, i] = q / n**3 if i == j else (q - spread[i] - spread[j]) / (2 * n**3)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = sum(spread[:dims]) / n**3
    values = np.where(values[order] > trace * dims * 1e-14, values[order], 0.0)
    explained = values / trace if trace else np.full(len(order), np.nan)
    model = Whitening(n, sums, axes[:, order], values, explained)
    model.identity_error = _identity_error(vectors, dims, model)
    return model


def _limb_batch(a: list[int], b: list[int]) -> pa.RecordBatch:
    """A task's exact sums as rows (k, limbs)."""
    columns = list(zip(*[(*_limbs(x), *_limbs(y)) for x, y in zip(a, b)]))
    arrays = [pa.array(range(len(a)), pa.int32()), *[pa.array(c, pa.int64()) for c in columns]]
    return pa.RecordBatch.from_arrays(arrays, ["k", *_LIMB_NAMES])


def _identity_error(vectors: DataFrame, dims: int, model: Whitening) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity), over components with variance."""
    good = np.flatnonzero(model.values > 0)
    if not len(good):
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(good), len(good)))
        for batch in batches:
            w = model.project(_rows(batch.column(0), dims))[:, good]
            total += w.T @ w
        places = [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(places, ["k", "v"])

    sums = vectors.select("x").mapInArrow(products, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    found = np.zeros(len(good) ** 2)
    for row in sums:
        found[row["k"]] = row["v"]
    return float(np.abs(found.reshape(len(good), -1) / model.n - np.eye(len(good))).max())


@cleaned
def whiten(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 4
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component.

    Left out are rows whose vector is null, is empty or has a null, a NaN, an infinite
    entry or one of 2**55 or more, and rows of another length than most usable rows have
    (the longer at a tie). The others stay, repeated rows and null ids among them; each
    different vector counts once in the fit. A component without variance has a null
    ``whitened``; without any variance ``explained`` and ``identity_error`` are null.
    A ``deviation`` that no long can hold is null. An empty table gives an empty result.
    """
    rows = df.filter(usable(F.col(vector)) & (F.size(vector) > 0))
    rows = rows.select(F.col(id).alias("id"), whole(F.col(vector)).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    schema = f"id {df.schema[id].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id)
    dims = lengths["dims"]
    rows = rows.filter(F.size("x") == dims)
    model = fit(stash(rows.select("x").distinct(), "whiten-list"), dims, components)
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        count = len(m.values)
        for batch in batches:
            x = _rows(batch.column(1), dims)
            k = len(x)
            each = np.repeat(np.arange(k), count)
            error = pa.array([m.identity_error] * (k * count), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), k)),
                    pa.array(np.full(k * count, m.n)),
                    pa.array(m.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(m.project(x).ravel(), from_pandas=True),
                    pa.array(np.tile(m.explained, k), from_pandas=True),
                    error,
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
