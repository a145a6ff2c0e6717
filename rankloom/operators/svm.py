"""Squared-hinge linear SVM: gradients, three solvers and their traces.

Features are ``(row_id, idx, val)``, labels ``(row_id, y)`` with y of +1 or -1,
weights ``(idx, w)``. SGD, Newton and conjugate gradients keep models of up to
``rowblocks.MOST_FEATURES`` features as an array, which goes to blocks of rows that stay
where they are. Larger models, and Pegasos, take joins: a margin per row and one sum
per feature, of which only scalars reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.order import hash_key, start_value
from rankloom.operators import rowblocks
from rankloom.operators.layout import number_rows
from rankloom.operators.metrics import sign_label, squared_hinge
from rankloom.session import Stored, cleaned, durable, loop_partitions, scratch, stash, store

MOST_CLASSES = 200  # Bound on the columns of a one-vs-rest model.
TRACE_SCHEMA = "method string, iter int, grad_norm double, loss double, objective double, rel double, acc double"


def zero_weights(features: DataFrame) -> DataFrame:
    """A zero weight for every feature that occurs."""
    return features.select("idx").distinct().withColumn("w", F.lit(0.0))


def keyed_by_row(df: DataFrame, parts: int) -> DataFrame:
    """Keep a table partitioned and sorted by row, so margins need no further shuffle of it."""
    kept = df.repartition(parts, "row_id").sortWithinPartitions("row_id").persist()
    kept.count()  # later plans see the layout only once the rows are kept
    return kept


def margins(features: DataFrame, labels: DataFrame, weights: DataFrame) -> DataFrame:
    """``(row_id, y, margin)``; a row without features has margin 0."""
    sums = features.join(weights, "idx").groupBy("row_id").agg(F.sum(F.col("val") * F.col("w")).alias("margin"))
    return labels.join(sums, "row_id", "left").select("row_id", "y", F.coalesce("margin", F.lit(0.0)).alias("margin"))


def active_set(scored: DataFrame) -> DataFrame:
    """Rows on the wrong side of their margin."""
    return scored.filter(1 - F.col("y") * F.col("margin") > 0)


def row_products(features: DataFrame, vector: DataFrame, column: str) -> DataFrame:
    """Features with ``dot``, the product of their row with ``vector``.

    The window spans one row's features only and reuses the row partitioning.
    """
    row = Window.partitionBy("row_id")
    joined = features.join(vector.select("idx", F.col(column).alias("_v")), "idx")
    return joined.withColumn("dot", F.sum(F.col("val") * F.col("_v")).over(row)).drop("_v")


def svm_gradient(
    features: DataFrame, labels: DataFrame, weights: DataFrame, total_rows: int, batch_size: int, lam: float
) -> DataFrame:
    """``(idx, w, grad)``: ``w / batch_size + 2 lam / N * X_I' (X_I w - y_I)``."""
    rows = row_products(features, weights, "w").join(labels, "row_id")
    wrong = rows.filter(1 - F.col("y") * F.col("dot") > 0)
    pull = wrong.groupBy("idx").agg(F.sum(F.col("val") * (F.col("dot") - F.col("y"))).alias("_pull"))
    grad = F.col("w") / F.lit(float(batch_size)) + F.coalesce("_pull", F.lit(0.0)) * (2.0 * lam / total_rows)
    return weights.join(pull, "idx", "left").select("idx", "w", grad.alias("grad"))


def squared_hinge_loss(scored: DataFrame, total_rows: int) -> DataFrame:
    return scored.agg(
        (F.coalesce(F.sum(squared_hinge(F.col("y"), F.col("margin"))), F.lit(0.0)) / F.lit(float(total_rows))).alias(
            "loss"
        )
    )


def svm_objective(scored: DataFrame, weights: DataFrame, total_rows: int, lam: float) -> float:
    """``|w|^2 / 2 + lam * loss``."""
    loss = squared_hinge_loss(scored, total_rows).first()[0]
    return weights.agg(F.sum(F.col("w") * F.col("w"))).first()[0] / 2 + lam * loss


def sign_accuracy(scored: DataFrame) -> DataFrame:
    hit = sign_label(F.col("margin")) == F.col("y")
    return scored.agg(F.avg(hit.cast("double")).alias("accuracy"))


@dataclass
class SvmFit:
    """Final weights and one trace row per epoch."""

    weights: DataFrame
    trace: DataFrame


class _Run:
    """Tables kept for a solver's loop, and its trace."""

    def __init__(self, method, features, labels, test_features, test_labels, lam, optimum):
        self.spark = features.sparkSession
        self.rows = labels.count()
        parts = loop_partitions(self.spark, features.count())
        self.features = keyed_by_row(features, parts)
        self.labels = keyed_by_row(labels, parts)
        self.test = None
        if test_features is not None:
            self.test = (keyed_by_row(test_features, parts), keyed_by_row(test_labels, parts))
        self.method, self.lam, self.optimum = method, lam, optimum
        self.trace: list[tuple] = []

    def record(self, epoch: int, weights: DataFrame, grad: float, loss: float, loss_scale: float) -> None:
        size = weights.agg(F.sum(F.col("w") * F.col("w"))).first()[0]
        objective = size / 2 + self.lam * loss * loss_scale
        rel = (objective - self.optimum) / self.optimum if self.optimum else None
        acc = None
        if self.test:
            acc = sign_accuracy(margins(*self.test, weights)).first()[0]
        self.trace.append((self.method, epoch, grad, loss, objective, rel, acc))

    def finish(self, weights: DataFrame) -> SvmFit:
        out = durable(weights)  # the loop's own tables go with it
        for table in (self.features, self.labels, *(self.test or ())):
            table.unpersist()
        return SvmFit(out, self.spark.createDataFrame(self.trace, TRACE_SCHEMA))


class _BlockRun:
    """Rows kept in blocks for a solver's loop, and its trace."""

    def __init__(self, method, features, labels, test_features, test_labels, lam, optimum, ids, block_rows=None, seed=0):
        self.features, self.method, self.lam, self.optimum = features, method, lam, optimum
        self.blocks = rowblocks.build(features, labels, ids, block_rows, seed)
        self.rows, self.size = self.blocks.rows, len(ids)
        self.test = None if test_features is None else rowblocks.build(test_features, test_labels, ids)
        self.trace: list[tuple] = []

    def slope(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """``X_I' (X_I w - y_I)`` over the active rows, and the loss, in one pass."""

        def part(rows: rowblocks.Rows) -> np.ndarray:
            margin = rows.dot(w)
            return np.append(*_pull(rows, margin))

        sums = self.blocks.total(part, self.size + 1)
        return sums[:-1], float(sums[-1]) / max(self.rows, 1)

    def record(self, epoch: int, w: np.ndarray, grad: float, loss: float) -> None:
        objective = float(w @ w) / 2 + self.lam * loss
        rel = (objective - self.optimum) / self.optimum if self.optimum else None
        acc = None
        if self.test is not None and self.test.rows:
            hits = self.test.total(lambda rows: np.array([((rows.dot(w) > 0) == (rows.y == 1)).sum()], float), 1)
            acc = float(hits[0]) / self.test.rows
        self.trace.append((self.method, epoch, grad, loss, objective, rel, acc))

    def finish(self, w: np.ndarray) -> SvmFit:
        out = durable(self.blocks.frame(w, "w", self.features))
        for held in (self.blocks, self.test):
            if held is not None:
                held.close()
        return SvmFit(out, out.sparkSession.createDataFrame(self.trace, TRACE_SCHEMA))


def _pull(rows: rowblocks.Rows, margin: np.ndarray) -> tuple[np.ndarray, float]:
    gap = np.maximum(1 - rows.y * margin, 0)
    return rows.back(np.where(gap > 0, margin - rows.y, 0.0)), float((gap**2).sum())


def _descend(
    weights: DataFrame, features: DataFrame, labels: DataFrame, rows: int, batch: int, lam: float, rate: float
) -> tuple[Stored, float]:
    """One gradient step; returns the new weights and the gradient norm."""
    grad = svm_gradient(features, labels, weights.select("idx", "w"), rows, batch, lam)
    moved = store(grad.select("idx", (F.col("w") - rate * F.col("grad")).alias("w"), "grad"), "weights")
    norm = math.sqrt(moved.table.agg(F.sum(F.col("grad") * F.col("grad"))).first()[0] or 0.0)
    return moved, norm


def epoch_start(seed: int, epoch: int, rows: int) -> int:
    """Rows before an epoch's batch: the first 32 bits of the md5 of ``seed:epoch``, modulo the rows."""
    return int(md5(f"{seed}:{epoch}".encode()).hexdigest()[:8], 16) % max(rows, 1)


@cleaned
def svm_pegasos(
    features: DataFrame,
    labels: DataFrame,
    lam: float,
    epochs: int = 2001,
    batch_size: int = 1000,
    learning_rate: float = 0.001,
    seed: int = 0,
    test_features: DataFrame | None = None,
    test_labels: DataFrame | None = None,
    optimum: float | None = None,
) -> SvmFit:
    """One random batch per epoch: neighbouring rows of a fixed hash order, from a place drawn for the epoch.

    Rows are numbered once and stored in that order, so an epoch reads the row
    groups of its batch. Beyond the last row a batch goes on with the first.
    """
    run = _Run("pegasos", features, labels, test_features, test_labels, lam, optimum)
    placed = number_rows(run.labels, [hash_key(seed, "row_id"), F.col("row_id")], name="pos")
    placed = stash(placed, "labels", sort_by=["pos"])
    cells = stash(run.features.join(placed.select("row_id", "pos"), "row_id"), "features", sort_by=["pos", "row_id"])
    weights = store(zero_weights(run.features), "weights")
    for epoch in range(epochs):
        rate = learning_rate / (1 + learning_rate / 100 * epoch)
        start = epoch_start(seed, epoch, run.rows)
        inside = ((F.col("pos") > start) & (F.col("pos") <= start + batch_size)) | (
            F.col("pos") <= start + batch_size - run.rows
        )
        picked = placed.filter(inside).drop("pos").persist()
        part = cells.filter(inside).drop("pos").persist()
        moved, norm = _descend(weights.table, part, picked, run.rows, batch_size, lam, rate)
        weights.drop()
        weights = moved
        now = weights.table.select("idx", "w")
        loss = squared_hinge_loss(margins(part, picked, now), run.rows).first()[0]
        scale = run.rows / batch_size
        run.record(epoch, now, norm * scale, loss, scale)
        part.unpersist()
        picked.unpersist()
    return run.finish(weights.table.select("idx", "w"))


def epoch_order(seed: int, epoch: int, rows: int, block_rows: int) -> list[int]:
    """Numbers of the blocks in the order of an epoch: by the md5 of ``seed:epoch:block``, a short last block last."""
    full = rows // block_rows
    order = sorted(range(full), key=lambda b: (md5(f"{seed}:{epoch}:block{b}".encode()).hexdigest(), b))
    return order + ([full] if rows % block_rows else [])


@cleaned
def svm_sgd(
    features: DataFrame,
    labels: DataFrame,
    lam: float,
    epochs: int = 201,
    batch_size: int = 1000,
    learning_rate: float = 0.001,
    seed: int = 0,
    repeat_tail: bool = True,
    test_features: DataFrame | None = None,
    test_labels: DataFrame | None = None,
    optimum: float | None = None,
    block_batches: int = 16,
) -> SvmFit:
    """All batches of a fresh shuffle per epoch.

    Rows are dealt once, by hash, into blocks of ``block_batches`` batches. An epoch
    permutes the blocks (:func:`epoch_order`) and the rows inside each block (by the md5
    of ``seed:epoch:row_id``), so no row is written after the start. The batches of a
    block follow one another in one task, and so do the blocks of about ``TURN_CELLS`` cells. A short last batch comes twice; when
    ``batch_size`` divides the rows there is an empty one.
    """
    ids = rowblocks.feature_ids(features)
    block_rows = batch_size * block_batches
    tables = (features, labels, test_features, test_labels, lam, optimum)
    if ids is None:
        return _sgd_by_joins(tables, epochs, batch_size, learning_rate, seed, repeat_tail, block_rows)
    run = _BlockRun("sgd", *tables, ids, block_rows, seed)
    held = run.blocks.stored.table.agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.length("at") / 4).alias("cells")).first()
    some = max(1, int(TURN_CELLS * held["blocks"] / max(1, held["cells"] or 1)))
    w = np.zeros(run.size)
    for epoch in range(epochs):
        rate = learning_rate / (1 + learning_rate / 100 * epoch)
        order = epoch_order(seed, epoch, run.rows, block_rows)
        norm = loss = 0.0
        for turn in range(0, len(order), some):
            again = repeat_tail and turn + some >= len(order)
            w, some_norm, some_loss = _block_steps(run, w, order[turn : turn + some], f"{seed}:{epoch}", batch_size, rate, again)
            norm, loss = norm + some_norm, loss + some_loss
        if repeat_tail and run.rows % batch_size == 0:
            grad = w / batch_size  # the empty batch
            w, norm = w - rate * grad, norm + float(np.sqrt(grad @ grad))
        run.record(epoch, w, norm, loss)
    return run.finish(w)


TURN_CELLS = 8_000_000  # Fixed value: packed cells that a task of SGD holds, 96 MB.


def _block_steps(
    run: _BlockRun, w: np.ndarray, blocks: list[int], shuffle: str, batch_size: int, rate: float, again: bool
) -> tuple[np.ndarray, float, float]:
    """New weights, and sums of gradient norms and losses, after the batches of some blocks, in this order; ``again`` repeats a short last one."""
    total, size, lam = run.rows, run.size, run.lam

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = {}  # as they come, which is another order
        for batch in batches:
            packed.update((block, batch.slice(i, 1)) for i, block in enumerate(batch.column(0).to_pylist()))
        now, norm, loss = w, 0.0, 0.0
        for block in blocks:
            rows = next(rowblocks.unpacked(iter([packed.pop(block)]), size))
            keys = [(md5(f"{shuffle}:{name}".encode()).hexdigest(), name) for name in rows.names]
            order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
            cuts = [order[a : a + batch_size] for a in range(0, len(order), batch_size)]
            if again and block == blocks[-1] and len(cuts[-1]) < batch_size:
                cuts.append(cuts[-1])
            for cut in cuts:
                part = rows.take(cut)
                pull, _ = _pull(part, part.dot(now))
                grad = now / batch_size + 2.0 * lam / total * pull
                now = now - rate * grad
                norm += float(np.sqrt(grad @ grad))
                loss += _pull(part, part.dot(now))[1] / total
        yield pa.RecordBatch.from_arrays([pa.array([now.tobytes()], pa.binary()), pa.array([norm]), pa.array([loss])], ["w", "norm", "loss"])

    some = run.blocks.stored.table.filter(F.col("block").isin(blocks)).coalesce(1)
    found = some.mapInArrow(steps, "w binary, norm double, loss double").first()
    return np.frombuffer(found["w"]), found["norm"], found["loss"]


def _sgd_by_joins(tables, epochs, batch_size, learning_rate, seed, repeat_tail, block_rows) -> SvmFit:
    """The same steps for a model too large for an array: the batch's rows are joined with the stored features of its block."""
    run = _Run("sgd", *tables)
    placed = number_rows(run.labels, [hash_key(seed, "row_id"), F.col("row_id")], name="pos")
    placed = placed.select("row_id", "y", F.floor((F.col("pos") - 1) / block_rows).cast("int").alias("block"))
    placed = stash(placed, "labels", sort_by=["block", "row_id"])
    cells = stash(run.features.join(placed.select("row_id", "block"), "row_id"), "features", sort_by=["block", "row_id"])
    weights = store(zero_weights(run.features), "weights")
    for epoch in range(epochs):
        rate = learning_rate / (1 + learning_rate / 100 * epoch)
        norms, losses = [], []
        order = epoch_order(seed, epoch, run.rows, block_rows)
        for turn, block in enumerate(order):
            # the window sees one block, which has at most block_rows rows
            in_block = Window.orderBy(hash_key(f"{seed}:{epoch}", "row_id"), F.col("row_id").cast("string"))
            batch = F.floor((F.row_number().over(in_block) - 1) / batch_size)
            own = placed.filter(F.col("block") == block).withColumn("batch", batch).persist()
            held = min(block_rows, run.rows - block * block_rows)
            numbers = list(range(-(-held // batch_size)))
            if repeat_tail and turn == len(order) - 1:
                numbers.append(numbers[-1] + (run.rows % batch_size == 0))
            for b in numbers:
                picked = own.filter(F.col("batch") == b).select("row_id", "y")
                part = cells.filter(F.col("block") == block).drop("block").join(picked.select("row_id"), "row_id", "left_semi")
                moved, norm = _descend(weights.table, part, picked, run.rows, batch_size, run.lam, rate)
                weights.drop()
                weights = moved
                norms.append(norm)
                losses.append(squared_hinge_loss(margins(part, picked, weights.table.select("idx", "w")), run.rows).first()[0])
            own.unpersist()
        run.record(epoch, weights.table.select("idx", "w"), sum(norms), sum(losses), 1.0)
    return run.finish(weights.table.select("idx", "w"))


def hessian_product(features: DataFrame, vector: DataFrame, column: str, scale: float) -> DataFrame:
    """``(idx, hv)``: ``v + scale * X' X v`` for the given rows."""
    rows = row_products(features, vector, column)
    back = rows.groupBy("idx").agg(F.sum(F.col("val") * F.col("dot")).alias("_xx"))
    hv = F.col(column) + scale * F.coalesce("_xx", F.lit(0.0))
    return vector.join(back, "idx", "left").select("idx", hv.alias("hv"))


def _solve(
    product: Callable[[np.ndarray], np.ndarray], d: np.ndarray, gradient: np.ndarray, tol: float, max_iter: int
) -> tuple[np.ndarray, int]:
    """``H d = -gradient`` by conjugate gradients from ``d``, with ``product`` giving ``H p``; also the iterations."""
    p = r = -gradient - product(d)
    rr, done = float(r @ r), 0
    for done in range(1, max_iter + 1):
        hp = product(p)
        curve = float(p @ hp)
        if not curve:
            break
        d, r = d + rr / curve * p, r - rr / curve * hp
        rr, before = float(r @ r), rr
        p = r + rr / before * p
        if math.sqrt(rr) < tol:
            break
    return d, done


@cleaned
def conjugate_gradient(
    features: DataFrame,
    gradient: DataFrame,
    total_rows: int,
    lam: float,
    tol: float = 0.1,
    max_iter: int = 100,
    start: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """Solve ``H d = -grad`` with ``H = I + 2 lam / N * X' X`` over the given rows.

    Returns ``(idx, d)`` and the number of iterations. A step is one pass over blocks of
    rows. For a model too large for an array, direction, residual and solution are columns
    of one table and the driver sees their dot products.
    """
    scale = 2.0 * lam / total_rows
    if start is None:
        start = gradient.select("idx", start_value("idx", 0).alias("d"))
    ids = rowblocks.feature_ids(gradient)
    if ids is not None:
        labels = features.select("row_id").distinct().withColumn("y", F.lit(0.0))
        blocks = rowblocks.build(features, labels, ids)
        first = blocks.values(start, "d"), blocks.values(gradient, "grad")
        solution, done = _solve(lambda p: p + scale * blocks.total(lambda rows: rows.back(rows.dot(p)), len(p)), *first, tol, max_iter)
        result = durable(blocks.frame(solution, "d", gradient))
        blocks.close()
        return result, done
    first = hessian_product(features, start, "d", scale)
    residual = -F.col("grad") - F.col("hv")
    stored = store(
        start.join(first, "idx")
        .join(gradient.select("idx", "grad"), "idx")
        .select("idx", "d", residual.alias("r"), residual.alias("p")),
        "direction",
    )
    rs_old = stored.table.agg(F.sum(F.col("r") * F.col("r"))).first()[0]
    done = 0
    for done in range(1, max_iter + 1):
        state = stored.table
        product = hessian_product(features, state.select("idx", "p"), "p", scale)
        both = state.join(product, "idx").persist()
        curve = both.agg(F.sum(F.col("p") * F.col("hv"))).first()[0]
        if not curve:
            both.unpersist()
            break
        alpha = rs_old / curve
        r_new = F.col("r") - alpha * F.col("hv")
        rs_new = both.agg(F.sum(r_new * r_new)).first()[0]
        moved = store(
            both.select(
                "idx",
                (F.col("d") + alpha * F.col("p")).alias("d"),
                r_new.alias("r"),
                (r_new + (rs_new / rs_old) * F.col("p")).alias("p"),
            ),
            "direction",
        )
        both.unpersist()
        stored.drop()
        stored, rs_old = moved, rs_new
        if math.sqrt(rs_new) < tol:
            break
    return stored.table.select("idx", "d"), done


@cleaned
def svm_newton(
    features: DataFrame,
    labels: DataFrame,
    lam: float,
    epochs: int = 51,
    refresh_active: bool = False,
    cg_tol: float = 0.1,
    cg_iterations: int = 100,
    test_features: DataFrame | None = None,
    test_labels: DataFrame | None = None,
    optimum: float | None = None,
) -> SvmFit:
    """Newton steps whose direction comes from conjugate gradients.

    The Hessian uses the active rows at ``w = 0``, which are all rows, unless
    ``refresh_active`` takes those of the current weights.
    """
    ids = rowblocks.feature_ids(features)
    tables = (features, labels, test_features, test_labels, lam, optimum)
    if ids is None:
        return _newton_by_joins(tables, epochs, refresh_active, cg_tol, cg_iterations)
    run = _BlockRun("newton", *tables, ids)
    scale = 2.0 * lam / max(run.rows, 1)
    w = np.zeros(run.size)
    start = ids * 7919 % 1000 / 1000.0  # as start_value
    pull, _ = run.slope(w)
    for epoch in range(epochs):
        gradient = w + scale * pull
        at = w if refresh_active else None

        def product(p: np.ndarray, at: np.ndarray | None = at) -> np.ndarray:
            def part(rows: rowblocks.Rows) -> np.ndarray:
                dots = rows.dot(p)
                return rows.back(dots if at is None else np.where(1 - rows.y * rows.dot(at) > 0, dots, 0.0))

            return p + scale * run.blocks.total(part, len(p))

        step, _ = _solve(product, start, gradient, cg_tol, cg_iterations)
        w = w + step
        pull, loss = run.slope(w)  # its sums are those of the next gradient
        run.record(epoch, w, float(np.sqrt(gradient @ gradient)), loss)
    return run.finish(w)


def _newton_by_joins(tables, epochs, refresh_active, cg_tol, cg_iterations) -> SvmFit:
    """The same steps for a model too large for an array."""
    run = _Run("newton", *tables)
    weights = durable(zero_weights(run.features))
    for epoch in range(epochs):
        with scratch(run.spark) as own:
            gradient = durable(svm_gradient(run.features, run.labels, weights, run.rows, 1, run.lam))
            norm = math.sqrt(gradient.agg(F.sum(F.col("grad") * F.col("grad"))).first()[0])
            rows = run.features
            if refresh_active:
                live = active_set(margins(run.features, run.labels, weights)).select("row_id")
                rows = run.features.join(live, "row_id", "left_semi").persist()
            step, _ = conjugate_gradient(rows, gradient, run.rows, run.lam, cg_tol, cg_iterations)
            weights = own.keep(weights.join(step, "idx").select("idx", (F.col("w") + F.col("d")).alias("w")))
            if refresh_active:
                rows.unpersist()
        loss = squared_hinge_loss(margins(run.features, run.labels, weights), run.rows).first()[0]
        run.record(epoch, weights, norm, loss, 1.0)
    return run.finish(weights)


# ---------------------------------------------------------------- one vs rest


def class_weights(labels: DataFrame, cls: str = "cls") -> dict[int, float]:
    """Balanced weight ``n / (classes * n_c)`` of each class."""
    found = labels.groupBy(cls).agg(F.count(F.lit(1)).alias("n")).limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes: one model column each would not do")
    counts = {r[cls]: r["n"] for r in found}
    n = sum(counts.values())
    return {c: n / (len(counts) * k) for c, k in sorted(counts.items())}


def _bias_column(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Add feature -1 with value 1 to every row."""
    return features.unionByName(labels.select("row_id", F.lit(-1).alias("idx"), F.lit(1.0).alias("val")))


@cleaned
def svm_multiclass_balanced(
    features: DataFrame,
    labels: DataFrame,
    cost: float = 1.0,
    newton_steps: int = 50,
    cg_steps: int = 10,
    tol: float = 1e-2,
) -> DataFrame:
    """One-vs-rest squared-hinge SVM with balanced class weights.

    ``labels`` is ``(row_id, cls)``. For each class, minimises ``|w|^2 / 2 +
    sum c * max(0, 1 - y m)^2`` with ``c`` the class weight for its own rows
    and ``cost`` for the others; the bias is a feature of value 1, index -1.
    All classes run in the same jobs, one column each, by truncated Newton
    steps that are halved until every class's objective falls. They end when every
    class's gradient is ``tol`` of its first one; otherwise, after
    ``newton_steps``, that is an error. Returns the wide table
    ``(idx, w_<class>...)``.
    """
    balance = class_weights(labels)
    classes = list(balance)
    spark = features.sparkSession
    parts = loop_partitions(spark, features.count())
    rows = keyed_by_row(_bias_column(features, labels), parts)
    known = keyed_by_row(labels, parts)

    def cost_of(c: int) -> Column:
        return F.when(F.col("cls") == c, cost * balance[c]).otherwise(cost)

    def sign_of(c: int) -> Column:
        return F.when(F.col("cls") == c, 1.0).otherwise(-1.0)

    def scores(vectors: DataFrame, prefix: str) -> DataFrame:
        sums = [F.sum(F.col("val") * F.col(f"{prefix}_{c}")).alias(f"m_{c}") for c in classes]
        return rows.join(vectors, "idx").groupBy("row_id").agg(*sums)

    def back(per_row: DataFrame, prefix: str) -> DataFrame:
        sums = [F.sum(F.col("val") * F.col(f"q_{c}")).alias(f"{prefix}_{c}") for c in classes]
        return rows.join(per_row, "row_id").groupBy("idx").agg(*sums)

    def losses(scored: DataFrame, weights: DataFrame) -> dict[int, float]:
        data = scored.agg(
            *[F.sum(cost_of(c) * squared_hinge(sign_of(c), F.col(f"m_{c}"))).alias(f"l_{c}") for c in classes]
        ).first()
        size = weights.agg(*[F.sum(F.col(f"w_{c}") * F.col(f"w_{c}")).alias(f"l_{c}") for c in classes]).first()
        return {c: data[f"l_{c}"] + size[f"l_{c}"] / 2 for c in classes}

    def scored_rows(weights: DataFrame) -> DataFrame:
        return known.join(scores(weights, "w"), "row_id").persist()

    weights = durable(rows.select("idx").distinct().select("idx", *[F.lit(0.0).alias(f"w_{c}") for c in classes]))
    scored = scored_rows(weights)
    value = losses(scored, weights)
    first_norm: dict[int, float] = {}
    for _ in range(newton_steps + 1):
        slope = [
            F.when(
                sign_of(c) * F.col(f"m_{c}") < 1, 2.0 * cost_of(c) * (F.col(f"m_{c}") - sign_of(c))
            ).otherwise(0.0).alias(f"q_{c}")
            for c in classes
        ]
        gradient = weights.join(back(scored.select("row_id", *slope), "g"), "idx")
        zero = F.lit(0.0)
        start = [zero.alias(f"d_{c}") for c in classes]
        down = [(-(F.col(f"w_{c}") + F.col(f"g_{c}"))).alias(f"r_{c}") for c in classes]
        state = gradient.select("idx", *start, *down)
        state = durable(state.select("*", *[F.col(f"r_{c}").alias(f"p_{c}") for c in classes]))
        rr = _dots(state, [("r", "r")], classes)["r", "r"]
        if not first_norm:
            first_norm = dict(rr)
        if all(math.sqrt(rr[c]) <= tol * math.sqrt(first_norm[c]) for c in classes):
            break
        target = {c: 0.01 * rr[c] for c in classes}
        curvature = [
            F.when(sign_of(c) * F.col(f"m_{c}") < 1, 2.0 * cost_of(c)).otherwise(0.0).alias(f"c_{c}") for c in classes
        ]
        curved = scored.select("row_id", *curvature).persist()
        for _inner in range(cg_steps):
            moved_rows = scores(state.select("idx", *[f"p_{c}" for c in classes]), "p").join(curved, "row_id")
            moved_rows = moved_rows.select(
                "row_id", *[(F.col(f"c_{c}") * F.col(f"m_{c}")).alias(f"q_{c}") for c in classes]
            )
            both = state.join(back(moved_rows, "h"), "idx").select(
                *state.columns, *[(F.col(f"p_{c}") + F.col(f"h_{c}")).alias(f"h_{c}") for c in classes]
            )
            both = durable(both)
            dots = _dots(both, [("p", "h"), ("r", "h"), ("h", "h")], classes)
            live = {c: rr[c] > target[c] and dots["p", "h"][c] > 0 for c in classes}
            step = {c: rr[c] / dots["p", "h"][c] if live[c] else 0.0 for c in classes}
            after = {
                c: max(0.0, rr[c] - 2 * step[c] * dots["r", "h"][c] + step[c] ** 2 * dots["h", "h"][c]) for c in classes
            }
            turn = {c: after[c] / rr[c] if live[c] else 0.0 for c in classes}
            left = {c: F.col(f"r_{c}") - step[c] * F.col(f"h_{c}") for c in classes}
            state = both.select(
                "idx",
                *[(F.col(f"d_{c}") + step[c] * F.col(f"p_{c}")).alias(f"d_{c}") for c in classes],
                *[left[c].alias(f"r_{c}") for c in classes],
                *[(left[c] + turn[c] * F.col(f"p_{c}")).alias(f"p_{c}") for c in classes],
            )
            rr = after
            if all(rr[c] <= target[c] for c in classes):
                break
        direction = durable(state.select("idx", *[f"d_{c}" for c in classes]))
        curved.unpersist()
        pace = {c: 1.0 for c in classes}
        for _halving in range(10):
            tried = durable(
                weights.join(direction, "idx").select(
                    "idx", *[(F.col(f"w_{c}") + pace[c] * F.col(f"d_{c}")).alias(f"w_{c}") for c in classes]
                )
            )
            tried_rows = scored_rows(tried)
            tried_value = losses(tried_rows, tried)
            worse = [c for c in classes if tried_value[c] > value[c]]
            if not worse:
                break
            tried_rows.unpersist()
            pace.update({c: pace[c] / 2 if _halving < 8 else 0.0 for c in worse})
        scored.unpersist()
        weights, scored, value = tried, tried_rows, tried_value
    else:
        raise RuntimeError(f"the model did not converge within {newton_steps} steps")
    out = weights
    for table in (rows, known, scored):
        table.unpersist()
    return out


def _dots(df: DataFrame, pairs: list[tuple[str, str]], classes: list[int]) -> dict[tuple[str, str], dict[int, float]]:
    """Inner products of column groups, per class, in one job."""
    sums = [F.sum(F.col(f"{a}_{c}") * F.col(f"{b}_{c}")).alias(f"{a}{b}_{c}") for a, b in pairs for c in classes]
    row = df.agg(*sums).first()
    return {(a, b): {c: row[f"{a}{b}_{c}"] or 0.0 for c in classes} for a, b in pairs}


def multiclass_predict(features: DataFrame, rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``(row_id, prediction)``: the class with the greatest margin, lowest class on ties."""
    from rankloom.functions.numeric import argmax

    classes = [int(c[2:]) for c in weights.columns if c.startswith("w_")]
    bias = weights.filter("idx = -1").select(*[F.col(f"w_{c}").alias(f"b_{c}") for c in classes]).first()
    sums = [F.sum(F.col("val") * F.col(f"w_{c}")).alias(f"m_{c}") for c in classes]
    scored = rows.select("row_id").join(features.join(weights, "idx").groupBy("row_id").agg(*sums), "row_id", "left")
    values = [F.coalesce(f"m_{c}", F.lit(0.0)) + F.lit(bias[f"b_{c}"]) for c in classes]
    return scored.select("row_id", argmax(values, classes).alias("prediction"))
