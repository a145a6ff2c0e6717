"""Softmax regression on sparse features with star classes 1..k.

Features are ``(row_id, idx, val)``, labels ``(row_id, cls)`` and weights the
wide table ``(idx, w1, ..., wk)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rankloom.functions.numeric import argmax, softmax, total
from rankloom.functions.order import hash_key
from rankloom.operators import rowblocks
from rankloom.operators.layout import number_rows
from rankloom.session import cleaned, loop_partitions, stash, store


def weight_columns(classes: int) -> list[str]:
    return [f"w{c}" for c in range(1, classes + 1)]


def classes_of(weights: DataFrame) -> int:
    return sum(1 for c in weights.columns if c[0] == "w" and c[1:].isdigit())


def zero_weights(features: DataFrame, classes: int = 5) -> DataFrame:
    return features.select("idx").distinct().select("idx", *[F.lit(0.0).alias(w) for w in weight_columns(classes)])


def class_probabilities(features: DataFrame, rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``rows`` with ``p1..pk``; a row without known features is uniform."""
    k = classes_of(weights)
    sums = [F.sum(F.col("val") * F.col(f"w{c}")).alias(f"_s{c}") for c in range(1, k + 1)]
    scores = features.select("row_id", "idx", "val").join(weights, "idx").groupBy("row_id").agg(*sums)
    joined = rows.join(scores, "row_id", "left")
    chances = softmax([F.coalesce(f"_s{c}", F.lit(0.0)) for c in range(1, k + 1)])
    return joined.select(*rows.columns, *[p.alias(f"p{c}") for c, p in enumerate(chances, 1)])


def true_probability(classes: int) -> Column:
    chance = F.lit(None).cast("double")
    for c in range(1, classes + 1):
        chance = F.when(F.col("cls") == c, F.col(f"p{c}")).otherwise(chance)
    return chance


def softmax_loglik(features: DataFrame, labels: DataFrame, weights: DataFrame, lmd: float = 0.01) -> DataFrame:
    """One row ``loglik``: log probability of the true classes minus the penalty."""
    k = classes_of(weights)
    chances = class_probabilities(features, labels, weights)
    fit = chances.agg(F.sum(F.ln(true_probability(k))).alias("fit"))
    size = weights.agg(F.sum(total([F.col(w) * F.col(w) for w in weight_columns(k)])).alias("size"))
    penalty = (lmd / 2) * F.coalesce(size.scalar(), F.lit(0.0))
    return fit.select((F.col("fit") - penalty).alias("loglik"))


def softmax_step(features: DataFrame, labels: DataFrame, weights: DataFrame, rate: float) -> DataFrame:
    """Weights after one step on the log likelihood of the given rows."""
    k = classes_of(weights)
    chances = class_probabilities(features, labels, weights)
    misses = [
        (F.when(F.col("cls") == c, 1.0).otherwise(0.0) - F.col(f"p{c}")).alias(f"_r{c}") for c in range(1, k + 1)
    ]
    sums = [F.sum(F.col("val") * F.col(f"_r{c}")).alias(f"_g{c}") for c in range(1, k + 1)]
    pull = features.join(chances.select("row_id", *misses), "row_id").groupBy("idx").agg(*sums)
    moved = [(F.col(f"w{c}") + rate * F.coalesce(f"_g{c}", F.lit(0.0))).alias(f"w{c}") for c in range(1, k + 1)]
    return weights.join(pull, "idx", "left").select("idx", *moved)


@dataclass
class SoftmaxFit:
    weights: DataFrame
    trace: DataFrame


@cleaned
def softmax_train(
    features: DataFrame,
    labels: DataFrame,
    eval_features: DataFrame,
    eval_labels: DataFrame,
    classes: int = 5,
    batch_size: int = 256,
    alpha: float = 0.0025,
    beta: float | None = None,
    lmd: float = 0.01,
    tol: float = 1e-8,
    seed: int = 0,
    check_every: int = 1,
) -> SoftmaxFit:
    """One pass of ``round(n / batch_size)`` hash-shuffled batches from zero weights.

    A step that changes the evaluation loss by less than ``tol`` (relative) ends
    the pass and is not applied. The loss reads all evaluation rows, so one pass costs
    ``n / batch_size / check_every`` looks at them: on large tables take a batch
    that grows with ``n``, or look at every ``check_every``-th step only.

    With at most ``rowblocks.MOST_FEATURES`` weights, rows are packed into blocks, a batch
    each; one task takes several steps after one another, and then one pass over the
    evaluation rows, shared by all tasks, gives the loss after each of them. Steps beyond
    the last one are dropped. Larger models take joins for each step.
    """
    beta = alpha / 1000 if beta is None else beta
    ids = None
    if isinstance(features.schema["idx"].dataType, IntegralType):
        ids = rowblocks.feature_ids(features.filter("idx IS NOT NULL"))
    tables = (features, labels, eval_features, eval_labels)
    if ids is None or len(ids) * classes > rowblocks.MOST_FEATURES:
        return _train_by_joins(tables, classes, batch_size, alpha, beta, lmd, tol, seed, check_every)
    return _train_by_blocks(tables, ids, classes, batch_size, alpha, beta, lmd, tol, seed, check_every)


STEPS, STEP_CELLS = 64, 4_000_000  # Fixed values: steps that a task takes after one another, and cells it holds for them.
EVAL_ROWS = 1024  # Fixed value: evaluation rows of a block, so that few of them are shared by many tasks too.


def _chances(rows: rowblocks.Rows, w: np.ndarray, times: np.ndarray | float = 1.0) -> np.ndarray:
    """Class probabilities of a block's rows, a column for each row; ``times`` multiplies a row's scores."""
    scores = np.array([rows.dot(one) for one in w]) * times
    powers = np.exp(scores - scores.max(axis=0))
    return powers / powers.sum(axis=0)


def _copies(names: list[str | None]) -> np.ndarray:
    """How often the row of each label is in the batch: every label meets the cells of all."""
    _, place, n = np.unique(np.array([n or "" for n in names]), return_inverse=True, return_counts=True)
    return n[place].astype(float)


def _train_by_blocks(tables, ids, classes, batch_size, alpha, beta, lmd, tol, seed, check_every) -> SoftmaxFit:
    features, labels, eval_features, eval_labels = tables
    spark, size = features.sparkSession, len(ids)
    label = F.col("cls").cast("double").alias("y")
    train = rowblocks.build(features, labels.select("row_id", label), ids, batch_size, seed)
    check = rowblocks.build(eval_features, eval_labels.select("row_id", label), ids, EVAL_ROWS)
    batches = -(-train.rows // batch_size)
    cells = train.stored.table.agg(F.sum(F.length("at"))).first()[0] or 0
    some = max(1, min(STEPS, rowblocks.MOST_FEATURES // max(1, size * classes), STEP_CELLS * batches // max(1, cells // 4)))
    known = np.arange(1.0, classes + 1)[:, None]

    def steps(w: np.ndarray, first: int, last: int) -> list[np.ndarray]:
        """Weights after each of the batches from ``first`` to ``last``."""

        def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {}
            for batch in found:
                held.update(zip(batch.column(0).to_pylist(), rowblocks.unpacked(iter([batch]), size)))
            now = w
            for i in sorted(held):
                rows = held.pop(i)
                times = _copies(rows.names)
                miss = ((known == rows.y) - _chances(rows, now, times)) * times
                now = now + alpha / (1 + beta * i) * np.array([rows.back(m) for m in miss])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([now.tobytes()], pa.binary())], ["i", "w"])

        picked = train.stored.table.filter(F.col("block").between(first, last)).coalesce(1)
        found = picked.mapInArrow(run, "i int, w binary").toArrow().sort_by("i")
        return [np.frombuffer(one).reshape(classes, size) for one in found["w"].to_pylist()]

    def losses(all_weights: list[np.ndarray]) -> list[float | None]:
        """Log probability of the evaluation rows' classes minus the penalty, for each of the weights."""

        def part(rows: rowblocks.Rows) -> np.ndarray:
            has = (rows.y >= 1) & (rows.y <= classes)
            at = rows.y[has].astype(np.int64) - 1
            sums = []
            for w in all_weights:
                chance = _chances(rows, w)[at, np.flatnonzero(has)]
                chance = chance[~(chance <= 0)]  # like a logarithm in SQL, which is null there
                sums += [np.log(chance).sum(), len(chance)]
            return np.array(sums)

        sums = check.total(part, 2 * len(all_weights)).reshape(-1, 2)
        return [fit - lmd / 2 * float((w * w).sum()) if n else None for w, (fit, n) in zip(all_weights, sums.tolist())]

    w = np.zeros((classes, size))
    loss, trace, at, end = losses([w])[0], [], 0, round(train.rows / batch_size)
    while at < end:
        moved = steps(w, at, min(at + some, end) - 1)
        looked = [j for j in range(len(moved)) if (at + j + 1) % check_every == 0]
        for j, moved_loss in zip(looked, losses([moved[j] for j in looked]) if looked else []):
            change = abs((loss - moved_loss) / loss)
            trace.append((at + j, loss, change))
            if change < tol:
                moved, end = moved[:j], 0
                break
            loss = moved_loss
        w = moved[-1] if moved else w
        at += some
    train.close()
    check.close()
    return SoftmaxFit(_weight_table(features, ids, w), spark.createDataFrame(trace, "iter int, loss double, change double"))


def _weight_table(features: DataFrame, ids: np.ndarray, w: np.ndarray) -> DataFrame:
    """The wide table of weights; cells without a feature have a row of zeros, as in ``zero_weights``."""
    spark, kind, names = features.sparkSession, features.schema["idx"].dataType, weight_columns(len(w))
    weights = spark.createDataFrame([], "idx long, " + ", ".join(f"{n} double" for n in names))
    if len(ids):
        weights = spark.createDataFrame(pa.table({"idx": ids, **{n: np.ascontiguousarray(one) for n, one in zip(names, w)}}))
    weights = weights.select(F.col("idx").cast(kind).alias("idx"), *names)
    return weights.unionByName(zero_weights(features.filter("idx IS NULL"), len(w)))


def _train_by_joins(tables, classes, batch_size, alpha, beta, lmd, tol, seed, check_every) -> SoftmaxFit:
    """The same steps for a model too large for arrays; batches are stored sorted, so a step reads its own row groups."""
    features, labels, eval_features, eval_labels = tables
    spark = features.sparkSession
    placed = number_rows(labels.select("row_id", "cls"), [hash_key(seed, "row_id"), F.col("row_id")], name="_pos")
    placed = placed.withColumn("batch", F.floor((F.col("_pos") - 1) / batch_size).cast("int")).drop("_pos")
    batch_labels = stash(placed, "labels", sort_by=["batch", "row_id"])
    n = batch_labels.count()
    tagged = features.select("row_id", "idx", "val").join(batch_labels.select("row_id", "batch"), "row_id")
    batch_features = stash(tagged, "features", sort_by=["batch", "row_id"])
    parts = loop_partitions(spark, eval_features.count())
    check_rows = eval_labels.select("row_id", "cls").repartition(parts, "row_id").persist()
    check = eval_features.select("row_id", "idx", "val").repartition(parts, "row_id").persist()
    stored = store(zero_weights(features, classes), "weights")
    loss = softmax_loglik(check, check_rows, stored.table, lmd).first()[0]
    trace = []
    for i in range(round(n / batch_size)):
        rate = alpha / (1 + beta * i)
        part = batch_features.filter(F.col("batch") == i).drop("batch")
        picked = batch_labels.filter(F.col("batch") == i).drop("batch")
        moved = store(softmax_step(part, picked, stored.table, rate), "weights")
        if (i + 1) % check_every:
            stored.drop()
            stored = moved
            continue
        moved_loss = softmax_loglik(check, check_rows, moved.table, lmd).first()[0]
        change = abs((loss - moved_loss) / loss)
        trace.append((i, loss, change))
        if change < tol:
            moved.drop()
            break
        stored.drop()
        stored, loss = moved, moved_loss
    check.unpersist()
    check_rows.unpersist()
    return SoftmaxFit(stored.table, spark.createDataFrame(trace, "iter int, loss double, change double"))


def softmax_predict(features: DataFrame, rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``rows`` with ``hard``, the most probable star, and ``soft``, the expected star."""
    k = classes_of(weights)
    chances = class_probabilities(features, rows, weights)
    values = [F.col(f"p{c}") for c in range(1, k + 1)]
    soft = total([c * F.col(f"p{c}") for c in range(1, k + 1)])
    return chances.select(*rows.columns, argmax(values, list(range(1, k + 1))).alias("hard"), soft.alias("soft"))
