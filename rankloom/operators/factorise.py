"""Matrix factorisation on rating rows.

Ratings are ``(user_id, item_id, rating)``. Factors of users (kind 0) and
items (kind 1) share one table ``(kind, id, f0, f1, ...)``. The full-batch solvers
keep the ratings in a grid of blocks (``grid``), through which the factors are sent.
Only rating rows are touched, never the user x item matrix.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.numeric import dot, sigmoid
from rankloom.functions.order import start_value
from rankloom.operators import grid
from rankloom.operators.layout import number_rows
from rankloom.operators.neighbours import rescale_predictions
from rankloom.session import cleaned, scratch, stash, store

USER, ITEM = grid.USER, grid.ITEM


def factor_columns(latent: int) -> list[str]:
    return [f"f{i}" for i in range(latent)]


def latent_of(factors: DataFrame) -> int:
    return sum(1 for c in factors.columns if c[0] == "f" and c[1:].isdigit())


def start_factors(users: DataFrame, items: DataFrame, latent: int, scale: float = 1.0) -> DataFrame:
    """Reproducible start factors in [0, scale) for ``users(id)`` and ``items(id)``."""

    def side(ids: DataFrame, kind: int) -> DataFrame:
        values = [(start_value("id", i + kind * latent) * scale).alias(f"f{i}") for i in range(latent)]
        return ids.select(F.lit(kind).alias("kind"), F.col("id").cast("long").alias("id"), *values)

    return side(users, USER).unionByName(side(items, ITEM))


def scale_unit(rating: Column) -> Column:
    """Stars 1..5 to [0, 1]."""
    return (rating - 1.0) / 4.0


def rated_mask(ratings: DataFrame) -> DataFrame:
    """Rows that count as rated: a stored zero does not."""
    return ratings.filter("rating <> 0")


def factor_join(pairs: DataFrame, factors: DataFrame, how: str = "inner") -> DataFrame:
    """Pairs with user factors ``u*`` and item factors ``v*``; ``how='left'`` keeps pairs without factors."""
    n = latent_of(factors)
    users = factors.filter(F.col("kind") == USER).select(
        F.col("id").alias("user_id"), *[F.col(f"f{i}").alias(f"u{i}") for i in range(n)]
    )
    items = factors.filter(F.col("kind") == ITEM).select(
        F.col("id").alias("item_id"), *[F.col(f"f{i}").alias(f"v{i}") for i in range(n)]
    )
    return pairs.join(users, "user_id", how).join(items, "item_id", how)


def inner_product(latent: int) -> Column:
    return dot([f"u{i}" for i in range(latent)], [f"v{i}" for i in range(latent)])


def masked_sse(ratings: DataFrame, factors: DataFrame, link: str = "identity") -> DataFrame:
    """One row ``sse``: squared error over the rated rows."""
    score = inner_product(latent_of(factors))
    score = sigmoid(score) if link == "sigmoid" else score
    joined = factor_join(rated_mask(ratings), factors)
    return joined.agg(F.sum(F.pow(F.col("rating") - score, 2)).alias("sse"))


@cleaned
def mf_gradient(
    ratings: DataFrame,
    factors: DataFrame,
    lmd: float = 0.2,
    step: float = 1e-4,
    iterations: int | None = None,
    tol: float = 1e-5,
    max_iterations: int = 1000,
    reg_sign: str = "reference",
) -> DataFrame:
    """Full-batch gradient steps on the squared error of the rated rows.

    ``reg_sign='reference'`` adds the penalty term to the factors,
    ``'descent'`` subtracts it. Stops when the relative change of the error
    falls below ``tol`` unless ``iterations`` fixes the number of updates.
    """
    latent = latent_of(factors)
    sign = {"reference": 1.0, "descent": -1.0}[reg_sign]

    def slopes(score: np.ndarray, rating: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        error = rating - score
        return error, error * error

    def update(f: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, float]:
        return f + step * (sums + sign * lmd * f), 0.0

    made = grid.build(rated_mask(ratings), factors)
    stored = store(grid.pack(factors, factor_columns(latent), made.blocks), "factors")
    last, settled = None, iterations is not None
    for _ in range(iterations if iterations is not None else max_iterations):
        fresh = grid.step(made, stored.table, latent, latent, slopes, update)
        sse = fresh.table.agg(F.sum("loss")).first()[0] or 0.0
        if iterations is None and last is not None and (not last or abs(sse - last) / last < tol):
            fresh.drop()
            settled = True
            break
        stored.drop()
        stored, last = fresh, sse
    made.close()
    if not settled:
        raise RuntimeError(f"the error has not settled within {max_iterations} steps")
    return grid.unpack(stored.table, factor_columns(latent), latent)


@cleaned
def mf_sigmoid(
    ratings: DataFrame,
    factors: DataFrame,
    lmd: float = 0.2,
    learning_rate: float = 0.01,
    weight_decay: float = 1e-4,
    iterations: int | None = None,
    tol: float = 1e-7,
    check_every: int = 10,
    max_iterations: int = 1000,
) -> DataFrame:
    """Fit ``sigmoid(u.v)`` to unit-scaled stars with Adam.

    The loss adds ``lmd`` times the (unsquared) norm of every factor row; rows
    scaled to zero are not rated. Moments live beside the factors.
    """
    latent = latent_of(factors)
    beta1, beta2, eps = 0.9, 0.999, 1e-8  # Fixed values: Adam's usual constants.

    def slopes(score: np.ndarray, rating: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        guess = 1.0 / (1.0 + np.exp(-score))
        gap = guess - rating
        return 2.0 * gap * guess * (1.0 - guess), gap * gap

    def adam(n: int) -> grid.Update:
        def update(values: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, float]:
            f, m, s = np.split(values, 3, axis=1)
            norm = np.sqrt((f * f).sum(axis=1, keepdims=True))
            pull = np.divide(lmd * f, norm, out=np.zeros_like(f), where=norm > 0)
            slope = sums + pull + weight_decay * f
            m, s = beta1 * m + (1 - beta1) * slope, beta2 * s + (1 - beta2) * slope * slope
            f = f - learning_rate * (m / (1 - beta1**n)) / (np.sqrt(s / (1 - beta2**n)) + eps)
            return np.concatenate([f, m, s], axis=1), float(lmd * norm.sum())

        return update

    unit = rated_mask(ratings.withColumn("rating", scale_unit(F.col("rating"))))
    made = grid.build(unit, factors)
    columns = [f"{k}{i}" for k in ("f", "m", "s") for i in range(latent)]
    blank = [F.lit(0.0).alias(c) for c in columns[latent:]]
    start = factors.select("kind", "id", *factor_columns(latent), *blank)
    stored = store(grid.pack(start, columns, made.blocks), "factors")
    last, settled = None, iterations is not None
    for n in range(1, (iterations if iterations is not None else max_iterations) + 1):
        fresh = grid.step(made, stored.table, latent, 3 * latent, slopes, adam(n))
        loss = fresh.table.agg(F.sum("loss")).first()[0] or 0.0
        stored.drop()
        stored = fresh
        if iterations is None and last is not None and (n - 1) % check_every == 0:
            change = abs(loss - last) / last if last else 0.0
            if 0 < change < tol or not last:
                settled = True
                break
        last = loss
    made.close()
    if not settled:
        raise RuntimeError(f"the loss has not settled within {max_iterations} steps")
    return grid.unpack(stored.table, factor_columns(latent), 3 * latent)


def _batch_bounds(step: int, batch_size: int, rows: int) -> tuple[int, int]:
    start = (step * batch_size) % rows
    return start, min(start + batch_size, rows)


def numbered_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings with a position from 1, stored sorted so that a batch reads only its rows."""
    placed = number_rows(ratings, [F.col("user_id"), F.col("item_id")], name="pos")
    return stash(placed, "ratings", sort_by=["pos"])


@cleaned
def mf_minibatch(
    placed: DataFrame,
    factors: DataFrame,
    alpha: float,
    lambda_u: float,
    lambda_v: float,
    batch_size: int,
    num_iterations: int,
) -> DataFrame:
    """Sequential mini-batches over ratings numbered in ``pos``.

    Slopes use the factors before the batch. The rows of one id are applied
    one after the other with decay ``1 - alpha * lambda``; in closed form the
    slope that has ``j`` later rows of the same id is weighted with decay^j.
    """
    latent = latent_of(factors)
    n_rows = placed.count()
    stored = store(factors, "factors")
    decay = {USER: 1 - alpha * lambda_u, ITEM: 1 - alpha * lambda_v}
    for step in range(num_iterations):
        low, high = _batch_bounds(step, batch_size, n_rows)
        state = stored.table
        batch = placed.filter((F.col("pos") > low) & (F.col("pos") <= high))
        rows = factor_join(batch, state).withColumn("_e", 2.0 * (inner_product(latent) - F.col("rating")))
        rows = number_rows(rows, [F.col("pos").desc()], ["user_id"], "_later_u")
        rows = number_rows(rows, [F.col("pos").desc()], ["item_id"], "_later_v")
        weight = {
            USER: F.pow(F.lit(decay[USER]), F.col("_later_u") - 1),
            ITEM: F.pow(F.lit(decay[ITEM]), F.col("_later_v") - 1),
        }
        sides = [(USER, "user_id", "v"), (ITEM, "item_id", "u")]
        records = F.array(
            *[
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.col(key).alias("id"),
                    *[(weight[kind] * F.col("_e") * F.col(f"{o}{i}")).alias(f"g{i}") for i in range(latent)],
                )
                for kind, key, o in sides
            ]
        )
        sums = (
            rows.select(F.explode(records).alias("r"))
            .select("r.*")
            .groupBy("kind", "id")
            .agg(F.count(F.lit(1)).alias("_c"), *[F.sum(f"g{i}").alias(f"g{i}") for i in range(latent)])
        )
        rate = F.when(F.col("kind") == USER, decay[USER]).otherwise(decay[ITEM])
        moved = [
            F.when(F.col("_c").isNull(), F.col(f"f{i}"))
            .otherwise(F.pow(rate, F.col("_c")) * F.col(f"f{i}") - alpha * F.col(f"g{i}"))
            .alias(f"f{i}")
            for i in range(latent)
        ]
        fresh = store(state.join(sums, ["kind", "id"], "left").select("kind", "id", *moved), "factors")
        stored.drop()
        stored = fresh
    return stored.table


@cleaned
def mf_minibatch_block(
    placed: DataFrame,
    factors: DataFrame,
    alpha: float,
    lambda_u: float,
    lambda_v: float,
    batch_size: int,
    num_iterations: int,
) -> DataFrame:
    """Mini-batches where each id takes only the step of its last row in the batch."""
    latent = latent_of(factors)
    n_rows = placed.count()
    stored = store(factors, "factors")
    for step in range(num_iterations):
        low, high = _batch_bounds(step, batch_size, n_rows)
        state = stored.table
        batch = placed.filter((F.col("pos") > low) & (F.col("pos") <= high))
        error = F.when(F.col("rating") != 0, F.col("rating") - inner_product(latent)).otherwise(0.0)
        rows = factor_join(batch, state).withColumn("_e", error)
        records = F.array(
            *[
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.col(key).alias("id"),
                    F.struct("pos", *[(F.col("_e") * F.col(f"{o}{i}")).alias(f"g{i}") for i in range(latent)]).alias("g"),
                )
                for kind, key, o in [(USER, "user_id", "v"), (ITEM, "item_id", "u")]
            ]
        )
        lasts = (
            rows.select(F.explode(records).alias("r")).select("r.*").groupBy("kind", "id").agg(F.max("g").alias("g"))
        )
        lmd = F.when(F.col("kind") == USER, lambda_u).otherwise(lambda_v)
        moved = [
            F.when(F.col("g").isNull(), F.col(f"f{i}"))
            .otherwise(F.col(f"f{i}") + alpha * (F.col(f"g.g{i}") - lmd * F.col(f"f{i}")))
            .alias(f"f{i}")
            for i in range(latent)
        ]
        fresh = store(state.join(lasts, ["kind", "id"], "left").select("kind", "id", *moved), "factors")
        stored.drop()
        stored = fresh
    return stored.table


NEUTRAL = 3.0  # Fixed value: the middle of the stars, for a target about which nothing is known.


def mf_predict(targets: DataFrame, factors: DataFrame, link: str = "identity", rescale: bool = True) -> DataFrame:
    """``(item_id, user_id, score)`` for every target pair, stretched to 1..5.

    A pair whose user or item has no factors gets the neutral score 3; it takes
    no part in the stretching, and without it the score is null.
    """
    score = inner_product(latent_of(factors))
    score = sigmoid(score) if link == "sigmoid" else score
    pairs = targets.select("item_id", "user_id").distinct()
    scored = factor_join(pairs, factors, "left").select("item_id", "user_id", score.alias("score"))
    return rescale_predictions(scored).fillna(NEUTRAL, ["score"]) if rescale else scored


def mf_als(
    ratings: DataFrame, targets: DataFrame, latent: int = 10, lmd: float = 0.2, iterations: int = 10, seed: int = 0
) -> DataFrame:
    """The same predictions with Spark's alternating least squares as the solver; unknown users and items get 3."""
    from pyspark.ml.recommendation import ALS

    als = ALS(
        rank=latent, regParam=lmd, maxIter=iterations, seed=seed,
        userCol="user_id", itemCol="item_id", ratingCol="rating", checkpointInterval=5,
    )
    model = als.fit(ratings.select("user_id", "item_id", "rating"))
    pairs = targets.select("item_id", "user_id").distinct()
    score = F.nanvl(F.col("prediction").cast("double"), F.lit(None).cast("double")).alias("score")
    scored = model.transform(pairs).select("item_id", "user_id", score)
    return rescale_predictions(scored).fillna(NEUTRAL, ["score"])
