"""Queries on ratings: similarity, neighbours, prediction and factorisation."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import factorise, neighbours, similarity
from rankloom.operators.metrics import rmse
from rankloom.plans.oracle import rating as sql
from rankloom.plans.registry import Query, rounded, saved
from rankloom.plans.views import Views
from rankloom.sources import readers

K, LATENT, STEPS, BATCHES = 10, 4, 2, 4
PACE, SETTLED = 0.002, 0.01
SIDES = ("user", "item")
MORE_K = (100, 500)
GRID = [  # the published combinations
    (by, m, c, mean)
    for by in SIDES
    for m, c, mean in (("dot", False, "mean"), ("cosine", False, "weight"), ("dot", True, "mean"), ("cosine", True, "weight"))
]
MEASURES = [("dot", False), ("cosine", False), ("dot", True), ("cosine", True)]


def train(v: Views) -> DataFrame:
    return saved(v, "train", v.train)


def stars(v: Views) -> DataFrame:
    return saved(v, "stars", v.stars)


def pairs(v: Views) -> DataFrame:
    return saved(v, "pairs", v.pairs)


def measure_name(measure: str, centred: bool) -> str:
    return f"centred_{measure}" if centred else measure


def nearest(v: Views, by: str, measure: str, centred: bool, self_mode: str = "drop_top", k: int = K) -> DataFrame:
    entity = f"{by}_id"
    wanted = pairs(v).select(F.col(entity).alias("id")).distinct()
    universe, cells = (v.users(), v.items()) if by == "user" else (v.items(), v.users())
    key = f"nearest-{by}-{measure}-{centred}-{self_mode}-{k}"
    return saved(
        v, key,
        lambda: similarity.nearest.__wrapped__(  # not stored twice
            train(v).filter("rating <> 0"), train(v), wanted, universe, by, measure, centred, k, cells.count(), self_mode=self_mode
        ),
    )


def predicted(v: Views, by: str, measure: str, centred: bool, mean: str, k: int = K) -> DataFrame:
    near = nearest(v, by, measure, centred, k=k)
    return neighbours.knn_predict(pairs(v), near, train(v), by, mean)


def start(v: Views, scale: float = 1.0) -> DataFrame:
    return factorise.start_factors(v.users(), v.items(), LATENT, scale)


def gradient_factors(v: Views) -> DataFrame:
    return saved(v, "mf-gradient", lambda: factorise.mf_gradient(stars(v), start(v), iterations=STEPS))


def sigmoid_factors(v: Views) -> DataFrame:
    return saved(v, "mf-sigmoid", lambda: factorise.mf_sigmoid(stars(v), start(v, 0.1), iterations=STEPS))


def _minibatch(v: Views, block: bool) -> DataFrame:
    """One pass over all ratings in four sequential batches."""
    placed = factorise.numbered_ratings(stars(v))
    size = math.ceil(placed.count() / BATCHES)
    solver = factorise.mf_minibatch_block if block else factorise.mf_minibatch
    return rounded(solver(placed, start(v), 0.005, 0.05, 0.1, size, BATCHES))


def _scored_rmse(v: Views) -> DataFrame:
    joined = predicted(v, "user", "dot", False, "mean").join(v.truth(), ["item_id", "user_id"])
    return rounded(rmse(joined, "truth", "score"), 9)


def _in_order(v: Views) -> DataFrame:
    return rounded(neighbours.prediction_order(v.targets(), predicted(v, "user", "dot", False, "mean")))


def _sizes(v: Views) -> DataFrame:
    sides = [
        readers.distinct_entities(v.ratings(), f"{s}_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("side"), "n")
        for s in SIDES
    ]
    return sides[0].unionByName(sides[1])


def _group(v: Views, entity: str) -> DataFrame:
    """Targets of each user or item, one row each, and their number."""
    return pairs(v).join(pairs(v).groupBy(entity).agg(F.count(F.lit(1)).alias("targets")), entity)


QUERIES: dict[str, Query] = {
    "centre_ratings": Query(
        lambda v: readers.centre_ratings(v.ratings()).select("user_id", "item_id", "fold", "rating"), sql.CENTRED
    ),
    "drop_neutral": Query(
        lambda v: readers.drop_neutral(readers.centre_ratings(v.ratings())).select("user_id", "item_id", "fold", "rating"),
        sql.NEUTRAL,
    ),
    "rating_matrix": Query(lambda v: readers.rating_matrix(v.ratings()), sql.MATRIX),
    "distinct_entities": Query(_sizes, sql.ENTITIES),
    "scale_unit": Query(
        lambda v: v.ratings().select("user_id", "item_id", "fold", factorise.scale_unit(F.col("rating")).alias("unit")),
        sql.SCALE_UNIT,
    ),
    "rated_mask": Query(
        lambda v: factorise.rated_mask(train(v)).select("user_id", "item_id"), sql.MASK
    ),
    "targets_by_user": Query(lambda v: _group(v, "user_id"), sql.group("user_id")),
    "targets_by_item": Query(lambda v: _group(v, "item_id"), sql.group("item_id")),
    "entity_mean": Query(
        lambda v: rounded(similarity.entity_mean(train(v), "user_id", v.users().count())), sql.ENTITY_MEAN
    ),
    "l2_norms": Query(lambda v: rounded(similarity.l2_norms(train(v), "item_id")), sql.L2_NORMS),
    **{
        f"sim_{by}_{measure_name(m, c)}": Query(
            lambda v, by=by, m=m, c=c: rounded(nearest(v, by, m, c)), sql.nearest(by, m, c, K)
        )
        for by in SIDES
        for m, c in MEASURES
    },
    "knn_topk_exclude": Query(
        lambda v: rounded(nearest(v, "user", "dot", False, "exclude")), sql.nearest("user", "dot", False, K, "exclude")
    ),
    "neighbour_rating_join": Query(
        lambda v: rounded(
            neighbours.neighbour_ratings(pairs(v), nearest(v, "user", "cosine", False), train(v)).select(
                "item_id", "user_id", "b", "sim", "rating"
            )
        ),
        sql.neighbour_rows("user", "cosine", False, K),
    ),
    **{
        f"knn_{by}_predict_{measure_name(m, c)}_{mean}": Query(
            lambda v, by=by, m=m, c=c, mean=mean: rounded(predicted(v, by, m, c, mean), 6),
            sql.predicted(by, m, c, mean, K),
        )
        for by in SIDES
        for m, c in MEASURES
        for mean in neighbours.MEANS
    },
    **{
        f"knn_{by}_predict_{measure_name(m, c)}_{mean}_k{k}": Query(
            lambda v, by=by, m=m, c=c, mean=mean, k=k: rounded(predicted(v, by, m, c, mean, k), 6),
            sql.predicted(by, m, c, mean, k),
        )
        for k in MORE_K
        for by, m, c, mean in GRID
    },
    "rmse": Query(_scored_rmse, sql.rmse(K)),
    "prediction_order_join": Query(_in_order, sql.in_order(K)),
    "mf_gradient": Query(lambda v: rounded(gradient_factors(v)), sql.mf_gradient(LATENT, STEPS)),
    "mf_gradient_settled": Query(
        lambda v: rounded(factorise.mf_gradient(stars(v), start(v), step=PACE, tol=SETTLED)),
        sql.mf_gradient_settled(LATENT, PACE, SETTLED),
    ),
    "mf_sigmoid": Query(lambda v: rounded(sigmoid_factors(v)), sql.mf_sigmoid(LATENT, STEPS)),
    "mf_minibatch": Query(lambda v: _minibatch(v, False), sql.mf_minibatch(LATENT, BATCHES)),
    "mf_minibatch_block": Query(lambda v: _minibatch(v, True), sql.mf_minibatch(LATENT, BATCHES, block=True)),
    "factor_join": Query(
        lambda v: rounded(factorise.mf_predict(pairs(v), gradient_factors(v), rescale=False)),
        sql.mf_predict(LATENT, STEPS, False),
    ),
    "mf_predict": Query(
        lambda v: rounded(factorise.mf_predict(pairs(v), gradient_factors(v)), 6), sql.mf_predict(LATENT, STEPS, True)
    ),
    "rescale_predictions": Query(
        lambda v: rounded(neighbours.rescale_predictions(predicted(v, "item", "dot", False, "mean")), 6), sql.rescaled(K)
    ),
    "mf_predict_sigmoid": Query(
        lambda v: rounded(factorise.mf_predict(pairs(v), sigmoid_factors(v), "sigmoid"), 6),
        sql.mf_predict_sigmoid(LATENT, STEPS),
    ),
    "masked_sse": Query(
        lambda v: rounded(factorise.masked_sse(stars(v), gradient_factors(v)), 4), sql.masked_sse(LATENT, STEPS)
    ),
    "mf_als": Query(lambda v: factorise.mf_als(stars(v), pairs(v), LATENT)),
}
