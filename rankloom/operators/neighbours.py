"""Rating prediction from nearest neighbours, and the order of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.session import cleaned, durable

MEANS = ("mean", "weight")


def neighbour_ratings(targets: DataFrame, neighbours: DataFrame, train: DataFrame, by: str = "user") -> DataFrame:
    """Each target pair with its neighbours' similarity and rating; unrated is 0."""
    entity, other = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    near = neighbours.select(F.col("a").alias(entity), "b", "sim")
    known = train.select(F.col(entity).alias("b"), other, "rating")
    pairs = targets.select("item_id", "user_id").distinct().join(near, entity)
    return pairs.join(known, ["b", other], "left").select(
        "item_id", "user_id", "b", "sim", F.coalesce("rating", F.lit(0.0)).alias("rating")
    )


@cleaned
def knn_predict(
    targets: DataFrame,
    neighbours: DataFrame,
    train: DataFrame,
    by: str = "user",
    mean: str = "mean",
    offset: float = 3.0,
) -> DataFrame:
    """``(item_id, user_id, score)``: plain or similarity-weighted mean of the neighbours.

    When the similarities add up to zero they are used as raw weights. A target looks up
    its neighbours' ratings or, where these are fewer, its ratings' neighbours, so it takes
    no more rows than the smaller of the two lists.
    """
    if mean not in MEANS:
        raise ValueError(f"mean must be one of {MEANS}")
    entity, other = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    near = neighbours.select(F.col("a").alias(entity), "b", "sim")
    lists = near.groupBy(entity).agg(F.count(F.lit(1)).alias("near"), F.sum("sim").alias("sims"))
    known = train.groupBy(F.col(entity).alias("b"), other).agg(
        F.sum(F.coalesce("rating", F.lit(0.0))).alias("rating"), F.count(F.lit(1)).alias("rows")
    )
    raters = train.groupBy(other).agg(F.count(F.lit(1)).alias("raters"))
    pairs = durable(targets.select("item_id", "user_id").distinct().join(lists, entity).join(raters, other, "left"))
    ends = pairs.select("item_id", "user_id", "near", "raters")
    by_near = ends.filter("near <= raters").join(near, entity).join(known, ["b", other])
    by_rater = ends.filter("near > raters").join(known, other).join(near, [entity, "b"])
    sums = by_near.unionByName(by_rater).groupBy("item_id", "user_id").agg(
        F.sum("rating").alias("rating"),
        F.sum(F.col("sim") * F.col("rating")).alias("weighted"),
        F.sum(F.col("rows") - 1).alias("more"),  # a rating that comes twice counts twice
        F.sum(F.col("sim") * (F.col("rows") - 1)).alias("more_sims"),
    )
    both = ["item_id", "user_id"]
    sums = pairs.alias("p").join(
        sums.alias("s"), F.expr(" AND ".join(f"p.{c} <=> s.{c}" for c in both)), "left"
    ).select(*[f"p.{c}" for c in both], "near", "sims", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rating", "weighted", "more", "more_sims")])
    if mean == "mean":
        score = F.col("rating") / (F.col("near") + F.col("more"))
    else:
        score = F.col("weighted") / F.coalesce(F.nullif(F.col("sims") + F.col("more_sims"), F.lit(0.0)), F.lit(1.0))
    return sums.select("item_id", "user_id", (score + offset).alias("score"))


def prediction_order(targets: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions for ``(pair_idx, item_id, user_id)`` targets, one per target row."""
    return targets.join(predictions, ["item_id", "user_id"], "left").select("pair_idx", "item_id", "user_id", "score")


def rescale_predictions(predictions: DataFrame, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Stretch the scores of all predictions to ``[low, high]``; null and NaN scores are not counted and become null."""
    score = F.when(~F.isnan("score"), F.col("score"))
    ends = predictions.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    if ends["lo"] is None or ends["hi"] == ends["lo"]:
        return predictions.withColumn("score", F.when(score.isNotNull(), F.lit(low)))
    unit = (score - ends["lo"]) / F.lit(ends["hi"] - ends["lo"])
    return predictions.withColumn("score", unit * (high - low) + low)
