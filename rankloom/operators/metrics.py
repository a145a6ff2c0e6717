"""Evaluation measures as one-row aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, truth: str | Column, guess: str | Column, name: str = "accuracy") -> DataFrame:
    same = _col(truth) == _col(guess)
    return df.agg(F.avg(same.cast("double")).alias(name))


def rmse(df: DataFrame, truth: str | Column, guess: str | Column, name: str = "rmse") -> DataFrame:
    gap = _col(truth) - _col(guess)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias(name))


def sign_label(margin: Column) -> Column:
    return F.when(margin > 0, 1).otherwise(-1)


def squared_hinge(y: Column, margin: Column) -> Column:
    slack = F.greatest(F.lit(0.0), 1.0 - y * margin)
    return slack * slack


def cross_entropy(df: DataFrame, probability: str | Column, name: str = "cross_entropy") -> DataFrame:
    """Mean negative log probability of the true class."""
    return df.agg((F.sum(-F.ln(_col(probability))) / F.count(F.lit(1))).alias(name))


def l2_distance(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Norm of the difference of two vectors; a missing entry is zero."""
    a = left.select(key, F.col(value).alias("_a"))
    b = right.select(key, F.col(value).alias("_b"))
    gap = F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))
    return a.join(b, key, "full").agg(F.sqrt(F.sum(gap * gap)).alias("l2"))


def dataset_sizes(df: DataFrame, split: str, batch_size: int = 64) -> DataFrame:
    """Rows and mini-batches of each split."""
    rows = F.count(F.lit(1))
    return df.groupBy(split).agg(rows.alias("rows"), F.ceil(rows / batch_size).cast("long").alias("batches"))


def best_epoch(trace: DataFrame, loss: str = "loss", epoch: str = "iter") -> DataFrame:
    """Epoch with the smallest loss; the earliest one wins a tie."""
    first = F.min(F.struct(F.col(loss).alias("l"), F.col(epoch).alias("e")))
    return trace.agg(first.alias("_b")).select(F.col("_b.e").alias(epoch), F.col("_b.l").alias(loss))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
