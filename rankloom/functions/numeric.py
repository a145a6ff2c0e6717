"""Scalar formulas shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def geometric_mean(a: Column, b: Column) -> Column:
    return F.exp((F.ln(a) + F.ln(b)) / 2.0)


def harmonic_mean(a: Column, b: Column) -> Column:
    return 2.0 * a * b / (a + b)


def total(terms: list[Column]) -> Column:
    return reduce(lambda left, right: left + right, terms)


def dot(left: list[str], right: list[str]) -> Column:
    """Inner product of two groups of columns."""
    return total([F.col(a) * F.col(b) for a, b in zip(left, right, strict=True)])


def softmax(scores: list[Column]) -> list[Column]:
    """Class probabilities; the row maximum is subtracted for stability."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    powers = [F.exp(s - top) for s in scores]
    norm = total(powers)
    return [p / norm for p in powers]


def argmax(values: list[Column], labels: list[int]) -> Column:
    """Label of the greatest value; the first label wins a tie."""
    best = F.greatest(*values) if len(values) > 1 else values[0]
    choice = F.lit(labels[-1])
    for value, label in reversed(list(zip(values, labels, strict=True))):
        choice = F.when(value == best, F.lit(label)).otherwise(choice)
    return choice


def star_class(stars: Column, classes: int = 5) -> Column:
    """Star label to a zero-based class; null when there is no label."""
    return F.when(stars.between(1, classes), (stars - 1).cast("int"))


def sentiment_label(folder: Column) -> Column:
    return F.when(folder == "positive", F.lit("pos")).when(folder == "negative", F.lit("neg"))
