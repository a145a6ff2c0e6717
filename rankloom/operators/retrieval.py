"""Fusion of link ranks with search relevance into ranked lists.

A run is ``(user_id, query_id, doc, rel)``; one list per ``(user_id, query_id)``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.numeric import geometric_mean, harmonic_mean
from rankloom.functions.order import snap
from rankloom.operators.layout import number_rows
from rankloom.session import scratch, stash

LIST = ["user_id", "query_id"]
FLOOR = 1e-10  # Fixed value: stands in for a zero or invalid normalised score.


def single_docs(run: DataFrame) -> DataFrame:
    """One row per document of a list; the last one of a list wins."""
    return run.groupBy(*LIST, "doc").agg(F.max_by("rel", "orig_rank").alias("rel"))


def run_score_join(run: DataFrame, ranks: DataFrame) -> DataFrame:
    """Add ``rank`` to the run, from ``(id, rank)`` or per-list ``(user_id, query_id, doc, rank)``."""
    if "id" in ranks.columns:
        return run.join(ranks.select(F.col("id").alias("doc"), "rank"), "doc", "left")
    return run.join(ranks.select(*LIST, "doc", "rank"), [*LIST, "doc"], "left")


def invalid_as_null(score: Column) -> Column:
    return F.when(score != F.lit(float("-inf")), score)


def score_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """Valid minimum and maximum of each column per list."""
    sides = []
    for c in columns:
        valid = invalid_as_null(F.col(c))
        sides += [F.min(valid).alias(f"low_{c}"), F.max(valid).alias(f"high_{c}")]
    return df.groupBy(*LIST).agg(*sides)


def clamp_zero(value: Column) -> Column:
    return F.when((value == 0) | (value == F.lit(float("-inf"))) | value.isNull(), F.lit(FLOOR)).otherwise(value)


def list_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """Min-max scaling inside each list as ``<column>_unit``.

    Ranges come from a partial aggregation joined back, so a huge list is
    neither sorted nor held by one task. A list without spread gets the floor.
    """
    joined = df.join(score_range(df, columns), LIST)
    units = []
    for c in columns:
        spread = F.nullif(F.col(f"high_{c}") - F.col(f"low_{c}"), F.lit(0.0))
        units.append(clamp_zero((F.col(c) - F.col(f"low_{c}")) / spread).alias(f"{c}_unit"))
    return joined.select(*df.columns, *units)


def list_l1(df: DataFrame, column: str, name: str) -> DataFrame:
    """Divide by the list's sum of absolute values; a zero sum counts as one."""
    sums = df.groupBy(*LIST).agg(F.sum(F.abs(F.col(column))).alias("_sum"))
    share = F.col(column) / F.coalesce(F.nullif("_sum", F.lit(0.0)), F.lit(1.0))
    return df.join(sums, LIST).select(*df.columns, share.alias(name))


def l1_norms(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(*LIST).agg(F.sum(F.abs(F.col(column))).alias("l1"))


def _uniform(key: np.ndarray, draw: int) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on the key and the draw only (splitmix64)."""
    z = key + np.uint64((draw + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def _gamma(shape: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Gamma draws for shapes above zero: squeeze method on ``shape + 1``, scaled down."""
    d = shape + 2.0 / 3.0
    out, left, draw = np.zeros(len(shape)), np.arange(len(shape)), 1
    while len(left):
        u = [_uniform(key[left], draw + i) for i in range(3)]
        normal = np.sqrt(-2.0 * np.log(u[0])) * np.cos(2.0 * np.pi * u[1])
        dl = d[left]
        v = (1.0 + normal / np.sqrt(9.0 * dl)) ** 3
        good = (v > 0) & (np.log(u[2]) < normal**2 / 2 + dl - dl * v + dl * np.log(np.where(v > 0, v, 1.0)))
        out[left[good]] = (dl * v)[good]
        left, draw = left[~good], draw + 3
    return out * _uniform(key, 0) ** (1.0 / shape)


def _gamma_draw(shape: pd.Series, key: pd.Series) -> pd.Series:
    """One draw per row; a row's share of its list's sum is a Dirichlet draw."""
    return pd.Series(_gamma(shape.to_numpy(), key.to_numpy().astype(np.uint64)))


def _coefficient(variant: str, pr: Column, rel: Column, seed: int) -> Column:
    if variant == "C00":
        return F.pandas_udf(_gamma_draw, "double")(rel, F.xxhash64(F.lit(seed), *LIST, "doc"))
    formulas = {
        "C01": lambda: pr + rel,
        "C02": lambda: F.abs(pr - rel),
        "C03": lambda: (pr + rel) / 2.0,
        "C04": lambda: F.greatest(pr, rel),
        "C05": lambda: geometric_mean(pr, rel),
        "C06": lambda: harmonic_mean(pr, rel),
        "C07": lambda: F.exp(rel) - F.exp(pr),
        "C08": lambda: F.exp(rel) + F.exp(pr),
        "C09": lambda: F.ln(rel) - F.ln(pr),
        "C10": lambda: -F.ln(pr) - F.ln(rel),
    }
    if variant not in formulas:
        raise ValueError(f"variant must be C00 or one of {sorted(formulas)}")
    return formulas[variant]()


def fuse_ns(scored: DataFrame) -> DataFrame:
    """Score by link rank alone."""
    return scored.withColumn("score", F.col("rank"))


def fuse_ws(scored: DataFrame, p_weight: float = 0.999, s_weight: float = 0.001) -> DataFrame:
    """Weighted sum of link rank and relevance."""
    if p_weight < 0 or s_weight < 0 or abs(p_weight + s_weight - 1) > 1e-9:
        raise ValueError("weights must be non-negative and add up to 1")
    return scored.withColumn("score", p_weight * F.col("rank") + s_weight * F.col("rel"))


def fuse_cm(scored: DataFrame, variant: str = "C07", seed: int = 0) -> DataFrame:
    """Relevance scaled to [0, 1] plus a coefficient of both scaled scores.

    The scored run and its units are each read twice, as rows and as sums of
    their lists, so they are stored once.
    """
    with scratch(scored.sparkSession) as own:
        units = stash(list_minmax(stash(scored, "scored"), ["rank", "rel"]), "units")
        raw = _coefficient(variant, F.abs(F.col("rank_unit")), F.abs(F.col("rel_unit")), seed)
        mixed = list_l1(stash(units.withColumn("_raw", raw), "mixed"), "_raw", "_share")
        return own.keep(mixed.select(*scored.columns, (F.col("rel_unit") + F.col("_share")).alias("score")))


def fuse(scored: DataFrame, method: str, variant: str = "C07", **weights: float) -> DataFrame:
    if method == "NS":
        return fuse_ns(scored)
    if method == "WS":
        return fuse_ws(scored, **weights)
    if method == "CM":
        return fuse_cm(scored, variant)
    raise ValueError("method must be NS, WS or CM")


def rank_run(fused: DataFrame, digits: int = 10) -> DataFrame:
    """Positions from 1 in each list by score; equal scores by document text, descending.

    Scores are compared by their first ``digits`` significant digits, so
    summation noise does not decide the order and the size of the scores does
    not matter.
    """
    rows = fused.withColumn("_snap", snap(F.col("score"), digits))
    order = [F.col("_snap").desc(), F.col("doc").cast("string").desc()]
    return number_rows(rows, order, LIST, "position").drop("_snap")


def retrieve(
    run: DataFrame, ranks: DataFrame, method: str = "WS", variant: str = "C07", **weights: float
) -> DataFrame:
    """Ranked lists ``(user_id, query_id, doc, position, score)`` for a run and link ranks.

    A document that a list repeats counts once: its last row in the order of
    ``orig_rank`` if the run has it, else the row of the greatest relevance.
    """
    if "orig_rank" in run.columns:
        run = single_docs(run)
    else:
        run = run.groupBy(*LIST, "doc").agg(F.max("rel").alias("rel"))
    if "id" not in ranks.columns:
        ranks = ranks.groupBy(*LIST, "doc").agg(F.max("rank").alias("rank"))
    scored = run_score_join(run, ranks)
    return rank_run(fuse(scored, method, variant, **weights)).select(*LIST, "doc", "position", "score")
