"""Deterministic pseudo-random order and start values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(seed: int | str, *columns: str | Column) -> Column:
    """md5 of ``seed:col:col``; sorting by it is a reproducible shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in columns]))


def start_value(row: str | Column, slot: int) -> Column:
    """Reproducible start value in [0, 1) for factor ``slot`` of ``row``."""
    return F.pmod(_col(row).cast("long") * 7919 + slot * 104729, F.lit(1000)) / F.lit(1000.0)


def snap(value: Column, digits: int = 10) -> Column:
    """Round half up to significant digits, so that ranking ignores summation noise at any size of the values."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, 0.0).otherwise(F.floor(value * scale + 0.5) / scale)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
