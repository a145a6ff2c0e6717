"""A query with its oracle SQL, and results shared by several queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rankloom.plans.views import Views
from rankloom.session import Stored, lasting, scratch

Build = Callable[[Views], DataFrame]
_SAVED: dict[tuple[str, str, str], Stored] = {}


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Views(spark, folder))


def saved(views: Views, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Compute a shared table once per application and folder, and reuse the stored rows."""
    name = (views.spark.sparkContext.applicationId, views.folder, key)
    if name not in _SAVED:
        with scratch(views.spark):
            _SAVED[name] = lasting(build(), key)
    return _SAVED[name].table


def forget() -> None:
    """Delete the shared tables, so that a query is timed with all its work."""
    for stored in _SAVED.values():
        stored.drop()
    _SAVED.clear()


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Double columns rounded, with negative zero made plain."""
    fields = df.schema.fields
    return df.select(
        *[
            (F.round(f.name, digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in fields
        ]
    )
