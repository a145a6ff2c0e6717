"""Session defaults and durable storage of intermediate results."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, fields, is_dataclass, replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rankloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are designed for."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A session that names none
    uses a folder in its warehouse, which all executors share too.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if folder is None and current is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/rankloom-work"
    if current is None:
        context.setCheckpointDir(folder)
        current = context.getCheckpointDir()
    return folder or current


_OWNED: list[list[str]] = []


@contextmanager
def _owner(paths: list[str]) -> Iterator[None]:
    """Tables stored inside belong to ``paths``."""
    _OWNED.append(paths)
    try:
        yield
    finally:
        _OWNED.pop()


class Scratch:
    """Written tables of one computation; at its end all are deleted but those it keeps."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self._outer = _OWNED[-1] if _OWNED else []

    def store(self, df: DataFrame, name: str) -> Stored:
        """Store a table that lives as long as the computation, or until it is dropped."""
        with _owner(self.paths):
            return store(df, name)

    def keep(self, result):
        """Store a result's DataFrame for the computation around this one, or for good if there is none."""
        if isinstance(result, DataFrame):
            with _owner(self._outer):
                return stash(result, "result")
        if isinstance(result, tuple):
            return tuple(map(self.keep, result))
        if is_dataclass(result):
            return replace(result, **{f.name: self.keep(getattr(result, f.name)) for f in fields(result)})
        return result

    def outside(self):
        """Tables stored inside belong to the computation around this one."""
        return _owner(self._outer)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Own all tables that are stored inside, and delete them at the end."""
    own = Scratch()
    try:
        with _owner(own.paths):
            yield own
    finally:
        for path in own.paths:
            remove(spark, path)


def cleaned(operator: Callable) -> Callable:
    """Let an operator's result outlive the call, stored, and delete all other tables that it stored."""

    @wraps(operator)
    def run(*args, **kwargs):
        table = next(x for x in (*args, *kwargs.values()) if isinstance(x, DataFrame))
        with scratch(table.sparkSession) as own:
            return own.keep(operator(*args, **kwargs))

    return run


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def arrow_rows(spark: SparkSession, most: int):
    """Queries that run inside send Python tasks at most ``most`` rows at a time."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(most))


def dense_tables(spark: SparkSession):
    """Tables stored inside take fewer bytes and more CPU than those of the session's codec."""
    return _setting(spark, "spark.sql.parquet.compression.codec", "zstd")


def lasting(df: DataFrame, name: str) -> Stored:
    """Store a table that no computation owns."""
    with _owner([]):
        return store(df, name)


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage by a written table, which outlives executors."""
    return stash(df, "durable")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the durable folder, noted by the computation that owns it."""
    path = f"{durable_dir(spark).rstrip('/')}/rankloom/{name}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    return path


def stash(df: DataFrame, name: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write to the durable folder as parquet and read it back.

    With ``sort_by`` the files are range partitioned and sorted, so a later
    filter on the first column skips the row groups it does not need. More
    columns let a large run of equal first values spread over many files.
    """
    return store(df, name, sort_by).table


@dataclass
class Stored:
    """A written table that can be dropped once it is replaced."""

    table: DataFrame
    path: str

    def drop(self) -> None:
        remove(self.table.sparkSession, self.path)


def store(df: DataFrame, name: str, sort_by: Sequence[str] = ()) -> Stored:
    """Write a table to the durable folder, which cuts its lineage, and give its path as well."""
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), path)


def loop_partitions(spark: SparkSession, rows: int, rows_per_partition: int = 1_000_000) -> int:
    """Partitions for a table that is kept partitioned across loop steps, from its rows alone."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / rows_per_partition))
