"""Sparse rows packed into blocks, for linear solvers that walk over them again and again.

Rows are dealt once, in a random order, into blocks of bounded size. A block is one row of
packed arrays and never moves or is written again. A pass sends the weights to the tasks,
which hold them next to their blocks, and adds up one vector for each task by a tree. So
the weights have a bound, ``MOST_FEATURES``; larger models take the joins in ``svm``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.order import hash_key
from rankloom.operators.layout import number_rows
from rankloom.session import Stored, store

MOST_FEATURES = 1_000_000  # Bound on the weights that travel whole: 8 MB.
PIECE = 65_536  # Values of a vector that stay together when tasks' vectors are added up.
FAN = 16  # Vectors added up in one group of the tree, and by the driver at its root.
BLOCK_SCHEMA = "block int, names array<string>, y binary, ends binary, at binary, val binary"


@dataclass
class Rows:
    """A block in a task: rows' ids and signs, and their cells (row, place of the feature, value)."""

    names: list[str]
    y: np.ndarray
    row: np.ndarray
    at: np.ndarray
    val: np.ndarray
    size: int

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * weights[self.at], len(self.y))

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.val * values[self.row], self.size)

    def take(self, chosen: np.ndarray) -> Rows:
        """The rows of these numbers, in this order."""
        place = np.full(len(self.y), -1)
        place[chosen] = np.arange(len(chosen))
        row = place[self.row]
        in_it = row >= 0
        names = [self.names[i] for i in chosen.tolist()]
        return Rows(names, self.y[chosen], row[in_it], self.at[in_it], self.val[in_it], self.size)


def unpacked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Rows]:
    for batch in batches:
        names, *packed = batch.columns[1:]
        for i in range(batch.num_rows):
            y, ends, at, val = (np.frombuffer(c[i].as_buffer(), t) for c, t in zip(packed, (float, np.int64, np.int32, float)))
            yield Rows(names[i].as_py(), y, np.repeat(np.arange(len(y)), np.diff(ends, prepend=0)), at, val, size)


@dataclass
class RowBlocks:
    """Blocks of rows; ``ids`` are the features in the order of the weights."""

    table: DataFrame
    stored: Stored
    ids: np.ndarray
    rows: int
    block_rows: int
    tasks: int

    def total(self, part: Callable[[Rows], np.ndarray], size: int) -> np.ndarray:
        """Sum of ``part`` over all blocks, vectors of ``size``."""
        features = len(self.ids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, found = np.zeros(size), False
            for rows in unpacked(batches, features):
                mine += part(rows)
                found = True
            if found:
                task = TaskContext.get().partitionId()
                for a in range(0, size, PIECE):
                    yield _piece(a, task, mine[a : a + PIECE])

        sums = self.table.mapInArrow(run, "start long, task int, part binary")
        width = self.tasks
        while width > FAN:
            sums = sums.withColumn("task", (F.col("task") / FAN).cast("int"))
            sums = sums.groupBy("start", "task").applyInArrow(_added, "start long, task int, part binary")
            width = -(-width // FAN)
        out = np.zeros(size)
        for start, part_sum in zip(*(sums.select("start", "part").toArrow()[c].to_pylist() for c in ("start", "part"))):
            values = np.frombuffer(part_sum)
            out[start : start + len(values)] += values
        return out

    def frame(self, values: np.ndarray, column: str, like: DataFrame) -> DataFrame:
        """``(idx, column)``, ``idx`` of the type it has in ``like``."""
        spark = self.table.sparkSession
        kind = like.schema["idx"].dataType
        if not len(values):
            return spark.createDataFrame([], f"idx {kind.simpleString()}, {column} double")
        frame = spark.createDataFrame(pa.table({"idx": self.ids, column: np.asarray(values, float)}))
        return frame.withColumn("idx", F.col("idx").cast(kind))

    def values(self, frame: DataFrame, column: str) -> np.ndarray:
        """A column of ``(idx, column)`` in the order of ``ids``, 0 for features that it lacks."""
        found = frame.select(F.col("idx").cast("long").alias("idx"), F.col(column).cast("double").alias("v")).toArrow()
        known = dict(zip(found["idx"].to_pylist(), found["v"].to_pylist()))
        return np.array([known.get(i, 0.0) for i in self.ids.tolist()])

    def close(self) -> None:
        self.table.unpersist()
        self.stored.drop()


def _piece(start: int, task: int, values: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([start], pa.int64()), pa.array([task], pa.int32()), pa.array([values.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["start", "task", "part"])


def _added(group: pa.Table) -> pa.Table:
    values = sum(np.frombuffer(part) for part in group["part"].to_pylist())
    return pa.Table.from_batches([_piece(group["start"][0].as_py(), group["task"][0].as_py(), values)])


def feature_ids(features: DataFrame) -> np.ndarray | None:
    """Ids of all features, ascending; nothing if they are more than ``MOST_FEATURES``."""
    found = features.select(F.col("idx").cast("long").alias("idx")).distinct().limit(MOST_FEATURES + 1).toArrow()
    return np.sort(found["idx"].to_numpy()) if found.num_rows <= MOST_FEATURES else None


def build(
    features: DataFrame, labels: DataFrame, ids: np.ndarray, block_rows: int | None = None, seed: int = 0, cells: int = 1_000_000
) -> RowBlocks:
    """Pack ``(row_id, idx, val)`` with ``labels`` (row_id, y); cells of other features than ``ids`` are left out.

    Rows are numbered in the md5 order of ``seed:row_id`` and cut every ``block_rows`` rows,
    by default so that a block has about ``cells`` cells. Rows without features stay.
    """
    rows = labels.count()
    if block_rows is None:
        block_rows = max(1, min(65_536, cells * max(rows, 1) // max(features.count(), 1)))
    placed = number_rows(labels.select("row_id", F.col("y").cast("double").alias("y")), [hash_key(seed, "row_id"), F.col("row_id")])
    placed = placed.withColumn("block", F.floor((F.col("pos") - 1) / block_rows).cast("int"))
    known = features.select("row_id", F.col("idx").cast("long").alias("idx"), F.col("val").cast("double").alias("val"))
    joined = placed.join(known, "row_id", "left").select("block", "pos", F.col("row_id").cast("string").alias("name"), "y", "idx", "val")

    def pack(cells: pa.Table) -> pa.Table:
        cells = cells.sort_by([("pos", "ascending"), ("idx", "ascending")])
        pos = cells["pos"].to_numpy()
        first = np.flatnonzero(np.diff(pos, prepend=-1))
        idx = pc.fill_null(cells["idx"], 0).to_numpy()
        at = np.searchsorted(ids, idx)
        full = pc.is_valid(cells["idx"]).to_numpy() & pc.is_valid(cells["val"]).to_numpy()
        full[full] = (at[full] < len(ids)) & (ids[np.minimum(at[full], len(ids) - 1)] == idx[full]) if len(ids) else False
        ends = np.cumsum(np.add.reduceat(full.astype(np.int64), first))
        packed = (
            cells["y"].to_numpy()[first], ends, at[full].astype(np.int32), cells["val"].to_numpy()[full].astype(float),
        )
        arrays = [pa.array([cells["block"][0].as_py()], pa.int32()), pa.array([cells["name"].take(pa.array(first)).to_pylist()])]
        arrays += [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in packed]
        return pa.Table.from_arrays(arrays, ["block", "names", "y", "ends", "at", "val"])

    stored = store(joined.groupBy("block").applyInArrow(pack, BLOCK_SCHEMA), "blocks", sort_by=["block"])
    tasks = max(1, min(-(-rows // block_rows), 2 * features.sparkSession.sparkContext.defaultParallelism))
    table = stored.table.repartition(tasks, "block").persist()
    table.count()
    return RowBlocks(table, stored, ids, rows, block_rows, tasks)
