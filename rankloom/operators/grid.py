"""Ratings in a grid of user blocks and item blocks, for solvers that walk over all of them again and again.

Ratings are packed once into cells (user block, item block), which stay partitioned by
cell. Factors are packed by block. In a step each block of factors goes to the cells of
its row or column; a cell adds up the slopes of its users and items, and the sums are
reduced per block next to the old factors. Ratings never move after the grid is built.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.session import Stored, store

USER, ITEM = 0, 1
Slopes = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]  # (scores, ratings): (slopes, errors)
Update = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float]]  # (values, sums): (new values, its part of the loss)


@dataclass
class Grid:
    """Cells (ub, ib, x, y, z): user ids, item ids and ratings; and the blocks' numbers."""

    cells: DataFrame
    stored: Stored
    blocks: tuple[int, int]
    width: int

    def close(self) -> None:
        self.cells.unpersist()
        self.stored.drop()


def _block(id: str, blocks: int):
    return F.pmod(F.xxhash64(id), F.lit(blocks)).cast("int")


def build(ratings: DataFrame, factors: DataFrame, block_rows: int = 2_000_000, cell_ratings: int = 16_000_000, row_ratings: int = 1_000_000) -> Grid:
    """Pack ``(user_id, item_id, rating)`` whose user and item are in ``factors``; null ratings are left out.

    There is at least a cell a core; a block has about ``block_rows`` ids at most, a
    cell about ``cell_ratings``, and a row of the grid ``row_ratings``. A step moves each
    id's factors once a block of the other side, so blocks are few: their number grows
    with the square root of the ratings.
    """
    spark = ratings.sparkSession
    sizes = {r["kind"]: r["n"] for r in factors.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = ratings.filter("rating IS NOT NULL")
    for kind, column in ((USER, "user_id"), (ITEM, "item_id")):
        known = known.join(factors.filter(F.col("kind") == kind).select(F.col("id").alias(column)), column, "left_semi")
    known = known.select(*[F.col(c).cast("long").alias(c) for c in ("user_id", "item_id")], F.col("rating").cast("double").alias("rating"))
    total = known.count()
    tasks = spark.sparkContext.defaultParallelism
    least = max(1, math.isqrt(tasks - 1) + 1 if total > 10_000 else 1, math.isqrt(total // cell_ratings) + 1)
    blocks = tuple(max(least, math.ceil(sizes.get(kind, 0) / block_rows)) for kind in (USER, ITEM))
    width = max(1, min(blocks[0] * blocks[1], max(tasks, math.ceil(total / cell_ratings))))
    rows = known.select(_block("user_id", blocks[0]).alias("ub"), _block("item_id", blocks[1]).alias("ib"), "user_id", "item_id", "rating")
    rows = rows.repartition(width, "ub", "ib").sortWithinPartitions("ub", "ib", "user_id", "item_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, mine = [], 0, None

        def packed() -> pa.RecordBatch:
            columns = [np.concatenate([h[i] for h in held]).tobytes() for i in range(3)]
            arrays = [pa.array([b], pa.int32()) for b in mine] + [pa.array([c], pa.binary()) for c in columns]
            return pa.RecordBatch.from_arrays(arrays, ["ub", "ib", "x", "y", "z"])

        for batch in batches:
            ub, ib, *values = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((np.diff(ub) != 0) | (np.diff(ib) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ub)]):
                if a == b:
                    continue
                key = (int(ub[a]), int(ib[a]))
                if held and (key != mine or size >= row_ratings):
                    yield packed()
                    held, size = [], 0
                mine = key
                held.append([v[a:b] for v in values])
                size += int(b - a)
        if held:
            yield packed()

    written = store(rows.mapInArrow(run, "ub int, ib int, x binary, y binary, z binary"), "grid")
    cells = written.table.repartition(width, "ub", "ib").sortWithinPartitions("ub", "ib").persist()
    cells.count()  # steps can rely on the partitioning of what is there
    return Grid(cells, written, blocks, width)


def pack(factors: DataFrame, columns: list[str], blocks: tuple[int, int]) -> DataFrame:
    """(kind, block, ids, f): a row for each block, ids ascending and their values in rows."""
    block = F.when(F.col("kind") == USER, _block("id", blocks[0])).otherwise(_block("id", blocks[1])).alias("block")
    rows = factors.select("kind", block, "id", *[F.col(c).cast("double").alias(c) for c in columns])
    rows = rows.repartition("kind", "block").sortWithinPartitions("kind", "block", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine = [], None

        def packed() -> pa.RecordBatch:
            ids, values = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            arrays = [pa.array([b], pa.int32()) for b in mine] + [pa.array([v.tobytes()], pa.binary()) for v in (ids, values)]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "block", "ids", "f"])

        for batch in batches:
            kind, number, ids, *values = (c.to_numpy() for c in batch.columns)
            table = np.stack(values, axis=1)
            cuts = np.flatnonzero((np.diff(kind) != 0) | (np.diff(number) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ids)]):
                if a == b:
                    continue
                key = (int(kind[a]), int(number[a]))
                if held and key != mine:
                    yield packed()
                    held = []
                mine = key
                held.append((ids[a:b], table[a:b]))
        if held:
            yield packed()

    return rows.mapInArrow(run, "kind int, block int, ids binary, f binary")


def unpack(packed: DataFrame, columns: list[str], width: int) -> DataFrame:
    """(kind, id, *columns) from blocks whose rows hold ``width`` values, of which the first are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, ids, f in zip(*(c.to_pylist() for c in batch.columns)):
                ids, values = np.frombuffer(ids, np.int64), np.frombuffer(f, np.float64).reshape(-1, width)
                arrays = [pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids)]
                arrays += [pa.array(np.ascontiguousarray(values[:, i])) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(arrays, ["kind", "id", *columns])

    types = "kind int, id long, " + ", ".join(f"{c} double" for c in columns)
    return packed.select("kind", "ids", "f").mapInArrow(run, types)


def cell_sums(grid: Grid, state: DataFrame, latent: int, values: int, slopes: Slopes) -> DataFrame:
    """(kind, block, other, g, loss): each cell's sums of slope times other side, and its errors, counted with the users."""
    sides = []
    for kind, own, other, count in ((USER, "ub", "ib", grid.blocks[1]), (ITEM, "ib", "ub", grid.blocks[0])):
        side = state.filter(F.col("kind") == kind).select(
            F.col("block").alias(own), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(other),
            F.col("ids").alias(f"ids{kind}"), F.col("f").alias(f"f{kind}"),
        )
        sides.append(side.repartition(grid.width, "ub", "ib"))
    met = grid.cells.join(sides[0], ["ub", "ib"]).join(sides[1], ["ub", "ib"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sums, loss = None, [], 0.0

        def done() -> Iterator[pa.RecordBatch]:
            if cell:
                ub, ib = cell
                out = [(USER, ub, ib, sums[0].tobytes(), loss), (ITEM, ib, ub, sums[1].tobytes(), 0.0)]
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["kind", "block", "other", "g", "loss"])

        for batch in batches:
            for ub, ib, x, y, z, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                ids = [np.frombuffer(packed[i], np.int64) for i in (0, 2)]
                tables = [np.frombuffer(packed[i], np.float64).reshape(-1, values)[:, :latent] for i in (1, 3)]
                if (ub, ib) != cell:
                    yield from done()
                    cell, sums, loss = (ub, ib), [np.zeros(t.shape) for t in tables], 0.0
                u, i = (np.searchsorted(known, np.frombuffer(b, np.int64)) for known, b in zip(ids, (x, y)))
                mine, theirs = tables[0][u], tables[1][i]
                slope, error = slopes(np.einsum("ij,ij->i", mine, theirs), np.frombuffer(z, np.float64))
                for total, place, far in ((sums[0], u, theirs), (sums[1], i, mine)):
                    for k in range(latent):
                        total[:, k] += np.bincount(place, slope * far[:, k], len(total))
                loss += float(error.sum())
        yield from done()

    wanted = met.select("ub", "ib", "x", "y", "z", "ids0", "f0", "ids1", "f1")
    return wanted.mapInArrow(run, "kind int, block int, other int, g binary, loss double")


def step(grid: Grid, state: DataFrame, latent: int, values: int, slopes: Slopes, update: Update) -> Stored:
    """One step over all ratings: (kind, block, ids, f, loss), stored."""
    sums = cell_sums(grid, state, latent, values, slopes)
    none = F.lit(None).cast("binary")
    rows = state.select("kind", "block", F.lit(-1).alias("other"), "ids", "f", F.lit(0.0).alias("loss")).unionByName(
        sums.select("kind", "block", "other", none.alias("ids"), F.col("g").alias("f"), "loss")
    )
    rows = rows.repartition("kind", "block").sortWithinPartitions("kind", "block", "other", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (kind, block), group in groupby(every, key=itemgetter(0, 1)):
            _, _, _, ids, f, _ = next(group)  # the block's values come first
            old = np.frombuffer(f, np.float64).reshape(-1, values)
            total, loss = np.zeros((len(old), latent)), 0.0
            for row in group:
                total += np.frombuffer(row[4], np.float64).reshape(-1, latent)
                loss += row[5]
            new, own = update(old, total)
            arrays = [pa.array([kind], pa.int32()), pa.array([block], pa.int32()), pa.array([ids], pa.binary()), pa.array([new.tobytes()], pa.binary()), pa.array([loss + own])]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "block", "ids", "f", "loss"])

    ordered = rows.select("kind", "block", "other", "ids", "f", "loss")
    return store(ordered.mapInArrow(run, "kind int, block int, ids binary, f binary, loss double"), "factors")
