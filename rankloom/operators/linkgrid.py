"""Links in a grid of source blocks and target blocks, for ranks that walk over all of them again and again.

Nodes are dealt into blocks by hash. Links are packed once into cells (source block,
target block) as places in the two blocks and stay partitioned by cell; the links of a
hot source are shared by its row of cells. In a step each block of ranks goes to the
cells of its row, and a cell sends one number for each node of its target block, however
many links meet there. Neither links nor ids move after the grid is built. Cells keep what
turns a rank into what it sends per weight, so ranks are all that a step moves and stores;
equal bytes of many ranks stand together, which packs well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.session import Stored, durable, store

WIDTHS = (np.int8, np.int16, np.int32, np.int64, np.float64)


def _narrow(values: np.ndarray) -> bytes:
    """The values in the narrowest type that holds them exactly; the first byte names it."""
    with np.errstate(invalid="ignore", over="ignore"):
        for code, width in enumerate(WIDTHS):
            small = values.astype(width)
            if (small.astype(values.dtype) == values).all() or width == np.float64:
                return bytes([code]) + small.tobytes()
    raise TypeError(values.dtype)


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, WIDTHS[packed[0]], offset=1)


def _planes(values: np.ndarray) -> bytes:
    """Doubles as the first bytes of all, then the second ones, and so on: signs and exponents are much alike."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _doubles(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.float64).ravel()


@dataclass
class LinkGrid:
    """Cells (sb, db, n, x, y, w, out, copies): nodes of the target block, places of sources and targets, weights, and
    ``out`` and ``copies`` of the source block; ``nodes`` (block, n, none, ids, out, copies, marks).

    A block keeps each id once, in order, with the number of its copies among the nodes;
    a null id comes first and has no links. ``out`` is the weight of all links of a node,
    ``marks`` has a byte a node for each column asked for.
    """

    cells: DataFrame
    nodes: DataFrame
    blocks: int
    size: int

    def close(self) -> None:
        self.cells.unpersist()


def _block(id: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id).cast("long")), F.lit(blocks)).cast("int")


def _packed_nodes(nodes: DataFrame, marks: list[str], blocks: int) -> DataFrame:
    rows = nodes.select(
        _block("id", blocks).alias("block"), F.col("id").isNull().cast("int").alias("none"),
        F.coalesce(F.col("id").cast("long"), F.lit(0)).alias("id"), "out", "copies", *[F.col(m).cast("byte").alias(m) for m in marks],
    ).repartition("block").sortWithinPartitions("block", F.desc("none"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine = [], None

        def packed() -> pa.RecordBatch:
            none, ids, out, copies, *flags = (np.concatenate(c) for c in zip(*held))
            row = [mine, len(ids), int(none.sum()), ids.tobytes(), _narrow(out), _narrow(copies), np.array(flags, np.int8).tobytes()]
            kinds = [*[pa.int32()] * 3, *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["block", "n", "none", "ids", "out", "copies", "marks"])

        for batch in batches:
            block, *values = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero(np.diff(block)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(block)]):
                if a == b:
                    continue
                if held and int(block[a]) != mine:
                    yield packed()
                    held = []
                mine = int(block[a])
                held.append([v[a:b] for v in values])
        if held:
            yield packed()

    return rows.mapInArrow(run, "block int, n int, none int, ids binary, out binary, copies binary, marks binary")


def _packed_links(edges: DataFrame, blocks: int, row_links: int) -> DataFrame:
    """(sb, db, x, y, w): source ids, steps between ascending target ids, and weights, at most ``row_links`` a row.

    A task packs the links it reads by cell, so what moves is packed; the rows of a cell are put together where they meet.
    """
    known = edges.filter("src IS NOT NULL AND dst IS NOT NULL AND weight IS NOT NULL")
    rows = known.select(
        _block("src", blocks).alias("sb"), _block("dst", blocks).alias("db"),
        F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"), F.col("weight").cast("double").alias("w"),
    )

    def packed(cell: int, parts: list) -> pa.RecordBatch:
        src, dst, w = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((src, dst))
        dst = dst[order]
        row = [*divmod(cell, blocks), _narrow(src[order]), dst[:1].tobytes() + _narrow(np.diff(dst)), _narrow(w[order])]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["sb", "db", "x", "y", "w"])

    def gathered(links: Iterator[tuple[int, list[np.ndarray]]], most: float) -> Iterator[pa.RecordBatch]:
        """Packed rows of links that come by cell; at most about ``most`` links are held."""
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        total = 0
        for cell, values in links:
            for at in range(0, len(values[0]), row_links):
                part = [v[at : at + row_links] for v in values]
                n = len(part[0])
                if size.get(cell, 0) + n > row_links:
                    total -= size.pop(cell)
                    yield packed(cell, held.pop(cell))
                held.setdefault(cell, []).append(part)
                size[cell] = size.get(cell, 0) + n
                total += n
            if total >= most:
                yield from (packed(c, held[c]) for c in held)
                held, size, total = {}, {}, 0
        yield from (packed(c, held[c]) for c in held)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[tuple[int, list[np.ndarray]]]:
            for batch in batches:
                sb, db, *values = (c.to_numpy() for c in batch.columns)
                cells = sb.astype(np.int64) * blocks + db
                for cell in np.unique(cells).tolist():
                    mine = np.flatnonzero(cells == cell)
                    yield cell, [v[mine] for v in values]

        return gathered(links(), row_links)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[tuple[int, list[np.ndarray]]]:
            for batch in batches:
                for sb, db, x, y, w in zip(*(c.to_pylist() for c in batch.columns)):
                    yield sb * blocks + db, [*_ids(x, y), _wide(w).astype(np.float64)]

        return gathered(links(), math.inf)  # a task has a few cells

    row = "sb int, db int, x binary, y binary, w binary"
    return rows.mapInArrow(read, row).repartition(blocks * blocks, "sb", "db").mapInArrow(met, row)


def _ids(x: bytes, y: bytes) -> list[np.ndarray]:
    """Sources and targets of a packed row of links."""
    return [_wide(x).astype(np.int64), np.frombuffer(y[:8], np.int64) + np.append(0, _wide(y[8:]).cumsum(dtype=np.int64))]


def _placed(links: DataFrame, nodes: DataFrame, blocks: int) -> DataFrame:
    """Ids of links turned into places in their blocks; links of ids that are no nodes are left out."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sides = [
        nodes.select(F.col("block").alias(own), every.alias(other), F.col("ids").alias(f"ids_{own}"), F.col("none").alias(f"none_{own}"), *more)
        for own, other, more in (("sb", "db", ["out", "copies"]), ("db", "sb", []))
    ]
    met = links.join(sides[0], ["sb", "db"]).join(sides[1], ["sb", "db"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sb, db, x, y, w, ids_s, none_s, ids_d, none_d, out, copies in zip(*(c.to_pylist() for c in batch.columns)):
                ids = _ids(x, y)
                weights, places, found = _wide(w), [], np.ones(len(ids[0]), bool)
                for mine, packed, none in zip(ids, (ids_s, ids_d), (none_s, none_d)):
                    known = np.frombuffer(packed, np.int64)[none:]
                    at = np.minimum(np.searchsorted(known, mine), max(len(known) - 1, 0))
                    found &= known[at] == mine if len(known) else False
                    places.append((at + none).astype(np.int32))
                if found.any():
                    row = [sb, db, len(ids_d) // 8, *[p[found].tobytes() for p in places], bytes([w[0]]) + weights[found].tobytes(), out, copies]
                    kinds = [*[pa.int32()] * 3, *[pa.binary()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["sb", "db", "n", "x", "y", "w", "out", "copies"])

    wanted = met.select("sb", "db", "x", "y", "w", "ids_sb", "none_sb", "ids_db", "none_db", "out", "copies")
    return wanted.mapInArrow(run, "sb int, db int, n int, x binary, y binary, w binary, out binary, copies binary")


def build(nodes: DataFrame, edges: DataFrame, sums: DataFrame, marks: list[str], row_links: int = 4_000_000, cell_links: int = 16_000_000) -> LinkGrid:
    """Lay out ``edges(src, dst, weight)`` for steps over ``nodes(id, ...)``, both with whole numbers as ids.

    ``sums`` is ``(src, out_weight, links)``. There is at least a cell for two cores, as a step
    moves more for more blocks and the cells are a small part of its time; a cell
    has about ``cell_links`` links at most.
    """
    total = sums.agg(F.sum("links")).first()[0] or 0
    tasks = -(-nodes.sparkSession.sparkContext.defaultParallelism // 2)
    blocks = max(1, math.isqrt(tasks - 1) + 1 if total > 10_000 else 1, math.isqrt(max(total - 1, 0) // cell_links) + 1)
    once = nodes.groupBy("id").agg(F.count(F.lit(1)).alias("copies"), *[F.max(m).alias(m) for m in marks])
    once = once.join(sums.select(F.col("src").alias("id"), F.col("out_weight").alias("out")), "id", "left")
    once = once.withColumn("out", F.coalesce(F.col("out").cast("double"), F.lit(0.0)))
    laid = durable(_packed_nodes(once, marks, blocks))
    cells = _placed(_packed_links(edges, blocks, row_links), laid, blocks)
    cells = cells.repartition(blocks * blocks, "sb", "db").sortWithinPartitions("sb", "db").persist()
    cells.count()  # steps can rely on the partitioning of what is there
    return LinkGrid(cells, laid, blocks, nodes.count())


STATE = "block int, col int, f binary, mass double, gap double, total double"


def _weighed(out: bytes, copies: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Weights of all links and copies of the nodes of a block."""
    return _wide(out).astype(np.float64), _wide(copies).astype(np.int64)


def _row(block: int, col: int, f: np.ndarray, old: np.ndarray, out: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
    """Ranks of a column in a block, and their sums."""
    gap = f - old
    sums = (f * copies)[out == 0].sum(), (gap * gap * copies).sum(), (np.abs(f) * copies).sum()
    arrays = [pa.array([block], pa.int32()), pa.array([col], pa.int32()), pa.array([_planes(f)], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays + [pa.array([float(s)]) for s in sums], ["block", "col", "f", "mass", "gap", "total"])


def start(grid: LinkGrid, columns: int, value: float) -> Stored:
    """(block, col, f, mass, gap, total): the same rank for every node, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                out, copies = _weighed(*packed)
                f = np.full(len(out), value)
                for col in range(columns):
                    yield _row(block, col, f, f, out, copies)

    return store(grid.nodes.select("block", "out", "copies").mapInArrow(run, STATE), "ranks")


COLUMN_VALUES = 16_000_000  # Fixed value: ranks of a block that a task holds at once, over all columns.


def step(grid: LinkGrid, state: DataFrame, columns: int, moving: dict[int, tuple[float, float, float]], damping: float, gated: bool) -> Stored:
    """One step of those of the ``columns`` in ``moving``; the others are not in the result.

    A moving column has the mass that dangling nodes hand to each node (if ``gated``, to
    each dangling one), what every node gets, and what nodes with the column's mark get.
    """
    blocks = grid.blocks
    active = state.filter(F.col("col").isin(list(moving))) if len(moving) < columns else state
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("db")

    def flows(cell: pa.Table, sent: pa.Table) -> pa.Table:
        """What arrives in the target block over the links of a cell, for each column that its source block sends."""
        found = []
        if cell.num_rows:
            out, copies = _weighed(cell["out"][0].as_py(), cell["copies"][0].as_py())
            x, y = ([np.frombuffer(v.as_buffer(), np.int32) for v in cell[c]] for c in ("x", "y"))
            w = [_wide(v) for v in cell["w"].to_pylist()]
            for f in sent["f"]:
                each = np.divide(_doubles(f.as_buffer()) * copies, out, out=np.zeros(len(out)), where=out != 0)  # per weight of a link
                flow = np.zeros(cell["n"][0].as_py())
                for one, two, weights in zip(x, y, w):
                    flow += np.bincount(two, each[one] * weights, len(flow))
                found.append(_planes(flow))
        sb, db, col = (pa.array(sent[c].to_pylist()[: len(found)], pa.int32()) for c in ("sb", "db", "col"))
        return pa.table({"block": db, "col": col, "other": sb, "f": pa.array(found, pa.binary())})

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (block, col), group in groupby(every, key=itemgetter(0, 1)):
            _, _, _, _, out, copies, marks = next(group)  # what a block keeps comes first, then its ranks
            old, (out, copies) = _doubles(next(group)[3]), _weighed(out, copies)
            flow = np.zeros(len(old))
            for row in group:
                flow += _doubles(row[3])
            leak, base, extra = moving[col]
            new = damping * flow + leak * ((out == 0) if gated else 1.0) + base
            if marks:
                new += extra * np.frombuffer(marks, np.int8)
            yield _row(block, col, new, old, out, copies)

    some = max(1, COLUMN_VALUES // max(1, grid.size // blocks))
    sums, names = [], sorted(moving)
    for a in range(0, len(names), some):
        part = active.filter(F.col("col").isin(names[a : a + some])) if len(names) > some else active
        sent = part.select(F.col("block").alias("sb"), every, "col", "f").repartition(blocks * blocks, "sb", "db")
        pairs = grid.cells.groupBy("sb", "db").cogroup(sent.groupBy("sb", "db"))
        sums.append(pairs.applyInArrow(flows, "block int, col int, other int, f binary"))
    each = F.explode(F.array(*[F.lit(c) for c in moving]))
    kept = grid.nodes.select("block", "n", each.alias("col"), F.lit(-2).alias("other"), "out", "copies", "marks")
    kept = kept.withColumn("marks", F.substring("marks", F.col("col") * F.col("n") + 1, F.col("n"))).drop("n")
    ranks = active.select("block", "col", F.lit(-1).alias("other"), "f")
    ranks = reduce(DataFrame.unionByName, sums, ranks)
    rows = kept.unionByName(ranks, allowMissingColumns=True).repartition("block", "col").sortWithinPartitions("block", "col", "other")
    return store(rows.select("block", "col", "other", "f", "out", "copies", "marks").mapInArrow(moved, STATE), "ranks")


SLICE = 65_536  # Fixed value: nodes of a block that are written out together.


def unpack(grid: LinkGrid, state: DataFrame, names: list[str]) -> DataFrame:
    """(id, *names): the columns of the state by node, a row for each copy of an id."""

    def sliced_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, col, f in zip(*(c.to_pylist() for c in batch.columns)):
                f = _doubles(f)
                for i, a in enumerate(range(0, len(f), SLICE)):
                    row = [pa.array([block], pa.int32()), pa.array([i], pa.int32()), pa.array([col], pa.int32()), pa.array([f[a : a + SLICE].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, ["block", "slice", "col", "f"])

    def sliced_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, none, ids, copies in zip(*(c.to_pylist() for c in batch.columns)):
                ids, copies = np.frombuffer(ids, np.int64), _wide(copies)
                for i, a in enumerate(range(0, len(ids), SLICE)):
                    numbers = [pa.array([v], pa.int32()) for v in (block, i, 0 if i else none)]
                    packed = [pa.array([v], pa.binary()) for v in (ids[a : a + SLICE].tobytes(), _narrow(copies[a : a + SLICE]))]
                    yield pa.RecordBatch.from_arrays(numbers + packed, ["block", "slice", "none", "ids", "copies"])

    fs = state.select("block", "col", "f").mapInArrow(sliced_ranks, "block int, slice int, col int, f binary")
    fs = fs.groupBy("block", "slice").agg(F.sort_array(F.collect_list(F.struct("col", "f"))).alias("fs"))  # an array for each column
    ids = grid.nodes.select("block", "none", "ids", "copies").mapInArrow(sliced_nodes, "block int, slice int, none int, ids binary, copies binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for none, ids, copies, fs in zip(*(c.to_pylist() for c in batch.columns)):
                copies = _wide(copies)
                at = np.repeat(np.arange(len(copies)), copies)
                for part in np.split(at, range(SLICE, len(at), SLICE)):
                    arrays = [pa.array(np.frombuffer(ids, np.int64)[part], mask=part < none), *[pa.array(np.frombuffer(f)[part]) for f in fs]]
                    yield pa.RecordBatch.from_arrays(arrays, ["id", *names])

    types = "id long, " + ", ".join(f"{n} double" for n in names)
    return ids.join(fs, ["block", "slice"]).select("none", "ids", "copies", F.col("fs.f").alias("fs")).mapInArrow(run, types)
