"""Similarity of users or items and exact nearest neighbours.

Ratings are ``(user_id, item_id, rating)``, already centred on the neutral score. The
entities to search are dealt into packs of bounded size, long vectors first; a pack holds
posting lists, the raters of each cell. Each block of query entities stays in one task
and meets the packs one after another. A pack is left out for a query if the largest
rating of each list bounds what it can add below the query's k-th neighbour so far. Pairs
are never stored; a task keeps ``k`` neighbours a query and one pack.

An entity without a common cell is as similar as its sums say, so only the ends of the
order by them can be near. These ends make the first packs, which are compared entity by
entity; of the other packs, a block receives the posting lists of its own cells only. A
query that is not sure of its neighbours then (nearly all of an end shares cells with it,
or ties reach beyond) meets all packs in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rankloom.operators.layout import top_per_group
from rankloom.session import cleaned, durable, stash

MEASURES = ("dot", "cosine")
NOISE = 1e-13  # A similarity below this share of its greatest possible size is zero.
PRODUCTS = 2_000_000  # Fixed value: products, or copies of ratings, that a task works on at once.


@dataclass(frozen=True)
class Measure:
    """Similarity formula on a raw dot product and per-vector sums.

    ``centred`` subtracts ``sum / divisor`` from all ``cells`` of both vectors
    in closed form, so nothing becomes dense.
    """

    kind: str = "dot"
    centred: bool = False
    divisor: float = 1.0
    cells: float = 0.0

    def __post_init__(self) -> None:
        if self.kind not in MEASURES:
            raise ValueError(f"measure must be one of {MEASURES}")

    def norm(self, total: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Length of vectors from their sums."""
        if not self.centred:
            return np.sqrt(square)
        mean = total / self.divisor
        return np.sqrt(np.maximum(square - 2.0 * mean * total + self.cells * mean * mean, 0.0))

    @property
    def factor(self) -> float:
        """What centring adds to a product, over the product of the sums."""
        return self.cells / self.divisor**2 - 2.0 / self.divisor if self.centred else 0.0


def _snapped(value: np.ndarray, digits: int = 10) -> np.ndarray:
    """Rounded half up to significant digits, so that ranking ignores summation noise at any size of the values."""
    out = np.zeros_like(value)
    some = value != 0
    scale = np.power(10.0, digits - 1 - np.floor(np.log10(np.abs(value[some]))))
    out[some] = np.floor(value[some] * scale + 0.5) / scale
    return out


def vector_sums(ratings: DataFrame, entity: str) -> DataFrame:
    """Sum and sum of squares of each entity's ratings."""
    return ratings.groupBy(F.col(entity).alias("id")).agg(
        F.sum("rating").alias("s"),
        F.sum(F.col("rating") * F.col("rating")).alias("ss"),
        F.count(F.lit(1)).alias("n"),
    )


def l2_norms(ratings: DataFrame, entity: str) -> DataFrame:
    return vector_sums(ratings, entity).select("id", F.sqrt("ss").alias("l2"))


def entity_mean(ratings: DataFrame, entity: str, divisor: float) -> DataFrame:
    """Row (or column) sum over a fixed divisor, not over the number of ratings."""
    return vector_sums(ratings, entity).select("id", (F.col("s") / F.lit(float(divisor))).alias("mean"))


WIDTHS = (np.int8, np.int32, np.float32, np.int64, np.float64)


def _least_bytes(values: np.ndarray) -> bytes:
    """The values in the narrowest type that holds them exactly; the first byte names it."""
    with np.errstate(invalid="ignore", over="ignore"):
        for code, width in enumerate(WIDTHS):
            if np.dtype(width).kind == "f" and values.dtype.kind != "f":
                continue
            small = values.astype(width)
            if width == values.dtype or (small == values).all():
                return bytes([code]) + small.tobytes()
    raise TypeError(values.dtype)


def _pressed(ids: np.ndarray, cell: np.ndarray, value: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ratings in ascending order of cells in few bytes."""
    return _least_bytes(ids), cell[:1].tobytes() + _least_bytes(np.diff(cell)), _least_bytes(value)


def _unpressed(row: tuple[bytes, bytes, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def wide(packed: bytes, dtype: type) -> np.ndarray:
        return np.frombuffer(packed, WIDTHS[packed[0]], offset=1).astype(dtype)

    steps = wide(row[1][8:], np.int64)
    return wide(row[0], np.int64), np.frombuffer(row[1][:8], np.int64) + np.append(0, steps.cumsum()), wide(row[2], np.float64)


class Vectors:
    """Entities with their sums and ratings, put together from the rows of a pack; postings by cell where wanted."""

    def __init__(self, rows: list[tuple], formula: Measure):
        def column(kind: int, at: int, dtype: type) -> np.ndarray:
            return np.frombuffer(b"".join(r[at] for r in rows if r[0] == kind), dtype)

        ids, total, square = column(0, 1, np.int64), column(0, 2, np.float64), column(0, 3, np.float64)
        order = np.argsort(ids)
        self.ids, self.total = ids[order], total[order]
        self.size = formula.norm(self.total, square[order])
        whole = [(column(1, 1, np.int64), column(1, 2, np.int64), column(1, 3, np.float64))]
        entity, self.cell, self.value = map(np.concatenate, zip(*whole, *(_unpressed(r[1:]) for r in rows if r[0] == 2)))
        self.place = np.searchsorted(self.ids, entity)

    def by_entity(self) -> Vectors:
        order = np.lexsort((self.cell, self.place))
        self.cell, self.value, self.place = self.cell[order], self.value[order], self.place[order]
        self.ends = np.searchsorted(self.place, np.arange(len(self.ids) + 1))
        return self

    def by_cell(self, formula: Measure) -> Vectors:
        order = np.argsort(self.cell, kind="stable")
        self.cell, self.value, self.place = self.cell[order], self.value[order], self.place[order]
        self.cells, self.starts = np.unique(self.cell, return_index=True)
        self.stops = np.append(self.starts[1:], len(self.cell))
        scale = 1.0
        if formula.kind == "cosine":
            with np.errstate(divide="ignore"):
                scale = np.where(self.size > 0, 1.0 / self.size, 0.0)
            size = np.abs(self.value) * scale[self.place]
        else:
            size = np.abs(self.value)
        self.most = np.maximum.reduceat(size, self.starts) if len(size) else size
        share = self.total * scale
        self.shares = (share.min(initial=0.0), share.max(initial=0.0))
        return self


class Search:
    """The nearest entities so far of each query of a block."""

    def __init__(self, queries: Vectors, formula: Measure, keep: int, skip_self: bool):
        self.queries, self.formula, self.keep, self.skip_self = queries, formula, keep, skip_self
        none = np.zeros(0), np.zeros(0, np.int64), np.zeros(0)
        self.best = [none] * len(queries.ids)  # (key, id, similarity), best first
        self.skipped = 0
        self.flat: list[np.ndarray] | None = None  # the same with the query's place first, once packs come in shared cells only

    def _bounds(self, pack: Vectors, known: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """No entity of the pack can be more similar to a query than this."""
        q = self.queries
        most = pack.most[slots] if len(pack.most) else np.zeros(len(slots))
        added = np.append(np.where(known, np.abs(q.value) * most, 0.0).cumsum(), 0.0)
        sums = added[q.ends[1:] - 1] - added[q.ends[:-1] - 1]
        push = self.formula.factor * q.total
        sums = sums + np.maximum(push * pack.shares[0], push * pack.shares[1])
        if self.formula.kind == "cosine":
            sums = np.where(q.size > 0, sums / np.where(q.size > 0, q.size, 1.0), 0.0)
        noise = NOISE * (1.0 if self.formula.kind == "cosine" else q.size * pack.size.max(initial=0.0))
        return sums + np.abs(sums) * 1e-9 + 1e-12 * (1.0 + added[:-1].max(initial=0.0)) + noise

    def _known(self, pack: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """Place of each query rating's cell in the pack, and whether the pack has it."""
        cell = self.queries.cell
        slots = np.minimum(np.searchsorted(pack.cells, cell), max(len(pack.cells) - 1, 0))
        return slots, pack.cells[slots] == cell if len(pack.cells) else np.zeros(len(cell), bool)

    def meet(self, pack: Vectors) -> None:
        """Compare all queries with all entities of the pack that can still be among their nearest."""
        q, formula, keep = self.queries, self.formula, self.keep
        if not len(pack.ids):
            return
        slots, known = self._known(pack)
        bounds = self._bounds(pack, known, slots)
        selves = np.searchsorted(pack.ids, q.ids) if self.skip_self else None
        for i in range(len(q.ids)):
            keys, ids, sims = self.best[i]
            full = len(keys) == keep
            if full and bounds[i] < keys[-1]:
                self.skipped += 1
                continue
            mine = slice(q.ends[i], q.ends[i + 1])
            mine = np.flatnonzero(known[mine]) + q.ends[i]
            starts = pack.starts[slots[mine]]
            lengths = pack.stops[slots[mine]] - starts
            at = np.arange(lengths.sum()) + np.repeat(starts - np.append(0, lengths.cumsum()[:-1]), lengths) if len(mine) else starts
            dot = np.bincount(pack.place[at], pack.value[at] * np.repeat(q.value[mine], lengths), len(pack.ids))
            if formula.centred:
                dot = dot + formula.factor * q.total[i] * pack.total
            sizes = q.size[i] * pack.size
            if formula.kind == "cosine":
                dot = np.divide(dot, sizes, out=np.zeros(len(dot)), where=sizes != 0)
                sizes = 1.0
            key = np.where(np.abs(dot) <= NOISE * sizes, 0.0, dot)
            if selves is not None and selves[i] < len(pack.ids) and pack.ids[selves[i]] == q.ids[i]:
                key[selves[i]] = -np.inf
            if full:
                least = keys[-1]
            else:
                wanted = min(keep, len(key))
                least = np.partition(key, len(key) - wanted)[len(key) - wanted]
            near = np.flatnonzero((key >= least - abs(least) * 1e-8 if np.isfinite(least) else key > -np.inf) & (key > -np.inf))
            if not len(near):
                continue
            keys = np.concatenate([keys, _snapped(key[near])])
            ids = np.concatenate([ids, pack.ids[near]])
            sims = np.concatenate([sims, dot[near]])
            order = np.lexsort((-ids, -keys))[:keep]
            self.best[i] = keys[order], ids[order], sims[order]

    def meet_shared(self, pack: Vectors) -> None:
        """Compare queries with the entities of the pack that share a cell with them."""
        q, formula = self.queries, self.formula
        if self.flat is None:
            self._flatten()
        if not len(pack.cells) or not len(q.cell):
            return
        slots, known = self._known(pack)
        near = self._bounds(pack, known, slots) >= self.least
        self.skipped += len(near) - np.count_nonzero(near)
        asks = np.flatnonzero(known & near[q.place])
        lengths = pack.stops[slots[asks]] - pack.starts[slots[asks]]
        work = np.bincount(q.place[asks], lengths, len(q.ids))
        turn = ((work.cumsum() - work) // PRODUCTS)[q.place[asks]]
        for part in np.split(np.arange(len(asks)), np.flatnonzero(np.diff(turn)) + 1):
            if not len(part):
                continue
            mine, many = asks[part], lengths[part]
            at = np.arange(many.sum()) + np.repeat(pack.starts[slots[mine]] - (many.cumsum() - many), many)
            pairs = np.repeat(q.place[mine], many) * len(pack.ids) + pack.place[at]
            order = np.argsort(pairs, kind="stable")
            pairs = pairs[order]
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            dot = np.add.reduceat((pack.value[at] * np.repeat(q.value[mine], many))[order], first)
            i, j = np.divmod(pairs[first], len(pack.ids))
            if formula.centred:
                dot = dot + formula.factor * q.total[i] * pack.total[j]
            sizes = q.size[i] * pack.size[j]
            if formula.kind == "cosine":
                dot = np.divide(dot, sizes, out=np.zeros(len(dot)), where=sizes != 0)
                sizes = 1.0
            key = np.where(np.abs(dot) <= NOISE * sizes, 0.0, dot)
            least = self.least[i]
            wanted = key >= np.where(np.isfinite(least), least - np.abs(least) * 1e-8, least)
            if self.skip_self:
                wanted &= q.ids[i] != pack.ids[j]
            self._wait([i[wanted], _snapped(key[wanted]), pack.ids[j[wanted]], dot[wanted]])

    def _flatten(self) -> None:
        counts = [len(b[0]) for b in self.best]
        columns = [np.concatenate([b[k] for b in self.best]) if self.best else np.zeros(0) for k in range(3)]
        self.flat = [np.repeat(np.arange(len(counts)), counts), columns[0], columns[1].astype(np.int64), columns[2]]
        self.waiting, self.room = [], 0
        self._merge()

    def _wait(self, rows: list[np.ndarray]) -> None:
        self.waiting.append(rows)
        self.room += len(rows[0])
        if self.room > max(PRODUCTS // 4, len(self.flat[0])):
            self._merge()

    def _merge(self) -> None:
        """Take the nearest of those found so far and those that wait."""
        place, key, ids, sim = (np.concatenate(c) for c in zip(self.flat, *self.waiting))
        order = np.lexsort((-ids, -key, place))
        place = place[order]
        self.starts = np.searchsorted(place, np.arange(len(self.queries.ids) + 1))
        rank = np.arange(len(place)) - self.starts[place]
        kept = rank < self.keep
        order = order[kept]
        self.flat, self.waiting, self.room = [place[kept], key[order], ids[order], sim[order]], [], 0
        self.starts = np.searchsorted(self.flat[0], np.arange(len(self.queries.ids) + 1))
        self.least = np.full(len(self.queries.ids), -np.inf)
        full = np.diff(self.starts) == self.keep
        self.least[full] = self.flat[1][self.starts[1:][full] - 1]

    def unsure(self, ends: dict[int, End]) -> np.ndarray:
        """Queries that an entity outside the ends, without a common cell, could still be near."""
        if self.flat is None:
            self._flatten()
        self._merge()
        q, formula = self.queries, self.formula
        push = formula.factor * q.total
        if formula.kind == "cosine":
            push = np.where(q.size > 0, push / np.where(q.size > 0, q.size, 1.0), 0.0)
        noise = NOISE * 1.01 * (1.0 if formula.kind == "cosine" else q.size * ends[0].longest)
        full = np.isfinite(self.least)
        last = np.full(len(q.ids), -1, np.int64)
        last[full] = self.flat[2][self.starts[1:][full] - 1]
        sure = np.zeros(len(q.ids), bool)
        for sign, end in ends.items():
            def most(share: float) -> np.ndarray:
                value = push * share
                value = value + np.abs(value) * 1e-10
                return _snapped(np.where(np.abs(value) <= noise, np.maximum(value, 0.0), value))

            mine = np.sign(push) == sign
            value = most(end.last)
            beaten = value < self.least
            if end.below is None:
                level = np.ones(len(q.ids), bool)
            else:
                level = most(end.below) < self.least
            sure |= mine & full & (beaten | ((value <= self.least) & level & (last >= end.least_id)))
        return ~sure

    def found(self, unsure: np.ndarray | None = None) -> pa.RecordBatch:
        """The neighbours by rank; an unsure query has one row of rank 0 instead."""
        if self.flat is None:
            self._flatten()
        self._merge()
        place, key, ids, sim = self.flat
        rank = (np.arange(len(place)) - self.starts[place] + 1).astype(np.int32)
        arrays = [self.queries.ids[place], ids, sim, key, rank]
        if unsure is not None and unsure.any():
            sure, open_ids = ~unsure[place], self.queries.ids[unsure]
            none = [np.zeros(len(open_ids), a.dtype) for a in arrays[1:]]
            arrays = [np.concatenate(c) for c in zip([a[sure] for a in arrays], [open_ids, *none])]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["a", "b", "sim", "_key", "rank"])


@dataclass(frozen=True)
class End:
    """Where an end of the order by shares stops: all entities outside it have at most this share of the sums.

    ``least_id`` is the smallest id in it of those of the ``last`` share, ``below`` the
    next share outside, ``longest`` the length of the longest vector.
    """

    last: float
    least_id: int
    below: float | None
    longest: float


def _ends(others: DataFrame, formula: Measure, room: int) -> tuple[DataFrame | None, dict[int, End]]:
    """``(id)`` of the ends of the order by shares, and where they stop; None if the ends are everything.

    Entities without a common cell with a query are near in the order of their share of
    the sums, upwards or downwards by the sign of the query's own, and by id where it is
    zero. Shares are told apart by twelve digits, equal ones ordered by id, descending.
    """
    mean = F.col("s") / F.lit(formula.divisor)
    square = F.col("ss") - F.lit(2.0) * mean * F.col("s") + F.lit(formula.cells) * mean * mean if formula.centred else F.col("ss")
    size = F.sqrt(F.greatest(square, F.lit(0.0)))
    share = F.when(size > 0, F.col("s") / size).otherwise(0.0) if formula.kind == "cosine" else F.col("s")
    shares = others.select("id", F.format_string("%.11e", share).cast("double").alias("share"), size.alias("size"))
    whole = shares.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("longest")).first()
    if whole["n"] <= room:
        return None, {}
    by_id = durable(shares.orderBy(F.desc("id")).limit(room).select("id"))
    ids = by_id.agg(F.min("id").alias("id")).first()["id"]
    chosen, ends = by_id, {0: End(0.0, ids, None, whole["longest"])}
    for sign in (1, -1) if formula.factor else ():
        up = sign > 0  # the greatest shares are near, not the smallest ones
        end = durable(shares.orderBy(F.desc("share") if up else F.asc("share"), F.desc("id")).limit(room))
        last = end.agg((F.min if up else F.max)("share").alias("share")).first()["share"]
        least = end.filter(F.col("share") == last).agg(F.min("id").alias("id")).first()["id"]
        outside = shares.filter(F.col("share") < last) if up else shares.filter(F.col("share") > last)
        below = outside.agg((F.max if up else F.min)("share").alias("share")).first()["share"]
        ends[sign] = End(last, least, below, whole["longest"])
        chosen = chosen.unionByName(end.select("id"))
    return chosen.distinct(), ends


def _routed(asked: DataFrame, postings: DataFrame, packs: int, parts: int) -> DataFrame:
    """(block, pack, kind, x, y, z): the ratings of each pack in the cells of each block, pressed (kind 2).

    ``asked`` is (block, cell), ``postings`` (no, id, cell, v). Both are dealt by cell; a
    task holds the blocks of its cells and hands on its ratings as they come.
    """
    rows = asked.select(F.lit(0).alias("kind"), F.col("block").alias("no"), F.lit(0).cast("long").alias("id"), "cell", F.lit(0.0).alias("v"))
    rows = rows.unionByName(postings.select(F.lit(1).alias("kind"), "no", "id", "cell", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = ["block", "pack", "kind", "x", "y", "z"]

        def sent(no: np.ndarray, ids: np.ndarray, cell: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            at = np.minimum(np.searchsorted(cells, cell), max(len(cells) - 1, 0))
            some = np.flatnonzero(cells[at] == cell) if len(cells) else np.zeros(0, np.int64)
            some = some[np.argsort(cell[some], kind="stable")]
            many = (stops - starts)[at[some]] if len(cells) else some
            for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(many.cumsum() // PRODUCTS)) + 1):
                if not len(part):
                    continue
                copies, row = many[part], some[part]
                to = blocks[np.arange(copies.sum()) + np.repeat(starts[at[row]] - (copies.cumsum() - copies), copies)]
                row = np.repeat(row, copies)
                goal = to.astype(np.int64) * packs + no[row]
                order = np.argsort(goal.astype(np.uint16) if goal.max() < 1 << 16 else goal, kind="stable")
                goal, row = goal[order], row[order]
                cuts = np.flatnonzero(np.append(True, goal[1:] != goal[:-1]))
                out = [
                    (*divmod(int(goal[a]), packs), 2, *_pressed(ids[row[a:b]], cell[row[a:b]], v[row[a:b]]))
                    for a, b in zip(cuts, np.append(cuts[1:], len(goal)))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        wanted, waiting, cells = [], [], None
        for batch in batches:
            kind, no, ids, cell, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            split = np.searchsorted(kind, 1)
            if split:
                wanted.append((cell[:split], no[:split]))
            if split == len(kind):
                continue
            if cells is None:
                pairs = [np.concatenate(c) for c in zip(*wanted)] if wanted else [np.zeros(0, np.int64), np.zeros(0, np.int32)]
                order = np.lexsort((pairs[1], pairs[0]))
                held, blocks = pairs[0][order], pairs[1][order]
                new = np.append(True, (held[1:] != held[:-1]) | (blocks[1:] != blocks[:-1]))[: len(held)]
                held, blocks = held[new], blocks[new]
                cells, starts = np.unique(held, return_index=True)
                stops = np.append(starts[1:], len(held))
            waiting.append((no[split:], ids[split:], cell[split:], v[split:]))
            if sum(len(w[0]) for w in waiting) >= PRODUCTS // 8:
                yield from sent(*(np.concatenate(c) for c in zip(*waiting)))
                waiting = []
        if waiting:
            yield from sent(*(np.concatenate(c) for c in zip(*waiting)))

    dealt = rows.repartition(parts, "cell").sortWithinPartitions("kind").select("kind", "no", "id", "cell", "v")
    return dealt.mapInArrow(run, "block int, pack int, kind int, x binary, y binary, z binary")


def _packed(entities: DataFrame, ratings: DataFrame | None) -> DataFrame:
    """(no, kind, x, y, z): entities (kind 0: ids, sums, squares) and ratings (kind 1: ids, cells, values) of each number, as arrays.

    ``entities`` is (no, id, s, ss), ``ratings`` (id, cell, v), if any. A row holds at most as many entries as an Arrow batch.
    """
    zero = F.lit(0).cast("long").alias("cell")
    rows = entities.select("no", F.lit(0).alias("kind"), "id", zero, F.col("s").alias("y"), F.col("ss").alias("z"))
    if ratings is not None:
        rated = ratings.join(entities.select("id", "no"), "id").select(
            "no", F.lit(1).alias("kind"), F.col("id"), F.col("cell"), F.lit(0.0).alias("y"), F.col("v").alias("z")
        )
        rows = rated.unionByName(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no, kind, ids, cell, y, z = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.flatnonzero((np.diff(no) != 0) | (np.diff(kind) != 0)) + 1
            out = []
            for part in np.split(np.arange(len(no)), cuts):
                if len(part):
                    middle = cell if kind[part[0]] else y
                    out.append((int(no[part[0]]), int(kind[part[0]]), *(v[part].tobytes() for v in (ids, middle, z))))
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(arrays, ["no", "kind", "x", "y", "z"])

    sorted_rows = rows.repartition("no").sortWithinPartitions("no", "kind")
    return sorted_rows.mapInArrow(run, "no int, kind int, x binary, y binary, z binary")


def _dealt(others: DataFrame, formula: Measure, entities: int, ratings: int) -> tuple[DataFrame, int]:
    """Number each entity's pack, longer vectors in earlier packs; a pack has about so many entities or ratings.

    Only the loads of some hundred steps of length reach the driver.
    """
    mean = F.col("s") / F.lit(formula.divisor)
    square = F.col("ss") - 2.0 * mean * F.col("s") + F.lit(formula.cells) * mean * mean if formula.centred else F.col("ss")
    step = F.floor(F.log2(1.0 + F.greatest(square, F.lit(0.0))) * 2).cast("int")
    placed = others.withColumn("step", step)
    load = F.sum(F.lit(1.0 / entities) + F.col("n") / F.lit(float(ratings)))
    loads = placed.groupBy("step").agg(load.alias("load")).orderBy(F.desc("step")).collect()
    first, room, ways = 0, 0.0, []
    for row in loads:
        if row["load"] > 1.0:  # packs of its own, by the hash of the id
            first += room > 0
            count, room = math.ceil(row["load"]), 0.0
            ways.append((row["step"], first, count))
            first += count
        else:
            if room + row["load"] > 1.0:
                first, room = first + 1, 0.0
            ways.append((row["step"], first, 1))
            room += row["load"]
    table = F.broadcast(others.sparkSession.createDataFrame(ways, "step int, first int, count int"))
    no = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("count"))).cast("int")
    return placed.join(table, "step").withColumn("no", no).drop("step", "first", "count"), first + 1


@cleaned
def nearest(
    profiles: DataFrame,
    train: DataFrame,
    query_ids: DataFrame,
    universe: DataFrame,
    by: str = "user",
    measure: str = "dot",
    centred: bool = False,
    k: int = 5,
    cells: int | None = None,
    denominator: str = "reference",
    self_mode: str = "drop_top",
    block_queries: int = 16_384,
    pack_entities: int = 16_384,
    pack_ratings: int = 1_000_000,
    end_entities: int = 1024,
) -> DataFrame:
    """``(a, b, sim, rank)``: the ``k`` nearest train entities of each query entity.

    ``query_ids`` and ``universe`` have one column ``id``. ``cells`` is the
    length of the vectors, needed when ``centred``. ``self_mode='drop_top'``
    drops the best of ``k + 1`` candidates, ``'exclude'`` the entity itself.
    Similarities are compared by ten significant digits; equal ones are ordered
    by id, descending. Ids are whole numbers; null ids and ratings do not count.
    The last four parameters bound what a task holds and change no result.
    """
    if by not in ("user", "item"):
        raise ValueError("by must be user or item")
    if self_mode not in ("drop_top", "exclude") or denominator not in ("reference", "pearson"):
        raise ValueError("unknown self_mode or denominator")
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    if centred and cells is None:
        raise ValueError("centred similarity needs the number of cells")
    entity, cell = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    if not all(isinstance(df.schema[c].dataType, IntegralType) for df in (profiles, train) for c in (entity, cell)):
        raise TypeError("ids must be whole numbers")

    def side(ratings: DataFrame, ids: DataFrame) -> DataFrame:
        rows = ids.select(F.col("id").cast("long").alias("id")).filter("id IS NOT NULL").distinct()
        sums = vector_sums(ratings.filter(F.col(entity).isNotNull() & F.col("rating").isNotNull()), entity)
        return durable(rows.join(sums, "id", "left").select("id", *[F.coalesce(c, F.lit(0)).cast(t).alias(c) for c, t in (("s", "double"), ("ss", "double"), ("n", "long"))]))

    def cells_of(ratings: DataFrame) -> DataFrame:
        rows = ratings.filter((F.col("rating") != 0) & F.col(cell).isNotNull())
        return rows.select(*[F.col(c).cast("long").alias(n) for c, n in ((entity, "id"), (cell, "cell"))], F.col("rating").cast("double").alias("v"))

    queries, others = side(profiles, query_ids), side(train, universe)
    divisor = others.count() if denominator == "reference" else (cells or 1)
    formula = Measure(measure, centred, float(divisor or 1), float(cells or 0))
    keep = k + 1 if self_mode == "drop_top" else k
    skip_self = self_mode == "exclude"

    spark = train.sparkSession
    tasks = spark.sparkContext.defaultParallelism

    def met(slots: DataFrame, tasks: int, full: int, ends: dict[int, End]) -> DataFrame:
        """Let each block meet its packs in turn, those numbered from ``full`` in shared cells only."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
            search, mine = None, None
            for (slot, pack), group in groupby(rows, key=itemgetter(0, 1)):
                if slot != mine:
                    if search is not None:
                        yield search.found(search.unsure(ends) if ends else None)
                    search, mine = None, slot
                vectors = Vectors([r[2:] for r in group], formula)
                if pack < 0:
                    search = Search(vectors.by_entity(), formula, keep, skip_self)
                elif search is not None:  # a block without queries has none
                    meet = search.meet if pack < full else search.meet_shared
                    meet(vectors.by_cell(formula))
            if search is not None:
                yield search.found(search.unsure(ends) if ends else None)

        ordered = slots.repartitionById(tasks, F.col("slot")).sortWithinPartitions("slot", "pack", "kind")
        ordered = ordered.select("slot", "pack", "kind", "x", "y", "z")
        return ordered.mapInArrow(run, "a long, b long, sim double, _key double, rank int")

    def blocks_for(size: int, asked: dict) -> int:
        room = max(1, min(size, 4_000_000 // keep))
        return max(math.ceil(asked["n"] / room), math.ceil(asked["ratings"] / (2 * pack_ratings)), min(tasks, math.ceil(asked["n"] / 64)), 1)

    def counted(queries: DataFrame) -> dict:
        return queries.agg(F.count("id").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("ratings")).first().asDict()

    def in_blocks(queries: DataFrame, blocks: int) -> DataFrame:
        """Blocks of queries, dealt by hash; a task holds one, with its neighbours so far."""
        return queries.withColumn("no", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def in_full(queries: DataFrame) -> DataFrame:
        """Every block meets every entity; few queries share their packs among more tasks."""
        blocks = blocks_for(min(block_queries, 2048), counted(queries))
        placed, packs = _dealt(others, formula, pack_entities, pack_ratings)
        parts = min(packs, max(1, math.ceil(tasks / blocks)))
        asking = stash(_packed(in_blocks(queries, blocks), cells_of(profiles)), "near-queries")
        asking = asking.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(-1).alias("pack"), F.col("no").alias("block"), "kind", "x", "y", "z")
        known = stash(_packed(placed, cells_of(train)), "near-packs")
        known = known.select(F.col("no").alias("pack"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod("no", F.lit(parts)).alias("part"), "kind", "x", "y", "z")
        slots = asking.unionByName(known).withColumn("slot", (F.col("block") * parts + F.col("part")).cast("int"))
        best = met(slots, blocks * parts, packs, {})
        if parts > 1:
            order = [F.col("_key").desc(), F.col("b").desc()]
            best = top_per_group(stash(best.drop("rank"), "near-parts"), ["a"], order, keep, ["b"], "rank")
        return best

    def in_shared_cells(queries: DataFrame, blocks: int, near: DataFrame, ends: dict[int, End]) -> DataFrame:
        """Every block meets the ends in full and else the entities that share its cells."""
        head, full = _dealt(others.join(F.broadcast(near), "id", "left_semi"), formula, pack_entities, pack_ratings)
        rest, packs = _dealt(others.join(F.broadcast(near), "id", "left_anti"), formula, 16 * pack_entities, 2 * pack_ratings)
        packs += full
        placed = stash(head.unionByName(rest.withColumn("no", F.col("no") + full)), "near-packs")
        mine = in_blocks(queries, blocks)
        asking = stash(_packed(mine, cells_of(profiles)), "near-queries").select(F.col("no").alias("slot"), F.lit(-1).alias("pack"), "kind", "x", "y", "z")
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("slot")
        sums = _packed(placed, None).select(every, F.col("no").alias("pack"), "kind", "x", "y", "z")
        asked = cells_of(profiles).join(mine.select("id", F.col("no").alias("block")), "id").select("block", "cell")
        postings = cells_of(train).join(placed.select("id", "no"), "id")
        parts = max(tasks, math.ceil(placed.agg(F.sum("n")).first()[0] / pack_ratings))
        routed = _routed(asked, postings, packs, parts).withColumnRenamed("block", "slot")
        return met(asking.unionByName(sums).unionByName(routed), blocks, full, ends)

    asked = counted(queries)
    blocks = blocks_for(block_queries, asked)
    near, ends = (None, {}) if blocks < tasks else _ends(others, formula, keep + end_entities)
    if near is None:
        best = in_full(queries)
    else:
        best = durable(in_shared_cells(queries, blocks, near, ends).drop("_key"))
        unsure = best.filter("rank = 0").select(F.col("a").alias("id"))
        best = best.filter("rank > 0")
        if unsure.limit(1).count():
            best = best.unionByName(in_full(queries.join(unsure, "id", "left_semi")).select(best.columns))
    if self_mode == "drop_top":
        best = best.filter("rank > 1").withColumn("rank", F.col("rank") - 1)
    return best.select("a", "b", "sim", "rank")
