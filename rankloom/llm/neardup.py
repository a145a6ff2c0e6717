"""Near-duplicate documents by an inverted join on MinHash signature coordinates.

Documents of equal shingle sets are one node. A node is posted under the pairs of
coordinate and value of its signature that other nodes share: only under the rarest
of them, because two signatures that agree in ``matches`` of ``coordinates`` places
must meet in the first ``coordinates - matches + 1`` under any common order. Lists
are worked off in two steps. First every list compares its members with one hub, so
groups of copies fall together with one comparison a member. Then lists whose members
are not yet in one component compare what remains, in blocks, and pass on only links
that join components; two nodes that meet in several lists are compared in the first.
Signatures of enough equal places are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import broadcast_if_small, chunks, text_slices, tidy_task
from rankloom.llm.words import mix, shingle_sets
from rankloom.session import stash

COORDINATES = 64
MATCHES = 38  # a pair of similarity 0.8 has fewer equal places with a probability of 3 in 100,000
BLOCK = 1024
SLICE = 250_000  # bytes of texts at a time; their words take about a hundred times as much


def _multipliers(coordinates: int) -> np.ndarray:
    return mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """MinHash values (set, coordinate) of sets that are not empty."""
    out = np.zeros((len(sets), coordinates), np.uint32)
    if sets:
        every = np.concatenate(sets)
        first = np.cumsum([0, *map(len, sets[:-1])])
        for i, factor in enumerate(_multipliers(coordinates)):
            out[:, i] = np.minimum.reduceat(every * factor, first) >> np.uint64(32)
    return out


def _described(df: DataFrame, kind: str, words: int, coordinates: int) -> DataFrame:
    """(id, n_shingles, digest of the set, signature, one byte of each coordinate), a row for each row."""

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE):
                sets = shingle_sets(texts, words)
                full = [i for i, s in enumerate(sets) if len(s)]
                signs = np.zeros((b - a, coordinates), np.uint32)
                signs[full] = signature([sets[i] for i in full], coordinates)
                with np.errstate(over="ignore"):
                    sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
                    other = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
                flat = pa.array(signs.ravel().view(np.int32))
                offsets = pa.array(np.arange(b - a + 1, dtype=np.int32) * coordinates)
                columns = [
                    batch.column(0)[a:b],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sums.view(np.int64)),
                    pa.array(other.view(np.int64)),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array([row.tobytes() for row in signs.astype(np.uint8)], pa.binary()),
                    batch.column(2)[a:b],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "d1", "d2", "sign", "code", "copy"])

    return df.mapInArrow(run, f"id {kind}, n_shingles long, d1 long, d2 long, sign array<int>, code binary, copy long")


def _prefixes(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(node, tokens): the rarest shared coordinate values that can decide, rarest first.

    A token holds the coordinate and the value, exactly.
    """
    token = F.call_function("shiftleft", F.col("coordinate").cast("long"), F.lit(32)).bitwiseOR(
        F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    )
    every = nodes.select("node", F.posexplode("sign").alias("coordinate", "value")).select("node", token.alias("token"))
    shared = every.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = every.join(shared, "token")
    # values of no other node come first in the order and need no list
    own = met.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("v"))
    count = F.size("v") - matches + 1
    return own.filter(count > 0).select("node", F.slice("v.token", F.lit(1), count).alias("tokens"))


def _alike(pairs: DataFrame, nodes: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose signatures agree often enough."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("code").alias(f"c_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = both.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8) for i in (2, 3))
                same = (a == b).reshape(batch.num_rows, -1).sum(axis=1) >= matches
                yield batch.select(["a", "b"]).filter(pa.array(same))

    kind = nodes.schema["node"].dataType.simpleString()
    return sized.select("a", "b", "c_a", "c_b").mapInArrow(run, f"a {kind}, b {kind}")


def _sets(texts: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the documents of the given ids, stored."""
    kind = ids.schema["id"].dataType.simpleString()

    @tidy_task
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, some in text_slices(batch.column(1), SLICE):
                sets = pa.array([s.tobytes() for s in shingle_sets(some, words)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], sets], ["id", "shingles"])

    wanted = stash(ids.distinct(), "near-ids")
    needed = texts.join(broadcast_if_small(wanted, 4_000_000), "id", "left_semi")
    return stash(needed.mapInArrow(make, f"id {kind}, shingles binary"), "near-sets")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets have the similarity."""
    kind = pairs.schema["a"].dataType.simpleString()
    pairs = stash(pairs, "near-pairs")
    sets = _sets(texts, pairs.select(F.explode(F.array("a", "b")).alias("id")), words)

    @tidy_task
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(2), batch.column(3))
            keep = [_similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in both), percent) for both in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")
    return joined.mapInArrow(compare, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for nodes with links.

    Alternates two steps until the links stand still: every node passes its larger
    neighbours, then its smaller ones, on to the smallest neighbour. What is left are
    stars. Nodes are only grouped with partial sums and joined, never gathered.
    """
    ordered = [F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")]
    links = stash(links.filter("a <> b").select(*ordered).distinct(), "near-links")
    while True:
        ends = F.explode(F.array(F.struct(F.col("low").alias("node"), F.col("high").alias("other")),
                                 F.struct(F.col("high").alias("node"), F.col("low").alias("other"))))
        both = links.select(ends.alias("e")).select("e.*")
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = both.filter("other > node").join(least, "node").select(F.col("least").alias("low"), F.col("other").alias("high"))
        large = stash(large.filter("low <> high").distinct(), "near-links")
        down = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(down, "high").select(F.col("least").alias("low"), F.explode(F.array("low", "high")).alias("high"))
        small = stash(small.filter("low <> high").distinct(), "near-links")
        if _sum(small) == _sum(links):
            return small.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
                small.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            )
        links = small


def _sum(links: DataFrame) -> tuple:
    """Number of links and an order-free checksum of them."""
    mixed = F.sum(F.xxhash64("low", "high").cast("decimal(20,0)"))
    return tuple(links.agg(F.count(F.lit(1)), mixed).first())


class _Group:
    """Rows of one list and block pair, and the links among them that join components."""

    def __init__(self, token: int, matches: int, percent: int):
        self.token, self.matches, self.percent = token, matches, percent
        self.columns: list[tuple] = []

    def links(self) -> Iterator[tuple[int, int]]:
        node, component, size, left, right = (np.concatenate([c[i] for c in self.columns]) for i in range(5))
        code = np.concatenate([c[5] for c in self.columns])
        sets = [x for c in self.columns for x in c[6]]
        earlier = [x for c in self.columns for x in c[7]]  # a row's tokens before this list's
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        rows, others = np.flatnonzero(left), np.flatnonzero(right)  # the same rows where a block meets itself
        for start in range(0, len(rows), 64):
            some = rows[start : start + 64]
            n_a, n_b = size[some][:, None], size[others][None, :]
            good = component[some][:, None] != component[others][None, :]
            good &= 100 * np.minimum(n_a, n_b) >= self.percent * np.maximum(n_a, n_b)
            x, y = np.nonzero(good)
            for cut in range(0, len(x), 50_000):
                p, q = some[x[cut : cut + 50_000]], others[y[cut : cut + 50_000]]
                alike = (code[p] == code[q]).sum(axis=1) >= self.matches
                for i, j in zip(p[alike].tolist(), q[alike].tolist()):
                    a, b = root(int(component[i])), root(int(component[j]))
                    if a != b and earlier[i].isdisjoint(earlier[j]) and _similar(sets[i], sets[j], self.percent):
                        up[max(a, b)] = min(a, b)
                        yield int(node[i]), int(node[j])


def _across(mixed: DataFrame, kind: str, matches: int, percent: int) -> DataFrame:
    """Confirmed links between components in one block pair of a list, as many as join all that are linked there.

    Rows come sorted by list and block pair; a group has at most two blocks of nodes.
    """

    @tidy_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = None, None

        def found(done: _Group | None) -> Iterator[pa.RecordBatch]:
            links = list(done.links()) if done else []
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in _parts(batches, 8):
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            node, component, size, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6))
            code = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8).reshape(len(node), -1)
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(8).to_pylist()]
            earlier = [frozenset(t[: t.index(own)]) for t, own in zip(batch.column(9).to_pylist(), keys[:, 0].tolist())]
            left, right = block == keys[:, 1], block == keys[:, 2]
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(node)]):
                key = tuple(keys[a].tolist())
                if key != last:
                    yield from found(group)
                    group, last = _Group(key[0], matches, percent), key
                columns = [x[a:b] for x in (node, component, size, left, right, code, sets, earlier)]
                group.columns.append(tuple(columns))
        yield from found(group)

    return mixed.mapInArrow(run, f"a {kind}, b {kind}")


def _parts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where their ``at``-th column, sets as bytes, reaches a megabyte."""
    for batch in batches:
        for a, b in chunks(pc.binary_length(batch.column(at)).to_pylist()):
            yield batch.slice(a, b - a)


def near_duplicates(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = 4,
    percent: int = 80,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    copy: str | None = None,
) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row for each row.

    Documents are linked if their sets of different ``words``-word shingles share at
    least ``percent`` in a hundred of their union; ``component_id`` is the smallest id
    that links reach. Texts of fewer words are one shingle; null and empty texts have
    none and are linked with nothing. Rows of one id and different texts are told apart
    by their texts, each with the component of its own text; ``copy`` names a further
    column for the text's hash, ``xxhash64``, which tells them apart. A null id is
    linked with nothing, has a null component and stays. Other columns are left out,
    whatever their names. Ids are integers.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = "bigint"
    hashed = rows.withColumn("copy", F.xxhash64(F.col("text"))) if copy else rows.withColumn("copy", F.lit(None).cast("long"))
    described = stash(_described(hashed, kind, words, coordinates), "near-described")
    known = described.filter("n_shingles > 0 AND id IS NOT NULL")
    groups = known.groupBy("d1", "d2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("sign").alias("sign"), F.first("code").alias("code"),
    )
    nodes = stash(groups, "near-nodes")
    prefixes = stash(_prefixes(nodes, coordinates, matches), "near-prefixes")
    posts = prefixes.select("node", F.explode("tokens").alias("token"))

    hubs = posts.groupBy("token").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    hubs = stash(hubs, "near-hubs")
    spokes = posts.join(hubs, "token").filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = stash(_confirmed(_alike(spokes.distinct(), nodes, matches, percent), rows, words, percent), "near-links")
    found = stash(components(links), "near-components")

    # what is left of lists whose members, without the hub, are not all in one component
    rest = posts.join(hubs.filter("n > 2"), "token").filter("node <> hub").drop("n")
    rest = rest.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = rest.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n"))
    split = stash(split.filter("x <> y").select("token", "n"), "near-split")
    left = stash(rest.join(split, "token").select("token", "node", "component", "n"), "near-rest")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    block = F.pmod(F.xxhash64("node"), blocks)
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    blocked = left.withColumn("block", block).withColumn("other", F.explode(every))
    described_nodes = nodes.select("node", "n_shingles", "code").join(prefixes, "node").join(
        _sets(rows, left.select(F.col("node").alias("id")), words).withColumnRenamed("id", "node"), "node"
    )
    keys = ["token", "low", "high"]
    mixed = blocked.join(described_nodes, "node").select(
        "token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "node", "component", "n_shingles", "block", "code", "shingles", "tokens",
    )
    mixed = mixed.repartition(*keys).sortWithinPartitions(*keys)
    more = stash(_across(mixed, kind, matches, percent), "near-links")
    stars = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
    final = components(stars.unionByName(more))

    members = nodes.join(final, "node", "left").filter("copies > 1 OR component IS NOT NULL")
    members = members.select("d1", "d2", F.coalesce("component", "node").alias("component_id"))
    out = described.select("id", "n_shingles", "d1", "d2", "copy").join(stash(members, "near-members"), ["d1", "d2"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    component = F.when(linked, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        *([F.col("copy").alias(copy)] if copy else []),
    )
