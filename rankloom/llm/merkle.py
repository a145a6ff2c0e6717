"""A Merkle manifest of a table, by time-forward processing.

Nodes are labelled so that children come before their parent. A node sends its digest to
its parent's label, and the queue hands out messages by label, so a sweep through the
labels computes every digest; a sweep in reverse order hands each node the proof suffix
of its parent. Trees are cut into tiers of blocks of 2**height neighbours. Between tiers
the queue is a table that Spark sorts by label, on disk if it has to; inside a block it
is a heap of at most a block's nodes. A block holds a bounded part of its tree, so a
group with most of the rows is shared by many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rankloom.llm.common import broadcast_if_small
from rankloom.operators.layout import number_rows
from rankloom.session import stash

HEIGHT = 10
LEFT, RIGHT, ALONE = "l", "r", "-"  # where the sibling of a level stands
_DIGEST = 64  # letters of a hexadecimal sha256


def digest_of(fields: Sequence[Column]) -> Column:
    """sha256 of the fields one after another: ``-`` for null, else bytes, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _join(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def sweep(leaves: list[str], height: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """Digest of the node ``height`` levels above the leaves, and the digests of all children by their parent's label."""
    if not height:
        return leaves[0], {}
    queue = [((1, i >> 1), i, d) for i, d in enumerate(leaves)]  # sorted, so a heap
    inbox: dict[tuple[int, int], list[str]] = {}
    while True:
        label, _, digest = heapq.heappop(queue)
        children = [digest]
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        inbox[label] = children
        level, at = label
        if level == height:
            return _join(children), inbox
        heapq.heappush(queue, ((level + 1, at >> 1), at, _join(children)))


def suffixes(leaves: int, height: int, inbox: dict[tuple[int, int], list[str]], sides: str, siblings: str) -> list[tuple[str, str]]:
    """(sides, siblings) of every leaf's way to the root, from those of the block's root."""
    above = {(height, 0): (sides, siblings)}
    for level, at in sorted(inbox, reverse=True):  # labels in reverse, each drops what it has delivered
        sides, siblings = above.pop((level, at))
        children = inbox[level, at]
        if len(children) == 1:
            above[level - 1, 2 * at] = ALONE + sides, siblings
        else:
            above[level - 1, 2 * at] = RIGHT + sides, children[1] + siblings
            above[level - 1, 2 * at + 1] = LEFT + sides, children[0] + siblings
    return [above[0, i] for i in range(leaves)]


def _height(size: int, most: int) -> int:
    """Levels that a block of a tree of ``size`` nodes in this tier is raised."""
    return min(most, (size - 1).bit_length())


def _by_label(rows: DataFrame, height: int, *first: str) -> DataFrame:
    """A block's rows together, in label order."""
    placed = rows.withColumn("block", F.shiftright("pos", height))
    return placed.repartitionByRange("tree", "block").sortWithinPartitions("tree", "block", *first, "pos")


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _sent(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_NODE = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])
_WAY = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("sides", pa.string()), ("siblings", pa.string()), ("top", pa.string())])


def _up(nodes: DataFrame, height: int) -> DataFrame:
    """One tier up: a node (tree, pos, size, digest) for every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def roots() -> Iterator[tuple]:
            for (tree, block), rows in groupby(_tuples(batches), key=itemgetter(0, 1)):
                members = list(rows)
                size = members[0][2]
                root, _ = sweep([m[3] for m in members], _height(size, height))
                yield tree, block, (size - 1 >> height) + 1, root

        yield from _sent(roots(), _NODE)

    rows = _by_label(nodes, height).select("tree", "block", "size", "digest")
    return rows.mapInArrow(run, "tree string, pos long, size long, digest string")


def _down(nodes: DataFrame, ways: DataFrame | None, height: int, carry: Sequence[str] = ()) -> DataFrame:
    """One tier down: (tree, pos, sides, siblings, top, *carry) of every node; trees of one block start here."""
    mine = nodes.select("tree", "pos", "size", "digest", F.lit("").alias("sides"), F.lit("").alias("siblings"), F.lit(1).alias("kind"), *carry)
    if ways is not None:  # the message to a block comes before its nodes
        message = ways.select(
            "tree", F.shiftleft("pos", height).alias("pos"), F.lit(0).cast("long").alias("size"), F.col("top").alias("digest"),
            "sides", "siblings", F.lit(0).alias("kind"),
        )
        mine = mine.unionByName(message, allowMissingColumns=True)
    names = ["tree", "pos", "sides", "siblings", "top", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def delivered() -> Iterator[tuple]:
            for (tree, _), rows in groupby(_tuples(batches), key=itemgetter(0, 1)):
                members = list(rows)
                head = members.pop(0) if members[0][7] == 0 else None
                levels = _height(members[0][3], height)
                root, inbox = sweep([m[4] for m in members], levels)
                sides, siblings, top = (head[5], head[6], head[4]) if head else ("", "", root)
                for m, (s, d) in zip(members, suffixes(len(members), levels, inbox, sides, siblings)):
                    yield tree, m[2], s, d, top, *m[8:]

        yield from _sent(delivered(), schema)

    schema = pa.schema([*_WAY, *to_arrow_schema(nodes.select(*carry).schema)])
    rows = _by_label(mine, height, "kind").select("tree", "block", "pos", "size", "digest", "sides", "siblings", "kind", *carry)
    types = ["string", "long", "string", "string", "string", *[nodes.schema[c].dataType.simpleString() for c in carry]]
    return rows.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in zip(names, types)))


def prove(nodes: DataFrame, height: int = HEIGHT, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """((tree, pos, sides, siblings, top, *carry) of every leaf, (tree, digest) of every root).

    ``nodes`` is a stored table of leaves (tree, pos from 0, size of its tree, digest, *carry).
    Two passes over each tier, and a tier has 2**height times fewer rows than the one below.
    """
    tiers, roots = [nodes], []
    while True:
        blocks = stash(_up(tiers[-1], height), "merkle-tier")
        roots.append(blocks.filter(F.col("size") == 1).select("tree", "digest"))
        if (blocks.agg(F.max("size")).first()[0] or 0) <= 1:
            break
        tiers.append(blocks.filter(F.col("size") > 1))
    ways = None
    for tier in reversed(tiers[1:]):
        ways = stash(_down(tier, ways, height), "merkle-ways")
    return _down(nodes, ways, height, carry), reduce(DataFrame.unionByName, roots)


def _seated(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with ``pos`` from 0 in their tree and ``size`` of it, stored."""
    placed = number_rows(stash(rows, "merkle-rows"), order, ("tree",)).withColumn("pos", F.col("pos") - 1)
    sizes = stash(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")
    return stash(placed.join(broadcast_if_small(sizes, 100_000), "tree"), "merkle-leaves")


def manifest(
    df: DataFrame,
    fields: Sequence[str],
    id: str = "doc_id",
    group: str = "lang",
    claim: Column | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """(id, leaf, subroot, root, sides, siblings, claim): the manifest entry of every row, with its whole proof.

    A leaf is the digest of the row's fields. The leaves of a group, by ascending id
    (null first; equal ids by digest, equal rows in any order), make a binary tree whose
    last node of a level may stand alone; the groups' roots in the order of the groups
    (null first, then by UTF-8 bytes) make another one. ``siblings`` are the sibling
    digests from the leaf up, one after another, ``sides`` tells for each level whether
    the sibling is left (l), right (r) or missing (-). ``claim`` is a digest that a holder
    of the row presents instead of its leaf. Null and empty fields differ; other columns
    are not read. An empty table has no entries.
    """
    tree = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), F.col(group).cast("string")))
    leaf = digest_of([F.col(f) for f in fields])
    rows = df.select(tree.alias("tree"), F.col(id).alias("id"), leaf.alias("digest"), (leaf if claim is None else claim).alias("claim"))
    leaves = _seated(rows, [F.col("id").asc_nulls_first(), F.col("digest").asc()]).withColumn("leaf", F.col("digest"))
    ways, roots = prove(leaves, height, ("id", "leaf", "claim"))
    groups = _seated(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), [F.col("name").asc()])
    above, _ = prove(groups, height, ("name",))
    tops = above.select(F.col("name").alias("tree"), F.col("sides").alias("_sides"), F.col("siblings").alias("_siblings"), F.col("top").alias("root"))
    found = ways.join(broadcast_if_small(stash(tops, "merkle-tops"), 100_000), "tree")
    return found.select(
        F.col("id").alias(id),
        "leaf",
        F.col("top").alias("subroot"),
        "root",
        F.concat("sides", "_sides").alias("sides"),
        F.concat("siblings", "_siblings").alias("siblings"),
        "claim",
    )


def folded(leaf: Column, sides: Column, siblings: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    start = F.struct(leaf.alias("digest"), F.lit(1).alias("at"))

    def step(state: Column, side: Column) -> Column:
        other = F.substring(siblings, state["at"], F.lit(_DIGEST))
        both = F.when(side == LEFT, F.concat(other, state["digest"])).when(side == RIGHT, F.concat(state["digest"], other))
        used = F.when(side == ALONE, 0).otherwise(_DIGEST)
        return F.struct(F.sha2(F.coalesce(both, state["digest"]), 256).alias("digest"), (state["at"] + used).alias("at"))

    return F.when(F.length(sides) == 0, leaf).otherwise(F.aggregate(F.split(sides, ""), start, step, lambda s: s["digest"]))


def manifest_sql(modulus: int = 7) -> str:
    """The digests of ``documents`` in SQL: levels by recursion, proofs by joins, crc32 bit by bit."""
    part = "coalesce(strlen(cast({0} as varchar)) || ':' || cast({0} as varchar), '-')"
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = " || ".join(part.format(f) for f in fields)
    changed = " || ".join(part.format("(n_chars + 1)" if f == "n_chars" else f) for f in fields)
    bits = "list_reduce([xor({0}, {1})] || range(8), lambda r, _: xor(r >> 1, 3988292384 * (r & 1)))"
    crc = (
        "xor(list_reduce([4294967295::bigint] || list_transform(string_split(cast(doc_id as varchar), ''), lambda d: ascii(d)::bigint), "
        "lambda c, d: " + bits.format("c", "d") + "), 4294967295)"
    )
    return f"""
with recursive rows as (
    select doc_id, case when lang is null then '-' else ':' || lang end as tree, sha256({leaf}) as leaf,
        case when {crc} % {modulus} = 0 then sha256({changed}) else sha256({leaf}) end as claim
    from documents),
leaves as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as size
    from rows),
up as (
    select tree, 0 as level, pos, size, leaf as digest from leaves
    union all
    select tree, level + 1, pos // 2, any_value((size + 1) // 2), sha256(string_agg(digest, '' order by pos))
    from up where size > 1 group by tree, level, pos // 2),
subroots as (
    select tree, digest, row_number() over (order by tree) - 1 as pos, count(*) over () as size from up where size = 1),
top as (
    select 0 as level, pos, size, digest from subroots
    union all
    select level + 1, pos // 2, any_value((size + 1) // 2), sha256(string_agg(digest, '' order by pos))
    from top where size > 1 group by level, pos // 2),
heights as (select tree, max(level) as height from up group by tree),
ways as (
    select l.tree, l.pos, u.level, u.digest, (u.pos & 1) = 0 as on_left
    from leaves l join up u on u.tree = l.tree and u.size > 1 and u.pos = xor(l.pos >> u.level, 1)
    union all
    select l.tree, l.pos, h.height + t.level, t.digest, (t.pos & 1) = 0
    from leaves l join subroots s on s.tree = l.tree join heights h on h.tree = l.tree
        join top t on t.size > 1 and t.pos = xor(s.pos >> t.level, 1)),
depth as (select (select max(level) from top) as above),
folds as (
    select tree, pos, 0 as level, claim as digest from leaves
    union all
    select f.tree, f.pos, f.level + 1,
        sha256(case when w.digest is null then f.digest when w.on_left then w.digest || f.digest else f.digest || w.digest end)
    from folds f join heights h on h.tree = f.tree cross join depth d
        left join ways w on w.tree = f.tree and w.pos = f.pos and w.level = f.level
    where f.level < h.height + d.above),
proofs as (select tree, pos, string_agg(digest, '' order by level) as siblings from ways group by tree, pos)
select l.doc_id, l.leaf, s.digest as subroot, r.digest as root, sha256(coalesce(p.siblings, '')) as proof_sha256,
    f.digest as folded_root, f.digest = r.digest as verified
from leaves l join subroots s on s.tree = l.tree join top r on r.size = 1 join heights h on h.tree = l.tree cross join depth d
    join folds f on f.tree = l.tree and f.pos = l.pos and f.level = h.height + d.above
    left join proofs p on p.tree = l.tree and p.pos = l.pos
"""
