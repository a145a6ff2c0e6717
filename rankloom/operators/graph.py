"""Link analysis: weighted PageRank, global and per topic, and topic mixtures.

Inputs: ``nodes(id)``, ``edges(src, dst, weight)``, ``doc_topics(doc, topic)``
and mixtures ``(user_id, query_id, topic, p)``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rankloom.functions.numeric import total
from rankloom.operators import linkgrid
from rankloom.session import cleaned, durable, loop_partitions, stash

DANGLING_MODES = ("reference", "uniform")
MOST_TOPICS = 200  # Bound on the rank columns of one loop.


def check_weights(alpha: float, beta: float = 0.0) -> None:
    if alpha < 0 or beta < 0 or alpha + beta > 1:
        raise ValueError("alpha and beta must be non-negative with alpha + beta <= 1")


def merge_edges(edges: DataFrame) -> DataFrame:
    """Add up repeated links."""
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def out_weights(edges: DataFrame) -> DataFrame:
    """Total weight and number of the links that leave each node."""
    return edges.groupBy("src").agg(
        F.sum("weight").alias("out_weight"), F.count(F.lit(1)).alias("links")
    )


def row_normalise_edges(edges: DataFrame) -> DataFrame:
    """Link probabilities ``(src, dst, p)``: the weight over its row sum."""
    sums = out_weights(edges).filter("out_weight <> 0")
    return edges.join(sums, "src").select("src", "dst", (F.col("weight") / F.col("out_weight")).alias("p"))


def dangling_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes whose outgoing weight adds up to zero."""
    live = out_weights(edges).filter("out_weight <> 0").select(F.col("src").alias("id"))
    return nodes.join(live, "id", "left_anti")


def topic_teleport(doc_topics: DataFrame) -> DataFrame:
    """Start probability of each topic's documents; repeats count in the size only."""
    sizes = doc_topics.groupBy("topic").agg(F.count(F.lit(1)).alias("_n"))
    members = doc_topics.select("topic", "doc").distinct()
    return members.join(sizes, "topic").select("topic", "doc", (1.0 / F.col("_n")).alias("p"))


@dataclass
class LinkTable:
    """Graph laid out for repeated propagation.

    ``links(src, salt, dst, p)`` is kept partitioned by its source, and by a
    salt where a node has very many links: such a node is spread over ``fan``
    salts and sends its rank once to each. Without such nodes there is no salt.
    ``nodes(id, fan, dangling)`` is kept by ``id``.
    """

    nodes: DataFrame
    links: DataFrame
    size: int
    salted: bool
    parts: int

    def release(self) -> None:
        self.nodes.unpersist()
        self.links.unpersist()


def link_table(nodes: DataFrame, edges: DataFrame, hot_links: int = 500_000) -> LinkTable:
    spark: SparkSession = nodes.sparkSession
    sums = durable(out_weights(edges))
    totals = sums.agg(F.sum("links").alias("m"), F.max("links").alias("top")).first()
    size = nodes.count()
    parts = loop_partitions(spark, max(totals["m"] or 0, size))
    share = max(hot_links, math.ceil((totals["m"] or 0) / (4 * parts)))
    salted = (totals["top"] or 0) > share
    sums = sums.withColumn("fan", F.ceil(F.col("links") / share).cast("int"))
    table = (
        nodes.join(sums.withColumnRenamed("src", "id"), "id", "left")
        .select(
            "id",
            F.coalesce("fan", F.lit(1)).alias("fan"),
            (F.coalesce("out_weight", F.lit(0.0)) == 0).alias("dangling"),
        )
        .repartition(parts, "id")
        .persist()
    )
    links = edges.join(sums.filter("out_weight <> 0"), "src").select(
        "src",
        F.pmod(F.xxhash64("dst"), F.col("fan")).cast("int").alias("salt"),
        "dst",
        (F.col("weight") / F.col("out_weight")).alias("p"),
    )
    keys = ["src", "salt"] if salted else ["src"]
    links = (links if salted else links.drop("salt")).repartition(parts, *keys).sortWithinPartitions(*keys).persist()
    links.count()  # a step plans without shuffling or sorting the links only once they are kept
    return LinkTable(table, links, size, salted, parts)


def propagate(state: DataFrame, table: LinkTable, ranks: list[str]) -> DataFrame:
    """Sparse transpose product: rank mass that arrives at each ``dst``."""
    keys, sent = ["src"], state.select(F.col("id").alias("src"), *ranks)
    if table.salted:
        salts = F.sequence(F.lit(0), F.col("fan") - 1)
        keys, sent = ["src", "salt"], state.select(F.col("id").alias("src"), F.explode(salts).alias("salt"), *ranks)
    flows = [F.sum(F.col("p") * F.col(r)).alias(f"in_{r}") for r in ranks]
    return sent.join(table.links, keys).groupBy(F.col("dst").alias("id")).agg(*flows)


def _numbered(nodes: DataFrame, edges: DataFrame, sums: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """The graph with whole numbers as ids, and ``(id, _no)`` if those are not the ids themselves."""
    if all(isinstance(df.schema[c].dataType, IntegralType) for df, c in ((nodes, "id"), (edges, "src"), (edges, "dst"))):
        return nodes, edges, sums, None
    keys = durable(nodes.select("id").filter("id IS NOT NULL").distinct().withColumn("_no", F.monotonically_increasing_id()))

    def number(df: DataFrame, column: str, how: str) -> DataFrame:
        named = keys.select(F.col("id").alias(column), "_no")
        return df.join(named, column, how).drop(column).withColumnRenamed("_no", column)

    return number(nodes, "id", "left"), number(number(edges, "src", "inner"), "dst", "inner"), number(sums, "src", "inner"), keys


def _power_loop(
    nodes: DataFrame,
    edges: DataFrame,
    ranks: list[str],
    start: float | None,
    damping: float,
    teleport: Callable[[int, str], tuple[float, float]],
    iterations: int | None,
    tol: float,
    max_iterations: int,
    dangling: str,
    hot_links: int,
) -> DataFrame:
    """Iterate all rank columns together over links that stay where they are.

    Ranks are arrays by blocks of nodes and links a grid of cells (``linkgrid``). A step
    moves each rank once per target block and a sum for each node once per source
    block, and writes the ranks, which cuts their lineage. ``start`` is one over the number of
    nodes if None; ``teleport`` gives, of that number and a column, what each node
    gets in a step and what those that the column ``start_<rank>`` of ``nodes`` marks get besides.
    The only values that reach the driver are, per column, the dangling mass, the
    squared change of the step and the sum. Ranks that do not settle within ``max_iterations`` are an
    error.
    """
    if dangling not in DANGLING_MODES:
        raise ValueError(f"dangling must be one of {DANGLING_MODES}")
    marks = [c for c in nodes.columns if c != "id"]
    kind = nodes.schema["id"].dataType
    plain, links, sums, keys = _numbered(nodes, edges, durable(out_weights(edges)))
    grid = linkgrid.build(plain, links, sums, marks, row_links=8 * hot_links)
    shares = [teleport(grid.size, r) for r in ranks]
    stored = linkgrid.start(grid, len(ranks), 1.0 / grid.size if start is None else start)

    def looked() -> dict[int, Row]:
        cells = stored.table.groupBy("col").agg(*[F.sum(c).alias(c) for c in ("mass", "gap", "total")])
        return {r["col"]: r for r in cells.collect()}

    seen = looked()
    moving, settled = set(range(len(ranks))), []
    for _ in range(iterations if iterations is not None else max_iterations):
        now = {c: (damping * seen[c]["mass"] / grid.size, *shares[c]) for c in sorted(moving)}
        fresh = linkgrid.step(grid, stored.table, len(ranks), now, damping, dangling == "reference")
        stored.drop()
        stored = fresh
        seen |= looked()
        if iterations is None:
            done = {c for c in moving if math.sqrt(seen[c]["gap"]) <= tol}
            moving -= done
            if not moving:
                break
            if done:  # stored once more, and not again in each step of the others
                settled.append(stash(stored.table.filter(F.col("col").isin(sorted(done))), "settled"))
    else:
        if iterations is None:
            raise RuntimeError(f"ranks did not settle within {max_iterations} steps")
    grid.close()
    out = linkgrid.unpack(grid, reduce(DataFrame.unionByName, settled, stored.table), ranks)
    if keys is not None:
        out = out.withColumnRenamed("id", "_no").join(keys, "_no", "left")
    return out.select(F.col("id").cast(kind), *[(F.col(r) / F.lit(seen[c]["total"] or 1.0)).alias(r) for c, r in enumerate(ranks)])


@cleaned
def pagerank_global(
    nodes: DataFrame,
    edges: DataFrame,
    alpha: float = 0.2,
    iterations: int | None = None,
    tol: float = 1e-10,
    max_iterations: int = 1000,
    dangling: str = "reference",
    hot_links: int = 500_000,
) -> DataFrame:
    """``(id, rank)`` with teleport weight ``alpha``; the ranks add up to 1.

    ``dangling='reference'`` hands the mass of dangling nodes back to those
    nodes only, ``'uniform'`` to all nodes. A fixed ``iterations`` replaces the
    convergence test ``tol`` on the L2 norm of the step. A packed row of links holds at
    most eight times ``hot_links``.
    """
    check_weights(alpha)
    return _power_loop(
        nodes.select("id"), edges, ["rank"], 1.0, 1 - alpha, lambda size, _: (alpha / size, 0.0),
        iterations, tol, max_iterations, dangling, hot_links,
    )


def topic_column(topic: int) -> str:
    return f"t{topic}"


@cleaned
def pagerank_topic(
    nodes: DataFrame,
    edges: DataFrame,
    doc_topics: DataFrame,
    topics: list[int] | None = None,
    alpha: float = 0.2,
    beta: float = 0.1,
    iterations: int | None = None,
    tol: float = 1e-10,
    max_iterations: int = 1000,
    dangling: str = "reference",
    hot_links: int = 500_000,
) -> DataFrame:
    """``(id, t1, t2, ...)``: one topic-sensitive rank per column.

    All topics share each step's join and shuffle. Teleport weight ``alpha`` is
    split into ``beta`` for the topic's documents and the rest for all nodes.
    """
    check_weights(alpha, beta)
    found = doc_topics.groupBy("topic").agg(F.count(F.lit(1)).alias("n")).limit(MOST_TOPICS + 1).collect()
    if len(found) > MOST_TOPICS:
        raise ValueError(f"more than {MOST_TOPICS} topics: one rank column each would not do, pass them in parts")
    sizes = {r["topic"]: r["n"] for r in found}
    topics = sorted(sizes) if topics is None else topics
    ranks = [topic_column(t) for t in topics]
    member = doc_topics.groupBy(F.col("doc").alias("id")).agg(
        *[F.max(F.when(F.col("topic") == t, 1)).alias(f"start_{topic_column(t)}") for t in topics]
    )
    marked = nodes.select("id").join(member, "id", "left").fillna(0, [f"start_{r}" for r in ranks])
    extra = {topic_column(t): beta * (1.0 / sizes.get(t, 1)) for t in topics}
    return _power_loop(
        marked, edges, ranks, None, 1 - alpha, lambda size, r: ((alpha - beta) / size, extra[r]),
        iterations, tol, max_iterations, dangling, hot_links,
    )


def wide_mixture(mix: DataFrame, topics: list[int]) -> DataFrame:
    """``(user_id, query_id, p_<topic>...)``; a missing share is zero."""
    shares = [
        F.coalesce(F.sum(F.when(F.col("topic") == t, F.col("p"))), F.lit(0.0)).alias(f"p_{t}") for t in topics
    ]
    return mix.groupBy("user_id", "query_id").agg(*shares)


def mixture_scores(wanted: DataFrame, topic_ranks: DataFrame, mix: DataFrame) -> DataFrame:
    """Rank of each wanted ``(user_id, query_id, doc)`` under its topic mixture.

    Only wanted documents are scored; the full user x query x document table
    never exists. With a query mixture this is the query-sensitive rank, with a
    user mixture the personal one. The mixtures are stored first, so that their size is
    known and few of them do not make the scored rows move.
    """
    topics = [int(c[1:]) for c in topic_ranks.columns if c != "id"]
    score = total([F.col(topic_column(t)) * F.coalesce(F.col(f"p_{t}"), F.lit(0.0)) for t in topics])
    return (
        wanted.select("user_id", "query_id", "doc")
        .join(topic_ranks.withColumnRenamed("id", "doc"), "doc")
        .join(durable(wide_mixture(mix, topics)), ["user_id", "query_id"], "left")
        .select("user_id", "query_id", "doc", score.alias("rank"))
    )
