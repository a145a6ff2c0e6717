import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import graph, linkgrid

EDGES = [(1, 2, 1.0), (2, 3, 2.0), (2, 4, 1.0), (4, 1, 3.0), (4, 2, 1.0), (5, 5, 1.0)]


def tables(spark, edges=EDGES, n=6):
    nodes = spark.range(1, n + 1)
    return nodes, spark.createDataFrame(edges, "src long, dst long, weight double")


def dense(edges, n, steps, alpha=0.2, dangling="reference", start=1.0, teleport=None):
    m = np.zeros((n, n))
    for s, d, w in edges:
        m[s - 1, d - 1] += w
    out = m.sum(axis=1)
    loose = out == 0
    m = np.divide(m, out[:, None], out=np.zeros_like(m), where=out[:, None] != 0)
    r = np.full(n, start)
    jump = np.full(n, alpha / n) if teleport is None else teleport
    gate = loose.astype(float) if dangling == "reference" else np.ones(n)
    for _ in range(steps):
        r = (1 - alpha) * m.T @ r + (1 - alpha) * r[loose].sum() / n * gate + jump
    return r / r.sum()


def as_array(df, column="rank"):
    return np.array([r[column] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("dangling", graph.DANGLING_MODES)
@pytest.mark.parametrize("hot_links", [500_000, 1])
def test_global_rank_matches_dense_power_iteration(spark, dangling, hot_links):
    nodes, edges = tables(spark)
    got = graph.pagerank_global(nodes, edges, iterations=7, dangling=dangling, hot_links=hot_links)
    assert np.allclose(as_array(got), dense(EDGES, 6, 7, dangling=dangling), atol=1e-12)


def test_hot_source_is_salted_and_result_is_the_same(spark):
    edges = [(1, d, 1.0) for d in range(2, 42)] + [(d, 1, 1.0) for d in range(2, 30)]
    nodes, table = tables(spark, edges, 45)
    laid = graph.link_table(nodes, table, hot_links=5)
    assert laid.salted and laid.links.filter("src = 1").select("salt").distinct().count() > 1
    laid.release()
    got = graph.pagerank_global(nodes, table, iterations=5, hot_links=5)
    assert np.allclose(as_array(got), dense(edges, 45, 5), atol=1e-12)


def test_convergence_and_unit_sum(spark):
    nodes, edges = tables(spark)
    got = as_array(graph.pagerank_global(nodes, edges, tol=1e-10))
    assert np.allclose(got, dense(EDGES, 6, 400), atol=1e-9) and abs(got.sum() - 1) < 1e-12


def test_chain_mass_of_the_gated_dangling_rule(spark):
    # Fixed point of the chain 1->2, 2->3, 2->4: total mass 0.426667 before normalising.
    edges = [(1, 2, 1.0), (2, 3, 1.0), (2, 4, 1.0)]
    nodes, table = tables(spark, edges, 4)
    got = as_array(graph.pagerank_global(nodes, table))
    first = 0.05 / 0.42666666666666664
    assert abs(got[0] - first) < 1e-6


def test_topic_ranks(spark):
    nodes, edges = tables(spark)
    topics = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (6, 2)], "doc long, topic int")
    got = graph.pagerank_topic(nodes, edges, topics, iterations=6)
    assert got.columns == ["id", "t1", "t2"]
    start = np.zeros(6)
    start[[0, 1]] = 1 / 3  # the repeated document counts in the size only
    teleport = 0.1 * start + (0.2 - 0.1) / 6
    expected = dense(EDGES, 6, 6, start=1 / 6, teleport=teleport)
    assert np.allclose(as_array(got, "t1"), expected, atol=1e-12)


def test_mixture_is_linear_and_missing_lists_are_zero(spark):
    ranks = spark.createDataFrame([(1, 0.5, 0.1), (2, 0.2, 0.4)], "id long, t1 double, t2 double")
    wanted = spark.createDataFrame([(7, 1, 1), (7, 1, 2), (8, 2, 1)], "user_id int, query_id int, doc long")
    mix = spark.createDataFrame([(7, 1, 1, 0.25), (7, 1, 2, 0.75)], "user_id int, query_id int, topic int, p double")
    got = {(r.user_id, r.doc): r["rank"] for r in graph.mixture_scores(wanted, ranks, mix).collect()}
    assert got[7, 1] == pytest.approx(0.2) and got[7, 2] == pytest.approx(0.35) and got[8, 1] == 0


def test_zero_weight_row_is_dangling(spark):
    nodes = spark.range(1, 4)
    edges = spark.createDataFrame([(1, 2, 0.0), (2, 3, 1.0)], "src long, dst long, weight double")
    assert sorted(r.id for r in graph.dangling_nodes(nodes, edges).collect()) == [1, 3]
    assert graph.row_normalise_edges(edges).agg(F.sum("p")).first()[0] == 1.0


@pytest.mark.parametrize("alpha,beta", [(-0.1, 0.1), (0.2, -1), (0.6, 0.5)])
def test_bad_weights(spark, alpha, beta):
    nodes, edges = tables(spark)
    with pytest.raises(ValueError):
        graph.pagerank_topic(nodes, edges, nodes, alpha=alpha, beta=beta)


def test_repeated_and_null_nodes_and_foreign_links(spark):
    nodes = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id long")
    edges = spark.createDataFrame([(1, 2, 2.0), (2, 3, 1.0), (2, 9, 3.0), (9, 1, 1.0), (3, 1, None), (None, 1, 1.0)], "src long, dst long, weight double")
    got = graph.pagerank_global(nodes, edges, iterations=3).collect()
    one = two = three = none = 1.0
    for _ in range(3):  # a copy of a node sends its own rank and gets what its id gets; node 3 and the null are dangling
        leak = 0.8 * (three + none) / 5
        one, two, three, none = 0.04, 0.8 * one + 0.04, 0.8 * 2 * two / 4 + leak + 0.04, leak + 0.04
    total = one + 2 * two + three + none
    assert sorted((r.id or 0, round(r["rank"], 12)) for r in got) == [
        (i, round(v / total, 12)) for i, v in ((0, none), (1, one), (2, two), (2, two), (3, three))
    ]


def test_text_ids(spark):
    nodes, edges = tables(spark)
    text = nodes.select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("id"))
    links = edges.select(*[F.concat(F.lit("n"), F.col(c).cast("string")).alias(c) for c in ("src", "dst")], "weight")
    got = graph.pagerank_global(text, links, iterations=4)
    assert np.allclose(as_array(got), dense(EDGES, 6, 4), atol=1e-12)


def test_cells_of_many_packed_rows_add_up(spark):
    rng = np.random.default_rng(5)
    edges = list({(int(s), int(d)): 1.0 for s, d in rng.integers(1, 301, (6000, 2))})
    edges = [(s, d, float((s + d) % 300 + 0.5 * (s % 2))) for s, d in edges]
    nodes, table = tables(spark, edges, 301)
    grid = linkgrid.build(nodes, table, graph.out_weights(table), [], row_links=50, cell_links=400)
    assert grid.blocks >= 4 and grid.cells.count() > grid.blocks**2
    state = linkgrid.start(grid, 1, 1.0).table
    step = linkgrid.step(grid, state, 1, {0: (0.0, 0.2 / 301, 0.0)}, 0.8, True).table
    got = as_array(linkgrid.unpack(grid, step, ["rank"]))
    grid.close()
    want = dense(edges, 301, 1) * 1.0
    loose = np.ones(301, bool)
    loose[[s - 1 for s, _, w in edges if w]] = False
    assert np.allclose(got[~loose] / got[~loose].sum(), want[~loose] / want[~loose].sum(), atol=1e-12)


def test_links_are_packed_before_they_move(spark):
    """Every exchange on the way to the packed links carries cells, not single links, and no link is lost or doubled."""
    draw = np.random.default_rng(11)
    links = {(int(a), int(b)): float(w) for a, b, w in zip(draw.integers(0, 90, 4000), draw.integers(0, 90, 4000), draw.integers(1, 9, 4000))}
    table = spark.createDataFrame([(a, b, w) for (a, b), w in links.items()], "src long, dst long, weight double")
    packed = linkgrid._packed_links(table, 3, 100)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression") :]
    assert "MapInArrow" in below
    got = []
    for sb, db, x, y, w in packed.collect():
        src, dst = linkgrid._ids(bytes(x), bytes(y))
        assert len(src) <= 100
        got += [(sb, db, a, b, v) for a, b, v in zip(src.tolist(), dst.tolist(), linkgrid._wide(bytes(w)).tolist())]
    place = {r["id"]: r["block"] for r in spark.range(90).select("id", linkgrid._block("id", 3).alias("block")).collect()}
    assert sorted(got) == sorted((place[a], place[b], a, b, w) for (a, b), w in links.items())


def test_a_step_stores_the_ranks_of_moving_columns_alone(spark):
    nodes, table = tables(spark)
    grid = linkgrid.build(nodes, table, graph.out_weights(table), [])
    state = linkgrid.start(grid, 2, 1.0).table
    step = linkgrid.step(grid, state, 2, {1: (0.0, 0.2 / 6, 0.0)}, 0.8, True).table
    grid.close()
    assert step.columns == ["block", "col", "f", "mass", "gap", "total"]
    assert [r["col"] for r in step.select("col").distinct().collect()] == [1]


def test_few_mixtures_do_not_move_the_scored_rows(spark):
    ranks = spark.createDataFrame([(1, 0.5)], "id long, t1 double")
    wanted = spark.range(1000).selectExpr("cast(id % 7 as int) user_id", "1 query_id", "id % 2 doc")
    mix = spark.range(1_000_000).selectExpr("cast(id % 7 as int) user_id", "1 query_id", "1 topic", "1e-6 p").repartition(4)
    plan = graph.mixture_scores(wanted, ranks, mix)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and "hashpartitioning(user_id" not in plan
