"""Loops leave only their result behind, and order does not depend on the size of the scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import factorise, graph, layout, retrieval, similarity, svm
from rankloom.plans import registry
from rankloom.session import durable_dir, scratch


def folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{durable_dir(spark).rstrip('/')}/rankloom")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {str(s.getPath()) for s in system.listStatus(path)} if system.exists(path) else set()


def svm_tables(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 3))
    feats = [(i, j, float(x[i, j])) for i in range(30) for j in range(3)]
    labels = [(i, 1 if x[i, 0] > 0 else -1) for i in range(30)]
    return (
        spark.createDataFrame(feats, "row_id long, idx int, val double"),
        spark.createDataFrame(labels, "row_id long, y int"),
    )


def ratings(spark):
    rows = [(u, i, float((u * i) % 5 - 2)) for u in range(8) for i in range(6) if (u + i) % 2]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def graph_tables(spark):
    edges = [(i, (i * 3 + 1) % 9 + 1, 1.0) for i in range(1, 9)]
    return spark.range(1, 10), spark.createDataFrame(edges, "src long, dst long, weight double")


CASES = {
    "pagerank": lambda s: graph.pagerank_global(*graph_tables(s), iterations=23),
    "pegasos": lambda s: svm.svm_pegasos(*svm_tables(s), 1.0, epochs=3, batch_size=7).weights,
    "sgd": lambda s: svm.svm_sgd(*svm_tables(s), 1.0, epochs=2, batch_size=11).weights,
    "newton": lambda s: svm.svm_newton(*svm_tables(s), 1.0, epochs=2).weights,
    "one_vs_rest": lambda s: svm.svm_multiclass_balanced(svm_tables(s)[0], svm_tables(s)[1].withColumnRenamed("y", "cls")),
    "gradient": lambda s: factorise.mf_gradient(
        ratings(s), factorise.start_factors(s.range(8), s.range(6), 2), iterations=3
    ),
    "nearest": lambda s: similarity.nearest(ratings(s), ratings(s), s.range(8), s.range(8), k=2),
    "number_rows": lambda s: layout.number_rows(s.range(20), [F.col("id").desc()]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_only_the_result_is_left(spark, name):
    before = folders(spark)
    result = CASES[name](spark)
    first = sorted(map(str, result.collect()))
    left = folders(spark) - before
    # a solver's fit is its weights and its trace
    assert len(left) == (2 if name in ("pegasos", "sgd", "newton") else 1) and sorted(map(str, result.collect())) == first


def test_a_computation_takes_its_parts_along(spark):
    before = folders(spark)
    with scratch(spark):
        for case in CASES.values():
            case(spark)
    assert folders(spark) == before


def test_forget_deletes_shared_tables(spark):
    class View:
        folder = "nowhere"

    View.spark = spark
    registry.forget()
    before = folders(spark)
    table = registry.saved(View, "some", lambda: layout.number_rows(spark.range(5), [F.col("id").asc()]))
    assert table.count() == 5 and len(folders(spark) - before) == 1
    registry.forget()
    assert folders(spark) == before


@pytest.mark.parametrize("factor", [1e-6, 1e-12, 1e9])
def test_positions_do_not_depend_on_the_size_of_scores(spark, factor):
    rows = [(1, 1, d, (d * 7919 % 1000) / 1000 + 1e-5 * d) for d in range(300)]
    fused = spark.createDataFrame(rows, "user_id int, query_id int, doc long, score double")
    plain = retrieval.rank_run(fused)
    scaled = retrieval.rank_run(fused.withColumn("score", F.col("score") * factor))
    both = plain.select("doc", "position").exceptAll(scaled.select("doc", "position"))
    assert both.count() == 0
    best = [r["doc"] for r in plain.orderBy("position").collect()]
    assert best == [r[2] for r in sorted(rows, key=lambda r: -r[3])]


def test_repeated_documents_count_once(spark):
    run = spark.createDataFrame(
        [(1, 1, 5, 0.5, 1), (1, 1, 5, 0.9, 2), (1, 1, 6, 0.7, 3)],
        "user_id int, query_id int, doc long, rel double, orig_rank int",
    )
    ranks = spark.createDataFrame([(5, 0.1), (6, 0.2)], "id long, rank double")
    got = retrieval.retrieve(run, ranks, "WS", p_weight=0.0, s_weight=1.0).orderBy("position").collect()
    assert [(r["doc"], r["score"]) for r in got] == [(5, 0.9), (6, 0.7)]
    unplaced = retrieval.retrieve(run.drop("orig_rank"), ranks, "NS").orderBy("position").collect()
    assert [r["doc"] for r in unplaced] == [6, 5]


def test_cold_targets(spark):
    factors = spark.createDataFrame([(0, 1, 1.0), (1, 1, 2.0), (1, 2, 4.0)], "kind int, id long, f0 double")
    targets = spark.createDataFrame([(1, 1), (2, 1), (9, 1), (1, 9)], "item_id long, user_id long")
    got = {(r["item_id"], r["user_id"]): r["score"] for r in factorise.mf_predict(targets, factors).collect()}
    assert got == {(1, 1): 1.0, (2, 1): 5.0, (9, 1): 3.0, (1, 9): 3.0}
    known = ratings(spark).filter("rating <> 0").withColumn("rating", F.col("rating") + 3)
    targets = targets.unionByName(spark.createDataFrame([(3, 4), (99, 2), (1, 77)], "item_id long, user_id long"))
    als = {(r["item_id"], r["user_id"]): r["score"] for r in factorise.mf_als(known, targets, 2, iterations=2).collect()}
    assert als[99, 2] == als[1, 77] == 3.0 and max(als.values()) == 5.0 and min(als.values()) == 1.0


def test_unsettled_ranks_are_an_error(spark):
    with pytest.raises(RuntimeError):
        graph.pagerank_global(*graph_tables(spark), max_iterations=2)
