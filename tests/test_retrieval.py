import math

import pytest
from pyspark.sql import functions as F

from rankloom.operators import retrieval

SCHEMA = "user_id int, query_id int, doc long, rel double, rank double"


def scored(spark, rows):
    return spark.createDataFrame([(1, 1, *r) for r in rows], SCHEMA)


def test_ties_are_ordered_by_document_text_descending(spark):
    rows = [(9, 0.0, 0.3), (10, 0.0, 0.3), (100, 0.0, 0.3), (5, 0.0, 0.9)]
    ranked = retrieval.rank_run(retrieval.fuse_ns(scored(spark, rows)))
    assert [r.doc for r in ranked.orderBy("position").collect()] == [5, 9, 100, 10]


def test_list_with_one_document_gets_the_floor(spark):
    units = retrieval.list_minmax(scored(spark, [(1, -3.0, 0.2)]), ["rank", "rel"]).first()
    assert units.rank_unit == retrieval.FLOOR and units.rel_unit == retrieval.FLOOR
    assert math.isfinite(retrieval.fuse_cm(scored(spark, [(1, -3.0, 0.2)])).first().score)


def test_invalid_relevance_is_left_out_of_the_range(spark):
    rows = [(1, float("-inf"), 0.1), (2, -4.0, 0.2), (3, -2.0, 0.3), (4, -3.0, 0.1)]
    units = {r.doc: r.rel_unit for r in retrieval.list_minmax(scored(spark, rows), ["rel"]).collect()}
    assert units == {1: retrieval.FLOOR, 2: retrieval.FLOOR, 3: 1.0, 4: 0.5}


def test_exponential_fusion_by_hand(spark):
    rows = [(1, -4.0, 0.1), (2, -2.0, 0.3), (3, -3.0, 0.3)]
    got = {r.doc: r.score for r in retrieval.fuse_cm(scored(spark, rows), "C07").collect()}
    f = retrieval.FLOOR
    pr, rel = {1: f, 2: 1.0, 3: 1.0}, {1: f, 2: 1.0, 3: 0.5}
    raw = {d: math.exp(rel[d]) - math.exp(pr[d]) for d in pr}
    size = sum(abs(x) for x in raw.values())
    assert all(got[d] == pytest.approx(rel[d] + raw[d] / size, abs=1e-12) for d in pr)


def test_random_fusion_is_a_distribution_and_repeats(spark):
    rows = [(d, -float(d), d / 10) for d in range(1, 8)]
    units = retrieval.list_minmax(scored(spark, rows), ["rel"]).select("doc", "rel_unit")
    got = retrieval.fuse_cm(scored(spark, rows), "C00").join(units, "doc")
    assert got.agg(F.sum(F.col("score") - F.col("rel_unit"))).first()[0] == pytest.approx(1.0)
    again = retrieval.fuse_cm(scored(spark, rows).repartition(3), "C00").select("doc", "score")
    assert dict(again.collect()) == pytest.approx(dict(got.select("doc", "score").collect()))


def test_gamma_draws_have_the_right_moments():
    import numpy as np

    key = np.arange(200_000, dtype=np.uint64) * np.uint64(2654435761)
    for shape in (0.3, 1.0):
        x = retrieval._gamma(np.full(len(key), shape), key)
        assert abs(x.mean() - shape) < 0.01 and abs(x.var() - shape) < 0.03


def test_repeated_document_keeps_the_last_score(spark):
    run = spark.createDataFrame(
        [(1, 1, 5, 1, -3.0), (1, 1, 5, 2, -4.0)], "user_id int, query_id int, doc long, orig_rank int, rel double"
    )
    assert retrieval.single_docs(run).first().rel == -4.0


def test_bad_arguments(spark):
    df = scored(spark, [(1, -3.0, 0.2)])
    for call in (
        lambda: retrieval.fuse(df, "XX"),
        lambda: retrieval.fuse_cm(df, "C11"),
        lambda: retrieval.fuse_ws(df, 0.5, 0.6),
        lambda: retrieval.fuse_ws(df, 1.5, -0.5),
    ):
        with pytest.raises(ValueError):
            call()
