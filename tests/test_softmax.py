import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import metrics, softmax

N, M, K = 11, 4, 3


def data(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (N, M)).astype(float)
    x[2] = 0  # a document without known words
    cls = rng.integers(1, K + 1, N)
    feats = [(int(r), int(c), float(x[r, c])) for r, c in zip(*np.nonzero(x))]
    return (
        x, cls,
        spark.createDataFrame(feats, "row_id long, idx int, val double"),
        spark.createDataFrame([(i, int(c)) for i, c in enumerate(cls)], "row_id long, cls int"),
    )


def chances(x, w):
    e = np.exp(x @ w)
    return e / e.sum(axis=1, keepdims=True)


def loglik(x, cls, w):
    return np.log(chances(x, w)[np.arange(len(x)), cls - 1]).sum() - 0.005 * (w**2).sum()


def test_one_pass_of_batches(spark):
    x, cls, feats, labels = data(spark)
    fit = softmax.softmax_train(feats, labels, feats, labels, classes=K, batch_size=4, alpha=0.1)
    order = sorted(range(N), key=lambda r: hashlib.md5(f"0:{r}".encode()).hexdigest())
    w, losses = np.zeros((M, K)), []
    for i in range(round(N / 4)):
        rows = order[4 * i : 4 * i + 4]
        losses.append(loglik(x, cls, w))
        w = w + 0.1 / (1 + 0.0001 * i) * x[rows].T @ (np.eye(K)[cls[rows] - 1] - chances(x[rows], w))
    got = np.array([[r[f"w{c}"] for c in range(1, K + 1)] for r in fit.weights.orderBy("idx").collect()])
    assert np.allclose(got, w, atol=1e-10)
    assert [r.loss for r in fit.trace.orderBy("iter").collect()] == pytest.approx(losses)
    guess = softmax.softmax_predict(feats, labels, fit.weights).orderBy("row_id").collect()
    p = chances(x, w)
    assert [r.hard for r in guess] == [int(c) for c in p.argmax(axis=1) + 1]
    assert [r.soft for r in guess] == pytest.approx(list(p @ np.arange(1, K + 1)))


def test_step_that_changes_nothing_is_not_applied(spark):
    _, _, feats, labels = data(spark)
    fit = softmax.softmax_train(feats, labels, feats, labels, classes=K, batch_size=4, alpha=0.1, tol=10.0)
    assert fit.trace.count() == 1
    assert fit.weights.agg(F.sum(F.abs("w1"))).first()[0] == 0


def test_large_scores_do_not_overflow(spark):
    feats = spark.createDataFrame([(0, 0, 1000.0)], "row_id long, idx int, val double")
    weights = spark.createDataFrame([(0, 1.0, 2.0)], "idx int, w1 double, w2 double")
    row = softmax.class_probabilities(feats, feats.select("row_id"), weights).first()
    assert (row.p1, row.p2) == (0.0, 1.0)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 1, 0.25), (3, 3, 1.0)], "t int, g int, p double")
    assert metrics.accuracy(df, "t", "g").first()[0] == pytest.approx(2 / 3)
    assert metrics.rmse(df, "t", "g").first()[0] == pytest.approx((1 / 3) ** 0.5)
    assert metrics.cross_entropy(df, "p").first()[0] == pytest.approx((np.log(2) + np.log(4)) / 3)
    trace = spark.createDataFrame([(0, 3.0), (1, 1.0), (2, 1.0)], "iter int, loss double")
    assert metrics.best_epoch(trace).first().iter == 1


@pytest.mark.parametrize("check_every,tol", [(1, 1e-8), (2, 1e-8), (1, 0.2)])
def test_blocks_and_joins_take_the_same_steps(spark, check_every, tol):
    """Repeated labels and rows without a class, id or feature count alike in both."""
    _, _, feats, labels = data(spark)
    feats = feats.unionByName(spark.createDataFrame([(3, None, 1.0), (None, 1, 2.0), (4, 1, None)], "row_id long, idx int, val double"))
    labels = labels.unionByName(spark.createDataFrame([(0, 1), (0, 2), (5, None), (None, 1), (7, 9)], "row_id long, cls int"))
    settings = (K, 2, 0.1, 0.0001, 0.01, tol, 0, check_every)
    tables = (feats, labels, feats, labels)
    ids = np.array(sorted(r.idx for r in feats.filter("idx IS NOT NULL").select("idx").distinct().collect()))
    fits = softmax._train_by_blocks(tables, ids, *settings), softmax._train_by_joins(tables, *settings)
    one, two = ([[v if v is None else round(v, 10) for v in r] for r in f.weights.orderBy("idx").collect()] for f in fits)
    assert one == two and one[0][0] is None
    one, two = ([[round(v, 8) for v in r] for r in f.trace.orderBy("iter").collect()] for f in fits)
    assert one == two and one


def test_many_steps_are_a_few_jobs(spark):
    """The jobs of a pass do not grow with its batches."""
    rng = np.random.default_rng(6)
    feats = spark.createDataFrame([(r, int(c), 1.0) for r in range(120) for c in set(rng.integers(0, 8, 3))], "row_id long, idx int, val double").persist()
    labels = spark.createDataFrame([(r, r % 2 + 1) for r in range(120)], "row_id long, cls int").persist()
    context, seen = spark.sparkContext, []
    for batch_size in (60, 3):
        context.setJobGroup(f"steps-{batch_size}", "softmax")
        fit = softmax.softmax_train(feats, labels, feats, labels, classes=2, batch_size=batch_size, alpha=0.1, tol=0.0)
        seen.append(len(context.statusTracker().getJobIdsForGroup(f"steps-{batch_size}")))
        assert fit.trace.count() == 120 // batch_size
    context.setLocalProperty("spark.jobGroup.id", None)
    assert seen[1] <= seen[0] + 6
