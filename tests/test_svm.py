import hashlib

import numpy as np
import pytest

from rankloom.operators import layout, rowblocks, svm

N, M = 13, 4


def data(seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(N, M))
    x[rng.random((N, M)) < 0.2] = 0
    x[6] = 0  # a row without features
    y = np.where(x @ np.array([1.0, -2.0, 0.5, 0.0]) + 0.3 * rng.normal(size=N) > 0, 1, -1)
    return x, y


def tables(spark, x, y):
    feats = [(int(r), int(c), float(x[r, c])) for r, c in zip(*np.nonzero(x))]
    labels = [(i, int(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(feats, "row_id long, idx int, val double"), spark.createDataFrame(labels, "row_id long, y int")


def vector(df, column="w"):
    return np.array([r[column] for r in df.orderBy("idx").collect()])


def gradient(x, y, w, n, batch, lam):
    on = 1 - y * (x @ w) > 0
    return w / batch + 2 * lam / n * x[on].T @ (x[on] @ w - y[on])


def test_gradient(spark):
    x, y = data()
    w = np.array([0.5, -1.0, 0.2, 0.1])
    weights = spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "idx int, w double")
    got = svm.svm_gradient(*tables(spark, x, y), weights, N, 3, 7.0)
    assert np.allclose(vector(got, "grad"), gradient(x, y, w, N, 3, 7.0))


@pytest.mark.parametrize("most", [1000, 0])
def test_conjugate_gradient_solves_the_system(spark, monkeypatch, most):
    monkeypatch.setattr(rowblocks, "MOST_FEATURES", most)  # an array, or joins
    x, y = data()
    feats, labels = tables(spark, x, y)
    grad = svm.svm_gradient(feats, labels, svm.zero_weights(feats), N, 1, 7.0)
    step, rounds = svm.conjugate_gradient(feats, grad, N, 7.0, tol=1e-9)
    g = gradient(x, y, np.zeros(M), N, 1, 7.0)
    assert np.allclose(vector(step, "d"), np.linalg.solve(np.eye(M) + 14.0 / N * x.T @ x, -g), atol=1e-8)
    assert rounds <= M + 2


@pytest.mark.parametrize("refresh, most", [(False, 1000), (True, 1000), (True, 0)])
def test_newton_trace(spark, monkeypatch, refresh, most):
    monkeypatch.setattr(rowblocks, "MOST_FEATURES", most)
    x, y = data()
    feats, labels = tables(spark, x, y)
    fit = svm.svm_newton(feats, labels, 7.0, epochs=3, refresh_active=refresh, cg_tol=1e-9, test_features=feats, test_labels=labels, optimum=2.0)
    w = np.zeros(M)
    for _ in range(3):
        on = (1 - y * (x @ w) > 0) if refresh else np.ones(N, bool)
        h = np.eye(M) + 14.0 / N * x[on].T @ x[on]
        w = w + np.linalg.solve(h, -gradient(x, y, w, N, 1, 7.0))
    assert np.allclose(vector(fit.weights), w, atol=1e-7)
    last = fit.trace.orderBy("iter").collect()[-1]
    loss = (np.maximum(0, 1 - y * (x @ w)) ** 2).sum() / N
    value = w @ w / 2 + 7.0 * loss
    assert last.loss == pytest.approx(loss) and last.objective == pytest.approx(value)
    assert last.rel == pytest.approx((value - 2) / 2)
    assert last.acc == pytest.approx(np.mean(np.where(x @ w > 0, 1, -1) == y))


def sgd_order(seed, epoch, n, block_rows):
    """Row ids of an epoch: blocks of the hash order permuted, a short one last, and the rows in each block permuted."""
    digest = lambda x: hashlib.md5(x.encode()).hexdigest()
    order = sorted(range(n), key=lambda r: digest(f"{seed}:{r}"))
    blocks = [order[a : a + block_rows] for a in range(0, n, block_rows)]
    full = [b for b in range(len(blocks)) if len(blocks[b]) == block_rows]
    turns = sorted(full, key=lambda b: digest(f"{seed}:{epoch}:block{b}")) + [b for b in range(len(blocks)) if b not in full]
    return [r for b in turns for r in sorted(blocks[b], key=lambda r: digest(f"{seed}:{epoch}:{r}"))]


@pytest.mark.parametrize("n, block_batches, most", [(13, 1, 1000), (13, 2, 1000), (10, 1, 1000), (13, 16, 1000), (13, 1, 0)])
def test_sgd_uses_every_batch_and_repeats_the_tail(spark, monkeypatch, n, block_batches, most):
    """13 rows: 5, 5, 3 and the short batch again; 10 rows: 5, 5 and an empty batch. Arrays and joins agree."""
    monkeypatch.setattr(rowblocks, "MOST_FEATURES", most)
    x, y = (v[:n] for v in data())
    feats, labels = tables(spark, x, y)
    parts = dict(epochs=2, batch_size=5, learning_rate=0.1, seed=3, block_batches=block_batches)
    fit = svm.svm_sgd(feats, labels, 7.0, **parts, test_features=feats, test_labels=labels)
    w, norms, losses = np.zeros(M), [], []
    for epoch in range(2):
        order = sgd_order(3, epoch, n, 5 * block_batches)
        cuts = [order[:5], order[5:10], order[10:], order[10:]][: 4 if n == 13 else 3]
        norms.append(0.0), losses.append(0.0)
        for rows in cuts:
            g = gradient(x[rows], y[rows], w, n, 5, 7.0)
            w = w - 0.1 / (1 + 0.001 * epoch) * g
            norms[-1] += np.sqrt(g @ g)
            losses[-1] += (np.maximum(0, 1 - y[rows] * (x[rows] @ w)) ** 2).sum() / n
    assert np.allclose(vector(fit.weights), w, atol=1e-10)
    trace = fit.trace.orderBy("iter").collect()
    assert np.allclose([r.grad_norm for r in trace], norms) and np.allclose([r.loss for r in trace], losses)
    assert trace[-1].objective == pytest.approx(w @ w / 2 + 7.0 * losses[-1])
    assert trace[-1].acc == pytest.approx(np.mean(np.where(x @ w > 0, 1, -1) == y))


def test_sgd_writes_rows_once(spark, monkeypatch):
    """What is stored does not depend on the number of epochs."""
    x, y = data()
    feats, labels = tables(spark, x, y)
    written = []
    for module in (rowblocks, svm, layout):
        for name in ("store", "stash", "durable"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, lambda *a, _old=getattr(module, name), **k: (written.append(1), _old(*a, **k))[1])
    counts = []
    for epochs in (1, 4):
        written.clear()
        svm.svm_sgd(feats, labels, 7.0, epochs=epochs, batch_size=5, block_batches=1)
        counts.append(len(written))
    assert counts[0] == counts[1]


def test_newton_steps_have_no_shuffle(spark):
    x, y = data()
    feats, labels = tables(spark, x, y)
    blocks = rowblocks.build(feats, labels, rowblocks.feature_ids(feats), block_rows=4)
    plans = []
    w = np.array([0.5, -1.0, 0.2, 0.1])
    assert np.allclose(blocks.total(lambda rows: rows.back(rows.dot(w)), M), x.T @ (x @ w))
    sums = blocks.table.mapInArrow(lambda batches: batches, rowblocks.BLOCK_SCHEMA)
    plans.append(sums._jdf.queryExecution().executedPlan().toString())
    assert "InMemoryTableScan" in plans[0]
    assert plans[0].split("InMemoryRelation")[0].count("Exchange") == 0
    blocks.close()


def test_vectors_are_added_up_by_a_tree(spark, monkeypatch):
    monkeypatch.setattr(rowblocks, "FAN", 2)
    monkeypatch.setattr(rowblocks, "PIECE", 3)
    x, y = data()
    feats, labels = tables(spark, x, y)
    blocks = rowblocks.build(feats, labels, rowblocks.feature_ids(feats), block_rows=2)
    w = np.array([0.5, -1.0, 0.2, 0.1])
    assert np.allclose(blocks.total(lambda rows: rows.back(rows.dot(w)), M), x.T @ (x @ w))
    blocks.close()


def test_nothing_to_learn_from(spark):
    feats, labels = tables(spark, *(v[:0] for v in data()))
    assert svm.svm_sgd(feats, labels, 7.0, epochs=1).weights.count() == 0
    assert svm.svm_newton(feats, labels, 7.0, epochs=1).weights.count() == 0


def test_pegasos_takes_one_batch_per_epoch(spark):
    order = sorted(range(N), key=lambda r: hashlib.md5(f"0:{r}".encode()).hexdigest())
    x, y = data()
    feats, labels = tables(spark, x, y)
    fit = svm.svm_pegasos(feats, labels, 7.0, epochs=3, batch_size=4, learning_rate=0.1)
    w = np.zeros(M)
    for epoch in range(3):
        start = svm.epoch_start(0, epoch, N)
        rows = (order + order)[start : start + 4]
        w = w - 0.1 / (1 + 0.001 * epoch) * gradient(x[rows], y[rows], w, N, 4, 7.0)
    assert np.allclose(vector(fit.weights), w, atol=1e-10)


def test_balanced_one_vs_rest_reaches_the_optimum(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 3))
    cls = np.where(x[:, 0] > 0.8, 3, np.where(x[:, 1] > 0, 2, 1))
    feats, _ = tables(spark, x, cls)
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(cls)], "row_id long, cls int")
    weights = svm.svm_multiclass_balanced(feats, labels, tol=1e-5)
    ones = np.hstack([x, np.ones((40, 1))])
    for c in (1, 2, 3):
        y = np.where(cls == c, 1.0, -1.0)
        cost = np.where(cls == c, 40 / (3 * (cls == c).sum()), 1.0)
        w = np.zeros(4)
        for _ in range(50):
            on = y * (ones @ w) < 1
            g = w + 2 * ones[on].T @ (cost[on] * (ones[on] @ w - y[on]))
            h = np.eye(4) + 2 * ones[on].T @ (cost[on, None] * ones[on])
            w = w - np.linalg.solve(h, g)
        got = {r.idx: r[f"w_{c}"] for r in weights.collect()}
        assert np.allclose([got[0], got[1], got[2], got[-1]], w, atol=1e-3)
    guess = svm.multiclass_predict(feats, labels, weights).join(labels, "row_id")
    assert guess.filter("prediction = cls").count() >= 34


@pytest.mark.parametrize("turn_cells", [1, 40, 10**6])
def test_blocks_of_an_epoch_share_tasks(spark, monkeypatch, turn_cells):
    """An epoch is a few jobs, however many blocks it has, and gives the same weights and sums for every share."""
    rng = np.random.default_rng(8)
    feats = spark.createDataFrame([(r, c, float(x)) for r in range(60) for c, x in enumerate(rng.normal(size=3))], "row_id long, idx int, val double")
    labels = spark.createDataFrame([(r, 1 if r % 3 else -1) for r in range(60)], "row_id long, y int")
    turns = []
    steps = svm._block_steps
    monkeypatch.setattr(svm, "_block_steps", lambda run, w, blocks, *more: turns.append(blocks) or steps(run, w, blocks, *more))
    settings = {"epochs": 2, "batch_size": 4, "block_batches": 1, "seed": 5}
    monkeypatch.setattr(svm, "TURN_CELLS", 10**6)
    want = svm.svm_sgd(feats, labels, 7.0, **settings)
    assert [len(t) for t in turns] == [15, 15]
    turns.clear()
    monkeypatch.setattr(svm, "TURN_CELLS", turn_cells)
    got = svm.svm_sgd(feats, labels, 7.0, **settings)
    assert sum(turns, []) == [b for e in (0, 1) for b in svm.epoch_order(5, e, 60, 4)]
    one, two = ([r.w for r in f.weights.orderBy("idx").collect()] for f in (want, got))
    assert one == pytest.approx(two, abs=1e-12)
    one, two = ([(r.grad_norm, r.loss) for r in f.trace.orderBy("iter").collect()] for f in (want, got))
    assert np.allclose(one, two)
