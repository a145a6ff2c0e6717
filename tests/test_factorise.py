import numpy as np
import pytest

from rankloom.operators import factorise as mf

ROWS = [(0, 0, 5.0), (0, 1, 1.0), (0, 2, 3.0), (1, 0, 4.0), (1, 2, 2.0), (2, 1, 0.0), (2, 2, 1.0)]
U0 = np.array([[0.2, 0.5], [0.4, 0.1], [0.3, 0.9]])
V0 = np.array([[0.6, 0.3], [0.1, 0.8], [0.7, 0.2]])


def ratings(spark):
    return spark.createDataFrame(ROWS, "user_id long, item_id long, rating double")


def factors(spark, u=U0, v=V0):
    rows = [(k, i, *map(float, f)) for k, side in enumerate((u, v)) for i, f in enumerate(side)]
    return spark.createDataFrame(rows, "kind int, id long, f0 double, f1 double")


def arrays(df):
    out = {(r.kind, r.id): (r.f0, r.f1) for r in df.collect()}
    return np.array([out[0, i] for i in range(3)]), np.array([out[1, i] for i in range(3)])


def dense():
    m = np.zeros((3, 3))
    for u, i, r in ROWS:
        m[u, i] = r
    return m


@pytest.mark.parametrize("sign", [1, -1])
def test_gradient_steps(spark, sign):
    m, u, v = dense(), U0.copy(), V0.copy()
    mask = m != 0
    for _ in range(7):
        e = mask * (m - u @ v.T)
        u, v = u + 0.01 * (e @ v + sign * 0.2 * u), v + 0.01 * (e.T @ u + sign * 0.2 * v)
    got = mf.mf_gradient(
        ratings(spark), factors(spark), 0.2, 0.01, iterations=7, reg_sign="reference" if sign > 0 else "descent"
    )
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(arrays(got), (u, v)))


def test_gradient_stops_when_the_error_settles(spark):
    m, u, v = dense(), U0.copy(), V0.copy()
    mask = m != 0
    err = (mask * (m - u @ v.T) ** 2).sum()
    for _ in range(100):
        e = mask * (m - u @ v.T)
        u, v = u + 0.01 * (e @ v + 0.2 * u), v + 0.01 * (e.T @ u + 0.2 * v)
        new = (mask * (m - u @ v.T) ** 2).sum()
        if abs(new - err) / err < 0.03:
            break
        err = new
    got = mf.mf_gradient(ratings(spark), factors(spark), 0.2, 0.01, tol=0.03)
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(arrays(got), (u, v)))


def test_sigmoid_fit_with_adam(spark):
    t = (dense() - 1) / 4
    stored = np.zeros((3, 3), bool)
    stored[[r[0] for r in ROWS], [r[1] for r in ROWS]] = True
    mask = stored & (t != 0)  # a stored zero is scaled to -1/4 and counts, a 1 is scaled to 0 and does not
    p = [U0.copy(), V0.copy()]
    m, s = [np.zeros((3, 2))] * 2, [np.zeros((3, 2))] * 2
    for n in range(1, 7):
        guess = 1 / (1 + np.exp(-p[0] @ p[1].T))
        slope = mask * 2 * (guess - t) * guess * (1 - guess)
        grads = [slope @ p[1], slope.T @ p[0]]
        for i in (0, 1):
            g = grads[i] + 0.2 * p[i] / np.linalg.norm(p[i], axis=1, keepdims=True) + 1e-4 * p[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            s[i] = 0.999 * s[i] + 0.001 * g * g
        p = [
            p[i] - 0.01 * (m[i] / (1 - 0.9**n)) / (np.sqrt(s[i] / (1 - 0.999**n)) + 1e-8)
            for i in (0, 1)
        ]
    got = mf.mf_sigmoid(ratings(spark), factors(spark), 0.2, iterations=6)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(arrays(got), p))


def sequential(batches, block):
    u, v = U0.copy(), V0.copy()
    alpha, lu, lv = 0.05, 0.3, 0.2
    for batch in batches:
        rows = [ROWS[i] for i in batch]
        if block:
            old_u, old_v = u.copy(), v.copy()
            for a, b, r in rows:  # a later row of the same id replaces the earlier step
                e = (r - old_u[a] @ old_v[b]) if r else 0.0
                u[a] = old_u[a] - alpha * (-e * old_v[b] + lu * old_u[a])
                v[b] = old_v[b] - alpha * (-e * old_u[a] + lv * old_v[b])
            continue
        e = [2 * (u[a] @ v[b] - r) for a, b, r in rows]
        du = [v[b] * x for (a, b, r), x in zip(rows, e)]
        dv = [u[a] * x for (a, b, r), x in zip(rows, e)]
        for (a, _, _), g in zip(rows, du):
            u[a] = u[a] - alpha * (g + lu * u[a])
        for (_, b, _), g in zip(rows, dv):
            v[b] = v[b] - alpha * (g + lv * v[b])
    return u, v


@pytest.mark.parametrize("block", [False, True])
def test_minibatches_with_repeated_ids_and_a_short_batch(spark, block):
    batches = [range(0, 4), range(4, 7), range(1, 5)]  # 7 rows in batches of 4, cycling
    placed = mf.numbered_ratings(ratings(spark))
    assert [(r.user_id, r.item_id) for r in placed.orderBy("pos").collect()] == [(a, b) for a, b, _ in ROWS]
    solver = mf.mf_minibatch_block if block else mf.mf_minibatch
    got = solver(placed, factors(spark), 0.05, 0.3, 0.2, 4, 3)
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(arrays(got), sequential(batches, block)))


def test_predictions_are_stretched(spark):
    pairs = spark.createDataFrame([(0, 0), (1, 2), (2, 1)], "item_id long, user_id long")
    got = {(r.user_id, r.item_id): r.score for r in mf.mf_predict(pairs, factors(spark)).collect()}
    raw = {(u, i): U0[u] @ V0[i] for i, u in [(0, 0), (1, 2), (2, 1)]}
    low, high = min(raw.values()), max(raw.values())
    assert got == pytest.approx({k: (x - low) / (high - low) * 4 + 1 for k, x in raw.items()})


def test_start_values_are_reproducible(spark):
    ids = spark.range(4)
    first, again = mf.start_factors(ids, ids, 3), mf.start_factors(ids.repartition(3), ids, 3)
    assert sorted(first.collect()) == sorted(again.collect())


def test_alternating_least_squares_ranks_seen_pairs(spark):
    rows = [(u, i, 5.0 if (u + i) % 2 else 1.0) for u in range(6) for i in range(6)]
    table = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    got = {(r.user_id, r.item_id): r.score for r in mf.mf_als(table, table, latent=2, lmd=0.01).collect()}
    assert len(got) == 36 and min(got.values()) == 1.0 and max(got.values()) == 5.0
    assert all((got[u, i] > 3) == (r > 3) for u, i, r in rows)


def random_ratings(spark, users=40, items=25, count=400, seed=5):
    rng = np.random.default_rng(seed)
    cells = rng.choice(users * items, count, replace=False)
    return spark.createDataFrame([(int(c // items), int(c % items), float(rng.integers(1, 6))) for c in cells], "user_id long, item_id long, rating double")


def test_grid_of_many_blocks_gives_the_same(spark, monkeypatch):
    """Blocks, cells and rows of any size change nothing but the order of sums."""
    rated = random_ratings(spark)
    ids = [spark.range(n).toDF("id") for n in (40, 26)]
    start = mf.start_factors(*ids, 3, 0.3)
    whole = mf.grid.build

    def solved(solver, **sizes):
        monkeypatch.setattr(mf.grid, "build", lambda *a: whole(*a, **sizes))
        return {(r[0], r[1]): tuple(r[2:]) for r in solver(rated, start, iterations=3).collect()}

    for solver in (mf.mf_gradient, mf.mf_sigmoid):
        one, many = solved(solver), solved(solver, block_rows=7, cell_ratings=20, row_ratings=5)
        assert set(one) == set(many) and len(one) == 66
        assert all(np.allclose(one[k], many[k], rtol=1e-9, atol=1e-12) for k in one)


def test_a_step_does_not_move_ratings(spark):
    """With broadcasts off, what a step exchanges are blocks of factors, never the cells."""
    rated = random_ratings(spark)
    start = mf.start_factors(spark.range(40).toDF("id"), spark.range(25).toDF("id"), 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = mf.grid.build(rated, start, block_rows=10)
        state = mf.grid.pack(start, mf.factor_columns(3), made.blocks)
        sums = mf.grid.cell_sums(made, state, 3, 3, lambda score, rating: (rating - score, score))
        plan = sums._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    above = lines[: next(i for i, line in enumerate(lines) if "InMemoryTableScan" in line)]
    # from the cells' scan up to the first join there is no exchange
    joins = [i for i, line in enumerate(above) if "Join" in line]
    assert joins and not any("Exchange" in line for line in above[joins[-1] :])
    made.close()


def test_unsettled_error_is_an_error(spark):
    rated = random_ratings(spark)
    start = mf.start_factors(spark.range(40).toDF("id"), spark.range(25).toDF("id"), 2)
    for solver in (mf.mf_gradient, mf.mf_sigmoid):
        with pytest.raises(RuntimeError):
            solver(rated, start, tol=0.0, max_iterations=2)


def test_no_ratings(spark):
    none = random_ratings(spark).limit(0)
    start = mf.start_factors(spark.range(3).toDF("id"), spark.range(2).toDF("id"), 2, 0.5)
    kept = {(r[0], r[1]): tuple(r[2:]) for r in mf.mf_gradient(none, start, lmd=0.0).collect()}
    assert kept == {(r[0], r[1]): tuple(r[2:]) for r in start.collect()}


def test_grid_blocks_follow_the_ratings_not_the_ids(spark):
    """Factors move once a block of the other side, so many ids alone must not make many blocks; a cell gives one sum."""
    import numpy as np
    from pyspark.sql import functions as F

    from rankloom.operators import grid

    ids = spark.range(150_000).select("id")
    factors = ids.select(F.lit(grid.USER).alias("kind"), "id", F.lit(0.5).alias("f0")).unionByName(
        ids.select(F.lit(grid.ITEM).alias("kind"), "id", F.lit(2.0).alias("f0"))
    )
    ratings = spark.range(20_000).select((F.col("id") % 7).alias("user_id"), F.col("id").alias("item_id"), F.lit(3.0).alias("rating"))
    made = grid.build(ratings, factors, row_ratings=100)
    tasks = spark.sparkContext.defaultParallelism
    assert made.blocks[0] == made.blocks[1] and made.blocks[0] ** 2 <= 4 * tasks
    state = grid.pack(factors, ["f0"], made.blocks)

    def slopes(score, rating):
        return rating - score, (rating - score) ** 2

    sums = grid.cell_sums(made, state, 1, 1, slopes).collect()
    made.close()
    cells = {(r["kind"], r["block"], r["other"]) for r in sums}
    assert len(cells) == len(sums) <= 2 * made.blocks[0] * made.blocks[1]
    assert sum(r["loss"] for r in sums) == pytest.approx(20_000 * 4.0)
    assert sum(np.frombuffer(r["g"]).sum() for r in sums if r["kind"] == grid.USER) == pytest.approx(20_000 * 2.0 * 2.0)
