import numpy as np
import pytest

from rankloom.operators import neighbours, similarity

USERS, ITEMS = 17, 11
LIMITS = [{}, {"block_queries": 2, "pack_entities": 3, "pack_ratings": 9}]


def ratings_matrix(seed=3):
    rng = np.random.default_rng(seed)
    m = rng.integers(-2, 3, (USERS, ITEMS)).astype(float)
    m[rng.random((USERS, ITEMS)) < 0.5] = 0
    m[4] = 0  # a user whose ratings are all neutral
    m[7] = 2  # a hot user
    return m


def long(spark, m):
    rows = [(int(u), int(i), float(m[u, i])) for u, i in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def ids(spark, values):
    return spark.createDataFrame([(int(v),) for v in values], "id long")


def brute(query, train, wanted, kind, centred, k, divisor, self_mode="drop_top"):
    if centred:
        query = query - query.sum(axis=1, keepdims=True) / divisor
        train = train - train.sum(axis=1, keepdims=True) / divisor
    sims = query @ train.T
    if kind == "cosine":
        norms = np.linalg.norm(query, axis=1)[:, None] * np.linalg.norm(train, axis=1)[None, :]
        sims = np.divide(sims, norms, out=np.zeros_like(sims), where=norms > 1e-12)
    out = {}
    for a in wanted:
        order = sorted(range(len(train)), key=lambda b: (-float(f"{sims[a, b] if abs(sims[a, b]) > 1e-12 else 0:.9e}"), -b))
        order = order[1 : k + 1] if self_mode == "drop_top" else [b for b in order if b != a][:k]
        out[a] = [(b, sims[a, b]) for b in order]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("a", "rank").collect():
        out.setdefault(r.a, []).append((r.b, r.sim))
    return out


@pytest.mark.parametrize("by", ["user", "item"])
@pytest.mark.parametrize("kind", similarity.MEASURES)
@pytest.mark.parametrize("centred", [False, True])
@pytest.mark.parametrize("limits", LIMITS)
def test_nearest_matches_the_dense_product(spark, by, kind, centred, limits):
    m = ratings_matrix()
    dense = m if by == "user" else m.T
    wanted = [0, 3, 4, 7, 10]
    n, cells = dense.shape
    got = similarity.nearest(
        long(spark, m), long(spark, m), ids(spark, wanted), ids(spark, range(n)), by, kind, centred, 5, cells, **limits
    )
    got, expected = collected(got), brute(dense, dense, wanted, kind, centred, 5, n)
    assert set(got) == set(expected)
    for a in wanted:
        assert [b for b, _ in got[a]] == [b for b, _ in expected[a]], (a, got[a], expected[a])
        assert np.allclose([s for _, s in got[a]], [s for _, s in expected[a]], atol=1e-9)


@pytest.mark.parametrize("limits", LIMITS)
def test_exclude_drops_the_entity_itself(spark, limits):
    m = ratings_matrix()
    got = similarity.nearest(
        long(spark, m), long(spark, m), ids(spark, [0, 7]), ids(spark, range(USERS)), k=4, self_mode="exclude", **limits
    )
    expected = brute(m, m, [0, 7], "dot", False, 4, USERS, "exclude")
    assert {a: [b for b, _ in v] for a, v in collected(got).items()} == {
        a: [b for b, _ in v] for a, v in expected.items()
    }


@pytest.mark.parametrize("kind", similarity.MEASURES)
@pytest.mark.parametrize("centred", [False, True])
def test_bounds_hold_and_skip_packs(kind, centred):
    """No similarity in a pack is above its bound, and packs of short vectors are left out once k longer ones are known."""
    rng = np.random.default_rng(8)
    m = rng.integers(-2, 3, (60, 12)) * (rng.random((60, 12)) < 0.4) * np.repeat([3.0, 0.1], [20, 40])[:, None]
    formula = similarity.Measure(kind, centred, 60.0, 12.0)

    def pack(places):
        ids = np.array(places, np.int64)
        u, c = np.nonzero(m[ids])
        entities = (0, ids.tobytes(), m[ids].sum(axis=1).tobytes(), (m[ids] ** 2).sum(axis=1).tobytes())
        return similarity.Vectors([entities, (1, ids[u].tobytes(), c.astype(np.int64).tobytes(), m[ids][u, c].tobytes())], formula)

    search = similarity.Search(pack(range(60)).by_entity(), formula, 3, False)
    parts = [list(range(0, 20)), list(range(20, 40)), list(range(40, 60))]
    shifted = m - m.sum(axis=1, keepdims=True) / 60.0 if centred else m
    sims = shifted @ shifted.T
    if kind == "cosine":
        norms = np.linalg.norm(shifted, axis=1)
        sims = np.divide(sims, np.outer(norms, norms), out=np.zeros_like(sims), where=np.outer(norms, norms) > 0)
    for part in parts:
        there = pack(part).by_cell(formula)
        q = search.queries
        slots = np.minimum(np.searchsorted(there.cells, q.cell), len(there.cells) - 1)
        bounds = search._bounds(there, there.cells[slots] == q.cell, slots)
        assert (sims[:, part].max(axis=1) <= bounds + 1e-12).all()
        search.meet(there)
    if kind == "dot":
        assert search.skipped > 30


def test_no_pairs_are_stored(spark, monkeypatch):
    """What a search stores grows with entities and ratings, not with pairs."""
    m = np.ones((200, 4))  # every user shares every cell with all others
    stored = []
    whole = similarity.stash
    monkeypatch.setattr(similarity, "stash", lambda df, name, *a: stored.append(whole(df, name, *a)) or stored[-1])
    got = similarity.nearest(long(spark, m), long(spark, m), ids(spark, range(200)), ids(spark, range(200)), k=2, block_queries=50)
    assert got.count() == 400
    assert len(stored) == 2  # packs of queries and of entities


def searched(spark, m, k, self_mode="drop_top", measure="dot", centred=False, **limits):
    n, cells = m.shape
    limits = {"block_queries": 20, "pack_entities": 2, "pack_ratings": 40, **limits}
    return similarity.nearest(
        long(spark, m), long(spark, m), ids(spark, range(n)), ids(spark, range(n)), "user", measure, centred, k, cells,
        self_mode=self_mode, **limits,
    )


@pytest.mark.parametrize("kind", similarity.MEASURES)
@pytest.mark.parametrize("centred", [False, True])
@pytest.mark.parametrize("room", [1, 6, 40])
@pytest.mark.parametrize("self_mode", ["drop_top", "exclude"])
def test_blocks_that_get_their_own_cells_only(spark, kind, centred, room, self_mode):
    """Sparse and common cells, negative and equal sums; entities without a common cell are among the nearest."""
    rng = np.random.default_rng(5)
    m = rng.integers(-2, 3, (120, 60)) * (rng.random((120, 60)) < 0.06).astype(float)
    m[:, 0] = rng.integers(-1, 2, 120)
    m[30:50] = np.eye(20, 60)  # many equal sums
    m[50:54] = 0
    m[54, 1:] = -1.0
    got = collected(searched(spark, m, 5, self_mode, kind, centred, end_entities=room))
    expected = brute(m, m, range(120), kind, centred, 5, 120, self_mode)
    assert set(got) == set(expected)
    for a in expected:
        assert [b for b, _ in got[a]] == [b for b, _ in expected[a]], (a, got[a], expected[a])
        assert np.allclose([s for _, s in got[a]], [s for _, s in expected[a]], atol=1e-9)


def test_query_that_shares_cells_with_an_end_meets_everything(spark):
    """All far entities that a block knows of are worse than one it does not know of: none is lost."""
    m = np.zeros((100, 30))
    m[80:, 0] = -1.0  # the end by id shares a cell with query 7 and is below zero for it
    m[7, 0] = 1.0
    got = collected(searched(spark, m, 3, "exclude", end_entities=4))
    assert [b for b, _ in got[7]] == [79, 78, 77]


def test_ratings_go_to_the_blocks_that_share_their_cell(spark):
    """What blocks receive does not grow with their number where cells are their own (before: every rating to every block)."""
    m = np.kron(np.eye(40), np.ones((4, 3)))  # 40 groups of four users with three cells of their own
    asked = spark.createDataFrame([(int(u) // 4, int(c)) for u, c in zip(*np.nonzero(m))], "block int, cell long")
    postings = long(spark, m).selectExpr("cast(user_id % 3 as int) no", "user_id id", "item_id cell", "rating v")
    rows = similarity._routed(asked, postings, 3, 5).collect()
    sent = sorted((r.block, u, c, v, r["pack"]) for r in rows for u, c, v in zip(*similarity._unpressed((r.x, r.y, r.z))))
    assert sent == sorted((u // 4, u, c, 1.0, u % 3) for u, c in zip(*np.nonzero(m)))


@pytest.mark.parametrize("value", [[1.0, -2.0, 3.0], [0.5, 0.25, -1.0], [0.1, 1e300, -3.0], [300.0, 2.0, 1e9], [np.inf, np.nan, 1e-300]])
def test_pressed_ratings_are_the_same(value):
    ids, cell, value = np.array([2**40, -5, 7]), np.array([-(2**50), 3, 3]), np.array(value)
    for got, put in zip(similarity._unpressed(similarity._pressed(ids, cell, value)), (ids, cell, value)):
        assert np.array_equal(got, put, equal_nan=put.dtype.kind == "f") and got.dtype == put.dtype
    one = similarity._unpressed(similarity._pressed(ids[:1], cell[:1], value[:1]))
    assert [len(x) for x in one] == [1, 1, 1]


def test_ids_must_be_numbers(spark):
    text = spark.createDataFrame([("a", 1, 1.0)], "user_id string, item_id long, rating double")
    with pytest.raises(TypeError):
        similarity.nearest(text, text, ids(spark, [1]), ids(spark, [1]))


def test_nothing_to_search(spark):
    none = long(spark, np.zeros((2, 2)))
    assert similarity.nearest(none, none, ids(spark, []), ids(spark, [1])).count() == 0
    assert similarity.nearest(none, none, ids(spark, [1]), ids(spark, [])).count() == 0
    got = similarity.nearest(none, none, ids(spark, [1, 2]), ids(spark, [1, 2, 3]), k=2).collect()
    assert sorted((r.a, r.b, r.sim, r["rank"]) for r in got) == [(a, b, 0.0, r) for a in (1, 2) for b, r in ((1, 2), (2, 1))]


def test_heavier_user_is_dropped_first_under_dot(spark):
    m = np.zeros((3, 4))
    m[0, :2] = 1
    m[1] = 2
    m[2, 3] = 1
    got = similarity.nearest(long(spark, m), long(spark, m), ids(spark, [0]), ids(spark, range(3)), k=1)
    assert [r.b for r in got.collect()] == [0]  # user 1 came first and was dropped, the user itself stays


@pytest.mark.parametrize("mean", neighbours.MEANS)
@pytest.mark.parametrize("by", ["user", "item"])
def test_prediction_by_hand(spark, by, mean):
    m = ratings_matrix()
    dense = m if by == "user" else m.T
    n, cells = dense.shape
    pairs = [(u, i) for u in (0, 4, 7) for i in (1, 5)]
    targets = spark.createDataFrame([(i, u) for u, i in pairs], "item_id long, user_id long")
    wanted = sorted({u if by == "user" else i for u, i in pairs})
    near = similarity.nearest(
        long(spark, m), long(spark, m), ids(spark, wanted), ids(spark, range(n)), by, "cosine", k=4
    )
    got = neighbours.knn_predict(targets, near, long(spark, m), by, mean)
    got = {(r.user_id, r.item_id): r.score for r in got.collect()}
    expected = brute(dense, dense, wanted, "cosine", False, 4, n)
    for u, i in pairs:
        a, other = (u, i) if by == "user" else (i, u)
        ratings = np.array([dense[b, other] for b, _ in expected[a]])
        sims = np.array([s for _, s in expected[a]])
        weights = sims / sims.sum() if sims.sum() else sims
        score = ratings.mean() if mean == "mean" else weights @ ratings
        assert got[u, i] == pytest.approx(score + 3, abs=1e-9)


@pytest.mark.parametrize("mean", neighbours.MEANS)
@pytest.mark.parametrize("by", ["user", "item"])
def test_prediction_with_more_neighbours_than_raters(spark, by, mean):
    """Targets with few and many raters, none, null and repeated ratings, and an entity without neighbours."""
    entity, other = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    near = spark.createDataFrame(
        [(1, b, s) for b, s in ((1, 0.5), (2, -0.25), (3, 0.75), (4, 1.0))] + [(2, 3, 0.5), (2, 1, -0.5)], "a long, b long, sim double"
    )
    known = [(1, 10, 2.0), (3, 10, -1.0), (3, 10, 1.0), (4, 11, None), (9, 11, 2.0)] + [(b, 12, float(b)) for b in range(1, 8)]
    train = spark.createDataFrame(known, f"{entity} long, {other} long, rating double")
    pairs = [(a, o) for a in (1, 2, 5) for o in (10, 11, 12, 13, None)]
    targets = spark.createDataFrame(pairs + pairs, f"{entity} long, {other} long")
    got = neighbours.knn_predict(targets, near, train, by, mean).collect()
    got = {(r[entity], r[other]): r.score for r in got}
    lists = {1: [(1, 0.5), (2, -0.25), (3, 0.75), (4, 1.0)], 2: [(3, 0.5), (1, -0.5)]}
    expected = {}
    for a, o in pairs:
        rows = [(s, r or 0.0) for b, s in lists.get(a, []) for r in [k[2] for k in known if k[:2] == (b, o)] or [0.0]]
        if rows:
            weight = sum(s for s, _ in rows) or 1.0
            score = sum(r for _, r in rows) / len(rows) if mean == "mean" else sum(s * r for s, r in rows) / weight
            expected[a, o] = pytest.approx(score + 3, abs=1e-12)
    assert got == expected


def test_rescale_and_order(spark):
    pred = spark.createDataFrame([(1, 1, -1.0), (2, 1, 0.0), (3, 1, 3.0)], "item_id long, user_id long, score double")
    scaled = {r.item_id: r.score for r in neighbours.rescale_predictions(pred).collect()}
    assert scaled == {1: 1.0, 2: 2.0, 3: 5.0}
    targets = spark.createDataFrame([(1, 3, 1), (2, 1, 1), (3, 3, 1)], "pair_idx long, item_id long, user_id long")
    ordered = neighbours.prediction_order(targets, pred).orderBy("pair_idx")
    assert [r.score for r in ordered.collect()] == [3.0, -1.0, 3.0]


def test_bad_arguments(spark):
    df = ids(spark, [1])
    for kwargs in ({"by": "x"}, {"self_mode": "x"}, {"measure": "x"}, {"centred": True}):
        with pytest.raises(ValueError):
            similarity.nearest(long(spark, np.eye(2)), long(spark, np.eye(2)), df, df, **kwargs)
