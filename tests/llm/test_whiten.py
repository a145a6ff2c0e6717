import math
from fractions import Fraction

import numpy as np
import pytest

from rankloom.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, id string, x int, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, components=4):
    """The contract by Fractions and a dense covariance."""
    whole = {}
    kept = []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            x = tuple(math.floor(256 * float(np.float32(c))) for c in v)
            kept.append((i, x))
            whole[x] = 1
    fit = list(whole)
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    centred = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(dims)] for x in fit])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    out = []
    for i, x in kept:
        deviation = sum((n * x[d] - sums[d]) ** 2 for d in range(dims))
        white = np.array([float(Fraction(n * x[d] - sums[d], n)) for d in range(dims)]) @ axes[:, order] / np.sqrt(values[order])
        out += [(i, c + 1, n, deviation, white[c], values[order][c] / np.trace(cov)) for c in range(len(order))]
    return out


def same(got, want):
    got = sorted(got, key=lambda r: (str(r[0]), r[1], r[3], abs(r[4])))
    want = sorted(want, key=lambda r: (str(r[0]), r[1], r[3], abs(r[4])))
    assert [r[:4] for r in got] == [tuple(r[:4]) for r in want]
    assert np.allclose([abs(r[4]) for r in got], [abs(r[4]) for r in want], atol=1e-7)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-8)


def test_against_brute_force(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(6, 6))
    rows = [(i, (draw.normal(size=6) @ base * 0.2).astype(np.float32).tolist()) for i in range(80)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(40)]  # copies count once in the fit
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] * 6), (203, [math.inf, *[0.0] * 5]), (None, rows[0][1]), (5, rows[1][1])]
    got = whiten.whiten(table(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    out = got.collect()
    same(out, brute(rows))
    assert {r["identity_error"] for r in out} == {out[0]["identity_error"]} and out[0]["identity_error"] < 1e-9
    signs = {}
    truth = {(i, c): w for i, c, _, _, w, _ in brute(rows) if i is not None and i >= 6}
    for r in out:
        if (r[0], r[1]) in truth and abs(r[4]) > 1e-6:
            signs.setdefault(r[1], set()).add(r[4] * truth[r[0], r[1]] > 0)
    assert all(len(v) == 1 for v in signs.values())  # one sign for all rows


def test_pair_sums_are_exact_at_any_size():
    draw = np.random.default_rng(1)
    for top in (100, 1 << 31, 1 << 59):
        u = draw.integers(-top, top, (7, 3))
        first, second = whiten.pair_sums(u)
        cols = [[int(v) for v in u[:, i]] for i in range(3)]
        cols += [[a + b for a, b in zip(cols[i], cols[j])] for i, j in ((0, 1), (0, 2), (1, 2))]
        assert first == [sum(c) for c in cols] and second == [sum(v * v for v in c) for c in cols]
    for number in (0, -1, 1 << 100, -(1 << 150) + 12345):
        assert whiten._number(whiten._limbs(number)) == number


def test_huge_and_odd_vectors(spark):
    rows = [(0, [1e16, 1.0]), (1, [-1e16, 2.0]), (2, [3e16, 3.0]), (3, [3.4e38, 0.0]), (4, []), (5, [1.0, 2.0, 3.0]), (6, [0.0, -0.0])]
    out = whiten.whiten(table(spark, rows)).collect()
    assert {r["vec_id"] for r in out} == {0, 1, 2, 6} and {r["component"] for r in out} == {1, 2}
    assert all(r["deviation"] is None for r in out)
    assert all(r["identity_error"] < 1e-4 for r in out)


@pytest.mark.parametrize("rows", [[(0, [0.5, 0.25])], [(0, [0.5, 0.25]), (1, [0.5, 0.25])]])
def test_no_variance(spark, rows):
    out = whiten.whiten(table(spark, rows)).collect()
    assert len(out) == 2 * len(rows)
    assert all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in out)


def test_one_direction_and_empty(spark):
    out = whiten.whiten(table(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in out)
    assert {round(r["explained"], 9) for r in out if r["component"] == 1} == {1.0}
    for rows in ([], [(0, None)]):
        empty = whiten.whiten(table(spark, rows))
        assert empty.count() == 0 and empty.columns[0] == "vec_id"
