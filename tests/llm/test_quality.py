import random

import numpy as np
import pytest

from rankloom.llm import quality

from .helpers import odd_rows

WORDS = [a + b for a in ("ka", "to", "mi", "ru", "se") for b in ("na", "lo", "pe", "di", "gu")]


def labelled(count, start=0):
    draw = random.Random(start)
    rows = []
    for i in range(count):
        words = draw.choices(WORDS, k=draw.randint(15, 60))
        bad = i % 3 == 0
        text = " ".join(w.upper() + "!!" if bad and i % 2 else w + "$$$" if bad else w for w in words)
        rows.append((start + i, text, int(not bad), "x"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = [*labelled(240), (900, None, 1, "x"), (901, "ka na", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int, h string")
    return quality.train(df.drop("label"), df.select("doc_id", "label", "h"))


def test_held_out_accuracy(spark, model):
    rows = labelled(120, 5000)
    df = spark.createDataFrame(rows, "doc_id long, text string, label int, score string")
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y, _ in rows]) > 0.95


def test_odd_rows(spark, model):
    from .helpers import documents

    rows = odd_rows()
    out = quality.score(documents(spark, rows), model).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in out)
    same = {r["score"] for r in out if r["doc_id"] == 1007}
    assert len(same) == 1
    empty = {r["score"] for r in out if r["doc_id"] in (1000, 1001, 1002)}
    assert len(empty) == 1
    assert quality.score(documents(spark, []), model).count() == 0


def test_one_label_or_none(spark):
    schema = "doc_id long, text string, label int"
    df = spark.createDataFrame([(i, "a b c", 1) for i in range(9)], schema)
    ones = quality.train(df, df)
    assert ones.probabilities(np.zeros((1, len(ones.mean))))[0] > 0.99
    none = quality.train(df.limit(0), df.limit(0))
    assert none.probabilities(np.zeros((1, len(none.mean))))[0] == pytest.approx(0.5)


def test_neighbour_sums_by_hand():
    index = quality.index_vectors(64, 16, 4)
    got = quality.neighbour_sums(["aa bb cc", "dd"], 64, index, 1)
    parts, counts = quality._buckets(["aa bb cc", "dd"], 64)
    assert counts.tolist() == [3, 1]
    want = np.zeros((64, 16))
    for here, there in ((0, 1), (1, 0), (1, 2), (2, 1)):
        for part in range(quality.PARTS):
            want[parts[here, part]] += index[parts[there, 0]]
    assert np.allclose(got, want)
    assert (np.abs(index).sum(axis=1) == 4).all()


def test_temperature_of_overconfident_logits():
    draw = np.random.default_rng(1)
    true = draw.normal(0, 1, 20000)
    y = (draw.random(20000) < 1 / (1 + np.exp(-true))).astype(float)
    assert quality._temperature(3 * true, y) == pytest.approx(3, rel=0.15)
