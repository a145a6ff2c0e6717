import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankloom.operators import layout


def test_number_rows_equals_a_window_with_one_hot_group(spark):
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(5), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, x int, id long").repartition(7)
    order = [F.col("x").desc(), F.col("id")]
    expected = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
    got = layout.number_rows(df, order, ["g"])
    assert sorted(got.collect()) == sorted(expected.select(got.columns).collect())


def test_number_rows_over_the_whole_table(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("id")).repartition(6)
    got = layout.number_rows(df, [F.col("id")]).collect()
    assert sorted((r["id"], r["pos"]) for r in got) == [(i, i + 1) for i in range(500)]


def test_top_per_group_keeps_exact_ranks(spark):
    rows = [("a" if i % 3 else "b", i * 7919 % 101, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x int, id int")
    order = [F.col("x").desc(), F.col("id").desc()]
    rank = F.row_number().over(Window.partitionBy("g").orderBy(*order))
    expected = df.withColumn("rank", rank).filter("rank <= 9")
    got = layout.top_per_group(df, ["g"], order, 9, ["id"], salts=4)
    assert sorted(got.collect()) == sorted(expected.collect())


def test_short_last_batch_comes_twice(spark):
    cuts = layout.minibatches(spark.range(7).withColumnRenamed("id", "row_id"), "row_id", 3).collect()
    sizes = [sum(r["batch"] == b for r in cuts) for b in range(4)]
    assert sizes == [3, 3, 1, 1]
    assert {r["row_id"] for r in cuts if r["batch"] == 2} == {r["row_id"] for r in cuts if r["batch"] == 3}
    assert layout.batch_count(7, 3) == 4
    assert layout.batch_count(7, 3, repeat_tail=False) == 3


def test_even_batches_leave_an_empty_one(spark):
    cuts = layout.minibatches(spark.range(6).withColumnRenamed("id", "row_id"), "row_id", 3).collect()
    assert sorted(r["batch"] for r in cuts) == [0, 0, 0, 1, 1, 1]
    assert layout.batch_count(6, 3) == 3


def test_holdout_stays_in_train_unless_exclusive(spark):
    df = spark.range(40)
    both = layout.holdout_sample(df, "id", 0.3).collect()
    assert sum(r["in_eval"] for r in both) == 12 and all(r["in_train"] for r in both)
    split = layout.holdout_sample(df, "id", 0.3, exclusive=True).collect()
    assert all(r["in_train"] != r["in_eval"] for r in split)


def test_length_batches_are_sorted(spark):
    df = spark.createDataFrame([(i, "x" * (i * 7 % 5)) for i in range(10)], "doc_id int, t string")
    got = sorted(layout.length_batches(df, "doc_id", F.length("t"), 4).collect(), key=lambda r: (r["length"], r["doc_id"]))
    assert [r["batch"] for r in got] == [0] * 4 + [1] * 4 + [2] * 2
