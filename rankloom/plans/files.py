"""Queries that write a view in an input or output format and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.operators import neighbours, retrieval
from rankloom.plans import link, margin, rating, words
from rankloom.plans.oracle import files as sql
from rankloom.plans.registry import Query, rounded
from rankloom.plans.views import DIM, TOPICS, Views
from rankloom.session import scratch_path
from rankloom.sources import readers, writers


def _lines(v: Views, df: DataFrame, *columns, sep: str = " ") -> str:
    """Write columns as text lines; returns the path."""
    path = scratch_path(v.spark, "lines")
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    df.select(F.concat_ws(sep, *parts)).write.text(path)
    return path


def edges(v: Views) -> DataFrame:
    return readers.read_edges(v.spark, _lines(v, v.edges(), "src", "dst", F.col("weight").cast("int")))


def doc_topics(v: Views) -> DataFrame:
    return readers.read_doc_topics(v.spark, _lines(v, v.doc_topics(), "doc", "topic"))


def topic_mixture(v: Views) -> DataFrame:
    shares = [F.coalesce(F.sum(F.when(F.col("topic") == t, F.col("p"))), F.lit(0.0)).alias(f"p{t}") for t in TOPICS]
    wide = v.user_mix().groupBy("user_id", "query_id").agg(*shares)
    pairs = [F.concat(F.lit(f"{t}:"), F.col(f"p{t}").cast("string")) for t in TOPICS]
    return rounded(readers.read_topic_mixture(v.spark, _lines(v, wide, "user_id", "query_id", *pairs)))


def run_dir(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "run")
    writers.write_run_dir(v.run().withColumn("orig_rank", F.lit(0)), path)
    return readers.read_run_dir(v.spark, path).select("user_id", "query_id", "doc", "rel")


def _rating_file(v: Views) -> str:
    return _lines(v, v.ratings(), "item_id", "user_id", "rating", F.lit("2005-01-01"), sep=",")


def profiles(v: Views) -> DataFrame:
    pair = F.concat_ws(":", F.col("item_id").cast("string"), F.col("rating").cast("string"))
    return readers.read_profiles(v.spark, _lines(v, v.ratings(), "user_id", pair))


def targets(v: Views) -> DataFrame:
    return readers.read_targets(v.spark, _lines(v, v.targets().orderBy("pair_idx"), "item_id", "user_id", sep=","))


def labelled_tree(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "tree")
    rows = v.binary_text().select("y", text.clean_line(F.col("text")).alias("text"))
    rows.filter("y = 1").select("text").write.text(f"{path}/positive")
    rows.filter("y = -1").select("text").write.text(f"{path}/negative")
    return readers.read_labelled_tree(v.spark, path)


def vectors(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "vectors")
    rows = v.dense_rows().select(F.concat(F.lit("w"), F.col("row_id").cast("string")).alias("word"), "v")
    writers.write_vectors(rows, path)
    return words._vector_text(readers.read_vectors(v.spark, path, DIM), "v")


def text_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv")
    rows = v.binary_text().select(F.when(F.col("y") > 0, "pos").otherwise("neg").alias("label"), "text")
    rows = rows.withColumn("text", text.clean_line(F.col("text")))
    writers.write_text_csv(rows, path)
    return readers.read_text_csv(v.spark, path)


def libsvm(v: Views) -> DataFrame:
    """Labels and features of the star classifier after a round trip, a row for each feature."""
    path = scratch_path(v.spark, "libsvm")
    rows = v.reviews().select(F.col("doc_id").alias("row_id"), F.col("stars").alias("label"))
    writers.write_libsvm(rows, words.doc_term(v, "CTF"), path)
    labels, features = readers.read_libsvm(v.spark, path)
    joined = labels.join(features, "row_id", "left")
    return joined.select(F.col("label").cast("int").alias("label"), "idx", F.col("val").cast("long").alias("val"))


def reviews(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "reviews")
    stars = F.when(F.col("split") == "train", F.col("stars"))
    rows = v.reviews().select(F.col("doc_id").cast("string").alias("review_id"), "text", stars.alias("stars"))
    writers.write_reviews(rows, path)
    return readers.read_reviews(v.spark, path)


def frequent_words(v: Views) -> DataFrame:
    """Words found in more than a tenth of the reviews, written and read as stop words."""
    total = v.reviews().count()
    common = words.review_words(v).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * 10 > total)
    return readers.read_stopwords(v.spark, _lines(v, common, "word"))


def scores(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "scores")
    writers.write_scores(link.global_ranks(v), path)
    return rounded(readers.read_scores(v.spark, path), 12)


def score_text(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "scoretext")
    writers.write_score_text(link.global_ranks(v).withColumnRenamed("rank", "score"), path)
    part = F.split("value", " ")
    back = v.spark.read.text(path)
    return rounded(back.select(part[0].cast("long").alias("id"), part[1].cast("double").alias("rank")), 12)


def written_run(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "ranked")
    writers.write_run(retrieval.retrieve(v.run(), link.global_ranks(v), "WS"), path)
    return rounded(readers.read_ranked_run(v.spark, path))


def written_predictions(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "predictions")
    ordered = neighbours.prediction_order(v.targets(), rating.predicted(v, "user", "dot", False, "mean"))
    writers.write_predictions(ordered, path)
    return rounded(readers.read_predictions(v.spark, path))


def hard_soft(v: Views) -> DataFrame:
    """Lines of hard and soft stars, numbered in row order."""
    path = scratch_path(v.spark, "stars")
    writers.write_hard_soft(margin.star_guess(v), path)
    part = F.split("value", " ")
    back = readers.numbered_lines(v.spark, path)
    return rounded(
        back.select("line_no", part[0].cast("int").alias("hard"), part[1].cast("double").alias("soft")), 6
    )


def model(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "model")
    writers.save_model(margin.star_weights(v), path)
    return rounded(readers.load_model(v.spark, path))


QUERIES: dict[str, Query] = {
    "read_edges": Query(edges, sql.EDGES),
    "read_doc_topics": Query(doc_topics, sql.DOC_TOPICS),
    "read_topic_mixture": Query(topic_mixture, sql.MIXTURE),
    "read_run_dir": Query(run_dir, sql.RUN),
    "read_ratings": Query(lambda v: readers.read_ratings(v.spark, _rating_file(v)), sql.ratings(3)),
    "read_ratings_raw": Query(lambda v: readers.read_ratings_raw(v.spark, _rating_file(v)), sql.ratings(0)),
    "read_profiles": Query(profiles, sql.ratings(3) + " WHERE rating <> 3"),
    "read_targets": Query(targets, sql.TARGETS),
    "read_labelled_tree": Query(labelled_tree, sql.TREE),
    "read_vectors": Query(vectors, sql.VECTORS),
    "read_text_csv": Query(text_csv, sql.TEXT_CSV),
    "read_libsvm": Query(libsvm, sql.LIBSVM),
    "read_reviews": Query(reviews, sql.REVIEWS),
    "read_stopwords": Query(frequent_words, sql.STOPWORDS),
    "read_scores": Query(scores, sql.SCORES),
    "write_score_text": Query(score_text, sql.SCORES),
    "write_run": Query(written_run, sql.RANKED),
    "write_predictions": Query(written_predictions, sql.PREDICTIONS),
    "write_hard_soft": Query(hard_soft, sql.HARD_SOFT),
    "save_model": Query(model, sql.MODEL),
}
