"""Writers of the text outputs and of saved tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _line(*parts: str | Column) -> Column:
    return F.concat_ws(" ", *[_text(p) for p in parts]).alias("value")


def write_scores(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").parquet(path)


def score_lines(scores: DataFrame) -> DataFrame:
    return scores.select(_line("id", "score"))


def write_score_text(scores: DataFrame, path: str) -> None:
    """``id score`` lines."""
    score_lines(scores).write.mode("overwrite").text(path)


def run_lines(ranked: DataFrame, run_id: str = "rankloom") -> DataFrame:
    """``user-query Q0 doc position score runid``."""
    name = F.concat_ws("-", _text("user_id"), _text("query_id"))
    return ranked.select(_line(name, F.lit("Q0"), "doc", "position", "score", F.lit(run_id)))


def write_run(ranked: DataFrame, path: str, run_id: str = "rankloom") -> None:
    """Ranked lists in order, range partitioned so that big lists are shared out."""
    ordered = ranked.orderBy("user_id", "query_id", "position")
    run_lines(ordered, run_id).write.mode("overwrite").text(path)


def write_run_dir(run: DataFrame, path: str) -> None:
    """One folder per list holding ``<user>-<query>.results.txt`` style run lines.

    Rows are range partitioned by list and document first, so that a task opens
    files for few lists and a big list is shared out.
    """
    lines = run.repartitionByRange("user_id", "query_id", "doc").select(
        F.concat_ws("-", _text("user_id"), _text("query_id")).alias("list"),
        _line(F.lit(0), F.lit("Q0"), "doc", "orig_rank", "rel", F.lit("search")),
    )
    lines.write.mode("overwrite").partitionBy("list").text(path)


def write_predictions(ordered: DataFrame, path: str) -> None:
    """One score per line in the order of the targets."""
    ordered.orderBy("pair_idx").select(_text("score").alias("value")).write.mode("overwrite").text(path)


def prediction_name(method: str, split: str, *parameters: object) -> str:
    """File name that tells how predictions were made."""
    return "_".join([method, split, *map(str, parameters)]) + ".txt"


def write_ratings(ratings: DataFrame, path: str) -> None:
    rows = ratings.select("item_id", "user_id", F.col("rating").cast("int").alias("score"), F.lit("").alias("day"))
    rows.write.mode("overwrite").csv(path)


def write_text_csv(docs: DataFrame, path: str) -> None:
    writer = docs.select("label", "text").write.mode("overwrite")
    writer.csv(
        path, header=True, escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_vectors(vectors: DataFrame, path: str) -> None:
    """``word v1 v2 ...`` lines."""
    numbers = F.array_join(F.transform("v", lambda x: x.cast("string")), " ")
    vectors.select(_line("word", numbers)).write.mode("overwrite").text(path)


def libsvm_lines(labels: DataFrame, features: DataFrame) -> DataFrame:
    """``label idx:val ...`` with ascending indexes; a row holds at most one entry per feature."""
    entry = F.struct("idx", "val")
    rows = features.groupBy("row_id").agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    pairs = F.transform("_e", lambda e: F.concat_ws(":", e["idx"].cast("string"), e["val"].cast("string")))
    joined = labels.join(rows, "row_id", "left")
    return joined.select("row_id", F.rtrim(F.concat_ws(" ", _text("label"), F.array_join(pairs, " "))).alias("value"))


def write_libsvm(labels: DataFrame, features: DataFrame, path: str) -> None:
    libsvm_lines(labels, features).orderBy("row_id").select("value").write.mode("overwrite").text(path)


def hard_soft_lines(predictions: DataFrame) -> DataFrame:
    return predictions.select("row_id", _line("hard", "soft"))


def write_hard_soft(predictions: DataFrame, path: str) -> None:
    """``hard soft`` per row, in row order."""
    hard_soft_lines(predictions).orderBy("row_id").select("value").write.mode("overwrite").text(path)


def write_reviews(reviews: DataFrame, path: str) -> None:
    reviews.select("review_id", "text", "stars").write.mode("overwrite").json(path)


def save_model(weights: DataFrame, path: str) -> None:
    weights.write.mode("overwrite").parquet(path)
