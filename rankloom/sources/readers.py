"""Readers of the text inputs, each with an explicit schema. Blank lines are skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.numeric import sentiment_label
from rankloom.functions.text import WHITESPACE, nonempty, pair_key, pair_value

# Fixed value: <user>-<query>.results.txt, or a folder list=<user>-<query> of part files.
RUN_NAME = r"(?:^|[/=])([0-9]+)-([0-9]+)(?:\.[A-Za-z.]+|/[^/]+)$"


def _fields(spark: SparkSession, path: str) -> DataFrame:
    """Lines as an array ``f`` of white-space separated fields."""
    lines = spark.read.text(path)
    return lines.select(nonempty(F.split("value", f"[{WHITESPACE}]+")).alias("f")).filter(F.size("f") > 0)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """``src dst weight`` lines; repeated links are added up."""
    f = F.col("f")
    rows = _fields(spark, path).select(
        f[0].cast("long").alias("src"), f[1].cast("long").alias("dst"), f[2].cast("double").alias("weight")
    )
    return rows.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def read_doc_topics(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    return _fields(spark, path).select(f[0].cast("long").alias("doc"), f[1].cast("int").alias("topic"))


def read_topic_mixture(spark: SparkSession, path: str) -> DataFrame:
    """``user query 1:p 2:p ...``: the topic is the position, the key text is ignored."""
    f = F.col("f")
    rows = _fields(spark, path).select(
        f[0].cast("int").alias("user_id"),
        f[1].cast("int").alias("query_id"),
        F.posexplode(F.slice(f, 3, F.size(f) - 2)).alias("at", "pair"),
    )
    return rows.select(
        "user_id", "query_id", (F.col("at") + 1).alias("topic"), pair_value(F.col("pair")).cast("double").alias("p")
    )


def parse_run_name(name: Column) -> list[Column]:
    """User and query from ``<user>-<query>.results.txt``."""
    return [
        F.regexp_extract(name, RUN_NAME, 1).cast("int").alias("user_id"),
        F.regexp_extract(name, RUN_NAME, 2).cast("int").alias("query_id"),
    ]


def read_run_dir(spark: SparkSession, path: str) -> DataFrame:
    """``(user_id, query_id, doc, orig_rank, rel)`` from one file per list."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    rows = lines.select(F.input_file_name().alias("name"), nonempty(F.split("value", f"[{WHITESPACE}]+")).alias("f"))
    f = F.col("f")
    return rows.filter(F.size("f") > 0).select(
        *parse_run_name(F.col("name")),
        f[2].cast("long").alias("doc"),
        f[3].cast("int").alias("orig_rank"),
        f[4].cast("double").alias("rel"),
    )


def read_ranked_run(spark: SparkSession, path: str) -> DataFrame:
    """``user-query Q0 doc position score runid`` lines of a written run."""
    f = F.col("f")
    return _fields(spark, path).select(
        F.split_part(f[0], F.lit("-"), F.lit(1)).cast("int").alias("user_id"),
        F.split_part(f[0], F.lit("-"), F.lit(2)).cast("int").alias("query_id"),
        f[2].cast("long").alias("doc"),
        f[3].cast("long").alias("position"),
        f[4].cast("double").alias("score"),
    )


def read_ratings(spark: SparkSession, path: str, offset: int = 3) -> DataFrame:
    """``item,user,score,date`` rows with ``score - offset``; the date is not read."""
    schema = "item_id long, user_id long, score int, day string"
    rows = spark.read.csv(path, schema=schema)
    return rows.select("item_id", "user_id", (F.col("score") - offset).cast("double").alias("rating"))


def read_ratings_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_ratings(spark, path, offset=0)


def rating_matrix(ratings: DataFrame) -> DataFrame:
    """One row per user and item; repeated pairs are added up."""
    return ratings.groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating"))


def distinct_entities(ratings: DataFrame, entity: str) -> DataFrame:
    return ratings.select(F.col(entity).alias("id")).distinct()


def read_profiles(spark: SparkSession, path: str, offset: int = 3) -> DataFrame:
    """``user item:score item:score ...`` with neutral scores dropped."""
    f = F.col("f")
    rows = _fields(spark, path).select(
        f[0].cast("long").alias("user_id"), F.explode(F.slice(f, 2, F.size(f) - 1)).alias("pair")
    )
    scored = rows.select(
        "user_id",
        pair_key(F.col("pair")).cast("long").alias("item_id"),
        (pair_value(F.col("pair")).cast("int") - offset).cast("double").alias("rating"),
    )
    return drop_neutral(scored)


def centre_ratings(ratings: DataFrame, offset: float = 3.0) -> DataFrame:
    return ratings.withColumn("rating", (F.col("rating") - offset).cast("double"))


def drop_neutral(ratings: DataFrame) -> DataFrame:
    return ratings.filter("rating <> 0")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, value)`` from 1, in file name order and line order.

    A line's key is its file, its split's offset and its place in the split;
    the keys are range sorted, so no task reads the whole input.
    """
    from rankloom.operators.layout import number_rows

    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
    )
    lines = lines.filter("trim(value) <> ''")
    placed = number_rows(lines, [F.col("_file"), F.col("_start"), F.col("_line")], name="line_no")
    return placed.select("line_no", "value")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """``item,user`` pairs with their place in the file as ``pair_idx``."""
    part = F.split("value", ",")
    return numbered_lines(spark, path).select(
        F.col("line_no").alias("pair_idx"), part[0].cast("long").alias("item_id"), part[1].cast("long").alias("user_id")
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Written predictions with the target they belong to."""
    lines = numbered_lines(spark, path)
    return lines.select(F.col("line_no").alias("pair_idx"), F.col("value").cast("double").alias("score"))


def read_labelled_tree(spark: SparkSession, path: str) -> DataFrame:
    """One example per line below ``positive`` and ``negative`` folders."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    folder = F.regexp_extract(F.input_file_name(), r"/(positive|negative)/[^/]*$", 1)
    return lines.select(sentiment_label(folder).alias("label"), F.col("value").alias("text")).filter("label is not null")


def read_vectors(spark: SparkSession, path: str, dim: int = 100) -> DataFrame:
    """Word vectors; lines that do not have exactly ``dim + 1`` fields are left out."""
    rows = _fields(spark, path).filter(F.size("f") == dim + 1)
    return rows.select(F.col("f")[0].alias("word"), F.slice("f", 2, dim).cast("array<double>").alias("v"))


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``label,text`` with a header; files can be split unless texts hold line breaks."""
    return spark.read.csv(path, schema="label string, text string", header=True, multiLine=multi_line, escape='"')


def read_libsvm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(row_id, label)`` and ``(row_id, idx, val)``; indexes are kept as written."""
    from rankloom.session import stash

    rows = _fields(spark, path).withColumn("row_id", F.monotonically_increasing_id())
    rows = stash(rows, "libsvm")  # row ids must be the same for both results
    f = F.col("f")
    labels = rows.select("row_id", f[0].cast("double").alias("label"))
    pairs = rows.select("row_id", F.explode(F.slice(f, 2, F.size(f) - 1)).alias("pair"))
    features = pairs.select(
        "row_id", pair_key(F.col("pair")).cast("int").alias("idx"), pair_value(F.col("pair")).cast("double").alias("val")
    )
    return labels, features


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; reviews without stars get label 0."""
    rows = spark.read.schema("review_id string, text string, stars int").json(path)
    return rows.select("review_id", "text", F.coalesce("stars", F.lit(0)).alias("stars"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    words = spark.read.text(path).select(F.trim("value").alias("word"))
    return words.filter("word <> ''").distinct()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores saved by ``write_scores``."""
    return spark.read.parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
