"""Inputs of the operators, derived from the given tables without leaving rows out.

The oracle states the same views in SQL (``plans/oracle/views.py``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.operators.layout import number_rows

STOPWORDS = ["the", "and", "to", "of", "in", "que", "der", "le"]
TOPICS = list(range(1, 13))
DIM = 64


class Views:
    """Lazy views over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def documents(self) -> DataFrame:
        """Documents, shared out when their files make fewer splits than there are cores.

        Cleaning text costs far more than moving it, and a big table has
        enough splits already, so there this adds no shuffle.
        """
        rows = self.table("documents").select("doc_id", "text", "lang")
        cores = self.spark.sparkContext.defaultParallelism
        return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, "doc_id")

    # Graph: customers (ids 3k), parts (3k + 1) and suppliers (3k + 2). A customer
    # links to the parts bought, a part to the customers who returned it and to its
    # suppliers; suppliers link nowhere.

    def nodes(self) -> DataFrame:
        return union_all(
            [
                self.table("customer").select((F.col("c_custkey") * 3).alias("id")),
                self.table("part").select((F.col("p_partkey") * 3 + 1).alias("id")),
                self.table("supplier").select((F.col("s_suppkey") * 3 + 2).alias("id")),
            ]
        )

    def edges(self) -> DataFrame:
        line = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        buyer, part, supplier = F.col("o_custkey") * 3, F.col("l_partkey") * 3 + 1, F.col("l_suppkey") * 3 + 2
        ends = [(buyer, part, F.lit(True)), (part, buyer, F.col("l_returnflag") == "R"), (part, supplier, F.lit(True))]
        links = F.array(*[F.struct(s.alias("src"), d.alias("dst"), on.alias("on")) for s, d, on in ends])
        rows = line.join(orders, "l_orderkey").select(F.explode(links).alias("e")).select("e.*").filter("on")
        return rows.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))

    def doc_topics(self) -> DataFrame:
        def topics(table: str, key: str, place: int, feature: str) -> DataFrame:
            topic = (1 + F.col(feature) % 12).cast("int")
            return self.table(table).select((F.col(key) * 3 + place).alias("doc"), topic.alias("topic"))

        return union_all(
            [
                topics("customer", "c_custkey", 0, "c_nationkey"),
                topics("part", "p_partkey", 1, "p_size"),
                topics("supplier", "s_suppkey", 2, "s_nationkey"),
            ]
        )

    # Users are nations, queries are six classes of orders.

    def _sales(self) -> DataFrame:
        line = self.table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        buyer = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("user_id")
        )
        query = (1 + F.col("l_orderkey") % 6).cast("int").alias("query_id")
        bought = orders.join(buyer, "o_custkey").select("l_orderkey", "user_id")  # the line items, the most rows, move once
        return line.join(bought, "l_orderkey").select("user_id", query, "l_partkey", "l_extendedprice")

    def _topic_counts(self) -> DataFrame:
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), (1 + F.col("p_size") % 12).cast("int").alias("topic")
        )
        sold = self._sales().join(part, "l_partkey")
        return sold.groupBy("user_id", "query_id", "topic").agg(F.count(F.lit(1)).cast("double").alias("n"))

    def user_mix(self) -> DataFrame:
        whole = Window.partitionBy("user_id", "query_id")  # at most one row per topic
        return self._topic_counts().select(
            "user_id", "query_id", "topic", (F.col("n") / F.sum("n").over(whole)).alias("p")
        )

    def query_mix(self) -> DataFrame:
        counts = self._topic_counts()
        lists = counts.select("user_id", "query_id").distinct()
        topics = counts.groupBy("query_id", "topic").agg(F.sum("n").alias("n"))
        whole = Window.partitionBy("query_id")  # at most one row per topic
        shares = topics.select("query_id", "topic", (F.col("n") / F.sum("n").over(whole)).alias("p"))
        return lists.join(shares, "query_id").select("user_id", "query_id", "topic", "p")

    def run(self) -> DataFrame:
        sold = self._sales().groupBy("user_id", "query_id", "l_partkey").agg(F.sum("l_extendedprice").alias("s"))
        rel = F.round(F.ln(F.col("s") / 10000000), 6)
        return sold.select("user_id", "query_id", (F.col("l_partkey") * 3 + 1).alias("doc"), rel.alias("rel"))

    # Ratings: quantity as stars, a tenth of the orders held out.

    def ratings(self) -> DataFrame:
        line = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        stars = (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("int")
        return line.join(orders, "l_orderkey").select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            stars.alias("rating"),
            (F.col("l_orderkey") % 10).cast("int").alias("fold"),
        )

    def train(self) -> DataFrame:
        rows = self.ratings().filter("fold < 9")
        return rows.groupBy("user_id", "item_id").agg(F.sum(F.col("rating") - 3).cast("double").alias("rating"))

    def stars(self) -> DataFrame:
        """Training stars without the offset, repeats added up."""
        rows = self.ratings().filter("fold < 9")
        return rows.groupBy("user_id", "item_id").agg(F.sum("rating").cast("double").alias("rating"))

    def profiles(self) -> DataFrame:
        return self.train().filter("rating <> 0")

    def truth(self) -> DataFrame:
        rows = self.ratings().filter("fold = 9")
        return rows.groupBy("item_id", "user_id").agg(F.avg("rating").alias("truth"))

    def pairs(self) -> DataFrame:
        return self.ratings().filter("fold = 9").select("item_id", "user_id").distinct()

    def targets(self) -> DataFrame:
        placed = number_rows(self.pairs(), [F.col("item_id"), F.col("user_id")], name="pair_idx")
        return placed.select("pair_idx", "item_id", "user_id")

    def users(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("id"))

    def items(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("id"))

    # Text: the language is the star class; folds by document.

    def reviews(self) -> DataFrame:
        lang = F.col("lang")
        stars = F.when(lang == "en", 1).when(lang == "de", 2).when(lang == "fr", 3).otherwise(4)
        tenth = F.col("doc_id") % 10
        split = F.when(tenth < 8, "train").when(tenth == 8, "dev").otherwise("test")
        return self.documents().select("doc_id", "text", stars.alias("stars"), split.alias("split"))

    def stopwords(self) -> DataFrame:
        return self.spark.createDataFrame([(w,) for w in STOPWORDS], "word string")

    def binary_text(self) -> DataFrame:
        labels = self.table("labels").select("doc_id", "quality")
        return self.documents().join(labels, "doc_id").select(
            "doc_id", "text", (2 * F.col("quality") - 1).alias("y")
        )

    # Dense rows: vectors with a sign and a class, every fifth held out.

    def dense_rows(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("row_id"),
            F.col("embedding").cast("array<double>").alias("v"),
            F.when(F.col("label") < 5, 1).otherwise(-1).alias("y"),
            (F.col("label") + 1).alias("cls"),
            (F.col("vec_id") % 5 == 0).alias("is_test"),
        )

    def dense_features(self, test: bool | None = None) -> DataFrame:
        rows = self.dense_rows()
        if test is not None:
            rows = rows.filter(F.col("is_test") if test else ~F.col("is_test"))
        return rows.select("row_id", F.posexplode("v").alias("idx", "val"))

    def dense_labels(self, test: bool | None = None) -> DataFrame:
        rows = self.dense_rows().select("row_id", "y", "cls", "is_test")
        if test is not None:
            rows = rows.filter(F.col("is_test") if test else ~F.col("is_test"))
        return rows.drop("is_test")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
