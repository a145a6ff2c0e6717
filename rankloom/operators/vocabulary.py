"""Token tables, counts, vocabularies and feature selection.

Token tables are ``(doc_id, pos, word)`` or ``(doc_id, word)`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.text import pad, token_windows
from rankloom.operators.layout import top_per_group

UNKNOWN, PADDING = "<unk>", "<pad>"
BROADCAST_WORDS = 100_000  # Size bound under which a vocabulary is broadcast.


def small_words(words: DataFrame) -> DataFrame:
    """Broadcast hint for a word list that has few enough rows, which are counted; else the list as it is.

    The count stops at the bound, and a stored list is counted from its footers.
    """
    return F.broadcast(words) if words.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS else words


def token_rows(docs: DataFrame, tokens: Column, *keep: str) -> DataFrame:
    """One row per token: ``doc_id``, kept columns, ``pos`` from 0, ``word``."""
    return docs.select("doc_id", *keep, F.posexplode(tokens).alias("pos", "word"))


def stopword_anti(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    return tokens.join(stopwords.select("word").distinct(), "word", "left_anti")


def word_count(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def document_words(tokens: DataFrame, *keep: str) -> DataFrame:
    """Each document's words once, with their count."""
    return tokens.groupBy("doc_id", *keep, "word").agg(F.count(F.lit(1)).alias("tf"))


def document_freq(words: DataFrame) -> DataFrame:
    """Documents per word, from :func:`document_words`."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def class_document_freq(words: DataFrame, cls: str = "stars") -> DataFrame:
    return words.groupBy(cls, "word").agg(F.count(F.lit(1)).alias("cnt"))


def most_common(counts: DataFrame, k: int, name: str = "rank") -> DataFrame:
    """The ``k`` most frequent words; equal counts in word order.

    Every task cuts its words to ``k`` before they meet, and only those ``k`` are numbered.
    """
    order = [F.col("cnt").desc(), F.col("word").asc()]
    best = counts.orderBy(*order).limit(k)
    return best.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def top_vocab(counts: DataFrame, size: int = 10_000, first: int = 2) -> DataFrame:
    """``(word, idx, cnt)`` of the most frequent words, indexed from ``first``."""
    return most_common(counts, size).select("word", (F.col("rank") + (first - 1)).cast("int").alias("idx"), "cnt")


def build_vocab(counts: DataFrame, min_freq: int = 3, size: int = 10_000) -> DataFrame:
    """Vocabulary with the two special words first."""
    words = top_vocab(counts.filter(F.col("cnt") >= min_freq), size)
    special = counts.sparkSession.createDataFrame(
        [(UNKNOWN, 0, 0), (PADDING, 1, 0)], "word string, idx int, cnt long"
    )
    return special.unionByName(words)


def encode_pad(tokens: DataFrame, docs: DataFrame, vocab: DataFrame, length: int = 1000) -> DataFrame:
    """``(doc_id, codes)``: word indexes, 0 for unknown, cut or filled with 1 to ``length``.

    Tokens beyond ``length`` are cut before anything is collected, so a
    document's group has at most ``length`` rows.
    """
    known = small_words(vocab.select("word", "idx"))
    used = tokens.filter(F.col("pos") < length).join(known, "word", "left")
    coded = used.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("idx", F.lit(0)).alias("idx")))).alias("_c")
    )
    codes = F.coalesce(F.col("_c.idx"), F.array().cast("array<int>"))
    return docs.select("doc_id").join(coded, "doc_id", "left").select("doc_id", pad(codes, length).alias("codes"))


def ngram_counts(docs: DataFrame, tokens: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """``(n, gram, docs, cnt)`` of all token runs."""
    runs = F.array(
        *[F.struct(F.lit(n).alias("n"), token_windows(F.col("_t"), n).alias("grams")) for n in sizes]
    )
    grams = (
        docs.select("doc_id", tokens.alias("_t"))
        .select("doc_id", F.explode(runs).alias("r"))
        .select("doc_id", F.col("r.n").alias("n"), F.explode("r.grams").alias("gram"))
    )
    per_doc = grams.groupBy("doc_id", "n", "gram").agg(F.count(F.lit(1)).alias("tf"))
    return per_doc.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("docs"), F.sum("tf").alias("cnt"))


# ------------------------------------------------------------ feature selection

SCHEMES = ("CTF", "DF", "BAL")


def top_features(words: DataFrame, scheme: str = "CTF", k: int = 2000) -> DataFrame:
    """``(word, idx)`` of the ``k`` most frequent words by tokens or by documents."""
    counts = words.groupBy("word").agg(F.sum("tf").alias("cnt")) if scheme == "CTF" else document_freq(words)
    return most_common(counts, k).select("word", (F.col("rank") - 1).cast("int").alias("idx"))


def top_features_per_class(words: DataFrame, k: int = 2000, cls: str = "stars") -> DataFrame:
    """``(cls, word, cnt, rank)``: the ``k`` words in most documents of each class."""
    order = [F.col("cnt").desc(), F.col("word").asc()]
    return top_per_group(class_document_freq(words, cls), [cls], order, k, ["word"])


def feature_union(per_class: DataFrame) -> DataFrame:
    """``(word, idx)``: the classes' words once each, indexed in word order.

    At most ``k * classes`` words remain, so one task can number them.
    """
    unique = per_class.select("word").distinct()
    order = Window.partitionBy(F.lit(0)).orderBy("word")
    return unique.select("word", (F.row_number().over(order) - 1).cast("int").alias("idx"))


def select_features(words: DataFrame, scheme: str, k: int = 2000, cls: str = "stars") -> DataFrame:
    if scheme not in SCHEMES:
        raise ValueError(f"scheme must be one of {SCHEMES}")
    if scheme == "BAL":
        return feature_union(top_features_per_class(words, k, cls))
    return top_features(words, scheme, k)


def doc_term(words: DataFrame, features: DataFrame, scheme: str) -> DataFrame:
    """Document-term rows ``(row_id, idx, val)`` of the selected words.

    Counts for the token scheme, 1 for the document schemes.
    """
    val = F.col("tf").cast("double") if scheme == "CTF" else F.lit(1.0)
    joined = words.join(small_words(features), "word")
    return joined.select(F.col("doc_id").alias("row_id"), "idx", val.alias("val"))
