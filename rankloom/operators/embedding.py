"""Word vectors, pooled documents and the sentiment classifier on top."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.order import start_value
from rankloom.operators import rowblocks
from rankloom.operators.cbow import cbow_train
from rankloom.operators.vocabulary import PADDING, UNKNOWN, small_words
from rankloom.session import cleaned, durable, loop_partitions

MOST_SPLITS = 16


def word2vec_train(
    docs: DataFrame,
    tokens: str = "tokens",
    dim: int = 100,
    window: int = 5,
    min_count: int = 3,
    seed: int = 0,
    passes: int = 5,
    rows_per_task: int = 50_000,
    method: str = "cbow",
    key: str = "doc_id",
) -> DataFrame:
    """``(word, v)`` of all words of at least ``min_count`` tokens.

    ``method='cbow'`` predicts a word from the mean of those around it, see
    :func:`cbow.cbow_train`. ``'skipgram'`` is Spark's Word2Vec: the documents are shared
    out over tasks of about ``rows_per_task`` rows, and after each of the ``passes`` the
    tasks' changes are added up.
    """
    if method not in ("cbow", "skipgram"):
        raise ValueError("method must be cbow or skipgram")
    if method == "cbow":
        return cbow_train(docs, tokens, key, dim, window, min_count, seed, passes).vectors
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    trainer = Word2Vec(
        vectorSize=dim, windowSize=window, minCount=min_count, seed=seed, maxIter=passes,
        numPartitions=loop_partitions(docs.sparkSession, docs.count(), rows_per_task),
        inputCol=tokens, outputCol="_pooled",
    )
    vectors = trainer.fit(docs.select(tokens)).getVectors()
    return vectors.select("word", vector_to_array("vector").alias("v"))


def vector_join(vocab: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Vocabulary with vectors; a word without one gets zeros."""
    blank = F.array_repeat(F.lit(0.0), dim)
    found = vocab.join(vectors.select("word", "v"), "word", "left")
    return found.select(*vocab.columns, F.coalesce("v", blank).alias("v"))


def embedding_table(vocab: DataFrame, vectors: DataFrame, dim: int, missing: str = "zeros") -> DataFrame:
    """``(word, idx, v)`` for a vocabulary with its special words.

    The unknown word gets small reproducible values within 0.05 of zero, the
    padding word zeros. ``missing='skip'`` leaves out words without a vector.
    """
    if missing not in ("zeros", "skip"):
        raise ValueError("missing must be zeros or skip")
    small = F.array(*[(start_value(F.lit(0), i) - 0.5) * 0.1 for i in range(dim)])
    table = vector_join(vocab.select("word", "idx"), vectors, dim)
    if missing == "skip":
        special = F.col("word").isin(UNKNOWN, PADDING)
        known = vectors.select("word").distinct()
        table = table.filter(special).unionByName(table.filter(~special).join(known, "word", "left_semi"))
    return table.select("word", "idx", F.when(F.col("word") == UNKNOWN, small).otherwise(F.col("v")).alias("v"))


def pooled_documents(words: DataFrame, table: DataFrame, dim: int) -> DataFrame:
    """``(doc_id, mean, peak)``: mean and element-wise maximum of a document's word vectors.

    ``words`` is ``(doc_id, word, tf)``; each distinct word is read once and
    weighted by its count, and both pools are partial aggregates. A table of few
    enough words is broadcast, so a frequent word is no key of a shuffle.
    """
    spread = words.join(small_words(table.select("word", "v")), "word").select(
        "doc_id", "tf", *[F.col("v")[i].alias(f"e{i}") for i in range(dim)]
    )
    sums = [F.sum(F.col("tf") * F.col(f"e{i}")).alias(f"s{i}") for i in range(dim)]
    peaks = [F.max(f"e{i}").alias(f"x{i}") for i in range(dim)]
    pooled = spread.groupBy("doc_id").agg(F.sum("tf").alias("n"), *sums, *peaks)
    return pooled.select(
        "doc_id",
        F.array(*[F.col(f"s{i}") / F.col("n") for i in range(dim)]).alias("mean"),
        F.array(*[F.col(f"x{i}") for i in range(dim)]).alias("peak"),
    )


@dataclass
class TextFit:
    """Predictions for all documents, and ``(epoch, split, rows, loss, accuracy)`` after each epoch."""

    predictions: DataFrame
    trace: DataFrame


@cleaned
def text_classify(
    pooled: DataFrame, labels: DataFrame, epochs: int = 20, reg: float = 0.01, learning_rate: float | None = None
) -> TextFit:
    """Logistic regression on pooled vectors, measured on every split after every epoch.

    ``labels`` is ``(doc_id, label, split)`` with label 0 or 1; only rows of the ``train``
    split are fitted. An epoch is one step against the gradient of the mean cross entropy
    plus ``reg / 2`` times the squared weights but the bias, by default as long as the
    bound on its curvature allows, so the loss never rises. Rows stay in blocks and a
    step reads each split once. Predictions are those of the epoch of least loss on the
    split ``valid`` (the first of equal ones), or of the last epoch if there is none; they
    hold the true class's probability, ready for accuracy and cross entropy. Documents
    that only one of the tables has are left out.
    """
    x = F.concat("mean", "peak", F.array(F.lit(1.0)))  # the last feature is the bias
    data = durable(pooled.join(labels, "doc_id").select("doc_id", "split", F.col("label").cast("int").alias("label"), x.alias("x")))
    spark = data.sparkSession
    widths = data.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if widths[0] != widths[1]:
        raise ValueError("pooled vectors must have one length")
    size = widths[0] or 1
    held = {}
    for split in sorted(r["split"] for r in data.select("split").distinct().limit(MOST_SPLITS + 1).collect()):
        rows = data.filter(F.col("split") == split)
        cells = rows.select(F.col("doc_id").alias("row_id"), F.posexplode("x").alias("idx", "val"))
        held[split] = rowblocks.build(cells, rows.select(F.col("doc_id").alias("row_id"), F.col("label").alias("y")), np.arange(size))
    if len(held) > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits")
    train = held.get("train")
    if train is None:
        raise ValueError("there is no row of the split 'train'")
    free = np.append(np.full(size - 1, reg), 0.0)  # no penalty on the bias
    if learning_rate is None:
        squares = train.total(lambda rows: np.array([(rows.val**2).sum()]), 1)[0]
        learning_rate = 1.0 / (squares / train.rows / 4 + reg)

    def measured(blocks: rowblocks.RowBlocks, w: np.ndarray) -> tuple[np.ndarray, float, float]:
        """Gradient of the mean cross entropy, the mean itself and the accuracy, in one pass."""

        def part(rows: rowblocks.Rows) -> np.ndarray:
            margin = rows.dot(w)
            signed = np.where(rows.y == 1, margin, -margin)
            loss, hits = np.logaddexp(0.0, -signed).sum(), ((margin > 0) == (rows.y == 1)).sum()
            return np.concatenate([rows.back(1 / (1 + np.exp(-np.clip(margin, -700, 700))) - rows.y), [loss, hits]])

        sums = blocks.total(part, size + 2) / blocks.rows
        return sums[:-2], float(sums[-2]), float(sums[-1])

    w = best = np.zeros(size)
    slope, least, trace = measured(train, w)[0], np.inf, []
    for epoch in range(1, epochs + 1):
        w = w - learning_rate * (slope + free * w)
        for split, blocks in held.items():
            change, loss, accuracy = measured(blocks, w)
            trace.append((epoch, split, blocks.rows, loss, accuracy))
            if split == "train":
                slope = change
            if split == "valid" and loss < least:
                best, least = w, loss
    if "valid" not in held:
        best = w
    for blocks in held.values():
        blocks.close()
    products = F.zip_with("x", F.array(*[F.lit(float(v)) for v in best]), lambda a, b: a * b)
    chance = 1 / (1 + F.exp(-F.aggregate(products, F.lit(0.0), lambda a, b: a + b)))
    predictions = data.withColumn("_chance", chance).select(
        "doc_id", "split", "label", (F.col("_chance") > 0.5).cast("int").alias("prediction"),
        F.when(F.col("label") == 1, F.col("_chance")).otherwise(1 - F.col("_chance")).alias("p_true"),
    )
    return TextFit(durable(predictions), durable(spark.createDataFrame(trace, "epoch int, split string, rows long, loss double, accuracy double")))
