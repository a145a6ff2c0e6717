"""Queries on text: cleaning, counts, vocabularies, features and word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.functions.numeric import star_class
from rankloom.operators import cbow, embedding, layout, metrics, vocabulary
from rankloom.plans.oracle import words as sql
from rankloom.plans.registry import Query, rounded, saved
from rankloom.plans.views import DIM, Views

PAD, BATCH = 1000, 64


def review_tokens(v: Views) -> DataFrame:
    """Tokens of all reviews without stop words."""
    rows = vocabulary.token_rows(v.reviews(), text.review_tokens(F.col("text")), "stars", "split")
    return vocabulary.stopword_anti(rows, v.stopwords())


def review_words(v: Views) -> DataFrame:
    return saved(v, "review-words", lambda: vocabulary.document_words(review_tokens(v), "stars", "split"))


def train_words(v: Views) -> DataFrame:
    return review_words(v).filter("split = 'train'")


def selected(v: Views, scheme: str) -> DataFrame:
    return saved(v, f"features-{scheme}", lambda: vocabulary.select_features(train_words(v), scheme))


def doc_term(v: Views, scheme: str) -> DataFrame:
    return vocabulary.doc_term(review_words(v), selected(v, scheme), scheme)


def line_tokens(v: Views) -> DataFrame:
    return vocabulary.token_rows(v.binary_text(), text.word_tokens(F.col("text")), "y")


def line_words(v: Views) -> DataFrame:
    return vocabulary.document_words(line_tokens(v))


def vocab(v: Views) -> DataFrame:
    return saved(v, "vocab", lambda: vocabulary.build_vocab(vocabulary.word_count(line_tokens(v))))


def vectors(v: Views) -> DataFrame:
    """Vectors for the words whose place in the vocabulary is a vector id."""
    rows = v.dense_rows().select((F.col("row_id") + 2).alias("idx"), "v")
    return vocab(v).join(rows, "idx").select("word", "v")


def table(v: Views) -> DataFrame:
    return embedding.embedding_table(vocab(v), vectors(v), DIM)


def _vector_text(df: DataFrame, *cols: str) -> DataFrame:
    """Vectors as text with six decimals, comparable between engines."""
    keep = [c for c in df.columns if c not in cols]
    parts = [
        F.array_join(F.transform(c, lambda x: F.floor(x * 1e6 + 0.5).cast("string")), " ").alias(c) for c in cols
    ]
    return df.select(*keep, *parts)


def _codes(v: Views) -> DataFrame:
    coded = vocabulary.encode_pad(line_tokens(v), v.binary_text(), vocab(v), PAD)
    return coded.select("doc_id", F.array_join(F.col("codes").cast("array<string>"), " ").alias("codes"))


def classified(v: Views) -> embedding.TextFit:
    labels = layout.hash_split(v.binary_text().select("doc_id", (F.col("y") > 0).cast("int").alias("label")), "doc_id")
    pooled = embedding.pooled_documents(line_words(v), table(v), DIM)
    return embedding.text_classify(pooled, labels)


def _quality(v: Views) -> DataFrame:
    """Loss and accuracy of the text classifier per split, by the epoch of least loss on ``valid``."""
    guess = classified(v).predictions
    return rounded(
        guess.groupBy("split").agg(
            F.count(F.lit(1)).alias("rows"),
            (F.sum(-F.ln("p_true")) / F.count(F.lit(1))).alias("loss"),
            F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        ),
        7,
    )


def _token_lists(v: Views) -> DataFrame:
    return v.binary_text().select("doc_id", text.word_tokens(F.col("text")).alias("tokens"))


def _word2vec(v: Views) -> DataFrame:
    return saved(v, "word-vectors", lambda: embedding.word2vec_train(_token_lists(v)))


def _skipped(v: Views) -> DataFrame:
    return _vector_text(embedding.embedding_table(vocab(v), vectors(v), DIM, missing="skip"), "v")


QUERIES: dict[str, Query] = {
    "tokenize_review": Query(
        lambda v: v.reviews().select("doc_id", F.array_join(text.review_tokens(F.col("text")), " ").alias("tokens")),
        sql.TOKENIZE,
    ),
    "clean_line": Query(
        lambda v: v.documents().select("doc_id", text.clean_line(F.col("text")).alias("clean")), sql.CLEAN_LINE
    ),
    "word_tokens": Query(
        lambda v: v.documents().select(
            "doc_id", F.array_join(text.word_tokens(F.col("text")), " ").alias("words")
        ),
        sql.WORD_TOKENS,
    ),
    "sentence_split": Query(
        lambda v: v.documents().select("doc_id", F.array_join(text.sentences(F.col("text")), " | ").alias("sentences")),
        sql.SENTENCES,
    ),
    "lower_split": Query(
        lambda v: v.documents().select("doc_id", F.array_join(text.lower_split(F.col("text")), " ").alias("t")),
        sql.LOWER_SPLIT,
    ),
    "unique_tokens": Query(
        lambda v: v.reviews().select(
            "doc_id",
            F.array_join(F.array_sort(F.array_distinct(text.review_tokens(F.col("text")))), " ").alias("words"),
        ),
        sql.UNIQUE,
    ),
    "label_to_class": Query(lambda v: v.reviews().select("doc_id", star_class(F.col("stars")).alias("cls")), sql.CLASSES),
    "stopword_anti": Query(lambda v: vocabulary.document_words(review_tokens(v)), sql.DOC_WORDS),
    "word_count": Query(lambda v: vocabulary.word_count(line_tokens(v)), sql.WORD_COUNT),
    "collection_tf": Query(
        lambda v: train_words(v).groupBy("word").agg(F.sum("tf").alias("cnt")), sql.COLLECTION_TF
    ),
    "document_freq": Query(lambda v: vocabulary.document_freq(train_words(v)), sql.DOCUMENT_FREQ),
    "class_document_freq": Query(lambda v: vocabulary.class_document_freq(train_words(v)), sql.CLASS_FREQ),
    "term_count": Query(lambda v: review_words(v).select("doc_id", "word", "tf"), sql.DOC_WORDS),
    "term_binary": Query(lambda v: review_words(v).select("doc_id", "word", F.lit(1).alias("tf")), sql.TERM_BINARY),
    "top_vocab": Query(lambda v: vocabulary.top_vocab(vocabulary.word_count(line_tokens(v))), sql.TOP_VOCAB),
    "build_vocab": Query(vocab, sql.BUILD_VOCAB),
    "top_features": Query(lambda v: selected(v, "CTF"), sql.features("CTF")),
    "top_features_df": Query(lambda v: selected(v, "DF"), sql.features("DF")),
    "top_features_per_class": Query(
        lambda v: vocabulary.top_features_per_class(train_words(v)).withColumn("rank", F.col("rank").cast("long")),
        sql.TOP_PER_CLASS,
    ),
    "feature_union": Query(lambda v: selected(v, "BAL"), sql.features("BAL")),
    "features_ctf": Query(lambda v: doc_term(v, "CTF"), sql.doc_term("CTF")),
    "features_df": Query(lambda v: doc_term(v, "DF"), sql.doc_term("DF")),
    "features_bal": Query(lambda v: doc_term(v, "BAL"), sql.doc_term("BAL")),
    "encode_pad": Query(_codes, sql.encode(PAD)),
    "length_bucket_batches": Query(
        lambda v: layout.length_batches(v.binary_text(), "doc_id", F.size(text.word_tokens(F.col("text"))), BATCH),
        sql.length_batches(BATCH),
    ),
    "ngram_windows": Query(
        lambda v: vocabulary.ngram_counts(v.binary_text(), text.word_tokens(F.col("text"))), sql.NGRAMS
    ),
    "holdout_sample": Query(
        lambda v: layout.holdout_sample(
            v.reviews().filter("split = 'train'").select("doc_id", "stars"), "doc_id", 0.3, 7
        ),
        sql.HOLDOUT,
    ),
    "train_valid_split": Query(
        lambda v: layout.hash_split(v.binary_text().select("doc_id", "y"), "doc_id", 0.2, 7), sql.SPLIT
    ),
    "dataset_sizes": Query(lambda v: metrics.dataset_sizes(v.reviews(), "split", BATCH), sql.sizes(BATCH)),
    "vector_join": Query(
        lambda v: _vector_text(embedding.vector_join(vocab(v).select("word", "idx"), vectors(v), DIM), "v"), sql.VECTOR_JOIN
    ),
    "embedding_table": Query(lambda v: _vector_text(table(v), "v"), sql.EMBEDDING),
    "embedding_table_skip": Query(_skipped, sql.EMBEDDING_SKIP),
    "pooled_documents": Query(
        lambda v: _vector_text(embedding.pooled_documents(line_words(v), table(v), DIM), "mean", "peak"), sql.POOLED
    ),
    "text_classify": Query(_quality, sql.classifier("quality")),
    "text_classify_predictions": Query(lambda v: rounded(classified(v).predictions, 7), sql.classifier("predictions")),
    "text_classify_trace": Query(lambda v: rounded(classified(v).trace, 7), sql.classifier("trace")),
    "word2vec_train": Query(_word2vec),
    "word2vec_loss": Query(lambda v: rounded(cbow.cbow_train(_token_lists(v)).trace, 6)),
    "word2vec_skipgram": Query(lambda v: embedding.word2vec_train(_token_lists(v), method="skipgram")),
    "word2vec_words": Query(lambda v: _word2vec(v).select("word"), sql.W2V_WORDS),
}
