import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.operators import embedding, vocabulary


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "text string").select(column.alias("x")).first().x


def test_review_tokens_delete_marks_before_stop_words(spark):
    stop = F.array(F.lit("at"), F.lit("don't"))
    got = one(spark, text.review_tokens(F.col("text"), stop), "Don't go (really) at 7pm!\tNow or NEVER")
    assert got == ["dont", "go", "really", "now", "or", "never"]


def test_clean_line_drops_brackets(spark):
    assert one(spark, text.clean_line(F.col("text")), "Don't go (really) at 7pm!") == "don t go at 7pm "
    assert one(spark, text.word_tokens(F.col("text")), "Don't go (really) at 7pm!") == ["don", "t", "go", "at", "7pm"]


def test_sentences_and_plain_split(spark):
    assert one(spark, text.sentences(F.col("text")), "One. Two?! Three") == ["One", "Two", "Three"]
    assert one(spark, text.lower_split(F.col("text")), " A b\n C ") == ["a", "b", "c"]


def test_token_windows_and_padding(spark):
    words = F.split("text", " ")
    assert one(spark, text.token_windows(words, 3), "a b c d") == ["a b c", "b c d"]
    assert one(spark, text.token_windows(words, 3), "a b") == []
    assert one(spark, text.pad(F.array(F.lit(7), F.lit(8)), 4), "") == [7, 8, 1, 1]
    assert one(spark, text.pad(F.array(F.lit(7), F.lit(8), F.lit(9)), 2), "") == [7, 8]


def docs(spark):
    rows = [(1, "a a a b", 1), (2, "b c", 1), (3, "c c d", 2), (4, "", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, stars int")


def words(spark):
    rows = vocabulary.token_rows(docs(spark), text.word_tokens(F.col("text")), "stars")
    return vocabulary.document_words(rows, "stars")


def test_feature_schemes(spark):
    def chosen(scheme, k):
        return {r.word: r.idx for r in vocabulary.select_features(words(spark), scheme, k).collect()}

    assert chosen("CTF", 2) == {"a": 0, "c": 1}  # three tokens each, in word order
    assert chosen("DF", 2) == {"b": 0, "c": 1}  # two documents each, in word order
    assert chosen("BAL", 1) == {"b": 0, "c": 1}  # best word of each class, in word order
    with pytest.raises(ValueError):
        chosen("X", 1)


def test_document_terms_count_or_mark(spark):
    for scheme, value in (("CTF", 3.0), ("DF", 1.0)):
        features = vocabulary.select_features(words(spark), "CTF", 1)
        rows = vocabulary.doc_term(words(spark), features, scheme).collect()
        assert [(r.row_id, r.idx, r.val) for r in rows] == [(1, 0, value)]


def test_vocabulary_and_codes(spark):
    tokens = vocabulary.token_rows(docs(spark), text.word_tokens(F.col("text")))
    vocab = vocabulary.build_vocab(vocabulary.word_count(tokens), min_freq=2, size=3)
    assert {r.word: r.idx for r in vocab.collect()} == {"<unk>": 0, "<pad>": 1, "a": 2, "c": 3, "b": 4}
    coded = vocabulary.encode_pad(tokens, docs(spark), vocab, 3)
    assert {r.doc_id: r.codes for r in coded.collect()} == {1: [2, 2, 2], 2: [4, 3, 1], 3: [3, 3, 0], 4: [1, 1, 1]}


def test_ngrams(spark):
    got = vocabulary.ngram_counts(docs(spark), text.word_tokens(F.col("text")), (2,)).collect()
    assert {r.gram: (r.docs, r.cnt) for r in got} == {
        "a a": (1, 2), "a b": (1, 1), "b c": (1, 1), "c c": (1, 1), "c d": (1, 1)
    }


def test_embedding_table_and_pools(spark):
    tokens = vocabulary.token_rows(docs(spark), text.word_tokens(F.col("text")))
    vocab = vocabulary.build_vocab(vocabulary.word_count(tokens), min_freq=1)
    vectors = spark.createDataFrame([("a", [1.0, -1.0]), ("b", [3.0, 5.0])], "word string, v array<double>")
    table = embedding.embedding_table(vocab, vectors, 2)
    got = {r.word: r.v for r in table.collect()}
    assert got["<pad>"] == [0.0, 0.0] and got["c"] == [0.0, 0.0] and got["a"] == [1.0, -1.0]
    assert all(abs(x) <= 0.05 for x in got["<unk>"])
    known = {r.word for r in embedding.embedding_table(vocab, vectors, 2, "skip").collect()}
    assert known == {"<unk>", "<pad>", "a", "b"}
    pools = {r.doc_id: (r["mean"], r.peak) for r in embedding.pooled_documents(words(spark), table, 2).collect()}
    assert pools[1] == ([1.5, 0.5], [3.0, 5.0]) and pools[2] == ([1.5, 2.5], [3.0, 5.0]) and 4 not in pools


def test_classifier_separates_clear_classes(spark):
    rows = [(i, [float(i % 2), 1.0], [float(i % 2), 0.0]) for i in range(20)]
    pooled = spark.createDataFrame(rows, "doc_id long, mean array<double>, peak array<double>")
    labels = spark.createDataFrame([(i, i % 2, "train" if i < 12 else "valid") for i in range(20)], "doc_id long, label int, split string")
    fit = embedding.text_classify(pooled, labels)
    assert fit.predictions.filter("label <> prediction").count() == 0
    assert fit.predictions.filter("p_true <= 0.5").count() == 0
    losses = [r.loss for r in fit.trace.filter("split = 'train'").orderBy("epoch").collect()]
    assert len(losses) == 20 and all(b < a for a, b in zip(losses, losses[1:]))


def test_classifier_steps_by_hand(spark):
    rng = np.random.default_rng(4)
    mean, peak = rng.normal(size=(30, 2)), rng.normal(size=(30, 2))
    y = (mean[:, 0] + 0.5 * rng.normal(size=30) > 0).astype(int)
    split = np.array(["train", "train", "valid", "test", "train"] * 6)
    pooled = spark.createDataFrame([(i, mean[i].tolist(), peak[i].tolist()) for i in range(30)], "doc_id long, mean array<double>, peak array<double>")
    rows = [(i, int(y[i]), str(split[i])) for i in range(30)] + [(99, 1, "train")]  # the last one has no vector
    fit = embedding.text_classify(pooled, spark.createDataFrame(rows, "doc_id long, label int, split string"), epochs=6, reg=0.1, learning_rate=3.0)
    x = np.hstack([mean, peak, np.ones((30, 1))])
    w, on, weights, want = np.zeros(5), split == "train", [], {}
    for epoch in range(1, 7):
        p = 1 / (1 + np.exp(-x[on] @ w))
        w = w - 3.0 * (x[on].T @ (p - y[on]) / on.sum() + 0.1 * w * [1, 1, 1, 1, 0])
        weights.append(w)
        p_true = np.where(y == 1, 1 / (1 + np.exp(-x @ w)), 1 - 1 / (1 + np.exp(-x @ w)))
        for s in ("train", "valid", "test"):
            own = split == s
            want[epoch, s] = (own.sum(), -np.log(p_true[own]).mean(), ((x[own] @ w > 0) == (y[own] == 1)).mean())
    got = {(r.epoch, r.split): (r.rows, r.loss, r.accuracy) for r in fit.trace.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    best = weights[int(np.argmin([want[e, "valid"][1] for e in range(1, 7)]))]
    for r in fit.predictions.collect():
        chance = 1 / (1 + np.exp(-x[r.doc_id] @ best))
        assert abs(r.p_true - (chance if r.label else 1 - chance)) < 1e-9 and r.prediction == (chance > 0.5)
    assert fit.predictions.count() == 30


def test_word2vec_keeps_frequent_words(spark):
    rows = [(i, ["red", "blue", "green", f"rare{i}"]) for i in range(6)]
    docs_table = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    got = {r.word: len(r.v) for r in embedding.word2vec_train(docs_table, dim=5, min_count=3).collect()}
    assert got == {"red": 5, "blue": 5, "green": 5}
