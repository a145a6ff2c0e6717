import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import classlm, plans
from rankloom.llm.words import hashes_and_endings
from rankloom.session import stash

from .helpers import ascii_words, documents, odd_rows


def corpus():
    a, b, c = ["red", "blue", "green"], ["cat", "dog", "cow"], ["runs", "sleeps", "eats"]
    rows = [(i, f"the {a[i % 3]} {b[i // 3 % 3]} {c[i // 9 % 3]} odd{i}", "en") for i in range(120)]
    return [*rows, *odd_rows()]


def fitted(spark, rows, endings=4, **parameters):
    df = documents(spark, rows).select(F.coalesce("text", F.lit("")).alias("text"), (F.length("lang") % 2).cast("long").alias("fold"))
    df = df.withColumn("fold", F.coalesce("fold", F.lit(0)))
    counts = stash(classlm.word_counts(df, endings), "test-counts")
    return classlm.train(df, counts, endings=endings, **parameters), counts


def units_and_counts(model, words):
    """(unit, training count) of each word and of the end of texts, one word at a time."""
    known = dict(zip(model.lexicon.keys.tolist(), model.lexicon.places.tolist()))
    out = {}
    for w in {*words}:
        key, _, last = hashes_and_endings([w.decode()], classlm.SUFFIX)
        out[w] = known.get(int(key.view(np.int64)[0]), len(known) + int(last[0]) % model.lexicon.endings)
    return {**out, classlm.END: model.lexicon.size - 1}


def tokens_of(text):
    return [*classlm.words_of(text or ""), classlm.END]


def test_query_base_scores_by_brute_force(spark, tmp_path):
    rows = corpus()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = plans.QUERIES["op5_brown_lm"](spark, str(tmp_path)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter()
    for i, t, _ in rows:
        if not held(i):
            c.update([*ascii_words(t), "\n"])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t, _ in rows:
        tokens = [*ascii_words(t), "\n"]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want.append((str(i), held(i), len(tokens), sum(c[w] > 0 for w in tokens), n, round(base, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out]
    assert sorted(got) == sorted(want)
    assert sum(r["score"] for r in out if r["held_out"]) > sum(r["base_score"] for r in out if r["held_out"])


def check_scores(spark, rows, model, counts, trained):
    n_of = Counter(w for _, t, _ in trained for w in tokens_of(t))
    assert Counter(n_of.values()) == Counter(r["n"] for r in counts.collect())
    units = units_and_counts(model, [w for _, t, _ in rows for w in classlm.words_of(t or "")])
    got = {}
    for r in classlm.score(documents(spark, rows), model, counts).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert Counter({i: len(r) for i, r in got.items()}) == Counter(i for i, _, _ in rows)
    for i, text, _ in rows:
        tokens = tokens_of(text)
        classes = [model.classes[units[w]] for w in [classlm.END, *tokens]]
        want = sum(math.log10(n_of[w] + 0.5) for w in tokens) + sum(model.log_g[a, b] for a, b in zip(classes, classes[1:]))
        found = [r for r in got[i] if r["n_tokens"] == len(tokens) and abs(r["score"] - want) < 1e-6]
        assert found, (i, text, want, got[i])
        assert found[0]["n_known"] == sum(n_of[w] > 0 for w in tokens)
        assert found[0]["perplexity"] == pytest.approx(10 ** (-want / len(tokens)), rel=1e-6)


def test_scores_by_the_formula(spark):
    rows = corpus()
    model, counts = fitted(spark, rows, classes=6, min_count=20)
    assert len(model.lexicon.keys) < 20
    other = [(5, "the red cat of another text", "en"), (5, "the red cat of another text", "en"), (3000, "new newer the", "en")]
    check_scores(spark, [*rows, *other], model, counts, rows)


def test_units_beyond_the_bound_share_their_endings(spark):
    rows = corpus()
    model, counts = fitted(spark, rows, classes=6, min_count=2, most_units=5)
    assert 0 < len(model.lexicon.keys) <= 5 and min(model.lexicon.counts) > 20
    check_scores(spark, rows, model, counts, rows)


def test_probabilities_add_up(spark):
    """After any class, known words and one unseen word of each class and of all have probability 1."""
    rows = corpus()
    model, _ = fitted(spark, rows, classes=6, min_count=20)
    n_of = Counter(w for _, t, _ in rows for w in tokens_of(t))
    units = units_and_counts(model, [w for w in n_of if w != classlm.END])
    sums = np.zeros((6, 6))
    for w, n in n_of.items():
        c = model.classes[units[w]]
        sums[:, c] += (n + 0.5) * 10 ** model.log_g[:, c]
    total = sums.sum(axis=1)
    # the rest is what unseen words have: half a count in each class, and half of one in the unigram model
    assert ((total > 0.85) & (total < 1)).all()


def test_neighbour_lists_by_brute_force(spark):
    """Flushes of few tokens and merges of two parts at a time give the same lists; the last text is longer than a flush."""
    rows = corpus()
    df = documents(spark, rows).select(F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("fold"))
    counts = stash(classlm.word_counts(df, 4), "test-counts")
    lexicon, _ = classlm.lexicon_of(counts, 4, 3, 1000)
    model = classlm.ClassModel(lexicon, None, None, 0, 0, 0)
    units = units_and_counts(model, [w for _, t, _ in rows for w in classlm.words_of(t or "")])
    want = Counter()
    for _, text, _ in rows:
        own = [units[w] for w in [classlm.END, *tokens_of(text)]]
        want.update((a, 0, b) for a, b in zip(own, own[1:]))
        want.update((b, 1, a) for a, b in zip(own, own[1:]) if a != b)
    tokens = sum(len(tokens_of(t)) for _, t, _ in rows)
    for flush, fan_in in ((2_500_000, 256), (300, 2)):
        got = Counter()
        blocks = classlm.neighbour_lists(df, lexicon, tokens, flush, fan_in).collect()
        assert len({r["block"] for r in blocks}) == len(blocks)
        for r in blocks:
            keys, n = classlm.unpack(r["data"], r["size"])
            assert (np.diff(keys) > 0).all()
            for k, m in zip(keys.tolist(), n.tolist()):
                got[k // lexicon.size // 2, k // lexicon.size % 2, k % lexicon.size] += m
        assert got == want


def test_exchange_raises_the_likelihood_to_planted_classes(spark):
    """Nouns and verbs of one ending are told apart by their contexts, no sweep lowers the likelihood."""
    draw = np.random.default_rng(4)
    some = lambda words: words[min(int(draw.exponential(len(words) / 3)), len(words) - 1)]
    nouns, verbs = [f"n{i}zzz" for i in range(20)], [f"v{i}zzz" for i in range(20)]
    rows = []
    for i in range(1500):
        a, b = (["the", "a", "this"], ["runs", "falls", "sleeps"]) if i % 5 < 3 else (["they", "we", "you"], ["it", "them", "us"])
        rows.append((i, f"{some(a)} {some(nouns if i % 5 < 3 else verbs)} {some(b)}", "en"))
    df = documents(spark, rows).select("text", F.lit(0).alias("fold"))
    counts = stash(classlm.word_counts(df, 4), "test-counts")
    lexicon, _ = classlm.lexicon_of(counts, 4, 5, 1000)
    lists = stash(classlm.neighbour_lists(df, lexicon, 6000), "test-lists")
    of, table, values = classlm.exchange(lists, lexicon.size, 12, 8)
    assert len(values) > 2 and all(b >= a for a, b in zip(values, values[1:]))
    assert (table == classlm.class_table(lists, of, 12)).all() and values[-1] == pytest.approx(classlm.likelihood(table))
    model = classlm.ClassModel(lexicon, of, None, 0, 0, 0)
    units = units_and_counts(model, [w for _, t, _ in rows for w in classlm.words_of(t)])
    nouns = {of[u] for w, u in units.items() if w.startswith(b"n")}
    verbs = {of[u] for w, u in units.items() if w.startswith(b"v")}
    assert nouns.isdisjoint(verbs), (nouns, verbs)
    assert of[-1] == 11 and (of[:-1] < 11).all()


def test_nothing_to_learn(spark):
    model, counts = fitted(spark, [])
    out = classlm.score(documents(spark, odd_rows()), model, counts).collect()
    assert len(out) == len(odd_rows()) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)
    assert classlm.score(documents(spark, []), model, counts).count() == 0


def test_best_classes_by_the_likelihood():
    draw = np.random.default_rng(3)
    size, classes = 30, 5
    counts = draw.integers(0, 6, (size, size)).astype(float) * (draw.random((size, size)) < 0.5)
    of = np.append(draw.integers(0, classes - 1, size - 1), classes - 1)

    def table(of):
        out = np.zeros((classes, classes))
        np.add.at(out, (of[:, None].repeat(size, 1), of[None].repeat(size, 0)), counts)
        return out

    units = np.arange(size - 1)
    loop = counts.diagonal()[:-1]
    right, left = np.zeros((size - 1, classes)), np.zeros((size - 1, classes))
    for unit in units:
        others = np.arange(size) != unit
        right[unit] = np.bincount(of[others], counts[unit, others], classes)
        left[unit] = np.bincount(of[others], counts[others, unit], classes)
    got = classlm.best_classes(table(of), of[:-1], right, left, loop)
    for unit in units:
        values = [classlm.likelihood(table(np.where(np.arange(size) == unit, c, of))) for c in range(classes - 1)]
        assert values[got[unit]] == pytest.approx(max(values))
