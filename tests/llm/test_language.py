import math
import random

import numpy as np
import pytest

from rankloom.llm import language

from .helpers import documents, odd_rows

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "und", "ein", "ver"], "cc": ["eau", "que", "oi", "ment"]}


def text_of(lang, words, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text_of(lang, 60, i), lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    return language.train(documents(spark, [*rows, (900, None, "aa"), (901, "katomi", None), (902, "123 456", "aa")]))


def test_predicts_single_languages_and_mixtures(spark, model):
    rows = [(i, text_of(lang, 40, 500 + i), lang) for i, lang in enumerate(list(SYLLABLES) * 10)]
    mixed = text_of("aa", 60, 1) + " " + text_of("bb", 30, 2)
    out = {r["doc_id"]: r for r in language.predict(documents(spark, [*rows, (99, mixed, None)]), model).collect()}
    assert all(out[i]["lang_pred"] == lang and out[i]["languages"] == [lang] for i, _, lang in rows)
    both = out[99]
    assert both["languages"] == ["aa", "bb"] and both["lang_pred"] == "aa"
    assert 0.4 < both["score"] < 0.9 and math.isclose(sum(both["shares"]), 1, abs_tol=1e-9)


def test_odd_rows(spark, model):
    rows = odd_rows()
    out = language.predict(documents(spark, rows), model).collect()
    assert len(out) == len(rows)
    blank = {None, "", " ", "\n\n", "\x00"}
    texts = {i: t for i, t, _ in rows}
    for r in out:
        assert (r["lang_pred"] == "und") == (texts[r["doc_id"]] in blank)
        assert 0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang_pred"] == "und")


def test_without_training_rows_all_is_unknown(spark):
    nothing = language.train(documents(spark, []))
    assert nothing.languages == []
    assert {r["lang_pred"] for r in language.predict(documents(spark, odd_rows()), nothing).collect()} == {"und"}
    assert language.predict(documents(spark, []), nothing).count() == 0


def test_trigrams_by_hand():
    owner, bucket = language.trigrams(["Ab, c1", "", "ab"], 1 << 20)
    assert owner.tolist() == [0, 0, 0, 2, 2]
    again = language.trigrams(["x", "ab  c"], 1 << 20)
    assert bucket[:3].tolist() == again[1][1:].tolist()  # other characters count as one space
    assert bucket[0] == bucket[3] and bucket[1] == bucket[4]


def test_em_raises_the_likelihood(model):
    texts = [text_of("aa", 20, 7) + " " + text_of("cc", 20, 8)]
    owner, bucket = language.trigrams(texts, model.buckets)
    key, weight = np.unique(bucket, return_counts=True)
    likelihood = model.probabilities[:, key].T.astype(float)
    first, zero = np.array([0]), np.zeros(len(key), int)
    values = [
        language._proportions(likelihood, weight.astype(float), first, zero, np.ones((1, 3)), rounds)[1][0] for rounds in range(6)
    ]
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:]))
    # the best proportions of a fine grid are not better than those of many rounds
    share, best = language._proportions(likelihood, weight.astype(float), first, zero, np.ones((1, 3)), 200)
    grid = [(a / 50, b / 50, 1 - a / 50 - b / 50) for a in range(51) for b in range(51 - a)]
    assert max(float(weight @ np.log(np.maximum(likelihood @ np.array(g), 1e-300))) for g in grid) <= best[0] + 1e-6


MANY = {f"l{i}": [f"{a}{b}{c}" for c in "xyz"] for i, (a, b) in enumerate(["ka", "to", "mi", "ru", "se", "po", "gu"])}


def test_a_text_of_more_than_four_languages(spark):
    """Only the penalty bounds the set."""
    draw = random.Random(3)

    def of(lang, count):
        return " ".join("".join(draw.choices(MANY[lang], k=3)) for _ in range(count))

    model = language.train(documents(spark, [(i, of(lang, 60), lang) for i, lang in enumerate(list(MANY) * 10)]))
    six = list(MANY)[:6]
    rows = [(1, " ".join(of(lang, 40) for lang in six), None), (2, of("l6", 30), None)]
    out = {r["doc_id"]: r for r in language.predict(documents(spark, rows), model).collect()}
    assert sorted(out[1]["languages"]) == six and all(0.1 < s < 0.25 for s in out[1]["shares"])
    assert out[2]["languages"] == ["l6"]


def brute_set(text, model, penalty=1.0):
    """The best penalised set of all sets of languages, by long EM, with the shares in it."""
    from itertools import combinations

    owner, bucket = language.trigrams([text], model.buckets)
    key, weight = np.unique(bucket, return_counts=True)
    likelihood, weight = model.probabilities[:, key].T.astype(float), weight.astype(float)
    best = (-math.inf, None, None)
    for size in range(1, len(model.languages) + 1):
        for chosen in combinations(range(len(model.languages)), size):
            share = np.zeros(len(model.languages))
            share[list(chosen)] = 1 / size
            for _ in range(400):
                mixed = likelihood * share
                share = (mixed * (weight / mixed.sum(axis=1))[:, None]).sum(axis=0) / weight.sum()
            value = float(weight @ np.log(likelihood @ share)) - penalty * size * math.log(max(weight.sum(), 2))
            if value > best[0]:
                best = (value, [model.languages[i] for i in chosen], share)
    return best


def test_sets_and_shares_by_brute_force(spark, model):
    parts = [("aa",), ("bb",), ("cc",), ("aa", "bb"), ("bb", "cc"), ("aa", "bb", "cc")]
    rows = [(i, " ".join(text_of(lang, 50 + 10 * k, 40 + i + k) for k, lang in enumerate(langs)), None) for i, langs in enumerate(parts)]
    for r in language.predict(documents(spark, rows), model).collect():
        _, names, share = brute_set(rows[r["doc_id"]][1], model)
        assert sorted(r["languages"]) == names
        assert r["lang_pred"] == model.languages[int(share.argmax())]
        assert r["score"] == pytest.approx(share.max(), abs=0.02)


def test_equal_shares_go_to_the_smaller_name():
    same = np.full((2, 64), 1 / 64, np.float32)
    model = language.LanguageModel(["a", "b"], same, 64)
    share = language.mixtures(["some text"], model, 12, 1.0)
    assert share.argmax(axis=1).tolist() == [0]
