import random

import pytest

from rankloom.llm import neardup, words

from .helpers import Union, ascii_words, documents, odd_rows


def shingles(text, size):
    w = ascii_words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size):
    sets = {}
    for i, t, _ in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, size))
    union = Union(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= 80 * len(x | y):
                        union.join(a, b)
    return union


def some_rows():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []

    def add(text):
        rows.append((len(rows) + 1, text, "en"))

    for _ in range(30):
        add(" ".join(draw.choices(vocabulary, k=draw.randint(5, 200))))
    for base in range(6):  # chains of copies with a few words changed each time
        words_of = draw.choices(vocabulary, k=120)
        for _ in range(25):
            add(" ".join(words_of))
            for _ in range(draw.choice([1, 1, 2, 4])):
                words_of[draw.randrange(len(words_of))] = draw.choice(vocabulary)
    shared = " ".join(draw.choices(vocabulary, k=60))
    for _ in range(40):  # a passage that makes half to most of many texts
        add(shared + " " + " ".join(draw.choices(vocabulary, k=draw.randint(4, 70))))
    for _ in range(30):
        add(shared.upper())
    draw.shuffle(rows)
    return [*rows, *odd_rows()]


@pytest.mark.parametrize("size,block", [(4, 1024), (5, 4)])
def test_components_by_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = some_rows()
    out = neardup.near_duplicates(documents(spark, rows), words=size).collect()
    union = brute(rows, size)
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == union.find(r["doc_id"]), r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = {i: {len(shingles(t, size)) for j, t, _ in rows if j == i} for i, *_ in rows}
    assert all(r["n_shingles"] in sizes[r["doc_id"]] for r in out)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(301, 300), (300, 301), (5, 5)]
    got = {r["node"]: r["component"] for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 130), 100), 300: 300, 301: 300}


def test_threshold_is_exact(spark):
    """20 of 25 shingles in common are enough, 19 of 25 are not."""
    base = [f"a{i}" for i in range(25)]
    rows = [(1, " ".join(base[:25]), ""), (2, " ".join(base[:23] + ["x"]), ""), (10, " ".join(f"b{i}" for i in range(24)), "")]
    rows.append((11, " ".join([f"b{i}" for i in range(22)] + ["x", "y", "z"]), ""))
    union = brute(rows, 4)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: union.find(i) for i, *_ in rows}


def test_empty_table(spark):
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_shingle_hashes_tell_sets_apart():
    texts = ["A b c d e", "a  b\tc\nd e", "a b c", "a b  c ", "c b a", "", None or " ", "é É", "É É"]
    sets = [tuple(s.tolist()) for s in words.shingle_sets(texts, 4)]
    assert sets[0] == sets[1] and len(sets[0]) == 2 and sets[2] == sets[3] != sets[4]
    assert sets[5] == sets[6] == () and sets[7] != sets[8]


def test_repeated_ids_are_told_apart_by_their_texts(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(30)) for k in "ab")
    rows = [(1, a, ""), (5, a, ""), (5, b, ""), (9, b, ""), (9, b, ""), (None, a, "")]
    out = neardup.near_duplicates(documents(spark, rows), copy="hash").collect()
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in out)
    assert got == [("1", 1, True), ("5", 1, False), ("5", 5, True), ("9", 5, False), ("9", 5, False), ("None", None, True)]
    assert len({r["hash"] for r in out}) == 2
