import math
import random
from hashlib import sha256

import duckdb
import pytest

from rankloom.llm import merkle, plans

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string, pos long, size int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, add=0):
    i, source, lang, n, text = r
    return H(*map(field, (i, source, lang, None if n is None else n + add, text)))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def way(levels, at):
    for level in levels[:-1]:
        mate = at ^ 1
        yield (level[mate] if mate < len(level) else None, mate < at)
        at >>= 1


def brute(rows):
    import zlib

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for p, r in enumerate(groups[g]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            d, proof = leaf_of(r, int(hit)), []
            for mate, left in [*way(trees[g], p), *way(top, at)]:
                proof += [mate] if mate else []
                d = H(d) if mate is None else H(mate, d) if left else H(d, mate)
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[g][-1][0], root, H(*proof), d, d == root))
    return sorted(out, key=str)


def digests(spark, rows, monkeypatch=None, height=None):
    df = spark.createDataFrame([(*r, "t", "d", 1, 2) for r in rows], SCHEMA)
    if height:
        whole = merkle.manifest
        monkeypatch.setattr(merkle, "manifest", lambda *a, **k: whole(*a, **k, height=height))
    return sorted(map(tuple, plans._manifest_digests(df).collect()), key=str)


def rows_of(count, seed=0):
    draw = random.Random(seed)
    langs = [*["en"] * 12, "fr", "de", "", None, "漢", "Z"]
    rows = [(draw.randrange(10 * count), draw.choice(["a", None, ""]), draw.choice(langs), draw.choice([None, 1, 7]), draw.choice([None, "", "x", "ü 漢" * i])) for i in range(count)]
    return rows + rows[:9] + rows[:4] + [(None, None, None, None, None), (None, "s", "en", 3, "t"), (None, None, None, None, None), (7, "s", "only", 3, "long " * 20000)]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_by_brute_force(spark, monkeypatch, height):
    rows = rows_of(150)
    assert digests(spark, rows, monkeypatch, height) == brute(rows)


def test_small_tables(spark):
    assert digests(spark, []) == []
    for count in (1, 2, 3):
        rows = [(i, "s", "en", 5, "t") for i in range(count)]
        assert digests(spark, rows) == brute(rows)


def test_many_groups(spark, monkeypatch):
    rows = [(i, "s", f"g{i % 23}", 5, "t") for i in range(90)]
    assert digests(spark, rows, monkeypatch, 2) == brute(rows)


def test_sweeps_in_one_block():
    for count in range(1, 20):
        leaves = [H(str(i)) for i in range(count)]
        levels = tree(leaves)
        root, inbox = merkle.sweep(leaves, (count - 1).bit_length())
        assert root == levels[-1][0]
        for at, (sides, siblings) in enumerate(merkle.suffixes(count, math.ceil(math.log2(count)), inbox, "", "")):
            want = list(way(levels, at))
            assert sides == "".join("-" if m is None else "l" if left else "r" for m, left in want)
            assert siblings == "".join(m for m, _ in want if m)


def test_sql_is_the_same(spark, tmp_path):
    rows = sorted({r[0]: r for r in rows_of(60, 4) if r[0] is not None}.values())
    names = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duck.execute(merkle.manifest_sql()).fetchall(), key=str) == brute(rows)
