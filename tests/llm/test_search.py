import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.llm import search

from .helpers import ODD_TEXTS, ascii_words

SCHEMA = "conv_id long, turn long, role string, text string, query string, shard string, i0 string, word string"


def turns(spark, rows):
    return spark.createDataFrame([(c, t, "r", x, "q", "s", "i", "w") for c, t, x in rows], SCHEMA)


def brute(rows, queries, k):
    docs = [(c, t, Counter(ascii_words(x))) for c, t, x in rows if c is not None and t is not None]
    size = len(docs)
    mean = sum(sum(w.values()) for *_, w in docs) / size
    df = Counter(w for *_, words in docs for w in words)
    idf = {w: math.log1p((size - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = []
    for qc, qt, x in queries:
        found = []
        for c, t, words in docs:
            length = sum(words.values())
            score = sum(
                n * idf[w] * words[w] * 2.2 / (words[w] + 1.2 * (0.25 + 0.75 * length / mean))
                for w, n in Counter(ascii_words(x)).items()
                if w in words
            )
            if any(w in words for w in ascii_words(x)):
                found.append((-round(score, 6), c, t))
        out += [(qc, qt, r + 1, c, t, -s) for r, (s, c, t) in enumerate(sorted(found)[:k])]
    return sorted(out)


def check(got, want):
    got = sorted(tuple(r) for r in got)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=2e-6)


@pytest.mark.parametrize("shard_rows", [37, 10_000])
def test_exact_against_brute_force(spark, shard_rows):
    draw = random.Random(4)
    common, rare = ["the", "of", "and", "in", "is"], [f"w{i}" for i in range(400)]
    rows = []
    for i in range(260):
        words = draw.choices(common, k=draw.randint(2, 30)) + draw.choices(rare, k=draw.randint(0, 12))
        draw.shuffle(words)
        rows.append((i // 4, i % 4, " ".join(words)))
    rows += [(300 + i, 0, "the same common turn") for i in range(50)]  # many ties
    rows += [(400 + i, 0, t) for i, t in enumerate(ODD_TEXTS)] + [(None, 0, "the of"), (1, None, "the of")]
    df = turns(spark, rows)
    asked = F.col("conv_id") % 20 == 0
    got = search.bm25_top_k(df, df.filter(asked), k=10, shard_rows=shard_rows).collect()
    queries = [(c, t, x) for c, t, x in rows if c is not None and t is not None and c % 20 == 0]
    check(got, brute(rows, queries, 10))


def test_repeated_rows_and_queries(spark):
    rows = [(20, 0, "a b"), (20, 0, "a b"), (1, 0, "a"), (2, 0, "c")]
    df = turns(spark, rows)
    got = search.bm25_top_k(df, df.filter("conv_id = 20"), k=3).collect()
    assert [(r["conv_id"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(20, 1), (20, 2), (1, 3)]


def test_empty_tables(spark):
    none, one = turns(spark, []), turns(spark, [(20, 0, "a b")])
    assert search.bm25_top_k(none, none).count() == 0
    assert search.bm25_top_k(one, none).count() == 0
    assert search.bm25_top_k(none, one).count() == 0


def test_pruning_leaves_blocks_out():
    """Blocks without a query's telling word are not scored for it."""
    texts = ["the of and " * 3 + (f"rare{i % 5} rare{i % 5}" if i < 40 else "") for i in range(5000)]
    index = search.ShardIndex(texts, 9)
    (places, scores), (nothing, _) = index.search([[(b"rare1", 9.0), (b"the", 0.1), (b"of", 0.1)], [(b"unknown", 1.0)]], 5)
    assert len(places) >= 5 and set(places.tolist()) <= {i for i in range(40) if i % 5 == 1} and not len(nothing)
    assert 0 < index.scored < 3 < index.blocks
