import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.llm import decontaminate

from .helpers import ODD_TEXTS, documents


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def shingles(w):
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows, items, least=0.8):
    """Best window of every start, for every document and item."""
    items = {i: words(t) for i, t in items if words(t)}
    df = Counter(g for w in {tuple(w) for w in items.values()} for g in shingles(list(w)))
    out = {}
    for doc, text, _ in rows:
        w = words(text)
        for item, own in items.items():
            want = shingles(own)
            mean = sum(1 / df[g] for g in want) / len(want)
            weight = lambda g, mean=mean: 1 / df[g] if g in df else mean
            for start in range(max(len(w) - len(own), 0) + 1):
                part = w[start : start + len(own)]
                size = min(5, len(own))
                have = {tuple(part[i : i + size]) for i in range(len(part) - size + 1)}
                both = sum(map(weight, have & want))
                if both:
                    value = round(both / (sum(map(weight, have)) + sum(map(weight, want)) - both), 9)
                    if value >= least and value > out.get((doc, item), (0,))[0]:
                        out[doc, item] = (value, start)
    return out


@pytest.fixture(scope="module")
def case():
    draw = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([12, 20, 20, 35, 50])))) for i in range(15)]
    items += [(90, "tiny item"), (91, None), (92, ""), (93, items[2][1]), (94, "Two words here now")]
    rows = []
    for i in range(80):
        text = draw.choices(vocabulary, k=draw.randint(0, 60))
        if i % 2:
            copy = words(items[i % 15][1])
            for _ in range(draw.choice([0, 0, 1, 2, 5])):
                place = draw.randrange(len(copy))
                change = draw.choice(["swap", "add", "cut"])
                copy[place : place + (change != "add")] = [] if change == "cut" else [draw.choice(vocabulary)]
            at = draw.randint(0, len(text))
            text[at:at] = copy
        rows.append((i, " ".join(text), "en"))
    rows += [(200, "a tiny item b", "en"), (201, "TINY\nITEM", "en"), (202, "two words  here now", "en"), (300, " ".join(words(items[3][1])[:-1]), "en")]
    rows += [(400 + i, t, "en") for i, t in enumerate(ODD_TEXTS)]
    return rows, items


def test_all_similar_windows_are_found(spark, case):
    rows, items = case
    benchmark = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc_id string, weight string")
    out = decontaminate.contaminated(documents(spark, rows), benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in out}
    want = brute(rows, items)
    assert len(out) == len(got) and set(got) == set(want)
    assert {k: v[0] for k, v in got.items()} == pytest.approx({k: v[0] for k, v in want.items()}, abs=1e-6)
    assert any(v < 1 for v, _ in got.values()) and len(got) > 20


def test_blocks_find_every_print_within_the_radius(spark):
    draw = random.Random(2)
    base = draw.getrandbits(64)
    rows = []
    for distance in range(0, decontaminate.RADIUS + 1):
        value = base
        for bit in draw.sample(range(64), distance):
            value ^= 1 << bit
        rows.append((distance, value - (1 << 64) if value >> 63 else value))
    own = base - (1 << 64) if base >> 63 else base
    df = spark.createDataFrame(rows, "d int, other long").withColumn("own", F.lit(own))
    near = [
        F.bit_count(decontaminate._block(F.col("own"), F.lit(b)).bitwiseXOR(decontaminate._block(F.col("other"), F.lit(b))))
        for b in range(decontaminate.BLOCKS)
    ]
    got = df.select("d", F.least(*near).alias("m"), F.bit_count(F.col("own").bitwiseXOR(F.col("other"))).alias("h")).collect()
    assert all(r["h"] == r["d"] and r["m"] <= decontaminate.RADIUS // decontaminate.BLOCKS for r in got)


def test_repeated_rows_null_ids_and_empty_tables(spark, case):
    rows, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    text = items[4][1]
    df = documents(spark, [(1, text, ""), (1, text, ""), (None, "x " + text, ""), (1, "other words", "")])
    got = sorted((str(r["doc_id"]), r["item_id"], r["similarity"]) for r in decontaminate.contaminated(df, benchmark).collect())
    assert got == [("1", 4, 1.0), ("None", 4, 1.0)]
    nothing = documents(spark, [])
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    empty = decontaminate.contaminated(df, benchmark.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "item_id", "start", "words", "similarity"]


def test_plan_has_no_python(spark, case):
    rows, items = case
    found = decontaminate.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_reordered_passages_are_found(spark):
    """An item with its halves exchanged: the similar window starts far from where a shingle in its place would put it."""
    a, b = [f"a{i}" for i in range(24)], [f"b{i}" for i in range(24)]
    items = [(1, " ".join(a + b)), (2, " ".join(f"c{i}" for i in range(30)))]
    filler = [f"f{i}" for i in range(80)]
    rows = [(1, " ".join(filler + b + a + filler), "en"), (2, " ".join(b + a + filler), "en"), (3, " ".join(filler + b + a), "en")]
    out = decontaminate.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), copy="hash").collect()
    want = brute(rows, items)
    assert len(want) == 3 and {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in out} == want
    assert all(isinstance(r["hash"], int) for r in out)


def test_copies_of_an_item_do_not_hide_its_near_copies(spark):
    words_of_item = [f"a{i}" for i in range(59)]
    edited = words_of_item[:]
    edited[20] = "other"
    for copies in (1, 2, 10):
        items = [(i, " ".join(words_of_item)) for i in range(copies)] + [(99, " ".join(f"c{i}" for i in range(59)))]
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        out = decontaminate.contaminated(documents(spark, [(1, " ".join(["x"] * 9 + edited), "en")]), benchmark).collect()
        assert sorted((r["item_id"], r["similarity"], r["start"]) for r in out) == [(i, round(50 / 60, 9), 9) for i in range(copies)]


def test_templated_items(spark):
    """Items that differ in a few words: edited copies are found as the exact weights say, shared wording weighing less."""
    draw = random.Random(8)
    frame = [f"t{i}" for i in range(50)]
    items = []
    for i in range(10):
        own = frame[:]
        own[10:14] = [f"own{i}x{k}" for k in range(4)]
        items.append((i, " ".join(own)))
    items.append((50, " ".join(f"alone{i}" for i in range(50))))
    rows = []
    for i in range(60):
        copy = words(items[i % 10][1])
        for place in draw.sample([*range(9), *range(20, 50)], draw.choice([1, 1, 2])):
            copy[place] = f"new{i}"
        rows.append((i, " ".join([f"f{i}"] * 5 + copy + ["end"] * 5), "en"))
    out = decontaminate.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in out}
    want = {k: v[0] for k, v in brute(rows, items).items()}
    assert all(want[k] == pytest.approx(v, abs=1e-6) for k, v in got.items())
    found = sum(k in got for k in want) / len(want)
    assert len(want) > 30 and found >= 0.99, found
    assert {d for d, _ in got} == {d for d, _ in want}
