import random

import pytest

from .helpers import documents, odd_rows

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from rankloom.llm import prescan, tokencount  # noqa: E402

FILE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


def check(spark, library, rows, **parameters):
    out = tokencount.count_tokens(documents(spark, rows), FILE, **parameters).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in out)
    want = [(str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    assert got == sorted(want)


def test_counts_equal_the_library(spark, library):
    draw = random.Random(5)
    letters = " \n\t'stmdrvel're xX19.,!é漢  ٣😀\x00\r"
    rows = [(i, "".join(draw.choice(letters) for _ in range(draw.randint(0, 80))), "en") for i in range(500)]
    special = ["<|endoftext|>", "a  <|endoftext|> b<|endoftext|>", "<|endoftext", "x<|endoftext|><|endoftext|>  "]
    rows += [(600 + i, t, "en") for i, t in enumerate(special)]
    check(spark, library, [*rows, *odd_rows()])


def test_small_tiers_change_no_count(spark, library):
    rows = [(i, f"word{i} and the other word{i % 7} of a long{'er' * 9} kind", "en") for i in range(300)]
    check(spark, library, rows, table_size=3, cache_entries=2)


def test_frequent_pretokens_are_merged_by_a_tree(spark):
    """More tasks than one merge takes: the table is that of all texts counted at once, and no row of it is a pre-token."""
    rows = [(i, "the cat " + f"w{i % 9} " * (i % 9 + 1), "en") for i in range(400)]
    df = documents(spark, rows).repartition(40)
    content = tokencount.file_content(FILE)
    low, high, length, n = tokencount.frequent_pretokens(df, content, 5, per_task=1000)
    got = {(a.tobytes() + b.tobytes())[:k].decode(): int(c) for a, b, k, c in zip(low, high, length, n)}
    split = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    want = {}
    for _, t, _ in rows:
        for _, (a, b) in split.pre_tokenize_str(t):
            want[t[a:b]] = want.get(t[a:b], 0) + 1
    assert got == {k: want[k] for k in got} and sorted(got.values()) == sorted(want.values())[-5:]


def test_empty_table(spark):
    assert tokencount.count_tokens(documents(spark, []), FILE).count() == 0


def test_the_library_has_the_same_letters():
    """Every sixteenth code point by the library's own splitting, against the shared table."""
    table = prescan.library_symbols()
    split = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    points = [p for p in range(0x21, 0x110000, 16) if not 0xD800 <= p < 0xE000]
    for mark, kind in (("a", 2), ("1", 1), ("!", 0)):
        for point in points:
            joined = len(split.pre_tokenize_str(mark + chr(point))) == 1
            assert joined == (prescan._KIND[table[point]] == kind), hex(point)


def test_special_strings():
    assert tokencount._segments("a<x>b<x>", ("<x>",)) == (["a", "b", ""], 2)
