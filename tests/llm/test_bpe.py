import base64
import hashlib
import random
import struct

import pytest

from .helpers import documents, odd_rows

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from rankloom.llm import bpe, plans, prescan  # noqa: E402

RANKS = P.path("byte_bpe_50k.tiktoken")
LETTERS = " \n\t'stmdrvel're xX19.,!é漢  ٣😀\x00\r"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(count, seed=1):
    draw = random.Random(seed)
    mixed = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 60))) for _ in range(count)]
    return mixed + ["".join(draw.choice("theronansi") for _ in range(draw.randint(1, 80))) for _ in range(count)]


def test_encoding_equals_the_library(library):
    texts = [*random_texts(4000), "x" * 1000, "ab" * 5000, " " * 3000 + "x", "abc" * 21, "abc" * 22, ""]
    encoder = bpe.Encoder(bpe.Vocabulary(open(RANKS, "rb").read()), 1000)
    got = bpe.encode_texts(texts, encoder, prescan.library_symbols())
    assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in got] == [library.encode_ordinary(t) for t in texts]


def test_scan_composes_in_any_blocks():
    import numpy as np

    codes = np.random.default_rng(3).integers(0, 11, 5000).astype(np.uint8)
    state, slow = prescan.S_END, []
    for c in codes[::-1]:
        state = prescan._step(int(c), state)
        slow.append(state)
    assert prescan.following(codes).tolist() == slow[::-1]


def test_rows_and_round_trip(spark, library):
    rows = [*odd_rows(), *[(i, t, "en") for i, t in enumerate(random_texts(50, 2))]]
    df = documents(spark, rows)
    coded = bpe.encode(df, RANKS)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "starts"]
    out = bpe.decode(coded, RANKS).collect()
    assert len(out) == len(rows)

    def expected(i, text):
        ids = library.encode_ordinary(text or "")
        return (str(i), len(ids), struct.pack(f"<{len(ids)}I", *ids), (text or "").encode())

    got = sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in out)
    assert got == sorted(expected(i, t) for i, t, _ in rows)


def test_offsets_are_checked():
    import numpy as np

    vocabulary = bpe.Vocabulary(open(RANKS, "rb").read())
    with pytest.raises(ValueError):
        bpe.decode_ids(np.array([1, 2]), np.array([0, 5]), vocabulary)


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(documents(spark, []), RANKS), RANKS).count() == 0


def test_query_digests(spark, library, tmp_path):
    rows = odd_rows()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in plans.QUERIES["op2_byte_bpe"](spark, str(tmp_path)).collect()}
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
