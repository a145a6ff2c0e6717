import sys
from pathlib import Path

import pytest

pytest.importorskip("public_tokenizers")
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from rankloom.llm import bpe, plans  # noqa: E402

from .helpers import odd_rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_stages_follow_their_operators(spark):
    """Each stage's rows from the operator's own query on the stage's input, put together without the stages."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == columns, name
        left, ids = after.collect(), {r["doc_id"] for r in before.collect()}
        assert {r["doc_id"] for r in left} <= ids and len(left) > 0.5 * len(ids)
        before = spark.createDataFrame(left, docs.schema)
    final = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in final} == {r["doc_id"] for r in before.collect()}
    assert all(r["decoded_equal"] for r in final)
    ranks = plans.vocabulary_path("byte_bpe_50k.tiktoken")
    want = {r["doc_id"]: bytes(r["ids"]) for r in bpe.encode(before, ranks).collect()}
    assert {r["doc_id"]: bytes(r["ids"]) for r in final} == want


def test_odd_documents(spark, tmp_path):
    text = "the cat and the dog went to the old house by the river and they were glad of it all day long"
    rows = [(i, f"{text} in year {i} " + " ".join(f"w{i}x{j}" for j in range(40)), "en", "s", 1) for i in range(30)]
    rows += [(100, rows[3][1], "en", "s", 1), (100, rows[3][1], "en", "s", 1), (None, rows[4][1] + " null id", "en", "s", 1)]
    rows += [(i, t, lang, None, None) for i, t, lang in odd_rows()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(20)] + [(1001, 0, 0), (1004, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    benchmark = [(0, rows[7][1]), (1, None)]
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert ids >= set(range(30)) - {7} and not ids & {7, 100, 1000, 1001, 1002}
    assert None in ids


def test_encoder_gets_rows_in_small_batches(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, kept = spark.conf.get(name), corpus_pipeline.stash

    def stash(df, label):
        seen.append(int(spark.conf.get(name)))
        return kept(df, label)

    monkeypatch.setattr(corpus_pipeline, "stash", stash)
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'s' AS source", "1 AS n_chars")
    out = corpus_pipeline.encode(spark, docs, str(tmp_path))
    assert seen and max(seen) <= 1000 and spark.conf.get(name) == before
    assert out.count() == 3000 and out.filter("NOT decoded_equal").count() == 0


def test_stored_ids_take_little_more_than_the_texts(spark, tmp_path, monkeypatch):
    import random

    name, sizes = "spark.sql.parquet.compression.codec", []
    before, kept = spark.conf.get(name), corpus_pipeline.stash

    def stash(df, label):
        out = kept(df, label)
        sizes.append(sum(Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles()))
        return out

    monkeypatch.setattr(corpus_pipeline, "stash", stash)
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(draw.choices(words, k=300)), "en", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    out = corpus_pipeline.encode(spark, docs, str(tmp_path))
    assert out.count() == 400 and out.filter("NOT decoded_equal").count() == 0
    assert sum(sizes) < 1.6 * sum(len(r[1]) for r in rows)
    assert spark.conf.get(name) == before


def test_workers_drop_the_caches_of_other_operators():
    from rankloom.llm import common, quality

    parts = quality._parts(64)
    common.fresh_worker("rankloom.llm.quality")
    assert quality._parts(64) is parts
    common.fresh_worker("rankloom.llm.language")
    assert quality._parts(64) is not parts


def test_empty_tables(spark, tmp_path):
    for name, schema in (
        ("documents", "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", "doc_id long, quality int, toxic int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_leaks_with_null_and_repeated_ids(spark, tmp_path):
    leak = " ".join(f"leak{i}" for i in range(40))
    rows = [(None, leak, "en", "s", 1), (None, "a clean text", "en", "s", 1), (5, leak + " more", "en", "s", 1), (5, "another clean text", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.drop_benchmark_passages(spark, docs.union(docs.limit(0)), str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("5", "another clean text"), ("None", "a clean text")]
    odd = spark.createDataFrame([(6, None, "en", "s", 1), (None, None, "en", "s", 1)], docs.schema)
    assert corpus_pipeline.drop_benchmark_passages(spark, odd, str(tmp_path)).count() == 2


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_repeated_ids_lose_no_text(spark, tmp_path):
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    rows = [(1, a), (5, a), (5, b), (9, b), (7, c), (7, c), (7, c + " more"), (None, a), (8, None), (8, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    got = sorted((str(r["doc_id"]), r["text"] or "-") for r in left)
    assert [g for g in got if g[0] != "7"] == sorted([("1", a), ("5", b), ("None", a), ("8", "-"), ("3", "-")])
    assert len([g for g in got if g[0] == "7"]) == 1  # c or its near copy


def test_nothing_is_left_behind(spark, tmp_path):
    from pyspark.sql import functions as F

    from rankloom.session import durable_dir, scratch

    text = "the cat and the dog went to the old house by the river and they were glad of it all day long"
    rows = [(i, f"{text} in year {i} " + " ".join(f"w{i}x{j}" for j in range(40)), "en", "s", 1) for i in range(20)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, rows[7][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    place = spark._jvm.org.apache.hadoop.fs.Path(durable_dir(spark) + "/rankloom")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def names():
        return {s.getPath().getName() for s in files.listStatus(place)} if files.exists(place) else set()

    before = names()
    with scratch(spark):
        assert corpus_pipeline.run(spark, str(tmp_path)).filter(F.col("doc_id") == 3).count() == 1
        assert len(names() - before) == 1
    for name in ("op3_language_mixture", "op7_minhash_join", "op8_benchmark_windows", "op9_document_quality", "op10_token_counts", "op12_merkle_manifest"):
        before = names()
        out = plans.QUERIES[name](spark, str(tmp_path))
        assert out.count() >= 1 and len(names() - before) == 1, name
