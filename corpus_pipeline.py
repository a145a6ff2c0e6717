"""A training corpus from ``documents``: quality, language, near duplicates, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet and gives it to the next one. The first four return the
columns of ``documents`` for the documents they keep, the last one the encoded rows.
Null and empty texts are judged like any other text: the quality model scores them, and
the language stage rejects what has no letter. Rows with a null id are never duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import bpe, decontaminate, language, neardup, plans, quality
from rankloom.llm.common import broadcast_if_small, id_remainder, table
from rankloom.session import arrow_rows, dense_tables, scratch, stash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
QUALITY_FLOOR = 0.5
LANGUAGE_FLOOR = 0.5


def _others(docs: DataFrame) -> tuple:
    return tuple(F.col(c) for c in COLUMNS if c not in ("doc_id", "text"))


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives at least an even chance of being good."""
    model = plans.quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=_others(docs), keep_text=True)
    return scored.filter(F.col("score") >= QUALITY_FLOOR).select(*COLUMNS)


def filter_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents most of which is in one known language; those without a letter go."""
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    model = language.train(docs.filter(~held_out).select("text", "lang"))
    found = language.predict(docs, model, keep=_others(docs), keep_text=True)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_FLOOR)
    return found.filter(known).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar shingles of five words link, the one of the smallest id.

    Rows of one id are told apart by their texts, null and empty ones being the same; of
    repeated rows one stays. Rows with a null id all stay.
    """
    found = neardup.near_duplicates(docs, words=5, percent=80, copy="copy").filter("doc_id IS NOT NULL")
    # one row for each id and text, with its group: texts without words are groups of their own
    group = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    rows = found.groupBy("doc_id", "copy").agg(F.max(group).alias("group"), F.count(F.lit(1)).alias("n"))
    rows = stash(rows, "pipeline-groups")
    first = rows.filter("`group` IS NOT NULL").groupBy("group").agg(F.min(F.struct("doc_id", "copy")).alias("first"), F.count(F.lit(1)).alias("m"))
    first = first.filter("m > 1").select("group", "first.*")
    later = rows.join(first.select("group", F.struct("doc_id", "copy").alias("first")), "group")
    gone = stash(later.filter(F.struct("doc_id", "copy") != F.col("first")).select("doc_id", "copy"), "pipeline-copies")
    again = stash(rows.filter("n > 1").select("doc_id", "copy"), "pipeline-repeats")
    coded = docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"))
    left = coded.join(broadcast_if_small(gone, 4_000_000), ["doc_id", "copy"], "left_anti")
    once = left.join(broadcast_if_small(again, 4_000_000), ["doc_id", "copy"], "left_anti")
    repeated = left.join(broadcast_if_small(again, 4_000_000), ["doc_id", "copy"], "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "copy"])).select(*COLUMNS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is like a benchmark item; ids null or repeated are told apart by the text."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), copy="copy")
    gone = stash(found.select(F.col("doc_id").alias("leak"), "copy").distinct(), "pipeline-leaks")
    same = F.col("doc_id").eqNullSafe(F.col("leak")) & (F.xxhash64("text") == F.col("copy"))
    return docs.select(*COLUMNS).join(broadcast_if_small(gone, 4_000_000), same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded_equal): token ids, proven by decoding them.

    Ids and offsets take several times the texts' bytes, so rows go to Python in small
    batches, and ids are stored before they are decoded: a core has one Python task at a time.
    Four bytes a token and a place are mostly zeros or alike, so what is stored is packed well.
    """
    ranks = plans.vocabulary_path("byte_bpe_50k.tiktoken")
    digest = F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("digest")
    with scratch(spark) as own, arrow_rows(spark, 1_000), dense_tables(spark):
        coded = bpe.encode(docs, ranks, keep=(F.col("lang"), F.col("source"), digest), cache_entries=200_000)
        decoded = bpe.decode(stash(coded, "pipeline-ids"), ranks, keep=("lang", "source", "digest"))
        equal = (F.md5("decoded") == F.col("digest")).alias("decoded_equal")
        return own.keep(decoded.select("doc_id", "lang", "source", "n_tokens", "ids", equal))


STAGES = [
    ("quality classifier", filter_quality),
    ("language ID", filter_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("byte-level BPE", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, over the whole of ``documents``; what the stages store on the way is deleted."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as whole:
        for _, stage in STAGES[:-1]:
            with scratch(spark) as own:
                docs = own.keep(stage(spark, docs, sf_dir))
        with whole.outside():
            return STAGES[-1][1](spark, docs, sf_dir)
