"""The registered queries of the text operators and, where SQL has them, their SQL.

Each query applies one operator with its production parameters to the whole of
the given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import (
    bpe, classlm, decontaminate, language, licences, merkle, neardup, quality, search, tokencount, urls, warc, whiten,
)
from rankloom.llm.common import id_remainder, table
from rankloom.session import scratch, stash


@dataclass(frozen=True)
class TextQuery:
    """A query; its result is stored, and all that was stored on the way to it is deleted, unless ``build`` sees to that."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    tidy: bool = False

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        if self.tidy:
            return self.build(spark, folder)
        with scratch(spark) as own:
            return own.keep(self.build(spark, folder))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.page_captures(table(spark, folder, "pages"))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return warc.resolve_revisits(captures).withColumn("headers", F.array_join(F.array_sort(lines), "\n"))


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = vocabulary_path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(table(spark, folder, "documents"), ranks), ranks)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    model = language.train(documents.filter(~held_out).select("text", "lang"))
    return language.predict(documents, model, keep=(held_out,))


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages")).drop("ratio")


def brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 1, F.lit(False))
    fold = F.coalesce((id_remainder("doc_id", 10) >= 5).cast("long"), F.lit(0))
    training = documents.filter(~held_out).select(F.coalesce("text", F.lit("")).alias("text"), fold.alias("fold"))
    counts = stash(classlm.word_counts(training), "lm-counts")
    model = classlm.train(training, counts)
    scored = classlm.score(documents, model, counts)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def bm25_wand(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return search.bm25_top_k(turns, turns.filter(F.col("conv_id") % 20 == 0))


def minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def benchmark_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """Fitted on labelled documents that are not held out."""
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    marked = labels.filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    return quality.train(documents, marked)


def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality_model(documents, table(spark, folder, "labels"))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    scored = quality.score(documents, model, keep=(held_out,))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokencount.count_tokens(table(spark, folder, "documents"), vocabulary_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whiten(table(spark, folder, "embeddings"))


def _manifest_digests(documents: DataFrame) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    changed = [F.try_add("n_chars", F.lit(1)) if f == "n_chars" else F.col(f) for f in fields]
    whole = merkle.digest_of([F.col(f) for f in fields])
    claim = F.when(id_remainder("doc_id", 7) == 0, merkle.digest_of(changed)).otherwise(whole)
    found = merkle.manifest(documents, fields, claim=claim)
    root = merkle.folded(F.col("claim"), F.col("sides"), F.col("siblings"))
    proofs = found.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), root.alias("folded_root"))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _manifest_digests(table(spark, folder, "documents"))


def licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first").alias("first_word"),
        F.array_max("places.first").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("places.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


QUERIES: dict[str, TextQuery] = {
    "op1_warc_revisits": TextQuery(warc_revisits, warc.page_captures_sql()),
    "op2_byte_bpe": TextQuery(byte_bpe),
    "op3_language_mixture": TextQuery(language_mixture),
    "op4_url_filter": TextQuery(url_filter, urls.judge_sql()),
    "op5_brown_lm": TextQuery(brown_lm),
    "op6_bm25_wand": TextQuery(bm25_wand, search.conversation_search_sql()),
    "op7_minhash_join": TextQuery(minhash_join),
    "op8_benchmark_windows": TextQuery(benchmark_windows),
    "op9_document_quality": TextQuery(document_quality),
    "op10_token_counts": TextQuery(token_counts),
    "op11_polarised_whitening": TextQuery(whitened_embeddings, tidy=True),
    "op12_merkle_manifest": TextQuery(merkle_manifest, merkle.manifest_sql()),
    "op13_licence_templates": TextQuery(licence_scan, licences.scan_sql()),
}
