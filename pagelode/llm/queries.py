"""The training-data operators as named queries over the standard tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import (
    bpe_tree,
    collisions,
    divergence,
    dual_tree,
    host_rules,
    merkle,
    mixing,
    ngram_join,
    paragraphs,
    pii,
    separators,
    substring_repeats,
    url_filter,
)
from pagelode.llm.common import documents, tokenizer_path
from pagelode.llm.oracle import oracle_sql
from pagelode.session import materialise

__all__ = ["oracle_sql", "queries"]


def op1_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Fixity audit of a replica of ``pages``. The replica is made from the table: in pages 7, 57, 107 and so on
    the last byte is changed, and pages 5, 102, 199 and so on are gone; files are the hosts' first
    letters. Every page is hashed, in both. A record's copy travels in its own row until both are laid out, so that a copy lies where its
    original lay, whatever is null or repeated; damage does not move the others."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    html = F.coalesce("html", F.lit(""))
    copy = F.when(F.col("page_id") % 50 == 7, F.concat(F.expr("left(coalesce(html, ''), length(html) - 1)"), F.lit("~"))).otherwise(html)
    pages = pages.select(
        F.substring(F.md5("url"), 1, 1).alias("file"),
        "page_id",
        "url",
        "html",
        F.sha2(copy.cast("binary"), 256).alias("copied"),
        (F.octet_length(copy) + merkle.HEADER).cast("bigint").alias("copied_length"),
        F.coalesce(F.col("page_id") % 97 == 5, F.lit(False)).alias("gone"),
    )
    order = ["page_id", "url", "copied", "copied_length", "gone"]
    records = merkle.laid_out(pages, "file", order, "html", header=merkle.HEADER)
    replica = records.where("NOT gone").select("file", "offset", F.col("copied_length").alias("length"), F.col("copied").alias("digest"))
    found = merkle.audit(records.select("file", "offset", "length", "digest"), materialise(replica, "replica"))
    return found.select("file", F.col("offset").alias("record_offset"), F.col("length").alias("n_bytes"), "digest", "status")


def op2_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe_tree.encode_documents(documents(spark, folder).select("doc_id", "text"), tokenizer_path())
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_substring_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_repeats.remove_repeats(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(documents(spark, folder))


def op5_separators(spark: SparkSession, folder: str) -> DataFrame:
    blocks = separators.write_token_files(documents(spark, folder), tokenizer_path())
    return separators.document_lengths(blocks)


def op6_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = host_rules.quality_by_host(documents(spark, folder).select("doc_id", "text", "source"))
    return found.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op8_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.remove_near_paragraphs(documents(spark, folder).select("doc_id", "text"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, folder).select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[number(k) for k in pii.KINDS], F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("found").alias("spans")
    )


def op10_collisions(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return collisions.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op11_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = dual_tree.compress(spark.read.parquet(f"{folder}/embeddings.parquet"))
    found = dual_tree.with_label_error(codes).withColumn("codebooks_sha256", F.lit(dual_tree.codebooks_sha256(books)))
    return found.select(F.col("key").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(documents(spark, folder))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{folder}/pages.parquet"), ["page_id"])


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_merkle, op2_bpe_tree, op3_substring_repeats, op4_ngram_join, op5_separators, op6_host_rules, op7_mixing]
    return {f.__name__: f for f in [*named, op8_paragraphs, op9_pii, op10_collisions, op11_dual_tree, op12_divergence, op13_url_filter, pipeline]}
