"""Table scans and the corpora made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import markup, text as tx
from pagelode.operators.joins import spread_join

TITLE_TOKENS = 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def scan_jdbc(
    spark: SparkSession, url: str, name: str, split_column: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """A table behind JDBC, read in parallel ranges of a numeric column. The driver is given by
    the session's classpath and ``options``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    return reader.options(
        partitionColumn=split_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
    ).load()


def corpus_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as a corpus: the first tokens are the title, the whole text the content,
    language and source the categories."""
    title = F.array_join(tx.first_tokens(F.col("text"), TITLE_TOKENS), " ")
    return table(spark, folder, "documents").select(
        "doc_id", title.alias("title"), F.col("text").alias("content"), F.array("lang", "source").alias("categories")
    )


def corpus_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``pages`` as a corpus: heading, article text, navigation items as categories."""
    html = F.col("html")
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("doc_id"),
        markup.element_text(html, "h1").alias("title"),
        markup.element_body(html, "article").alias("content"),
        markup.list_items(html, "nav").alias("categories"),
    )


def page_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Link graph of ``pages``: a navigation link leads to the smallest page whose heading
    holds the linked word; ``src, dst``, distinct."""
    pages = table(spark, folder, "pages")
    dictionary = (
        pages.select(
            F.col("page_id"), F.explode(tx.tokens(F.lower(markup.element_text(F.col("html"), "h1")))).alias("word")
        )
        .groupBy("word")
        .agg(F.min("page_id").alias("dst"))
    )
    words = F.transform(markup.hrefs(F.col("html"), "nav"), lambda h: F.lower(F.regexp_extract(h, "^/(.*)$", 1)))
    found = pages.select(F.col("page_id").alias("src"), F.explode(F.array_distinct(words)).alias("word"))
    return spread_join(found, dictionary, ["word"], [F.col("src")]).select("src", "dst").distinct()
