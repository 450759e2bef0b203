"""The published search index: parquet tables clustered by term, and documents clustered by id.

Layout under one folder: ``postings`` (partitioned by field and term shard, sorted by term and document inside),
``term_stats`` (partitioned by shard, sorted by term), ``docs`` and ``content`` (ranges of document ids, sorted), ``ranks``, ``stats``, and
``meta``, one row that says how the index was made. Terms of a search and ids of a results page are literals of a pushed filter, so a
scan opens the folders of their shards and reads the row groups that hold them.

Title postings carry the link rank of their document. Every hit has one, so blending ranks in needs no rank table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators import postings as ps
from pagelode.operators.joins import LITERALS, estimated_bytes, one_of
from pagelode.session import materialise

POSTINGS_SCHEMA = "term string, doc_id bigint, tf int, positions array<int>, field_len int, rank double, field int, shard int"
META_SCHEMA = "n_shards int, stemmed boolean, fulltext boolean, n_docs bigint, max_rank double"
#: Bytes of a row group of postings and of page content: the grain of a lookup.
POSTING_GROUP, CONTENT_GROUP = 16 << 20, 8 << 20


@dataclass(frozen=True)
class SearchIndex:
    """Tables a search needs. ``meta`` has one row; its ``max_rank`` is null, and ``ranks`` None, where the index holds no link ranks."""

    postings: DataFrame
    term_stats: DataFrame
    stats: DataFrame
    docs: DataFrame
    content: DataFrame
    meta: DataFrame
    ranks: DataFrame | None = None
    n_shards: int = 1

    def with_ranks(self, ranks: DataFrame) -> "SearchIndex":
        """The index with link ranks joined on. Publishing with ranks stores them instead."""
        largest = self.meta.drop("max_rank").join(F.broadcast(ranks.agg(F.max("rank").alias("max_rank"))))
        return replace(self, postings=ranked_titles(self.postings.drop("rank"), ranks), meta=largest, ranks=ranks)


    def restricted(self, words: DataFrame) -> "SearchIndex":
        """The index as a search for ``words`` (a written table with ``term``) has to read it: with few words, these and their
        shards are literals in the filters of its scans."""
        asked = words.select("term", shard_of(F.col("term"), self.n_shards).alias("shard")).where("term IS NOT NULL")
        asked = asked.distinct().limit(LITERALS + 1).collect()
        if len(asked) > LITERALS:
            return self
        shards = F.col("shard").isin(sorted({r["shard"] for r in asked}) or [-1])
        kept = shards & one_of("term", sorted({r["term"] for r in asked}))
        return replace(self, postings=self.postings.where(kept), term_stats=self.term_stats.where(kept))


def shard_of(term: Column, n_shards: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(n_shards)).cast("int")


def default_shards(corpus: DataFrame) -> int:
    """One shard per 256 MiB of corpus, 4 at least."""
    return max(4, estimated_bytes(corpus) >> 28)


def ranked_titles(postings: DataFrame, ranks: DataFrame | None) -> DataFrame:
    """Add ``rank`` to title postings; it is null for other fields and unranked documents."""
    if ranks is None:
        return postings.withColumn("rank", F.lit(None).cast("double"))
    known = ranks.select(F.col("id").alias("doc_id"), F.col("rank"))
    titles = postings.where("field = 0").join(known, "doc_id", "left")
    return titles.unionByName(postings.where("field <> 0").withColumn("rank", F.lit(None).cast("double")))


def _meta(docs: DataFrame, ranks: DataFrame | None, shards: int, stem: bool, fulltext: bool) -> DataFrame:
    row = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    if ranks is None:
        row = row.withColumn("max_rank", F.lit(None).cast("double"))
    else:
        row = row.join(F.broadcast(ranks.agg(F.max("rank").alias("max_rank"))))
    made = (F.lit(shards).alias("n_shards"), F.lit(stem).alias("stemmed"), F.lit(fulltext).alias("fulltext"))
    return row.select(*made, "n_docs", "max_rank")


def build_index(corpus: DataFrame, stem: bool = True, fulltext: bool = False) -> SearchIndex:
    """An unpublished index: every table is a lazy DataFrame over ``corpus``."""
    postings = ps.build_postings(corpus, stem, fulltext).withColumn("shard", F.lit(0))
    docs = ps.with_lengths(corpus, fulltext)
    return SearchIndex(
        ranked_titles(postings, None),
        ps.doc_frequency(postings).withColumn("shard", F.lit(0)),
        ps.length_stats(docs, fulltext),
        docs.drop("content"),
        corpus.select("doc_id", "content"),
        _meta(corpus, None, 1, stem, fulltext),
    )


def publish_index(
    corpus: DataFrame, path: str, n_shards: int | None = None, stem: bool = True, fulltext: bool = False, ranks: DataFrame | None = None
) -> SearchIndex:
    """Build and write the index; returns it reading from ``path``. ``ranks`` is ``id, rank``.

    The rebalance hint lets adaptive execution split the shard of a very frequent term over
    several files and merge small shards."""
    spark = corpus.sparkSession
    shards = n_shards or default_shards(corpus)
    if ranks is not None:
        ranks.select("id", "rank").write.parquet(f"{path}/ranks")
        ranks = spark.read.parquet(f"{path}/ranks")
    # Titles are analysed apart only where ranks are joined to them, so that content is analysed once and never joined.
    parts = [ps.FIELDS] if ranks is None else [[0], [1, 2]]
    for fields in parts:
        postings = ps.build_postings(corpus, stem, fulltext, fields)
        (
            ranked_titles(postings, ranks if fields == [0] else None)
            .withColumn("shard", shard_of(F.col("term"), shards))
            .hint("rebalance", "field", "shard")
            .sortWithinPartitions("field", "shard", "term", "doc_id")
            .write.mode("errorifexists" if fields is parts[0] else "append")
            .option("parquet.block.size", POSTING_GROUP)
            .partitionBy("field", "shard")
            .parquet(f"{path}/postings")
        )
    written = spark.read.schema(POSTINGS_SCHEMA).parquet(f"{path}/postings")
    ps.doc_frequency(written, "shard").repartition("shard").sortWithinPartitions("shard", "term").write.partitionBy("shard").parquet(f"{path}/term_stats")
    # Lengths are stored with the documents; the averages are then read from that one column.
    # Written first: finding the ranges reads its rows a second time, and should not analyse every text again.
    docs = materialise(ps.with_lengths(corpus, fulltext).drop("content"), "docs")
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(f"{path}/docs")
    content = corpus.select("doc_id", "content").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    # A writer looks at the size of its row group every few rows; texts can be long, so from the first ones on.
    content.write.options(**{"parquet.block.size": CONTENT_GROUP, "parquet.page.size.row.check.min": 4}).parquet(f"{path}/content")
    docs = spark.read.parquet(f"{path}/docs")
    ps.length_stats(docs, fulltext).coalesce(1).write.parquet(f"{path}/stats")
    _meta(docs, ranks, shards, stem, fulltext).coalesce(1).write.parquet(f"{path}/meta")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index at ``path``; all there is to know of it is in its ``meta`` row."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    meta = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta")
    row = meta.first()
    return SearchIndex(
        spark.read.schema(POSTINGS_SCHEMA).parquet(f"{path}/postings"),
        spark.read.schema("term string, field int, df bigint, shard int").parquet(f"{path}/term_stats"),
        read("stats"),
        read("docs"),
        read("content"),
        meta,
        read("ranks") if row["max_rank"] is not None else None,
        row["n_shards"],
    )


def index_summary(index: SearchIndex) -> DataFrame:
    """``metric, n``: keywords, postings, documents and ranked pages. Term statistics have one
    row per (term, field), so distinct keywords are counted from them, not from postings."""
    def metric(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")

    out = metric(index.term_stats.select("term").distinct(), "keywords")
    out = out.unionByName(metric(index.postings.select("doc_id"), "postings"))
    out = out.unionByName(metric(index.docs.select("doc_id"), "documents"))
    if index.ranks is not None:
        out = out.unionByName(metric(index.ranks, "ranked_pages"))
    return out
