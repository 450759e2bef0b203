"""Incremental ingest and URL de-duplication over a folder that receives page files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagelode.functions import markup, urls
from pagelode.sources.ingest import compact, insert_or_ignore

PAGES_SCHEMA = "page_id bigint, url string, html string"


def read_page_stream(spark: SparkSession, folder: str, files: str = "*.parquet", schema: str | StructType = PAGES_SCHEMA, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def read_table_stream(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """The files of table ``name`` in ``folder`` as a stream; the table is one file or, when it is larger, a folder of files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isDirectory():
        return read_page_stream(spark, f"{folder}/{name}.parquet", **options)
    return read_page_stream(spark, folder, f"{name}.parquet", **options)


def titled(pages: DataFrame) -> DataFrame:
    return pages.select(
        markup.element_text(F.col("html"), "h1").alias("title"), "page_id", "url"
    )


def ingest_pages(rows: DataFrame, table_path: str, checkpoint: str, compact_every: int = 64) -> None:
    """Process all files present and insert-or-ignore their rows by title. ``rows`` is a stream with ``page_id`` and ``title``, such as
    ``markup.page_rows`` of a page stream; all its columns are stored. Each micro-batch is one batch of the table; after a failure
    the same batch is written again in place. Every ``compact_every`` batches the table is compacted."""
    def insert(arrivals: DataFrame, batch: int) -> None:
        insert_or_ignore(arrivals, table_path, batch)
        if batch % compact_every == compact_every - 1:
            compact(arrivals.sparkSession, table_path, arrivals.schema)

    query = (
        rows.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def visited_urls(pages: DataFrame, watermark: str | None = None, time_column: str = "ts") -> DataFrame:
    """Each canonical URL once. The state holds one key per URL for ever, as the crawler's
    visited set does; with a watermark, repeats are only recognised within that time and state
    is dropped after it."""
    keyed = pages.withColumn("url", urls.canonical_url(F.col("url")))
    if watermark is None:
        return keyed.dropDuplicates(["url"])
    return keyed.withWatermark(time_column, watermark).dropDuplicatesWithinWatermark(["url"])


def write_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all pending rows of a stream to parquet and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
