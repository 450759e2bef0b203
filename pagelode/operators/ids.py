"""Dense document ids and the title dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.session import materialise


def assign_doc_ids(df: DataFrame, order_by: str = "title", out: str = "id") -> DataFrame:
    """Number rows 0..n-1 in order of ``order_by`` (unique values) without a global window.

    Rows are range-partitioned, sorted, and numbered within their partition; only the row count
    of each partition is cumulated. The numbered rows are written first, so the counts and the rows
    they apply to come from the same partitioning."""
    ranged = df.repartitionByRange(order_by).sortWithinPartitions(order_by)
    # Partition number in the upper bits, row number within the partition in the lower 33.
    place = ranged.withColumn("__place", F.monotonically_increasing_id())
    numbered = materialise(
        place.withColumn("__part", F.shiftright("__place", 33))
        .withColumn("__row", F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__place"),
        "ids",
    )
    counts = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per range partition: a table of partition counts, not of data.
    running = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__start"))
    return (
        numbered.join(F.broadcast(starts), "__part")
        .withColumn(out, F.col("__start") + F.col("__row"))
        .drop("__part", "__row", "__start")
    )


def first_per_key(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """One row for each key: that of the smallest ``arrival``; of rows that tie in it, the one with the smallest
    hash of all columns, and of rows alike in all columns one. Winners are found by a partial
    aggregation and matched back by key, arrival and hash, so a key with very many copies never gathers its
    rows in one task; the copies that are still there are dropped by a partial aggregation too."""
    tagged = df.withColumn("__tag", F.xxhash64(*df.columns))
    best = tagged.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(F.col(arrival).alias("a"), "__tag")).alias("__best"))
    same = F.col(key).eqNullSafe(F.col("__key")) & F.col(arrival).eqNullSafe(F.col("__best.a")) & (F.col("__tag") == F.col("__best.__tag"))
    return tagged.join(best, same, "left_semi").dropDuplicates([key]).drop("__tag")


def title_dictionary(pages: DataFrame) -> DataFrame:
    return pages.select("title", "id")
