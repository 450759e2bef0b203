"""Insert-or-ignore into a page table stored as parquet folders.

A table is a list of batches, each dealt to buckets by a hash of the key: ``batch=<n>/bucket=<k>``. What a batch has to be compared with lies
in the buckets of its own keys, so a small batch reads a small part of a large table, and only its key column. ``compact`` merges
the batches so far into one folder ``base=<n>`` with the same buckets; it stands for all batches up to n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pagelode.operators.ids import first_per_key

#: Buckets of a table; fixed for its life.
BUCKETS = 256


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def new_pages(arrivals: DataFrame, existing: DataFrame | None, key: str = "title", arrival: str = "page_id") -> DataFrame:
    """Rows to insert: the first arrival of each key that the table does not hold yet."""
    winners = first_per_key(arrivals, key, arrival)
    if existing is None:
        return winners
    return winners.join(existing.select(key), key, "left_anti")


def _write(rows: DataFrame, folder: str, key: str) -> None:
    rows.withColumn("bucket", bucket_of(key)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)


def insert_or_ignore(
    arrivals: DataFrame, path: str, batch: int, key: str = "title", arrival: str = "page_id"
) -> int:
    """Write the new rows as ``batch=<n>`` of the table at ``path`` and return their count. Of the table, only the buckets
    that the batch's keys fall in are read. Writing a batch again replaces it and nothing else, so a retried batch is
    harmless."""
    spark = arrivals.sparkSession
    existing = _read(spark, path, arrivals.schema, before=batch)
    if existing is not None:
        hit = [r[0] for r in arrivals.select(bucket_of(key)).distinct().collect()]  # at most BUCKETS numbers
        existing = existing.where(F.col("bucket").isin(hit or [-1]))
    written = Observation()
    rows = new_pages(arrivals, existing, key, arrival).observe(written, F.count(F.lit(1)).alias("n"))
    _write(rows, f"{path}/batch={batch}", key)
    return written.get["n"]


def _folders(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished folders ``kind=<n>`` at ``path``, through the file system Spark itself uses."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    done = lambda name: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS"))
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=") and done(n))


def batches(spark: SparkSession, path: str) -> list[int]:
    return _folders(spark, path, "batch")


def _read(spark: SparkSession, path: str, schema: str | StructType, before: int | None = None) -> DataFrame | None:
    """The rows with their ``bucket``: of the newest base and the batches after it, all under number ``before``."""
    bases = _folders(spark, path, "base")
    base = bases[-1] if bases else None
    found = [f"{path}/base={base}"] if base is not None else []
    found += [f"{path}/batch={b}" for b in batches(spark, path) if (before is None or b < before) and (base is None or b > base)]
    if not found:
        return None
    own = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bucket = StructType([*own.fields, StructField("bucket", IntegerType())])
    # Every folder is a table of its own, partitioned by bucket.
    read = lambda folder: spark.read.schema(with_bucket).option("basePath", folder).parquet(folder)
    rows = read(found[0])
    for folder in found[1:]:
        rows = rows.unionByName(read(folder))
    return rows


def read_table(spark: SparkSession, path: str, schema: str | StructType, before: int | None = None) -> DataFrame | None:
    rows = _read(spark, path, schema, before)
    return None if rows is None else rows.drop("bucket")


def compact(spark: SparkSession, path: str, schema: str | StructType, key: str = "title") -> int | None:
    """Merge all batches so far into one base and return its number, or None for an empty table. Rows are not compared again: a key is in
    one batch only. Readers take the new base once it is complete; the folders it stands for are left to the caller."""
    found = batches(spark, path)
    if not found:
        return None
    _write(read_table(spark, path, schema), f"{path}/base={found[-1]}", key)
    return found[-1]
