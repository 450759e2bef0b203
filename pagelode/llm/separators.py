"""Token counts of documents in flat token files without an index.

A file is a run of 16-bit ids in which one id ends a document. Blocks of the file are searched for that id in
parallel; prefix sums and a running maximum over the blocks' summaries give where each block starts, how many
documents ended before, and where the document that reaches into it began.

Defined results: two separators in a row are an empty document; ids after the last separator are a document
that is not ``closed``; a block of no bytes holds nothing; half an id at the end of a file is ignored; an empty
table gives an empty result; further columns are ignored. Null and empty texts are written as empty documents; a text whose ids do not
fit 16 bits or hold the separator stops the writing with an error."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelode.llm.bpe_tree import Encoder
from pagelode.llm.common import checked
from pagelode.session import fresh_path, materialise

#: The id that ends a document, free in the vocabulary; bytes of a block; blocks summed up together.
END, BLOCK, GROUP = 65535, 1 << 20, 1024


def write_token_files(docs: DataFrame, path: str, text: str = "text", end: int = END, block: int = BLOCK) -> DataFrame:
    """Documents encoded and laid end to end, one flat file a task, written as blocks ``file, block, data``."""

    def lay(batches):
        encoder, file = Encoder.load(path), TaskContext.get().partitionId()
        rest, number, stop = bytearray(), 0, int(end).to_bytes(2, "little")
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                ids = np.frombuffer(encoder.leaf(t or "")[0], "<u4")
                if len(ids) and (ids.max() > 65535 or (ids == end).any()):
                    raise ValueError(f"a text holds an id above 65535 or the separator {end}")
                rest += ids.astype("<u2").tobytes() + stop
                while len(rest) >= block:
                    out.append(bytes(rest[:block]))
                    del rest[:block]
            yield rows(file, number, out)
            number += len(out)
        yield rows(file, number, [bytes(rest)] if rest else [])

    def rows(file, number, data):
        numbers = list(range(number, number + len(data)))
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * len(data), pa.int64()), pa.array(numbers, pa.int64()), pa.array(data, pa.binary())], names=["file", "block", "data"]
        )

    spark = docs.sparkSession
    place = fresh_path(spark, "tokens")
    blocks = docs.select(text).mapInArrow(lay, "file bigint, block bigint, data binary")
    blocks.write.option("compression", "zstd").parquet(place)
    return spark.read.parquet(place)


def read_token_files(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Blocks ``file, block, data`` of flat files (up to 2 GB each) at a path that Spark can read."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length", "content")
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.greatest("length", F.lit(1)) - 1) / block)))
    data = F.substring("content", (F.col("block") * block + 1).cast("int"), F.lit(block))
    return files.withColumn("block", number).select("file", "block", data.alias("data"))


def summaries(blocks: DataFrame, end: int = END) -> DataFrame:
    """``file, block, n`` ids and the places ``ends`` of separators in every block, written."""

    def scan(batches):
        for batch in batches:
            ids = [np.frombuffer(d, "<u2", len(d) // 2) if d else np.empty(0, "<u2") for d in batch.column(2).to_pylist()]
            ends = [np.flatnonzero(i == end).astype(np.int32) for i in ids]
            offsets = np.r_[0, np.cumsum([len(e) for e in ends])].astype(np.int32)
            flat = np.concatenate([*ends, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(i) for i in ids], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))],
                names=["file", "block", "n", "ends"],
            )

    kind = dict(blocks.dtypes)["file"]
    given = blocks.select("file", F.col("block").cast("bigint").alias("block"), "data")
    return materialise(given.mapInArrow(scan, f"file {kind}, block bigint, n bigint, ends array<int>"), "summaries")


def document_lengths(blocks: DataFrame, end: int = END) -> DataFrame:
    """``file, document, start, n_tokens, closed``: every document of every file in order.

    The scan has two levels: groups of ``GROUP`` blocks are summed, the groups of a file are scanned, and then
    the blocks in a group, so that a file of any length is no single task."""
    found = summaries(blocks, end).withColumn("group", F.floor(F.col("block") / GROUP))
    found = found.withColumn("k", F.size("ends").cast("bigint"))
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = found.withColumns({"at": F.coalesce(F.sum("n").over(inside), F.lit(0)), "had": F.coalesce(F.sum("k").over(inside), F.lit(0))})
    local = local.withColumn("last", F.when(F.col("k") > 0, F.col("at") + F.element_at("ends", -1)))
    local = materialise(local.withColumn("open", F.max("last").over(inside)), "local")

    sums = local.groupBy("file", "group").agg(F.sum("n").alias("gn"), F.sum("k").alias("gk"), F.max("last").alias("gl"))
    over = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"g_at": F.coalesce(F.sum("gn").over(over), F.lit(0)), "g_had": F.coalesce(F.sum("gk").over(over), F.lit(0))})
    sums = sums.withColumn("g_open", F.max(F.col("g_at") + F.col("gl")).over(over))
    sums = materialise(sums, "groups")

    starts = checked(sums.select("file", "group", "g_at", "g_had", "g_open"))
    placed = local.where("k > 0").join(starts, ["file", "group"])
    first = F.coalesce(F.col("g_at") + F.col("open"), F.col("g_open"), F.lit(-1)) + 1
    each = placed.select("file", "ends", (F.col("g_at") + F.col("at")).alias("base"), (F.col("g_had") + F.col("had")).alias("before"), first.alias("first"), F.posexplode("ends").alias("i", "e"))
    start = F.when(F.col("i") == 0, F.col("first")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + 1)
    closed = each.select("file", (F.col("before") + F.col("i")).alias("document"), start.alias("start"), (F.col("base") + F.col("e")).alias("stop"), F.lit(True).alias("closed"))

    totals = sums.groupBy("file").agg(F.sum("gn").alias("stop"), F.sum("gk").alias("document"), F.max(F.col("g_at") + F.col("gl")).alias("last"))
    tail = totals.withColumn("start", F.coalesce(F.col("last") + 1, F.lit(0))).where("start < stop")
    rows = closed.union(tail.select("file", "document", "start", "stop", F.lit(False).alias("closed")))
    return rows.select("file", "document", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "closed")
