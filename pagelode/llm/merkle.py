"""Fixity audit of archive replicas by hash trees.

Every record is hashed; the records of a file that start in the same range of offsets make a leaf, and
``FAN`` neighbouring nodes make the node above, up to one root a file. Two replicas compare their
roots, then only the children of nodes that differ, and last the records of leaves that differ.

Defined results: a null payload hashes as an empty one; a null file is a file of its own; records at the same place are
compared as a sorted list; a file that only one replica has is missing or extra as a whole; two
empty tables give an empty result; further columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import checked, running_total
from pagelode.session import materialise

#: Bytes of offsets in a leaf, and nodes under one node, as powers of two.
LEAF_BITS, FAN_BITS = 16, 4
#: Bytes of a record's header in the archives of the query.
HEADER = 512


def laid_out(records: DataFrame, file: str, order: list[str], payload: str, header: int = 0) -> DataFrame:
    """``file, offset, length, digest`` and the ``order`` columns: records hashed, and placed one after the other in
    their file. Payloads are read once and not shuffled."""
    whole = F.coalesce(F.col(payload), F.lit(""))
    hashed = records.select(
        F.col(file).alias("file"), *order, (F.octet_length(whole) + header).cast("bigint").alias("length"), F.sha2(whole.cast("binary"), 256).alias("digest")
    )
    return materialise(running_total(hashed, "file", order, "length", "offset"), "records")


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of ``file, node, digest``, leaves first, each written. A leaf holds the records that start in its
    range; a node above, ``2 ** FAN_BITS`` nodes."""
    entry = F.struct("offset", "length", "digest")
    joined = lambda items: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(items)), lambda e: F.concat_ws(":", *[e[c] for c in ("node", "digest")])), ","), 256)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat_ws(":", e["offset"], e["length"], e["digest"])), ",")
    leaf = F.shiftright("offset", LEAF_BITS).alias("node")
    levels = [materialise(records.groupBy("file", leaf).agg(F.sha2(listed, 256).alias("digest")), "leaves")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top:
        above = F.shiftright("node", FAN_BITS).alias("up")
        nodes = levels[-1].groupBy("file", above).agg(joined(F.struct("node", "digest")).alias("digest"))
        levels.append(materialise(nodes.withColumnRenamed("up", "node"), "nodes"))
        top >>= FAN_BITS
    return levels


def differing(left: DataFrame, right: DataFrame, parents: DataFrame | None) -> DataFrame:
    """``file, node`` whose digests differ or that one side lacks, among the children of ``parents``."""
    if parents is not None:
        known = checked(parents.select(F.col("file").alias("f"), F.col("node").alias("p")))
        under = F.col("file").eqNullSafe(F.col("f")) & (F.shiftright("node", FAN_BITS) == F.col("p"))
        left, right = left.join(known, under, "left_semi"), right.join(known, under, "left_semi")
    rows = left.select("file", "node", "digest", F.lit(1).alias("side")).union(right.select("file", "node", "digest", F.lit(2).alias("side")))
    differ = rows.groupBy("file", "node").agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.count(F.lit(1)).alias("n"))
    return materialise(differ.where("n < 2 or a <> b").select("file", "node"), "differing")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """``file, offset, status`` and both lengths and digests of every record that is not the same in both:
    ``corrupt``, ``missing`` in the replica or ``extra`` in it. Both tables are written ``records``."""
    left, right = tree(primary), tree(replica)
    # A replica cut short may have a lower tree: its levels above would be its single node again.
    height = max(len(left), len(right))
    for levels in (left, right):
        while len(levels) < height:
            levels.append(levels[-1].withColumn("node", F.shiftright("node", FAN_BITS)))
    found = None
    for mine, theirs in zip(reversed(left), reversed(right)):
        found = differing(mine, theirs, found)
    known = checked(found.select(F.col("file").alias("f"), F.col("node").alias("p")))
    inside = F.col("file").eqNullSafe(F.col("f")) & (F.shiftright("offset", LEAF_BITS) == F.col("p"))
    columns = ["file", "offset", "length", "digest"]
    sides = [
        records.join(known, inside, "left_semi").select(*columns, F.lit(side).alias("side"))
        for records, side in ((primary, 1), (replica, 2))
    ]
    own = lambda side, c: F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col(c))))
    # Records at one place: one in each replica, as long as archives are sound.
    places = sides[0].union(sides[1]).groupBy("file", "offset").agg(
        *[own(side, c).alias(f"{c}_{side}") for side in (1, 2) for c in ("length", "digest")]
    )
    status = F.when(F.size("digest_2") == 0, "missing").when(F.size("digest_1") == 0, "extra").otherwise("corrupt")
    changed = (F.col("digest_1") != F.col("digest_2")) | (F.col("length_1") != F.col("length_2"))
    first = lambda c: F.element_at(F.concat(f"{c}_1", f"{c}_2"), 1)
    return places.where(changed).select("file", "offset", first("length").alias("length"), first("digest").alias("digest"), status.alias("status"))
