"""Breadth-first expansion over stored links ``(src, dst)``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.operators import ids, joins
from pagelode.session import fresh_path


class Links:
    """Links laid out once for many levels: a table bucketed by source, where a source with very many links is dealt to
    several buckets. A level moves to the links, which stay where they are."""

    def __init__(self, edges: DataFrame):
        self.spark = edges.sparkSession
        self.hot = joins.hot_keys(joins.key_counts(edges, ["src"]), ["src"])
        self.name = f"pagelode_links_{uuid.uuid4().hex}"
        dealt = joins.in_lanes(edges.select("src", "dst"), self.hot, ["src"], [F.col("dst")])
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        write = dealt.repartition(buckets, "src", "__lane").write.bucketBy(buckets, "src", "__lane").sortBy("src", "__lane")
        write.option("path", fresh_path(self.spark, "links")).saveAsTable(self.name)

    def targets(self, level: DataFrame) -> DataFrame:
        """``url, depth`` of the links of a level, distinct."""
        sources = joins.in_all_lanes(level.withColumnRenamed("url", "src"), self.hot, ["src"])
        return _deeper(self.spark.table(self.name).join(sources, ["src", "__lane"]))

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _deeper(joined: DataFrame) -> DataFrame:
    return joined.groupBy(F.col("dst").alias("url")).agg(F.min(F.col("depth") + 1).alias("depth"))


def frontier_step(level: DataFrame, edges: DataFrame, visited: DataFrame) -> DataFrame:
    """Links of the current level ``(url, depth)``, distinct, minus visited, one level deeper."""
    targets = _deeper(joins.spread_join(edges, level.withColumnRenamed("url", "src"), ["src"], [F.col("dst")]))
    return targets.join(visited.select("url"), "url", "left_anti")


def frontier_bfs(
    seeds: DataFrame, edges: DataFrame, max_depth: int = 10, page_budget: int | None = None
) -> DataFrame:
    """All pages reached from ``seeds(url)`` with their depth. Each level is written to its own
    folder, which is both the next frontier and part of the visited set. Stops at an empty level,
    the depth limit or the page budget; the budget takes the last level in url order, which is numbered by ranges of
    url and prefix sums of their sizes."""
    spark = seeds.sparkSession
    path = fresh_path(spark, "frontier")
    schema = f"url {edges.schema['dst'].dataType.simpleString()}, depth int"
    read = lambda where: spark.read.schema(schema).parquet(*where)
    links = Links(edges)
    try:
        level = seeds.select("url", F.lit(0).alias("depth")).distinct()
        written: list[str] = []
        reached = 0
        for depth in range(max_depth + 1):
            folder = f"{path}/level={depth}"
            level.write.parquet(folder)
            count = read([folder]).count()
            left = count if page_budget is None else page_budget - reached
            if count > left:
                numbered = ids.assign_doc_ids(read([folder]), "url", "place")
                folder = f"{path}/last"
                numbered.where(F.col("place") < left).select("url", "depth").write.parquet(folder)
            written.append(folder)
            reached += count
            if count == 0 or (page_budget is not None and reached >= page_budget):
                break
            level = links.targets(read([folder])).join(read(written).select("url"), "url", "left_anti")
        return read(written)
    finally:
        links.close()
