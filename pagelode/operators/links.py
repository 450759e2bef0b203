"""The link graph: resolving titles to ids, degrees, in-links, dangling targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.operators.joins import spread_join


def link_rows(pages: DataFrame) -> DataFrame:
    """One row per out-link: ``id, pos, target``."""
    return pages.select("id", F.posexplode("out_links").alias("pos", "target"))


def resolve_links(pages: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Edges ``src, pos, dst``; titles that are not in the dictionary are dropped, self-links
    are kept. A title that everything links to is a hot key: beyond the broadcast limit the
    links are put in lanes and the dictionary is repeated once per lane."""
    links = link_rows(pages)
    names = dictionary.select(F.col("title").alias("target"), F.col("id").alias("dst"))
    joined = spread_join(links, names, ["target"], [F.col("id"), F.col("pos")])
    return joined.select(F.col("id").alias("src"), "pos", "dst")


def adjacency(edges: DataFrame) -> DataFrame:
    """``id, links`` in link order, only pages with a resolved link. Bounded by the links of
    one page."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "dst")))
    return edges.groupBy("src").agg(F.transform(ordered, lambda e: e["dst"]).alias("links")).withColumnRenamed("src", "id")


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))


def in_links(edges: DataFrame) -> DataFrame:
    """Incoming links per page, counted with partial aggregation. The sources themselves stay
    in edge form: a page may be linked from most others."""
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """Pages that occur only as link targets."""
    targets = edges.select(F.col("dst").alias("id")).distinct()
    return targets.join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
