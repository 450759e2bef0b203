"""The three JSON-line sets made from the page table: data, index and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators import ids, links

SETS = {
    "data": "id bigint, title string, content string, categories array<string>",
    "index": "id bigint, title string",
    "link": "id bigint, links array<bigint>",
}


def _columns(kind: str) -> list[str]:
    return [part.split()[0] for part in SETS[kind].split(", ")]


def _numbered(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages with their ids, written, and the adjacency of their resolved links."""
    numbered = ids.assign_doc_ids(pages.select("title", "content", "categories", "out_links"))
    edges = links.resolve_links(numbered.select("id", "out_links"), ids.title_dictionary(numbered))
    return numbered, links.adjacency(edges)


def export_sets(pages: DataFrame) -> dict[str, DataFrame]:
    """``pages`` is ``(title, content, categories, out_links)`` with unique titles. Ids follow
    title order and are shared by the three sets."""
    numbered, link = _numbered(pages)
    return {"data": numbered.select(*_columns("data")), "index": numbered.select(*_columns("index")), "link": link}


def export_lines(pages: DataFrame) -> DataFrame:
    """``kind, value``: the JSON lines of all three sets.

    Pages are read once, while ids are given; then a numbered page makes its data and its index line in one pass, and
    its links are resolved from their own columns. A page without a resolved link has no link line."""
    numbered, link = _numbered(pages)
    line = lambda kind: F.struct(F.lit(kind).alias("kind"), F.to_json(F.struct(*_columns(kind))).alias("value"))
    own = numbered.select(F.inline(F.array(line("data"), line("index"))))
    return own.unionByName(link.select(F.inline(F.array(line("link")))))


def export_three_way(pages: DataFrame, path: str) -> None:
    """One write of the three sets, in folders ``kind=data``, ``kind=index`` and ``kind=link`` of text lines."""
    export_lines(pages).write.partitionBy("kind").text(path)


def read_set(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A set read back from its files."""
    return spark.read.schema(SETS[kind]).json(f"{path}/kind={kind}")
