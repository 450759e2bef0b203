"""Results to pages: paging comes before text work, so only shown rows are highlighted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions import present, scoring, text as tx, urls
from pagelode.operators.joins import fits_broadcast, literals_of, one_of
from pagelode.plans.query_terms import parse_queries
from pagelode.plans.ranked import MAX_RESULTS, hit_counts, ranked_results, search_hits
from pagelode.session import materialise
from pagelode.sources.index_store import SearchIndex


def paginate(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Keep the rows of the requested page: adds ``page_no, total_pages``. ``requests`` is
    ``(query_id, page)`` with page numbers from 1, clamped into range. A query has at most ``MAX_RESULTS`` results, numbered from
    1, and they lie together since they were ranked; so the window moves nothing, and no query is a hot key."""
    total = present.page_count(F.max("rank_no").over(Window.partitionBy("query_id")))
    asked = results.withColumn("total_pages", total).join(requests, "query_id", "left")
    page_no = present.clamped_page(F.coalesce("page", F.lit(1)), F.col("total_pages"))
    row_page = F.ceil(F.col("rank_no") / present.PER_PAGE)
    return asked.withColumn("page_no", page_no).drop("page").filter(row_page == F.col("page_no"))


def fetch_pages(results: DataFrame, docs: DataFrame, content: DataFrame | None = None) -> DataFrame:
    """Attach title and categories, and ``content`` where it is given; the order travels as ``rank_no``.

    The results are written. The ids of a few pages of results are literals in the scans' filters; as documents are stored in
    ranges of ids, the scans read the row groups of these ids and no others."""
    shown = materialise(results, "shown")
    ids = literals_of(shown, "doc_id")
    stored = [docs] if content is None else [docs, content]
    pages = shown
    for table in stored:
        if ids is not None:
            table = table.where(one_of("doc_id", ids))
        pages = table.join(F.broadcast(pages) if fits_broadcast(pages) else pages, "doc_id")
    return pages


def present_results(pages: DataFrame, queries: DataFrame, fulltext: bool = False) -> DataFrame:
    """Rows ready to show: highlighted title, snippet, categories, links, printed score."""
    words = parse_queries(queries).select(
        "query_id",
        tx.split_words(F.col("keyword")).alias("words"),
        tx.split_words(F.col("category")).alias("category_words"),
    )
    joined = pages.join(words, "query_id")
    body = present.fulltext_snippet if fulltext else present.snippet
    if "rank_norm" in pages.columns:
        score = scoring.score_text(F.col("total"), F.col("text_norm"), F.col("rank_norm"))
    else:
        score = scoring.score_text(F.col("total"))
    modified = F.date_format("last_modified", "yyyy-MM-dd HH:mm") if "last_modified" in pages.columns else F.lit("")
    return joined.select(
        "query_id",
        "rank_no",
        "doc_id",
        *[c for c in ("page_no", "total_pages") if c in pages.columns],
        present.highlight(F.col("title"), F.col("words"), "span").alias("title"),
        urls.result_link(F.col("title"), present.PAGE_BASE).alias("url"),
        body(F.col("content"), F.col("words")).alias("snippet"),
        F.transform("categories", lambda c: present.highlight(c, F.col("category_words"), "b")).alias("category_html"),
        F.transform("categories", lambda c: urls.result_link(c, present.CATEGORY_BASE)).alias("category_href"),
        modified.alias("last_modified"),
        score.alias("score"),
    )


def result_json(shown: DataFrame, counts: DataFrame) -> DataFrame:
    """``query_id, json``: one response per query; a query without results has only its hit
    count. A page holds at most ten rows."""
    page = F.struct(
        "title",
        "url",
        "snippet",
        F.struct(F.col("category_html").alias("html"), F.col("category_href").alias("href")).alias("categories"),
        F.col("last_modified").alias("lastModify"),
        "score",
    )
    per_query = shown.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank_no", page.alias("p")))), lambda e: e["p"]).alias("pages"),
        F.first("page_no").alias("pageNo"),
        F.first("total_pages").alias("totalPages"),
    )
    return counts.join(per_query, "query_id", "left").select(
        "query_id", F.to_json(F.struct("hits", "pages", "pageNo", "totalPages")).alias("json")
    )


def all_hit_counts(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Hit count of every query, 0 where nothing matched."""
    return queries.select("query_id").join(hit_counts(hits), "query_id", "left").select(
        "query_id", F.coalesce("hits", F.lit(0)).alias("hits")
    )


def respond(
    index: SearchIndex, queries: DataFrame, requests: DataFrame, with_rank: bool = False, fulltext: bool = False
) -> DataFrame:
    """``query_id, json``: the response to every query from one search, whose hits are written and then counted, ranked and shown."""
    hits = materialise(search_hits(index, queries, fulltext), "hits")
    page = paginate(ranked_results(hits, index, with_rank), requests)
    shown = present_results(fetch_pages(page, index.docs, index.content), queries, fulltext)
    return result_json(shown, all_hit_counts(hits, queries))


__all__ = ["MAX_RESULTS", "paginate", "fetch_pages", "present_results", "result_json", "all_hit_counts", "respond"]
