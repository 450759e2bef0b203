"""Ranked retrieval: field-weighted, proximity-aware, optionally blended with link ranks.

The unit of work is a table of queries; a single query is a table of one row.
"""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from pagelode.functions import scoring
from pagelode.operators.joins import keep_matching, spread_join
from pagelode.plans import query_batches, query_terms as qt
from pagelode.session import discard, materialise
from pagelode.sources.index_store import SearchIndex

MAX_RESULTS = 1000
#: (query, document) pairs matched in titles at once, about: queries that may give more are searched in batches, so that what
#: lies on disk meanwhile does not grow with queries times documents.
PAIRS_AT_ONCE = 4_000_000
KEY = ["query_id", "doc_id"]
#: Decimals of a printed score; totals are compared by them.
PRINTED_DIGITS = 8


class AnalysedQueries:
    """Query tables shared by the steps of one search: ``lists`` (a row per query) and ``terms``
    (a row per query, field and distinct term, with weights), and the ``index`` narrowed to their terms.

    Both tables are written once. They are used several times, and only a written table has a true size
    by which to choose between broadcasting it and shuffling it."""

    def __init__(self, index: SearchIndex, queries: DataFrame, fulltext: bool = False):
        self.fulltext = fulltext
        self.lists = materialise(qt.analyse_queries(queries, not fulltext), "query-lists")
        words = qt.listed_words(self.lists)
        self.index = index.restricted(words)
        self.freq = qt.query_term_freq(words)
        self.terms = materialise(qt.field_terms(self.freq, self.index, fulltext), "query-terms")

    def pairs_bound(self) -> DataFrame:
        """``query_id, n``: at least the (query, document) pairs matched in titles, from the terms' frequencies alone."""
        return self.terms.where("field = 0").groupBy("query_id").agg(F.sum("df").alias("n"))

    def n_batches(self) -> int:
        """How many batches of about ``PAIRS_AT_ONCE`` pairs the queries make."""
        return -(-(self.pairs_bound().agg(F.sum("n")).first()[0] or 1) // PAIRS_AT_ONCE)

    def batches(self, n: int | None = None) -> list["AnalysedQueries"]:
        """The queries dealt by a hash to ``n`` batches (``n_batches``)."""
        n = n or self.n_batches()
        if n == 1:
            return [self]
        return [self.part(lambda t: t.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i)) for i in range(n)]

    def part(self, of: Callable[[DataFrame], DataFrame]) -> "AnalysedQueries":
        """Some of the queries: those that ``of`` leaves in each table."""
        part = copy(self)
        part.lists, part.terms, part.freq = (of(t) for t in (self.lists, self.terms, self.freq))
        return part

    def whole_ids(self) -> bool:
        """Are query and document ids whole numbers?"""
        ids = (self.lists.schema["query_id"], self.index.postings.schema["doc_id"])
        return all(isinstance(i.dataType, (IntegerType, LongType)) for i in ids)

    def by_rows(self) -> tuple["AnalysedQueries", "AnalysedQueries | None"]:
        """The queries with one row in ``lists``, and the others, if any: an id may have been given with and without a category."""
        several = self.lists.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("query_id")
        several = materialise(several, "several")
        if several.isEmpty():
            return self, None
        return tuple(self.part(lambda t: t.join(several, "query_id", how)) for how in ("left_anti", "left_semi"))


def term_scores(matches: DataFrame, fulltext: bool = False) -> DataFrame:
    """Add ``score`` of each matched term: a sum of logarithms in the ranked method, the usual
    product in the full-text one."""
    norm = scoring.length_norm(F.col("field_len"), F.col("avg_len"))
    if fulltext:
        score = F.col("weight") * scoring.fulltext_tf(F.col("tf"), norm)
    else:
        score = F.col("weight") + scoring.tf_part(F.col("tf"), norm)
    return matches.withColumn("score", score)


def match_terms(index: SearchIndex, terms: DataFrame, fields: list[int] | None = None) -> DataFrame:
    """Postings of all query terms: one row per (query, field, term, document)."""
    postings = index.postings
    if fields is not None:
        postings = postings.filter(F.col("field").isin(fields))
        terms = terms.filter(F.col("field").isin(fields))
    key = ["field", "shard", "term"]
    # How many postings a term has is stored; nothing needs to be counted to find the hot ones.
    counts = index.term_stats.select(*key, F.col("df").alias("n"))
    return spread_join(postings, terms.drop("df"), key, [F.col("doc_id")], counts=counts)


def gather_fields(scored: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Scored terms of one (query, field, document) as ``entries``, bounded by the number of
    distinct query terms; ``carry`` names columns that are constant within the group."""
    constant = ["field_len", "avg_len", *(carry or [])]
    return scored.groupBy(*KEY, "field").agg(
        *[F.first(c).alias(c) for c in constant],
        F.collect_list(F.struct("term", "score", "positions", "weight")).alias("entries"),
    )


def field_value(field: int, terms: Column, entries: Column, field_len: Column) -> Column:
    """Score of one field: summed term scores times proximity factor times field weight."""
    boosts = scoring.RANKED_BOOSTS[field]
    factor = scoring.proximity_factor(
        F.size(entries),
        F.size(F.array_distinct(terms)),
        scoring.positions_of(entries),
        terms,
        field_len,
        boosts,
    )
    return scoring.total(F.transform(entries, lambda e: e["score"])) * factor * boosts.weight


def fulltext_field_value(field: int, terms: Column, entries: Column, field_len: Column, avg_len: Column) -> Column:
    """Score of one field in the full-text method: phrase clause, all-terms clause, and the
    any-term clause where the phrase does not match; NULL where no clause matches."""
    boosts = scoring.FULLTEXT_BOOSTS[field]
    any_term = scoring.total(F.transform(entries, lambda e: e["score"]))
    has_all = F.size(entries) == F.size(F.array_distinct(terms))
    freq = F.when(has_all, F.size(scoring.phrase_starts(scoring.positions_of(entries), terms))).otherwise(0)
    idf = scoring.total(F.transform(entries, lambda e: e["weight"]))
    phrase = idf * scoring.fulltext_tf(freq, scoring.length_norm(field_len, avg_len))
    value = (
        F.when(freq > 0, boosts.phrase * phrase).otherwise(boosts.any_term * any_term)
        + F.when(has_all, boosts.all_terms * any_term).otherwise(F.lit(0.0))
    )
    return value * boosts.weight


def _score_fields(gathered: DataFrame, fields: list[int], fulltext: bool) -> DataFrame:
    """Add ``value``; needs the term lists of the query on the row."""
    def one(field: int) -> Column:
        terms = F.col("category_terms" if field == 2 else "keyword_terms")
        args = (field, terms, F.col("entries"), F.col("field_len"))
        return fulltext_field_value(*args, F.col("avg_len")) if fulltext else field_value(*args)

    value = reduce(lambda acc, f: F.when(F.col("field") == f, one(f)).otherwise(acc), fields, F.lit(None).cast("double"))
    return gathered.withColumn("value", value)


def search_hits(index: SearchIndex, queries: DataFrame, fulltext: bool = False) -> DataFrame:
    """All hits with their text score: ``query_id, doc_id, title_score, content_score,
    category_score, text_score`` and the stored link ``rank`` of the document.

    A hit needs a term in the title and one in the content. Titles are short, so they are matched
    first; only (query, document) pairs found there look up content and category postings, by
    (term, document) - a key without hot values. Queries sharing a frequent word therefore never
    meet the whole content posting list of that word."""
    return _hits(AnalysedQueries(index, queries, fulltext))


def _hits(analysed: AnalysedQueries) -> DataFrame:
    index, lists, terms, fulltext = analysed.index, analysed.lists, analysed.terms, analysed.fulltext
    by_query = lambda df, side: spread_join(df, side, ["query_id"], [F.col("doc_id")], counts=analysed.pairs_bound())

    title = gather_fields(term_scores(match_terms(index, terms, [0]), fulltext), ["rank"])
    title = _score_fields(by_query(title, lists), [0], fulltext)
    pairs = title.select(*KEY, F.col("value").alias("title_score"), "rank")

    rest = terms.filter(F.col("field") != 0)
    wanted = by_query(pairs, rest.drop("qf", "df"))
    postings = keep_matching(
        index.postings.filter(F.col("field") != 0).drop("rank"),
        rest.select("field", "shard", "term").distinct(),
        ["field", "shard", "term"],
    )
    found = term_scores(postings.join(wanted, ["field", "shard", "term", "doc_id"]), fulltext)

    # Spread by (query, document), so that gathering and folding need no further exchange.
    other = gather_fields(found.repartition(*KEY), ["title_score", "rank"])
    other = _score_fields(by_query(other, lists), [1, 2], fulltext)
    folded = other.groupBy(*KEY).agg(
        F.first("title_score").alias("title_score"),
        F.first("rank").alias("rank"),
        F.first("has_category").alias("has_category"),
        F.max(F.when(F.col("field") == 1, F.col("value"))).alias("content_score"),
        F.max(F.when(F.col("field") == 2, F.col("value"))).alias("category_score"),
    )
    hit = F.col("content_score").isNotNull() & (~F.col("has_category") | F.col("category_score").isNotNull())
    text = F.col("title_score") + F.col("content_score") + F.coalesce("category_score", F.lit(0.0))
    return folded.filter(hit).select(
        *KEY, "title_score", "content_score", "category_score", text.alias("text_score"), "rank"
    )


def hit_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))


def normalised(hits: DataFrame) -> DataFrame:
    """Text scores rescaled to 0..100 over all hits of the query. Hits are written, so that the search behind them runs once. The
    extremes come from a partial aggregation and are joined back; a window would put all hits of a query in one task."""
    hits = materialise(hits, "hits")
    extremes = hits.groupBy("query_id").agg(
        F.min("text_score").alias("low"), F.max("text_score").alias("high"), F.count(F.lit(1)).alias("n")
    )
    extremes = materialise(extremes, "extremes")
    joined = spread_join(hits, extremes.drop("n"), ["query_id"], [F.col("doc_id")], counts=extremes)
    return joined.withColumn(
        "text_norm", scoring.rescale(F.col("text_score"), F.col("low"), F.col("high"), scoring.TEXT_SCALE)
    ).drop("low", "high")


def rank_or_default(docs: DataFrame, ranks: DataFrame, stats: DataFrame) -> DataFrame:
    """Add ``rank``: the link rank, or one over the number of documents where there is none."""
    n_docs = stats.filter(F.col("field") == 0).select("n_docs")  # one row
    known = ranks.select(F.col("id").alias("doc_id"), F.col("rank").alias("__rank"))
    return (
        docs.join(known, "doc_id", "left")
        .join(F.broadcast(n_docs))
        .withColumn("rank", F.coalesce("__rank", 1.0 / F.col("n_docs")))
        .drop("__rank", "n_docs")
    )


def blend_ranks(hits: DataFrame, index: SearchIndex) -> DataFrame:
    """Total score of rank-blended search: ``text_norm, rank_norm, total``. Hits carry their document's rank from the title
    postings, and the largest rank is in the index's one row of ``meta``; the rank table is not read."""
    if index.ranks is None:
        raise ValueError("the index holds no link ranks")
    rank = F.coalesce("rank", 1.0 / F.col("n_docs"))
    rank_norm = scoring.rescale(rank, F.lit(0.0), F.coalesce("max_rank", F.lit(0.0)), scoring.RANK_SCALE)
    return (
        normalised(hits)
        .join(F.broadcast(index.meta.select("n_docs", "max_rank")))  # one row
        .withColumn("rank", rank)
        .withColumn("rank_norm", rank_norm)
        .withColumn("total", scoring.blended(F.col("text_norm"), F.col("rank_norm")))
        .drop("n_docs", "max_rank")
    )


def top_results(hits: DataFrame, limit: int = MAX_RESULTS) -> DataFrame:
    """First ``limit`` results per query by ``total``, numbered from 1 in ``rank_no``. Totals
    are compared as printed (8 decimals), then by document id. Spark keeps at most ``limit`` rows
    per query and map task before the exchange, so one query with very many hits is no hot spot."""
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("total", PRINTED_DIGITS)), F.asc("doc_id"))
    return hits.withColumn("rank_no", F.row_number().over(order)).filter(F.col("rank_no") <= limit)


def ranked_results(hits: DataFrame, index: SearchIndex, with_rank: bool = False, limit: int = MAX_RESULTS) -> DataFrame:
    """The first results of every query among its hits: ``query_id, rank_no, doc_id, total`` and score parts."""
    scored = blend_ranks(hits, index) if with_rank else hits.withColumn("total", F.col("text_score"))
    return top_results(scored, limit)


def _search(index: SearchIndex, queries: DataFrame, fulltext: bool, with_rank: bool, limit: int) -> DataFrame:
    """Results by batches of queries. Where there are several, each one's results are written before the next starts; its shuffle files
    and hits go then. Those of the ranked method without link ranks go through blocks of documents, where pairs do not become rows."""
    analysed = AnalysedQueries(index, queries, fulltext)
    n = analysed.n_batches()
    if n == 1:
        return ranked_results(_hits(analysed), index, with_rank, limit)
    written, others = [], analysed
    if not fulltext and not with_rank and analysed.whole_ids():
        simple, others = analysed.by_rows()
        written.append(query_batches.search(simple, limit, PRINTED_DIGITS))
        n = others.n_batches() if others else 0
    for batch in others.batches(n) if n else []:
        hits = materialise(_hits(batch), "hits")
        written.append(materialise(ranked_results(hits, index, with_rank, limit), "results"))
        discard(hits)
    return reduce(DataFrame.unionByName, written)


def search(index: SearchIndex, queries: DataFrame, with_rank: bool = False, limit: int = MAX_RESULTS) -> DataFrame:
    """Ranked results of every query."""
    return _search(index, queries, False, with_rank, limit)


def search_fulltext(index: SearchIndex, queries: DataFrame, limit: int = MAX_RESULTS) -> DataFrame:
    """Boolean and phrase search over an index built with ``fulltext=True``."""
    return _search(index, queries, True, False, limit)
