"""Query text to weighted query terms, for many queries at once.

``queries`` is ``(query_id, query)``. Part 0 is the keyword (matched in title and content), part
1 the category text (matched in categories).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions import scoring, text as tx
from pagelode.functions.stemming import with_stem
from pagelode.operators.joins import fits_broadcast, key_counts, spread_join
from pagelode.sources.index_store import SearchIndex, shard_of


def parse_queries(queries: DataFrame) -> DataFrame:
    """``query_id, keyword, category``, both lower-cased."""
    return queries.select(
        "query_id",
        tx.keyword_part(F.col("query")).alias("keyword"),
        tx.category_part(F.col("query")).alias("category"),
    )


def _parts(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "query_id",
        (F.col("category") != "").alias("has_category"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("part"), F.col("keyword").alias("text")),
                F.struct(F.lit(1).alias("part"), F.col("category").alias("text")),
            )
        ),
    )


def query_words(parsed: DataFrame, analyse: bool = True) -> DataFrame:
    """Ordered query terms ``query_id, has_category, part, pos, term``. The ranked method drops stop words and
    stems; the full-text method takes the words as they are."""
    words = _parts(parsed).select("query_id", "has_category", "part", F.posexplode(tx.split_words(F.col("text"))).alias("pos", "word"))
    if not analyse:
        return words.withColumnRenamed("word", "term")
    kept = words.filter(~tx.is_stop_word(F.col("word")))
    return with_stem(kept, "word", "term").select("query_id", "has_category", "part", "pos", "term")


def query_term_freq(words: DataFrame) -> DataFrame:
    return words.groupBy("query_id", "part", "term").agg(F.count(F.lit(1)).alias("qf"))


def term_lists(words: DataFrame) -> DataFrame:
    """One row per query that has terms: ``keyword_terms`` and ``category_terms`` in order, and
    whether a category was given. Bounded by the length of the query text."""
    ordered = lambda part: F.transform(
        F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("pos", "term")))),
        lambda e: e["term"],
    )
    return words.groupBy("query_id", "has_category").agg(
        ordered(0).alias("keyword_terms"), ordered(1).alias("category_terms")
    )


def analyse_queries(queries: DataFrame, analyse: bool = True) -> DataFrame:
    return term_lists(query_words(parse_queries(queries), analyse))


def listed_words(lists: DataFrame) -> DataFrame:
    """Back from term lists to one row per term, without repeating the analysis."""
    parts = lists.select(
        "query_id",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("part"), F.col("keyword_terms").alias("terms")),
                F.struct(F.lit(1).alias("part"), F.col("category_terms").alias("terms")),
            )
        ),
    )
    return parts.select("query_id", "part", F.posexplode("terms").alias("pos", "term"))


def field_terms(freq: DataFrame, index: SearchIndex, fulltext: bool = False) -> DataFrame:
    """Terms per field with their weight: ``query_id, field, shard, term, qf, df, weight, avg_len``.
    Terms that do not occur in a field are dropped."""
    fields = F.when(F.col("part") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(2)))
    wanted = freq.select("query_id", "term", "qf", F.explode(fields).alias("field"))
    wanted = wanted.withColumn("shard", shard_of(F.col("term"), index.n_shards))
    key = ["term", "field", "shard"]
    if fits_broadcast(wanted):
        counted = index.term_stats.join(F.broadcast(wanted), key)
    else:
        # Statistics of the distinct terms only: one row per term however many queries ask for it.
        asked = key_counts(wanted, key)
        known = index.term_stats.join(asked.drop("n"), key, "left_semi")
        counted = spread_join(wanted, known, key, [F.col("query_id")], counts=asked)
    both = counted.join(F.broadcast(index.stats), "field")  # three rows
    if fulltext:
        weight = F.col("qf") * scoring.fulltext_idf(F.col("n_docs"), F.col("df"))
    else:
        weight = scoring.query_weight(F.col("n_docs"), F.col("df"), F.col("qf"))
    return both.select(
        "query_id",
        "field",
        "shard",
        "term",
        "qf",
        "df",
        weight.alias("weight"),
        "avg_len",
    )
