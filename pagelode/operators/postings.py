"""Field tokens, positional postings and corpus statistics.

A corpus is a DataFrame ``(doc_id, title, content, categories array<string>)``; fields are
numbered 0 title, 1 content, 2 categories.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import grouping, porter2, text as tx
from pagelode.functions.stemming import stem_all
from pagelode.operators.joins import estimated_bytes
from pagelode.session import limit_arrow_batches

# Workers need not have the package installed: ship the helpers with the functions.
cloudpickle.register_pickle_by_value(grouping)

N_FIELDS = 3
FIELDS = list(range(N_FIELDS))
# Documents per block of a posting list; bounds the rows gathered under one term.
BLOCK_DOCS = 4096


def _lowered(category_separator: str = " ") -> list[Column]:
    return [
        F.lower("title"),
        F.lower("content"),
        F.lower(F.array_join("categories", category_separator)),
    ]


def _by_field(columns: list[Column], name: str, fields: list[int] = FIELDS) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(i).alias("field"), columns[i].alias(name)) for i in fields]))


def field_tokens(corpus: DataFrame) -> DataFrame:
    """Every whitespace token with its position: ``doc_id, field, field_len, pos, raw``."""
    fields = corpus.select("doc_id", _by_field(_lowered(), "text"))
    split = fields.select("doc_id", "field", tx.tokens(F.col("text")).alias("toks"))
    # The length is taken before exploding: otherwise every token row would carry the array.
    sized = split.select("doc_id", "field", F.size("toks").alias("field_len"), "toks")
    return sized.select("doc_id", "field", "field_len", F.posexplode("toks").alias("pos", "raw"))


def fulltext_tokens(corpus: DataFrame) -> DataFrame:
    """Tokens of the full-text analyser: word-break tokens without stop words, gaps kept.
    ``field_len`` counts kept words only."""
    fields = corpus.select("doc_id", _by_field(_lowered("|"), "text"))
    words = fields.select("doc_id", "field", tx.fulltext_words(F.col("text")).alias("words"))
    kept = F.size(F.filter("words", lambda w: ~w.isin(tx.FULLTEXT_STOP_WORDS)))
    sized = words.select("doc_id", "field", kept.alias("field_len"), "words")
    return sized.select("doc_id", "field", "field_len", F.posexplode("words").alias("pos", "term")).filter(
        ~F.col("term").isin(tx.FULLTEXT_STOP_WORDS)
    )


def _indexed_words(tokens: Column) -> Column:
    """The tokens that enter the ranked index, normalised but not stemmed, with their positions."""
    words = F.transform(tokens, lambda t, i: F.struct(tx.indexable_token(t).alias("t"), i.alias("i")))
    return F.filter(words, lambda w: (w["t"] != "") & ~tx.is_stop_word(w["t"]))


def _fulltext_words(tokens: Column) -> Column:
    """The tokens that enter the full-text index, with their positions."""
    words = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    return F.filter(words, lambda w: ~w["t"].isin(tx.FULLTEXT_STOP_WORDS))


def _grouped(texts: DataFrame, stem: bool, fulltext: bool) -> DataFrame:
    """Postings of ``doc_id, field`` and lower-cased ``text``, or for the full-text method its ``words``. The words of a field are
    grouped by term in Arrow batches of whole fields, so a document's postings need no exchange."""
    names = ["term", "field", "doc_id", "tf", "positions", "field_len"]
    kinds = ["string", "int", texts.schema["doc_id"].dataType.simpleString(), "int", "array<int>", "int"]
    terms_of = grouping.FulltextTerms(tx.FULLTEXT_STOP_WORDS) if fulltext else grouping.RankedTerms(tx.STOP_WORDS, porter2.stem if stem else None)
    gathered, split, split_lists, postings = grouping.gathered, grouping.split_tokens, grouping.split_lists, grouping.posting_batches
    delimiters = tx.DELIMITER_BYTES

    def group(batches):
        for batch in gathered(batches):
            sizes, words = split_lists(batch["words"]) if fulltext else split(batch["text"], delimiters)
            yield from postings(batch, sizes, words, terms_of, not fulltext)

    return texts.mapInArrow(group, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def spread_small(corpus: DataFrame) -> DataFrame:
    """Put an input that has fewer file splits than there are cores on all cores. Larger inputs
    are left as they are read and not shuffled."""
    spark = corpus.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if estimated_bytes(corpus) < cores * split:
        return corpus.repartition(cores, "doc_id")
    return corpus


def build_postings(corpus: DataFrame, stem: bool = True, fulltext: bool = False, fields: list[int] = FIELDS) -> DataFrame:
    """The positional inverted index in long form: one row per (term, field, document) with
    ``tf``, sorted ``positions`` and the field length, so that scoring needs no length table."""
    names = ["title", "content", "categories"]
    limit_arrow_batches(corpus.sparkSession)
    rows = spread_small(corpus.select("doc_id", *[names[i] for i in fields]))
    # Fields that are left out are never read.
    rows = rows.select("doc_id", *[F.col(n) if n in rows.columns else F.lit(None).cast(corpus.schema[n].dataType).alias(n) for n in names])
    texts = rows.select("doc_id", _by_field(_lowered("|" if fulltext else " "), "text", fields))
    if fulltext:
        texts = texts.select("doc_id", "field", tx.fulltext_words(F.col("text")).alias("words"))
    return _grouped(texts, stem, fulltext)


def with_lengths(corpus: DataFrame, fulltext: bool = False) -> DataFrame:
    """Add ``lengths``: the length of each field, all tokens for the ranked method and kept
    words for the full-text one."""
    if fulltext:
        kept = lambda c: F.size(F.filter(tx.fulltext_words(c), lambda w: ~w.isin(tx.FULLTEXT_STOP_WORDS)))
        return corpus.withColumn("lengths", F.array(*[kept(c) for c in _lowered("|")]))
    limit_arrow_batches(corpus.sparkSession)
    count, delimiters = grouping.count_tokens, tx.DELIMITER_BYTES

    @F.arrow_udf("int")
    def n_tokens(texts: pa.Array) -> pa.Array:
        return count(texts, delimiters)

    # Lower case has the same delimiters.
    return corpus.withColumn("lengths", F.array(n_tokens("title"), n_tokens("content"), n_tokens(F.array_join("categories", " "))))


def field_lengths(corpus: DataFrame) -> DataFrame:
    """Unfiltered token count per document and field: ``doc_id, field, len``."""
    return with_lengths(corpus).select("doc_id", F.posexplode("lengths").alias("field", "len"))


def length_stats(docs: DataFrame, fulltext: bool = False) -> DataFrame:
    """Three rows ``field, n_docs, avg_len`` from the ``lengths`` of documents, by one partial
    aggregation. The ranked method counts all documents, the full-text one only those with a
    word in the field."""
    length = lambda i: F.get("lengths", F.lit(i))
    counted = lambda i: F.count_if(length(i) > 0) if fulltext else F.count(F.lit(1))
    sums = docs.agg(
        *[F.struct(counted(i).alias("n"), F.sum(length(i)).alias("s")).alias(f"f{i}") for i in range(N_FIELDS)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("field"),
            F.col(f"f{i}.n").alias("n_docs"),
            F.try_divide(F.col(f"f{i}.s"), F.col(f"f{i}.n")).alias("avg_len"),
        )
        for i in range(N_FIELDS)
    ]
    return sums.select(F.inline(F.array(*rows)))


def corpus_stats(corpus: DataFrame, fulltext: bool = False) -> DataFrame:
    return length_stats(with_lengths(corpus, fulltext), fulltext)


def doc_frequency(postings: DataFrame, *more: str) -> DataFrame:
    return postings.groupBy("term", "field", *more).agg(F.count(F.lit(1)).alias("df"))


def _wide_of_postings(postings: DataFrame) -> DataFrame:
    per_field = postings.groupBy("term", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("field", "tf", "positions"))).alias("parts")
    )
    tf_of = lambda i: F.coalesce(F.get(F.filter("parts", lambda p: p["field"] == i), F.lit(0))["tf"], F.lit(0))
    return per_field.select(
        "term",
        "doc_id",
        F.array(*[tf_of(i) for i in FIELDS]).alias("freq"),
        F.flatten(F.transform("parts", lambda p: p["positions"])).alias("positions"),
    )


def wide_postings(corpus: DataFrame, stem: bool = True, fulltext: bool = False) -> DataFrame:
    """Per (term, document): ``freq`` by field and ``positions`` flattened in field order. ``corpus`` may also be postings that are
    built already; their fields are then gathered by an exchange.

    The words of all fields of a document are one array, sorted by (term, field, position) and cut where the
    term changes, so that the fields of a posting meet in their document's row and nothing is exchanged."""
    if "positions" in corpus.columns:
        return _wide_of_postings(corpus)
    limit_arrow_batches(corpus.sparkSession)
    rows = spread_small(corpus.select("doc_id", "title", "content", "categories"))
    texts = _lowered("|" if fulltext else " ")
    words = lambda text: _fulltext_words(tx.fulltext_words(text)) if fulltext else _indexed_words(tx.tokens(text))
    marked = lambda i: F.transform(words(texts[i]), lambda w: F.struct(w["t"].alias("t"), F.lit(i).alias("f"), w["i"].alias("p")))
    # A missing field has no words; it must not blank the others.
    rows = rows.select("doc_id", F.concat(*[F.coalesce(marked(i), F.array().cast("array<struct<t:string,f:int,p:int>>")) for i in FIELDS]).alias("w"))
    terms = stem_all(F.col("w.t")) if stem and not fulltext else F.col("w.t")
    entry = lambda t, w: F.struct(t.alias("t"), w["f"].alias("f"), w["p"].alias("p"))
    rows = rows.select("doc_id", "w", terms.alias("terms")).select("doc_id", F.sort_array(F.zip_with("terms", "w", entry)).alias("e"))
    n = F.size("e")
    changes = lambda i: F.coalesce(F.get("e", i)["t"] != F.get("e", i - 1)["t"], F.lit(True))
    cut = rows.select("doc_id", "e", F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), changes)).alias("starts"))

    def group(start: Column, k: Column) -> Column:
        part = F.slice("e", start + 1, F.coalesce(F.get("starts", k + 1), n) - start)
        return F.struct(F.get("e", start)["t"].alias("term"), part.alias("part"))

    def frequency(field: int) -> Column:
        return F.size(F.filter("part", lambda x: x["f"] == field))

    exploded = cut.select("doc_id", F.inline_outer(F.transform("starts", group))).filter(F.col("term").isNotNull())
    return exploded.select(
        "term",
        "doc_id",
        F.array(*[frequency(i) for i in FIELDS]).alias("freq"),
        F.col("part.p").alias("positions"),
    )


def posting_lists(corpus: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Postings gathered under their term in blocks of document ids: ``term, block, entries``.

    A frequent term can occur in most documents, so a list is cut at fixed id ranges: a row never
    holds more than ``block_docs`` entries, and the blocks of one term in order are the whole list."""
    wide = wide_postings(corpus)
    return (
        wide.withColumn("block", F.floor(F.col("doc_id") / block_docs))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "freq", "positions"))).alias("entries"))
    )
