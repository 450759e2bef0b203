"""Mixing sources to target weights: every source gives an exact number of words.

Documents get hash-random keys; within each source they are dealt to key ranges, the ranges' words
are summed, prefix sums over the ranges find the one in which the source's budget ends, and only
that range is sorted to find the document at which to cut. Whole epochs are taken before that.

Defined results: a null or empty text has size 0 and is taken 0 words; a null source is a source of
its own and comes last; rows with the same id and text share a key, and if the cut falls on them
each gives an equal part, rounded down; an empty table gives an empty result; further columns pass
through unless they bear the name of a result column, which replaces them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.llm.common import checked, count_words
from pagelode.session import materialise

#: Weights dealt to the sources in order, repeating, and how often a source may be used at most.
WEIGHTS, MOST_EPOCHS = (1, 2, 3), 3
#: Leading hex digits of the key that name its range: 4,096 ranges of each source.
RANGE_DIGITS = 3

RESULT = ["size", "source_size", "target", "budget", "taken"]


def document_key(doc_id: str, text: str) -> Column:
    """Hash-random key of a document, the same in every run: 32 hex digits."""
    given = F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit("")))
    return F.md5(given)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target, budget`` from ``source, size`` rows.

    A target is the smaller of ``most`` times the source's size and its weight times a common
    level. Sorted by the level at which they reach their limit, the sources before the first whose
    limit is above the level stop at their limits; that level shares out the rest. The windows
    without partition see one row for each source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    deal = F.array(*[F.lit(w) for w in weights])
    limits = totals.withColumn("w", F.element_at(deal, (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    limits = limits.withColumn("limit", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = (
        limits.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("shares", F.sum("w").over(after))
        .withColumn("open", F.col("rest") * F.col("w") <= F.col("limit") * F.col("shares"))
        .withColumn("first", F.row_number().over(by_level))
    )
    level = F.min(F.when(F.col("open"), F.struct("first", "rest", "shares"))).over(everything)
    target = F.when(F.col("first") < level["first"], F.col("limit").cast("double")).otherwise(
        (level["rest"] * F.col("w")).cast("double") / level["shares"]
    )
    return steps.select("source", "source_size", target.alias("target")).withColumn("budget", F.floor("target"))


def mix_cuts(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: ``epochs`` in which every document is taken, and the key ``cut`` before
    which a document is taken once more; documents at the key give ``left`` of their ``at`` words.

    ``keyed``, a written table, has ``source, key, size``; ``targets`` is written too. No row of a
    document is gathered by source: sums of ranges are, and the documents of one range."""
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)))
    plan = plan.withColumn("extra", F.col("budget") - F.col("epochs") * F.col("source_size"))
    span = F.substring("key", 1, RANGE_DIGITS)
    ranges = keyed.groupBy("source", span.alias("span")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    extra = plan.select(F.col("source").alias("s"), "extra")
    ends = ranges.join(checked(materialise(extra, "extra")), F.col("source").eqNullSafe(F.col("s")))
    ends = materialise(
        ends.where("extra > before and extra <= before + words").select("s", "span", F.col("before").alias("start"), "extra"), "ends"
    )
    inside = keyed.withColumn("span2", span).join(
        checked(ends), F.col("source").eqNullSafe(F.col("s")) & (F.col("span2") == F.col("span"))
    )
    keys = inside.groupBy("s", "start", "extra", "key").agg(F.sum("size").alias("at"))
    upto = Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("begin", F.col("start") + F.coalesce(F.sum("at").over(upto), F.lit(0)))
    cuts = keys.where("extra > begin and extra <= begin + at").select("s", F.col("key").alias("cut"), (F.col("extra") - F.col("begin")).alias("left"), "at")
    return plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "extra")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size, source_size, target, budget, taken``: the words that the mix takes of each
    document, repeats counted. Only ids of sources and keys are written and shuffled, no text."""
    kept = [c for c in docs.columns if c not in (*RESULT, "epochs", "cut", "left", "at", "__s", "__key")]
    keyed = docs.select(F.col(source).alias("source"), document_key(doc_id, text).alias("key"), count_words(F.col(text)).alias("size"))
    keyed = materialise(keyed, "keyed")
    targets = materialise(source_targets(keyed), "targets")
    cuts = materialise(mix_cuts(keyed, targets).withColumnRenamed("source", "__s"), "cuts")
    sized = docs.select(*kept, count_words(F.col(text)).alias("size"), document_key(doc_id, text).alias("__key"))
    joined = sized.join(checked(cuts), F.col(source).eqNullSafe(F.col("__s")), "left")
    once_more = (
        F.when(F.col("__key") < F.col("cut"), F.col("size"))
        .when(F.col("__key") == F.col("cut"), F.floor(F.col("size") * F.col("left") / F.col("at")))
        .otherwise(F.lit(0))
    )
    taken = (F.col("epochs") * F.col("size") + once_more).cast("bigint").alias("taken")
    return joined.select(*kept, "size", "source_size", "target", "budget", taken)


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a document once for each epoch that takes
    it, and where a source's budget ends inside a document, its words up to there."""
    mixed = mix(docs, doc_id, text, source).where("taken > 0")
    turns = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")))
    rows = mixed.withColumn("__turn", F.explode(turns))
    words = F.least(F.col("size"), F.col("taken") - (F.col("__turn") - 1) * F.col("size")).cast("int")
    # Pieces end where a word ends, so the first n pieces hold n words and what stands between them.
    pieces = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    cut = F.when(words == F.col("size"), F.col(text)).otherwise(F.array_join(F.slice(pieces, 1, words), ""))
    columns = [cut.alias(c) if c == text else F.length(cut).cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return rows.select(*columns)
