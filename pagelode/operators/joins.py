"""Joins that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.session import materialise

#: A key with more rows than this is hot; it is shared by a task for each so many rows.
HOT_ROWS = 1_000_000
#: Hot keys that are spread, at most: the heaviest. Bounds the table that is broadcast.
HOT_KEYS = 10_000
#: Literals in a filter that is pushed to a scan, at most, and in one ``IN`` of it: the Parquet reader turns
#: longer lists into a range.
LITERALS, LITERALS_IN = 1000, 10


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (an upper bound for filters and projections)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    spark = df.sparkSession
    limit = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return 0 < estimated_bytes(df) <= limit


def key_counts(rows: DataFrame, on: list[str]) -> DataFrame:
    """``on, n``: rows of each key, by a partial aggregation."""
    return rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, on: list[str]) -> DataFrame | None:
    """The heaviest keys of ``counts`` (``on, n``; n counted or bounded from above) over ``HOT_ROWS``, written, with the
    number of ``lanes`` each is dealt to; None where no key is hot."""
    hot = counts.where(F.col("n") > HOT_ROWS).where(reduce(Column.__and__, [F.col(c).isNotNull() for c in on]))
    heaviest = hot.orderBy(F.desc("n")).limit(HOT_KEYS)
    lanes = F.ceil(F.col("n") / HOT_ROWS).cast("int")
    written = materialise(heaviest.select(*on, lanes.alias("__lanes")), "hot-keys")
    return None if written.isEmpty() else written


def in_lanes(big: DataFrame, hot: DataFrame | None, on: list[str], spread: list[Column]) -> DataFrame:
    """``big`` with ``__lane``: rows of a hot key are dealt by ``spread``, all others have lane 0. Rows with a null in the
    key match nothing; they are dealt too, so that an outer join does not gather them."""
    null_key = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    own = F.lit(1)
    if hot is not None:
        big, own = big.join(F.broadcast(hot), on, "left"), F.coalesce("__lanes", F.lit(1))
    lane = F.pmod(F.xxhash64(*spread), F.when(null_key, F.lit(HOT_KEYS)).otherwise(own)).cast("int")
    return big.withColumn("__lane", lane).drop("__lanes")


def in_all_lanes(small: DataFrame, hot: DataFrame | None, on: list[str]) -> DataFrame:
    """``small`` with ``__lane``: a row of a hot key once in each of its lanes, every other row once."""
    if hot is None:
        return small.withColumn("__lane", F.lit(0))
    lanes = F.sequence(F.lit(0), F.coalesce("__lanes", F.lit(1)) - 1)
    return small.join(F.broadcast(hot), on, "left").withColumn("__lane", F.explode(lanes)).drop("__lanes")


def spread_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: list[Column], how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """Join on keys that may be very frequent in ``big``.

    If the estimated size of ``small`` is under the session's broadcast limit it is broadcast. Otherwise the keys of
    ``big`` are counted (or ``counts``, ``on, n``, is taken, where something smaller tells them), and only the hot ones are
    spread: their rows in ``big`` over as many lanes as their number asks for, their rows in ``small`` repeated in
    these lanes. All other rows move once, in the same shuffle."""
    if fits_broadcast(small):
        return big.join(F.broadcast(small), on, how)
    hot = hot_keys(key_counts(big, on) if counts is None else counts.select(*on, "n"), on)
    if hot is None and how != "left":
        return big.join(small, on, how)
    return in_lanes(big, hot, on, spread).join(in_all_lanes(small, hot, on), [*on, "__lane"], how).drop("__lane")


def keep_matching(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Drop rows of ``big`` whose key is not in ``keys`` before a later shuffle. Purely an
    optimisation: where ``keys`` is too large to broadcast the later join does the filtering."""
    if fits_broadcast(keys):
        return big.join(F.broadcast(keys), on, "left_semi")
    return big


def literals_of(keys: DataFrame, column: str) -> list | None:
    """The distinct values of a column of a written table, for a filter that a scan can push down, or None if there are
    more than ``LITERALS``. What the driver gets is bounded by that."""
    found = keys.select(column).where(F.col(column).isNotNull()).distinct().limit(LITERALS + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= LITERALS else None


def one_of(column: str, values: list) -> Column:
    """``column`` is one of ``values``, in a form that prunes sorted row groups by every value."""
    if not values:
        return F.lit(False)
    groups = [F.col(column).isin(values[i : i + LITERALS_IN]) for i in range(0, len(values), LITERALS_IN)]
    while len(groups) > 1:  # a balanced tree of disjunctions
        groups = [reduce(Column.__or__, groups[i : i + 2]) for i in range(0, len(groups), 2)]
    return groups[0]
