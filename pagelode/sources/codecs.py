"""Text forms of postings, rank files and list columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _numbers(col: Column, sep: str = ",") -> Column:
    return F.array_join(col.cast("array<string>"), sep)


def encode_list(items: Column) -> Column:
    return F.array_join(items, "|")


def decode_list(text: Column) -> Column:
    """Split at the bar; trailing empty items are dropped, but '' is one empty item."""
    bare = F.regexp_replace(text, r"\|+$", "")
    return F.when(text.isNull() | (text == ""), F.array(F.lit(""))).when(
        bare == "", F.array().cast("array<string>")
    ).otherwise(F.split(bare, r"\|"))


def encode_postings(lists: DataFrame) -> DataFrame:
    """Posting lists to lines ``term TAB doc:f0,f1,f2|p,p;doc:...``, one line per block."""
    entry = lambda e: F.concat(
        e["doc_id"].cast("string"), F.lit(":"), _numbers(e["freq"]), F.lit("|"), _numbers(e["positions"])
    )
    body = F.array_join(F.transform("entries", entry), ";")
    return lists.select(F.concat_ws("\t", "term", body).alias("value"))


# Repeats of groups are possessive: Java matches a plain repeat of a group by recursion, one call for each item, and a
# term can have a posting in most documents, a document a position for most of its words.
_NUMBERS = r"[0-9]++(?:,[0-9]++)*+"
_ENTRY = rf"[0-9]++:{_NUMBERS}\|(?:{_NUMBERS})?+"
#: A whole posting line: a term, a tab, entries.
POSTING_LINE = rf"\A[^\t]++\t{_ENTRY}(?:;{_ENTRY})*+\z"


def bad_postings(lines: DataFrame) -> DataFrame:
    """The lines that ``decode_postings`` skips: not of the form of a posting line."""
    return lines.where(F.col("value").isNull() | ~F.col("value").rlike(POSTING_LINE))


def decode_postings(lines: DataFrame) -> DataFrame:
    """Lines back to ``term, doc_id, freq, fields``: ``fields`` slices the flat position list
    by the per-field frequencies. Malformed lines are skipped; ``bad_postings`` returns them. Numbers
    too large for their type are NULL."""
    # A line is matched and cut once, before its entries become rows; cut after that, a whole line would be cut again for every entry.
    cut = lines.select(F.when(F.col("value").rlike(POSTING_LINE), F.split("value", "\t")).alias("cut"))
    named = cut.select(F.get("cut", F.lit(0)).alias("term"), F.get("cut", F.lit(1)).alias("body"))
    entries = named.select("term", F.explode(F.split("body", ";")).alias("entry"))
    pieces = entries.select("term", F.split("entry", "[:|]").alias("e"))
    numbers = lambda text: F.when(text == "", F.array().cast("array<int>")).otherwise(F.split(text, ",").try_cast("array<int>"))
    parts = pieces.select(
        "term",
        F.get("e", F.lit(0)).try_cast("long").alias("doc_id"),
        numbers(F.get("e", F.lit(1))).alias("freq"),
        numbers(F.get("e", F.lit(2))).alias("flat"),
    )

    def field_slice(f: Column, i: Column) -> Column:
        before = F.aggregate(F.slice("freq", F.lit(1), i), F.lit(0), lambda a, x: a + x)
        return F.slice("flat", before + 1, f)

    return parts.select("term", "doc_id", "freq", F.transform("freq", field_slice).alias("fields"))


def encode_ranks(ranks: DataFrame) -> DataFrame:
    """``id, rank, links`` to lines ``id,rank TAB a,b,c`` (the value may be empty)."""
    key = F.concat_ws(",", F.col("id").cast("string"), F.col("rank").cast("string"))
    return ranks.select(F.concat(key, F.lit("\t"), F.coalesce(_numbers(F.col("links")), F.lit(""))).alias("value"))


def decode_ranks(lines: DataFrame) -> DataFrame:
    """Lines back to ``id, rank, links``; malformed numbers give NULL."""
    key = F.split(F.split_part("value", F.lit("\t"), F.lit(1)), ",")
    links = F.split_part("value", F.lit("\t"), F.lit(2))
    return lines.select(
        F.try_element_at(key, F.lit(1)).try_cast("long").alias("id"),
        F.try_element_at(key, F.lit(2)).try_cast("double").alias("rank"),
        F.when(links == "", F.array().cast("array<bigint>"))
        .otherwise(F.split(links, ",").try_cast("array<bigint>"))
        .alias("links"),
    )
