"""Highlighting, snippets, links and pages of results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_BREAK = r"[,;.\n]"
SNIPPET_SENTENCES = 5
FRAGMENT_CHARS = 100
PER_PAGE = 10
# Where result links point.
PAGE_BASE = "https://en.wikipedia.org/wiki/"
CATEGORY_BASE = "https://en.wikipedia.org/wiki/Category:"


def quoted(word: Column) -> Column:
    """Pattern matching ``word`` literally."""
    return F.concat(F.lit(r"\Q"), F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def highlight(text: Column, words: Column, tag: str) -> Column:
    """Wrap every case-insensitive occurrence of each word in ``tag``; words are applied one
    after another, so a later word also sees the tags put in by earlier ones."""
    return F.aggregate(
        words,
        text,
        lambda t, w: F.regexp_replace(t, F.concat(F.lit("(?i)"), quoted(w)), F.lit(f"<{tag}>$0</{tag}>")),
    )


def sentences(text: Column) -> Column:
    bare = F.regexp_replace(text, f"{SENTENCE_BREAK}+\\z", "")
    return F.when((bare == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(bare, SENTENCE_BREAK))


def coverage(sentence: Column, words: Column) -> Column:
    """20 times the least count of any word plus the sum of all counts; a word counts where it
    stands between spaces."""
    counts = F.transform(words, lambda w: F.regexp_count(sentence, F.concat(F.lit("(?i)[ ]+"), quoted(w), F.lit("[ ]+"))))
    return F.coalesce(F.array_min(counts), F.lit(0)) * 20 + F.aggregate(counts, F.lit(0), lambda a, x: a + x)


def _joined(parts: Column) -> Column:
    tidy = F.transform(
        parts, lambda s: F.regexp_replace(F.regexp_replace(s, r"\r\n|\r|\n", " "), "[ ]+", " ")
    )
    return F.concat(F.lit("... "), F.array_join(tidy, " ... "), F.lit(" ..."))


def snippet(text: Column, words: Column) -> Column:
    """The five best sentences by word coverage, highlighted; ties keep text order."""
    ranked = F.sort_array(
        F.transform(sentences(text), lambda s, i: F.struct((-coverage(s, words)).alias("k"), i.alias("i"), s.alias("s")))
    )
    best = F.slice(ranked, 1, SNIPPET_SENTENCES)
    return _joined(F.transform(best, lambda e: highlight(e["s"], words, "b")))


def fulltext_snippet(text: Column, words: Column) -> Column:
    """The five best fragments of about 100 characters by distinct query words, with the words
    in bold; fragments without any query word are left out."""
    fragments = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{FRAGMENT_CHARS}}}(?=\\s|\\z)|\\S+"), F.lit(0))
    whole_word = lambda w: F.concat(F.lit(r"(?iU)(?<!\w)"), quoted(w), F.lit(r"(?!\w)"))
    found = lambda s: F.size(F.filter(F.array_distinct(words), lambda w: F.rlike(s, whole_word(w))))
    ranked = F.filter(
        F.transform(fragments, lambda s, i: F.struct((-found(s)).alias("k"), i.alias("i"), s.alias("s"))),
        lambda e: e["k"] < 0,
    )
    best = F.slice(F.sort_array(ranked), 1, SNIPPET_SENTENCES)
    # One pattern over all words, so that a word cannot match inside an inserted tag.
    anyword = F.concat(
        F.lit(r"(?iU)(?<!\w)(?:"), F.array_join(F.transform(words, quoted), "|"), F.lit(r")(?!\w)")
    )
    bold = F.transform(best, lambda e: F.regexp_replace(e["s"], anyword, F.lit("<B>$0</B>")))
    return _joined(bold)


def page_count(n_results: Column) -> Column:
    return F.ceil(n_results / PER_PAGE).cast("int")


def clamped_page(requested: Column, total_pages: Column) -> Column:
    """Page number from 1, moved into range."""
    return F.greatest(F.lit(1), F.least(requested, total_pages))


def requested_page(text: Column) -> Column:
    """Page parameter of a request: missing or unreadable means the first."""
    return F.coalesce(text.try_cast("int"), F.lit(1))
