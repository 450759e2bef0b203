"""Tokens, normalisation, stop words, query text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token delimiters (space, tab, line feed, carriage return, form feed) and the
# stop words removed from the ranked index and from its queries.
DELIMITERS = r"[ \t\n\r\f]+"
DELIMITER_BYTES = b" \t\n\r\f"
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "would should could ought cannot a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very"
).split()

# Stop words of the full-text analyser.
FULLTEXT_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then "
    "there these they this to was will with"
).split()
#: Longer words of the full-text analyser are cut into pieces of this length.
FULLTEXT_LONGEST = 255

# Classes of the published rules for Unicode word breaks (UAX 29). Marks and format characters belong to the
# character before them; the second to fourth join letters, numbers, or both, where one stands on each side.
_MARK = r"\p{M}\u00AD\u200C-\u200F\u202A-\u202E\u2060-\u2064\uFEFF"
_MID_LETTER = r":\u00B7\u0387\u05F4\u2027\uFE13\uFE55\uFF1A"
_MID_NUMBER = r",;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B"
_MID_BOTH = r"'.\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
_JOINER = r"_\u203F\u2040\u2054\uFE33\uFE34\uFE4D-\uFE4F\uFF3F"
_KATAKANA = r"\p{IsKatakana}\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70"
_UNSPACED = r"\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}"
_HEBREW = r"\u05D0-\u05EA\u05EF-\u05F2"


def _word_pattern() -> str:
    """A word as those rules find it: letters and numbers that touch, with what joins them; a run of Katakana; a run of a
    script that is written without spaces; one Han or Hiragana character. Every repeat of a group is possessive:
    Java matches a plain one by recursion, and a text may be one word of a megabyte."""
    others = rf"[^\p{{IsHan}}\p{{IsHiragana}}{_KATAKANA}{_UNSPACED}]"
    run = lambda first, more: rf"[{first}][{more}{_MARK}]*+"
    letters = rf"[\p{{L}}\p{{Nl}}&&{others}][\p{{L}}\p{{Nl}}{_MARK}&&{others}]*+"
    letters += rf"(?:[{_MID_LETTER}{_MID_BOTH}][{_MARK}]*+{letters})*+"
    # After a Hebrew letter an apostrophe belongs to the word, and a quotation mark if another one follows.
    letters += rf"(?:(?<=[{_HEBREW}])(?:'|\"(?=[{_HEBREW}])))?+"
    numbers = run(r"\p{Nd}", r"\p{Nd}")
    numbers += rf"(?:[{_MID_NUMBER}{_MID_BOTH}][{_MARK}]*+{numbers})*+"
    joiner = run(_JOINER, _JOINER)
    group = rf"(?:{run(_KATAKANA, _KATAKANA)}|(?:{letters}|{numbers})++)"
    word = rf"(?:{joiner})?+{group}(?:{joiner}{group})*+(?:{joiner})?+"
    return rf"{word}|{run(_UNSPACED, _UNSPACED)}|[\p{{IsHan}}\p{{IsHiragana}}][{_MARK}]*+"


FULLTEXT_WORD = _word_pattern()
# Most words are runs of simple letters and digits before a character that neither belongs to a word nor joins two; these are found
# without the classes above. Up to eight characters that start no word are passed over in the match of the next one.
_BREAK = r" \t\n\r\f!?()\"#$%&*+\-/<=>@\[\\\]^`{|}~"
_SIMPLE = r"[a-z0-9\u00DF-\u00F6\u00F8-\u00FF]"
#: As ``FULLTEXT_WORD``, in group 1, for lower-cased texts.
FULLTEXT_WORDS = rf"[{_BREAK}.,;:']{{0,8}}+({_SIMPLE}++(?=[{_BREAK}]|\z|[.,;:'](?:[{_BREAK}]|\z))|{FULLTEXT_WORD})"

CATEGORY_MARKER = "category:"


def tokens(text: Column) -> Column:
    """Whitespace tokens of ``text``; index in the array is the token position."""
    return F.array_remove(F.split(text, DELIMITERS), "")


def first_tokens(text: Column, n: int) -> Column:
    """The first ``n`` of the whitespace tokens; the text after them is not looked at."""
    blank = DELIMITERS.removesuffix("+")
    return F.slice(tokens(F.regexp_extract(text, rf"\A(?:{blank}*+[^{blank[1:]}++){{0,{n}}}+", 0)), 1, n)


def trim_controls(text: Column) -> Column:
    """Drop spaces and control characters (up to U+0020) at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def normalize_token(token: Column) -> Column:
    """Drop ASCII punctuation at both ends, trim, lower-case."""
    return F.lower(trim_controls(F.regexp_replace(token, r"^\p{Punct}*|\p{Punct}*$", "")))


def is_alnum(token: Column) -> Column:
    """Whole token is ASCII letters and digits."""
    return token.rlike(r"\A[A-Za-z0-9]+\z")


def is_stop_word(token: Column) -> Column:
    return token.isin(STOP_WORDS)


def indexable_token(lowered: Column) -> Column:
    """Normalised form of an already lower-cased token, or '' where it is not wholly
    alphanumeric: :func:`normalize_token` and :func:`is_alnum` in a single match."""
    inner = F.regexp_extract(
        lowered, r"\A\p{Punct}*[\x00-\x20]*([a-z0-9]+)[\x00-\x20]*\p{Punct}*\z", 1
    )
    return F.when(lowered.rlike(r"\A[a-z0-9]+\z"), lowered).otherwise(inner)


def fulltext_words(text: Column) -> Column:
    """Word-break tokens, lower-cased; index in the array is the position. A word over ``FULLTEXT_LONGEST`` is cut there, and what follows
    a cut starts at its next letter or digit."""
    found = F.regexp_extract_all(F.lower(text), F.lit(FULLTEXT_WORDS), F.lit(1))
    cut = lambda w: F.regexp_extract_all(w, F.lit(rf"(?s)[{_MID_LETTER}{_MID_NUMBER}{_MID_BOTH}]*+(.{{1,{FULLTEXT_LONGEST}}})"), F.lit(1))
    again = lambda piece: F.regexp_extract(piece, FULLTEXT_WORD, 0)
    pieces = lambda w: F.array_remove(F.transform(cut(w), again), "")
    long = lambda w: F.length(w) > FULLTEXT_LONGEST
    shortened = lambda words: F.when(
        F.exists(words, long), F.flatten(F.transform(words, lambda w: F.when(long(w), pieces(w)).otherwise(F.array(w))))
    ).otherwise(words)
    # The words are used three times but found once: as the item of an array.
    return F.get(F.transform(F.array(found), shortened), F.lit(0))


def category_text(categories: Column) -> Column:
    """Category list as one lower-cased text field."""
    return F.lower(F.array_join(categories, " "))


def keyword_part(query: Column) -> Column:
    """Text left of the first category marker (trimmed if the marker is there), lower-cased."""
    at = F.instr(query, CATEGORY_MARKER)
    return F.lower(F.when(at > 0, trim_controls(F.substring(query, F.lit(1), at - 1))).otherwise(query))


def category_part(query: Column) -> Column:
    """Text right of the first category marker, trimmed and lower-cased, else ''."""
    at = F.instr(query, CATEGORY_MARKER)
    rest = F.substring(query, at + len(CATEGORY_MARKER), F.length(query))
    return F.lower(F.when(at > 0, trim_controls(rest)).otherwise(F.lit("")))


def split_words(text: Column) -> Column:
    """Query words: split at single spaces, each trimmed, empty ones dropped."""
    return F.array_remove(F.transform(F.split(text, " "), trim_controls), "")
