"""Page extraction from stored HTML.

Two routes give the same fields. Column expressions serve regular markup and stay in the JVM;
:func:`extract_pages` parses each page once in Arrow batches and handles nesting, selectors and
malformed markup.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import htmltree, urls
from pagelode.session import limit_arrow_batches

cloudpickle.register_pickle_by_value(htmltree)

EXTRACT_SCHEMA = (
    "page_id bigint, url string, found boolean, title string, content string, "
    "categories array<string>, footer string, hrefs array<string>"
)

# The footer sentence with the last edit, and its date format.
EDITED_ON = "edited on ([^,]*), at ([^.]*)"
EDITED_FORMAT = "d MMMM yyyy HH:mm"


def unescape(text: Column) -> Column:
    """Character references of regular markup; the parser route knows all of them."""
    for pattern, char in (
        ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "'"), ("&nbsp;?", " "), ("&amp;?", "&"),
    ):
        text = F.regexp_replace(text, pattern, char)
    return text


def element_text(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element, tags dropped; '' where there is none."""
    inner = F.regexp_extract(html, f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>", 1)
    return F.trim(unescape(F.regexp_replace(inner, "<[^>]*>", "")))


def element_body(html: Column, tag: str) -> Column:
    """Body of the ``tag`` element with each tag replaced by a space."""
    inner = F.regexp_extract(html, f"(?s)<{tag}(?:\\s[^>]*)?>(.*)</{tag}>", 1)
    return F.trim(unescape(F.regexp_replace(inner, "<[^>]*>", " ")))


def list_items(html: Column, block: str) -> Column:
    """Trimmed text of the list items below the first ``block`` element."""
    inner = F.regexp_extract(html, f"(?s)<{block}(?:\\s[^>]*)?>(.*?)</{block}>", 1)
    items = F.regexp_extract_all(inner, F.lit("(?s)<li(?:\\s[^>]*)?>(.*?)</li>"), F.lit(1))
    return F.transform(items, lambda i: F.trim(unescape(F.regexp_replace(i, "<[^>]*>", ""))))


def hrefs(html: Column, block: str) -> Column:
    """``href`` values of the links below the first ``block`` element."""
    inner = F.regexp_extract(html, f"(?s)<{block}(?:\\s[^>]*)?>(.*?)</{block}>", 1)
    found = F.regexp_extract_all(inner, F.lit('<a\\s[^>]*?href="([^"]*)"'), F.lit(1))
    return F.transform(found, unescape)


def last_modified(footer: Column, default: Column) -> Column:
    """Timestamp of the last edit named in the footer; ``default`` (the time of the run) where
    there is none or it cannot be read."""
    day = F.regexp_extract(footer, EDITED_ON, 1)
    time = F.regexp_extract(footer, EDITED_ON, 2)
    parsed = F.try_to_timestamp(F.concat_ws(" ", day, time), F.lit(EDITED_FORMAT))
    return F.when(day == "", default).otherwise(F.coalesce(parsed, default))


def extract_pages(pages: DataFrame, selectors: htmltree.Selectors | None = None) -> DataFrame:
    """Parse ``(page_id, url, html)`` once per page: title, content, categories, footer markup
    and link targets. ``found`` is false where a required block is missing."""
    rules = selectors or htmltree.Selectors()
    limit_arrow_batches(pages.sparkSession, 200, 2 << 20)  # a batch holds whole pages and what was found in them
    extract = htmltree.extract

    def parse(batches):
        for batch in batches:
            rows = [extract(html, rules) for html in batch["html"]]
            out = batch[["page_id", "url"]].copy()
            for i, name in enumerate(("found", "title", "content", "categories", "footer", "hrefs")):
                out[name] = [row[i] for row in rows]
            yield out

    return pages.select("page_id", "url", "html").mapInPandas(parse, EXTRACT_SCHEMA)


def page_rows(
    pages: DataFrame, run_time: Column, host_regex: str, path_regex: str, selectors: htmltree.Selectors | None = None
) -> DataFrame:
    """Stored HTML to the whole page row in one call: ``page_id, url, title, content, categories, last_modified, out_links``. Pages without
    a title, content or category give no row. A footer without a readable date counts as edited at ``run_time``; out-links are the
    titles that the page's links name within the scope of the two patterns. Works on a stream too."""
    found = drop_empty(extract_pages(pages, selectors).filter("found"))
    absolute = F.transform("hrefs", lambda h: urls.resolve_href(F.col("url"), h))
    return found.select(
        "page_id",
        "url",
        "title",
        "content",
        "categories",
        last_modified(F.coalesce("footer", F.lit("")), run_time).alias("last_modified"),
        urls.link_titles(absolute, host_regex, path_regex).alias("out_links"),
    )


def drop_empty(pages: DataFrame) -> DataFrame:
    """Keep pages that have content and at least one category."""
    return pages.filter((F.col("content") != "") & (F.size("categories") > 0))
