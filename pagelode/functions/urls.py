"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Scheme, host (without user and port), path, query.
URL_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)(\?[^#]*)?"
_GROUPS = {"PROTOCOL": 1, "HOST": 2, "PATH": 3, "QUERY": 4}


def url_part(url: Column, part: str) -> Column:
    """One part of an absolute URL, '' if it is not there. Split by pattern: links in real pages
    hold characters that a strict URL parser rejects."""
    if part == "FILE":
        return F.concat(url_part(url, "PATH"), url_part(url, "QUERY"))
    return F.regexp_extract(url, URL_PATTERN, _GROUPS[part])


def canonical_url(url: Column) -> Column:
    """Protocol, host, path and query; the anchor is dropped."""
    return F.concat(url_part(url, "PROTOCOL"), F.lit("://"), url_part(url, "HOST"), url_part(url, "FILE"))


def in_scope(url: Column, host_regex: str, path_regex: str) -> Column:
    """Host and path both match their pattern as a whole."""
    return url_part(url, "HOST").rlike(rf"\A(?:{host_regex})\z") & url_part(url, "PATH").rlike(
        rf"\A(?:{path_regex})\z"
    )


def resolve_href(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` for the cases found in pages: absolute URL, protocol-relative,
    root-relative, anchor or query only, and relative to the folder of ``base``; NULL for other
    schemes."""
    origin = F.concat(url_part(base, "PROTOCOL"), F.lit("://"), url_part(base, "HOST"))
    path = url_part(base, "PATH")
    folder = F.regexp_replace(path, "[^/]*$", "")
    return (
        F.when(href.rlike("^(?i)https?://"), href)
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(href.startswith("//"), F.concat(url_part(base, "PROTOCOL"), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.rlike("^[#?]") | (href == ""), F.concat(origin, path, href))
        .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), href))
    )


def link_titles(urls: Column, host_regex: str, path_regex: str) -> Column:
    """Titles named by an array of absolute URLs: keep in-scope ones, percent-decode the path,
    take the capture group of ``path_regex`` from the decoded path, underscores to spaces,
    distinct in order."""
    kept = F.filter(urls, lambda u: u.isNotNull() & in_scope(u, host_regex, path_regex))
    decoded = F.transform(kept, lambda u: F.try_url_decode(url_part(u, "PATH")))
    inside = F.filter(decoded, lambda p: p.rlike(path_regex))
    names = F.transform(inside, lambda p: F.translate(F.regexp_extract(p, path_regex, 1), "_", " "))
    return F.array_distinct(names)


def result_link(title: Column, base: str) -> Column:
    return F.concat(F.lit(base), F.translate(title, " ", "_"))
