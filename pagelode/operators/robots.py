"""robots.txt rules and the URL filter they give.

``lines`` is ``(host, line_no, line)``; the agent is one name for the whole job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions.urls import url_part
from pagelode.operators.joins import spread_join

# The line patterns, a mandatory space after the colon, value up to '#'.
DIRECTIVE = r"(?i)(User-agent: |Allow: |Disallow: )([^#]*)"


def wildcard_regex(wildcard: Column) -> Column:
    """Agent wildcard to a whole-string pattern: '*' any text, '?' one character."""
    quoted = F.regexp_replace(wildcard, r"([()\[\]$^.{}|\\])", r"\\$1")
    return F.concat(F.lit(r"\A"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit(r"\z"))


def robots_rules(lines: DataFrame, agent: str) -> DataFrame:
    """``host, ord, path, allow``: rules that apply to ``agent``, in order. Each agent line
    replaces the match state; a repeated path keeps its first place and takes its last value.
    The window is per host and bounded by the length of its robots.txt."""
    line = F.trim("line")
    kind = F.lower(F.regexp_extract(line, DIRECTIVE, 1))
    parsed = lines.select("host", "line_no", kind.alias("kind"), F.regexp_extract(line, DIRECTIVE, 2).alias("value"))
    parsed = parsed.filter(F.col("kind") != "")
    names_agent = F.rlike(F.lit(agent), wildcard_regex(F.trim("value")))
    state = F.when(F.col("kind") == "user-agent: ", names_agent)
    so_far = Window.partitionBy("host").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    active = parsed.withColumn("active", F.last(state, ignorenulls=True).over(so_far))
    rules = active.filter((F.col("kind") != "user-agent: ") & F.col("active")).select(
        "host",
        "line_no",
        F.trim(F.try_url_decode("value")).alias("path"),
        (F.col("kind") == "allow: ").alias("allow"),
    )
    return rules.groupBy("host", "path").agg(
        F.min("line_no").alias("ord"), F.max_by("allow", "line_no").alias("allow")
    ).select("host", "ord", "path", "allow")


def robots_filter(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``allowed`` to ``urls(url)``: the first rule whose path is a prefix of the URL's path
    and query decides; no rule, or another host, allows. The rules of a host travel as one array,
    so a URL stays one row: no pairs of URL and rule are made."""
    per_host = rules.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("ord", "path", "allow"))).alias("__rules")
    )
    parts = urls.withColumn("host", url_part(F.col("url"), "HOST")).withColumn(
        "__file", url_part(F.col("url"), "FILE")
    )
    joined = spread_join(parts, per_host, ["host"], [F.col("url")], "left")
    hit = F.filter("__rules", lambda r: F.startswith(F.col("__file"), r["path"]))
    return joined.select(
        *urls.columns, F.coalesce(F.try_element_at(hit, F.lit(1))["allow"], F.lit(True)).alias("allowed")
    )
