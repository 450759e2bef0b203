"""Verdicts on URLs: host and path rules first, gradient-boosted trees for the URLs no rule fits.

The URLs that a rule fits are the labelled ones. Trees are trained on a bounded sample of them; the statistics
of host and path suffixes cover every URL.

Defined cases: a null URL has an empty host and path, no rule, and the trees' verdict on an empty text. Repeated rows and
keys each get their row. Without labelled URLs, or with labels of one kind only, the verdict is that kind (``allow``
without any). Other columns of the input are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import checked
from pagelode.session import materialise

# Fixed values: (verdict, host, path) of the contract's rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Labelled URLs the trees are trained on, at most; drawn by hash of the URL, so a rerun draws the same.
TRAIN_ROWS = 20_000
#: Labelled URLs that the average block rate counts for in the block rate of a suffix.
PRIOR = 10.0
TREES, DEPTH = 20, 4

FEATURES = [
    "n_chars", "n_host", "n_path", "host_depth", "path_depth", "digits", "punctuation", "entropy", "n_parameters",
    "host_seen", "host_rate", "path_seen", "path_rate",
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and path (from there up to ``? #``)."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as a struct ``verdict, rule``, else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, where, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == where) | F.endswith(host, F.lit("." + where))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(where + start).alias("rule"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits a character. A pass over the text for each distinct character, never for each pair."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    bits = F.transform(letters, lambda c: -share(c) * F.log2(share(c)))
    return F.when(n > 0, F.aggregate(bits, F.lit(0.0), lambda total, b: total + b)).otherwise(0.0)


def lexical(rows: DataFrame, keep: list[str], url: str = "url", rules=RULES) -> DataFrame:
    """``keep`` as ``k0, k1, ...``, and of each URL: host, path, rule, verdict of the rule, label (1.0 for block), suffixes, and the features
    of its text alone."""
    text = F.coalesce(F.col(url), F.lit(""))
    rows = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text.alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    text, host, path = F.col("url"), F.col("host"), F.col("path")
    n = F.length(text)
    count = lambda column, pattern: F.regexp_count(column, F.lit(pattern)).cast("double")
    share = lambda pattern: F.when(n > 0, count(text, pattern) / n).otherwise(0.0)
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    return rows.select(
        *[f"k{i}" for i in range(len(keep))],
        "url",
        "host",
        "path",
        F.col("fits.rule").alias("rule"),
        F.col("fits.verdict").alias("ruled"),
        F.when(F.col("fits.verdict") == "block", 1.0).when(F.col("fits").isNotNull(), 0.0).alias("label"),
        F.regexp_extract(host, "[^.]*$", 0).alias("host_suffix"),
        F.regexp_extract(path, "[.]([^./]*)$", 1).alias("path_suffix"),
        n.cast("double").alias("n_chars"),
        F.length(host).cast("double").alias("n_host"),
        F.length(path).cast("double").alias("n_path"),
        count(host, "[.]").alias("host_depth"),
        count(path, "/").alias("path_depth"),
        share("[0-9]").alias("digits"),
        share("[^0-9A-Za-z]").alias("punctuation"),
        _entropy(text).alias("entropy"),
        F.when(query == "", 0.0).otherwise(count(query, "&") + 1).alias("n_parameters"),
    )


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """``kind, suffix, seen, rate``, written: for each last label of a host and each ending of a path, how many of all URLs
    have it, and the share of block among its labelled ones, drawn to the share among all by ``PRIOR`` URLs."""
    kinds = F.inline(
        F.array(
            F.struct(F.lit("host").alias("kind"), F.col("host_suffix").alias("suffix")),
            F.struct(F.lit("path").alias("kind"), F.col("path_suffix").alias("suffix")),
        )
    )
    counts = labelled.select("label", kinds).groupBy("kind", "suffix").agg(
        F.count(F.lit(1)).alias("seen"), F.count("label").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")
    )
    counts = materialise(counts, "suffixes")
    n, blocked = counts.where("kind = 'host'").agg(F.sum("n"), F.sum("blocked")).first()
    share = blocked / n if n else 0.0
    return counts.select("kind", "suffix", "seen", ((F.col("blocked") + PRIOR * share) / (F.col("n") + PRIOR)).alias("rate"))


def with_statistics(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """The suffix features, joined on; the statistics are broadcast if their counted size allows it."""
    for kind in ("host", "path"):
        own = statistics.where(F.col("kind") == kind).select(
            F.col("suffix").alias(f"{kind}_suffix"), F.log1p("seen").alias(f"{kind}_seen"), F.col("rate").alias(f"{kind}_rate")
        )
        rows = rows.join(checked(own), f"{kind}_suffix", "left").fillna(0.0, [f"{kind}_seen", f"{kind}_rate"])
    return rows


def train(rows: DataFrame, most: int = TRAIN_ROWS) -> GBTClassificationModel | float:
    """Trees fitted to at most ``most`` of the labelled ``rows``, or the only label there is (0.0 without any)."""
    drawn = rows.where("label IS NOT NULL").orderBy(F.xxhash64("url"), "url").limit(most)
    drawn = materialise(drawn.select("label", *FEATURES), "labelled")
    labels = sorted(r[0] for r in drawn.select("label").distinct().collect())
    if len(labels) < 2:
        return labels[0] if labels else 0.0
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=13)
    return trees.fit(_vectors(drawn))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def predicted(rows: DataFrame, model: GBTClassificationModel | float) -> DataFrame:
    """``rows`` with ``prediction``: 1.0 for block."""
    if isinstance(model, float):
        return rows.withColumn("prediction", F.lit(model))
    return model.transform(_vectors(rows)).drop("features", "rawPrediction", "probability")


def judge(pages: DataFrame, keep: list[str], url: str = "url", rules=RULES, most: int = TRAIN_ROWS) -> DataFrame:
    """Every row's ``keep`` columns with ``host, path, rule, verdict``."""
    rows = lexical(pages, keep, url, rules)
    rows = with_statistics(rows, suffix_statistics(rows))
    judged = predicted(rows, train(rows, most))
    verdict = F.coalesce("ruled", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
    names = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return judged.select(*names, "host", "path", "rule", verdict.alias("verdict"))
