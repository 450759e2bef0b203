"""Quality rules judged by host: failures are summed by domain, their rates shrunk by a beta prior
fitted to all domains, and the verdict on a domain is joined back to its documents.

Defined results: a null or empty text has no words and fails the length rule; a null host is a host
of its own; repeated rows and ids count as often as they occur; an empty table gives an empty result;
further columns pass through unless they bear the name of a result column, which replaces them."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.llm.common import checked
from pagelode.session import materialise

#: A document fails below so many words, or if more than this percentage of them repeats.
MIN_WORDS, REPEATS_PERCENT = 50, 50
#: Rules that count against a host only, in percent: symbols of words, repeated lines of words.
SYMBOLS_PERCENT, LINES_PERCENT = 30, 10
#: A host is rejected if the shrunken failure rate of any rule reaches this.
HOST_REJECT = 0.5
#: Largest weight of the prior in documents, where the hosts' rates hardly differ.
PRIOR_LIMIT = 1e6

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["short", "repeats", "symbols", "lines"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the list. Words and
    windows are renumbered exactly, without hashing."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    word = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code, top = word[:n], len(number)
    for i in range(1, width):
        if top > 1 << 31:
            code = np.unique(code, return_inverse=True)[1]
            top = int(code.max()) + 1
        code, top = code * len(number) + word[i : n + i], top * len(number)
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words) + 1, np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered)[: len(words)] > 0).sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    raw = np.frombuffer(text, np.uint8)
    words = text.split()
    characters = int(((raw & 0xC0) != 0x80).sum() - _SPACE[raw].sum())
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(words), characters, int(_SYMBOL[raw].sum()), len(lines) - len(set(lines)), repeated_words(words)


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measures(texts: pd.Series) -> pd.DataFrame:
    rows = [measure(None if t is None else t.encode()) for t in texts]
    return pd.DataFrame(rows, columns=MEASURES, dtype="int64")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five measures of the whole text and ``base_failed``."""
    kept = [c for c in docs.columns if c not in (*MEASURES, "base_failed", "kept", "__q")]
    found = docs.select(*kept, _measures(F.col(text)).alias("__q")).select(*kept, "__q.*")
    return found.withColumn("base_failed", _failures()["short"] | _failures()["repeats"])


def _failures() -> dict:
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEATS_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > SYMBOLS_PERCENT * n,
        "lines": 100 * F.col("n_dup_lines") > LINES_PERCENT * n,
    }


def host_verdicts(docs: DataFrame, host: str) -> DataFrame:
    """A row for each host: ``__host, n``, failures and shrunken rate of each rule, ``rejected``.

    ``docs`` has the measures. The prior is beta-binomial by the method of moments for unequal
    sizes: with m hosts, N documents, mean rate u and S the sum of n * (rate - u) ** 2, the correlation is
    (S / (u * (1 - u)) - (m - 1)) / (N - sum(n * n) / N - (m - 1)), and the prior's weight in documents
    is its odds reversed. Sums over hosts are one row; nothing but that row reaches the driver."""
    failed = _failures()
    hosts = docs.groupBy(F.col(host).alias("__host")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(failed[r].cast("long")).alias(r) for r in RULES]
    )
    hosts = materialise(hosts, "hosts")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("N"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        *[F.sum(r).alias(r) for r in RULES],
        *[F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in RULES],
    ).first()
    for rule in RULES:
        mean, weight = prior(sums["m"], sums["N"], sums["nn"], sums[rule], sums[f"{rule}_sq"])
        hosts = hosts.withColumn(f"{rule}_rate", (F.col(rule) + mean * weight) / (F.col("n") + weight))
    worst = F.greatest(*[F.col(f"{r}_rate") for r in RULES])
    return hosts.withColumn("rejected", worst >= HOST_REJECT)


def prior(hosts: int, total: int | None, squares: float | None, failures: int | None, spread: float | None) -> tuple[float, float]:
    """Mean and weight of the beta prior from sums over hosts."""
    if not total or not failures or failures == total:
        return (0.0 if not total else failures / total), PRIOR_LIMIT if total else 0.0
    u = failures / total
    within = u * (1 - u)
    room = total - squares / total - (hosts - 1)
    rho = ((spread - failures * failures / total) / within - (hosts - 1)) / room if room > 0 else 0.0
    return u, min(PRIOR_LIMIT, (1 - rho) / rho) if rho > 0 else PRIOR_LIMIT


def quality_by_host(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with measures, ``base_failed``, the host's rates and ``kept``: neither the document
    nor its host is rejected. Texts are measured twice, once to sum up hosts and once for the
    result, so that no text is shuffled or written; hosts join by broadcast while they fit it, and
    by a sort-merge join that adaptive execution splits beyond."""
    verdicts = host_verdicts(measured(docs.select(text, host), text), host)
    verdicts = materialise(verdicts.select("__host", "rejected", *[f"{r}_rate" for r in RULES]), "verdicts")
    found = measured(docs, text)
    clash = [c for c in found.columns if c in verdicts.columns]
    joined = found.drop(*clash).join(checked(verdicts), F.col(host).eqNullSafe(F.col("__host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).drop("__host", "rejected")
