"""Personal data by weak supervision, as DataFrame expressions only.

Four kinds are found by pattern (the base spans, always kept). Further candidates are digit groups
that fail the card check but follow a cue word, telephone numbers without a country code and spelled-out addresses. Five
labelers vote on every span and candidate: pattern, gazetteer, context words, separation from the
neighbours, and shape. Votes are counted over the whole table by vote pattern (a few thousand at
most), expectation-maximisation estimates how reliable each labeler is, a logistic classifier is
trained on the resulting probabilities, and candidates that it is sure of are added.

Positions count code points. Defined results: a null or empty text has no spans; repeated rows give
repeated rows; an empty table gives an empty result; columns pass through unless they bear the name of a
result column, which replaces them."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the result, and the sources of candidates with the kind they give.
KINDS = ("email", "ip", "card", "phone")
SOURCES = {"email": "email", "ip": "ip", "card": "card", "phone": "phone", "spelled": "email", "national": "phone"}
LABELERS = ("pattern", "gazetteer", "context", "apart", "shape")
#: Probability from which a candidate is added.
SURE = 0.9
#: Characters before a span in which context words are looked for.
NEAR = 40

# The patterns of the kinds, each equal to the plain one given beside it, written so that matching
# takes time in proportion to the text: runs are entered at their start, or where the last match ended.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+)++",
    "national": r"(?<![0-9A-Za-z+.-])(?<!\+[0-9]{1,3} )(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z-])",
}
#: What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "spelled": "at", "national": None}

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"

# Gazetteers: common top-level domains, issuer prefixes with their lengths, calling codes.
_DOMAINS = r"(?i)(?:\.|\bdot\b\W*)(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|us|eu|ch|at|nl|pl|ru|cn|jp|br|in|ca|au)\W*$"
_RESERVED = r"^0*(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|^0*192\.0*168\.|^0*169\.0*254\.|^0*172\.0*(?:1[6-9]|2[0-9]|3[01])\."
_ISSUERS = r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|6(?:011|5[0-9]{2})[0-9]{12})$"
_CODES = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_CUES = {
    "email": r"(?i)e-?mail|mail|contact|kontakt|correo|courriel|write to",
    "ip": r"(?i)\bip\b|address|host|server|adresse|login|client",
    "card": r"(?i)card|visa|master|credit|karte|carte|tarjeta|pay",
    "phone": r"(?i)tel|phone|call|mobile|fax|contact|ruf|appel",
}
_AGAINST = r"(?i)version|token|serial|order|isbn|invoice|build|hash|secret|key|http|www|v\.?\s*$"


def running_sums(lengths: Column) -> Column:
    """Running sums of an array, in blocks of 256 so that long arrays are not copied for each item."""
    block = 256
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block)), lambda b: F.slice(lengths, (b * block + 1).cast("int"), block))
    blocks = F.when(F.size(lengths) > 0, blocks).otherwise(F.array(F.array().cast("array<int>")))
    append = lambda base: lambda a, x: F.array_append(a, F.coalesce(F.element_at(a, -1), base) + x)
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    starts = F.aggregate(totals, F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
    running = F.zip_with(
        blocks,
        F.slice(starts, 1, F.size(blocks)),
        lambda b, s: F.slice(F.aggregate(b, F.array(s), lambda a, x: F.array_append(a, F.element_at(a, -1) + x)), 2, F.size(b)),
    )
    return F.flatten(running)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check: every second from the right doubled, its digits summed."""

    def add(total, i):
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, 0 against, -1 no vote."""
    return F.when(yes, 1).when(no if no is not None else ~yes, 0).otherwise(-1)


def _judged(source: str, match: Column, before: Column, after: Column) -> dict[str, Column]:
    """Whether a match is a base span, whether it is considered at all, and the five votes."""
    kind, yes, digits = SOURCES[source], F.lit(True), _digits(match)
    none = F.lit(-1)
    count = F.length(digits)
    base = {"email": yes, "ip": match.rlike(_IP), "card": count.between(13, 19) & luhn(digits), "phone": count.between(9, 15)}.get(source, F.lit(False))
    considered = {"card": count.between(13, 19) & (luhn(digits) | before.rlike(_CUES["card"])), "spelled": yes, "national": yes}.get(source, base)
    gazetteer = {
        "email": _vote(match.rlike(_DOMAINS)),
        "ip": _vote(~match.rlike(_RESERVED)),
        "card": _vote(digits.rlike(_ISSUERS)),
        "phone": _vote(digits.rlike(_CODES)) if source == "phone" else _vote(digits.rlike("^[2-9]")),
    }[kind]
    shape = {
        "email": _vote(match.rlike("^[^@]*[A-Za-z]")),
        "ip": _vote(~match.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(match.rlike("^[0-9]{16}$|^[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{4}$|^[0-9]{15}$|^[0-9]{4}([ -])[0-9]{6}\\2[0-9]{5}$")),
        "phone": _vote(match.rlike("[ ().-]")),
    }[kind]
    return {
        "base": base,
        "considered": considered,
        "pattern": none if source in ("spelled", "national") else _vote(base),
        "gazetteer": gazetteer,
        "context": _vote(before.rlike(_CUES[kind]), before.rlike(_AGAINST)),
        "apart": _vote(~(F.substring(before, -1, 1).rlike("[A-Za-z0-9]") | after.rlike("[A-Za-z0-9]"))),
        "shape": shape,
    }


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with an array of judged matches for each source, ``__c_<source>``. A match's place is the
    running sum of what lies between matches and of the matches before it."""
    whole = F.coalesce(F.col(text), F.lit(""))
    cut: dict[str, Column] = {}
    nothing = F.array().cast("array<string>")
    for source, pattern in PATTERNS.items():
        tried = whole.contains(NEEDS[source]) if NEEDS[source] else whole.rlike("[0-9]{3}")
        if source in ("ip", "card"):
            tried = whole.rlike(r"[0-9]\.[0-9]" if source == "ip" else "[0-9][ -]?[0-9]")
        cut[f"__m_{source}"] = F.when(tried, F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))).otherwise(nothing)
    # Most texts have no match of a kind; only those that have one are cut at them.
    found = docs.withColumns(cut)
    has = lambda s: F.size(f"__m_{s}") > 0
    found = found.withColumns({f"__g_{s}": F.when(has(s), F.split(whole, PATTERNS[s], -1)).otherwise(nothing) for s in PATTERNS})
    steps = {
        s: F.zip_with(F.slice(f"__g_{s}", 1, F.greatest(F.size(f"__m_{s}"), F.lit(0))), F.col(f"__m_{s}"), lambda g, m: F.length(g) + F.length(m))
        for s in PATTERNS
    }
    found = found.withColumns({f"__l_{s}": F.when(has(s), steps[s]).otherwise(F.array().cast("array<int>")) for s in PATTERNS})
    found = found.withColumns(
        {f"__e_{s}": F.when(has(s), running_sums(F.col(f"__l_{s}"))).otherwise(F.array().cast("array<int>")) for s in PATTERNS}
    )

    def judged(source):
        def one(match, i):
            gaps = F.col(f"__g_{source}")
            end = F.get(F.col(f"__e_{source}"), i)
            before, after = F.substring(F.get(gaps, i), -NEAR, NEAR), F.substring(F.get(gaps, i + 1), 1, 1)
            parts = _judged(source, match, before, after)
            return F.struct((end - F.length(match)).alias("start"), end.alias("end"), *[c.alias(n) for n, c in parts.items()])

        return F.filter(F.transform(F.col(f"__m_{source}"), one), lambda c: c["considered"])

    found = found.withColumns({f"__c_{s}": judged(s) for s in PATTERNS})
    return found.drop(*[f"__{x}_{s}" for x in "mgle" for s in PATTERNS])


def vote_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``source``, the five votes and their number over all candidates of all texts."""
    found = with_candidates(docs.select(text), text)
    named = lambda source: lambda c: F.struct(F.lit(source).alias("source"), *[c[n].alias(n) for n in LABELERS])
    each = F.concat(*[F.transform(f"__c_{s}", named(s)) for s in PATTERNS])
    return found.select(F.inline(each)).groupBy("source", *LABELERS).agg(F.count(F.lit(1)).alias("n"))


def estimate(votes: list[tuple], rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns ``(source, five votes, number)``: the probability that each
    pattern's candidates are personal data, and the reliabilities (class, labeler, vote)."""
    sources, n = [v[0] for v in votes], np.array([v[-1] for v in votes], float)
    given = np.array([v[1:-1] for v in votes], int) + 1
    share = (given == 2).sum(1) + 0.5 * (given == 1).sum(1)
    p = np.clip(share / len(LABELERS), 0.05, 0.95)
    own = {s: np.array([x == s for x in sources]) for s in set(sources)}
    for _ in range(rounds):
        rate = np.empty((2, len(LABELERS), 3))
        for label, weight in enumerate(((1 - p) * n, p * n)):
            for k in range(len(LABELERS)):
                counted = np.bincount(given[:, k], weight, 3) + 1
                rate[label, k] = counted / counted.sum()
        log = np.zeros((2, len(votes)))
        for s, mask in own.items():
            prior = (np.sum((p * n)[mask]) + 1) / (np.sum(n[mask]) + 2)
            log[0, mask], log[1, mask] = math.log(1 - prior), math.log(prior)
        for label in (0, 1):
            log[label] += sum(np.log(rate[label, k, given[:, k]]) for k in range(len(LABELERS)))
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return p, rate


def train(votes: list[tuple]) -> tuple[dict[str, float], np.ndarray]:
    """The span classifier: weights of the sources and of (labeler, vote), a logistic regression by
    Newton's method with a small penalty on the estimated probabilities."""
    names, width = list(SOURCES), len(SOURCES) + 3 * len(LABELERS)
    w = np.zeros(width)
    if votes:
        p, _ = estimate(votes)
        x, n = np.zeros((len(votes), width)), np.array([v[-1] for v in votes], float)
        for row, v in enumerate(votes):
            x[row, names.index(v[0])] = 1
            for k, vote in enumerate(v[1:-1]):
                x[row, len(names) + 3 * k + vote + 1] = 1
        n = n / n.sum()
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (n * (q - p)) + 1e-4 * w
            bend = (x.T * (n * np.maximum(q * (1 - q), 1e-6))) @ x + 1e-4 * np.eye(width)
            w = w - np.linalg.solve(bend, slope)
    return dict(zip(names, map(float, w[: len(names)]))), w[len(names) :].reshape(len(LABELERS), 3)


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (kind number, start, end) by kind and start, the base
    spans and all spans. Texts are read twice, once to count votes and once for the spans."""
    votes = sorted(tuple(r) for r in vote_counts(docs, text).collect())
    bias, weights = train(votes)
    kept = [c for c in docs.columns if c not in ("base", "found")]
    rows = with_candidates(docs.select(*kept), text)

    def spans(source, chosen):
        kind = F.lit(KINDS.index(SOURCES[source]))
        picked = F.filter(F.col(f"__c_{source}"), chosen)
        return F.transform(picked, lambda c: F.struct(kind.alias("kind"), c["start"].cast("bigint").alias("start"), c["end"].cast("bigint").alias("end")))

    def sure(source):
        def test(c):
            score = F.lit(bias[source])
            for k, name in enumerate(LABELERS):
                score = score + F.when(c[name] == 1, float(weights[k, 2])).when(c[name] == 0, float(weights[k, 1])).otherwise(float(weights[k, 0]))
            return ~c["base"] & (score >= math.log(SURE / (1 - SURE)))

        return test

    rows = rows.withColumn("base", F.concat(*[spans(k, lambda c: c["base"]) for k in KINDS]))
    more = F.concat(*[spans(s, sure(s)) for s in ("card", "spelled", "national")])
    rows = rows.withColumn("__more", more).drop(*[f"__c_{s}" for s in PATTERNS])
    clear = F.filter("__more", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])))
    return rows.withColumn("found", F.array_sort(F.concat("base", clear))).drop("__more")


def written(spans: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets; of
    overlapping spans the first gives the kind. ``n_chars``, if there, follows the text."""
    found = find_personal_data(docs.select("*"), text)
    whole = F.coalesce(F.col(text), F.lit(""))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    order = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(a, s):
        piece = F.substring(whole, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        parts = F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(piece, F.get(names, s["kind"])))).otherwise(a["parts"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    ended = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(whole, (a["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    clean = F.when(F.size("found") == 0, F.col(text)).otherwise(F.aggregate(order, start, step, ended))
    columns = [clean.alias(c) if c == text else F.length(clean).cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return found.select(*columns)
