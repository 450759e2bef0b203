"""How the sources of a language differ in their words: an audit over every pair of sources of a language.

The steps are those of a count vectoriser fitted for each language and of a summariser over its vectors. A document is an
exact sparse vector (term -> count); vectors of a group (language, source) are added up in its tasks, then by Spark; the vocabulary of a
language is all terms in at least ``MIN_DOCS`` of its documents, up to the largest integer of them. Spark's own vectoriser brings its vocabulary
to the driver and its summariser adds dense vectors; here both stay rows, so that neither bounds the size of a vocabulary.

Pairs are evaluated on the sparse sums. With p0 and q0 the probabilities of a term that a group lacks, the sum over the whole vocabulary is
V f(p0, q0), plus what changes for the terms of either group (one evaluation for each count that occurs in it, times its terms), plus a
correction for the terms both have. Only the last needs terms side by side: tiles of sources by blocks of terms, in numpy.

Defined cases: null text, language and source count as ''. Groups without kept terms have zeros. A language without
kept terms has value 0 in all its pairs, and no terms. Repeated rows and ids count each. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.llm.common import checked
from pagelode.session import materialise

MIN_DOCS, TOP_TERMS = 10, 10
#: The vocabulary of a language may hold as many terms as an integer can number.
VOCABULARY = (1 << 31) - 1
ONE = 1_000_000_000
#: Terms in a task's sums before they are sent on, bytes of text looked at together, sources and terms of a tile.
HELD, SLICE, TILE, TERMS = 300_000, 1 << 20, 128, 4096

GROUP = ["lang", "source"]
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms_of(text: bytes):
    """Terms of a text in UTF-8 as lists, a slice of the text at a time; slices end where a term does."""
    text, at = text.lower(), 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            rest = re.compile(rb"[^a-z\x80-\xff]").search(text, end)
            end = rest.start() if rest else len(text)
        yield _TERM.findall(text, at, end)
        at = end


def group_vectors(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: partial sums of the documents' sparse vectors (occurrences, documents with the term) for each
    group, and a row with an empty term for each group. Sums of a task are sent on when they hold ``HELD`` terms."""

    def send(groups):
        sizes = [len(counts) + 1 for counts, _ in groups.values()]
        of_row = pa.array(np.repeat(np.arange(len(groups)), sizes))
        lang, source = (pa.array(names, pa.string()).take(of_row) for names in zip(*groups, strict=True))
        terms, n, documents = [], [], []
        for counts, seen in groups.values():
            terms += [b"", *counts]
            n += [0, *counts.values()]
            documents += [0, *map(seen.__getitem__, counts)]
        terms = pa.array(terms, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([lang, source, terms, pa.array(n, pa.int64()), pa.array(documents, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        groups, held = defaultdict(lambda: (Counter(), Counter())), 0
        for batch in batches:
            for text, lang, source in zip(*batch.columns, strict=True):
                counts, seen = groups[lang.as_py(), source.as_py()]
                held -= len(counts)
                own = set()
                for some in terms_of(text.as_buffer().to_pybytes()):
                    counts.update(some)
                    own.update(some)
                seen.update(own)
                held += len(counts)
                if held > HELD:
                    yield send(groups)
                    groups.clear()
                    held = 0
        if groups:
            yield send(groups)

    # In UTF-8 no letter is part of another character's bytes, so bytes are searched.
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(blank("text"), *map(blank, GROUP)).mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def vocabulary_cells(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """``cells``: ``lang, source, term, n, of_lang, first`` for the kept terms a group has, with the occurrences in the whole language and a mark on
    one row of each term; ``groups``: ``lang, source, n_group, n_lang, v``, every occurring group. Both written.

    Sums of a (group, term) come first, from partial sums of each task; then the rows of a term, one for each source, meet."""
    sums = group_vectors(docs).groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    marked = sums.select(
        *GROUP, "term", "n",
        F.sum("docs").over(whole).alias("df"),
        F.sum("n").over(whole).alias("of_lang"),
        (F.min("source").over(whole) == F.col("source")).alias("first"),
    )
    cells = materialise(marked.where((F.col("df") >= min_docs) | (F.col("term") == "")).drop("df"), "cells")
    term = F.col("term") != ""
    groups = cells.groupBy(*GROUP).agg(F.sum("n").alias("n_group"))
    langs = cells.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if(F.col("first") & term).alias("v"))
    langs = materialise(langs, "langs")
    if langs.where(F.col("v") > VOCABULARY).limit(1).count():
        raise ValueError(f"a language has over {VOCABULARY} terms")
    groups = materialise(groups.join(checked(langs), "lang"), "groups")
    return cells.where(term), groups


def probability(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 v)), exact."""
    up = F.lit(ONE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    down = (total + 2 * v).cast("decimal(20,0)")
    return F.when(down > 0, 1 + F.call_function("div", up, down)).otherwise(1)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); both are at most 10^9 + 1, so 64 bits hold it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _corrections(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: over the terms two sources both have, what the sum of the parts of each one misses."""
    langs = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"), F.ceil(F.max("v") / TERMS).cast("int").alias("blocks")
    )
    rows = cells.select(*GROUP, "term", "p", "zero").join(checked(materialise(langs, "tiles")), "lang")
    own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    rows = rows.withColumn("tile", own).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    # A tile meets every tile of its language; with few sources there is one.
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.select("lang", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), "block", "tile", "source", "term", "p", "zero")
    schema = "lang string, source string, item string, value bigint"

    def tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lang, x, y, _ = (k.as_py() for k in key)
        names = table.column("source").combine_chunks().dictionary_encode()
        terms = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        who, p, zero, side = names.indices.to_numpy(), *(table.column(c).to_numpy() for c in ("p", "zero", "tile"))
        names = names.dictionary.to_pylist()
        empty, of = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        empty[who], of[who] = zero, side
        left, right = np.flatnonzero(of == x), np.flatnonzero(of == y)
        dense = np.repeat(empty[right][:, None], terms.max() + 1, axis=1)
        row_of = np.full(len(names), -1)
        row_of[right] = np.arange(len(right))
        mine = row_of[who] >= 0
        dense[row_of[who[mine]], terms[mine]] = p[mine]
        out = []
        by_source = np.argsort(who, kind="stable")
        start = np.searchsorted(who[by_source], np.arange(len(names) + 1))
        for i in left:
            at = by_source[start[i] : start[i + 1]]
            a, a0, b, b0 = p[at][None], empty[i], dense[:, terms[at]], empty[right][:, None]
            # A term the other source lacks has b = b0 and adds nothing.
            value = (_gaps(a, b) - _gaps(a, b0) - _gaps(a0, b) + _gaps(a0, b0)).sum(axis=1)
            for j, v in zip(right, value.tolist(), strict=True):
                if i != j:
                    out.append((lang, names[i], names[j], v))
                    if x != y:
                        out.append((lang, names[j], names[i], v))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "source", "item", "value"])

    return met.groupBy("lang", "x", "y", "block").applyInArrow(tile, schema)


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language."""
    zero = groups.select(*GROUP, "v", "zero")
    other = checked(zero).select("lang", F.col("source").alias("item"), F.col("zero").alias("zero2"))
    base = zero.join(other, "lang").where("source <> item")
    base = base.select(*GROUP, "item", F.when(F.col("v") > 0, F.col("v") * gap(F.col("zero"), F.col("zero2"))).otherwise(0).alias("value"))
    # A group's terms with the same count are alike for every other source: one row for each count.
    counts = materialise(cells.groupBy(*GROUP, "p", "zero").agg(F.count(F.lit(1)).alias("k")), "counts")
    own = counts.join(other, "lang").where("source <> item")
    own = own.groupBy(*GROUP, "item").agg(F.sum(F.col("k") * (gap(F.col("p"), F.col("zero2")) - gap(F.col("zero"), F.col("zero2")))).alias("value"))
    own = materialise(own, "own")
    turned = own.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = base.unionByName(own).unionByName(turned).unionByName(_corrections(cells, groups))
    return parts.groupBy(*GROUP, "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources of the language by their distance from the source (part
    ``pair``), and the terms the source uses more than its language, the ``top`` of them (part ``term``)."""
    cells, groups = vocabulary_cells(docs, min_docs)
    groups = groups.withColumn("zero", probability(F.lit(0), F.col("n_group"), F.col("v")))
    sized = cells.join(checked(groups), GROUP)
    # The mark of groups without terms is no term, so every row here has a count.
    cells = sized.select(
        *GROUP, "term", "zero",
        probability(F.col("n"), F.col("n_group"), F.col("v")).alias("p"),
        probability(F.col("of_lang"), F.col("n_lang"), F.col("v")).alias("q"),
    )
    cells = materialise(cells, "probabilities")
    pairs = pair_values(cells, groups).withColumn("part", F.lit("pair"))
    terms = cells.where("p > q").select(*GROUP, F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"), F.lit("term").alias("part"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    both = ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))
    return both.select(*GROUP, "part", "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))
