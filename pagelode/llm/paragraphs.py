"""Near copies of passages removed across documents, by MinHash banding of paragraphs.

Lines do not tell where a passage begins: it may start and end inside a line, or run over several. So a
paragraph is a stretch of words between cuts that the words themselves make: a cut lies before a word whose hash (with the
word after it) is the least of ``SPAN`` words on both sides. Equal passages are cut alike wherever they stand, but for
their first and last words. A paragraph's set is its distinct five-word shingles (the whole, if it has fewer words), and equal sets are one
node. Bands are tuned so that two sets that are 80 % alike share one with a probability of at least ``RECALL``;
nodes that share a band are compared inside the bands without forming all pairs and verified by exact
Jaccard similarity; of each connected component the first paragraph, by document id and place, stays.
The others go where they stand in a run of at least ``LEAST_RUN`` words of such paragraphs: shorter runs are set
phrases and common lines, and stay.

Defined results: a null or empty text has no words; passages repeated inside a document go as well; white space before a
removed run stays, that behind it goes with it; rows alike in id and text are one document and lose the same
runs; a null id comes last; an empty table gives an empty result; columns pass through unless they bear a result's name."""

import hashlib
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import BROADCAST_BYTES, WordHash, checked, components, hash_words, links_in_buckets, mix, parity_bits, shared, verified
from pagelode.llm.ngram_join import WIDTH, _signed
from pagelode.session import discard, materialise

#: Words on either side that a cut has to undercut; words of copied paragraphs in a row from which they go.
SPAN, LEAST_RUN = 6, 16
#: Chance that a pair at the threshold shares a band; hash functions at most.
RECALL, MOST_HASHES = 0.98, 20
#: Words hashed at a time (a longer text alone), and nodes that a task remembers to band each once.
SLICE, SEEN = 1 << 17, 1 << 20
#: Parts in which bands are shuffled.
PARTS = 3

RESULT = ["n_words", "n_removed", "removed_words", "kept_sha256", "kept"]
STEP = np.uint64(0x9E3779B97F4A7C15)
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


def tuned_bands(threshold: float = 0.8, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows a band: the longest bands that reach the recall with so many hash functions."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def cut_starts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where paragraphs start in the word hashes of texts laid end to end, ``sizes`` words each. A text's first word starts
    one; what stands in other texts has no influence."""
    ends = np.cumsum(sizes)
    after = np.append(hashes[1:], np.uint64(0))
    after[ends[sizes > 0] - 1] = 0
    keys = mix(hashes * STEP + after)
    at = np.arange(len(keys)) + SPAN * (np.repeat(np.arange(len(sizes)), sizes) + 1)
    padded = np.full(len(keys) + SPAN * (len(sizes) + 2), np.iinfo(np.uint64).max, np.uint64)
    padded[at] = keys
    least = padded.copy()
    for i in range(1, SPAN):
        np.minimum(least[:-i], padded[i:], out=least[:-i])
    starts = (keys < least[at - SPAN]) & (keys <= least[at + 1])
    starts[(ends - sizes)[sizes > 0]] = True
    return np.flatnonzero(starts)


def paragraph_tokens(hashes: np.ndarray, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles of all paragraphs, end to end; how many each has)."""
    whole = np.maximum(words - WIDTH + 1, 0)
    owner, first = np.repeat(np.arange(len(starts)), whole), np.cumsum(whole) - whole
    place = starts[owner] + np.arange(len(owner)) - first[owner]
    parts, owners = [_spans(hashes, place, WIDTH)], [owner]
    for n in range(1, WIDTH):
        short = np.flatnonzero(words == n)
        parts.append(_spans(hashes, starts[short], n))
        owners.append(short)
    tokens, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[new], np.bincount(owner[new], minlength=len(starts))


def _spans(hashes: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    out = np.full(len(place), width, np.uint64)
    for i in range(width):
        out = out * STEP + hashes[place + i]
    return mix(out)


def set_names(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit names of the token sets that lie end to end."""
    total = np.add.reduceat(mix(tokens ^ STEP), np.cumsum(sizes) - sizes)
    return mix(total * STEP + sizes.astype(np.uint64))


def band_names(tokens: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each token set (end to end) a name for each band of its least values under ``bands * rows`` hash functions."""
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    first, names = np.cumsum(sizes) - sizes, np.empty((len(sizes), bands), np.uint64)
    for band in range(bands):
        name = np.full(len(sizes), band + 1, np.uint64)
        for factor in factors[band * rows : (band + 1) * rows]:
            name = mix(name * STEP + np.minimum.reduceat(tokens * factor, first))
        names[:, band] = name
    return names


def _sliced(batch: pa.RecordBatch, known: WordHash) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number of the first row, word hashes of each text) of slices of a batch, of about ``SLICE`` words."""
    low, held, total = 0, [], 0
    for i, raw in enumerate(batch.column("text").cast(pa.binary())):
        held.append(hash_words(raw.as_py().lower().split(), known))
        total += len(held[-1])
        if total >= SLICE or i + 1 == len(batch):
            yield low, held
            low, held, total = i + 1, [], 0


PLACES = "doc_id bigint, mark bigint, start int, words int, node bigint, n int, bands array<bigint>"
SETS = "node bigint, n int, tokens array<bigint>, bits array<bigint>"


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(whole).alias("mark"), whole.alias("text"))


def paragraph_places(docs: DataFrame, doc_id: str, text: str, bands: tuple[int, int]) -> DataFrame:
    """Every paragraph, written: ``doc_id``, ``mark`` (the text's hash), ``start`` and ``words`` in words, its ``node``, the
    set's size ``n``. The names of its ``bands`` are in the row a task gives a node first, and null in others."""

    def run(batches):
        for batch, sizes, starts, words, tokens, n, nodes, fresh in _paragraphs(batches):
            with np.errstate(over="ignore"):
                named = band_names(tokens[np.repeat(fresh, n)], n[fresh], *bands) if fresh.any() else np.empty((0, bands[0]), np.uint64)
            doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
            start = starts - (np.cumsum(sizes) - sizes)[doc]
            columns = [batch.column("doc_id").take(pa.array(doc)), batch.column("mark").take(pa.array(doc))]
            columns += [pa.array(start.astype(np.int32)), pa.array(words.astype(np.int32)), pa.array(nodes), pa.array(n.astype(np.int32))]
            columns.append(_lists(fresh, np.full(len(named), bands[0]), _signed(named.ravel())))
            yield pa.RecordBatch.from_arrays(columns, names=[column.split()[0] for column in PLACES.split(", ")])

    return materialise(_keyed(docs, doc_id, text).mapInArrow(run, PLACES), "paragraphs")


def paragraph_sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """``node, n, tokens, bits`` (see ``parity_bits``) of the ``wanted`` nodes, written: texts are hashed again, as the sets of all
    paragraphs take more room than the texts."""

    def run(batches):
        for *_, tokens, n, nodes, fresh in _paragraphs(batches):
            own, n, every = tokens[np.repeat(fresh, n)], n[fresh], np.ones(fresh.sum(), bool)
            if len(n):
                columns = [pa.array(nodes[fresh]), pa.array(n.astype(np.int32)), _lists(every, n, _signed(own)), _lists(every, *_bit_sets(own, n))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "tokens", "bits"])

    found = _keyed(docs, doc_id, text).mapInArrow(run, SETS).join(checked(wanted), "node", "left_semi")
    return materialise(found.dropDuplicates(["node"]), "sets")


def _paragraphs(batches) -> Iterator[tuple]:
    """Of each slice of the texts: its rows, words of each text, starts, words, tokens (end to end), set sizes and nodes of the paragraphs, and which of
    them the task meets first."""
    known, seen = WordHash(), set()
    for batch in batches:
        for low, texts in _sliced(batch, known):
            sizes, hashes = np.array([len(t) for t in texts], np.int64), np.concatenate(texts)
            if not len(hashes):
                continue
            with np.errstate(over="ignore"):
                starts = cut_starts(hashes, sizes)
                words = np.diff(np.append(starts, len(hashes)))
                tokens, n = paragraph_tokens(hashes, starts, words)
                nodes = _signed(set_names(tokens, n))
            fresh = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes.tolist()):
                if node not in seen:
                    seen.add(node)
                    fresh[i] = True
            if len(seen) > SEEN:
                seen.clear()
            yield batch.slice(low, len(texts)), sizes, starts, words, tokens, n, nodes, fresh


def _bit_sets(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of each, words end to end) of the sets' ``parity_bits``; sets of one word are made together."""
    first = np.cumsum(sizes) - sizes
    words = np.bitwise_xor.reduceat(np.uint64(1) << (tokens & np.uint64(63)), first).view(np.int64)
    large = np.flatnonzero(sizes > 64)
    if not len(large):
        return np.ones(len(sizes), np.int64), words
    parts = list(words[:, None])
    for i in large:
        parts[i] = parity_bits(tokens[first[i] : first[i] + sizes[i]])
    return np.array([len(p) for p in parts]), np.concatenate(parts)


def _lists(given: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> pa.Array:
    """A list for each row that is ``given``, null in the others."""
    counts = np.zeros(len(given), np.int64)
    counts[given] = sizes
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(~given, False)), pa.array(flat))


def band_members(places: DataFrame, bands: int) -> list[DataFrame]:
    """``bucket, node, n`` of the bands that two nodes or more share, written in up to ``PARTS`` parts of some bands each: what is
    shuffled lies on disk beside the places, a part at a time."""
    banded = places.where("bands IS NOT NULL")
    step = math.ceil(bands / PARTS)
    return [shared(banded.select(F.explode(F.slice("bands", low, step)).alias("bucket"), "node", "n")) for low in range(1, bands + 1, step)]


def paragraph_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: tuple[int, int] | None = None) -> DataFrame:
    """``doc_id, mark, start, words, label, removed``: every paragraph that has a near copy elsewhere, written. ``removed``: it is not the
    first of its group. Rows alike in id and text are one document."""
    bands = bands or tuned_bands()
    places = paragraph_places(docs, doc_id, text, bands)
    parts = band_members(places, bands[0])
    members = reduce(DataFrame.union, parts).drop("many")
    near = materialise(members.select("node").distinct(), "near")
    sets = paragraph_sets(docs, doc_id, text, near)
    sketches = materialise(sets.select("node", "n", "bits"), "sketches")
    tokens = sets.select("node", "n", "tokens")
    links = links_in_buckets(members, verified(lambda wanted: tokens.join(checked(wanted), "node", "left_semi"), sketches), sketches)
    groups = components(links).withColumnRenamed("root", "label")
    # Places count if their node has links or stands in two places; all others are left behind here.
    spot = F.xxhash64("doc_id", "mark", "start")
    twice = places.select("node", spot.alias("s")).groupBy("node").agg(F.min("s").alias("low"), F.max("s").alias("high")).where("low <> high")
    named = twice.select("node").join(groups, "node", "full").select("node", F.coalesce("label", "node").alias("label"))
    labelled = places.select("doc_id", "mark", "start", "words", "node").join(checked(materialise(named, "named")), "node")
    labelled = materialise(labelled.select("doc_id", "mark", "start", "words", "label"), "labelled")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "start")
    firsts = materialise(labelled.groupBy("label").agg(F.min(place).alias("first")), "firsts")
    found = labelled.join(checked(firsts), "label").withColumn("removed", place != F.col("first")).drop("first")
    found = materialise(found.distinct(), "groups")
    discard(places, *parts, near, sets, sketches, links, labelled, firsts)
    return found


def long_runs(removed: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first word, words, paragraphs) of the runs of at least ``LEAST_RUN`` words in removed paragraphs (start, words)."""
    runs = []
    for start, words in sorted(removed):
        if runs and sum(runs[-1][:2]) == start:
            runs[-1] = (runs[-1][0], runs[-1][1] + words, runs[-1][2] + 1)
        else:
            runs.append((start, words, 1))
    return [run for run in runs if run[1] >= LEAST_RUN]


def removed_runs(groups: DataFrame) -> DataFrame:
    """``doc_id, mark, runs`` of the documents that lose words by ``paragraph_groups``, written: their ``long_runs`` end to end. Paragraphs in shorter
    runs, and documents with no others, are left behind here, before the texts are met."""

    @F.pandas_udf("array<int>")
    def joined(lists: pd.Series) -> pd.Series:
        runs = (long_runs([tuple(map(int, p)) for p in gone]) for gone in lists)
        return pd.Series([[n for run in found for n in run] or None for found in runs], dtype=object)

    gone = groups.where("removed").groupBy("doc_id", "mark").agg(F.collect_list(F.array("start", "words")).alias("places"))
    return materialise(gone.select("doc_id", "mark", joined("places").alias("runs")), "gone").where("runs IS NOT NULL")


def without_runs(raw: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """A text without runs of its words, each up to the next word."""
    if not runs:
        return raw
    at = [found.start() for found in TOKEN.finditer(raw)] + [len(raw)]
    kept, low = [], 0
    for start, words, _ in runs:
        kept.append(raw[low : at[start]])
        low = at[start + words]
    return b"".join([*kept, raw[low:]])


def _cut(whole: bool):
    kinds = "n_words bigint, n_removed bigint, removed_words bigint, kept_sha256 string" + ", kept string" * whole

    @F.pandas_udf(kinds)
    def cut(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for text, gone in zip(texts, lists):
            raw = (text or "").encode()
            runs = [] if gone is None else [tuple(run) for run in gone.reshape(-1, 3).tolist()]
            kept = without_runs(raw, runs)
            row = (len(raw.split()), sum(r[2] for r in runs), sum(r[1] for r in runs), hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept.decode()) if whole else row)
        return pd.DataFrame(rows, columns=RESULT[: 5 if whole else 4])

    return cut


def remove_near_paragraphs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False, bands: tuple[int, int] | None = None
) -> DataFrame:
    """``docs`` with the number of words, of the paragraphs removed and of their words, the digest of the text that
    stays, and with ``whole`` that text as ``kept``. ``bands`` (bands, rows a band) are tuned where not given."""
    names = RESULT[: 5 if whole else 4]
    columns = [c for c in docs.columns if c not in names]
    gone = removed_runs(paragraph_groups(docs, doc_id, text, bands))
    size = gone.agg(F.count(F.lit(1)) * 96 + F.coalesce(F.sum(F.size("runs")), F.lit(0)) * 4).first()[0]
    gone = gone.select(F.col("doc_id").alias("__d"), F.col("mark").alias("__m"), F.col("runs").alias("__runs"))
    gone = F.broadcast(gone) if size <= BROADCAST_BYTES else gone
    same = (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__m")) & F.col(doc_id).cast("bigint").eqNullSafe(F.col("__d"))
    joined = docs.join(gone, same, "left")
    return joined.select(*columns, _cut(whole)(F.col(text), F.col("__runs")).alias("__r")).select(*columns, "__r.*")
