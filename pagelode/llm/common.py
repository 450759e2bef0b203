"""Helpers the training-data operators share: size-checked joins, word hashing, components."""

from __future__ import annotations

import ctypes
import gc
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelode.session import discard, materialise

#: A written table is broadcast up to this size, ``rows * bytes a row``; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def row_bytes(df: DataFrame) -> int:
    """Bytes of one row of fixed-width columns; 64 for any other column."""
    width = {"bigint": 8, "double": 8, "int": 4, "float": 4, "boolean": 1}
    return 16 + sum(width.get(kind, 64) for _, kind in df.dtypes)


def checked(df: DataFrame) -> DataFrame:
    """``df``, a written table, with a broadcast hint if its counted rows fit ``BROADCAST_BYTES``."""
    return F.broadcast(df) if df.count() * row_bytes(df) <= BROADCAST_BYTES else df


def count_words(text) -> "F.Column":
    """Number of words of a text column, null counting as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def release() -> None:
    """Give memory that finished work left in this Python worker back to the system: workers go from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library; it keeps what it keeps


# --- hashing inside tasks ----------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one (the finaliser of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words, remembered; forgotten when there are too many."""

    LIMIT = 1 << 17

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hash_words(words: list[bytes], known: WordHash) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive words; of the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        span = min(width, n)
        out = np.full(n - span + 1, span, np.uint64)
        for i in range(span):
            out = out * step + hashes[i : n - span + 1 + i]
        return mix(out)


def distinct_shingles(text: bytes | None, width: int, known: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes of a text: A-Z lower-cased, words by ASCII white space."""
    if not text:
        return np.empty(0, np.uint64)
    return np.unique(shingles(hash_words(text.lower().split(), known), width))


# --- connected components ----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: every node of the undirected ``edges`` (a, b bigint) with the smallest node it
    reaches. Alternates two steps, each a minimum per node (partial sums) and a join: larger
    neighbours are moved to the smallest neighbour, then smaller ones are. Each step is written
    to the shared folder; it ends when an alternation changes nothing. A node with very many
    neighbours is one key of a sort-merge join over written tables, which adaptive execution splits.
    No edges give no rows; self-loops are ignored."""
    current = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = materialise(current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u <> v").distinct(), "large")
        smallest = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(moved.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "small")
        discard(current, both, least, large, smallest)
        current = after
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == state:
            roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            found = materialise(current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots), "components")
            discard(current)
            return found
        state = tuple(seen)


# --- links inside buckets ----------------------------------------------------------------------


#: Members of a bucket in a tile of the exact comparison, and 64-bit words compared at a time.
TILE, WORDS = 2048, 1 << 21
#: Pairs that a task holds to send each of them once.
HELD = 1 << 19


def links_in_buckets(members: DataFrame, verify, sketches: DataFrame | None = None, stars: int = 3) -> DataFrame:
    """Links ``a, b`` that connect the same nodes as all verified links between members of the
    same bucket, without comparing all pairs of a bucket.

    ``members`` is a written table (bucket, node bigint, n int) in which a bucket may repeat a node;
    ``verify`` takes pairs (a, b, distinct) and returns those that are links. In each star round every member of
    a bucket is compared with one member of it, the hub, which then leaves the bucket: all its pairs there are
    known. Hubs are drawn by hash of the node in the first round, so that like buckets make like pairs, and
    of node and bucket in the later ones, so that a node in many like buckets meets many hubs. Members joined
    already share a label, and a bucket of one label is finished. What is left after ``stars`` rounds is
    compared exactly, see ``remaining_pairs``. Pairs of one label are never compared, as they are connected."""
    spark = members.sparkSession
    links = spark.createDataFrame([], "a bigint, b bigint")
    whole = Window.partitionBy("bucket")
    labelled, before = members.select("bucket", "node", "n", F.col("node").alias("label")), None
    rounds = ["hub"] * stars + ["likeliest"] * (sketches is not None) + ["all"]
    for turn, kind in enumerate(rounds):
        if kind == "hub":
            key = F.xxhash64("node") if not turn else F.xxhash64("node", "bucket", F.lit(turn))
            labelled = labelled.withColumn("hub", F.min_by(F.struct("node", "n", "label"), key).over(whole))
            pairs = labelled.where("label <> hub.label").select(
                F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"), F.col("n").alias("x"), F.col("hub.n").alias("y")
            )
            labelled = labelled.where("node <> hub.node").drop("hub")
            # A link needs sizes within 80 % of each other; of the same pair in many buckets one is kept.
            pairs = pairs.where("100 * least(x, y) >= 80 * greatest(x, y)").select("a", "b").distinct()
        else:
            pairs = remaining_pairs(labelled, sketches, kind == "likeliest")
        pairs = materialise(pairs, "pairs")
        found = materialise(links.union(verify(pairs, kind != "hub" and sketches is not None)), "links")
        if kind == "all":
            return found
        discard(pairs, links)
        links = found
        groups = components(links)
        renamed = labelled.join(checked(groups), "node", "left")
        renamed = renamed.select("bucket", "node", "n", F.coalesce("root", "node").alias("label"))
        open_ = renamed.withColumn("low", F.min("label").over(whole)).withColumn("high", F.max("label").over(whole))
        labelled = materialise(open_.where("low <> high").drop("low", "high"), "open")
        discard(groups, before)
        before = labelled
        if labelled.isEmpty():
            return links


def remaining_pairs(labelled: DataFrame, sketches: DataFrame | None, likeliest: bool = False) -> DataFrame:
    """``a, b``, distinct: pairs of nodes of one bucket and different labels that may be linked. The members outside a bucket's most
    frequent label are compared with all its members, in tiles of both, inside tasks: only pairs whose sizes, and bit sets
    where ``sketches`` (node, n, bits) has them, allow a link become rows; with ``likeliest``, of a member's pairs in a tile the one whose bit
    sets differ least. A tile's memory is bounded; no bucket is gathered."""
    rest = labelled.distinct()
    sizes = materialise(rest.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k")), "sizes")
    tiles = lambda rows: F.greatest(F.lit(1), F.ceil(rows / TILE)).cast("int")
    total, most = F.sum("k"), F.max("k")
    buckets = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("k", "label")).alias("major"), tiles(total).alias("wide"), tiles(total - most).alias("high"))
    rows = rest.join(checked(materialise(buckets, "buckets")), "bucket").withColumn("few", F.col("label") != F.col("major"))
    own = lambda count, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["bucket", "column", "row", "few", "node", "n", "label"]
    left = rows.where("few").withColumn("row", own("high", 1)).withColumn("column", every("wide")).select(*columns)
    right = rows.withColumn("few", F.lit(False)).withColumn("column", own("wide", 2)).withColumn("row", every("high")).select(*columns)
    dealt = left.union(right)
    if sketches is None:
        dealt = dealt.withColumn("bits", F.lit(None).cast("array<bigint>"))
    else:
        # Bit sets go to tiles by their node; of a node in many buckets they are repeated, as its rows are.
        dealt = dealt.join(checked_size(sketches.select("node", "bits"), F.size("bits") * 8 + 48), "node").select(*columns, "bits")
    key = ["bucket", "column", "row"]
    compare = partial(_compare_tiles, likeliest=likeliest)
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, "a bigint, b bigint").distinct()


def _compare_tiles(batches, likeliest: bool):
    """Pairs of the tiles in rows sorted by tile; what a batch ends with waits for the next one. A pair met in many tiles of a
    task is sent once, as long as the task holds it."""
    waiting, found, held = None, [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        keys = np.stack([table.column(c).to_numpy() for c in range(3)])
        ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for i, j in zip(np.r_[0, ends[:-1]], ends) if len(ends) else ():
            found.append(_tile_pairs(table.slice(i, j - i), likeliest))
            held += len(found[-1])
            if held > HELD:
                yield _pair_rows(found)
                found, held = [], 0
        waiting = table.slice(ends[-1] if len(ends) else 0)
    if waiting is not None:
        found.append(_tile_pairs(waiting, likeliest))
    yield _pair_rows(found)


def _pair_rows(found: list) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate([np.empty((0, 2), np.int64), *found]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _tile_pairs(tile: pa.Table, likeliest: bool) -> np.ndarray:
    few = tile.column("few").to_numpy(zero_copy_only=False)
    node, n, label = (tile.column(c).to_numpy() for c in ("node", "n", "label"))
    bits = tile.column("bits").combine_chunks()
    width = np.zeros(len(node), np.int64) if bits.null_count else bits.value_lengths().to_numpy()
    flat, start = bits.flatten().to_numpy().view(np.uint64), np.r_[0, np.cumsum(width)]
    out = []
    for w in np.unique(width):
        for other in (w, 2 * w) if w else (w,):
            for i, j in {(w, other), (other, w)}:
                mine, theirs = np.flatnonzero(few & (width == i)), np.flatnonzero(~few & (width == j))
                if len(mine) and len(theirs):
                    at = lambda rows, own: _folded(flat[start[rows][:, None] + np.arange(own)], w)
                    out.append(_near(mine, theirs, at(mine, i), at(theirs, j), node, n, label, likeliest))
    pairs = np.concatenate([np.empty((0, 2), np.int64), *out])
    return np.unique(np.sort(pairs, axis=1), axis=0) if len(pairs) else pairs


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    return bits if bits.shape[1] == words else bits[:, :words] ^ bits[:, words:]


def _near(mine, theirs, x, y, node, n, label, likeliest) -> np.ndarray:
    """Pairs of nodes whose labels differ and whose sizes and bit sets allow a similarity of 80 %."""
    out, step = [np.empty((0, 2), np.int64)], max(1, WORDS // max(1, len(theirs) * max(1, x.shape[1])))
    for low in range(0, len(mine), step):
        rows = mine[low : low + step]
        a, b = n[rows][:, None].astype(np.int64), n[theirs][None].astype(np.int64)
        fits = (100 * np.minimum(a, b) >= 80 * np.maximum(a, b)) & (label[rows][:, None] != label[theirs][None])
        if x.shape[1]:
            apart = np.bitwise_count(x[low : low + step][:, None] ^ y[None]).sum(axis=2, dtype=np.int64)
            fits &= 9 * apart <= a + b
            if likeliest:
                fits &= np.arange(len(theirs)) == np.where(fits, apart / (a + b), 2.0).argmin(axis=1)[:, None]
        i, j = np.nonzero(fits)
        out.append(np.stack([node[rows[i]], node[theirs[j]]], axis=1))
    return np.concatenate(out)


def shared(rows: DataFrame) -> DataFrame:
    """The rows of buckets with two nodes or more, with the bucket's number of rows, written."""
    whole = Window.partitionBy("bucket")
    spans = rows.withColumn("low", F.min("node").over(whole)).withColumn("high", F.max("node").over(whole))
    spans = spans.withColumn("many", F.count(F.lit(1)).over(whole))
    return materialise(spans.where("low <> high").drop("low", "high"), "shared")


def checked_size(df: DataFrame, size) -> DataFrame:
    """``df``, a written table, with a broadcast hint if ``size`` (bytes of a row, a column) adds up to at
    most ``BROADCAST_BYTES``."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """A bit set of a token set in 64-bit words, at least a bit for each token: a bit is on if an odd number of
    tokens falls on it. Two sets differ in at least as many tokens as their bit sets in bits."""
    words = 1 << max(0, (max(1, len(tokens)) - 1).bit_length() - 6)
    odd = np.bincount((tokens & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _differing_bits(u, v):
    """Differing bits of two bit sets; the longer is folded, which keeps the bound. Sets of sizes within
    80 % differ by one folding at most."""

    def folded(x, other):
        half = F.floor(F.size(x) / 2).cast("int")
        twice = F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(x) > F.size(other), twice).otherwise(x)

    words = F.zip_with(folded(u, v), folded(v, u), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(words, F.lit(0), lambda total, n: total + n)


def promising(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs that may be 80 % alike by ``sketches`` (node, n, bits): alike sets differ in at most a ninth
    of their tokens together, and their bit sets in no more bits. Written."""
    bits = checked_size(sketches, F.size("bits") * 8 + 48)
    side = lambda key, n, b: bits.select(F.col("node").alias(key), F.col("n").alias(n), F.col("bits").alias(b))
    both = pairs.join(side("a", "x", "u"), "a").join(side("b", "y", "v"), "b")
    return materialise(both.where(9 * _differing_bits(F.col("u"), F.col("v")) <= F.col("x") + F.col("y")).select("a", "b"), "promising")


def verified(sets_of, sketches: DataFrame | None = None):
    """A function from pairs of nodes to those whose sets are 80 % alike. ``sets_of`` makes node, n, tokens for
    a table of nodes. The sets of one side are found by the pairs, then those of the other join them."""

    def verify(pairs: DataFrame, sifted: bool = False) -> DataFrame:
        if sketches is not None and not sifted:
            pairs = promising(pairs, sketches)
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = sets_of(materialise(ends, "ends"))
        right = sets.select(F.col("node").alias("b"), F.col("n").alias("y"), F.col("tokens").alias("v"))
        right = right.join(checked(pairs), "b")
        left = sets.select(F.col("node").alias("a"), F.col("n").alias("x"), F.col("tokens").alias("u"))
        left = left.join(checked(materialise(pairs.select("a").distinct(), "hubs")), "a", "left_semi")
        both = F.size(F.array_intersect("u", "v"))
        return right.join(left, "a").where(100 * both >= 80 * (F.col("x") + F.col("y") - both)).select("a", "b")

    return verify


# --- running sums ------------------------------------------------------------------------------


def running_total(rows: DataFrame, group: str, order: list[str], size: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the sum of ``size`` over the rows of the same ``group`` before each in ``order``.

    Rows are dealt to ranges of (group, order), the ranges are summed, and the prefix sums of the
    ranges (a row for each) are added to those inside a range; no group is gathered in one task."""
    parts = materialise(rows.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy(group, "__part").agg(F.sum(size).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    starts = checked(materialise(starts, "starts"))
    inside = Window.partitionBy(group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = parts.join(starts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    own = F.coalesce(F.sum(size).over(inside), F.lit(0))
    return joined.withColumn(out, F.col("__start") + own).drop("__part", "__g", "__p", "__start")
