"""Removal of repeated byte strings by bucket-pointer refinement.

Every offset belongs to the bucket of the string that starts there. Names of buckets of 2k bytes are made from
the bucket names at an offset and at the offset k later, from single bytes up to 32, 64, 128 and 200
bytes, the same update each time; equal names mean equal strings (64-bit names). Which offsets are
sorted into buckets over the whole corpus is refined in three rounds, each for what the last left open:

1. runs of starts that share the smallest 32-byte bucket among their 200 bytes, one row a run;
2. blocks of 16 starts, counted from that bucket's place, in runs whose 32-byte bucket also occurs with
   other surroundings, by the 185 bytes that all 16 strings share;
3. single starts of blocks whose shared bytes also occur with other ends.

In each round a class of equal runs or blocks in two places or more is decided, and only one member of it
goes on, as a partner for the rest. Places are a 64-bit hash of the text and an offset, so copies of a text
are worked on once; a text that occurs twice is repeated as a whole.

Different texts are laid out once, in a table bucketed by their hash: the only time that texts are shuffled, and copies meet
in their task before. The lists of each round and the removed ranges go to the buckets; what a text loses goes back to its copies
by the hash alone.

Defined results: a null text is empty; texts under the length lose nothing; repeated rows count as
copies; an empty table gives an empty result; columns pass through unless they bear a result's name."""

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.llm.common import checked, mix
from pagelode.session import delete_folder, discard, fresh_path, materialise, shuffles_dropped

#: Length of a string; of the first bucket; starts in a block.
LENGTH, FIRST, BLOCK = 200, 32, 16
#: Starts of a long text that are worked on at once, and the bytes around them that are read too.
PIECE, MARGIN = 1 << 18, 1024

_PLACE_BITS = np.uint64((1 << 20) - 1)
_K = np.uint64(0x9E3779B97F4A7C15)
_L = np.uint64(0xBF58476D1CE4E5B9)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _K)

RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def named(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bucket names of pairs of bucket names."""
    with np.errstate(over="ignore"):
        z = x * _K
        z += y
        z ^= z >> np.uint64(32)
        z *= _L
        z ^= z >> np.uint64(29)
    return z


class Buckets:
    """Bucket names of a piece of text at every offset: of 32, 185 and 200 bytes."""

    def __init__(self, raw: bytes):
        names, width = _BYTE[np.frombuffer(raw, np.uint8)], 1
        while width < 128:
            names, width = named(names[:-width], names[width:]), 2 * width
            if width == FIRST:
                self.first = names
        self.starts = len(raw) - LENGTH + 1
        core = LENGTH - BLOCK + 1
        self.whole = named(names[: self.starts], names[LENGTH - 128 :][: self.starts])
        self.core = named(names[: len(raw) - core + 1], names[core - 128 :])

    def smallest(self) -> np.ndarray:
        """For each start the offset of the smallest 32-byte bucket in its 200 bytes, the last of
        equal ones, so that it depends on those bytes alone."""
        low = (self.first & ~_PLACE_BITS) | (_PLACE_BITS - np.arange(len(self.first), dtype=np.uint64))
        span, width = LENGTH - FIRST + 1, 1
        while width < 128:
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        low = np.minimum(low[: self.starts], low[span - 128 :][: self.starts])
        return (_PLACE_BITS - (low & _PLACE_BITS)).astype(np.int64)


def pieces(size: int):
    """(first start, end of starts, begin, end of bytes) of each piece of a text of ``size`` bytes."""
    for low in range(0, max(0, size - LENGTH + 1), PIECE):
        high = min(low + PIECE, size - LENGTH + 1)
        yield low, high, max(0, low - MARGIN), min(size, high + MARGIN)


def runs(text: bytes) -> tuple:
    """(bucket, name, start, length, lead) of every run; lead is from its start to its bucket's place."""
    out = []
    for low, high, begin, end in pieces(len(text)):
        b = Buckets(text[begin:end])
        place = b.smallest()[low - begin : high - begin]
        cuts = np.flatnonzero(np.diff(place)) + 1
        first, last = np.r_[0, cuts] + low - begin, np.r_[cuts, len(place)] - 1 + low - begin
        place = place[first - (low - begin)]
        lead, length = place - first, last - first + 1
        name = named(named(b.whole[first], b.whole[last]), (length << 16 | lead).astype(np.uint64))
        out.append((b.first[place], name, first + begin, length, lead))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.empty(0, np.int64) for _ in range(5))


def blocks(text: bytes, first: np.ndarray, length: np.ndarray, lead: np.ndarray) -> tuple:
    """(shared bytes, name, nominal start, low, high) of the blocks that hold starts of the given runs."""
    last_start, out = len(text) - LENGTH, []
    for low, high, begin, end in pieces(len(text)):
        here = (first >= low) & (first < high)
        if not here.any():
            continue
        b = Buckets(text[begin:end])
        f, place, n = first[here], (first + lead)[here], length[here]
        near, far = (place - f - n + 1) // BLOCK, (place - f) // BLOCK
        count = far - near + 1
        j = np.repeat(near, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        x = np.repeat(place, count) - BLOCK * j - (BLOCK - 1)
        lo, hi = np.maximum(x, 0), np.minimum(x + BLOCK - 1, last_start)
        ends = ((lo - x) * BLOCK + (hi - x)).astype(np.uint64)
        name = named(named(b.whole[lo - begin], b.whole[hi - begin]), ends)
        out.append((b.core[x + BLOCK - 1 - begin], name, x, lo, hi))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.empty(0, np.int64) for _ in range(5))


def starts(text: bytes, nominal: np.ndarray) -> tuple:
    """(bucket of 200 bytes, start) of all starts in the blocks with the given nominal starts."""
    every = np.unique((nominal[:, None] + np.arange(BLOCK)).ravel())
    every, out = every[(every >= 0) & (every <= len(text) - LENGTH)], []
    for low, high, begin, end in pieces(len(text)):
        here = every[(every >= low) & (every < high)]
        if len(here):
            out.append((Buckets(text[begin:end]).whole[here - begin], here))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.empty(0, np.int64) for _ in range(2))


def removed_spans(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the strings that start in the given ranges of starts."""
    out: list[list[int]] = []
    for i in np.argsort(low, kind="stable"):
        a, b = int(low[i]), int(high[i]) + LENGTH
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


# --- the rounds --------------------------------------------------------------------------------


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _rows(keys: list, found: list[tuple], names: list[str]) -> pa.RecordBatch:
    """A batch with a key and the columns of each text's arrays."""
    columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(len(names) - 1)]
    key = np.repeat(np.array(keys, np.int64), [len(f[0]) for f in found]) if found else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([_signed(key), *[_signed(c) for c in columns]], names=names)


def _over_texts(texts: DataFrame, work, label: str) -> DataFrame:
    """``key, bucket, name, place`` of what ``work(text, *lists)`` returns for each text, written. ``texts`` is key, text and
    lists."""

    def run(batches):
        for batch in batches:
            raw = batch.column(1).cast(pa.binary())
            given = range(2, batch.num_columns)
            found = [work(raw[i].as_py(), *[batch.column(c)[i].values.to_numpy() for c in given]) for i in range(len(raw))]
            yield _rows(batch.column(0).to_pylist(), found, ["key", "bucket", "name", "place"])

    return materialise(texts.mapInArrow(run, "key bigint, bucket bigint, name bigint, place bigint"), label)


# A place is one number. Of a run: start, length, lead. Of a block: nominal start (which may lie before the text), first and
# last start in it.


def _runs(text: bytes) -> tuple:
    bucket, name, start, length, lead = runs(text)
    return bucket, name, start << 16 | length << 8 | lead


def _blocks(text: bytes, place: np.ndarray) -> tuple:
    core, name, x, low, high = blocks(text, place >> 16, place >> 8 & 255, place & 255)
    return core, name, x + BLOCK << 8 | low - x << 4 | high - x


def _starts(text: bytes, place: np.ndarray) -> tuple:
    whole, start = starts(text, (place >> 8) - BLOCK)
    return whole, whole, start


def _run_range(rows: DataFrame) -> DataFrame:
    low = F.shiftright("place", 16)
    return rows.select("key", low.alias("low"), (low + F.shiftright("place", 8).bitwiseAND(F.lit(255)) - 1).alias("high"))


def _block_range(rows: DataFrame) -> DataFrame:
    x = F.shiftright("place", 8) - BLOCK
    low, high = (F.shiftright("place", n).bitwiseAND(F.lit(15)) for n in (4, 0))
    return rows.select("key", (x + low).alias("low"), (x + high).alias("high"))


def decided(rows: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Of ``rows`` those that are repeated, and those to be refined: a class (bucket, name) in two places is
    repeated; in buckets with several names, one member of each class goes on. Last, the tables both are read from."""
    spot = F.xxhash64("key", "place")
    by_bucket = rows.groupBy("bucket").agg(
        F.min(spot).alias("p"), F.max(spot).alias("q"), F.min("name").alias("v"), F.max("name").alias("w")
    )
    met = materialise(by_bucket.where("p <> q").select("bucket", (F.col("v") == F.col("w")).alias("same")), "met")
    rows = materialise(rows.join(checked(met), "bucket"), "shared")
    pure = rows.where("same").drop("same")
    mixed = rows.where(~F.col("same")).drop("same").withColumn("spot", spot)
    classes = materialise(mixed.groupBy("bucket", "name").agg(F.min("spot").alias("p"), F.max("spot").alias("q")), "classes")
    mixed = mixed.join(checked(classes), ["bucket", "name"])
    return pure.unionByName(mixed.where("p <> q").drop("spot", "p", "q")), mixed.where("spot = p").drop("spot", "p", "q"), [met, rows, classes]


class Texts:
    """The different texts of ``docs`` as ``key, text, n, size`` (copies, bytes), bucketed by ``key``. Each task keeps one of the copies it
    has before texts are shuffled, so that a text in a third of all rows is sent once a task."""

    def __init__(self, docs: DataFrame, text: str):
        self.spark = docs.sparkSession
        self.name, self.path = f"pagelode_texts_{uuid.uuid4().hex}", fresh_path(self.spark, "texts")
        whole = F.coalesce(F.col(text), F.lit(""))
        given = docs.select(F.xxhash64(whole).alias("key"), whole.alias("text"))
        each = given.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
        each = each.withColumn("size", F.octet_length("text").cast("bigint"))
        write = each.write.bucketBy(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "key").sortBy("key")
        with shuffles_dropped(self.spark):
            write.option("path", self.path).option("compression", "zstd").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def with_lists(self, lists: DataFrame, how: str = "inner") -> DataFrame:
        """``key, text`` and the lists of a text, which go to its bucket."""
        columns = [c for c in lists.columns if c != "key"]
        return self.table().select("key", "text").join(lists.hint("merge"), "key", how).select("key", "text", *columns)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_folder(self.spark, self.path)


def _places(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.collect_list("place").alias("place"))


def repeated_ranges(texts: Texts) -> DataFrame:
    """``key, low, high`` lists: for each text by its hash, ranges of starts whose strings occur elsewhere."""
    long_ = texts.table().where(f"size >= {LENGTH}")
    full = long_.where("n > 1").select("key", F.lit(0).cast("bigint").alias("low"), (F.col("size") - LENGTH).alias("high"))

    first = _over_texts(long_.select("key", "text"), _runs, "runs")
    done, open_, read = decided(first)
    found = [materialise(_run_range(done), "run-ranges")]
    second = _over_texts(texts.with_lists(_places(open_)), _blocks, "blocks")
    discard(first, *read)

    done, open_, read = decided(second)
    found.append(materialise(_block_range(done), "block-ranges"))
    third = _over_texts(texts.with_lists(_places(open_)), _starts, "starts")
    discard(second, *read)

    spot = F.xxhash64("key", "place")
    met = materialise(third.groupBy("bucket").agg(F.min(spot).alias("p"), F.max(spot).alias("q")).where("p <> q").select("bucket"), "met")
    done = third.join(checked(met), "bucket", "left_semi")
    every = found[0].union(found[1]).union(done.select("key", F.col("place").alias("low"), F.col("place").alias("high"))).union(full)
    lists = every.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("l"))
    ranges = materialise(lists.select("key", "l.low", "l.high"), "ranges")
    discard(third, met, *found)
    return ranges


_RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in RESULT[:3]] + [T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]
)


def _cut(whole: bool):
    @F.pandas_udf(_RESULT if whole else T.StructType(_RESULT.fields[:4]))
    def cut(texts: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.DataFrame:
        rows = []
        for text, low, high in zip(texts, lows, highs):
            raw = (text or "").encode()
            spans = removed_spans(np.asarray(low), np.asarray(high)) if low is not None else []
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            left = b"".join([*kept, raw[at:]])
            row = (len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest())
            rows.append((*row, left) if whole else row)
        return pd.DataFrame(rows, columns=RESULT[: 5 if whole else 4])

    return cut


def remove_repeats(docs: DataFrame, text: str = "text", whole: bool = False) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept_sha256``, and with ``whole`` the bytes ``kept``."""
    names = RESULT[: 5 if whole else 4]
    columns = [c for c in docs.columns if c not in names]
    texts = Texts(docs, text)
    ranges = repeated_ranges(texts)
    cut = texts.with_lists(ranges, "left").select(F.col("key").alias("__key"), _cut(whole)(F.col("text"), F.col("low"), F.col("high")).alias("__r"))
    cut = materialise(cut, "cut")
    discard(ranges)
    texts.close()
    cut = cut if whole else checked(cut)
    keyed = docs.select("*", F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__key")).join(cut, "__key")
    return keyed.select(*columns, "__r.*")
