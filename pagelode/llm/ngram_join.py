"""Near copies by a Jaccard join on word shingles, with token-combination prefixes.

Tokens are 64-bit hashes of five-word shingles; documents with the same set are one node. A set of n
tokens that links with another at 80 % misses at most t = n - ceil(0.8 n) of its tokens, so in a
common order of all tokens its first t + 1 hold one that the other has among its own first ones.
Tokens are ordered by hash. Tokens that too many nodes index ("frequent") form a class of their own,
behind all others: a node whose first tokens hold frequent ones takes rarer tokens instead, and if
it has too few of them, extends its prefix by frequent ones and indexes pairs of them. Frequent tokens are
dealt to sub-classes by hash and paired inside a sub-class only: with c tokens of one in the prefix, c - 1 misses still leave a common
pair, so the prefix is extended until these numbers add up to more than the misses. There are about as many sub-classes as a set
of that size may have misses, which keeps the pairs of a node in proportion to its tokens.
Candidates are compared inside the index buckets without forming all pairs; bit sets rule out most of
those that are not alike, and the rest are verified by their whole sets.

Defined results: a null or empty text, or one without words, has an empty set and links with nothing;
fewer than five words are one token; rows with the same text are linked with each other; a null id
is allowed and never the smallest; an empty table gives an empty result; further columns are ignored
by the join and kept by ``first_of_each``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import BROADCAST_BYTES, WordHash, checked, components, distinct_shingles, links_in_buckets, mix, parity_bits, release, shared, verified
from pagelode.session import materialise

WIDTH, PERCENT = 5, 80
#: A token is frequent if more nodes than this have it.
FREQUENT = 1000

#: Tokens of the nodes that a task counts together, and from how many of them on a token is noted.
RECENT, OFTEN = 1 << 20, 4

#: Documents that a task works on at a time; bounds what it holds of sets and index values.
SLICE = 256


def pieces(batches):
    """Arrow batches cut into slices."""
    release()
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE):
            yield batch.slice(low, SLICE)
    release()

NODE_COLUMNS = ["doc_id", "mark", "n", "node", "prefix", "bits", "often", "often_n"]

_signed = lambda values: np.ascontiguousarray(values).view(np.int64)


def misses(n: int) -> int:
    """How many of its n tokens a set may lack in one that it links with."""
    return n - (PERCENT * n + 99) // 100


def set_name(tokens: np.ndarray) -> int:
    """64-bit name of a sorted token set, as a signed integer."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def _lists(values: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if v is None else len(v) for v in values], np.int64)
    flat = np.concatenate([v for v in values if v is not None and len(v)] or [np.empty(0, np.int64)])
    mask = np.array([v is None for v in values] + [False])
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=mask if mask.any() else None)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64()))


def nodes_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each document, written: ``doc_id, mark`` (hash of the text)``, n, node``; with the first document
    of a node in each task also ``prefix`` (its first tokens) and ``bits`` (see ``parity_bits``); and from time to time
    ``often``: tokens that ``OFTEN`` or more of the last nodes have, with their number."""

    def prepare(batches):
        known, seen, recent, held = WordHash(), set(), [], 0
        for batch in pieces(batches):
            sets = [distinct_shingles(t, WIDTH, known) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            names = [set_name(s) if len(s) else None for s in sets]
            prefixes, bits, often = [], [], [None] * len(sets)
            for s, name in zip(sets, names):
                new = name is not None and name not in seen
                prefixes.append(_signed(s[: misses(len(s)) + 1]) if new else None)
                bits.append(parity_bits(s) if new else None)
                if new:
                    seen.add(name)
                    recent.append(s)
                    held += len(s)
            if held >= RECENT and sets:
                often[-1], recent, held = heavy(recent), [], 0
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array(names, pa.int64()),
                _lists(prefixes),
                _lists(bits),
                _lists([None if o is None else o[0] for o in often]),
                _lists([None if o is None else o[1] for o in often]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=NODE_COLUMNS)
        if recent:
            last = heavy(recent)
            none = [pa.array([None], kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, _lists([None]), _lists([None]), _lists([last[0]]), _lists([last[1]])], names=NODE_COLUMNS)

    given = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    kinds = ["bigint", "bigint", "int", "bigint", *["array<bigint>"] * 4]
    return materialise(given.mapInArrow(prepare, ", ".join(f"{c} {k}" for c, k in zip(NODE_COLUMNS, kinds))), "nodes")


def heavy(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that ``OFTEN`` or more of the sets have, and how many."""
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    return _signed(tokens[counts >= OFTEN]), counts[counts >= OFTEN]


def wanted_texts(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text`` of one document of each of the ``wanted`` nodes; rows alike in id and text come together."""
    given = nodes.where("prefix IS NOT NULL").join(checked(wanted), "node", "left_semi")
    given = materialise(given.groupBy("node").agg(F.min(F.struct("doc_id", "mark")).alias("d")).select("d.*").distinct(), "wanted")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("d"), F.xxhash64(text).alias("m"), F.col(text).alias("text"))
    return texts.join(checked(given), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark")), "left_semi").select("text")


def token_sets(texts: DataFrame) -> DataFrame:
    """``node, n, tokens`` of texts, written; a set that a task meets again is passed over."""

    def sets(batches):
        known, seen = WordHash(), set()
        for batch in pieces(batches):
            found = [distinct_shingles(t, WIDTH, known) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            named = [(set_name(s), s) for s in found]
            named = [(name, s) for name, s in named if not (name in seen or seen.add(name))]
            names = pa.array([name for name, _ in named], pa.int64())
            sizes = pa.array([len(s) for _, s in named], pa.int32())
            yield pa.RecordBatch.from_arrays([names, sizes, _lists([_signed(s) for _, s in named])], names=["node", "n", "tokens"])

    return materialise(texts.mapInArrow(sets, "node bigint, n int, tokens array<bigint>"), "sets")


def subclasses(n: int) -> list[int]:
    """Numbers of sub-classes, powers of two, under which a set of ``n`` tokens is indexed: those of all sizes it can link with."""
    of = lambda size: 1 << max(0, (size // 5).bit_length() - 1)
    return sorted({of(max(1, -(-PERCENT * n // 100))), of(n), of(100 * n // PERCENT)})


def signatures(rare: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Index values of a set from its tokens of both classes, each in order: rare tokens singly, and for the extended
    prefix the pairs of frequent ones that lie in the same sub-class. With k of these a quarter of the tokens at most, the
    whole set is always enough; sub-classes of a smaller number hold those of a larger one, so that equal pairs have one value."""
    n = len(rare) + len(frequent)
    need = misses(n) + 1
    if len(rare) >= need:
        return rare[:need]
    found = [rare]
    for k in subclasses(n):
        own = frequent & np.uint64(k - 1)
        repeated = np.ones(len(own), bool)
        repeated[np.unique(own, return_index=True)[1]] = False
        enough = np.searchsorted(np.cumsum(repeated), need - len(rare)) + 1
        by_class = np.argsort(own[:enough], kind="stable")
        own, chosen = own[by_class], frequent[by_class]
        for apart in range(1, len(chosen)):
            same = np.flatnonzero(own[apart:] == own[:-apart])
            if not len(same):
                break
            with np.errstate(over="ignore"):
                found.append(mix(chosen[same] * np.uint64(3) + mix(chosen[same + apart])))
    return np.unique(np.concatenate(found))


def additions(tokens: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Index values of a set, its ``tokens`` in order, that its first tokens do not give: with those of these that are not
    ``often``, its ``signatures``. A set with rare tokens enough has one for each frequent token among the first."""
    first = misses(len(tokens)) + 1
    return np.setdiff1d(signatures(tokens[~often], tokens[often]), tokens[:first][~often[:first]])


def extended(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """``bucket, node, n``: the ``additions`` of texts under the token classes that the written table ``frequent`` (token) makes. The
    class goes to the tasks as a sorted array while it fits a broadcast; beyond, tokens are joined with it."""
    if frequent.count() * 8 <= BROADCAST_BYTES:
        # Bounded by the check above: the frequent tokens, not the corpus.
        values = np.sort(np.array([r[0] for r in frequent.select("token").collect()], np.int64).view(np.uint64))
        shared_values = texts.sparkSession.sparkContext.broadcast(values)

        def index(batches):
            known, seen, often = WordHash(), set(), shared_values.value
            for batch in pieces(batches):
                nodes, sizes, found = [], [], [np.empty(0, np.uint64)]
                for t in batch.column(0).cast(pa.binary()).to_pylist():
                    tokens = distinct_shingles(t, WIDTH, known)
                    name = set_name(tokens)
                    if name not in seen:
                        seen.add(name)
                        found.append(additions(tokens, np.isin(tokens, often)))
                        nodes.append(name)
                        sizes.append(len(tokens))
                yield _index_rows(nodes, sizes, found[1:])

        return materialise(texts.mapInArrow(index, _INDEX), "extended")

    def joined(batches):
        for batch in batches:
            found = []
            for tokens, often in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own, flags = np.array(tokens, np.int64).view(np.uint64), np.array(often, bool)
                order = np.argsort(own)
                found.append(additions(own[order], flags[order]))
            yield _index_rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), found)

    flags = token_sets(texts).select("node", "n", F.explode("tokens").alias("token"))
    flags = flags.join(frequent.select("token", F.lit(True).alias("often")), "token", "left")
    pairs = F.collect_list(F.struct("token", F.coalesce("often", F.lit(False)).alias("often")))
    # The tokens of one text: as many as it has words at most.
    grouped = flags.groupBy("node", "n").agg(pairs.alias("p")).select("node", "n", "p.token", "p.often")
    return materialise(grouped.mapInArrow(joined, _INDEX), "extended")


_INDEX = "bucket bigint, node bigint, n int"


def _index_rows(nodes: list, sizes: list, found: list[np.ndarray]) -> pa.RecordBatch:
    counts = [len(f) for f in found]
    flat = np.concatenate([*found, np.empty(0, np.uint64)])
    columns = [pa.array(_signed(flat)), pa.array(np.repeat(np.array(nodes, np.int64), counts)), pa.array(np.repeat(np.array(sizes, np.int32), counts))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "node", "n"])


def index_members(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, frequent: int) -> DataFrame:
    """``bucket, node, n`` of the index buckets with two nodes or more, written. Tokens that tasks have noted often
    are frequent from the start; should a single token's bucket still be too large, it becomes
    frequent too, until none is. Rows of frequent tokens give way to the ``additions`` of their nodes; all others stay."""
    index = nodes.where("prefix IS NOT NULL").select(F.explode("prefix").alias("bucket"), "node", "n")
    noted = nodes.where("often IS NOT NULL").select(F.inline(F.arrays_zip("often", "often_n"))).groupBy(F.col("often").alias("token"))
    classes = materialise(noted.agg(F.sum("often_n").alias("k")).where(F.col("k") > frequent).select("token"), "frequent")
    while True:
        touched = materialise(index.join(checked(classes), F.col("bucket") == F.col("token"), "left_semi").select("node").distinct(), "touched")
        rows = index
        if not touched.isEmpty():
            new = extended(wanted_texts(docs, doc_id, text, nodes, touched), classes)
            rows = index.join(checked(classes), F.col("bucket") == F.col("token"), "left_anti").union(new)
        members = shared(rows)
        large = members.where(F.col("many") > 4 * frequent).select(F.col("bucket").alias("token")).distinct()
        # Of the large buckets, those of single tokens: values that stand in some prefix.
        single = large.join(index.select(F.col("bucket").alias("token")), "token", "left_semi").join(checked(classes), "token", "left_anti")
        single = materialise(single, "large")
        if single.isEmpty():
            return members.drop("many")
        classes = materialise(classes.union(single), "frequent")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Two written tables: ``doc_id, mark, n, label`` for every document (label null for an empty set),
    and ``label, component_id, first_mark``: the smallest id of each label's documents and its text's mark."""
    nodes = nodes_of(docs, doc_id, text)
    members = index_members(docs, doc_id, text, nodes, frequent)
    sketches = materialise(nodes.where("prefix IS NOT NULL").select("node", "n", "bits").dropDuplicates(["node"]), "sketches")
    sets_of = lambda wanted: token_sets(wanted_texts(docs, doc_id, text, nodes, wanted)).dropDuplicates(["node"])
    links = links_in_buckets(members, verified(sets_of, sketches), sketches)
    groups = components(links).withColumnRenamed("root", "label")
    documents = nodes.where("n IS NOT NULL").select("doc_id", "mark", "n", "node").join(checked(groups), "node", "left")
    documents = materialise(documents.select("doc_id", "mark", "n", F.coalesce("label", "node").alias("label")), "labelled")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("best")
    firsts = documents.where("label IS NOT NULL").groupBy("label").agg(best)
    return documents, materialise(firsts.select("label", F.col("best.doc_id").alias("component_id"), F.col("best.mark").alias("first_mark")), "firsts")


def ngram_jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row for each document."""
    documents, firsts = near_copies(docs, doc_id, text, frequent)
    joined = documents.join(checked(firsts), "label", "left")
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), own.alias("component_id"))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without further copies: of each group the row with the smallest id stays, of
    rows alike in id and text one. Documents with empty sets stay, all of them."""
    documents, firsts = near_copies(docs, doc_id, text)
    copies = documents.where("label IS NOT NULL").groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    stay = firsts.select(F.col("component_id").alias("doc_id"), F.col("first_mark").alias("mark"))
    stay = stay.withColumnsRenamed({"doc_id": "d", "mark": "m"}).join(
        copies, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark"))
    )
    empty = documents.where("label IS NULL").select("doc_id", "mark", F.lit(1).cast("bigint").alias("rows")).distinct()
    stay = materialise(stay.select("doc_id", "mark", "rows").union(empty), "stay")
    keyed = docs.withColumns({"__d": F.col(doc_id).cast("bigint"), "__m": F.xxhash64(text)})
    keys = F.col("__d").eqNullSafe(F.col("__id")) & (F.col("__m") == F.col("__mark"))
    named = lambda rows: checked(rows.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")))
    single = keyed.join(named(stay.where("rows = 1")), keys, "left_semi")
    # Repeated deliveries of one row: few, so that only they are shuffled.
    double = keyed.join(named(stay.where("rows > 1")), keys, "left_semi").dropDuplicates(["__d", "__m"])
    return single.union(double).drop("__d", "__m")
