"""Vectors as short codes: a codebook for each part of the vector, fitted by Lloyd's rounds over two trees.

A task lays its vectors out in blocks; a block holds a tree over the vectors' parts for each part position, with the box,
the sum and the members of every node. The entries of a codebook have such a tree too. Both are descended
together: an entry node leaves a data node's list when its least distance from the node's box is over the largest distance
of another one, and a data node with one entry left is assigned whole, by its stored sum. Leaves with several entries left
are compared in integers. Nothing is approximate: ties are never pruned and go to the lower index.

Blocks are written once and read by every round. A round sends a count and a sum for each codebook entry and task; the
driver holds codebooks (parts x entries x width), nothing that grows with the rows.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped. Null and repeated keys are
kept as rows; the first codebooks take keys in order, nulls last, equal keys by their vectors. Fewer rows than entries make
as many entries as rows; no rows give no rows. Vectors whose size is no multiple of the parts, or differs, count as
filled up with zeros. Components are exact up to ``LARGEST``; beyond that an error is raised. Other columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from pagelode.llm.common import checked
from pagelode.session import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Vectors of a block, and parts in a leaf of its trees.
BLOCK, LEAF = 2048, 32
#: Largest integer component: sums of squares of 4,096 components fit 64 bits.
LARGEST = 1 << 24


# --- trees ---------------------------------------------------------------------------------------


def edges_of(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin and end in a tree's order of ``n`` members: halves of halves."""
    edges = np.array([0, n])
    for _ in range(level):
        edges = np.sort(np.concatenate([edges, (edges[:-1] + edges[1:]) // 2]))
    return edges


def depth_of(n: int, leaf: int) -> int:
    return max(0, math.ceil(math.log2(n / leaf)))


def grow(points: np.ndarray, leaf: int) -> np.ndarray:
    """The order of the points in a tree that halves each node along its widest side."""
    order = np.arange(len(points))
    for level in range(depth_of(len(points), leaf)):
        edges = edges_of(len(points), level)
        laid = points[order]
        wide = (np.maximum.reduceat(laid, edges[:-1]) - np.minimum.reduceat(laid, edges[:-1])).argmax(axis=1)
        node = np.repeat(np.arange(len(wide)), np.diff(edges))
        order = order[np.lexsort((laid[np.arange(len(laid)), wide[node]], node))]
    return order


@dataclass
class Tree:
    """Points in tree order with the nodes of all levels, root first: node k has the children 2k + 1 and 2k + 2."""

    points: np.ndarray
    depth: int
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def over(cls, points: np.ndarray, leaf: int) -> Tree:
        """The tree of points that are in its order already."""
        depth = depth_of(len(points), leaf)
        levels = [edges_of(len(points), level) for level in range(depth + 1)]
        low, high = [np.minimum.reduceat(points, levels[-1][:-1])], [np.maximum.reduceat(points, levels[-1][:-1])]
        for _ in range(depth):
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
        start, end = np.concatenate([e[:-1] for e in levels]), np.concatenate([e[1:] for e in levels])
        return cls(points, depth, np.concatenate(low), np.concatenate(high), start, end)

    def sums(self) -> np.ndarray:
        """Sum of the points of every node."""
        total = [np.add.reduceat(self.points, self.start[(1 << self.depth) - 1 :])]
        for _ in range(self.depth):
            total.insert(0, total[0][::2] + total[0][1::2])
        return np.concatenate(total)


class EntryTree:
    """A codebook's entries in a tree whose leaves hold one or two of them."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.order = entries, grow(entries, 2)
        self.tree = Tree.over(entries[self.order], 2)


def _prune(tree: Tree, low, high, q, e):
    """Drop pairs (data node, entry node; sorted by ``q``) whose least distance is over the node's bound: the smallest of
    the largest distances to its entry nodes. Every point then has its nearest entries left."""
    gap = np.maximum(0, np.maximum(tree.low[q] - high[e], low[e] - tree.high[q]))
    far = np.maximum(tree.high[q] - low[e], high[e] - tree.low[q])
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    bound = np.minimum.reduceat((far * far).sum(axis=1), first)
    keep = (gap * gap).sum(axis=1) <= np.repeat(bound, np.diff(np.r_[first, len(q)]))
    return q[keep], e[keep]


def descend(tree: Tree, book: EntryTree):
    """``whole``: data nodes that get one entry, and these entries; ``open``: the data leaves with several, as pairs."""
    q, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    whole_node, whole_entry = [], []
    low, high, level, single = book.tree.low, book.tree.high, 0, False
    first_leaf = (1 << tree.depth) - 1
    while len(q):
        if not single:
            if level < book.tree.depth:
                level += 1
                q, e = np.repeat(q, 2), (2 * np.repeat(e, 2) + np.tile([1, 2], len(e)))
            else:
                size = book.tree.end[e] - book.tree.start[e]
                place = np.repeat(book.tree.start[e], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                q, e = np.repeat(q, size), book.order[place]
                low = high = book.entries
                single = True
            q, e = _prune(tree, low, high, q, e)
        if single:
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            alone = np.repeat(np.diff(np.r_[first, len(q)]) == 1, np.diff(np.r_[first, len(q)]))
            whole_node.append(q[alone])
            whole_entry.append(e[alone])
            q, e = q[~alone], e[~alone]
            if not len(q) or q[0] >= first_leaf:
                break
        if q[0] < first_leaf:
            q, e = np.concatenate([2 * q + 1, 2 * q + 2]), np.concatenate([e, e])
            by_node = np.argsort(q, kind="stable")
            q, e = _prune(tree, low, high, q[by_node], e[by_node])
    return (np.concatenate(whole_node), np.concatenate(whole_entry)), (q, e)


def _open_leaves(tree: Tree, book: EntryTree, q, e):
    """For each open leaf its place and the nearest of its entries for every point, in integers."""
    if not len(q):
        return
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    for i, j in zip(first, np.r_[first[1:], len(q)], strict=True):
        candidates = np.sort(e[i:j])
        at = slice(tree.start[q[i]], tree.end[q[i]])
        apart = tree.points[at][:, None, :] - book.entries[candidates][None]
        yield at, candidates[(apart * apart).sum(axis=2).argmin(axis=1)]


def nearest_entries(tree: Tree, book: EntryTree) -> np.ndarray:
    """Index of the nearest entry of every point of the tree, in its order."""
    (nodes, entries), leaves = descend(tree, book)
    codes = np.empty(len(tree.points), np.int64)
    for node, entry in zip(nodes, entries, strict=True):
        codes[tree.start[node] : tree.end[node]] = entry
    for at, nearest in _open_leaves(tree, book, *leaves):
        codes[at] = nearest
    return codes


def add_sums(tree: Tree, sums: np.ndarray, book: EntryTree, totals: np.ndarray, counts: np.ndarray) -> None:
    """Add the members of each entry to ``totals`` and ``counts``: whole nodes by their stored sums."""
    (nodes, entries), leaves = descend(tree, book)
    np.add.at(totals, entries, sums[nodes])
    np.add.at(counts, entries, tree.end[nodes] - tree.start[nodes])
    for at, nearest in _open_leaves(tree, book, *leaves):
        np.add.at(totals, nearest, tree.points[at])
        np.add.at(counts, nearest, 1)


# --- blocks --------------------------------------------------------------------------------------


def to_integers(vectors: pa.Array, size: int) -> np.ndarray:
    """A matrix of floor(256 x), zeros beyond the end of a vector."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(SCALE * vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"a component times {SCALE} is not under {LARGEST}")
    out = np.zeros((len(vectors), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = flat.astype(np.int64)
    return out


def _pack(numbers: np.ndarray, kinds=(np.int16, np.int32, np.int64)) -> bytes:
    """The numbers in the smallest of the kinds that holds them, its number of bytes first."""
    kind = next(k for k in kinds if k is np.int64 or not numbers.size or np.abs(numbers).max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + numbers.astype(kind).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def _wide(size: int) -> int:
    return max(1, -(-size // PARTS))


def lay_out(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of the rows ``key, label, vector``, written: keys and labels, and for each part position the order of its
    tree, the parts in that order and the sums of its nodes."""
    width = _wide(size)
    schema = StructType(
        [
            StructField("keys", ArrayType(rows.schema["key"].dataType)),
            StructField("labels", ArrayType(rows.schema["label"].dataType)),
            *[StructField(c, BinaryType()) for c in ("orders", "points", "sums")],
        ]
    )

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        ends = pa.array([0, part.num_rows], pa.int32())
        keys, labels = (pa.ListArray.from_arrays(ends, part.column(i)) for i in (0, 1))
        matrix = to_integers(part.column(2), PARTS * width)
        orders, points, sums = [], [], []
        for i in range(PARTS):
            own = matrix[:, i * width : (i + 1) * width]
            order = grow(own, LEAF)
            orders.append(order)
            points.append(own[order])
            sums.append(Tree.over(own[order], LEAF).sums())
        packed = [pa.array([_pack(np.stack(x))], pa.binary()) for x in (orders, points, sums)]
        return pa.RecordBatch.from_arrays([keys, labels, *packed], names=schema.names)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                yield one(batch.slice(i, BLOCK))

    return materialise(rows.select("key", "label", "vector").mapInArrow(run, schema), "blocks")


def _trees(width: int, orders: bytes, points: bytes, sums: bytes):
    """Of each part position of a block: order, tree and node sums."""
    orders = _unpack(orders).reshape(PARTS, -1)
    points, sums = _unpack(points).reshape(PARTS, -1, width), _unpack(sums).reshape(PARTS, -1, width)
    return [(orders[i], Tree.over(points[i], LEAF), sums[i]) for i in range(PARTS)]


def new_codebooks(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of its parts; unused ones stay."""
    width = books.shape[2]

    def run(batches):
        trees = [EntryTree(book) for book in books]
        totals, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for columns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, (_, tree, sums) in enumerate(_trees(width, *columns)):
                    add_sums(tree, sums, trees[i], totals[i], counts[i])
        part, entry = counts.nonzero()
        if len(part):
            sent = [pa.array(x) for x in (part, entry, counts[part, entry])]
            yield pa.RecordBatch.from_arrays([*sent, pa.array(list(totals[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    sent = blocks.select("orders", "points", "sums").mapInArrow(run, "part bigint, entry bigint, n bigint, sums array<bigint>")
    flat = sent.select("part", "entry", "n", F.posexplode("sums").alias("place", "x"))
    # As many rows as the codebooks have integers, however many vectors there are.
    found = flat.groupBy("part", "entry", "place").agg(F.sum("n"), F.sum("x")).collect()
    books = books.copy()
    for part, entry, place, n, x in found:
        books[part, entry, place] = x // n
    return books


def assigned(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``key, label, code, error`` of every vector."""
    width = books.shape[2]
    kind = lambda c: blocks.schema[c].dataType.elementType
    schema = StructType(
        [StructField("key", kind("keys")), StructField("label", kind("labels")), StructField("code", StringType()), StructField("error", LongType())]
    )

    def run(batches):
        trees = [EntryTree(book) for book in books if len(book)]
        for batch in batches:
            for row in range(batch.num_rows):
                keys, labels = (batch.column(i).slice(row, 1).flatten() for i in (0, 1))
                codes = np.empty((len(keys), PARTS), np.uint8)
                error = np.zeros(len(keys), np.int64)
                for i, (order, tree, _) in enumerate(_trees(width, *(batch.column(c)[row].as_py() for c in (2, 3, 4)))):
                    own = nearest_entries(tree, trees[i])
                    apart = tree.points - books[i][own]
                    codes[order, i] = own
                    error[order] += (apart * apart).sum(axis=1)
                hexes = [c.tobytes().hex() for c in codes]
                yield pa.RecordBatch.from_arrays([keys, labels, pa.array(hexes, pa.string()), pa.array(error)], names=schema.names)

    return blocks.mapInArrow(run, schema)


# --- the operator --------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    x = lambda c: c.cast("double")
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < math.inf))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``key, label, code, error`` of every usable vector, written, and the codebooks (parts, entries, width)."""
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    first = rows.select("vector").orderBy(F.asc_nulls_last("key"), "vector").limit(ENTRIES).collect()
    values = pa.array([list(r[0]) for r in first], pa.list_(pa.float64()))
    width = _wide(size)
    books = to_integers(values, PARTS * width).reshape(len(first), PARTS, width).transpose(1, 0, 2)
    blocks = lay_out(rows, size)
    for _ in range(ROUNDS if len(first) else 0):
        books = new_codebooks(blocks, books)
    return materialise(assigned(blocks, books), "codes"), books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors of all rows of the same label, nulls together. Labels are summed before they are
    joined back, broadcast if their counted size allows it."""
    sums = materialise(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(checked(sums), F.col("label").eqNullSafe(F.col("of"))).drop("of")
