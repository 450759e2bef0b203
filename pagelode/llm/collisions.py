"""Nearest neighbours by inner product with collision-counting hashing.

Rows and queries are dealt to blocks; every query block meets every row block, a cell of bounded
size for one task. In a cell each of many projections is one sorted array of the rows. Around a
query's own projection a window is opened in every array; a row collides where it lies in the window,
and a row with enough collisions is verified by its exact product. The windows are widened step by
step (the hash functions are never rebuilt) until enough rows have been verified or the windows hold
everything. Vectors of unequal length are first extended by one component, so that the nearest by
distance is the largest by inner product. Best rows of all cells are merged by rank.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows
with a null id, take no part; vectors meet only those of their own dimension; rows alike in id and
vector count once, and a query never meets rows of its own id; ties go to the smaller id; fewer rows
than asked for are all returned; an empty table gives an empty result; further columns are ignored."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.session import materialise

#: Rows and queries of a cell.
ROWS, QUERIES = 4096, 4096
#: Projections (255 at most), the share of them in which a candidate collides, and the share of a block's rows that
#: are verified before the search ends.
PROJECTIONS, COLLIDE, VERIFY = 64, 0.7, 0.05
#: Half width of the first windows in typical differences of projections, and its growth.
FIRST_WIDTH, GROWTH = 1.0, 1.06

SCHEMA = "query_id bigint, vec_id bigint, score double"


def directions(dimension: int, count: int = PROJECTIONS) -> np.ndarray:
    """The same projections everywhere: turned axes, as many sets of them as needed."""
    random = np.random.default_rng(dimension)
    sets = [np.linalg.qr(random.standard_normal((dimension, dimension)))[0] for _ in range(-(-count // dimension))]
    return np.concatenate(sets, axis=1)[:, :count]


def search_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
    """(query id, id, score) of the best ``k`` verified rows of a block for each query."""
    n, dimension = rows.shape
    longest = np.sqrt((rows * rows).sum(1).max())
    scaled = rows / longest
    rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
    axes = directions(dimension + 1)
    projected = np.column_stack([scaled, rest]) @ axes
    asked = np.column_stack([queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros(len(queries))]) @ axes
    ordered = np.sort(projected, axis=0)
    places = np.empty(projected.shape, np.uint16)
    np.put_along_axis(places, np.argsort(projected, axis=0, kind="stable"), np.arange(n, dtype=np.uint16)[:, None], axis=0)
    places = np.ascontiguousarray(places.T)
    spread = np.sqrt(2) * np.maximum(projected.std(axis=0), 0.05)
    enough, wanted = int(np.ceil(COLLIDE * axes.shape[1])), min(n, max(4 * k + 1, int(np.ceil(VERIFY * n))))
    out, open_, width = [], np.arange(len(queries)), FIRST_WIDTH * spread
    while len(open_):
        # The windows of all open queries, one sorted array after the other.
        low = np.stack([np.searchsorted(a, x, "left") for a, x in zip(ordered.T, (asked[open_] - width).T)], axis=1)
        high = np.stack([np.searchsorted(a, x, "right") for a, x in zip(ordered.T, (asked[open_] + width).T)], axis=1)
        ended = np.zeros(len(open_), bool)
        for i, (q, first, size) in enumerate(zip(open_, low.astype(np.uint16), (high - low).astype(np.uint16))):
            inside = (places - first[:, None]) < size[:, None]
            found = np.flatnonzero(inside.sum(axis=0, dtype=np.uint8) >= enough)
            ended[i] = len(found) >= wanted or bool((high[i] - low[i] == n).all())
            if ended[i]:
                found = found[ids[found] != query_ids[q]]
                scores = (rows[found] * queries[q]).sum(axis=1)
                best = np.lexsort((ids[found], -scores))[:k]
                out.append((np.full(len(best), query_ids[q]), ids[found][best], scores[best]))
        open_, width = open_[~ended], width * GROWTH
    return tuple(np.concatenate(c) for c in zip(*out))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v`` of the vectors that take part, each row once."""
    v = F.col("v")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    given = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return given.where(F.col("vec_id").isNotNull() & v.isNotNull() & good).dropDuplicates(["vec_id", "v"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest of ``vectors``."""
    rows = materialise(usable(vectors, vec_id, vector), "vectors")
    asked = materialise(usable(queries, vec_id, vector), "queries")
    row_blocks, query_blocks = max(1, -(-rows.count() // ROWS)), max(1, -(-asked.count() // QUERIES))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cell = ["dimension", "rb", "qb"]
    left = rows.select("*", F.size("v").alias("dimension"), block(row_blocks).alias("rb"), all_of(query_blocks).alias("qb"))
    right = asked.select("*", F.size("v").alias("dimension"), all_of(row_blocks).alias("rb"), block(query_blocks).alias("qb"))

    def search(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        # Sorted, so that the result does not depend on the order in which rows arrive.
        mine, theirs = mine.sort_values("vec_id"), theirs.sort_values("vec_id")
        found = search_block(mine["vec_id"].to_numpy(), np.stack(mine["v"]), theirs["vec_id"].to_numpy(), np.stack(theirs["v"]), k)
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], found)))

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(search, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
