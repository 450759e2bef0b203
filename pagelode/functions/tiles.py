"""Many queries against blocks of documents, on arrays.

A block holds all postings of its documents that any of the queries may look up, grouped by term and field (``key``; its lowest bits
are the field). A query's scores in a block are sums over the posting lists of its terms, laid out by document; only its best
documents so far are kept from block to block. Values are those of ``plans.ranked``: term scores come from the caller, this module adds,
compares positions and multiplies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa

#: Low bits of a key that hold its field.
FIELD_BITS = 2
#: Postings dealt to blocks at once, about, and bytes of them.
PACK_ROWS, PACK_BYTES = 400_000, 32 << 20
#: Queries whose results are given back in one batch.
OUT_QUERIES = 64

PIECE = "block int, key binary, doc binary, code binary, parts binary, len binary, n_pos binary, pos binary, rank binary"
BLOCK = "block int, key binary, n binary, doc binary, code binary, parts binary, n_pos binary, pos binary, doc_id binary, len binary, rank binary"


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on as bytes, in the smallest type that holds them; floats as they are."""
    if values.dtype.kind != "f":
        top = int(values.max()) if len(values) else 0
        values = values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if top <= np.iinfo(t).max))
    return values.dtype.char.encode() + values.tobytes()


def wide(data: bytes) -> np.ndarray:
    """Back from ``narrow``."""
    view = memoryview(data)
    return np.frombuffer(view[1:], np.dtype(chr(view[0])))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _binary_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings ``block, key, doc_id, part, field_len, rank, positions`` to rows that hold many postings of one block each, so that
    what is exchanged is a few large rows."""
    schema = _binary_schema(PIECE)
    held: list[pa.RecordBatch] = []

    def packed() -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: whole[name].chunk(0)
        block, key, doc = (column(n).to_numpy() for n in ("block", "key", "doc_id"))
        order = np.lexsort((key, block))
        lists = column("positions")
        offsets = lists.offsets.to_numpy()
        positions, n_pos = lists.values.to_numpy(), np.diff(offsets)
        part, length = column("part").to_numpy(), column("field_len").to_numpy()
        rank = column("rank").to_numpy(zero_copy_only=False).astype(np.float64)  # NaN where null
        block, cuts = block[order], np.flatnonzero(np.diff(block[order], prepend=-1))
        for at, to in zip(cuts, np.append(cuts[1:], len(block))):
            own = order[at:to]
            keys = key[own]
            parts, code = np.unique(part[own], return_inverse=True)
            row = {
                "block": int(block[at]),
                "key": keys.tobytes(),
                "doc": doc[own].tobytes(),
                "code": narrow(code),
                "parts": narrow(parts),
                "len": narrow(length[own]),
                "n_pos": narrow(n_pos[own]),
                "pos": narrow(positions[ranges(offsets[own].astype(np.int64), n_pos[own])]),
                "rank": narrow(rank[own][keys & ((1 << FIELD_BITS) - 1) == 0]),
            }
            yield _rows([row], schema)

    n = size = 0
    for batch in batches:
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.nbytes
        if n >= PACK_ROWS or size >= PACK_BYTES:
            yield from packed()
            held.clear()
            n = size = 0
    if n:
        yield from packed()


def one_block(table: pa.Table) -> pa.Table:
    """The pieces of a block as one row, its postings ordered by key and document."""
    joined = lambda name: np.concatenate([wide(v.as_buffer()) for v in table[name]])
    ids = lambda name: np.concatenate([np.frombuffer(v.as_buffer(), np.int64) for v in table[name]])
    key, length, rank, n_pos = ids("key"), *(joined(n) for n in ("len", "rank", "n_pos"))
    part = np.concatenate([wide(p.as_buffer())[wide(c.as_buffer())] for p, c in zip(table["parts"], table["code"])])
    n_pos = n_pos.astype(np.int64)
    doc_id, doc = np.unique(ids("doc"), return_inverse=True)
    field = key & ((1 << FIELD_BITS) - 1)
    ranks = np.full(len(doc_id), np.nan)
    ranks[doc[field == 0]] = rank
    lengths = np.zeros((1 << FIELD_BITS, len(doc_id)), np.int64)
    lengths[field, doc] = length
    order = np.lexsort((doc, key))
    starts = np.cumsum(n_pos) - n_pos
    pos = joined("pos")[ranges(starts[order], n_pos[order])]
    keys, n = np.unique(key, return_counts=True)
    parts, code = np.unique(part, return_inverse=True)
    row = {"block": table["block"][0].as_py(), "rank": narrow(ranks), "parts": narrow(parts)}
    row |= {"key": keys.tobytes(), "doc_id": doc_id.tobytes(), "n": narrow(n), "len": narrow(lengths.ravel())}
    row |= {"doc": narrow(doc[order]), "code": narrow(code[order]), "n_pos": narrow(n_pos[order]), "pos": narrow(pos)}
    return pa.Table.from_batches([_rows([row], _binary_schema(BLOCK))])


class Block:
    """One block's postings. ``first`` and ``last`` bound the posting list of each key that the queries ask for."""

    def __init__(self, batch: pa.RecordBatch, at: int, asked: np.ndarray):
        read = lambda name: wide(batch[name][at].as_buffer())
        self.doc_id = np.frombuffer(batch["doc_id"][at].as_buffer(), np.int64)
        self.size = len(self.doc_id)
        self.doc, self.part = read("doc"), read("parts")[read("code")]
        self.n_pos, self.pos = read("n_pos"), read("pos")
        self.pos_start = np.cumsum(self.n_pos, dtype=np.int64) - self.n_pos
        self.lengths, self.rank = read("len").reshape(-1, self.size), read("rank")
        keys, ends = np.frombuffer(batch["key"][at].as_buffer(), np.int64), np.cumsum(read("n"), dtype=np.int64)
        slot = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        known = keys[slot] == asked
        self.last = np.where(known, ends[slot], 0).tolist()
        self.first = np.where(known, ends[slot] - np.diff(ends, prepend=0)[slot], 0).tolist()

    def sums(self, terms: list[tuple[int, float]]) -> tuple[np.ndarray, np.ndarray] | None:
        """Per document of the block, the sum of the scores of ``terms`` (key's number, weight), in their order, and how many match."""
        lists = [(self.first[k], self.last[k], w) for k, w in terms if self.last[k]]
        if not lists:
            return None
        doc = np.concatenate([self.doc[a:b] for a, b, _ in lists])
        score = np.concatenate([self.part[a:b] + w for a, b, w in lists])
        return np.bincount(doc, score, self.size), np.bincount(doc, minlength=self.size)

    def places(self, key: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a key in ``docs`` (ascending): numbers into ``docs``, and the positions, both ascending."""
        a, b = self.first[key], self.last[key]
        own = self.doc[a:b]
        at = np.searchsorted(own, docs)
        n = np.searchsorted(own, docs, "right") - at
        if (n > 1).any():
            raise ValueError(f"document {self.doc_id[docs[n > 1][0]]} came several times")
        postings = a + ranges(at, n)
        counts = self.n_pos[postings].astype(np.int64)
        return np.repeat(np.repeat(np.arange(len(docs)), n), counts), self.pos[ranges(self.pos_start[postings], counts)].astype(np.int64)

    def in_order(self, keys: list[int], docs: np.ndarray) -> np.ndarray:
        """Which of ``docs`` hold every two consecutive ones of ``keys`` next to each other, as a mask."""
        left = np.arange(len(docs))
        for one, two in zip(keys, keys[1:]):
            if one < 0 or two < 0 or not self.last[one] or not self.last[two]:
                left = left[:0]
            if not len(left):
                break
            (d1, p1), (d2, p2) = self.places(one, docs[left]), self.places(two, docs[left])
            if not len(d1) or not len(d2):
                left = left[:0]
                break
            reach = int(max(p1.max(), p2.max())) + 2
            before, after = d1 * reach + p1 + 1, np.sort(d2 * reach + p2)
            met = after[np.minimum(np.searchsorted(after, before), len(after) - 1)] == before
            found = np.zeros(len(left), dtype=bool)
            found[d1[met]] = True
            left = left[found]
        mask = np.zeros(len(docs), dtype=bool)
        mask[left] = True
        return mask

    def factors(self, field: int, boosts: tuple, query: "Query", docs: np.ndarray, matched: np.ndarray) -> np.ndarray:
        """The factor of one field for how the terms stand together."""
        exact, ordered, all_terms, partial, _ = boosts
        keys = query.sequence[field]
        factor = np.full(len(docs), partial)
        full = (matched >= query.distinct[field]).nonzero()[0]
        if len(full):
            own = docs[full]
            factor[full] = np.where(
                self.in_order(keys, own), np.where(self.lengths[field][own] == len(keys), exact, ordered), all_terms
            )
        return factor


class Query:
    """A query with its terms as numbers into the list of all keys of its batch, in the order of the terms' names."""

    def __init__(self, row: dict, number: dict[int, int]):
        self.id, self.has_category = row["query_id"], row["has_category"]
        known: dict[tuple[int, str], int] = {}
        self.terms: list[list[tuple[int, float]]] = [[], [], []]
        for t in sorted(row["terms"], key=lambda t: (t["field"], t["term"])):
            known[t["field"], t["term"]] = number[t["key"]]
            self.terms[t["field"]].append((number[t["key"]], t["weight"]))
        words = [row["keyword_terms"], row["keyword_terms"], row["category_terms"]]
        self.sequence = [[known.get((f, w), -1) for w in ws] for f, ws in enumerate(words)]
        self.distinct = [len(set(ws)) for ws in words]
        self.found: list[np.ndarray] = []  # doc_id, title, content, category, rank; by blocks
        self.n, self.floor = 0, None


def printed(total: np.ndarray, digits: int) -> np.ndarray:
    """Totals as whole numbers of the last printed digit, rounded half up as Spark's ``round`` does: by their decimal form where that
    could matter."""
    scaled = total * 10.0**digits
    low = np.floor(scaled)
    out = low + (scaled - low >= 0.5)
    close = (np.abs(scaled - low - 0.5) < 1e-3) | (np.abs(scaled) > 1e11)
    for i in np.flatnonzero(close):
        out[i] = float(Decimal(repr(float(total[i]))).scaleb(digits).to_integral_value(ROUND_HALF_UP))
    return out


def total_of(found: np.ndarray) -> np.ndarray:
    return found[1] + found[2] + np.where(np.isnan(found[3]), 0.0, found[3])


def best(order: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, float]:
    """Which are the first ``limit`` by ``order`` downwards, then by id, in no order; and the ``order`` of the last of them."""
    cut = np.partition(order, len(order) - limit)[len(order) - limit]
    above, level = np.flatnonzero(order > cut), np.flatnonzero(order == cut)
    missing = limit - len(above)
    if len(level) > missing:
        level = level[np.argsort(ids[level], kind="stable")[:missing]]
    return np.concatenate([above, level]), float(cut)


def most(sums: np.ndarray, matched: np.ndarray, distinct: int, boosts: tuple) -> np.ndarray:
    """No less than the score of a field, before positions are looked at."""
    *factors, partial, weight = boosts
    highest = np.maximum(sums * max(factors), sums * min(factors))
    return np.where(matched >= distinct, highest, sums * partial) * weight


def search_block(block: Block, query: Query, boosts: list[tuple], limit: int, digits: int) -> None:
    """Add the query's hits in a block to what it has found, cut to the best where they are many. Once ``limit`` hits are known, those
    that cannot come before the last of them are left out before positions are looked at."""
    fields = [0, 1, 2] if query.has_category else [0, 1]
    found = []
    for field in fields:
        sums = block.sums(query.terms[field])
        if sums is None:
            return
        found.append(sums)
    docs = reduce(np.logical_and, [matched > 0 for _, matched in found]).nonzero()[0]
    found = [(sums[docs], matched[docs]) for sums, matched in found]
    if query.floor is not None:
        highest = sum(most(sums, matched, query.distinct[f], boosts[f]) for f, (sums, matched) in zip(fields, found))
        kept = (highest >= query.floor).nonzero()[0]
        docs, found = docs[kept], [(sums[kept], matched[kept]) for sums, matched in found]
    if not len(docs):
        return
    rows = np.full((5, len(docs)), np.nan)
    rows[0] = block.doc_id[docs].view(np.float64)
    for f, (sums, matched) in zip(fields, found):
        rows[1 + f] = sums * block.factors(f, boosts[f], query, docs, matched) * boosts[f][-1]
    rows[4] = block.rank[docs]
    if query.floor is not None:
        rows = rows[:, total_of(rows) >= query.floor]
    query.found.append(rows)
    query.n += rows.shape[1]
    if query.n > limit + limit // 4:
        cut_down(query, limit, digits)


def cut_down(query: Query, limit: int, digits: int) -> None:
    whole = np.concatenate(query.found, axis=1)
    kept, last = best(printed(total_of(whole), digits), whole[0].view(np.int64), limit)
    # Anything less is printed as less; what is kept beyond that goes in the next cut.
    query.floor = (last - 1) / 10.0**digits
    query.found, query.n = [whole[:, kept]], len(kept)


def results(queries: list[Query], id_type: pa.DataType, limit: int, digits: int) -> Iterator[pa.RecordBatch]:
    """What the queries found, each one's in order."""
    for at in range(0, len(queries), OUT_QUERIES):
        ids, numbers, columns = [], [], []
        for query in queries[at : at + OUT_QUERIES]:
            if not query.n:
                continue
            if query.n > limit:
                cut_down(query, limit, digits)
            whole = np.concatenate(query.found, axis=1)
            order = np.lexsort((whole[0].view(np.int64), -printed(total_of(whole), digits)))
            columns.append(whole[:, order])
            ids.append(np.full(len(order), query.id))
            numbers.append(np.arange(1, len(order) + 1, dtype=np.int32))
        if ids:
            whole = np.concatenate(columns, axis=1)
            scores = [pa.array(c, pa.float64(), from_pandas=True) for c in whole[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids), id_type), pa.array(whole[0].view(np.int64)), *scores, pa.array(np.concatenate(numbers))],
                ["query_id", "doc_id", "title_score", "content_score", "category_score", "rank", "rank_no"],
            )


def searcher(asked: bytes, boosts: list[tuple], limit: int, digits: int) -> Callable:
    """The search of a batch of queries (an Arrow stream) through all blocks, which come one after another."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.ipc.open_stream(asked).read_all()
        rows = table.to_pylist()
        keys = sorted({t["key"] for row in rows for t in row["terms"]})
        number = {key: i for i, key in enumerate(keys)}
        queries = [Query(row, number) for row in rows]
        keys = np.array(keys, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch, at, keys)
                for query in queries:
                    search_block(block, query, boosts, limit, digits)
        yield from results(queries, table.schema.field("query_id").type, limit, digits)

    return search
