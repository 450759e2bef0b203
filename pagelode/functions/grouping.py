"""Words of an Arrow batch of texts grouped by term.

Word counts follow a steep power law: a batch is reduced to its distinct tokens, these to distinct words, only words are stemmed one
by one (most are found in a bounded memo), and the rest is arithmetic on arrays. Documents stay whole in a batch, so nothing is exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in a worker's memo, at most, and the longest that is kept there.
MEMO_LIMIT, MEMO_CHARS = 500_000, 64
#: Bytes of texts grouped at once, about, and rows of a batch that is given back, at most.
IN_BYTES, OUT_ROWS = 4 << 20, 100_000

_PUNCTUATION = r"[!-/:-@\[-`{-~]*"
_INNER = rf"\A{_PUNCTUATION}[\x00-\x20]*(?P<word>[a-z0-9]+)[\x00-\x20]*{_PUNCTUATION}\z"


class RankedTerms:
    """Terms of distinct lower-cased tokens: null where one is not wholly alphanumeric or a stop word. A worker keeps stems of
    words in a bounded memo."""

    def __init__(self, stop_words: list[str], stem: Callable[[str], str] | None):
        self.stop_words, self.stem = pa.array(stop_words), stem
        self.memo: dict[str, str] = {}

    def __call__(self, tokens: pa.Array) -> pa.Array:
        words = pc.struct_field(pc.extract_regex(tokens, _INNER), "word").cast(pa.string())
        words = pc.if_else(pc.is_in(words, self.stop_words), None, words)
        if self.stem is None:
            return words
        encoded = words.dictionary_encode()
        return pa.array(self.stems(encoded.dictionary.to_pylist()), pa.string()).take(encoded.indices)

    def stems(self, words: list[str]) -> list[str]:
        memo, out = self.memo, []
        for word in words:
            stem = memo.get(word)
            if stem is None:
                stem = self.stem(word)
                if len(word) <= MEMO_CHARS:
                    if len(memo) >= MEMO_LIMIT:
                        memo.clear()
                    memo[word] = stem
            out.append(stem)
        return out


class FulltextTerms:
    """Terms of distinct words of the full-text analyser: the words, null for stop words."""

    def __init__(self, stop_words: list[str]):
        self.stop_words = pa.array(stop_words)

    def __call__(self, words: pa.Array) -> pa.Array:
        return pc.if_else(pc.is_in(words, self.stop_words), None, words)


def split_tokens(texts: pa.Array, delimiters: bytes) -> tuple[np.ndarray, pa.Array]:
    """The number of tokens of each text, and all tokens. A null has none. Works on bytes: delimiters are ASCII."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    is_word = np.ones(256, dtype=bool)
    is_word[list(delimiters)] = False
    filled = is_word[data]
    # A token starts after a delimiter and where a text starts.
    first = filled.copy()
    first[1:] &= ~filled[:-1]
    at = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[at] = filled[at]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, bounds))
    words = data[filled]
    ends = np.append(np.cumsum(filled, dtype=np.int32)[starts] - 1, len(words)).astype(np.int32)
    return counts, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(words)])


def split_lists(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """As :func:`split_tokens` of lists of words."""
    return pc.list_value_length(lists).fill_null(0).to_numpy(), lists.flatten()


def count_tokens(texts: pa.Array, delimiters: bytes) -> pa.Array:
    """The number of tokens of each text; null for null."""
    counts, _ = split_tokens(texts, delimiters)
    return pa.array(counts, pa.int32(), mask=texts.is_null().to_numpy(zero_copy_only=False))


def group_words(sizes: np.ndarray, words: pa.Array, terms_of: Callable, all_tokens: bool, field: np.ndarray) -> tuple:
    """Words of texts to one entry per (text, term), ordered by field, term and text: the text's number, term, start of its positions
    and end, length of the text (all words, or those that have a term); and all positions."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    position = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    encoded = words.dictionary_encode()
    terms = terms_of(encoded.dictionary).dictionary_encode()
    by_name = pc.sort_indices(terms.dictionary)
    place = np.empty(len(by_name) + 1, dtype=np.int64)
    place[by_name.to_numpy()] = np.arange(len(by_name))
    place[-1] = -1  # words without a term
    term = place[terms.indices.fill_null(-1).to_numpy()][encoded.indices.to_numpy()]
    kept = term >= 0
    row, position, term = row[kept], position[kept], term[kept]
    lengths = sizes if all_tokens else np.bincount(row, minlength=len(sizes))
    # Positions ascend within a text, so a stable sort leaves those of a term in order. An index is stored in this order: its sort
    # then meets long runs that are sorted already.
    key = (field[row] * len(by_name) + term) * len(sizes) + row
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(starts[1:], len(key))
    row = row[order[starts]]
    return row, terms.dictionary.take(by_name.take(pa.array(term[order[starts]]))), starts, ends, lengths[row], position[order].astype(np.int32)


def in_order(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Batches as one, sorted by ``field`` and ``doc_id``."""
    whole = pa.concat_batches(batches)
    return whole.take(pc.sort_indices(whole.select(["field", "doc_id"]), [("field", "ascending"), ("doc_id", "ascending")]))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together up to about ``IN_BYTES``: the more words, the fewer of them are distinct."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > IN_BYTES:
            yield in_order(held)
            held = []
        held.append(batch)
    if held:
        yield in_order(held)


def posting_batches(
    batch: pa.RecordBatch, sizes: np.ndarray, words: pa.Array, terms_of: Callable, all_tokens: bool
) -> Iterator[pa.RecordBatch]:
    """The postings of a batch with ``doc_id`` and ``field``, sorted by them."""
    field = batch["field"].to_numpy().astype(np.int64)
    row, terms, starts, ends, lengths, positions = group_words(sizes, words, terms_of, all_tokens, field)
    for at in range(0, len(row), OUT_ROWS):
        some = slice(at, at + OUT_ROWS)
        first, last = starts[some], ends[some]
        offsets = np.append(first, last[-1:]) - first[0]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(positions[first[0] : last[-1]]))
        rows = pa.array(row[some])
        yield pa.RecordBatch.from_arrays(
            [
                terms[some],
                batch["field"].take(rows),
                batch["doc_id"].take(rows),
                pa.array(last - first, pa.int32()),
                lists,
                pa.array(lengths[some], pa.int32()),
            ],
            ["term", "field", "doc_id", "tf", "positions", "field_len"],
        )
