"""BPE encoding and decoding with a word-end vocabulary; long texts by tree concatenation.

A text of up to ``LEAF`` characters is one leaf. A longer one is cut into halves of halves, the leaves
are encoded in parallel as rows of their own, and the tree is joined level by level: around each join
a window of tokens is encoded again, growing until its first token equals the left side's token
there and a later token equals the right side's. A sequence of BPE tokens is the encoding of its
text exactly if every two neighbours are, so the joined sequence is that of the whole text.

Inside a leaf, words between blanks are independent of each other in this vocabulary, so they are
encoded once and remembered; so are the letter runs in them. A worker holds one text at a time as Python
objects, a batch only as Arrow columns, and forgets its words when a task ends.

Defined results: a null or empty text has no ids and decodes to an empty text; repeated rows give
repeated rows; equal long texts are encoded once; an empty table gives an empty result; columns
pass through unless they bear the name of a result column, which replaces them."""

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.llm.common import release
from pagelode.session import materialise

#: Characters of a leaf: longer texts are joined from several.
LEAF = 1 << 15
#: Tokens at each side of a join in the first window.
WINDOW = 16
#: Words and letter runs that a worker remembers.
MEMORY = 1 << 16

#: Fixed values of the vocabulary's format: how it splits words, and its special tokens.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")

RESULT = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]


def _byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary: itself where it is
    printable Latin-1 other than blanks and the soft hyphen, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Remembered(dict):
    """Values by key, made when they are first asked for; all are forgotten when there are too many."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str):
        value = self.make(key)
        if len(self) >= MEMORY:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """The tokenizer of one worker, with its memory."""

    _loaded: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pretokens = regex.compile(PRETOKEN)
        # Letters that are their own normal form and whose lower case is one letter.
        self.plain = regex.compile("[\\x21-\\x7eÀ-įı-ſ]*")
        self.characters = _byte_characters()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.values = [self.tokenizer.id_to_token(i) for i in range(len(self.packed))]
        self.words = Remembered(self._word)
        self.runs = Remembered(self._run)

    @classmethod
    def load(cls, path: str) -> "Encoder":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _run(self, run: str) -> bytes:
        """Ids of a letter run, a digit or a run of signs in lower case, as little-endian 32-bit integers."""
        shown = run if run.isascii() else "".join([self.characters[b] for b in run.encode()])
        return b"".join([self.packed[t.id] for t in self.tokenizer.model.tokenize(shown)])

    def _word(self, word: str) -> bytes:
        """Ids of what stands between two blanks."""
        if word.isascii() and word.isalpha():
            return self.runs[word.lower()]
        if "<|" not in word and self.plain.fullmatch(word):
            return b"".join([self.runs[run] for run in self.pretokens.findall(word.lower())])
        return b"".join([self.packed[i] for i in self.tokenizer.encode(word, add_special_tokens=False).ids])

    def leaf(self, text: str) -> tuple[bytes, str]:
        """Ids and decoded text of a whole short text; blanks and line ends separate words."""
        words, values = self.words, self.values
        ids = b"".join([words[w] for w in text.replace("\n", " ").split(" ") if w])
        return ids, " ".join([values[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def forget(self) -> None:
        """Drop what was remembered; workers go from stage to stage."""
        self.words.clear()
        self.runs.clear()
        release()

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with the first and the last character position of each."""
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        places = np.array(encoding.offsets, np.int32).reshape(-1, 2)
        return np.array(encoding.ids, np.int32), places[:, 0].copy(), places[:, 1].copy()

    def decode(self, ids) -> str:
        return self.tokenizer.decode(list(map(int, ids)), skip_special_tokens=False)


def divisible(text: str, at: int) -> bool:
    """Whether the parts before and after a position normalise as they do together, and no special
    token lies across it."""
    before, after = text[at - 1 : at], text[at : at + 1]
    normal = unicodedata.normalize
    if unicodedata.combining(after) or normal("NFC", before + after) != normal("NFC", before) + normal("NFC", after):
        return False
    return not any(s in text[max(0, at - len(s) + 1) : at + len(s) - 1] for s in SPECIAL)


def leaves(text: str, leaf: int) -> list[str]:
    """Parts of a text, as many as a power of two; a cut moves on to where the text is divisible,
    so parts may be uneven or empty."""
    parts = 1
    while len(text) > parts * leaf:
        parts *= 2
    cuts = [0]
    for i in range(1, parts):
        at = max(cuts[-1], i * len(text) // parts)
        while 0 < at < len(text) and not divisible(text, at):
            at += 1
        cuts.append(at)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def join_encodings(encoder: Encoder, left: tuple, right: tuple, window: int = WINDOW) -> tuple:
    """(text, ids, starts, ends) of two neighbouring texts together."""
    lt, li, ls, le = left
    rt, ri, rs, re_ = right
    middle, text = len(lt), lt + rt
    rs, re_ = rs + middle, re_ + middle
    while True:
        i = max(0, len(li) - window)
        # The window starts with a token that starts with a character, not with an apostrophe
        # (which could join letters that belong elsewhere), where the text is divisible.
        while i and (text[ls[i]] == "'" or le[i - 1] > ls[i] or not divisible(text, int(ls[i]))):
            i -= 1
        j = min(len(ri), window)
        begin = int(ls[i]) if i else 0
        end = int(re_[j - 1]) if j < len(ri) else len(text)
        while j < len(ri) and end < len(text) and not divisible(text, end):
            j += 1
            end = int(re_[j - 1]) if j < len(ri) else len(text)
        wi, ws, we = encoder.spans(text[begin:end])
        ws, we = ws + begin, we + begin
        agrees = i == 0 or (len(wi) and wi[0] == li[i] and ws[0] == ls[i] and we[0] == le[i] and le[i] <= middle)
        if j == len(ri):
            upto, after = len(wi), len(ri)
        else:
            known = {(a, b, c): n for n, (a, b, c) in enumerate(zip(ri[:j].tolist(), rs[:j].tolist(), re_[:j].tolist()))}
            same = [(n, known[t]) for n, t in enumerate(zip(wi.tolist(), ws.tolist(), we.tolist())) if t in known]
            same = [(n, v) for n, v in same if ws[n] >= middle and (n == 0 or we[n - 1] <= ws[n]) and (v == 0 or re_[v - 1] <= rs[v])]
            agrees = agrees and bool(same)
            upto, after = (same[0][0] + 1, same[0][1] + 1) if same else (0, 0)
        if agrees:
            pick = lambda a, b, c: np.concatenate([a[:i], b[:upto], c[after:]])
            return text, pick(li, wi, ri), pick(ls, ws, rs), pick(le, we, re_)
        window *= 2


_KINDS = dict(zip(RESULT, [T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.IntegerType()), T.StringType()]))


def _struct(results: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[name]) for name in results])


def result_columns(found: Iterable[tuple[bytes, str]], results: list[str]) -> list[pa.Array]:
    """The ``results`` of encoded texts, given as ids and decoded text, in Arrow columns: ids go on from bytes as they are, without an object each."""
    counts, digests, ids, decoded = [], [], bytearray(), []
    for own, text in found:
        counts.append(len(own) // 4)
        digests.append((hashlib.sha256(own).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        if "ids" in results:
            ids += own
        if "decoded" in results:
            decoded.append(text)
    columns = [pa.array(counts, pa.int64()), *[pa.array([d[i] for d in digests], pa.string()) for i in (0, 1)]]
    if "ids" in results:
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(ids, "<i4"), pa.int32())))
    return [*columns, pa.array(decoded, pa.string())] if "decoded" in results else columns


def _short(path: str, results: list[str]):
    @F.arrow_udf(_struct(results))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        encoder = Encoder.load(path)
        for texts in batches:
            yield pa.StructArray.from_arrays(result_columns((encoder.leaf(t.as_py() or "") for t in texts), results), names=results)
        encoder.forget()

    return encode


_NODE = "key string, node bigint, parts bigint, packed binary"


def packed(text: str, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """An encoded text in one compressed value: its numbers as differences, so that they take little room."""
    body = text.encode()
    gaps = np.diff(starts, prepend=0)
    numbers = np.concatenate([[len(body), len(ids)], ids, gaps, ends - starts]).astype("<i4")
    # Lowest bytes together, then the next: most of them are zero.
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + zstandard.compress(planes.tobytes() + body, 1)


def unpacked(value: bytes) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """``text, ids, starts, ends`` of a packed value."""
    count, data = int.from_bytes(value[:8], "little"), zstandard.decompress(value[8:])
    planes = np.frombuffer(data, np.uint8, 4 * count).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view("<i4").ravel()
    n = int(numbers[1])
    ids, gaps, widths = numbers[2 : 2 + n], numbers[2 + n : 2 + 2 * n], numbers[2 + 2 * n :]
    starts = np.cumsum(gaps, dtype=np.int32)
    return data[4 * count :].decode(), ids, starts, starts + widths


def _node(key: str, node: int, parts: int, value: bytes) -> pa.RecordBatch:
    columns = [pa.array([key], pa.string()), pa.array([node], pa.int64()), pa.array([parts], pa.int64()), pa.array([value], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["key", "node", "parts", "packed"])


def encode_long(texts: DataFrame, path: str, leaf: int, results: list[str]) -> DataFrame:
    """Results for distinct long ``texts`` (key, text): a row for each leaf, joined level by level; a
    group is two neighbours. A text whose parts are all joined takes no part in further levels. Tasks hand on
    each row as soon as it is made, so that a worker holds one encoded text and not a batch of them."""

    def rows(batches):
        for batch in batches:
            for values in zip(*batch.columns):
                yield [v.as_py() for v in values]

    def cut(batches):
        for key, text in rows(batches):
            found = leaves(text, leaf)
            columns = [pa.array([key] * len(found), pa.string()), *[pa.array(c, pa.int64()) for c in (range(len(found)), [len(found)] * len(found))]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], names=["key", "node", "parts", "text"])

    def encode(batches):
        release()
        encoder = Encoder.load(path)
        for key, node, parts, text in rows(batches):
            yield _node(key, node, parts, packed(text, *encoder.spans(text)))
        encoder.forget()

    def join(pair: pa.Table) -> pa.Table:
        first, *others = pair.sort_by("node").to_pylist()
        found = join_encodings(Encoder.load(path), *(unpacked(node["packed"]) for node in (first, *others)))
        return pa.Table.from_batches([_node(first["key"], first["node"] // 2, first["parts"] // 2, packed(*found))])

    def finish(batches):
        release()
        encoder = Encoder.load(path)
        for key, value in rows(batches):
            ids = unpacked(value)[1]
            columns = result_columns([(ids.astype("<u4").tobytes(), encoder.decode(ids))], results)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), *columns], names=["key", *results])
        encoder.forget()

    parts = texts.select("key", "text").mapInArrow(cut, "key string, node bigint, parts bigint, text string").repartition("key", "node")
    nodes = materialise(parts.mapInArrow(encode, _NODE), "leaves")
    done = nodes.where("parts = 1")
    most = nodes.agg(F.max("parts")).first()[0] or 1
    while most > 1:
        open_ = nodes.where("parts > 1")
        # Without type hints, Spark takes a function of one argument as one from table to table.
        nodes = open_.groupBy("key", F.shiftright("node", 1).alias("pair")).applyInArrow(lambda pair: join(pair), _NODE)
        nodes, most = materialise(nodes, "joined"), most // 2
        done = done.union(nodes.where("parts = 1"))
    out = T.StructType([T.StructField("key", T.StringType()), *_struct(results).fields])
    return materialise(done.select("key", "packed").mapInArrow(finish, out), "encoded")


def encode_documents(docs: DataFrame, path: str, text: str = "text", whole: bool = False, leaf: int = LEAF, decoded: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, and with ``whole`` also ``ids`` and, unless ``decoded``
    is off, the ``decoded`` text itself. ``path`` is a tokenizer file at the same place on every machine."""
    results = RESULT[: 3 if not whole else 5 if decoded else 4]
    kept = [c for c in docs.columns if c not in results]
    long_ = F.coalesce(F.length(text) > leaf, F.lit(False))
    short = docs.where(~long_).select(*kept, _short(path, results)(F.col(text)).alias("__e")).select(*kept, "__e.*")
    rows = docs.where(long_).withColumn("__key", F.sha2(text, 256))
    found = encode_long(rows.select(F.col("__key").alias("key"), F.col(text).alias("text")).dropDuplicates(["key"]), path, leaf, results)
    return short.union(rows.join(found.withColumnRenamed("key", "__key"), "__key").select(*kept, *results))
