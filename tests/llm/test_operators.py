"""Every operator against its plain version, on copies, ties, nulls, empty and unusual texts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagelode.llm import bpe_tree, collisions, common, host_rules, merkle, mixing, ngram_join, paragraphs, pii, separators, substring_repeats
from pagelode.session import materialise

PATH = public_tokenizers.path("word_bpe_49k.json")


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def texts(rows):
    return [(r[0], r[1]) for r in rows]


# --- encoding


def test_encoding_equals_the_library(docs, rows):
    tokenizer = Tokenizer.from_file(PATH)
    got = collected(bpe_tree.encode_documents(docs, PATH, leaf=97), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted([(d, *plain.encoded(tokenizer, t)) for d, t in texts(rows)], key=repr)


def test_whole_encoding_hands_on_what_is_asked_for(docs, rows):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted([(d, tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in texts(rows)], key=repr)
    got = bpe_tree.encode_documents(docs, PATH, whole=True, leaf=97, decoded=False)
    assert "decoded" not in got.columns and collected(got, "doc_id", "ids") == want
    got = bpe_tree.encode_documents(docs, PATH, whole=True, leaf=97)
    assert collected(got, "doc_id", "ids", "decoded") == sorted([(d, ids, tokenizer.decode(ids, skip_special_tokens=False)) for d, ids in want], key=repr)


def test_workers_forget_words_when_a_task_ends(docs):
    assert len(collected(bpe_tree.encode_documents(docs, PATH, whole=True), "doc_id", "ids"))

    def held(batches):
        encoder = bpe_tree.Encoder.load(PATH)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(encoder.words) + len(encoder.runs)] * batch.num_rows, pa.int64())], names=["held"])

    assert {r.held for r in docs.select("doc_id").mapInArrow(held, "held bigint").collect()} == {0}


def test_joins_of_parts_without_blanks():
    encoder, draw = bpe_tree.Encoder.load(PATH), random.Random(4)
    letters = ["a", "th", "é", "'s", "'", "!!", "1", "日", " ", "\n", "é", "<|endoftext|>", "ABC", "İ", "가", "😀", "'ll"]
    for _ in range(300):
        some = draw.sample(letters, draw.randint(1, 5))
        text = "".join(draw.choice(some) for _ in range(draw.randint(0, 300)))
        parts = [(p, *encoder.spans(p)) for p in bpe_tree.leaves(text, 41)]
        while len(parts) > 1:
            parts = [bpe_tree.join_encodings(encoder, *parts[i : i + 2], window=2) for i in range(0, len(parts), 2)]
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert parts[0][1].tolist() == want
        assert np.frombuffer(encoder.leaf(text)[0], "<u4").tolist() == want


# --- repeats and near copies


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, 0])
def test_repeats(docs, rows, limit, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    got = collected(substring_repeats.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(plain.repeats(texts(rows)), key=repr)


def test_repeat_rounds_in_pieces(monkeypatch):
    """Long texts are worked on in pieces; where a piece ends makes no difference."""
    draw = random.Random(1)
    text = "".join(draw.choice("abcd é") for _ in range(3000)).encode()
    first = substring_repeats.runs(text)
    whole = substring_repeats.blocks(text, *first[2:]), substring_repeats.starts(text, first[2])
    monkeypatch.setattr(substring_repeats, "PIECE", 170)
    pieces = substring_repeats.runs(text)
    covered = lambda r: sorted((s + i, lead - i) for s, n, lead in zip(*map(np.ndarray.tolist, r[2:])) for i in range(n))
    assert covered(pieces) == covered(first)
    again = substring_repeats.blocks(text, *pieces[2:]), substring_repeats.starts(text, first[2])
    assert {*zip(*map(np.ndarray.tolist, again[0]))} == {*zip(*map(np.ndarray.tolist, whole[0]))}
    assert again[1][0].tolist() == whole[1][0].tolist()


@pytest.mark.parametrize("frequent", [1000, 8])
def test_near_copies(docs, rows, frequent):
    got = collected(ngram_join.ngram_jaccard_join(docs, frequent=frequent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(plain.near_copies(texts(rows)), key=repr)


def test_pairs_of_frequent_tokens_meet():
    """Two sets that are alike share an index value, whatever tokens are frequent."""
    draw = random.Random(6)
    for _ in range(300):
        every = np.unique(np.array([draw.getrandbits(64) for _ in range(60)], np.uint64))
        often = np.array([t for t in every if draw.random() < draw.choice([0.1, 0.6, 1.0])], np.uint64)
        a = np.sort(np.array(draw.sample(list(every), draw.randint(2, 50)), np.uint64))
        b = np.unique(np.concatenate([a[draw.randint(0, 3) :], every[: draw.randint(0, 4)]]))
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) and len(np.setxor1d(a, b)):
            split = lambda s: ngram_join.signatures(s[~np.isin(s, often)], s[np.isin(s, often)])
            assert len(np.intersect1d(split(a), split(b)))
            bits = [np.unpackbits(common.parity_bits(s).view(np.uint8)) for s in (a, b)]
            if len(bits[0]) == len(bits[1]):
                assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("limit", [32 << 20, -1])
def test_index_rows_of_rare_tokens_stay(spark, monkeypatch, limit):
    """A frequent token gives way to one row; rows of the rare ones among the first are not made again, whether the class is sent or joined."""
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", limit)
    draw, known = random.Random(9), common.WordHash()
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(204)) for _ in range(3)]
    sets = [common.distinct_shingles(t.encode(), 5, known) for t in texts]
    first = ngram_join.misses(200) + 1
    often = np.sort(np.concatenate([sets[0][[0, 5]], sets[1][first - 1 :], sets[2][first:]]))
    classes = materialise(spark.createDataFrame([(int(t),) for t in often.view(np.int64)], "token bigint"), "classes")
    found = defaultdict(list)
    for bucket, node, n in ngram_join.extended(spark.createDataFrame([(t,) for t in texts], "text string"), classes).collect():
        assert n == 200
        found[node].append(bucket)
    for own in sets:
        flags = np.isin(own, often)
        kept, added = own[:first][~flags[:first]], np.array(found[ngram_join.set_name(own)], np.int64).view(np.uint64)
        assert not len(np.intersect1d(kept, added))
        assert np.union1d(kept, added).tolist() == np.unique(ngram_join.signatures(own[~flags], own[flags])).tolist()
        if (~flags).sum() >= first:
            assert len(added) == flags[:first].sum()


def test_first_of_each_keeps_one(docs, rows, odd):
    want = {(c if n else d) for d, n, c in plain.near_copies(texts(rows))}
    kept = ngram_join.first_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(want)
    # Of the copies the row of id 5 stays once; empty texts all stay.
    assert collected(ngram_join.first_of_each(odd), "doc_id", F.length("text")) == sorted(
        [(5, len(("one two three four five six seven eight nine ten eleven twelve " * 12).strip())), (5, 560), (None, 0), (None, None)], key=repr
    )


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(7, 7)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def plain_paragraphs(text):
    """(first word, words) of the paragraphs of a text, a word at a time."""
    words = plain.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    names = [xxhash.xxh3_64_intdigest(w.encode()) for w in words] + [0]
    step, whole = 0x9E3779B97F4A7C15, 1 << 64
    keys = [int(common.mix(np.array([(a * step + b) % whole], np.uint64))[0]) for a, b in zip(names, names[1:])]
    near = lambda i: (keys[max(0, i - paragraphs.SPAN) : i], keys[i + 1 : i + 1 + paragraphs.SPAN])
    starts = [i for i, k in enumerate(keys) if not i or (all(k < x for x in near(i)[0]) and all(k <= x for x in near(i)[1]))]
    return [(i, j - i, " ".join(words[i:j])) for i, j in zip(starts, [*starts[1:], len(words)])]


def plain_without_copies(given):
    """(doc_id, paragraphs removed, words removed, digest) of (doc_id, text) rows, by comparing all paragraphs."""
    found = [(d, *p) for d, t in sorted(given) for p in plain_paragraphs(t)]
    root = plain.roots(len(found), plain.alike([plain.shingles(x[3]) for x in found]))
    first, gone = set(), defaultdict(list)
    for r, (d, start, words, _) in zip(root, found):
        if r in first:
            gone[d].append((start, words))
        first.add(r)
    out = []
    for d, text in given:
        runs = []
        for start, words in gone[d]:
            joined = runs and runs[-1][0] + runs[-1][1] == start
            runs = [*runs[:-1], (runs[-1][0], runs[-1][1] + words, runs[-1][2] + 1)] if joined else [*runs, (start, words, 1)]
        runs = [r for r in runs if r[1] >= paragraphs.LEAST_RUN]
        off = {i for start, words, _ in runs for i in range(start, start + words)}
        parts = re.split(f"({plain.WORD.pattern})", text or "")  # white space, word, white space, ...
        kept = parts[0] + "".join(parts[i] + parts[i + 1] for i in range(1, len(parts), 2) if i // 2 not in off)
        out.append((d, sum(r[2] for r in runs), len(off), plain.sha(kept.encode())))
    return sorted(out, key=repr)


def test_paragraphs(docs, rows):
    want = plain_without_copies(texts(rows))
    assert sum(w[1] for w in want) > 100
    got = collected(paragraphs.remove_near_paragraphs(docs, bands=(40, 2)), "doc_id", "n_removed", "removed_words", "kept_sha256")
    assert got == want
    tuned = collected(paragraphs.remove_near_paragraphs(docs), "doc_id", "removed_words")
    assert sum(w for _, w in tuned) >= 0.95 * sum(w[2] for w in want)


def test_paragraphs_joined_by_shuffles(spark, rows, monkeypatch):
    few = [r[:2] for r in rows[:4] + rows[25:29]]
    monkeypatch.setattr(paragraphs, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    found = paragraphs.remove_near_paragraphs(spark.createDataFrame(few, "doc_id bigint, text string"), bands=(40, 2))
    assert collected(found, "doc_id", "n_removed", "removed_words", "kept_sha256") == plain_without_copies(few)


def test_runs_are_joined_before_texts_are_met(spark):
    """Only documents that lose words meet their texts, with joined runs; a part of the bands is shuffled at a time."""
    rows = [(1, 7, 0, 9, True), (1, 7, 9, 8, True), (1, 7, 40, 15, True), (2, 7, 3, 15, True), (None, 8, 50, 20, True), (None, 8, 5, 16, True), (3, 9, 0, 30, False)]
    groups = spark.createDataFrame(rows, "doc_id bigint, mark bigint, start int, words int, removed boolean")
    assert collected(paragraphs.removed_runs(groups), "doc_id", "mark", "runs") == [(1, 7, [0, 17, 2]), (None, 8, [5, 16, 1, 50, 20, 1])]
    places = spark.createDataFrame([(1, 5, [10, 20, 30, 40]), (2, 5, [11, 20, 30, 41]), (3, 5, [12, 21, 30, 40]), (1, 5, None)], "node bigint, n int, bands array<bigint>")
    parts = [collected(part, "bucket", "node") for part in paragraphs.band_members(places, 4)]
    assert parts == [[(20, 1), (20, 2)], [(30, 1), (30, 2), (30, 3), (40, 1), (40, 3)]]


def test_passages_inside_lines(spark):
    """Passages of 51 to 90 words are found wherever they stand; common lines of a dozen words stay."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(4))
    some = lambda n: " ".join(word() for _ in range(n))
    shared, line, made = [some(draw.randint(51, 90)) for _ in range(40)], some(12), []
    for i in range(160):
        # every passage in two documents, in the second one over two lines
        passage = shared[i % 40] if i < 40 else shared[i % 40].replace(" ", "\n", 1) if i < 80 else ""
        made.append((i, f"{some(30)} {passage} {some(30)}\n{line}\n{some(20)}"))
    found = dict(collected(paragraphs.remove_near_paragraphs(spark.createDataFrame(made, "doc_id bigint, text string"), whole=True), "doc_id", "n_removed"))
    assert all(found[i] == 0 for i in [*range(40), *range(80, 160)])
    assert sum(found[i] > 0 for i in range(40, 80)) >= 36


def test_very_long_text_is_cut_alike_in_slices(spark):
    draw = random.Random(6)
    long = " ".join("".join(draw.choice("abcdefghij") for _ in range(3)) for _ in range(200_000))
    made = spark.createDataFrame([(1, long), (2, "x " + long), (3, "other words " * 9), (4, "\t\n")], "doc_id bigint, text string")
    found = collected(paragraphs.remove_near_paragraphs(made), "doc_id", "n_words", "removed_words")
    assert found[0][:2] == (1, 200_000) and found[1][1] == 200_001 and found[1][2] > 199_900
    assert found[2:] == [(3, 18, 0), (4, 0, 0)]


def test_bands_reach_their_recall():
    bands, rows = paragraphs.tuned_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= paragraphs.RECALL and bands * rows <= paragraphs.MOST_HASHES


# --- quality, mixing, personal data


def test_measures_and_host_verdict(spark, docs, rows):
    got = collected(host_rules.measured(docs), "doc_id", *host_rules.MEASURES)
    assert got == sorted([(d, *plain.measures(t)) for d, t in texts(rows)], key=repr)
    good, bad = " ".join(f"w{i}" for i in range(80)), "$$$ " * 3 + " ".join(f"## v{i} ##" for i in range(60))
    some = [(i, good, f"h{i % 7}") for i in range(700)] + [(i, bad, "spam") for i in range(1000, 1060)] + [(1060, good, "spam"), (1061, bad, "h1")]
    judged = host_rules.quality_by_host(spark.createDataFrame(some, "doc_id bigint, text string, source string"))
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert kept == {*range(700), 1061}


def test_mixing(docs, rows):
    mixed = mixing.mix(docs)
    got = mixed.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    sizes = {r[0]: len(plain.words(r[1])) for r in rows}
    total, sources = sum(sizes.values()), sorted({r[3] for r in rows if r[3]}) + [None]
    own = Counter()
    for r in rows:
        own[r[3]] += sizes[r[0]]
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while True:  # sources over three times their size stop there; the rest share again
        left = total - sum(3 * own[s] for s in sources if s not in open_)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * own[s]}
        target = {**{s: 3.0 * own[s] for s in sources if s not in open_}, **share}
        if not over:
            break
        open_ -= over
    taken = Counter()
    for r in got:
        assert r["size"] == sizes[r.doc_id] and r.source_size == own[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(int(target[s] - 1e-6) <= taken[s] <= target[s] + 1e-6 for s in sources)
    assert collected(mixed.repartition(5), "doc_id", "taken") == sorted([(r.doc_id, r.taken) for r in got], key=repr)
    words = Counter()
    for r in mixing.mixed_documents(docs).select("doc_id", "text").collect():
        words[r.doc_id] += len(plain.words(r.text))
    assert {r.doc_id: r.taken for r in got if r.taken} == dict(words)


def test_personal_data(spark, docs, rows):
    draw = random.Random(3)
    signs = ["a", "b.", "@", "1", "2", "255", ".", "+", "-", " ", "(", ")", "4111111111111111", "é", "😀", "_", "%", "com", "0", "\n"]
    strange = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 80))) for _ in range(400)] + ["a@b.c " * 700, "1" * 9000]
    every = texts(rows) + [(1000 + i, t) for i, t in enumerate(strange)]
    found = pii.find_personal_data(spark.createDataFrame(every, "doc_id bigint, text string"))
    written = lambda t: ",".join(f"{k}:{a}:{b}" for k, a, b in plain.personal(t))
    got = {r[0]: (r[1], r[2]) for r in found.select("doc_id", pii.written("base"), pii.written("found")).collect()}
    assert {d: b for d, (b, _) in got.items()} == {d: written(t) for d, t in every}
    assert all({*b.split(",")} <= {*f.split(",")} for b, f in got.values() if b)
    clean = {r.doc_id: r.text for r in pii.redacted(docs).select("doc_id", "text").collect()}
    assert clean == {d: plain.redacted(t) if t else t for d, t in texts(rows)}


def test_labelers_are_weighed():
    """A labeler that contradicts the others comes out as unreliable, and the classifier follows the rest."""
    votes = [("card", 1, 1, 1, 1, 0, 90), ("card", 1, 1, 1, 1, 1, 10), ("card", 0, 0, 0, 0, 1, 90), ("card", 0, 0, 0, 0, 0, 10), ("card", 1, 1, -1, 1, 0, 40)]
    p, rate = pii.estimate(votes)
    assert p[0] > 0.95 and p[2] < 0.05 and p[4] > 0.9
    assert rate[1, 0, 2] > 0.9 > 0.5 > rate[1, 4, 2]
    bias, weights = pii.train(votes)
    score = lambda v: bias[v[0]] + sum(weights[k, x + 1] for k, x in enumerate(v[1:6]))
    assert score(votes[0]) > 1 and score(votes[2]) < -1


# --- archives and token files


def test_audit_finds_the_damage(spark):
    pages = spark.createDataFrame([(i, f"p{i}" * (1 + i % 300), "ab"[i % 5 == 0]) for i in range(3000)], "page_id bigint, html string, file string")
    records = merkle.laid_out(pages, "file", ["page_id"], "html", header=100)
    broken = records.where("page_id <> 77").withColumn("digest", F.when(F.col("page_id").isin(5, 2999), "0").otherwise(F.col("digest")))
    extra = records.where("page_id = 8").withColumn("offset", F.lit(10**9))
    replica = materialise(broken.unionByName(extra), "replica")
    place = {r.page_id: (r.file, r.offset) for r in records.collect()}
    got = collected(merkle.audit(records, replica), "file", "offset", "status")
    want = [(*place[5], "corrupt"), (*place[2999], "corrupt"), (*place[77], "missing"), (place[8][0], 10**9, "extra")]
    assert got == sorted(want, key=repr)
    assert merkle.audit(records, records).count() == 0
    offsets = sorted((f, o) for f, o in place.values())
    assert offsets[0] == ("a", 0) and len(set(offsets)) == 3000


@pytest.mark.parametrize("block", [6, 50, 4000])
def test_separators(spark, tmp_path, block):
    draw, files = random.Random(block), {}
    for name in "abc":
        ids = [65535 if draw.random() < 0.1 else draw.randint(0, 9) for _ in range(draw.randint(1, 900))]
        if name == "c":
            ids = [1] * 500
        files[name] = ids
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    (tmp_path / "d").write_bytes(b"")
    found = separators.document_lengths(separators.read_token_files(spark, str(tmp_path), block))
    got = collected(found, F.substring_index("file", "/", -1), "document", "start", "n_tokens", "closed")
    want = []
    for name, ids in files.items():
        start, number = 0, 0
        for i, x in enumerate(ids):
            if x == 65535:
                want.append((name, number, start, i - start, True))
                start, number = i + 1, number + 1
        if start < len(ids):
            want.append((name, number, start, len(ids) - start, False))
    assert got == sorted(want, key=repr)


def test_ids_that_do_not_fit_a_token_file(spark):
    """The separator among a text's ids would end a document that does not end there."""
    first = int(np.frombuffer(bpe_tree.Encoder.load(PATH).leaf("hello there")[0], "<u4")[0])
    one = spark.createDataFrame([(1, "hello there")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="the separator"):
        separators.write_token_files(one, PATH, end=first)


def test_written_token_files(docs, rows):
    lengths = separators.document_lengths(separators.write_token_files(docs, PATH, block=64))
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter(plain.encoded(tokenizer, t)[0] for _, t in texts(rows))
    assert Counter(r.n_tokens for r in lengths.collect()) == want


# --- neighbours


def test_neighbours(spark):
    random_ = np.random.default_rng(5)
    vectors = random_.standard_normal((3000, 16)) * random_.uniform(0.5, 2, (3000, 1))
    vectors[100:400] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    strange = [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [None] * 16), (3004, []), (None, [1.0] * 16), (0, rows[0][1])]
    table = spark.createDataFrame(rows + strange, "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    for r in collisions.nearest(table, table.where("vec_id % 50 = 0"), k=20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 50))
    hits = 0
    for q, found in got.items():
        scores = (vectors * vectors[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        hits += len({*best.tolist()} & {i for i, _ in found})
        assert len(found) == 20 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(scores[i]) for i, s in found)
    assert hits >= 0.9 * 20 * len(got)
    few = spark.createDataFrame(rows[:5], "vec_id bigint, embedding array<double>")
    assert collisions.nearest(few, few.where("vec_id = 0")).count() == 4


# --- all of them on nothing and on odd rows


def test_empty_tables(spark, empty):
    assert bpe_tree.encode_documents(empty, PATH).count() == 0
    assert substring_repeats.remove_repeats(empty).count() == 0
    assert ngram_join.ngram_jaccard_join(empty).count() == 0
    assert ngram_join.first_of_each(empty).count() == 0
    assert host_rules.quality_by_host(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    assert paragraphs.remove_near_paragraphs(empty).count() == 0
    assert pii.redacted(empty).count() == 0
    assert separators.document_lengths(separators.write_token_files(empty, PATH)).count() == 0
    nothing = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert collisions.nearest(nothing, nothing).count() == 0
    records = merkle.laid_out(empty, "source", ["doc_id"], "text")
    assert merkle.audit(records, records).count() == 0


def test_odd_rows(odd):
    assert bpe_tree.encode_documents(odd, PATH, leaf=100).count() == 6
    assert collected(substring_repeats.remove_repeats(odd), "n_bytes", F.expr("n_bytes - n_removed"))[0] == (0, 0)
    assert ngram_join.ngram_jaccard_join(odd).where("component_id = 5").count() == 4
    assert host_rules.quality_by_host(odd).count() == 6
    assert mixing.mix(odd).count() == 6
    assert paragraphs.remove_near_paragraphs(odd).count() == 6
    assert pii.redacted(odd).count() == 6
    records = merkle.laid_out(odd, "source", ["doc_id"], "text")
    assert merkle.audit(records, records).count() == 0
