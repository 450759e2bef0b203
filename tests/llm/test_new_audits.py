"""Codes by dual trees, the divergence audit and the URL filter against plain versions, with odd rows and tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelode.llm import common, divergence, dual_tree, queries, url_filter

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error bigint, key int"


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Lloyd's rounds with every distance, in Python integers."""
    kept = [(k, v, lab) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = max((len(v) for _, v, _ in kept), default=0)
    width = max(1, -(-size // parts))
    whole = [[math.floor(256 * x) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    books = [[v[i * width : (i + 1) * width] for v in whole[:entries]] for i in range(parts)]

    def assign():
        out = []
        for v in whole:
            row = []
            for i in range(parts):
                p = v[i * width : (i + 1) * width]
                row.append(min((sum((a - b) ** 2 for a, b in zip(p, e)), j) for j, e in enumerate(books[i])))
            out.append(row)
        return out

    for _ in range(rounds if kept else 0):
        found = assign()
        for i in range(parts):
            members = defaultdict(list)
            for v, row in zip(whole, found):
                members[row[i][1]].append(v[i * width : (i + 1) * width])
            for j, own in members.items():
                books[i][j] = [sum(c) // len(own) for c in zip(*own)]
    found = assign() if kept else []
    of_label = Counter()
    errors = [sum(d for d, _ in row) for row in found]
    for (_, _, lab), e in zip(kept, errors):
        of_label[lab] += e
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return [(k, "".join("%02x" % j for _, j in row), e, of_label[lab]) for (k, _, lab), row, e in zip(kept, found, errors)], hashlib.sha256(flat.encode()).hexdigest()


def compressed(spark, rows):
    table = spark.createDataFrame([(k, v, lab, "x", 1, 2) for k, v, lab in rows], VECTORS)
    codes, books = dual_tree.compress(table)
    return collected(dual_tree.with_label_error(codes), "key", "code", "error", "label_error"), dual_tree.codebooks_sha256(books)


def vectors(n, seed=3, size=32, spread=0.02):
    """Clusters with ties, repeated vectors and far points."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 0.4, (9, size))
    v = (centres[draw.integers(0, 9, n)] + draw.normal(0, spread, (n, size))).astype(np.float32)
    v[::17] = v[0]
    v[5::29] *= 9
    return [(int(i), v[i].tolist(), None if i % 7 == 0 else int(i % 3)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 40, 700])
def test_codes_equal_plain_rounds(spark, n):
    want, sha = plain_codes(vectors(n))
    got, got_sha = compressed(spark, vectors(n))
    assert got == sorted(want, key=repr) and got_sha == sha


def test_codes_of_odd_rows(spark, monkeypatch):
    rows = vectors(90) + vectors(30) + [(None, [0.5] * 32, None), (None, [0.25] * 32, 1)]
    rows += [(900, None, 1), (901, [math.nan] + [0.0] * 31, 1), (902, [math.inf] * 32, 1), (903, [None] * 32, 1), (904, [], 5), (905, [0.1] * 5, 5)]
    want, sha = plain_codes(rows)
    got, got_sha = compressed(spark, rows)
    assert got == sorted(want, key=repr) and got_sha == sha
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)  # labels joined by a shuffle
    assert compressed(spark, rows)[0] == got


def test_codes_of_nothing(spark):
    assert compressed(spark, []) == plain_codes([])
    assert compressed(spark, [(1, None, 1)]) == plain_codes([])


def test_blocks_and_leaves_make_no_difference(spark, monkeypatch):
    want = compressed(spark, vectors(300))
    monkeypatch.setattr(dual_tree, "BLOCK", 23)
    assert compressed(spark, vectors(300)) == want


def test_components_too_large(spark):
    with pytest.raises(Exception, match="not under"):
        compressed(spark, [(1, [1e9] * 16, 1)])


def test_trees_prune_and_lose_nothing():
    draw = np.random.default_rng(5)
    for trial in range(40):
        n, k, w = int(draw.integers(1, 900)), int(draw.integers(1, 65)), int(draw.integers(1, 6))
        centres = draw.integers(-300, 300, (5, w))
        points = centres[draw.integers(0, 5, n)] + draw.integers(-4 if trial % 2 else 0, 5 if trial % 2 else 1, (n, w))
        book = dual_tree.EntryTree(np.concatenate([centres, points])[draw.integers(0, n + 5, k)])
        tree = dual_tree.Tree.over(points[dual_tree.grow(points, 8)], 8)
        want = ((tree.points[:, None] - book.entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (dual_tree.nearest_entries(tree, book) == want).all()
    # Far clusters, an entry each: whole nodes are assigned, no leaf is left open.
    centres = np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]])
    points = np.repeat(centres, 64, axis=0) + draw.integers(-3, 4, (256, 2))
    tree = dual_tree.Tree.over(points[dual_tree.grow(points, 16)], 16)
    (nodes, _), (left, _) = dual_tree.descend(tree, dual_tree.EntryTree(centres))
    assert len(left) == 0 and len(nodes) < 16


# --- divergence


def plain_divergence(rows, min_docs=10, top=10):
    docs = [((x or ""), (lang or ""), (source or "")) for x, lang, source in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    seen, had, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        words = term.findall(text.translate(lower))
        seen[lang].update(set(words))
        had[lang, source].update(words)
        groups.add((lang, source))
    kept = {lang: [t for t, n in seen[lang].items() if n >= min_docs] for lang, _ in groups}
    gap = lambda p, q: (p - q) ** 2 // (p + q)

    def probabilities(counts, terms):
        total = sum(counts[t] for t in terms)
        return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(terms)) for t in terms}

    out = []
    for lang, source in groups:
        terms = kept[lang]
        p = probabilities(had[lang, source], terms)
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(had[g])
        q = probabilities(whole, terms)
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                o = probabilities(had[lang, other], terms)
                pairs.append((-sum(gap(p[t], o[t]) for t in terms), other.encode()))
        words = [(-gap(p[t], q[t]), t.encode()) for t in terms if had[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
            out += [(lang, source, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out, key=repr)


def audited(spark, rows, **more):
    table = spark.createDataFrame([(i, *r, "x", 1, 2) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string, term string, n int, zero int")
    return collected(divergence.audit(table, **more), "lang", "source", "part", "item", "value", "rank")


def word_rows(n=260):
    draw = random.Random(8)
    words = ["Haus", "haus", "École", "école", "été", "ab1cd", "x_y", "日本", "the", "THE", "naïve", "z", "İ", "ſ", "don't"]
    words += ["w" + "".join(draw.choice("abcdef") for _ in range(2)) for _ in range(30)]
    rows = []
    for i in range(n):
        some = draw.sample(words, 12)
        text = " ".join(draw.choice(some) for _ in range(draw.randint(0, 40)))
        rows.append((text, draw.choice(["en", "de", "en", None, ""]), draw.choice(["a", "a", "a", "b", "ç", "zz", None])))
    rows += [(None, "en", "a"), ("", "fr", "a"), ("only here " * 3, "fr", "b"), (" \n\t\x00 1 2", "fr", None), ("the " * 50_000, "en", "b")]
    return rows + rows[:30]


def test_divergence_equals_plain(spark):
    rows = word_rows()
    assert audited(spark, rows) == plain_divergence(rows)
    assert audited(spark, rows, min_docs=1, top=3) == plain_divergence(rows, 1, 3)


def test_divergence_in_many_tiles(spark, monkeypatch):
    """Small tiles, blocks and sums, and joins by shuffle, change nothing."""
    rows = word_rows(120)
    for name, value in (("HELD", 20), ("TILE", 2), ("TERMS", 5)):
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert audited(spark, rows, min_docs=2) == plain_divergence(rows, 2)


def test_divergence_of_nothing(spark):
    assert audited(spark, []) == []
    rows = [(None, None, None), (None, None, "b"), ("", "x", "a")]
    assert audited(spark, rows) == plain_divergence(rows) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("École été " * 40 + "x" * 300 + " 1 ab").encode()
    want = [t for some in divergence.terms_of(text) for t in some]
    monkeypatch.setattr(divergence, "SLICE", 7)
    pieces = list(divergence.terms_of(text))
    assert [t for some in pieces for t in some] == want and len(pieces) > 20


# --- URLs

ODD = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "HTTP://EXAMPLE.ORG/es/1", "http://a.b.example.org/es/?x=1&y=2",
    "http://xexample.org/es/", "http://example.org/en/1", "http://example.org/en/2", "http://example.org?/en/1", "http://example.org#/es/",
    "http://m.com/fr/a.html", "http://com/de/", "http://com.net/de/", "https://xorg/", "http://İ.org/ü?é=日#😀", "x://y://org/", "http://org/a?u=http://m.com/de/",
    "http://exa mple.com/de/x\ny", "http://org:80/", "http://a@com/de/", "http://" + "a." * 3000 + "org/" + "d/" * 3000,
]


def plain_judged(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")):
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]) and len(rule) > len(best[0] if best else ""):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


def test_rules_equal_plain(spark):
    rows = [(i, u, "x", 1.0) for i, u in enumerate(ODD)] + [(3, "http://org/", "x", 1.0)] * 2 + [(None, "http://m.com/de/", "x", 1.0)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, host string, label double")
    got = {}
    for page, host, path, rule, verdict in collected(url_filter.judge(table, ["page_id"]), "page_id", "host", "path", "rule", "verdict"):
        got.setdefault(page, []).append((host, path, rule, verdict))
    for page, url in [(i, u) for i, u, _, _ in rows]:
        host, path, rule, verdict = plain_judged(url)
        assert any(g[:3] == (host, path, rule) and (verdict is None or g[3] == verdict) and g[3] in ("allow", "block") for g in got[page]), url
    assert sum(map(len, got.values())) == len(rows) and len(got[3]) == 3


def test_query_over_pages(spark, small, monkeypatch):
    found = collected(queries.op13_url_filter(spark, small), "page_id", "host", "path", "rule", "verdict")
    pages = dict(spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url").collect())
    assert len(found) == len(pages)
    for page, host, path, rule, verdict in found:
        assert (host, path, rule) == plain_judged(pages[page])[:3]
        assert verdict == (plain_judged(pages[page])[3] or verdict)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert collected(queries.op13_url_filter(spark, small), "page_id", "host", "path", "rule", "verdict") == found


def labelled_urls(n, seed):
    """URLs of two kinds that differ in their letters, not in any rule: junk has long random paths, digits, parameters, rare endings."""
    draw = random.Random(seed)
    word = lambda k: "".join(draw.choice("abcdefghiklmnoprstu") for _ in range(k))
    noise = lambda k: "".join(draw.choice("0123456789abcdefxyz-_") for _ in range(k))
    rows = []
    for i in range(n):
        junk = draw.random() < 0.4
        if junk:
            url = f"http://{noise(9)}.{word(4)}.{draw.choice(['xyz', 'top', 'com'])}/{noise(draw.randint(15, 40))}?{'&'.join(noise(5) + '=' + noise(8) for _ in range(draw.randint(1, 5)))}"
        else:
            url = f"https://www.{word(7)}.{draw.choice(['com', 'net', 'info'])}/{word(5)}/{word(8)}.html" + draw.choice(["", "?page=2"])
        rows.append((i, url, junk))
    return rows


def test_trees_on_held_out_urls(spark):
    """Trained on 1,500 labelled URLs, tried on 500 others."""
    rows = labelled_urls(2000, 2)
    table = spark.createDataFrame(rows, "page_id bigint, url string, junk boolean")
    lexical = url_filter.lexical(table, ["page_id", "junk"]).withColumn("truth", F.col("k1").cast("double"))
    lexical = lexical.withColumn("label", F.when(F.col("k0") < 1500, F.col("truth")))
    full = url_filter.with_statistics(lexical, url_filter.suffix_statistics(lexical))
    model = url_filter.train(full)
    held = url_filter.predicted(full.where("k0 >= 1500"), model)
    assert held.where("prediction = truth").count() >= 480


def test_urls_without_labels(spark):
    urls = lambda rows: collected(url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), ["page_id"]), "rule", "verdict")
    assert urls([]) == []
    assert urls([(1, "http://a.net/"), (2, None)]) == [(None, "allow")] * 2
    assert urls([(1, "http://a.net/"), (2, "http://a.com/de/x")]) == [("com/de/", "block"), (None, "block")]


def test_features_of_a_url(spark):
    table = spark.createDataFrame([(1, "http://ab.c/d/e.html?x=1&y=2#z"), (2, "")], "page_id bigint, url string")
    one, none = url_filter.lexical(table, ["page_id"]).orderBy("k0").collect()
    text = "http://ab.c/d/e.html?x=1&y=2#z"
    share = [n / len(text) for n in Counter(text).values()]
    assert one.entropy == pytest.approx(-sum(s * math.log2(s) for s in share))
    assert (one.n_chars, one.n_host, one.host_depth, one.path_depth, one.n_parameters) == (30, 4, 1, 2, 2)
    assert (one.host_suffix, one.path_suffix) == ("c", "html")
    assert one.digits == pytest.approx(2 / 30)
    assert (none.n_chars, none.entropy, none.digits, none.n_parameters) == (0, 0, 0, 0)


# --- the fixity query


def test_fixity_query_on_odd_pages(spark, tmp_path):
    """Null urls, texts and ids and repeated pages are sound; only what the query damages is reported, once each."""
    rows = [(1, None, "a"), (2, "http://a/", None), (None, "http://b/", "x"), (3, "http://c/", "same"), (3, "http://c/", "same"), (3, "http://c/", "other")]
    rows += [(7, "http://d/", "spoiled"), (7, "http://d/", "spoiled"), (57, None, ""), (5, "http://e/", "gone"), (102, None, None), (None, None, None)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, file string")
    table.write.parquet(f"{tmp_path}/pages.parquet")
    found = [(r.status, r.n_bytes, r.digest) for r in queries.op1_merkle(spark, str(tmp_path)).collect()]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = [("corrupt", 519, sha("spoiled"))] * 2 + [("corrupt", 512, sha("")), ("missing", 516, sha("gone")), ("missing", 512, sha(""))]
    assert sorted(found) == sorted(want)
    spark.createDataFrame([], table.schema).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert queries.op1_merkle(spark, f"{tmp_path}/none").count() == 0


# --- links inside buckets


@pytest.mark.parametrize("tile", [2048, 3])
def test_links_left_after_the_hubs(spark, monkeypatch, tile):
    """No hub rounds: all is left to the exact comparison, in one tile or many; it finds every pair that is alike."""
    monkeypatch.setattr(common, "TILE", tile)
    draw = random.Random(12)
    base = [draw.getrandbits(63) for _ in range(150)]
    sets = [base[:140] + [draw.getrandbits(63) for _ in range(draw.randint(0, 30))] for _ in range(14)]
    sets += [[draw.getrandbits(63) for _ in range(draw.choice([2, 60, 70, 130]))] + base[:k] for k in (0, 3, 20, 140, 150)]
    sets = [np.unique(np.array(s, np.uint64)) for s in sets]
    alike = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    assert 10 < len(alike) < 130
    sketches = spark.createDataFrame([(i, len(s), common.parity_bits(s).tolist()) for i, s in enumerate(sets)], "node bigint, n int, bits array<bigint>")
    members = spark.createDataFrame([(b, i, len(s)) for i, s in enumerate(sets) for b in ((7,) if i % 3 else (7, 8, 9))], "bucket bigint, node bigint, n int")
    labelled = members.withColumn("label", F.col("node"))
    for given in (sketches, None):
        pairs = {tuple(r) for r in common.remaining_pairs(labelled, given).collect()}
        assert alike <= pairs and all(a < b for a, b in pairs)
    assert len({tuple(r) for r in common.remaining_pairs(labelled, sketches).collect()}) < len(pairs)
    one_each = {tuple(r) for r in common.remaining_pairs(labelled, sketches, likeliest=True).collect()}
    if tile == 2048:
        assert one_each <= {tuple(r) for r in common.remaining_pairs(labelled, sketches).collect()} and len(one_each) <= len(sets)
    whole = labelled.withColumn("label", F.lit(1).cast("bigint"))
    assert common.remaining_pairs(whole, sketches).count() == 0


# --- the host query


def test_host_query_where_hosts_differ(spark, tmp_path):
    """The query and its SQL agree on a table in which a host is rejected: its sound documents go as well, those of others stay."""
    duckdb = pytest.importorskip("duckdb")
    draw = random.Random(21)
    good = lambda: " ".join(f"w{draw.randrange(5000)}" for _ in range(80))
    marked = lambda: "$$ && " * 15 + " ".join(f"#{draw.randrange(5000)}#" for _ in range(60))
    rows = [(i, good() if draw.random() < 0.95 else marked(), f"h{i % 9}") for i in range(400)]
    rows += [(i, marked(), "spam") for i in range(400, 460)] + [(460, good(), "spam"), (461, "too short", "h1"), (462, None, None), (463, good(), None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    table.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = collected(queries.op6_host_rules(spark, str(tmp_path)), *columns)
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = base.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()['op6_host_rules']})").fetchall()
    assert got == sorted(want, key=repr)
    state = {r[0]: r[-2:] for r in got}
    assert state[460] == (False, False) and state[461] == (True, False) and state[463] == (False, True)
    assert all(state[i] == (False, True) for i in range(400))
