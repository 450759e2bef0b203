import random
import re

import duckdb
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from pagelode.catalog.stem_sql import duckdb_stem
from pagelode.functions import grouping, markup, porter2, text as tx
from pagelode.functions.stemming import with_stem
from pagelode.operators import postings as ps
from pagelode.sources import codecs

PIECES = (
    "ational tional izer ator ly li ing ed eed s es ies ied y ee e l ll at bl iz gener commun arsen sky ful ness "
    "ative ion t s able 's ' b c d a e i o u y bb ogi log er us ss ment"
).split()


def test_published_stems():
    for word, stem in {
        "consign": "consign", "consigned": "consign", "consistency": "consist", "knackeries": "knackeri",
        "knives": "knive", "generously": "generous", "communication": "communic", "skies": "sky", "dying": "die",
        "news": "news", "succeeded": "succeed", "hopping": "hop", "hoped": "hope", "ties": "tie", "cries": "cri",
        "gas": "gas", "this": "this", "gaps": "gap", "say": "say", "by": "by", "at": "at",
    }.items():
        assert porter2.stem(word) == stem


def test_stemmer_agrees_with_sql_chain():
    rnd = random.Random(7)
    words = {"".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 5))) for _ in range(20000)}
    words |= set(porter2.EXCEPTIONS) | set(porter2.FINISHED)
    frame = pd.DataFrame({"token": sorted(words)})
    con = duckdb.connect()
    con.register("words", frame)
    for word, stem in con.execute(f"SELECT token, stem FROM {duckdb_stem('words')} s").fetchall():
        assert porter2.stem(word) == stem, word


def test_stem_column_handles_null(spark):
    rows = with_stem(spark.createDataFrame([("rivers",), (None,), ("rivers",)], "w string"), "w", "s").collect()
    assert [r.s for r in rows] == ["river", None, "river"]


def test_token_delimiters(spark):
    row = spark.range(1).select(tx.tokens(F.lit(" a\tb\n\nc\rd\fe\x0bf g ")).alias("t")).head()
    assert row.t == ["a", "b", "c", "d", "e\x0bf g"]


def test_normalisation_in_one_match(spark):
    raw = ["(Red)", "--", "don't", "e-mail", "café", "\x0bfoo.", "x1!", "!\x01a", "a\x01!\x01", "ÀB"]
    frame = spark.createDataFrame([(r,) for r in raw], "raw string")
    token = tx.normalize_token(F.col("raw"))
    rows = frame.select(
        F.when(tx.is_alnum(token), token).otherwise("").alias("two"), tx.indexable_token(F.lower("raw")).alias("one")
    ).collect()
    assert [r.two for r in rows] == [r.one for r in rows]
    assert [r.one for r in rows] == ["red", "", "", "", "", "foo", "x1", "a", "", ""]


def test_positions_survive_dropped_tokens(corpus):
    rows = {(r.term, r.field, r.doc_id): r.positions for r in ps.build_postings(corpus).collect()}
    assert rows["red", 1, 0] == [1]
    assert rows["river", 1, 0] == [2, 4]  # stop words and punctuation hold their place
    assert rows["river", 1, 1] == [5] and ("red", 1, 1) not in rows  # red-barked is dropped
    assert rows["red", 1, 2] == [0, 1, 2]
    assert rows["art", 2, 2] == [2] and rows["north", 2, 2] == [3]
    assert not [k for k in rows if k[2] == 3 and k[1] < 2]


def test_words_of_a_batch_are_grouped_on_arrays(spark):
    """Words of odd texts are grouped by term as one by one, in batches of texts and without a row per word."""
    rnd = random.Random(5)
    letters = "aab\u00e9R1.,(!- \t\n\r\f\x0b\x01  "
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " \n", "Rivers the rivers. (RIVER)", "x" * 1_000_000 + " a" * 3, "\x01a the"]
    frame = spark.createDataFrame([(i, t, t, [t, None] if i % 2 else None) for i, t in enumerate(texts)], "doc_id bigint, title string, content string, categories array<string>")
    want = {}
    for i, t in enumerate(texts):
        for field, text in enumerate((t, t, t if i % 2 else None)):
            toks = [x for x in re.split(tx.DELIMITERS, (text or "").lower()) if x]
            for at, token in enumerate(toks):
                word = re.fullmatch(r"[!-/:-@\[-`{-~]*[\x00-\x20]*([a-z0-9]+)[\x00-\x20]*[!-/:-@\[-`{-~]*", token)
                if word and word[1] not in tx.STOP_WORDS:
                    want.setdefault((porter2.stem(word[1]), field, i), ([], len(toks)))[0].append(at)
    rows = ps.build_postings(frame).collect()
    assert {(r.term, r.field, r.doc_id): (r.positions, r.field_len) for r in rows} == want and len(rows) == len(want)
    assert all(r.tf == len(r.positions) for r in rows)
    lens = {(r.doc_id, r.field): r.len for r in ps.field_lengths(frame).collect()}
    assert all(lens[i, 1] == (None if t is None else len([x for x in re.split(tx.DELIMITERS, t) if x])) for i, t in enumerate(texts))
    sizes, words = grouping.split_tokens(pa.array(["z", "ab", None, "c d"]).slice(1), tx.DELIMITER_BYTES)
    assert list(sizes) == [1, 0, 2] and words.to_pylist() == [b"ab", b"c", b"d"]


def test_lengths_and_statistics(corpus):
    lens = {(r.doc_id, r.field): r.len for r in ps.field_lengths(corpus).collect()}
    assert lens[0, 1] == 8 and lens[3, 1] == 3 and lens[2, 2] == 4
    stats = {r.field: (r.n_docs, r.avg_len) for r in ps.corpus_stats(corpus).collect()}
    assert stats[1] == (4, (8 + 8 + 3 + 3) / 4)


def test_posting_lists_are_blocked_and_whole(corpus):
    postings = ps.build_postings(corpus)
    blocks = ps.posting_lists(postings, block_docs=1).collect()
    assert max(len(b.entries) for b in blocks) == 1
    assert sum(len(b.entries) for b in blocks) == ps.wide_postings(postings).count()


def test_posting_text_roundtrip(corpus):
    wide = ps.wide_postings(ps.build_postings(corpus))
    back = codecs.decode_postings(codecs.encode_postings(ps.posting_lists(ps.build_postings(corpus))))
    want = sorted((r.term, r.doc_id, r.freq, r.positions) for r in wide.collect())
    got = sorted((r.term, r.doc_id, r.freq, sum(r.fields, [])) for r in back.collect())
    assert want == got
    assert all([len(f) for f in r.fields] == r.freq for r in back.collect())


def test_fulltext_words_are_found_once_and_as_the_rules_say(spark):
    """Simple words are found by a short pattern, in one pass over the text."""
    rnd = random.Random(3)
    letters = "ab1\u00e9 \u00df\u00ad_.,;:'\"-!\n\u0144\u05d0\u30ab\u6f22\u200d\u00aa\u00b2\u2167\u00b7\x0b %"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)] + [None, " " * 5000 + "a. b", "a.b,c 1,2.x"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_extract_all(F.lower("t"), F.lit(tx.FULLTEXT_WORD), F.lit(0))
    found = frame.select(tx.fulltext_words(F.col("t")).alias("w"), plain.alias("plain"))
    assert found.where(~F.col("w").eqNullSafe(F.col("plain"))).count() == 0
    assert found.select("w")._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(lower") == 1


def test_first_tokens(spark):
    texts = ["", " ", " a\tb  c d ", "a", "a b\x0bc d e\n", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.slice(tx.tokens(F.col("t")), 1, 3)
    assert frame.where(~tx.first_tokens(F.col("t"), 3).eqNullSafe(want)).count() == 0


def test_python_workers_get_bounded_batches(spark, corpus):
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "10000"), spark.conf.set(names[1], str(64 << 20))
    ps.wide_postings(corpus)
    assert [int(spark.conf.get(n)) for n in names] == [1000, 8 << 20]
    markup.extract_pages(spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string"))
    assert [int(spark.conf.get(n)) for n in names] == [200, 2 << 20]
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def test_posting_line_is_cut_once(spark):
    """Entries travel without their line; a line cut again for each entry costs the square of its length."""
    lines = spark.createDataFrame([("a\t1:1,0,0|5;2:0,2,0|1,7",), ("a\t1:1,0,0|5;2",), (None,)], "value string")
    back = codecs.decode_postings(lines)
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert "value" not in plan[: plan.index("Generate explode")]
    assert sorted(map(tuple, back.collect())) == [("a", 1, [1, 0, 0], [[5], [], []]), ("a", 2, [0, 2, 0], [[], [1, 7], []])]


def test_list_codec(spark):
    texts = ["", "a", "a|b", "a||", "|a", "||", "a||b"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(codecs.decode_list(F.col("t"))).collect()]
    assert got == [[""], ["a"], ["a", "b"], ["a"], ["", "a"], [], ["a", "", "b"]]


def test_rank_lines(spark):
    frame = spark.createDataFrame([(1, 0.25, [2, 3]), (2, 0.5, [])], "id bigint, rank double, links array<bigint>")
    lines = codecs.encode_ranks(frame)
    assert [r.value for r in lines.collect()] == ["1,0.25\t2,3", "2,0.5\t"]
    assert sorted(map(tuple, codecs.decode_ranks(lines).collect())) == [(1, 0.25, [2, 3]), (2, 0.5, [])]
    bad = codecs.decode_ranks(spark.createDataFrame([("x,y\t1",)], "value string")).head()
    assert bad.id is None and bad.rank is None


def test_query_parsing(spark):
    texts = ["Red River", " red category: Art North ", "a Category:b", "x category:y category:z", "a\tb  c"]
    frame = spark.createDataFrame([(t,) for t in texts], "q string")
    rows = frame.select(tx.keyword_part(F.col("q")).alias("k"), tx.category_part(F.col("q")).alias("c")).collect()
    assert [tuple(r) for r in rows] == [
        ("red river", ""), ("red", "art north"), ("a category:b", ""), ("x", "y category:z"), ("a\tb  c", ""),
    ]
    words = frame.select(tx.split_words(F.col("q"))).collect()
    assert words[4][0] == ["a\tb", "c"]


#: Texts and their words by the published rules for Unicode word breaks, worked out by hand.
WORD_BREAKS = [
    ("3.14 1,000.5 10.0.0.1", ["3.14", "1,000.5", "10.0.0.1"]),
    ("Don't can’t o'clock 'quoted'", ["don't", "can’t", "o'clock", "quoted"]),
    ("me.x@site.example.org", ["me.x", "site.example.org"]),
    ("a:b a,b a;b 1:2", ["a:b", "a", "b", "a", "b", "1", "2"]),
    ("foo_bar __init__ _ __", ["foo_bar", "__init__"]),
    ("日本語テスト ひらが カタカナー", ["日", "本", "語", "テスト", "ひ", "ら", "が", "カタカナー"]),
    ("abc日本12", ["abc", "日", "本", "12"]),
    ("nai\u0308ve naïve", ["nai\u0308ve", "naïve"]),
    ("x1y2 1st 2nd", ["x1y2", "1st", "2nd"]),
    ("a.b.c. U.S.A.", ["a.b.c", "u.s.a"]),
    ("สวัสดี ครับ", ["สวัสดี", "ครับ"]),
    ("한국어 단어", ["한국어", "단어"]),
    ("\u05e9\u05f4\u05e1 \u05e6' \u05d0\"\u05d1", ["\u05e9\u05f4\u05e1", "\u05e6'", "\u05d0\"\u05d1"]),
    ("soft\u00adhyphen", ["soft\u00adhyphen"]),
    ("a..b 1..2 a.1 1.a", ["a", "b", "1", "2", "a", "1", "1", "a"]),
    ("C++ C# R&D", ["c", "c", "r", "d"]),
    ("²³ Ⅷ ½", ["ⅷ"]),
    ("ア_a アa", ["ア_a", "ア", "a"]),
    ("I.B.M.'s", ["i.b.m", "s"]),
    ("emoji 😀 ok — «oui» ", ["emoji", "ok", "oui"]),
    ("", []),
]


def test_word_breaks_by_hand(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WORD_BREAKS)], "i int, t string")
    found = dict(rows.select("i", tx.fulltext_words(F.col("t"))).collect())
    for i, (text, words) in enumerate(WORD_BREAKS):
        assert found[i] == words, text


def test_words_of_a_megabyte(spark):
    """Neither stack nor time runs out on one word of a megabyte; it is cut into pieces of 255."""
    n = 500_000
    texts = {"a.": ("a", "."), "a": ("a", ""), "1,": ("1", ","), "a_": ("a", "_"), "a1": ("a", "1"), "a'": ("a", "'"), ". ": (None, None), "日": (None, None)}
    rows = spark.createDataFrame([(k, k * n) for k in texts], "k string, t string")
    found = dict(rows.select("k", tx.fulltext_words(F.col("t")).alias("w")).collect())
    for piece, (first, _) in texts.items():
        if first:
            assert all(0 < len(w) <= 255 for w in found[piece]) and "".join(found[piece]).count(first) == n, piece
            assert len(found[piece]) <= len(piece) * n // 254 + 1
    assert found[". "] == [] and found["日"] == ["日"] * n
