import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from corpus import CORPUS
from pyspark.sql import functions as F

from pagelode.functions import tiles
from pagelode.operators import postings as ps
from pagelode.operators.joins import one_of
from pagelode.plans import pages as pg, query_batches, ranked
from pagelode.session import fresh_path
from pagelode.sources import index_store, tables

QUERIES = [
    (1, "red river"), (2, "river red"), (3, "red"), (4, "the of"), (5, "zzzz"), (6, "red red"),
    (7, "red category:north"), (8, "red category:art north"), (9, "red category:the"), (10, "Red zzzz"),
    (11, "the red"), (12, "river gum red"), (13, "café"), (14, "red category:nosuch"),
]


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id bigint, query string")


def expected(search):
    return {(q, d): s for q, text in QUERIES for d, s in search(text).items()}


def scores(hits):
    return {(r.query_id, r.doc_id): r.text_score for r in hits.collect()}


def check(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


def test_ranked_hits_match_brute_force(spark, corpus, queries):
    check(scores(ranked.search_hits(index_store.build_index(corpus), queries)), expected(brute.Engine(CORPUS).search))


def test_fulltext_hits_match_brute_force(spark, corpus, queries):
    index = index_store.build_index(corpus, fulltext=True)
    hits = ranked.search_hits(index, queries, fulltext=True)
    check(scores(hits), expected(brute.Engine(CORPUS).search_fulltext))


@pytest.mark.parametrize("setting", [("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.shuffle.partitions", "13")])
def test_published_index_without_broadcast(spark, corpus, queries, setting):
    """The lane joins, and another partition count, give the same hits."""
    key, value = setting
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        index = index_store.publish_index(corpus, fresh_path(spark, "test-index"), n_shards=3)
        got = scores(ranked.search_hits(index, queries))
    finally:
        spark.conf.set(key, before)
    check(got, expected(brute.Engine(CORPUS).search))


def test_documents_match_brute_force(spark, small):
    rows = [tuple(r) for r in tables.corpus_documents(spark, small).collect()]
    texts = [(1, "de la"), (2, "inesea der"), (3, "de de la"), (4, "que en category:es")]
    engine = brute.Engine(rows)
    index = index_store.build_index(tables.corpus_documents(spark, small))
    frame = spark.createDataFrame(texts, "query_id bigint, query string")
    want = {(q, d): s for q, text in texts for d, s in engine.search(text).items()}
    check(scores(ranked.search_hits(index, frame)), want)


def test_batch_equals_single_queries(spark, corpus, queries):
    index = index_store.build_index(corpus)
    together = scores(ranked.search_hits(index, queries))
    for q in (1, 7):
        single = scores(ranked.search_hits(index, queries.filter(F.col("query_id") == q)))
        assert single == {k: v for k, v in together.items() if k[0] == q}


def test_rank_blending_and_default(spark, corpus, queries):
    ranks = spark.createDataFrame([(0, 0.1), (1, 0.4)], "id bigint, rank double")
    index = index_store.build_index(corpus).with_ranks(ranks)
    only = queries.filter("query_id = 3")
    rows = {r.doc_id: r for r in ranked.search(index, only, with_rank=True).collect()}
    raw = brute.Engine(CORPUS).search("red")
    low, high = min(raw.values()), max(raw.values())
    for d, s in raw.items():
        text = 100.0 if low == high else (s - low) / (high - low) * 100
        rank = {0: 0.1, 1: 0.4}.get(d, 1 / 4) / 0.4 * 1000
        assert rows[d].total == pytest.approx(0.9 * text + 0.1 * rank)


def test_top_results_order_and_limit(spark):
    hits = spark.createDataFrame(
        [(1, d, float(d % 3)) for d in range(10)] + [(2, 5, -1.0)], "query_id bigint, doc_id bigint, total double"
    )
    rows = ranked.top_results(hits, 4).orderBy("query_id", "rank_no").collect()
    assert [(r.query_id, r.doc_id) for r in rows] == [(1, 2), (1, 5), (1, 8), (1, 1), (2, 5)]


def test_pages_are_clamped(spark):
    results = spark.createDataFrame(
        [(q, d, d + 1) for q in (1, 2, 3, 4) for d in range(25)], "query_id bigint, doc_id bigint, rank_no int"
    )
    asked = spark.createDataFrame([(1, 2), (2, -5), (3, 99)], "query_id bigint, page int")
    rows = pg.paginate(results, asked).collect()
    shown = {q: sorted(r.rank_no for r in rows if r.query_id == q) for q in (1, 2, 3, 4)}
    assert shown[1] == list(range(11, 21)) and shown[2] == shown[4] == list(range(1, 11))
    assert shown[3] == list(range(21, 26))
    assert {r.total_pages for r in rows} == {3}


def test_window_limit_is_pushed_before_the_exchange(spark):
    hits = spark.range(10).selectExpr("id % 2 AS query_id", "id AS doc_id", "double(id) AS total")
    plan = ranked.top_results(hits, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def scanned_rows(df):
    """Rows the scans of a plan without exchanges gave: those of the row groups and pages they read."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return sum(found)


@pytest.fixture(scope="module")
def stored(spark, small):
    """A published index of the documents, in row groups of a few kilobytes."""
    group = index_store.POSTING_GROUP, index_store.CONTENT_GROUP
    index_store.POSTING_GROUP = index_store.CONTENT_GROUP = 4096
    try:
        path = fresh_path(spark, "stored")
        ranks = spark.createDataFrame([(0, 0.1), (1, 0.4)], "id bigint, rank double")
        corpus = tables.corpus_documents(spark, small)
        return path, index_store.publish_index(corpus, path, n_shards=3, ranks=ranks)
    finally:
        index_store.POSTING_GROUP, index_store.CONTENT_GROUP = group


def test_index_reopens_from_its_path_alone(spark, stored, small):
    path, index = stored
    again = index_store.open_index(spark, path)
    assert again.n_shards == 3 and again.ranks.count() == 2
    meta = again.meta.first()
    assert (meta.n_docs, meta.max_rank, meta.stemmed, meta.fulltext) == (200, 0.4, True, False)
    frame = spark.createDataFrame([(1, "de la"), (2, "inesea der category:src1")], "query_id bigint, query string")
    whole = index_store.build_index(tables.corpus_documents(spark, small)).with_ranks(again.ranks)
    rows = lambda ix: {(r.query_id, r.rank_no, r.doc_id, round(r.total, 8)) for r in ranked.search(ix, frame, with_rank=True).collect()}
    assert rows(again) == rows(whole) and len(rows(again)) > 10
    plan = ranked.search(again, frame, with_rank=True)._jdf.queryExecution().executedPlan().toString()
    assert "/ranks" not in plan


def test_terms_prune_shards_and_row_groups(spark, stored):
    _, index = stored
    rare = index.term_stats.where("field = 1 AND df = 2").orderBy("term").first()["term"]
    words = spark.createDataFrame([(rare,)], "term string")
    narrow = index.restricted(words)
    found = narrow.postings.where("field = 1")
    assert {r.term for r in found.collect()} == {rare} and found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and rare in plan
    assert scanned_rows(found) < index.postings.where("field = 1").count() / 10
    assert scanned_rows(narrow.term_stats) < index.term_stats.count() / 3
    many = spark.range(2000).select(F.col("id").cast("string").alias("term"))
    assert index.restricted(many) is index
    assert index.restricted(words.limit(0)).postings.count() == 0


def test_search_of_a_large_batch_is_not_narrowed(spark, stored, monkeypatch):
    _, index = stored
    frame = spark.createDataFrame([(1, "de la"), (2, "inesea der")], "query_id bigint, query string")
    want = scores(ranked.search_hits(index, frame))
    monkeypatch.setattr(index_store, "LITERALS", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr("pagelode.operators.joins.HOT_ROWS", 5)  # terms and queries are hot
        assert scores(ranked.search_hits(index, frame)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_shown_pages_are_looked_up_by_id(spark, stored):
    _, index = stored
    results = spark.createDataFrame([(1, 7, 1), (1, 150, 2), (2, 7, 1)], "query_id bigint, doc_id bigint, rank_no int")
    rows = pg.fetch_pages(results, index.docs, index.content).collect()
    want = {r.doc_id: r for r in index.content.where("doc_id IN (7, 150)").collect()}
    assert sorted((r.query_id, r.rank_no, r.doc_id) for r in rows) == [(1, 1, 7), (1, 2, 150), (2, 1, 7)]
    assert all(r.content == want[r.doc_id].content for r in rows)
    plan = pg.fetch_pages(results, index.docs)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "In(doc_id" in plan
    assert scanned_rows(index.content.where(one_of("doc_id", [7]))) < index.docs.count() / 10


def test_paging_moves_nothing(spark):
    hits = spark.range(100).selectExpr("id % 2 AS query_id", "id AS doc_id", "double(id) AS total")
    asked = spark.createDataFrame([], "query_id bigint, page int")
    plan = pg.paginate(ranked.top_results(hits), asked)._jdf.queryExecution().executedPlan().toString()
    assert "__lane" not in plan and plan.count("Exchange hashpartitioning(query_id") <= 2


@pytest.mark.parametrize("fulltext", [False, True])
def test_wide_postings_meet_in_their_row(spark, corpus, fulltext):
    odd = spark.createDataFrame([(7, None, "red Red", None), (8, "", "", []), (9, None, None, None)], corpus.schema)
    rows = corpus.unionByName(odd)
    wide = ps.wide_postings(rows, fulltext=fulltext)
    assert "Exchange hashpartitioning(term" not in wide._jdf.queryExecution().executedPlan().toString()
    want = defaultdict(lambda: [[], [], []])
    for r in ps.build_postings(rows, fulltext=fulltext).collect():
        want[r.term, r.doc_id][r.field] = r.positions
    got = {(r.term, r.doc_id): (r.freq, r.positions) for r in wide.collect()}
    assert got == {k: ([len(p) for p in v], sum(v, [])) for k, v in want.items()} and ("red", 7) in got
    lists = ps.posting_lists(corpus)._jdf.queryExecution().executedPlan().toString()
    assert lists.count("Exchange hashpartitioning(term") == 1


def test_batches_of_queries_give_the_same_results(spark, corpus, monkeypatch):
    index = index_store.build_index(corpus)
    asked = spark.createDataFrame([(i, q) for i, q in enumerate(("red river", "river", "red", "river category:trees", "zzzz", "gum red"))], "query_id bigint, query string")
    rows = lambda: sorted((r.query_id, r.rank_no, r.doc_id, round(r.total, 8)) for r in ranked.search(index, asked).collect())
    whole = rows()
    monkeypatch.setattr(ranked, "PAIRS_AT_ONCE", 1)
    assert len(ranked.AnalysedQueries(index, asked).batches()) > 1
    assert rows() == whole and len({r[0] for r in whole}) > 2


def many_queries(spark):
    """A corpus of few words, so that scores tie and words stand in all orders, and queries of them, some with a category."""
    rng = random.Random(7)
    words = ["red", "river", "gum", "tree", "blue", "stone", "the", "falls"]
    some = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(1, n)))
    docs = [(i * 7 - 300, some(4), some(20), rng.sample(words, 2)) for i in range(60)]
    asked = [(i - 5, some(4) + (f" category:{some(2)}" if i % 4 == 0 else "")) for i in range(24)]
    corpus = spark.createDataFrame(docs, "doc_id bigint, title string, content string, categories array<string>")
    ranks = spark.createDataFrame([(d[0], d[0] / 1000) for d in docs[::2]], "id bigint, rank double")
    return corpus, ranks, spark.createDataFrame(asked, "query_id bigint, query string")


def test_many_queries_go_through_blocks_and_keep_every_column(spark, monkeypatch, tmp_path):
    corpus, ranks, asked = many_queries(spark)
    index = index_store.publish_index(corpus, str(tmp_path / "index"), 4, ranks=ranks)
    columns = ["query_id", "rank_no", "doc_id", "title_score", "content_score", "category_score", "text_score", "rank", "total"]
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    rows = lambda limit: sorted((tuple(map(plain, r)) for r in ranked.search(index, asked, limit=limit).select(columns).collect()), key=str)
    whole, first = rows(1000), rows(5)
    monkeypatch.setattr(ranked, "PAIRS_AT_ONCE", 100)
    monkeypatch.setattr(query_batches, "BLOCK_POSTINGS", 200)
    # Pairs of queries and documents do not become rows.
    monkeypatch.setattr(ranked, "_hits", lambda analysed: pytest.fail("searched by a join"))
    assert rows(1000) == whole and rows(5) == first
    monkeypatch.setattr(query_batches, "KEPT_RESULTS", 50)
    monkeypatch.setattr(query_batches, "TERMS_AT_ONCE", 1)
    assert rows(5) == first and len(first) < len(whole)


def test_many_queries_with_an_id_given_with_and_without_category(spark, monkeypatch):
    corpus, _, _ = many_queries(spark)
    index = index_store.build_index(corpus)
    asked = spark.createDataFrame([(1, "red"), (2, "river"), (2, "blue category:red"), (None, "gum")], "query_id bigint, query string")
    rows = lambda: sorted((r.query_id, r.rank_no, r.doc_id, round(r.total, 9)) for r in ranked.search(index, asked).collect())
    whole = rows()
    monkeypatch.setattr(ranked, "PAIRS_AT_ONCE", 40)
    assert rows() == whole and {r[0] for r in whole} >= {1}


def test_results_are_cut_by_printed_total_and_id():
    total = np.array([1.0, 1.000000004, 1.00000001, 0.999999996, 0.5, 0.123456785, -0.123456785, -0.1])
    printed = tiles.printed(total, 8)
    assert printed.tolist() == [1e8, 1e8, 100000001, 1e8, 5e7, 12345679, -12345679, -1e7]
    kept, last = tiles.best(printed, np.array([9, 2, 7, 1, 0, 3, 4, 5]), 3)
    assert sorted(kept.tolist()) == [1, 2, 3] and last == 1e8
