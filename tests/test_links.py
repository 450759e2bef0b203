import pytest

import brute
from pagelode.operators import frontier, ids, joins, links, pagerank as pr, robots
from pagelode.sources import export
from pyspark.sql import functions as F

EDGES = [(0, 1), (0, 2), (1, 2), (2, 0), (3, 2), (3, 3), (1, 9), (2, 8)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src bigint, dst bigint")


def test_fixed_steps_match_brute_force(edges):
    got = {r.id: r.rank for r in pr.pagerank_steps(edges, 7).collect()}
    assert got == pytest.approx(brute.pagerank(EDGES, steps=7))


def test_converged_ranks_stop_at_the_first_still_step(edges):
    got = {r.id: r.rank for r in pr.pagerank(edges, tolerance=1e-3).collect()}
    assert got == pytest.approx(brute.pagerank(EDGES, tolerance=1e-3), abs=1e-12)


def test_hot_source_is_split_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pr, "BLOCK_LINKS", 10)
    star = [(0, d) for d in range(1, 60)] + [(d, 0) for d in range(1, 60)]
    frame = spark.createDataFrame(star, "src bigint, dst bigint")
    graph = pr.RankGraph(frame)
    assert graph.edges.filter("src = 0 AND block >= 0").select("block").distinct().count() > 1
    graph.close()
    got = {r.id: r.rank for r in pr.pagerank_steps(frame, 4).collect()}
    assert got == pytest.approx(brute.pagerank(star, steps=4))


def test_ranks_are_at_least_the_base(edges):
    rows = pr.pagerank_steps(edges, 3).collect()
    assert min(r.rank for r in rows) >= 0.15 / 4 - 1e-12


def test_step_plan_reads_old_ranks_once(edges):
    graph = pr.RankGraph(edges)
    ranks = graph.start()
    for _ in range(3):
        ranks = graph.step(ranks)
    plan = ranks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 3
    graph.close()


def test_ids_are_dense_in_title_order(spark):
    titles = [f"t{i * 7919 % 1000:04d}" for i in range(1000)]
    frame = spark.createDataFrame([(t,) for t in titles], "title string").repartition(5)
    rows = ids.assign_doc_ids(frame).collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.title)] == list(range(1000))


def test_first_per_key(spark):
    frame = spark.createDataFrame([(i, f"k{i % 3}") for i in range(30)], "page_id bigint, title string")
    assert sorted(r.page_id for r in ids.first_per_key(frame, "title", "page_id").collect()) == [0, 1, 2]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_export_resolves_titles(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        pages = spark.createDataFrame(
            [("b", "x", ["c"], ["a", "zz", "b", "a"]), ("a", "y", ["c", "d"], ["b"]), ("c", "z", ["c"], [""])],
            "title string, content string, categories array<string>, out_links array<string>",
        )
        sets = export.export_sets(pages)
        assert sorted(map(tuple, sets["index"].collect())) == [(0, "a"), (1, "b"), (2, "c")]
        assert {r.id: r.links for r in sets["link"].collect()} == {0: [1], 1: [0, 1, 0]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("counted", [True, False])
def test_only_hot_keys_are_spread(spark, no_broadcast, monkeypatch, how, counted):
    """Of two keys one is hot: its row is repeated in as many lanes as its rows ask for, the others move once."""
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    key = F.when(F.col("id") < 450, 0).when(F.col("id") < 490, 1).when(F.col("id") < 495, 5)
    big = spark.range(500).select(key.cast("bigint").alias("k"), "id")  # 450 rows of 0, 40 of 1, 5 of 5, 5 nulls
    small = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c"), (None, "d")], "k bigint, v string")
    counts = joins.key_counts(big, ["k"])
    hot = joins.hot_keys(counts, ["k"])
    assert [tuple(r) for r in hot.collect()] == [(0, 5)]
    repeated = joins.in_all_lanes(small, hot, ["k"]).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in repeated} == {0: 5, 1: 1, 7: 1, None: 1}
    lanes = joins.in_lanes(big, hot, ["k"], [F.col("id")]).groupBy("k").agg(F.countDistinct("__lane").alias("n")).collect()
    assert {r.k: r.n for r in lanes} == {0: 5, 1: 1, 5: 1, None: 5}
    got = joins.spread_join(big, small, ["k"], [F.col("id")], how, counts if counted else None)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, big.join(small, "k", how).collect()), key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__lane" in plan and "Generate" in plan


def test_keys_that_are_not_hot_are_joined_plainly(spark, no_broadcast):
    big = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    got = joins.spread_join(big, small, ["k"], [F.col("id")])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__lane" not in plan and "Generate" not in plan
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, big.join(small, "k").collect()))


def test_literals_of_a_written_table(spark):
    keys = spark.createDataFrame([(i % 37,) for i in range(100)] + [(None,)], "k bigint")
    values = joins.literals_of(keys, "k")
    assert values == list(range(37))
    rows = spark.range(100).select(F.col("id").alias("k"))
    assert rows.where(joins.one_of("k", values)).count() == 37 and rows.where(joins.one_of("k", [])).count() == 0
    assert joins.literals_of(spark.range(joins.LITERALS + 1), "id") is None


def test_frontier_depth_budget_and_empty_level(spark, edges):
    seeds = spark.createDataFrame([(0,)], "url bigint")
    depths = lambda df: {r.url: r.depth for r in df.collect()}
    assert depths(frontier.frontier_bfs(seeds, edges)) == {0: 0, 1: 1, 2: 1, 9: 2, 8: 2}
    assert depths(frontier.frontier_bfs(seeds, edges, max_depth=1)) == {0: 0, 1: 1, 2: 1}
    assert depths(frontier.frontier_bfs(seeds, edges, page_budget=4)) == {0: 0, 1: 1, 2: 1, 8: 2}


def test_frontier_of_a_source_with_very_many_links(spark, no_broadcast, monkeypatch):
    """The links stay in their buckets: a level's join moves the level only; a hot source is dealt to several buckets."""
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    edges = spark.range(1, 400).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"))
    edges = edges.unionByName(spark.range(1, 400).select(F.col("id").alias("src"), (F.col("id") + 1000).alias("dst")))
    seeds = spark.createDataFrame([(0,)], "url bigint")
    rows = frontier.frontier_bfs(seeds, edges).collect()
    assert {r.url: r.depth for r in rows} == {0: 0, **{i: 1 for i in range(1, 400)}, **{i + 1000: 2 for i in range(1, 400)}}
    some = frontier.frontier_bfs(seeds, edges, page_budget=500).collect()
    assert sorted(r.url for r in some) == [*range(400), *range(1001, 1101)]
    links = frontier.Links(edges)
    try:
        assert [(r.src, r[1]) for r in links.hot.collect()] == [(0, 8)]
        assert links.spark.table(links.name).where("src = 0").select("__lane").distinct().count() == 8
        level = spark.createDataFrame([(0, 0), (5, 0)], "url bigint, depth int")
        plan = links.targets(level)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(src") == 1 and "Bucketed: true" in plan
    finally:
        links.close()


def test_frontier_budget_below_the_seeds(spark, edges):
    seeds = spark.createDataFrame([(3,), (1,), (2,)], "url bigint")
    assert sorted(r.url for r in frontier.frontier_bfs(seeds, edges, page_budget=2).collect()) == [1, 2]
    assert frontier.frontier_bfs(seeds, edges, page_budget=0).count() == 0


ROBOTS = [
    "User-agent: other", "Disallow: /", "User-agent: *", "User-agent: page*", "Allow: /a/b", "disallow: /a",
    "Allow: /a", "Disallow:", "Disallow: /x%20y # note", "  Disallow: /q?z  ", "Noise", "User-agent: PAGELODE",
    "Disallow: /never", "User-agent: pagelod?", "Disallow: /late", "Disallow: /a/b",
]


def test_robots(spark):
    lines = spark.createDataFrame([("h", i, l) for i, l in enumerate(ROBOTS)], "host string, line_no int, line string")
    rules = robots.robots_rules(lines, "pagelode")
    got = sorted((r.ord, r.path, r.allow) for r in rules.collect())
    # '/a/b' keeps its first place and takes its last value, as does '/a'
    assert got == [(4, "/a/b", False), (5, "/a", True), (8, "/x y", False), (9, "/q?z", False), (14, "/late", False)]
    urls = ["http://h/a/b/c", "http://h/a/c", "http://h/q?z=1", "http://h/never", "http://other/a/b", "http://h"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    allowed = {r.url: r.allowed for r in robots.robots_filter(frame, rules).collect()}
    assert [allowed[u] for u in urls] == [False, True, False, True, True, True]


def test_robots_empty_path_blocks_all(spark):
    lines = spark.createDataFrame(
        [("h", 0, "User-agent: *"), ("h", 1, "Disallow: # everything")], "host string, line_no int, line string"
    )
    frame = spark.createDataFrame([("http://h/x",)], "url string")
    assert not robots.robots_filter(frame, robots.robots_rules(lines, "pagelode")).head().allowed


def test_links(edges, spark):
    assert {r.src: r.n for r in links.out_degree(edges).collect()} == {0: 2, 1: 2, 2: 2, 3: 2}
    assert sorted(r.id for r in links.dangling_nodes(edges).collect()) == [8, 9]
    assert {r.dst: r.n for r in links.in_links(edges).collect()}[2] == 3
