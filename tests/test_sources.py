import datetime
import os

import pandas as pd
from pyspark.sql import functions as F

from pagelode.functions import htmltree, markup, urls
from pagelode.session import fresh_path
from pagelode.catalog import queries
from pagelode.sources import codecs, export, index_store, ingest, jsonl, tables
from pagelode.streaming import ingest as si

HTML = """<html><script>var t="</p><h1>no</h1>";</script><h1 id="firstHeading"> Red <i>River</i> </h1>
<div id="body"><div class="out"><p>First <sup class="reference">[1]</sup>para<br>more<p>Second &amp; <b>bold
<p><a href="/wiki/Red_Gum">gum</a></p><h2>Empty<span class="mw-editsection">edit</span></h2><h2>Full</h2>
<ul><li>one<li>two</ul><table><tr><td><a href="/wiki/Lost">t</a></table><div>gone</div>loose text
<p> </p></div></div><nav><ul><li> Rivers </li><li>North</li></ul></nav>
<footer>edited on 18 January 2018, at 21:30.</footer>"""
RULES = htmltree.Selectors(
    title="#firstHeading", content="#body .out", categories="nav ul > li", links="#body .out"
)


def test_parser_follows_the_content_rules():
    found, title, content, categories, footer, hrefs = htmltree.extract(HTML, RULES)
    assert found and title == "Red River" and categories == ["Rivers", "North"]
    assert content.split("\n") == ["First paramore", "Second & bold", "gum", "Full", "onetwo"]
    assert hrefs == ["/wiki/Red_Gum"] and "18 January" in footer


def test_missing_blocks_are_not_found(spark):
    assert htmltree.extract("<p>x", RULES)[0] is False
    frame = spark.createDataFrame([(1, "http://h/", "<p>x"), (2, "http://h/", HTML)], "page_id bigint, url string, html string")
    rows = markup.extract_pages(frame, RULES).orderBy("page_id").collect()
    assert [r.found for r in rows] == [False, True]
    assert markup.drop_empty(markup.extract_pages(frame, RULES).filter("found")).count() == 1


def test_parser_and_column_routes_agree(spark, small):
    pages = tables.scan_pages(spark, small)
    parsed = {r.page_id: (r.title, r.categories) for r in markup.extract_pages(pages).collect()}
    columns = pages.select(
        "page_id", markup.element_text(F.col("html"), "h1").alias("t"), markup.list_items(F.col("html"), "nav").alias("c")
    )
    for r in columns.collect():
        assert parsed[r.page_id] == (" ".join(r.t.split()), r.c)


def test_last_modified(spark):
    texts = ["This page was last edited on 18 January 2018, at 21:30.", "nothing", "edited on 1 Foo 2018, at 10:00."]
    frame = spark.createDataFrame([(t,) for t in texts], "f string")
    run = F.to_timestamp(F.lit("2020-01-02 03:04:00"))
    got = [r[0] for r in frame.select(markup.last_modified(F.col("f"), run)).collect()]
    other = datetime.datetime(2020, 1, 2, 3, 4)
    assert got == [datetime.datetime(2018, 1, 18, 21, 30), other, other]


def test_urls(spark):
    base = F.lit("http://en.site.org:80/wiki/Page?x=1#top")
    one = lambda c: spark.range(1).select(c.alias("x")).head().x
    assert one(urls.canonical_url(base)) == "http://en.site.org/wiki/Page?x=1"
    for href, want in {
        "/wiki/A": "http://en.site.org/wiki/A", "B": "http://en.site.org/wiki/B", "//o.org/x": "http://o.org/x",
        "https://o.org/y": "https://o.org/y", "#a": "http://en.site.org/wiki/Page#a", "mailto:x": None,
    }.items():
        assert one(urls.resolve_href(base, F.lit(href))) == want
    links = ["/wiki/Red_Gum", "/wiki/Talk:X", "/wiki/A%3AB", "/wiki/Red%5FGum", "/other/Y", "/wiki/C%20D+E", "/wiki/b%ZZ"]
    absolute = F.transform(F.array(*map(F.lit, links)), lambda h: urls.resolve_href(base, h))
    assert one(urls.link_titles(absolute, r"^en\.site\.org$", "^/wiki/([^:]*)$")) == ["Red Gum", "C D E"]


def test_json_lines_are_split(spark):
    lines = [
        '{"id": 1, "title": "a", "content": "b", "categories": ["x"]}', "", "  ", '{"id": 2,', '{"id": 3, "title": "a"}',
        '{"id": "x", "title": "a", "content": "b", "categories": []}', '{"id": 4, "title": "a", "content": "b", "categories": []}',
    ]
    path = fresh_path(spark, "lines")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    good, bad = jsonl.read_pages(spark, path)
    assert sorted(r.id for r in good.collect()) == [1, 4] and bad.count() == 3


def test_insert_or_ignore_counts_and_retries(spark):
    frame = lambda rows: spark.createDataFrame(rows, "page_id bigint, title string")
    path = fresh_path(spark, "table")
    assert ingest.insert_or_ignore(frame([(1, "a"), (2, "b"), (3, "a")]), path, 0) == 2
    assert ingest.insert_or_ignore(frame([(4, "b"), (5, "c")]), path, 1) == 1
    assert ingest.insert_or_ignore(frame([(4, "b"), (5, "c")]), path, 1) == 1  # the same batch again
    rows = ingest.read_table(spark, path, "page_id bigint, title string").collect()
    assert sorted((r.page_id, r.title) for r in rows) == [(1, "a"), (2, "b"), (5, "c")]


def test_a_batch_reads_the_buckets_of_its_keys(spark, monkeypatch):
    monkeypatch.setattr(ingest, "BUCKETS", 16)
    rows = lambda low, high: spark.range(low, high).select(F.col("id").alias("page_id"), F.concat(F.lit("t"), F.col("id")).alias("title"), F.lit("x").alias("body"))
    path = fresh_path(spark, "buckets")
    assert ingest.insert_or_ignore(rows(0, 300), path, 0) == 300
    assert ingest.insert_or_ignore(rows(250, 350), path, 1) == 50
    schema = rows(0, 1).schema
    before = ingest._read(spark, path, schema)
    assert before.select("bucket").distinct().count() == 16
    hit = before.where(F.col("bucket").isin([3]))
    assert set(f.split("bucket=")[1].split("/")[0] for f in hit.select("title").inputFiles()) >= {"3"}
    plan = hit.select("title")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "body" not in plan
    assert ingest.compact(spark, path, schema) == 1
    assert ingest.read_table(spark, path, schema).count() == 350
    assert ingest.insert_or_ignore(rows(250, 350), path, 1) == 0  # retried after it was merged
    assert ingest.insert_or_ignore(rows(340, 360), path, 2) == 10
    table = ingest.read_table(spark, path, schema)
    assert table.count() == table.select("title").distinct().count() == 360
    assert ingest.read_table(spark, path, "page_id bigint, title string, body string").where("body = 'x'").count() == 360
    assert ingest.compact(spark, fresh_path(spark, "none"), schema) is None


def test_page_rows_in_one_call(spark):
    pages = [
        (1, "http://en.site.org/wiki/A", HTML),
        (2, "http://en.site.org/wiki/B", HTML.replace("edited on 18 January 2018, at 21:30.", "never")),
        (3, "http://en.site.org/wiki/C", "<h1 id=firstHeading>only a title</h1>"),
        (4, None, None),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in markup.page_rows(frame, F.lit(datetime.datetime(2024, 1, 1)), r"en\.site\.org", "^/wiki/([^:]*)$", RULES).collect()}
    assert sorted(rows) == [1, 2]
    assert rows[1].title == "Red River" and rows[1].categories == ["Rivers", "North"] and rows[1].out_links == ["Red Gum"]
    assert rows[1].content.startswith("First para") and str(rows[1].last_modified) == "2018-01-18 21:30:00"
    assert str(rows[2].last_modified) == "2024-01-01 00:00:00"


def test_selectors_from_one_walk():
    """Against the definition of each selector, on random trees."""
    import random

    draw = random.Random(3)
    selectors = ("div", "#a .x", "ul > li", "div ul > li.x", ".x > .x", "div[class=x]", "div", "h1 > ul li")

    def tree(depth):
        node = htmltree.Node(draw.choice(["div", "ul", "li", "h1"]), {"id": draw.choice("ab"), "class": draw.choice(["x", "x y", "y", ""])})
        node.children = [tree(depth - 1) for _ in range(draw.randint(0, 3))] if depth else ["text"]
        return node

    def is_part(node, part):
        if part.startswith("#"):
            return node.attrs["id"] == part[1:]
        if part.endswith("]"):
            tag, value = part[:-1].split("[class=")
            return node.tag == tag and node.attrs["class"] == value
        tag, _, name = part.partition(".")
        return (not tag or node.tag == tag) and (not name or name in node.attrs["class"].split())

    def plain(root, selector):
        words = selector.split()

        def fits(chain, at):
            if not is_part(chain[-1], words[at]):
                return False
            if at == 0:
                return True
            child = words[at - 1] == ">"
            ends = [len(chain) - 1] if child else range(1, len(chain))
            return any(end >= 1 and fits(chain[:end], at - 1 - child) for end in ends)

        out = []

        def walk(node, chain):
            for c in node.elements():
                if fits([*chain, c], len(words) - 1):
                    out.append(c)
                walk(c, [*chain, c])

        walk(root, [])
        return out

    for _ in range(60):
        root = htmltree.Node("", {})
        root.children = [tree(4), tree(3)]
        for selector, found in zip(selectors, htmltree.select(root, selectors)):
            assert [id(n) for n in found] == [id(n) for n in plain(root, selector)], selector


def test_export_files_round_trip(spark):
    pages = spark.createDataFrame(
        [("b", 'x "q"', ["c"], ["a"]), ("a", "y", ["c", "d"], ["zz"])],
        "title string, content string, categories array<string>, out_links array<string>",
    )
    path = fresh_path(spark, "export")
    export.export_three_way(pages, path)
    good, bad = jsonl.read_pages(spark, f"{path}/kind=data")
    assert bad.count() == 0 and sorted((r.id, r.content) for r in good.collect()) == [(0, "y"), (1, 'x "q"')]
    assert [(r.id, r.links) for r in export.read_set(spark, path, "link").collect()] == [(1, [0])]
    assert sorted(map(tuple, export.read_set(spark, path, "index").collect())) == [(0, "a"), (1, "b")]
    assert sorted((r.id, r.categories) for r in export.read_set(spark, path, "data").collect()) == [(0, ["c", "d"]), (1, ["c"])]


def test_published_index_equals_built_index(spark, corpus):
    built = index_store.build_index(corpus)
    stored = index_store.publish_index(corpus, fresh_path(spark, "ix"), n_shards=2)
    cols = ["term", "field", "doc_id", "tf", "positions", "field_len"]
    key = lambda df: sorted(map(tuple, df.select(*cols).collect()))
    assert key(built.postings) == key(stored.postings)
    assert stored.postings.select("shard").distinct().count() == 2
    summary = {r.metric: r.n for r in index_store.index_summary(stored).collect()}
    assert summary["documents"] == 4 and summary["postings"] == built.postings.count()


def _page(i, title, url):
    return (i, url, f"<h1>{title}</h1><article><p>x</p></article><nav><ul><li>c</li></ul></nav>")


def _drop(folder, name, rows):
    pd.DataFrame(rows, columns=["page_id", "url", "html"]).to_parquet(os.path.join(folder, name))


def test_streams_restart_and_add_only_new_keys(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    table, state = fresh_path(spark, "s-table"), fresh_path(spark, "s-state")
    seen, seen_state = fresh_path(spark, "s-seen"), fresh_path(spark, "s-seen-state")

    def run():
        rows = markup.page_rows(si.read_page_stream(spark, folder), F.to_timestamp(F.lit("2024-01-01 00:00:00")), ".*", "^/(.*)$")
        si.ingest_pages(rows, table, state, compact_every=2)
        urls_seen = si.visited_urls(si.read_page_stream(spark, folder).select("url"))
        si.write_once(urls_seen, seen, seen_state)
        rows = ingest.read_table(spark, table, rows.schema)
        return sorted((r.title, r.page_id) for r in rows.collect()), sorted(
            r.url for r in spark.read.schema("url string").parquet(seen).collect()
        )

    _drop(folder, "1.parquet", [_page(1, "A", "http://h/a#x"), _page(2, "B", "http://h/b"), _page(3, "A", "http://h/a")])
    assert run() == ([("A", 1), ("B", 2)], ["http://h/a", "http://h/b"])
    _drop(folder, "2.parquet", [_page(4, "B", "http://h/b2"), _page(5, "C", "http://h/a#y")])
    assert run() == ([("A", 1), ("B", 2), ("C", 5)], ["http://h/a", "http://h/b", "http://h/b2"])
    assert run()[0] == [("A", 1), ("B", 2), ("C", 5)]


def test_stream_queries_read_a_table_of_many_files(spark, tmp_path):
    """A larger table is a folder of files, a smaller one a file; both give all their rows."""
    pages = [_page(1, "A", "http://h/a"), _page(2, "B", "http://h/b"), _page(3, "A", "http://h/a")]
    one, many = tmp_path / "one", tmp_path / "many"
    os.makedirs(one), os.makedirs(many / "pages.parquet")
    _drop(str(one), "pages.parquet", pages)
    for i, page in enumerate(pages):
        _drop(str(many / "pages.parquet"), f"part-{i}.parquet", [page])
    for folder in (one, many):
        assert sorted((r.title, r.page_id) for r in queries.stream_ingest_pages(spark, str(folder)).collect()) == [("A", 1), ("B", 2)]
        assert sorted(r.url for r in queries.stream_visited_dedup(spark, str(folder)).collect()) == ["http://h/a", "http://h/b"]


def test_visited_urls_with_watermark_plan(spark, tmp_path):
    stream = si.read_page_stream(
        spark, str(tmp_path), schema="url string, ts timestamp"
    )
    assert si.visited_urls(stream, "1 hour").isStreaming


def test_a_million_postings_on_one_line(spark):
    """Many entries on a line, and many positions in an entry, are read without recursion."""
    n = 1_000_000
    numbers = F.sequence(F.lit(1), F.lit(n))
    many = F.array_join(F.transform(numbers, lambda i: F.concat(i.cast("string"), F.lit(":1,0,2|5,7,9"))), ";")
    lines = spark.range(1).select(F.concat(F.lit("frequent\t"), many).alias("value"))
    found = codecs.decode_postings(lines)
    assert found.count() == n and codecs.bad_postings(lines).count() == 0
    assert found.where("doc_id = 777").first()["fields"] == [[5], [], [7, 9]]
    long = spark.range(1).select(F.concat(F.lit(f"long\t7:0,{n},0|"), F.array_join(numbers.cast("array<string>"), ",")).alias("value"))
    assert codecs.decode_postings(long).select(F.size(F.col("fields")[1])).first()[0] == n
    broken = lines.unionByName(long).select(F.concat("value", F.lit(";9:")).alias("value"))
    assert codecs.decode_postings(broken).count() == 0 and codecs.bad_postings(broken).count() == 2
