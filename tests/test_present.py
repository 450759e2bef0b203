import json
import re

from pyspark.sql import functions as F

from pagelode.functions import present
from pagelode.plans import pages as pg


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head().x


def words(*items):
    return F.array(*[F.lit(w) for w in items]) if items else F.array().cast("array<string>")


def test_highlight_is_literal_and_sequential(spark):
    text = F.lit("Red b. red (a+b) \\E")
    assert one(spark, present.highlight(text, words("red"), "b")) == "<b>Red</b> b. <b>red</b> (a+b) \\E"
    assert one(spark, present.highlight(text, words("(a+b)"), "b")) == "Red b. red <b>(a+b)</b> \\E"
    assert one(spark, present.highlight(F.lit("x \\E y"), words("\\e"), "b")) == "x <b>\\E</b> y"
    # a later word also matches inside the tags put in before
    assert one(spark, present.highlight(F.lit("red"), words("red", "b"), "b")) == "<<b>b</b>>red</<b>b</b>>"


def brute_snippet(text, terms):
    parts = re.split("[,;.\n]", text)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    if parts == [""] and text:
        parts = []
    def score(s):
        counts = [len(re.findall("[ ]+" + re.escape(w) + "[ ]+", s, re.I)) for w in terms]
        return (min(counts) if counts else 0) * 20 + sum(counts)
    best = sorted(range(len(parts)), key=lambda i: -score(parts[i]))[:5]
    out = []
    for i in best:
        s = parts[i]
        for w in terms:
            s = re.sub(re.escape(w), lambda m: f"<b>{m.group(0)}</b>", s, flags=re.I)
        out.append(re.sub("[ ]+", " ", re.sub("\r\n|\r|\n", " ", s)))
    return "... " + " ... ".join(out) + " ..."


def test_snippets_match_brute_force(spark):
    texts = [
        "The red river is long. A red  red tree, a river; the red river \nflows. none here. x. y. z river here.",
        "...", "", "no break at all", "a, red b, c red river d.", "a++ b a++ c. a++",
    ]
    for terms in (["red", "river"], ["a++"], []):
        for text in texts:
            got = one(spark, present.snippet(F.lit(text), words(*terms)))
            assert got == brute_snippet(text, terms), (text, terms)


def test_fulltext_snippet_keeps_matching_fragments(spark):
    text = "filler " * 40 + "the Red river " + "filler " * 40 + "redder"
    got = one(spark, present.fulltext_snippet(F.lit(text), words("red", "river")))
    assert got.count(" ... ") == 0 and "<B>Red</B> <B>river</B>" in got and "redder" not in got
    assert one(spark, present.fulltext_snippet(F.lit(text), words("zzz"))) == "...  ..."


def test_requested_page_text(spark):
    got = [one(spark, present.requested_page(F.lit(t))) for t in ("3", "x", None)]
    assert got == [3, 1, 1]


def test_result_json_shape(spark):
    results = spark.createDataFrame(
        [(1, 7, 1, 2.5), (1, 8, 2, 1.5)], "query_id bigint, doc_id bigint, rank_no int, total double"
    )
    docs = spark.createDataFrame(
        [(7, "Red River", "The red river.", ["Rivers of art"]), (8, "Red", "A red one.", ["X"])],
        "doc_id bigint, title string, content string, categories array<string>",
    )
    queries = spark.createDataFrame([(1, "red category:art"), (2, "zzz")], "query_id bigint, query string")
    asked = spark.createDataFrame([], "query_id bigint, page int")
    shown = pg.present_results(pg.fetch_pages(pg.paginate(results, asked), docs), queries)
    out = {r.query_id: json.loads(r.json) for r in pg.result_json(shown, pg.all_hit_counts(results, queries)).collect()}
    assert out[2] == {"hits": 0}
    first = out[1]["pages"][0]
    assert out[1]["hits"] == 2 and out[1]["pageNo"] == out[1]["totalPages"] == 1
    assert first["title"] == "<span>Red</span> River" and first["score"] == "2.50000000"
    assert first["url"].endswith("/wiki/Red_River")
    assert first["categories"] == {
        "html": ["Rivers of <b>art</b>"], "href": ["https://en.wikipedia.org/wiki/Category:Rivers_of_art"]
    }
