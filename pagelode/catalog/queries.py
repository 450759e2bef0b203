"""Every operator as a named query over the standard tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import markup, present, scoring, text as tx, urls
from pagelode.functions.stemming import with_stem
from pagelode.operators import frontier, ids, links, pagerank as pr, postings as ps, robots
from pagelode.plans import pages as pg, query_terms as qt, ranked
from pagelode.session import fresh_path, materialise
from pagelode.sources import codecs, export, index_store, ingest, jsonl, tables
from pagelode.streaming import ingest as si

# The keyword queries put to the documents corpus.
QUERY_LIST = [
    (1, "de la"),
    (2, "der die"),
    (3, "inesea der"),
    (4, "re"),
    (5, "rewh ononst"),
    (6, "anea eriner"),
    (7, "the of"),
    (8, "zzzz"),
    (9, "de de la"),
    (10, "de category:fr"),
    (11, "de category:nosuch"),
    (12, "Que en category:es src3"),
]
HOST_REGEX = r".*example\.(?:com|net|org)"
PATH_REGEX = r"^/([^:]*)$"
AGENT = "pagelode"
RUN_TIME = "2024-01-01 00:00:00"

_cache: dict[tuple, object] = {}


def _once(spark: SparkSession, folder: str, name: str, make: Callable):
    """Build a shared table once per session and folder; it is written, not held in memory."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _cache:
        _cache[key] = make()
    return _cache[key]


def documents_index(spark: SparkSession, folder: str) -> index_store.SearchIndex:
    """The published index of the documents, with the link ranks of the pages by id."""
    return _once(
        spark,
        folder,
        "ranked",
        lambda: index_store.publish_index(
            tables.corpus_documents(spark, folder), fresh_path(spark, "ranked-index"), ranks=page_ranks(spark, folder)
        ),
    )


def fulltext_index(spark: SparkSession, folder: str) -> index_store.SearchIndex:
    corpus = lambda: tables.corpus_documents(spark, folder)
    return _once(
        spark,
        folder,
        "fulltext",
        lambda: index_store.publish_index(corpus(), fresh_path(spark, "fulltext-index"), fulltext=True),
    )


def page_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "ranks", lambda: materialise(pr.pagerank(tables.page_edges(spark, folder)), "page-ranks"))


def query_list(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({query_id}L, '{text}')" for query_id, text in QUERY_LIST)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS q(query_id, query)")


def heading_queries(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of queries that grows with the data: every distinct page heading, whole."""
    headings = tables.scan_pages(spark, folder).select(
        "page_id", markup.element_text(F.col("html"), "h1").alias("query")
    )
    return headings.groupBy("query").agg(F.min("page_id").alias("query_id")).select("query_id", "query")


def marked_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Query texts with and without a category: every conversation turn, whole, with its role
    as category where the turn number is above zero."""
    turns = tables.table(spark, folder, "conversations")
    query_id = F.col("conv_id") * 1000 + F.col("turn")
    marked = F.concat(F.col("text"), F.lit(" category: "), F.initcap("role"), F.lit(" "))
    return turns.select(
        query_id.alias("query_id"), F.when(F.col("turn") > 0, marked).otherwise(F.col("text")).alias("query")
    )


def _long(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("bigint").alias(alias or name)


def _r(name, alias: str | None = None, digits: int = 6) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return F.round(col, digits).alias(alias or name)


def _text(name: str, sep: str = ",") -> Column:
    return F.array_join(F.col(name).cast("array<string>"), sep)


_registry: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    _registry[fn.__name__] = fn
    return fn


# --- sources and sinks -------------------------------------------------------------------------


@query
def scan_pages(spark, folder):
    return tables.scan_pages(spark, folder).select("page_id", "url", F.length("html").cast("bigint").alias("html_len"))


@query
def read_jsonl_quarantine(spark, folder):
    """Lines made from every event; the event type decides what is wrong with the line."""
    e = tables.table(spark, folder, "events")
    id_, kind = F.col("event_id").cast("string"), F.col("event_type")
    head = F.concat(F.lit('{"id": '), id_, F.lit(', "title": "user '), F.col("user_id").cast("string"), F.lit('"'))
    line = (
        F.when(kind == "error", F.concat(head, F.lit(', "content": "x", "categories": ["error"')))
        .when(kind == "view", F.lit(""))
        .when(kind == "click", F.concat(head, F.lit(', "content": "x"}')))
        .otherwise(F.concat(head, F.lit(', "content": "x", "categories": ["'), kind, F.lit('", "all"]}')))
    )
    out = jsonl.parse_lines(e.select(F.col("event_id").alias("line_no"), line.alias("line")))
    ok = F.col("status") == "ok"
    return out.select(
        "line_no",
        "status",
        F.when(ok, F.col("record.id").cast("bigint")).alias("id"),
        F.when(ok, F.col("record.title")).alias("title"),
        F.when(ok, F.size("record.categories").cast("bigint")).alias("n_categories"),
    )


def _postings(spark, folder, stem=True):
    return ps.build_postings(tables.corpus_documents(spark, folder), stem)


@query
def posting_text_roundtrip(spark, folder):
    lists = ps.posting_lists(tables.corpus_documents(spark, folder))
    lines = codecs.encode_postings(lists)
    back = codecs.decode_postings(lines)
    return back.select(
        "term",
        "doc_id",
        *[F.col("freq")[i].cast("bigint").alias(f"f{i}") for i in range(3)],
        F.array_join(F.transform("fields", lambda f: F.array_join(f.cast("array<string>"), ",")), "|").alias("positions_text"),
    )


@query
def rank_text_roundtrip(spark, folder):
    edges = tables.page_edges(spark, folder)
    rows = pr.initial_ranks(edges).join(
        links.adjacency(edges.withColumn("pos", F.col("dst"))), "id", "left"
    )
    back = codecs.decode_ranks(codecs.encode_ranks(rows))
    return back.select("id", _r("rank", digits=9), _text("links").alias("links_text"))


@query
def list_codec(spark, folder):
    """Category lists of every page, with an empty item put last or first for some lengths."""
    items = tables.corpus_pages(spark, folder).select("doc_id", "content", "categories")
    n = F.length("content") % 3
    raw = (
        F.when(n == 0, F.concat(F.col("categories"), F.array(F.lit(""), F.lit(""))))
        .when(n == 1, F.concat(F.array(F.lit("")), F.col("categories")))
        .otherwise(F.array(F.lit("")))
    )
    text = items.select("doc_id", codecs.encode_list(raw).alias("text"))
    return text.withColumn("items", codecs.decode_list(F.col("text"))).select(
        "doc_id", "text", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", "~").alias("items_text")
    )


@query
def ingest_insert_or_ignore(spark, folder):
    titled = si.titled(tables.scan_pages(spark, folder))
    path = fresh_path(spark, "pages-table")
    ingest.insert_or_ignore(titled, path, 0)
    ingest.insert_or_ignore(titled, path, 1)  # everything is there: inserts nothing
    return ingest.read_table(spark, path, titled.schema).select("title", "page_id")


@query
def stream_ingest_pages(spark, folder):
    """Page files to whole page rows to the page table, as a stream."""
    path, state = fresh_path(spark, "stream-table"), fresh_path(spark, "stream-state")
    stream = si.read_table_stream(spark, folder, "pages")
    rows = markup.page_rows(stream, F.to_timestamp(F.lit(RUN_TIME)), HOST_REGEX, PATH_REGEX)
    si.ingest_pages(rows, path, state)
    return ingest.read_table(spark, path, rows.schema).select(
        "title",
        "page_id",
        "content",
        F.array_join("categories", "|").alias("categories"),
        F.date_format("last_modified", "yyyy-MM-dd HH:mm").alias("last_modified_text"),
        F.array_join("out_links", "|").alias("links"),
    )


def linked_pages(spark, folder) -> DataFrame:
    """Pages with unique titles, their categories as out-link titles."""
    pages = tables.corpus_pages(spark, folder)
    return ids.first_per_key(pages, "title", "doc_id").select(
        "title", "content", "categories", F.col("categories").alias("out_links")
    )


def lower_linked_pages(spark, folder) -> DataFrame:
    """As :func:`linked_pages` with titles reduced to their first word in lower case, so that
    navigation words resolve; the first page of each word is kept."""
    pages = tables.corpus_pages(spark, folder)
    word = F.lower(F.element_at(F.split("title", " "), 1))
    named = pages.select("doc_id", word.alias("title"), "content", "categories")
    return ids.first_per_key(named, "title", "doc_id").select(
        "title", "content", "categories", F.transform("categories", F.lower).alias("out_links")
    )


@query
def export_three_way(spark, folder):
    """The three sets written once, read back from their files and compared in full."""
    path = fresh_path(spark, "export")
    export.export_three_way(lower_linked_pages(spark, folder), path)
    part = lambda name, payload: export.read_set(spark, path, name).select(F.lit(name).alias("kind"), "id", payload.alias("payload_text"))
    return (
        part("data", F.concat_ws("~", "title", "content", F.array_join("categories", "|")))
        .unionByName(part("index", F.col("title")))
        .unionByName(part("link", _text("links")))
    )


@query
def publish_index_tables(spark, folder):
    index = documents_index(spark, folder)
    sizes = [
        ("postings", index.postings),
        ("term_stats", index.term_stats),
        ("stats", index.stats),
        ("docs", index.docs),
        ("content", index.content),
        ("ranks", index.ranks),
        ("meta", index.meta),
    ]
    out = None
    for name, df in sizes:
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


# --- page extraction ---------------------------------------------------------------------------


@query
def page_title(spark, folder):
    return tables.scan_pages(spark, folder).select("page_id", markup.element_text(F.col("html"), "h1").alias("title"))


@query
def page_content(spark, folder):
    return tables.scan_pages(spark, folder).select(
        "page_id", markup.element_body(F.col("html"), "article").alias("content")
    )


@query
def page_categories(spark, folder):
    return tables.scan_pages(spark, folder).select(
        "page_id", F.array_join(markup.list_items(F.col("html"), "nav"), "|").alias("categories")
    )


@query
def page_extract(spark, folder):
    """The parser route: all fields from one parse of each page."""
    out = markup.drop_empty(markup.extract_pages(tables.scan_pages(spark, folder)).filter("found"))
    return out.select(
        "page_id",
        "title",
        "content",
        F.array_join("categories", "|").alias("categories"),
        F.array_join("hrefs", "|").alias("hrefs"),
    )


@query
def page_last_modified(spark, folder):
    """Footers made from every event; some name no date, some an impossible month."""
    e = tables.table(spark, folder, "events")
    when = F.concat(
        F.date_format("ts", "d"), F.lit(" "),
        F.when(F.col("event_type") == "error", "Brumaire").otherwise(F.date_format("ts", "MMMM")),
        F.lit(" "), F.date_format("ts", "yyyy"), F.lit(", at "), F.date_format("ts", "HH:mm"),
    )
    footer = F.when(F.col("event_type") == "view", "No date here.").otherwise(
        F.concat(F.lit("This page was last edited on "), when, F.lit("."))
    )
    stamp = markup.last_modified(footer, F.to_timestamp(F.lit(RUN_TIME)))
    return e.select(F.col("event_id").alias("id"), F.date_format(stamp, "yyyy-MM-dd HH:mm").alias("last_modified_text"))


@query
def page_outlinks(spark, folder):
    pages = tables.scan_pages(spark, folder)
    absolute = F.transform(markup.hrefs(F.col("html"), "nav"), lambda h: urls.resolve_href(F.col("url"), h))
    return pages.select(
        "page_id", F.array_join(urls.link_titles(absolute, HOST_REGEX, PATH_REGEX), "|").alias("links")
    )


@query
def url_canonicalize(spark, folder):
    return tables.scan_pages(spark, folder).select("page_id", urls.canonical_url(F.col("url")).alias("url"))


@query
def url_scope_filter(spark, folder):
    pages = tables.scan_pages(spark, folder).select("page_id", "url")
    return pages.filter(urls.in_scope(F.col("url"), r"(?:www|blog)\..*", r"/(?:en|fr)/[0-9]+"))


@query
def drop_empty_pages(spark, folder):
    pages = tables.corpus_pages(spark, folder).filter("title <> ''")
    kept = markup.drop_empty(pages)
    return kept.select(F.col("doc_id").alias("page_id"), F.size("categories").cast("bigint").alias("n_categories"))


def robots_lines(spark, folder) -> DataFrame:
    """A robots.txt per host, made from the first and last path of the host's pages."""
    pages = tables.scan_pages(spark, folder).select(
        urls.url_part(F.col("url"), "HOST").alias("host"), urls.url_part(F.col("url"), "PATH").alias("path")
    )
    spans = pages.groupBy("host").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    low, high = F.col("low"), F.col("high")
    folder_of = lambda p: F.regexp_extract(p, "^/[^/]*/", 0)
    lines = F.array(
        F.lit("User-agent: *"),
        F.lit("User-agent: other"),
        F.concat(F.lit("Disallow: "), high),
        F.lit("# a comment"),
        F.lit("user-agent: PAGELODE"),
        F.concat(F.lit("Disallow: "), low),
        F.lit("User-agent: page?ode*"),
        F.concat(F.lit("Allow: "), low),
        F.concat(F.lit("  Disallow: "), folder_of(low), F.lit(" # whole folder")),
        F.concat(F.lit("Disallow: "), F.replace(high, F.lit("/"), F.lit("%2F"))),
        F.concat(F.lit("Allow: "), high),
        F.lit("Disallow:"),
    )
    return spans.select("host", F.posexplode(lines).alias("line_no", "line"))


@query
def robots_rules(spark, folder):
    return robots.robots_rules(robots_lines(spark, folder), AGENT).select("host", _long("ord"), "path", "allow")


@query
def robots_filter(spark, folder):
    rules = robots.robots_rules(robots_lines(spark, folder), AGENT)
    return robots.robots_filter(tables.scan_pages(spark, folder).select("page_id", "url"), rules)


def _seed(edges: DataFrame) -> DataFrame:
    return edges.agg(F.min("src").alias("url"))


@query
def frontier_step(spark, folder):
    edges = tables.page_edges(spark, folder)
    level = _seed(edges).withColumn("depth", F.lit(0))
    return frontier.frontier_step(level, edges, level).select(F.col("url").alias("page_id"), _long("depth"))


@query
def frontier_bfs(spark, folder):
    edges = materialise(tables.page_edges(spark, folder), "edges")
    return frontier.frontier_bfs(_seed(edges), edges, 10).select(F.col("url").alias("page_id"), _long("depth"))


@query
def stream_visited_dedup(spark, folder):
    path, state = fresh_path(spark, "visited"), fresh_path(spark, "visited-state")
    stream = si.read_table_stream(spark, folder, "pages").select("url")
    si.write_once(si.visited_urls(stream), path, state)
    return spark.read.schema("url string").parquet(path)


# --- ids and links -----------------------------------------------------------------------------


@query
def assign_doc_ids(spark, folder):
    return ids.assign_doc_ids(linked_pages(spark, folder).select("title")).select(_long("id"), "title")


@query
def title_dictionary(spark, folder):
    numbered = ids.assign_doc_ids(lower_linked_pages(spark, folder).select("title"))
    return ids.title_dictionary(numbered).select("title", _long("id"))


@query
def resolve_links(spark, folder):
    numbered = ids.assign_doc_ids(lower_linked_pages(spark, folder).select("title", "out_links"))
    edges = links.resolve_links(numbered, ids.title_dictionary(numbered))
    return links.adjacency(edges).select(_long("id"), _text("links").alias("links_text"))


@query
def out_degree(spark, folder):
    return links.out_degree(tables.page_edges(spark, folder)).select(F.col("src").alias("id"), "n")


@query
def in_links(spark, folder):
    return links.in_links(tables.page_edges(spark, folder))


@query
def dangling_nodes(spark, folder):
    return links.dangling_nodes(tables.page_edges(spark, folder))


# --- text --------------------------------------------------------------------------------------


def _raw(spark, folder):
    return ps.field_tokens(tables.corpus_documents(spark, folder))


@query
def tokenize_positions(spark, folder):
    return _raw(spark, folder).select("doc_id", _long("field"), _long("pos"), F.col("raw").alias("token"))


@query
def normalize_token(spark, folder):
    token = tx.normalize_token(F.col("raw"))
    return _raw(spark, folder).select("doc_id", _long("field"), _long("pos"), token.alias("token"))


@query
def alnum_filter(spark, folder):
    return normalize_token(spark, folder).filter(tx.is_alnum(F.col("token")))


@query
def stopword_filter(spark, folder):
    return alnum_filter(spark, folder).filter(~tx.is_stop_word(F.col("token")))


@query
def stem_english(spark, folder):
    vocabulary = stopword_filter(spark, folder).select("token").distinct()
    return with_stem(vocabulary, "token", "stem")


@query
def field_lengths(spark, folder):
    return ps.field_lengths(tables.corpus_documents(spark, folder)).select("doc_id", _long("field"), _long("len"))


@query
def join_categories(spark, folder):
    return tables.corpus_pages(spark, folder).select("doc_id", tx.category_text(F.col("categories")).alias("text"))


@query
def parse_query(spark, folder):
    return qt.parse_queries(marked_queries(spark, folder))


@query
def split_query_terms(spark, folder):
    words = qt.query_words(qt.parse_queries(marked_queries(spark, folder)))
    return words.select("query_id", _long("part"), _long("pos"), "term")


@query
def query_term_freq(spark, folder):
    words = qt.query_words(qt.parse_queries(marked_queries(spark, folder)))
    return qt.query_term_freq(words).select("query_id", _long("part"), "term", "qf")


@query
def analyze_standard(spark, folder):
    out = ps.fulltext_tokens(tables.corpus_documents(spark, folder))
    return out.select("doc_id", _long("field"), _long("pos"), F.col("term").alias("token"))


# --- index -------------------------------------------------------------------------------------


def _posting_rows(postings: DataFrame) -> DataFrame:
    return postings.select("term", _long("field"), "doc_id", _long("tf"), _text("positions").alias("positions_text"))


@query
def build_postings(spark, folder):
    return _posting_rows(_postings(spark, folder))


@query
def build_postings_unstemmed(spark, folder):
    return _posting_rows(_postings(spark, folder, stem=False))


@query
def posting_lists(spark, folder):
    lists = ps.posting_lists(tables.corpus_documents(spark, folder))
    entry = lambda e: F.concat_ws(":", e["doc_id"].cast("string"), F.array_join(e["freq"].cast("array<string>"), ","))
    return lists.select("term", _long("block"), F.array_join(F.transform("entries", entry), ";").alias("line"))


@query
def wide_postings(spark, folder):
    wide = ps.wide_postings(tables.corpus_documents(spark, folder))
    return wide.select(
        "term", "doc_id", *[F.col("freq")[i].cast("bigint").alias(f"f{i}") for i in range(3)],
        _text("positions").alias("positions_text"),
    )


@query
def doc_frequency(spark, folder):
    return ps.doc_frequency(_postings(spark, folder)).select("term", _long("field"), "df")


@query
def avg_field_length(spark, folder):
    return ps.corpus_stats(tables.corpus_documents(spark, folder)).select(_long("field"), _r("avg_len"))


@query
def doc_count(spark, folder):
    return tables.corpus_documents(spark, folder).agg(F.count(F.lit(1)).alias("n"))


@query
def index_summary(spark, folder):
    return index_store.index_summary(documents_index(spark, folder))


# --- link analysis -----------------------------------------------------------------------------


@query
def pagerank_init(spark, folder):
    return pr.initial_ranks(tables.page_edges(spark, folder)).select("id", _r("rank", digits=9))


@query
def pagerank_contrib(spark, folder):
    edges = tables.page_edges(spark, folder)
    return pr.contributions(pr.initial_ranks(edges), edges).select("src", "dst", _r("contrib", digits=9))


@query
def pagerank_step(spark, folder):
    return pr.pagerank_steps(tables.page_edges(spark, folder), 1).select("id", _r("rank", digits=9))


@query
def pagerank_k10(spark, folder):
    return pr.pagerank_steps(tables.page_edges(spark, folder), 10).select("id", _r("rank", digits=9))


@query
def pagerank_converged(spark, folder):
    return pr.pagerank(tables.page_edges(spark, folder)).select("id", _r("rank", digits=9))


@query
def max_rank(spark, folder):
    return documents_index(spark, folder).meta.select(_r("max_rank", digits=9))


@query
def rank_lookup_default(spark, folder):
    index = documents_index(spark, folder)
    out = ranked.rank_or_default(index.docs.select("doc_id"), index.ranks, index.stats)
    return out.select("doc_id", _r("rank", digits=9))


# --- ranked retrieval --------------------------------------------------------------------------


def _matches(spark, folder, fulltext=False):
    index = fulltext_index(spark, folder) if fulltext else documents_index(spark, folder)
    analysed = ranked.AnalysedQueries(index, query_list(spark), fulltext)
    matches = ranked.match_terms(analysed.index, analysed.terms)
    return analysed, ranked.term_scores(matches, fulltext)


def _fields(spark, folder):
    """Matched fields with the term list that applies to the field."""
    analysed, scored = _matches(spark, folder)
    rows = ranked.gather_fields(scored).join(analysed.lists, "query_id")
    terms = F.when(F.col("field") == 2, F.col("category_terms")).otherwise(F.col("keyword_terms"))
    return rows.withColumn("terms", terms)


_FIELD_KEY = ["query_id", "field", "doc_id"]


def _field_key():
    return ["query_id", _long("field"), "doc_id"]


@query
def fetch_postings(spark, folder):
    _, scored = _matches(spark, folder)
    return scored.select("query_id", "term", _long("field"), "doc_id", _long("tf"))


@query
def bm25_log_score(spark, folder):
    _, scored = _matches(spark, folder)
    return scored.select(*_field_key(), "term", _r("score", "value"))


@query
def score_terms(spark, folder):
    rows = _fields(spark, folder)
    return rows.select(
        *_field_key(),
        _r(scoring.total(F.transform("entries", lambda e: e["score"])), "value"),
        F.size("entries").cast("bigint").alias("n_terms"),
    )


@query
def all_terms_match(spark, folder):
    rows = _fields(spark, folder)
    return rows.select(*_field_key(), (F.size("entries") == F.size(F.array_distinct("terms"))).alias("value"))


@query
def bigram_adjacency(spark, folder):
    rows = _fields(spark, folder)
    pairs = scoring.pair_matches(scoring.positions_of(F.col("entries")), F.col("terms"))
    return rows.select(*_field_key(), F.size(F.filter(pairs, lambda ok: ok)).cast("bigint").alias("value"))


@query
def proximity_boost(spark, folder):
    rows = _fields(spark, folder)
    value = F.lit(None).cast("double")
    for field in (0, 1, 2):
        one = ranked.field_value(field, F.col("terms"), F.col("entries"), F.col("field_len"))
        value = F.when(F.col("field") == field, one).otherwise(value)
    return rows.withColumn("value", value).select(*_field_key(), _r("value"))


def _keyword_sides(spark, folder):
    rows = _fields(spark, folder)
    side = lambda f: rows.filter(F.col("field") == f).select(
        "query_id", "doc_id",
        ranked.field_value(f, F.col("terms"), F.col("entries"), F.col("field_len")).alias(f"s{f}"),
    )
    return side(0), side(1)


@query
def combine_fields_inner(spark, folder):
    title, content = _keyword_sides(spark, folder)
    return title.join(content, ["query_id", "doc_id"]).select("query_id", "doc_id", _r(F.col("s0") + F.col("s1"), "score"))


@query
def combine_fields_outer(spark, folder):
    title, content = _keyword_sides(spark, folder)
    both = title.join(content, ["query_id", "doc_id"], "full")
    total = F.coalesce("s0", F.lit(0.0)) + F.coalesce("s1", F.lit(0.0))
    return both.select("query_id", "doc_id", _r(total, "score"))


def _hits(spark, folder):
    return ranked.search_hits(documents_index(spark, folder), query_list(spark))


@query
def category_constraint(spark, folder):
    return _hits(spark, folder).select("query_id", "doc_id", _r("category_score"), _r("text_score", "score"))


@query
def hit_count(spark, folder):
    return pg.all_hit_counts(_hits(spark, folder), query_list(spark))


@query
def minmax_normalize(spark, folder):
    return ranked.normalised(_hits(spark, folder)).select("query_id", "doc_id", _r("text_norm", "score"))


@query
def blend_rank(spark, folder):
    out = ranked.blend_ranks(_hits(spark, folder), documents_index(spark, folder))
    return out.select("query_id", "doc_id", _r("text_norm"), _r("rank_norm"), _r("total"))


def _results(spark, folder, with_rank=False):
    return ranked.search(documents_index(spark, folder), query_list(spark), with_rank)


def _result_rows(results: DataFrame) -> DataFrame:
    return results.select("query_id", _long("rank_no", "rank"), "doc_id", _r("total"))


@query
def topk_results(spark, folder):
    hits = _hits(spark, folder).withColumn("total", F.col("text_score"))
    return _result_rows(ranked.top_results(hits))


@query
def search_text(spark, folder):
    return _result_rows(_results(spark, folder))


@query
def search_text_rank(spark, folder):
    return _result_rows(_results(spark, folder, with_rank=True))


@query
def search_batch(spark, folder):
    return _result_rows(ranked.search(documents_index(spark, folder), heading_queries(spark, folder)))


@query
def score_text(spark, folder):
    rows = _results(spark, folder, with_rank=True)
    text = scoring.score_text(F.col("total"), F.col("text_norm"), F.col("rank_norm"))
    return rows.select("query_id", _long("rank_no", "rank"), "doc_id", text.alias("text"))


@query
def fetch_result_pages(spark, folder):
    rows = pg.fetch_pages(_results(spark, folder), documents_index(spark, folder).docs)
    return rows.select(
        "query_id", _long("rank_no", "rank"), "doc_id", "title", F.array_join("categories", "|").alias("text")
    )


def _requests(spark) -> DataFrame:
    """Page asked for per query: one below the range, one above, one inside, others none."""
    asked = {1: 2, 2: 0, 3: 999}
    return query_list(spark).select(
        "query_id", F.try_element_at(F.create_map(*[F.lit(x) for kv in asked.items() for x in kv]), F.col("query_id").cast("int")).alias("page")
    )


def _shown(spark, folder, fulltext=False):
    index = fulltext_index(spark, folder) if fulltext else documents_index(spark, folder)
    search = ranked.search_fulltext if fulltext else ranked.search
    page = pg.paginate(search(index, query_list(spark)), _requests(spark))
    return pg.present_results(pg.fetch_pages(page, index.docs, index.content), query_list(spark), fulltext)


@query
def highlight(spark, folder):
    return _shown(spark, folder).select("query_id", _long("rank_no", "rank"), "doc_id", F.col("title").alias("text"))


@query
def snippet_sentences(spark, folder):
    return _shown(spark, folder).select("query_id", _long("rank_no", "rank"), "doc_id", F.col("snippet").alias("text"))


@query
def result_links(spark, folder):
    text = F.concat_ws(" ", "url", F.array_join("category_href", " "))
    return _shown(spark, folder).select("query_id", _long("rank_no", "rank"), "doc_id", text.alias("text"))


@query
def paginate(spark, folder):
    page = pg.paginate(_results(spark, folder), _requests(spark))
    return page.select("query_id", _long("page_no"), _long("total_pages"), _long("rank_no", "rank"), "doc_id")


@query
def result_json(spark, folder):
    """The response of each query, read back: every shown row, in the parts whose text is the same in both JSON writers."""
    out = pg.respond(documents_index(spark, folder), query_list(spark), _requests(spark))
    read = F.from_json("json", "hits bigint, pageNo bigint, totalPages bigint, pages array<struct<title:string,url:string,snippet:string,score:string>>")
    return out.select("query_id", read.alias("r")).select(
        "query_id",
        F.col("r.hits").alias("hits"),
        F.col("r.pageNo").alias("page_no"),
        F.col("r.totalPages").alias("total_pages"),
        *[F.array_join(F.col(f"r.pages.{name}"), "~").alias(f"{name}s") for name in ("title", "url", "snippet", "score")],
    )


# --- full-text retrieval -----------------------------------------------------------------------


def _clauses(spark, folder):
    """Matched fields of the full-text method with their clause values."""
    analysed, scored = _matches(spark, folder, fulltext=True)
    rows = ranked.gather_fields(scored).join(analysed.lists, "query_id")
    terms = F.when(F.col("field") == 2, F.col("category_terms")).otherwise(F.col("keyword_terms"))
    rows = rows.withColumn("terms", terms)
    total = lambda name: scoring.total(F.transform("entries", lambda e: e[name]))
    starts = scoring.phrase_starts(scoring.positions_of(F.col("entries")), F.col("terms"))
    has_all = F.size("entries") == F.size(F.array_distinct("terms"))
    rows = rows.select(
        *_FIELD_KEY, "field_len", "avg_len", "terms", "entries",
        total("score").alias("any_term"), total("weight").alias("idf"), has_all.alias("has_all"),
        F.when(has_all, F.size(starts)).otherwise(0).alias("freq"),
    )
    norm = scoring.length_norm(F.col("field_len"), F.col("avg_len"))
    return rows.withColumn("phrase", F.col("idf") * scoring.fulltext_tf(F.col("freq"), norm))


@query
def ft_index(spark, folder):
    return _posting_rows(ps.build_postings(tables.corpus_documents(spark, folder), fulltext=True))


@query
def ft_term_query(spark, folder):
    _, scored = _matches(spark, folder, fulltext=True)
    return scored.select(*_field_key(), "term", _r("score"))


@query
def ft_phrase_query(spark, folder):
    return _clauses(spark, folder).filter("freq > 0").select(*_field_key(), _r("phrase", "score"))


@query
def ft_all_terms(spark, folder):
    return _clauses(spark, folder).filter("has_all").select(*_field_key(), _r("any_term", "score"))


@query
def ft_any_term(spark, folder):
    return _clauses(spark, folder).select(*_field_key(), _r("any_term", "score"))


@query
def ft_must_not(spark, folder):
    return _clauses(spark, folder).filter("freq = 0").select(*_field_key(), _r("any_term", "score"))


@query
def ft_field_query(spark, folder):
    rows = _clauses(spark, folder)
    value = F.lit(None).cast("double")
    for field in (0, 1, 2):
        one = ranked.fulltext_field_value(
            field, F.col("terms"), F.col("entries"), F.col("field_len"), F.col("avg_len")
        )
        value = F.when(F.col("field") == field, one).otherwise(value)
    return rows.withColumn("score", value).select(*_field_key(), _r("score"))


@query
def ft_cross_field_must(spark, folder):
    hits = ranked.search_hits(fulltext_index(spark, folder), query_list(spark), fulltext=True)
    return hits.select("query_id", "doc_id", _r("text_score", "score"))


@query
def ft_topk(spark, folder):
    return _result_rows(ranked.search_fulltext(fulltext_index(spark, folder), query_list(spark)))


@query
def ft_snippet(spark, folder):
    return _shown(spark, folder, fulltext=True).select(
        "query_id", _long("rank_no", "rank"), "doc_id", F.col("snippet").alias("text")
    )


@query
def search_fulltext(spark, folder):
    return _result_rows(ranked.search_fulltext(fulltext_index(spark, folder), query_list(spark)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_registry)
