"""DuckDB SQL that each catalog query is checked against.

The SQL is written from the semantics, not generated from the Spark plans. Common table
expressions are kept in a dictionary and pulled in by name.
"""

from __future__ import annotations

import re

from pagelode.catalog.queries import AGENT, QUERY_LIST, RUN_TIME
from pagelode.catalog.stem_sql import duckdb_stem
from pagelode.functions.text import FULLTEXT_STOP_WORDS, STOP_WORDS

_strings = lambda words: ", ".join("'" + w + "'" for w in words)
STOPS = _strings(STOP_WORDS)
FT_STOPS = _strings(FULLTEXT_STOP_WORDS)
QUERY_VALUES = ", ".join(f"({i}::BIGINT, '{q}')" for i, q in QUERY_LIST)
WS = r"[ \t\n\r\f]+"
CTRL = r"^[\x00-\x20]+|[\x00-\x20]+$"
# Word breaks for the alphabets the tables hold (no Han, Kana or Thai, whose words need other rules). Quotes are doubled for SQL.
_FT_LETTERS = r"[\p{L}\p{Nl}][\p{L}\p{Nl}\p{M}]*"
_FT_LETTERS += rf"(?:[:·''.‘’․]{_FT_LETTERS})*"
_FT_NUMBERS = r"\p{Nd}[\p{Nd}\p{M}]*"
_FT_NUMBERS += rf"(?:[,;⁄''.‘’․]{_FT_NUMBERS})*"
FT_WORD = rf"_*(?:{_FT_LETTERS}|{_FT_NUMBERS})+(?:_+(?:{_FT_LETTERS}|{_FT_NUMBERS})+)*_*"
URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)(\?[^#]*)?"
TAG = "<[^>]*>"


def _unescape(x: str) -> str:
    for pattern, char in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "''"), ("&nbsp;?", " "), ("&amp;?", "&")):
        x = f"regexp_replace({x}, '{pattern}', '{char}', 'g')"
    return x


def _url(x: str, part: str) -> str:
    if part == "FILE":
        return f"(regexp_extract({x}, '{URL}', 3) || regexp_extract({x}, '{URL}', 4))"
    return f"regexp_extract({x}, '{URL}', {dict(PROTOCOL=1, HOST=2, PATH=3)[part]})"


def _nums(x: str) -> str:
    return f"array_to_string({x}, ',')"


def _ranks(steps: int) -> dict[str, str]:
    out = {
        "deg": "SELECT src, count(*) AS n FROM edges GROUP BY src",
        "nsrc": "SELECT count(*) AS n FROM deg",
        "nodes": "SELECT src AS id FROM edges UNION SELECT dst FROM edges",
        "rank0": "SELECT id, CASE WHEN id IN (SELECT src FROM deg) THEN 1.0::DOUBLE / (SELECT n FROM nsrc) ELSE 0 END AS rank FROM nodes",
    }
    for i in range(1, steps + 1):
        out[f"rank{i}"] = (
            f"SELECT nodes.id, (1 - 0.85::DOUBLE) / (SELECT n FROM nsrc) + 0.85::DOUBLE * coalesce(c.s, 0) AS rank FROM nodes LEFT JOIN "
            f"(SELECT e.dst, sum(r.rank / d.n) AS s FROM edges e JOIN rank{i - 1} r ON r.id = e.src JOIN deg d ON d.src = e.src GROUP BY e.dst) c "
            f"ON c.dst = nodes.id"
        )
    # The first round in which no rank moves by 1e-6 or more; 0.85 ** k is below that before 90 rounds.
    out["moves"] = " UNION ALL ".join(
        f"SELECT {i} AS round_no, max(abs(a.rank - b.rank)) AS move FROM rank{i} a JOIN rank{i - 1} b ON b.id = a.id" for i in range(1, steps + 1)
    )
    out["still"] = "SELECT min(round_no) AS round_no FROM moves WHERE move < 1e-6 OR move IS NULL"
    out["rankconv"] = " UNION ALL ".join(f"SELECT id, rank FROM rank{i}, still WHERE round_no = {i}" for i in range(1, steps + 1))
    return out


NAV = "regexp_extract(html, '(?s)<nav(?:\\s[^>]*)?>(.*?)</nav>', 1)"
H1 = f"trim({_unescape(f'''regexp_replace(regexp_extract(html, '(?s)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1), '{TAG}', '', 'g')''')})"
BODY = f"trim({_unescape(f'''regexp_replace(regexp_extract(html, '(?s)<article(?:\\s[^>]*)?>(.*)</article>', 1), '{TAG}', ' ', 'g')''')})"
ITEMS = (
    f"list_transform(regexp_extract_all({NAV}, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1), "
    f"lambda i: trim({_unescape(f'''regexp_replace(i, '{TAG}', '', 'g')''')}))"
)
HREFS = f"""list_transform(regexp_extract_all({NAV}, '<a\\s[^>]*?href="([^"]*)"', 1), lambda h: {_unescape('h')})"""

CTES: dict[str, str] = {
    # documents corpus and ranked index
    "corpus": f"SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '{WS}'), lambda x: x <> '')[1:8], ' ') AS title, "
    "text AS content, [lang, source] AS categories FROM documents",
    "fields": "SELECT doc_id, 0 AS field, lower(title) AS text FROM corpus UNION ALL SELECT doc_id, 1, lower(content) FROM corpus "
    "UNION ALL SELECT doc_id, 2, lower(array_to_string(categories, ' ')) FROM corpus",
    "split": f"SELECT doc_id, field, list_filter(string_split_regex(text, '{WS}'), lambda x: x <> '') AS toks FROM fields",
    "raw": "SELECT doc_id, field, len(toks) AS field_len, unnest(toks) AS raw, generate_subscripts(toks, 1) - 1 AS pos FROM split",
    "norm": r"SELECT doc_id, field, field_len, pos, lower(regexp_replace(regexp_replace(raw, '^[[:punct:]]*|[[:punct:]]*$', '', 'g'), "
    + f"'{CTRL}', '', 'g')) AS token FROM raw",
    "alnum": "SELECT * FROM norm WHERE regexp_full_match(token, '[A-Za-z0-9]+')",
    "kept": f"SELECT * FROM alnum WHERE token NOT IN ({STOPS})",
    "stems": f"SELECT * FROM {duckdb_stem('kept')} s",
    "toks": "SELECT k.doc_id, k.field, k.field_len, k.pos, s.stem AS term FROM kept k JOIN stems s ON s.token = k.token",
    "post": "SELECT term, field, doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions, any_value(field_len) AS field_len "
    "FROM toks GROUP BY term, field, doc_id",
    "rawpost": "SELECT token AS term, field, doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions FROM kept GROUP BY ALL",
    "df": "SELECT term, field, count(*) AS df FROM post GROUP BY term, field",
    "stats": "SELECT field, avg(len(toks)) AS avg_len, count(*) AS n_docs FROM split GROUP BY field",
    "wide": "SELECT term, doc_id, sum(CASE WHEN field = 0 THEN tf ELSE 0 END)::BIGINT AS f0, sum(CASE WHEN field = 1 THEN tf ELSE 0 END)::BIGINT AS f1, "
    "sum(CASE WHEN field = 2 THEN tf ELSE 0 END)::BIGINT AS f2, flatten(list(positions ORDER BY field)) AS positions, "
    "list(positions) FILTER (field = 0) AS p0, list(positions) FILTER (field = 1) AS p1, list(positions) FILTER (field = 2) AS p2 FROM post GROUP BY term, doc_id",
    # full-text index
    "ftfields": "SELECT doc_id, 0 AS field, lower(title) AS text FROM corpus UNION ALL SELECT doc_id, 1, lower(content) FROM corpus "
    "UNION ALL SELECT doc_id, 2, lower(array_to_string(categories, '|')) FROM corpus",
    "ftsplit": f"SELECT doc_id, field, regexp_extract_all(text, '{FT_WORD}') AS toks FROM ftfields",
    "ftall": "SELECT doc_id, field, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM ftsplit",
    "fttoks": f"SELECT * FROM ftall WHERE term NOT IN ({FT_STOPS})",
    "ftlen": "SELECT doc_id, field, count(*) AS field_len FROM fttoks GROUP BY doc_id, field",
    "ftpost": "SELECT term, t.field, t.doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions, any_value(l.field_len) AS field_len "
    "FROM fttoks t JOIN ftlen l ON l.doc_id = t.doc_id AND l.field = t.field GROUP BY term, t.field, t.doc_id",
    "ftdf": "SELECT term, field, count(*) AS df FROM ftpost GROUP BY term, field",
    "ftstats": "SELECT field, count(*) AS n_docs, sum(field_len) / count(*) AS avg_len FROM ftlen GROUP BY field",
    # queries
    "qtext": f"SELECT * FROM (VALUES {QUERY_VALUES}) v(query_id, query)",
    "qparse": f"SELECT query_id, lower(CASE WHEN strpos(query, 'category:') > 0 THEN regexp_replace(left(query, strpos(query, 'category:') - 1), '{CTRL}', '', 'g') ELSE query END) AS keyword, "
    f"lower(CASE WHEN strpos(query, 'category:') > 0 THEN regexp_replace(substr(query, strpos(query, 'category:') + 9), '{CTRL}', '', 'g') ELSE '' END) AS category FROM qtext",
    "qparts": "SELECT query_id, 0 AS part, keyword AS text FROM qparse UNION ALL SELECT query_id, 1, category FROM qparse",
    "qsplit": f"SELECT query_id, part, list_filter(list_transform(string_split(text, ' '), lambda w: regexp_replace(w, '{CTRL}', '', 'g')), lambda w: w <> '') AS ws FROM qparts",
    "qraw": "SELECT query_id, part, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM qsplit",
    "qkept": f"SELECT * FROM qraw WHERE word NOT IN ({STOPS})",
    "qstems": f"SELECT * FROM {duckdb_stem('qkept', 'word')} s",
    "qterms": "SELECT k.query_id, k.part, k.pos, s.stem AS term FROM qkept k JOIN qstems s ON s.token = k.word",
    "qfreq": "SELECT query_id, part, term, count(*) AS qf FROM qterms GROUP BY query_id, part, term",
    "qlist": "SELECT query_id, part, list(term ORDER BY pos) AS terms, count(DISTINCT term) AS n_distinct FROM qterms GROUP BY query_id, part",
    "qfield": "SELECT query_id, part, 0 AS field FROM qlist WHERE part = 0 UNION ALL SELECT query_id, part, 1 FROM qlist WHERE part = 0 UNION ALL SELECT query_id, part, 2 FROM qlist WHERE part = 1",
    # ranked scores
    "matched": "SELECT q.query_id, f.part, p.field, p.term, p.doc_id, p.tf, p.positions, p.field_len, q.qf FROM qfreq q "
    "JOIN qfield f ON f.query_id = q.query_id AND f.part = q.part JOIN post p ON p.term = q.term AND p.field = f.field",
    "scored": "SELECT m.*, ln((s.n_docs - d.df + 0.5::DOUBLE) / (d.df + 0.5::DOUBLE)) + ln(2.2::DOUBLE * m.tf / (1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * m.field_len / s.avg_len) + m.tf)) "
    "+ ln(101::DOUBLE * m.qf / (100 + m.qf)) AS score FROM matched m JOIN df d ON d.term = m.term AND d.field = m.field JOIN stats s ON s.field = m.field",
    "summed": "SELECT query_id, part, field, doc_id, sum(score ORDER BY score) AS s, count(*) AS n_terms, any_value(field_len) AS field_len FROM scored GROUP BY query_id, part, field, doc_id",
    "pairs": "SELECT a.query_id, a.part, a.i, a.term AS t1, b.term AS t2 FROM (SELECT *, row_number() OVER (PARTITION BY query_id, part ORDER BY pos) AS i FROM qterms) a "
    "JOIN (SELECT *, row_number() OVER (PARTITION BY query_id, part ORDER BY pos) AS i FROM qterms) b ON b.query_id = a.query_id AND b.part = a.part AND b.i = a.i + 1",
    "adjacent": "SELECT p.query_id, p.part, m1.field, m1.doc_id, count(*) AS n FROM pairs p "
    "JOIN matched m1 ON m1.query_id = p.query_id AND m1.part = p.part AND m1.term = p.t1 "
    "JOIN matched m2 ON m2.query_id = p.query_id AND m2.part = p.part AND m2.term = p.t2 AND m2.field = m1.field AND m2.doc_id = m1.doc_id "
    "WHERE list_has_any(list_transform(m1.positions, lambda x: x + 1), m2.positions) GROUP BY p.query_id, p.part, m1.field, m1.doc_id",
    "valued": "SELECT s.query_id, s.field, s.doc_id, s.s, s.n_terms, s.n_terms = l.n_distinct AS has_all, coalesce(a.n, 0) AS n_adj, s.s * CASE "
    "WHEN s.n_terms < l.n_distinct THEN 1 WHEN coalesce(a.n, 0) < len(l.terms) - 1 THEN CASE WHEN s.field = 1 THEN 1.0499999523162842::DOUBLE ELSE 5 END "
    "WHEN s.field_len = len(l.terms) THEN CASE WHEN s.field = 1 THEN 2 ELSE 20 END ELSE CASE WHEN s.field = 1 THEN 1.2000000476837158::DOUBLE ELSE 10 END END "
    "* CASE WHEN s.field = 1 THEN 0.5::DOUBLE ELSE 1 END AS value FROM summed s JOIN qlist l ON l.query_id = s.query_id AND l.part = s.part "
    "LEFT JOIN adjacent a ON a.query_id = s.query_id AND a.part = s.part AND a.field = s.field AND a.doc_id = s.doc_id",
    "hits": "SELECT t.query_id, t.doc_id, c.value AS category_score, t.value + b.value + coalesce(c.value, 0) AS text_score FROM valued t "
    "JOIN valued b ON b.query_id = t.query_id AND b.doc_id = t.doc_id AND b.field = 1 "
    "JOIN qparse q ON q.query_id = t.query_id LEFT JOIN valued c ON c.query_id = t.query_id AND c.doc_id = t.doc_id AND c.field = 2 "
    "WHERE t.field = 0 AND (q.category = '' OR c.value IS NOT NULL)",
    "normed": "SELECT h.*, CASE WHEN low = high THEN 100 ELSE (text_score - low) / (high - low) * 100 END AS text_norm FROM hits h "
    "JOIN (SELECT query_id, min(text_score) AS low, max(text_score) AS high FROM hits GROUP BY query_id) x ON x.query_id = h.query_id",
    "docranks": "SELECT c.doc_id, coalesce(r.rank, 1.0::DOUBLE / (SELECT count(*) FROM corpus)) AS rank FROM corpus c LEFT JOIN rankconv r ON r.id = c.doc_id",
    "blended": "SELECT n.query_id, n.doc_id, n.text_norm, d.rank / m.m * 1000 AS rank_norm, n.text_norm * 0.9::DOUBLE + d.rank / m.m * 1000 * 0.1::DOUBLE AS total "
    "FROM normed n JOIN docranks d ON d.doc_id = n.doc_id CROSS JOIN (SELECT max(rank) AS m FROM rankconv) m",
    "ranked": "SELECT query_id, doc_id, text_score AS total, row_number() OVER (PARTITION BY query_id ORDER BY round(text_score, 8) DESC, doc_id) AS rank FROM hits",
    "rankedpr": "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(total, 8) DESC, doc_id) AS rank FROM blended",
    "results": "SELECT * FROM ranked WHERE rank <= 1000",
    # full-text scores
    "ftq": "SELECT query_id, part, pos, word AS term FROM qraw",
    "ftqfreq": "SELECT query_id, part, term, count(*) AS qf FROM ftq GROUP BY query_id, part, term",
    "ftqlist": "SELECT query_id, part, list(term ORDER BY pos) AS terms, count(DISTINCT term) AS n_distinct FROM ftq GROUP BY query_id, part",
    "ftqfield": "SELECT query_id, part, 0 AS field FROM ftqlist WHERE part = 0 UNION ALL SELECT query_id, part, 1 FROM ftqlist WHERE part = 0 UNION ALL SELECT query_id, part, 2 FROM ftqlist WHERE part = 1",
    "ftmatched": "SELECT q.query_id, f.part, p.field, p.term, p.doc_id, p.tf, p.positions, p.field_len, q.qf, q.qf * ln(1 + (s.n_docs - d.df + 0.5::DOUBLE) / (d.df + 0.5::DOUBLE)) AS w, "
    "1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * p.field_len / s.avg_len) AS norm FROM ftqfreq q "
    "JOIN ftqfield f ON f.query_id = q.query_id AND f.part = q.part JOIN ftpost p ON p.term = q.term AND p.field = f.field "
    "JOIN ftdf d ON d.term = p.term AND d.field = p.field JOIN ftstats s ON s.field = p.field",
    "ftscored": "SELECT *, w * (tf * 2.2::DOUBLE / (tf + norm)) AS score FROM ftmatched",
    "ftsummed": "SELECT query_id, part, field, doc_id, sum(score ORDER BY score) AS s, sum(w ORDER BY w) AS idf, count(*) AS n_terms, any_value(norm) AS norm FROM ftscored GROUP BY query_id, part, field, doc_id",
    # a phrase start is a position from which every query word follows at its own offset
    "ftstarts": "SELECT m.query_id, m.part, m.field, m.doc_id, unnest(m.positions) - q.o AS start, q.o FROM ftmatched m "
    "JOIN (SELECT *, row_number() OVER (PARTITION BY query_id, part ORDER BY pos) - 1 AS o FROM ftq) q ON q.query_id = m.query_id AND q.part = m.part AND q.term = m.term",
    "ftphrase": "SELECT query_id, part, field, doc_id, count(*) AS freq FROM (SELECT s.query_id, s.part, s.field, s.doc_id, s.start FROM ftstarts s "
    "JOIN ftqlist l ON l.query_id = s.query_id AND l.part = s.part GROUP BY s.query_id, s.part, s.field, s.doc_id, s.start "
    "HAVING count(DISTINCT s.o) = any_value(len(l.terms))) x GROUP BY query_id, part, field, doc_id",
    "ftclauses": "SELECT s.query_id, s.field, s.doc_id, s.s AS any_term, s.n_terms = l.n_distinct AS has_all, coalesce(p.freq, 0) AS freq, "
    "s.idf * (coalesce(p.freq, 0) * 2.2::DOUBLE / (coalesce(p.freq, 0) + s.norm)) AS phrase FROM ftsummed s JOIN ftqlist l ON l.query_id = s.query_id AND l.part = s.part "
    "LEFT JOIN ftphrase p ON p.query_id = s.query_id AND p.part = s.part AND p.field = s.field AND p.doc_id = s.doc_id",
    "ftvalued": "SELECT query_id, field, doc_id, (CASE WHEN freq > 0 THEN phrase * CASE WHEN field = 1 THEN 2 ELSE 20 END ELSE any_term END "
    "+ CASE WHEN has_all THEN any_term * CASE WHEN field = 1 THEN 1.0499999523162842::DOUBLE ELSE 5 END ELSE 0 END) * CASE WHEN field = 1 THEN 0.5::DOUBLE ELSE 1 END AS value FROM ftclauses",
    "fthits": "SELECT t.query_id, t.doc_id, t.value + b.value + coalesce(c.value, 0) AS text_score FROM ftvalued t "
    "JOIN ftvalued b ON b.query_id = t.query_id AND b.doc_id = t.doc_id AND b.field = 1 "
    "JOIN qparse q ON q.query_id = t.query_id LEFT JOIN ftvalued c ON c.query_id = t.query_id AND c.doc_id = t.doc_id AND c.field = 2 "
    "WHERE t.field = 0 AND (q.category = '' OR c.value IS NOT NULL)",
    "ftranked": "SELECT query_id, doc_id, text_score AS total, row_number() OVER (PARTITION BY query_id ORDER BY round(text_score, 8) DESC, doc_id) AS rank FROM fthits",
    # paging and presentation
    "asked": "SELECT * FROM (VALUES (1, 2), (2, 0), (3, 999)) v(query_id, page)",
    "shown": "SELECT query_id, ceil(count(*) / 10)::BIGINT AS total_pages FROM results GROUP BY query_id",
    "wanted": "SELECT s.query_id, s.total_pages, greatest(1, least(coalesce(a.page, 1), s.total_pages)) AS page_no FROM shown s LEFT JOIN asked a ON a.query_id = s.query_id",
    "paged": "SELECT r.query_id, w.page_no, w.total_pages, r.rank, r.doc_id, r.total FROM results r JOIN wanted w ON w.query_id = r.query_id WHERE ceil(r.rank / 10) = w.page_no",
    "qwords": "SELECT query_id, ws FROM qsplit WHERE part = 0",
    # pages corpus and link graph
    "pg": f"SELECT page_id, url, html, {H1} AS title, {BODY} AS content, {ITEMS} AS categories, {HREFS} AS hrefs FROM pages",
    "heads": f"SELECT word, min(page_id) AS dst FROM (SELECT unnest(string_split_regex(lower(title), '{WS}')) AS word, page_id FROM pg) x WHERE word <> '' GROUP BY word",
    "edges": "SELECT DISTINCT l.page_id AS src, h.dst FROM (SELECT page_id, lower(regexp_extract(unnest(hrefs), '^/(.*)$', 1)) AS word FROM pg) l JOIN heads h ON h.word = l.word",
    "firsts": "SELECT * FROM pg WHERE page_id IN (SELECT min(page_id) FROM pg GROUP BY title)",
    "wordfirsts": "SELECT string_split(lower(title), ' ')[1] AS word, * FROM pg WHERE page_id IN (SELECT min(page_id) FROM pg GROUP BY string_split(lower(title), ' ')[1])",
    "numbered": "SELECT row_number() OVER (ORDER BY word) - 1 AS id, word AS title, content, categories FROM wordfirsts",
    "outs": "SELECT id, unnest(categories) AS target, generate_subscripts(categories, 1) AS pos FROM numbered",
    "resolved": "SELECT o.id, list(n.id ORDER BY o.pos) AS links FROM outs o JOIN numbered n ON n.title = lower(o.target) GROUP BY o.id",
    # robots
    "spans": f"SELECT {_url('url', 'HOST')} AS host, min({_url('url', 'PATH')}) AS low, max({_url('url', 'PATH')}) AS high FROM pages GROUP BY 1",
    # the rules that the file of each host leaves for the agent, by hand: lines 7 to 10
    "rules4": "SELECT host, unnest([7, 8, 9, 10]) AS ord, unnest([low, regexp_extract(low, '^/[^/]*/', 0), high, high]) AS path, unnest([true, false, false, true]) AS allow FROM spans",
    "rules": "SELECT host, min(ord) AS ord, path, arg_max(allow, ord) AS allow FROM (SELECT host, 2 AS ord, high AS path, false AS allow FROM spans WHERE false UNION ALL SELECT * FROM rules4) GROUP BY host, path",
    # generated query texts
    "turns": "SELECT conv_id * 1000 + turn AS query_id, CASE WHEN turn > 0 THEN text || ' category: ' || upper(left(role, 1)) || substr(role, 2) || ' ' ELSE text END AS query FROM conversations",
    "headings": "SELECT min(page_id) AS query_id, title AS query FROM pg GROUP BY title",
    **_ranks(90),
}


def sql(final: str, **replaced: str) -> str:
    """``final`` with the common table expressions it needs; ``replaced`` swaps some of them."""
    known = {**CTES, **replaced}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"[a-z_][a-z0-9_]*", re.sub(r"'(?:[^']|'')*'", "", text)):
            if name in known and name not in order and known[name] is not text:
                if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
                    visit(known[name])
                    if name not in order:
                        order.append(name)

    visit(final)
    ctes = ", ".join(f"{n} AS MATERIALIZED ({known[n]})" for n in order)
    return f"WITH RECURSIVE {ctes} {final}" if order else final


def _highlight(text: str, words: str, tag: str) -> str:
    """Words of the query list are plain letters, so they need no quoting."""
    return f"list_reduce({words}, lambda t, w: regexp_replace(t, '(?i)' || w, '<{tag}>\\0</{tag}>', 'g'), {text})"


def _snippet() -> str:
    counts = "list_transform(q.ws, lambda w: len(regexp_extract_all(x.s, '(?i)[ ]+' || w || '[ ]+')))"
    return (
        "SELECT p.query_id, p.rank, p.doc_id, '... ' || coalesce(b.body, '') || ' ...' AS text FROM paged p LEFT JOIN ("
        "SELECT query_id, doc_id, string_agg(regexp_replace(regexp_replace("
        + _highlight("s", "ws", "b")
        + ", '\\r\\n|\\r|\\n', ' ', 'g'), '[ ]+', ' ', 'g'), ' ... ' ORDER BY k DESC, i) AS body FROM ("
        f"SELECT x.query_id, x.doc_id, x.i, x.s, q.ws, list_min({counts}) * 20 + list_sum({counts}) AS k, "
        f"row_number() OVER (PARTITION BY x.query_id, x.doc_id ORDER BY list_min({counts}) * 20 + list_sum({counts}) DESC, x.i) AS rn "
        "FROM (SELECT query_id, doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM (SELECT p.query_id, p.doc_id, "
        "string_split_regex(regexp_replace(c.content, '[,;.\\n]+$', ''), '[,;.\\n]') AS ss FROM paged p JOIN corpus c ON c.doc_id = p.doc_id)) x "
        "JOIN qwords q ON q.query_id = x.query_id) y WHERE rn <= 5 GROUP BY query_id, doc_id) b ON b.query_id = p.query_id AND b.doc_id = p.doc_id"
    )


def _fulltext_snippet() -> tuple[str, str]:
    """Fragments by a fold over the text: up to 100 characters that end before a blank or the end, else the whole word; words are found
    between characters that are no letters, marks, digits or joiners. Bold tags are two control characters until the end, so that
    the second pass, which sees words that share a blank with the one before, finds no word twice."""
    blank, word = r"[\t\n\x0B\f\r ]", r"\p{L}\p{M}\p{Nd}\p{Pc}"
    piece = (
        f"CASE WHEN length(rest) <= 100 THEN rest WHEN regexp_matches(left(rest, 101), '(?s)^.{{1,100}}{blank}') "
        f"THEN regexp_extract(left(rest, 101), '(?s)^(.{{1,100}}){blank}', 1) ELSE regexp_extract(rest, '^[^\t\n\x0B\f\r ]+') END"
    )
    # A blank that starts no fragment is skipped.
    step = f"SELECT query_id, rank, doc_id, ws, i + 1 AS i, substr(rest, greatest(1, length({piece})) + 1) AS rest, {piece} AS s FROM pieces WHERE rest <> ''"
    found = f"len(list_filter(list_distinct(ws), lambda w: regexp_matches(s, '(?i)(?:^|[^{word}])' || w || '(?:$|[^{word}])')))"
    bold = f"'(?i)(^|[^{word}\x01\x02])(' || array_to_string(ws, '|') || ')($|[^{word}\x01\x02])', '\\1\x01\\2\x02\\3', 'g'"
    marked = f"regexp_replace(regexp_replace(s, {bold}), {bold})"
    tidy = f"regexp_replace(regexp_replace({marked}, '\\r\\n|\\r|\\n', ' ', 'g'), '[ ]+', ' ', 'g')"
    tags = f"replace(replace({tidy}, chr(1), '<B>'), chr(2), '</B>')"
    return (
        "SELECT p.query_id, p.rank, p.doc_id, '... ' || coalesce(b.body, '') || ' ...' AS text FROM paged p LEFT JOIN ("
        f"SELECT query_id, rank, string_agg({tags}, ' ... ' ORDER BY k DESC, i) AS body FROM ("
        "SELECT *, row_number() OVER (PARTITION BY query_id, rank ORDER BY k DESC, i) AS rn FROM ("
        f"SELECT *, {found} AS k FROM pieces WHERE s <> '') WHERE k > 0) WHERE rn <= 5 GROUP BY query_id, rank"
        ") b ON b.query_id = p.query_id AND b.rank = p.rank",
        "SELECT p.query_id, p.rank, p.doc_id, q.ws, 0 AS i, c.content AS rest, '' AS s FROM paged p JOIN corpus c ON c.doc_id = p.doc_id "
        f"JOIN qwords q ON q.query_id = p.query_id UNION ALL {step}",
    )


def _decoded_links() -> str:
    """Root-relative links only, which is all the pages hold."""
    bad = "regexp_matches(h, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)')"
    path = "regexp_extract(h, '^([^?#]*)', 1)"
    return (
        "SELECT page_id, coalesce(array_to_string(list(name ORDER BY i), '|'), '') AS links FROM ("
        "SELECT page_id, name, min(i) AS i FROM (SELECT page_id, i, replace(regexp_extract(d, '^/([^:]*)$', 1), '_', ' ') AS name FROM ("
        f"SELECT page_id, i, h, CASE WHEN {bad} THEN NULL ELSE url_decode(replace({path}, '+', ' ')) END AS d FROM ("
        "SELECT page_id, unnest(hrefs) AS h, generate_subscripts(hrefs, 1) AS i FROM pg)) "
        f"WHERE d IS NOT NULL AND regexp_full_match({path}, '/([^:]*)') AND regexp_matches(d, '^/([^:]*)$')) GROUP BY page_id, name) GROUP BY page_id"
    )


def _extracted() -> str:
    inner = "regexp_extract(html, '(?s)<article(?:\\s[^>]*)?>(.*)</article>', 1)"
    parts = f"string_split(regexp_replace({inner}, '</?(?:p|h1)>', chr(1), 'g'), chr(1))"
    clean = f"list_transform({parts}, lambda x: regexp_replace({_unescape(f'''regexp_replace(x, '{TAG}', '', 'g')''')}, '{CTRL}', '', 'g'))"
    return (
        f"SELECT page_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, array_to_string(list_filter({clean}, lambda x: x <> ''), chr(10)) AS content, "
        "array_to_string(categories, '|') AS categories, array_to_string(hrefs, '|') AS hrefs FROM pg "
        f"WHERE len(categories) > 0 AND len(list_filter({clean}, lambda x: x <> '')) > 0"
    )


def oracle_sql() -> dict[str, str]:
    footer_month = "CASE WHEN event_type = 'error' THEN 'Brumaire' ELSE monthname(ts) END"
    result_cols = "query_id, rank, doc_id, round(total, 6) AS total"
    post_cols = "term, field::BIGINT AS field, doc_id, tf, " + _nums("positions") + " AS positions_text"
    token_cols = "doc_id, field::BIGINT AS field, pos::BIGINT AS pos, token"
    q = {
        "scan_pages": "SELECT page_id, url, length(html) AS html_len FROM pages",
        "read_jsonl_quarantine": "SELECT event_id AS line_no, CASE event_type WHEN 'view' THEN 'blank' WHEN 'error' THEN 'bad' WHEN 'click' THEN 'bad' ELSE 'ok' END AS status, "
        "CASE WHEN event_type IN ('signup', 'purchase') THEN event_id END AS id, CASE WHEN event_type IN ('signup', 'purchase') THEN 'user ' || user_id END AS title, "
        "CASE WHEN event_type IN ('signup', 'purchase') THEN 2::BIGINT END AS n_categories FROM events",
        "posting_text_roundtrip": sql(
            f"SELECT term, doc_id, f0, f1, f2, concat_ws('|', coalesce({_nums('p0[1]')}, ''), coalesce({_nums('p1[1]')}, ''), coalesce({_nums('p2[1]')}, '')) AS positions_text FROM wide"
        ),
        "rank_text_roundtrip": sql(
            f"SELECT r.id, round(r.rank, 9) AS rank, {_nums('list(e.dst ORDER BY e.dst)')} AS links_text FROM rank0 r JOIN edges e ON e.src = r.id GROUP BY r.id, r.rank"
        ),
        "list_codec": sql(
            "SELECT doc_id, text, len(items)::BIGINT AS n_items, array_to_string(items, '~') AS items_text FROM (SELECT page_id AS doc_id, "
            "CASE length(content) % 3 WHEN 0 THEN array_to_string(categories, '|') || '||' WHEN 1 THEN '|' || array_to_string(categories, '|') ELSE '' END AS text, "
            "CASE length(content) % 3 WHEN 0 THEN categories WHEN 1 THEN list_concat([''], categories) ELSE [''] END AS items FROM pg)"
        ),
        "ingest_insert_or_ignore": sql("SELECT title, page_id FROM firsts"),
        "stream_ingest_pages": sql(
            f"SELECT x.title, x.page_id, x.content, x.categories, '{RUN_TIME[:16]}' AS last_modified_text, coalesce(l.links, '') AS links FROM extracted x "
            "LEFT JOIN outnames l ON l.page_id = x.page_id WHERE x.page_id IN (SELECT min(page_id) FROM extracted GROUP BY title)",
            extracted=_extracted(),
            outnames=_decoded_links(),
        ),
        "export_three_way": sql(
            "SELECT 'data' AS kind, id, title || '~' || content || '~' || array_to_string(categories, '|') AS payload_text FROM numbered "
            f"UNION ALL SELECT 'index', id, title FROM numbered UNION ALL SELECT 'link', id, {_nums('links')} FROM resolved"
        ),
        "publish_index_tables": sql(
            "SELECT 'postings' AS table_name, count(*) AS n FROM post UNION ALL SELECT 'term_stats', count(*) FROM df UNION ALL SELECT 'stats', count(*) FROM stats "
            "UNION ALL SELECT 'docs', count(*) FROM corpus UNION ALL SELECT 'content', count(*) FROM corpus UNION ALL SELECT 'ranks', count(*) FROM nodes "
            "UNION ALL SELECT 'meta', 1"
        ),
        "page_title": sql("SELECT page_id, title FROM pg"),
        "page_content": sql("SELECT page_id, content FROM pg"),
        "page_categories": sql("SELECT page_id, array_to_string(categories, '|') AS categories FROM pg"),
        "page_extract": sql(_extracted()),
        "page_last_modified": "SELECT event_id AS id, CASE WHEN event_type IN ('view', 'error') THEN '" + RUN_TIME[:16] + "' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS last_modified_text "
        f"FROM events WHERE {footer_month} IS NOT NULL",
        "page_outlinks": sql("SELECT p.page_id, coalesce(l.links, '') AS links FROM pages p LEFT JOIN (" + _decoded_links() + ") l ON l.page_id = p.page_id"),
        "url_canonicalize": f"SELECT page_id, {_url('url', 'PROTOCOL')} || '://' || {_url('url', 'HOST')} || {_url('url', 'FILE')} AS url FROM pages",
        "url_scope_filter": f"SELECT page_id, url FROM pages WHERE regexp_full_match({_url('url', 'HOST')}, '(www|blog)[.].*') AND regexp_full_match({_url('url', 'PATH')}, '/(en|fr)/[0-9]+')",
        "drop_empty_pages": sql("SELECT page_id, len(categories)::BIGINT AS n_categories FROM pg WHERE title <> '' AND content <> '' AND len(categories) > 0"),
        "robots_rules": sql("SELECT host, ord::BIGINT AS ord, path, allow FROM rules"),
        "robots_filter": sql(
            f"SELECT p.page_id, p.url, coalesce((SELECT arg_min(r.allow, r.ord) FROM rules r WHERE r.host = {_url('p.url', 'HOST')} AND starts_with({_url('p.url', 'FILE')}, r.path)), true) AS allowed FROM pages p"
        ),
        "frontier_step": sql("SELECT DISTINCT dst AS page_id, 1::BIGINT AS depth FROM edges WHERE src = (SELECT min(src) FROM edges) AND dst <> (SELECT min(src) FROM edges)"),
        "frontier_bfs": sql(
            "SELECT page_id, min(depth)::BIGINT AS depth FROM reach GROUP BY page_id",
            reach="SELECT min(src) AS page_id, 0 AS depth FROM edges UNION SELECT e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.page_id WHERE r.depth < 10",
        ),
        "stream_visited_dedup": f"SELECT DISTINCT {_url('url', 'PROTOCOL')} || '://' || {_url('url', 'HOST')} || {_url('url', 'FILE')} AS url FROM pages",
        "assign_doc_ids": sql("SELECT row_number() OVER (ORDER BY title) - 1 AS id, title FROM firsts"),
        "title_dictionary": sql("SELECT title, id FROM numbered"),
        "resolve_links": sql(f"SELECT id, {_nums('links')} AS links_text FROM resolved"),
        "out_degree": sql("SELECT src AS id, n FROM deg"),
        "in_links": sql("SELECT dst, count(*) AS n FROM edges GROUP BY dst"),
        "dangling_nodes": sql("SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM edges)"),
        "tokenize_positions": sql("SELECT doc_id, field::BIGINT AS field, pos::BIGINT AS pos, raw AS token FROM raw"),
        "normalize_token": sql(f"SELECT {token_cols} FROM norm"),
        "alnum_filter": sql(f"SELECT {token_cols} FROM alnum"),
        "stopword_filter": sql(f"SELECT {token_cols} FROM kept"),
        "stem_english": sql("SELECT token, stem FROM stems"),
        "field_lengths": sql("SELECT doc_id, field::BIGINT AS field, len(toks)::BIGINT AS len FROM split"),
        "join_categories": sql("SELECT page_id AS doc_id, lower(array_to_string(categories, ' ')) AS text FROM pg"),
        "parse_query": sql("SELECT query_id, keyword, category FROM qparse", qtext="SELECT * FROM turns"),
        "split_query_terms": sql("SELECT query_id, part::BIGINT AS part, pos::BIGINT AS pos, term FROM qterms", qtext="SELECT * FROM turns"),
        "query_term_freq": sql("SELECT query_id, part::BIGINT AS part, term, qf FROM qfreq", qtext="SELECT * FROM turns"),
        "analyze_standard": sql("SELECT doc_id, field::BIGINT AS field, pos::BIGINT AS pos, term AS token FROM fttoks"),
        "build_postings": sql(f"SELECT {post_cols} FROM post"),
        "build_postings_unstemmed": sql(f"SELECT {post_cols} FROM rawpost"),
        "posting_lists": sql("SELECT term, (doc_id // 4096)::BIGINT AS block, string_agg(doc_id || ':' || f0 || ',' || f1 || ',' || f2, ';' ORDER BY doc_id) AS line FROM wide GROUP BY ALL"),
        "wide_postings": sql(f"SELECT term, doc_id, f0, f1, f2, {_nums('positions')} AS positions_text FROM wide"),
        "doc_frequency": sql("SELECT term, field::BIGINT AS field, df FROM df"),
        "avg_field_length": sql("SELECT field::BIGINT AS field, round(avg_len, 6) AS avg_len FROM stats"),
        "doc_count": sql("SELECT count(*) AS n FROM corpus"),
        "index_summary": sql(
            "SELECT 'keywords' AS metric, count(DISTINCT term) AS n FROM post UNION ALL SELECT 'postings', count(*) FROM post "
            "UNION ALL SELECT 'documents', count(*) FROM corpus UNION ALL SELECT 'ranked_pages', count(*) FROM nodes"
        ),
        "pagerank_init": sql("SELECT src AS id, round(1.0::DOUBLE / (SELECT n FROM nsrc), 9) AS rank FROM deg"),
        "pagerank_contrib": sql("SELECT e.src, e.dst, round(1.0::DOUBLE / (SELECT n FROM nsrc) / d.n, 9) AS contrib FROM edges e JOIN deg d ON d.src = e.src"),
        "pagerank_step": sql("SELECT id, round(rank, 9) AS rank FROM rank1"),
        "pagerank_k10": sql("SELECT id, round(rank, 9) AS rank FROM rank10"),
        "pagerank_converged": sql("SELECT id, round(rank, 9) AS rank FROM rankconv"),
        "max_rank": sql("SELECT round(max(rank), 9) AS max_rank FROM rankconv"),
        "rank_lookup_default": sql("SELECT doc_id, round(rank, 9) AS rank FROM docranks"),
        "fetch_postings": sql("SELECT query_id, term, field::BIGINT AS field, doc_id, tf FROM matched"),
        "bm25_log_score": sql("SELECT query_id, field::BIGINT AS field, doc_id, term, round(score, 6) AS value FROM scored"),
        "score_terms": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(s, 6) AS value, n_terms FROM summed"),
        "all_terms_match": sql("SELECT query_id, field::BIGINT AS field, doc_id, has_all AS value FROM valued"),
        "bigram_adjacency": sql("SELECT query_id, field::BIGINT AS field, doc_id, n_adj AS value FROM valued"),
        "proximity_boost": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(value, 6) AS value FROM valued"),
        "combine_fields_inner": sql("SELECT a.query_id, a.doc_id, round(a.value + b.value, 6) AS score FROM valued a JOIN valued b ON b.query_id = a.query_id AND b.doc_id = a.doc_id AND b.field = 1 WHERE a.field = 0"),
        "combine_fields_outer": sql("SELECT query_id, doc_id, round(sum(value), 6) AS score FROM valued WHERE field < 2 GROUP BY query_id, doc_id"),
        "category_constraint": sql("SELECT query_id, doc_id, round(category_score, 6) AS category_score, round(text_score, 6) AS score FROM hits"),
        "hit_count": sql("SELECT q.query_id, count(h.doc_id) AS hits FROM qtext q LEFT JOIN hits h ON h.query_id = q.query_id GROUP BY q.query_id"),
        "minmax_normalize": sql("SELECT query_id, doc_id, round(text_norm, 6) AS score FROM normed"),
        "blend_rank": sql("SELECT query_id, doc_id, round(text_norm, 6) AS text_norm, round(rank_norm, 6) AS rank_norm, round(total, 6) AS total FROM blended"),
        "topk_results": sql(f"SELECT {result_cols} FROM ranked WHERE rank <= 1000"),
        "search_text": sql(f"SELECT {result_cols} FROM results"),
        "search_text_rank": sql(f"SELECT {result_cols} FROM rankedpr WHERE rank <= 1000"),
        "search_batch": sql(f"SELECT {result_cols} FROM results", qtext="SELECT query_id, query FROM headings"),
        "score_text": sql("SELECT query_id, rank, doc_id, printf('%.8f (Normalized BM25 + Proximity: %.8f, Normalized PageRank: %.8f)', total, text_norm, rank_norm) AS text FROM rankedpr WHERE rank <= 1000"),
        "fetch_result_pages": sql("SELECT r.query_id, r.rank, r.doc_id, c.title, array_to_string(c.categories, '|') AS text FROM results r JOIN corpus c ON c.doc_id = r.doc_id"),
        "highlight": sql(f"SELECT p.query_id, p.rank, p.doc_id, {_highlight('c.title', 'w.ws', 'span')} AS text FROM paged p JOIN corpus c ON c.doc_id = p.doc_id JOIN qwords w ON w.query_id = p.query_id"),
        "snippet_sentences": sql(_snippet()),
        "result_links": sql(
            "SELECT p.query_id, p.rank, p.doc_id, 'https://en.wikipedia.org/wiki/' || replace(c.title, ' ', '_') || ' ' || array_to_string(list_transform(c.categories, "
            "lambda x: 'https://en.wikipedia.org/wiki/Category:' || replace(x, ' ', '_')), ' ') AS text FROM paged p JOIN corpus c ON c.doc_id = p.doc_id"
        ),
        "paginate": sql("SELECT query_id, page_no, total_pages, rank, doc_id FROM paged"),
        "result_json": sql(
            "SELECT q.query_id, coalesce(h.n, 0) AS hits, w.page_no, w.total_pages, f.titles, f.urls, f.snippets, f.scores FROM qtext q "
            "LEFT JOIN (SELECT query_id, count(*) AS n FROM hits GROUP BY query_id) h ON h.query_id = q.query_id LEFT JOIN wanted w ON w.query_id = q.query_id "
            f"LEFT JOIN (SELECT p.query_id, string_agg({_highlight('c.title', 'x.ws', 'span')}, '~' ORDER BY p.rank) AS titles, "
            "string_agg('https://en.wikipedia.org/wiki/' || replace(c.title, ' ', '_'), '~' ORDER BY p.rank) AS urls, "
            "string_agg(s.text, '~' ORDER BY p.rank) AS snippets, string_agg(printf('%.8f', p.total), '~' ORDER BY p.rank) AS scores FROM paged p "
            "JOIN corpus c ON c.doc_id = p.doc_id JOIN qwords x ON x.query_id = p.query_id "
            "JOIN snips s ON s.query_id = p.query_id AND s.rank = p.rank GROUP BY p.query_id) f ON f.query_id = q.query_id",
            snips=_snippet(),
        ),
        "ft_index": sql(f"SELECT {post_cols} FROM ftpost"),
        "ft_term_query": sql("SELECT query_id, field::BIGINT AS field, doc_id, term, round(score, 6) AS score FROM ftscored"),
        "ft_phrase_query": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(phrase, 6) AS score FROM ftclauses WHERE freq > 0"),
        "ft_all_terms": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(any_term, 6) AS score FROM ftclauses WHERE has_all"),
        "ft_any_term": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(any_term, 6) AS score FROM ftclauses"),
        "ft_must_not": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(any_term, 6) AS score FROM ftclauses WHERE freq = 0"),
        "ft_field_query": sql("SELECT query_id, field::BIGINT AS field, doc_id, round(value, 6) AS score FROM ftvalued"),
        "ft_cross_field_must": sql("SELECT query_id, doc_id, round(text_score, 6) AS score FROM fthits"),
        "ft_topk": sql(f"SELECT {result_cols} FROM ftranked WHERE rank <= 1000"),
        "search_fulltext": sql(f"SELECT {result_cols} FROM ftranked WHERE rank <= 1000"),
    }
    final, pieces = _fulltext_snippet()
    q["ft_snippet"] = sql(final, pieces=pieces, results="SELECT * FROM ftranked WHERE rank <= 1000")
    return q
