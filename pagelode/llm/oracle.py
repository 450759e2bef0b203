"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

_OP1 = """
WITH d AS (SELECT substr(md5(url), 1, 1) AS file, page_id, url, coalesce(html, '') AS html FROM pages),
copied AS (
  SELECT *, CASE WHEN page_id % 50 = 7 THEN substr(html, 1, greatest(length(html) - 1, 0)) || '~' ELSE html END AS copy, coalesce(page_id % 97 = 5, false) AS gone FROM d
),
hashed AS (
  SELECT file, page_id, url, sha256(html) AS digest, strlen(html) + 512 AS n_bytes, sha256(copy) AS copied, strlen(copy) + 512 AS copied_length, gone FROM copied
),
placed AS (
  SELECT *, (sum(n_bytes) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, url NULLS FIRST, copied, copied_length, gone ROWS UNBOUNDED PRECEDING) - n_bytes)::BIGINT
         AS record_offset FROM hashed
)
SELECT file, record_offset, n_bytes, digest, CASE WHEN gone THEN 'missing' ELSE 'corrupt' END AS status
FROM placed WHERE gone OR digest <> copied OR n_bytes <> copied_length
"""

_OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents
),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM windows) WHERE n > 1
),
repeated AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS i FROM again) GROUP BY r
),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}') GROUP BY r
),
measured AS (
  SELECT doc_id, source, len(w) AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
),
judged AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
         100 * n_symbols > 30 * n_words AS symbols, 100 * n_dup_lines > 10 * n_words AS lines FROM measured
),
failures AS (
  SELECT source, rule, count(*) AS n, sum(failed::INT) AS f
  FROM (SELECT source, unnest(['short', 'repeats', 'symbols', 'lines']) AS rule, unnest([short, repeats, symbols, lines]) AS failed FROM judged)
  GROUP BY ALL
),
sums AS (
  SELECT rule, count(*)::DOUBLE AS m, sum(n)::DOUBLE AS total, sum(n::DOUBLE * n) AS squares, sum(f)::DOUBLE AS fs, sum(f::DOUBLE * f / n) AS spread
  FROM failures GROUP BY rule
),
rho AS (
  SELECT rule, fs / total AS u,
         CASE WHEN fs > 0 AND fs < total AND total - squares / total - (m - 1) > 0
              THEN ((spread - fs * fs / total) / (fs / total * (1 - fs / total)) - (m - 1)) / (total - squares / total - (m - 1)) END AS rho
  FROM sums
),
prior AS (SELECT rule, u, CASE WHEN rho > 0 THEN least(1e6, (1 - rho) / rho) ELSE 1e6 END AS weight FROM rho),
bad AS (
  SELECT source, bool_or((f + u * weight) / (n + weight) >= 0.5) AS rejected FROM failures JOIN prior USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND NOT rejected AS kept
FROM judged JOIN bad ON judged.source IS NOT DISTINCT FROM bad.source
"""

_OP7 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(text, '')) AS key
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
),
steps AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY most / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares,
         row_number() OVER (ORDER BY most / w, source) AS place
  FROM sources
),
level AS (SELECT place AS first_place, rest AS left_over, shares AS parts FROM steps WHERE rest * w <= most * shares ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN place < first_place THEN most::DOUBLE ELSE (left_over * w)::DOUBLE / parts::DOUBLE END AS target FROM steps, level
),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS extra FROM targets
),
ordered AS (
  SELECT d.doc_id, d.size, plan.*,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, extra - before)))::BIGINT AS taken FROM ordered
"""

# Floors of quotients, written for DuckDB's truncating division.
def _floor(up: str, down: str) -> str:
    return f"(({up}) // ({down}) - CASE WHEN ({up}) % ({down}) < 0 THEN 1 ELSE 0 END)"


def _op11_round(book: str, step: int) -> str:
    return f"""
near{step} AS (
  SELECT r, part, min(ROW(apart, entry)) AS best
  FROM (SELECT r, part, entry, list_sum(list_transform(list_zip(v.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS apart
        FROM parts v JOIN {book} b USING (part)) GROUP BY r, part
),"""


def _op11_update(book: str, step: int) -> str:
    return f"""
means{step} AS (
  SELECT part, entry, list({_floor("s", "c")} ORDER BY place) AS p
  FROM (SELECT part, best[2] AS entry, place, sum(x)::BIGINT AS s, count(*) AS c
        FROM (SELECT part, best, unnest(p) AS x, unnest(range(len(p))) AS place FROM near{step} JOIN parts USING (r, part)) GROUP BY ALL)
  GROUP BY part, entry
),
book{step} AS (SELECT part, entry, coalesce(m.p, b.p) AS p FROM {book} b LEFT JOIN means{step} m USING (part, entry)),"""


_OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
  SELECT r, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS p FROM (SELECT r, v, unnest(range(16)) AS part FROM kept)
),
book0 AS (SELECT part, r - 1 AS entry, p FROM parts WHERE r <= 64),
{_op11_round("book0", 1)}{_op11_update("book0", 1)}{_op11_round("book1", 2)}{_op11_update("book1", 2)}{_op11_round("book2", 3)}
codes AS (
  SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM near3 GROUP BY r
),
coded AS (SELECT vec_id, label, code, error FROM kept JOIN codes USING (r)),
sha AS (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, sha
"""

_OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS of_lang FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
had AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
pairs AS (SELECT DISTINCT lang, source FROM d),
sized AS (
  SELECT pairs.*, coalesce((SELECT sum(n) FROM had WHERE had.lang = pairs.lang AND had.source = pairs.source), 0) AS n_group,
         coalesce((SELECT sum(of_lang) FROM kept WHERE kept.lang = pairs.lang), 0) AS n_lang,
         (SELECT count(*) FROM kept WHERE kept.lang = pairs.lang) AS v FROM pairs
),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (n_group + 2 * v) AS p,
         1 + 1000000000::HUGEINT * (of_lang + 2) // (n_lang + 2 * v) AS q
  FROM sized JOIN kept USING (lang) LEFT JOIN had USING (lang, source, term)
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM cells x JOIN cells y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM cells WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_merkle": _OP1, "op6_host_rules": _OP6, "op7_mixing": _OP7, "op11_dual_tree": _OP11, "op12_divergence": _OP12}
