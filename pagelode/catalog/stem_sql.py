"""Porter2 as a chain of DuckDB SQL projections over a vocabulary: an independent formulation
used only to check the engine's stems."""

from __future__ import annotations

from pagelode.functions.porter2 import DOUBLES, EXCEPTIONS, FINISHED, REGION_PREFIXES, STEP2, STEP3, STEP4

SHORT_SYLLABLE = "[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$"


def suffix_pattern(suffixes) -> str:
    """One end-anchored group; the leftmost match is the longest suffix."""
    return "(" + "|".join(sorted(suffixes, key=lambda s: (-len(s), s))) + ")$"


def region_pattern() -> str:
    syllable = "[^aeiouy]*[aeiouy]+[^aeiouy]"
    return f"^({'|'.join(REGION_PREFIXES)}|{syllable})(?:{syllable})?"


def duckdb_stem(relation: str, word: str = "token") -> str:
    """The same chain as DuckDB SQL over the distinct values of ``word``: columns
    ``token, stem``. Used only to check results."""
    esc = lambda s: s.replace("'", "''")
    quoted = lambda xs: ", ".join(f"'{esc(x)}'" for x in xs)
    cases = lambda table: " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    region = region_pattern()
    short = SHORT_SYLLABLE
    cut = "left(w, length(w) - length(s))"
    return f"""(
WITH v0 AS (SELECT DISTINCT {word} AS token FROM {relation}),
v1 AS (SELECT token, regexp_replace(regexp_replace(regexp_replace(token, '^''', ''), '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM v0),
v2 AS (SELECT token, w, length(regexp_extract(w, '{region}', 1)) AS a, length(regexp_extract(w, '{region}', 0)) AS b FROM v1),
v3 AS (SELECT token, regexp_replace(w, '(''s''|''s|'')$', '') AS w,
  CASE WHEN a > 0 THEN a ELSE length(w) END AS p1, CASE WHEN b > a THEN b ELSE length(w) END AS p2 FROM v2),
v4 AS (SELECT token, p1, p2, CASE
    WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
    WHEN w LIKE '%ied' OR w LIKE '%ies' THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
    WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
    WHEN regexp_matches(w, '(?s)[aeiouy].+s$') THEN left(w, length(w) - 1) ELSE w END AS w FROM v3),
v5 AS (SELECT token, p1, p2, w, w IN ({quoted(FINISHED)}) AS fin,
    CASE WHEN w IN ({quoted(FINISHED)}) THEN '' ELSE regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$', 1) END AS s FROM v4),
v6 AS (SELECT *, {cut} AS t FROM v5),
v7 AS (SELECT token, p1, p2, fin, CASE
    WHEN s = '' THEN w
    WHEN s IN ('eed', 'eedly') THEN CASE WHEN length(t) >= p1 THEN t || 'ee' ELSE w END
    WHEN NOT regexp_matches(t, '[aeiouy]') THEN w
    WHEN regexp_matches(t, '(at|bl|iz)$') THEN t || 'e'
    WHEN right(t, 2) IN ({quoted(DOUBLES)}) THEN left(t, length(t) - 1)
    WHEN length(t) = p1 AND regexp_matches(t, '{short}') THEN t || 'e'
    ELSE t END AS w FROM v6),
v8 AS (SELECT token, p1, p2, fin, CASE WHEN fin THEN w ELSE regexp_replace(w, '(?s)^(.+[^aeiouy])[yY]$', '\\1i') END AS w FROM v7),
v9 AS (SELECT *, CASE WHEN fin THEN '' ELSE regexp_extract(w, '{suffix_pattern(STEP2)}', 1) END AS s FROM v8),
v10 AS (SELECT *, {cut} AS t FROM v9),
v11 AS (SELECT token, p1, p2, fin, CASE
    WHEN s = '' OR length(t) < p1 OR (s = 'ogi' AND t NOT LIKE '%l')
      OR (s = 'li' AND NOT regexp_matches(t, '[cdeghkmnrt]$')) THEN w
    ELSE t || CASE s {cases(STEP2)} END END AS w FROM v10),
v12 AS (SELECT *, CASE WHEN fin THEN '' ELSE regexp_extract(w, '{suffix_pattern(STEP3)}', 1) END AS s FROM v11),
v13 AS (SELECT *, {cut} AS t FROM v12),
v14 AS (SELECT token, p1, p2, fin, CASE
    WHEN s = '' OR length(t) < CASE WHEN s = 'ative' THEN p2 ELSE p1 END THEN w
    ELSE t || CASE s {cases(STEP3)} END END AS w FROM v13),
v15 AS (SELECT *, CASE WHEN fin THEN '' ELSE regexp_extract(w, '{suffix_pattern(STEP4)}', 1) END AS s FROM v14),
v16 AS (SELECT *, {cut} AS t FROM v15),
v17 AS (SELECT token, p1, p2, fin, CASE
    WHEN s = '' OR length(t) < p2 OR (s = 'ion' AND NOT regexp_matches(t, '[st]$')) THEN w ELSE t END AS w FROM v16),
v18 AS (SELECT token, CASE
    WHEN fin THEN w
    WHEN w LIKE '%e' AND (length(w) - 1 >= p2 OR (length(w) - 1 >= p1 AND NOT regexp_matches(left(w, length(w) - 1), '{short}')))
      THEN left(w, length(w) - 1)
    WHEN w LIKE '%ll' AND length(w) - 1 >= p2 THEN left(w, length(w) - 1) ELSE w END AS w FROM v17)
SELECT token, CASE
    WHEN length(token) < 3 THEN token
    {" ".join(f"WHEN token = '{k}' THEN '{v}'" for k, v in EXCEPTIONS.items())}
    ELSE replace(w, 'Y', 'y') END AS stem FROM v18)"""
