"""The queries in DuckDB's SQL, where SQL can express them; over the same tables."""

from __future__ import annotations

import string

from shelfmark.llm import licenses, quality_rules, ranked_search
from shelfmark.llm.common import SPACE, WORD

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

NGRAM_JOIN = f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM split),
entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM entries a JOIN entries b ON a.g = b.g
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce((SELECT min(y) FROM reach WHERE x = doc_id), doc_id) AS component_id
FROM sets
"""


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    pattern = licenses.COPYRIGHT_LINE.replace("\n", "\\n")
    plain = f"' ' || regexp_replace(lower(regexp_replace({text}, {_quoted(pattern)}, '\\1', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
    for said, meant in licenses.SPELLINGS:
        plain = f"replace({plain}, {_quoted(said)}, {_quoted(meant)})"
    return f"sha256(trim({plain}))"


LICENSE_SCAN = f"""
WITH texts(license, text) AS (VALUES {', '.join(f'({_quoted(name)}, {_quoted(body)})' for name, body in licenses.known_texts())}),
known AS (SELECT digest, min(license) AS license FROM (SELECT {_canonical('text')} AS digest, license FROM texts
  UNION ALL VALUES {', '.join(f'({_quoted(d)}, {_quoted(name)})' for name, d in licenses.DIGESTS.items())}) GROUP BY 1),
lines AS (
  SELECT doc_id, {_canonical('line')} AS digest
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, {_quoted(licenses.NOTICE_HINT)})),
notices AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM lines JOIN known USING (digest) GROUP BY doc_id),
whole AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS digest FROM documents)
SELECT whole.doc_id, whole.digest, known.license, coalesce(notices.n, 0) AS n_notices, coalesce(notices.names, '') AS notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices ON notices.doc_id = whole.doc_id
"""

_W, _STOPS = quality_rules.WINDOW, sorted({*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)})


def _fails(rule: quality_rules.Rule) -> str:
    ratio = f"{rule.above} / greatest({rule.below}, 1)"
    tests = [f"{ratio} < {rule.least}"] if rule.least is not None else []
    tests += [f"{ratio} > {rule.most}"] if rule.most is not None else []
    return " OR ".join(tests)


QUALITY_RULES = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[{SPACE}]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - {_W - 2})) AS i, array_to_string(w[i:i + {_W - 1}], ' ') AS g FROM split WHERE len(w) > {_W}),
twice AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, sum(least({_W}, coalesce(following - i, {_W}))) AS n FROM twice GROUP BY doc_id),
measured AS (
  SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(list_filter(w, lambda x: x IN ({', '.join(map(_quoted, _STOPS))}))) AS BIGINT) AS n_stop_words,
    CAST(length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals
  FROM split LEFT JOIN repeated ON repeated.doc_id = split.doc_id),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    concat_ws(',', {', '.join(f"CASE WHEN {_fails(r)} THEN '{r.name}' END" for r in quality_rules.RULES)}) AS failed_rules
  FROM measured)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM judged
"""

IMPACT_SEARCH = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.v AS qv, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id OR q.v <> c.v WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^{ranked_search.SEPARATORS}]+')"

RANKED_SEARCH = f"""
WITH split AS (SELECT doc_id, {_TERMS} AS t FROM documents),
docs AS (SELECT row_number() OVER () AS k, doc_id, t, len(t) AS n FROM split WHERE len(t) > 0),
stats AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
items AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT i, item_id, unnest(t) AS term FROM items),
postings AS (
  SELECT k, doc_id, n, term, count(*) AS tf FROM (SELECT k, doc_id, n, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
held AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
scored AS (
  SELECT i, item_id, k, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN postings USING (term) CROSS JOIN stats
  WHERE doc_id IS NOT NULL GROUP BY i, item_id, k, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

STATEMENTS = {"op12_impact_search": IMPACT_SEARCH, "op13_ranked_search": RANKED_SEARCH,
              "op2_ngram_join": NGRAM_JOIN, "op3_license_scan": LICENSE_SCAN, "op9_quality_rules": QUALITY_RULES}
