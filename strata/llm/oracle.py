"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from strata.llm.common import UPPER
from strata.llm.licenses import EQUIVALENT, LICENSE_NOTICES, LICENSE_TEXTS


def _words(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def _shingles(table: str, key: str) -> str:
    """Distinct 5-word shingles of a table's texts, one list per row."""
    return f"""
    SELECT {key}, CASE
      WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM (SELECT {key}, {_words(_lower('text'))} AS w FROM {table})"""


_DECONTAMINATION = f"""
WITH d AS (
  -- also of one to four words, as items may be that short
  SELECT doc_id, list_distinct(flatten(list_transform(range(1, 6), lambda m: list_transform(
    range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS s
  FROM (SELECT doc_id, {_words(_lower('text'))} AS w FROM documents)),
q AS ({_shingles('benchmark', 'item_id')}),
ds AS (SELECT DISTINCT doc_id, unnest(s) AS sh FROM d WHERE doc_id IS NOT NULL),
qs AS (SELECT DISTINCT item_id, unnest(s) AS sh FROM q WHERE item_id IS NOT NULL),
n AS (SELECT item_id, count(*) AS n_item FROM qs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM ds JOIN qs USING (sh) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n_item)
"""

_MIXTURE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_words('text')}) AS BIGINT) AS size,
         md5('4:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
-- clamp, share again, until no share is above its cap
fill AS (
  SELECT *, coalesce(sum(2 * source_size) OVER o, 0) AS caps,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS ws, sum(source_size) OVER () * 1.5 AS total,
         row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS n
  FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min(CAST(total - caps AS DOUBLE), n) AS remaining, arg_min(CAST(ws AS DOUBLE), n) AS weight, min(n) AS n0
  FROM fill WHERE CAST(w AS DOUBLE) * CAST(total - caps AS DOUBLE) / CAST(ws AS DOUBLE) <= 2 * source_size),
t AS (
  SELECT source, source_size,
         CASE WHEN n >= n0 THEN CAST(w AS DOUBLE) * remaining / weight ELSE CAST(2 * source_size AS DOUBLE) END AS target
  FROM fill, level),
x AS (
  SELECT d.*, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
y AS (
  SELECT *, whole + CASE WHEN 2 * start + size <= 2 * (target - CAST(whole * source_size AS DOUBLE)) THEN 1 ELSE 0 END AS copies
  FROM x)
SELECT doc_id, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken FROM y
"""

_SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda j: array_to_string(w[j:j+12], ' '))) AS g
  FROM d WHERE len(w) >= 13),
lost AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS m FROM win) WHERE m < doc_id),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM lost),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS txt, count(*) AS n
  FROM word ANTI JOIN cov USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _canonical(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    line = (
        r"(?m)^[^\w\n]*(copyright[^\w\n]*(\(c\)|©|[0-9]{4})|\(c\)[^\w\n]*[0-9]{4}|©[^\w\n]*[0-9]{4}"
        r"|all rights reserved)[^\n]*$"
    )
    out = f"regexp_replace({out}, '{line}', '', 'g')"
    for spelling, standard in EQUIVALENT:
        out = f"replace({out}, '{spelling}', '{standard}')"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"


def _digest(canonical: str) -> str:
    return rf"sha256(trim(regexp_replace({canonical}, '[ \n]+', ' ', 'g')))"


def _known(texts: tuple[tuple[str, str], ...]) -> str:
    quoted = (f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in texts)
    return f"SELECT {_digest(_canonical('t'))} AS digest, min(n) AS name FROM (VALUES {', '.join(quoted)}) v(n, t) GROUP BY 1"


_LICENSES = f"""
WITH c AS (SELECT doc_id, {_canonical('text')} AS c FROM documents),
lines AS (SELECT DISTINCT doc_id, unnest(string_split(c, chr(10))) AS line FROM c),
texts AS ({_known(LICENSE_TEXTS + LICENSE_NOTICES)}), notices AS ({_known(LICENSE_NOTICES)}),
found AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices
  FROM lines JOIN notices ON {_digest('line')} = digest WHERE length(line) > 1 GROUP BY doc_id)
SELECT c.doc_id, {_digest('c.c')} AS digest, texts.name AS license, found.notices AS notices
FROM c LEFT JOIN texts ON {_digest('c.c')} = texts.digest LEFT JOIN found ON found.doc_id = c.doc_id
"""

_NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS ({_shingles('documents', 'doc_id')}),
u AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, unnest(s) AS sh FROM d),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM u a JOIN u b USING (sh)
  WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.y FROM reach r JOIN link l ON r.b = l.x),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d JOIN c ON c.a = d.doc_id
"""

_URLS = f"""
WITH p AS (
  SELECT page_id, html, {_lower("coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
q AS (
  SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '(/|\\.html?)$', '') AS page,
         {_words("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title
  FROM p),
spam AS (SELECT DISTINCT page FROM q WHERE host <> '' AND len(title) >= 8 AND len(list_distinct(title)) <= 2),
r(rule, h, pre, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
-- a rule fits the page's own host or one that ends with a dot and its host
hit AS (
  SELECT DISTINCT host, path, arg_max(rule, length(rule)) OVER (PARTITION BY host, path) AS rule,
         arg_max(verdict, length(rule)) OVER (PARTITION BY host, path) AS verdict
  FROM q JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre))
SELECT page_id, q.host, q.path, hit.rule AS rule,
       coalesce(hit.verdict, CASE WHEN q.host <> '' AND page IN (SELECT page FROM spam) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN hit ON hit.host = q.host AND hit.path = q.path
"""

# CRC-32 of a list of byte values, one bit at a time (-1 stands for a shift).
_CRC32 = """xor(4294967295, list_reduce(
    flatten(list_transform({bytes}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END,
    CAST(4294967295 AS BIGINT)))"""
_DIGITS = _CRC32.format(bytes="list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))")

_TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS n,
         substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list(struct_pack(id := id, n := n) ORDER BY turn NULLS FIRST, id) AS seq FROM t GROUP BY conv_id),
r AS (
  SELECT conv_id, list_concat(coalesce(opening[1:h], []), seq[h + 1:]) AS seq
  FROM (
    SELECT c.conv_id, c.seq, b.seq AS opening, {_DIGITS} % 6 AS h
    FROM s c LEFT JOIN s b ON b.conv_id = c.conv_id - c.conv_id % 100)),
p AS (
  SELECT conv_id, d, d = len(seq) AS at_end, CASE WHEN d > 0 THEN seq[d].n ELSE 0 END AS n,
         md5(array_to_string(list_transform(seq[1:d], lambda x: x.id), ',')) AS k,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(seq[1:d - 1], lambda x: x.id), ',')) END AS pk
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM r)),
node AS (
  SELECT k, d, min(conv_id) AS conv_id, any_value(pk) AS pk, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256
  FROM p GROUP BY k, d),
kids AS (SELECT pk, count(*) AS n_children FROM node WHERE pk IS NOT NULL GROUP BY pk),
-- every node counts for all prefixes of one of its members
below AS (
  SELECT p.k, p.d, sum((node.n_convs - 1) * node.n) AS saved_tokens, count(*) FILTER (WHERE kids.pk IS NULL) AS n_leaves
  FROM node LEFT JOIN kids ON kids.pk = node.k JOIN p ON p.conv_id = node.conv_id AND p.d <= node.d GROUP BY p.k, p.d)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n_children, 0) AS n_children,
       below.n_leaves, CAST(below.saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node LEFT JOIN node up ON up.k = node.pk LEFT JOIN kids ON kids.pk = node.k JOIN below ON below.k = node.k AND below.d = node.d
"""


def _divergence(p: str, q: str) -> str:
    return f"({p} - {q}) * ({p} - {q}) // ({p} + {q})"


_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_lower("coalesce(text, '')")} AS text
  FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY lang, source),
share AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (g.total + 2 * g.v) AS BIGINT) AS p,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (kept.n + 2) // (v.total + 2 * v.v) AS BIGINT) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum({_divergence('x.p', 'y.p')}), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN share x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN share y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
term AS (SELECT lang, source, term AS item, {_divergence('p', 'q')} AS value FROM share WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 10
"""

LLM_SQL: dict[str, str] = {
    "op2_decontamination": _DECONTAMINATION,
    "op4_mixture": _MIXTURE,
    "op5_substring_dedup": _SUBSTRINGS,
    "op6_licenses": _LICENSES,
    "op8_near_duplicates": _NEAR_DUPLICATES,
    "op10_url_filter": _URLS,
    "op12_prefix_trie": _TRIE,
    "op13_source_divergence": _DIVERGENCE,
}
