"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from footfall.llm import quality_rules as q

ORACLE: dict[str, str] = {}

def _value(value: str) -> str:
    return "(" + value.replace("DIV", "//") + ")"


def _blend(value: str, n: str, coarser: str) -> str:
    return f"({n} * {value} + {q.PRIOR} * {coarser}) // ({n} + {q.PRIOR})"


def _median(keys: str) -> str:
    comma = f"{keys}, " if keys else ""
    return f"""
SELECT {comma}rule, sum(n)::BIGINT AS n, min(own) FILTER (WHERE 2 * reached > total) AS fence
FROM (SELECT *, sum(length(bin(n))) OVER (PARTITION BY {comma}rule ORDER BY own, n ROWS UNBOUNDED PRECEDING) AS reached,
             sum(length(bin(n))) OVER (PARTITION BY {comma}rule) AS total FROM spans)
GROUP BY ALL"""


_VALUES = "\nUNION ALL ".join(
    f"SELECT lang, source, '{name}' AS rule, {_value(value)} AS value FROM good" for name, value, _ in q.RULES
)
_LEAST = " ".join(f"WHEN '{name}' THEN {least}" for name, _, least in q.RULES)
_JUDGE = "\nUNION ALL ".join(
    f"SELECT rid, lang, source, '{name}' AS rule, {_value(value)} AS value FROM good" for name, value, _ in q.RULES
)

ORACLE["op9_quality_rules"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source FROM documents),
words AS (
  SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM docs),
windows AS (
  SELECT rid, i, array_to_string(w[i : i + {q.WINDOW - 1}], ' ') AS x
  FROM (SELECT rid, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM words WHERE len(w) >= {q.WINDOW})),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {q.WINDOW})) AS p FROM again) GROUP BY rid),
measures AS (
  SELECT d.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(text) - length(regexp_replace(text, '[!?;:=_~^+/\\\\@]', '', 'g')))::BIGINT AS n_marks,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         len([i FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]])::BIGINT AS n_echoes,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM docs d JOIN words USING (rid) LEFT JOIN covered c ON c.rid = d.rid),
based AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT} * n_words AS base_failed FROM measures),
good AS (SELECT * FROM based WHERE NOT base_failed),
vals AS ({_VALUES}),
cells AS (
  SELECT lang, source, rule, (value >> s) << s AS cell, count(*) AS n
  FROM (SELECT *, greatest(length(bin(value)) - {q.SKETCH_BITS}, 0) AS s FROM vals) GROUP BY ALL),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY cell) AS reached,
         sum(n) OVER (PARTITION BY lang, source, rule) AS total FROM cells),
quantile AS (
  SELECT lang, source, rule, max(total)::BIGINT AS n, min(cell) FILTER (WHERE 100 * reached >= 10 * total) AS q10,
         min(cell) FILTER (WHERE 100 * reached >= 50 * total) AS q50, min(cell) FILTER (WHERE 100 * reached >= 90 * total) AS q90
  FROM ranked GROUP BY lang, source, rule),
spans AS (
  SELECT lang, source, rule, n, q90 + {q.FENCE} * (q90 - q50) + least_ AS own, q50 + {q.FENCE} * (q50 - q10) + least_ AS mirrored
  FROM (SELECT *, CASE rule {_LEAST} END AS least_ FROM quantile)),
l AS ({_median("lang")}),
a AS ({_median("")}),
coarse AS (
  SELECT spans.*, {_blend("l.fence", "l.n", "a.fence")} AS coarse
  FROM spans JOIN l ON spans.rule = l.rule AND spans.lang IS NOT DISTINCT FROM l.lang JOIN a ON spans.rule = a.rule),
picked AS (
  SELECT lang, source, rule, least({_blend("own", "n", "coarse")}, greatest({_blend("mirrored", "n", "coarse")}, coarse)) AS fence
  FROM coarse),
judged AS (
  SELECT rid, bool_and(value <= fence) AS fine
  FROM ({_JUDGE}) v JOIN picked p
    ON v.rule = p.rule AND v.lang IS NOT DISTINCT FROM p.lang AND v.source IS NOT DISTINCT FROM p.source GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(fine, FALSE) AS kept
FROM based LEFT JOIN judged USING (rid)"""

ORACLE["op6_ngram_jaccard_join"] = """
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
shingles AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.rid AS a, b.rid AS b, a.n AS na, b.n AS nb, count(*) AS i FROM shingles a JOIN shingles b USING (x)
  WHERE a.rid != b.rid AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) GROUP BY ALL),
edges AS (SELECT a, b FROM common WHERE 100 * i >= 90 * (na + nb - i)),
reach AS (SELECT rid AS a, rid AS b FROM docs UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM sets s JOIN reach r ON r.a = s.rid JOIN docs t ON t.rid = r.b GROUP BY s.rid, s.doc_id, len(s.s)"""

_RECORD = """concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:md5:', rid,
  '>', chr(13), chr(10), 'WARC-Date: 1970-01-01T00:00:00Z', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10),
  'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10), html,
  chr(13), chr(10), chr(13), chr(10))"""
ORACLE["op10_merkle_fixity"] = f"""
WITH pages_ AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         md5(concat(page_id, '|', coalesce(url, ''))) AS rid FROM pages),
held AS (SELECT page_id, rid, {_RECORD} AS r FROM pages_),
placed AS (
  SELECT page_id, rid AS record_id, row_number() OVER (ORDER BY page_id) - 1 AS position,
         coalesce(sum(strlen(r)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_,
         strlen(r)::BIGINT AS length, sha256(r) AS sha256,
         CASE WHEN page_id % 211 = 5 THEN 'missing' WHEN page_id % 97 = 13 THEN 'corrupt' ELSE 'ok' END AS status FROM held),
added AS (
  SELECT page_id, url, html, md5(concat(page_id, '|', url)) AS rid
  FROM (SELECT -page_id AS page_id, url, html FROM pages_ WHERE page_id % 503 = 7))
SELECT page_id, record_id, position, offset_ AS "offset", length, sha256, status FROM placed
UNION ALL SELECT page_id, rid, NULL, NULL, strlen({_RECORD})::BIGINT, sha256({_RECORD}), 'extra' FROM added"""

# CRC-32 (the reflected polynomial 3988292384) of the decimal digits of an id.
_CRC_TABLE = """SELECT list(v ORDER BY i) AS crc FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i))"""
_CRC = """xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
  lambda v, x: xor(v >> 8, crc[(xor(v, x) & 255) + 1])), 4294967295)"""
ORACLE["op12_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crcs AS ({_CRC_TABLE}),
heads AS (SELECT conv_id, w, {_CRC} % 6 AS h FROM own, crcs),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.w, [])[1 : c.h], c.w[c.h + 1 :]) AS w
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
firsts AS (SELECT conv_id, w[1 : d] AS k, d = len(w) AS whole FROM (SELECT *, unnest(range(len(w) + 1)) AS d FROM built)),
nodes AS (
  SELECT k, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256
  FROM firsts GROUP BY k),
above AS (SELECT k, conv_id, n_convs, k[1 : len(k) - 1] AS up FROM nodes WHERE len(k) > 0),
kids AS (SELECT up, count(*) AS n_children FROM above GROUP BY up),
worth AS (
  SELECT n.k, (kids.up IS NULL)::BIGINT AS leaf, CASE WHEN len(n.k) > 0 THEN (n_convs - 1) * length(n.k[-1].t) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids ON kids.up = n.k),
totals AS (
  SELECT k[1 : d] AS k, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(len(k) + 1)) AS d FROM worth) GROUP BY ALL)
SELECT n.conv_id, len(n.k)::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN totals USING (k) LEFT JOIN kids ON kids.up = n.k LEFT JOIN nodes p ON len(n.k) > 0 AND p.k = n.k[1 : len(n.k) - 1]"""

_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
ORACLE["op13_lexical_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
items AS (
  SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
totals AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
asked AS (SELECT iid, term, count(*) AS times FROM (SELECT iid, unnest(w) AS term FROM items) GROUP BY ALL),
lengths AS (SELECT rid, doc_id, 25 + (75 * len(w) * n_docs) // n_terms AS m FROM docs, totals WHERE len(w) > 0),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, totals),
scores AS (
  SELECT iid, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (rid) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scores JOIN items USING (iid) WHERE score > 0 QUALIFY rank <= 10"""
