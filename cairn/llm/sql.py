"""DuckDB statements that give the rows of the queries which SQL can express."""

_WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '{_WORD}')) AS l FROM d),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d),
counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM starts),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words) AND NOT (10 * n_dup_lines > 3 * n_lines)
    AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM judged
"""

#: The pages of the given tables hold no canonical link and no refresh, so the method adds no verdict to the rules'; see URL_MIRRORS.
URL_FILTERS = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, rhost || rpath AS rule, action,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, action) AS k
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT s.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND k = 1
"""

URL_MIRRORS = r"""
WITH RECURSIVE urls AS (
  SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
    regexp_replace(url, 'example\.(com|net)', 'example.org', 'g') AS target FROM pages),
named AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)
      || regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS node, target FROM urls),
ends AS (
  SELECT page_id, node, substr(target, strpos(target, '://') + 3) AS t FROM named),
edges AS (
  SELECT DISTINCT node AS a, lower(regexp_extract(t, '^[^/?#]*')) || regexp_extract(t, '^[^/?#]*([^?#]*)', 1)
      || regexp_extract(t, '^[^?#]*(\?[^#]*)', 1) AS b FROM ends WHERE node <> ''),
links AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS node, min(b) AS component FROM reached GROUP BY a),
rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
nodes AS (SELECT node FROM classes UNION SELECT node FROM ends),
fits AS (
  SELECT node, rhost || rpath AS rule, action,
    row_number() OVER (PARTITION BY node ORDER BY length(rhost || rpath) DESC, action) AS k
  FROM nodes JOIN rules ON (regexp_extract(node, '^[^/?#]*') = rhost OR ends_with(regexp_extract(node, '^[^/?#]*'), '.' || rhost))
    AND starts_with(regexp_extract(node, '^[^/?#]*([^?#]*)', 1), rpath)),
passed AS (
  SELECT component, CASE WHEN bool_or(action = 'allow') THEN 'allow' WHEN bool_or(action = 'block') THEN 'block' END AS passed
  FROM classes c LEFT JOIN fits f ON f.node = c.node AND k = 1 GROUP BY component)
SELECT page_id, c.component, rule, coalesce(action, passed, 'allow') AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN passed IS NOT NULL THEN 'alias' ELSE 'default' END AS basis
FROM ends e LEFT JOIN fits f ON f.node = e.node AND k = 1 LEFT JOIN classes c ON c.node = e.node
LEFT JOIN passed p ON p.component = c.component
"""

WARC = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, max(page_id) AS kept FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM p LEFT JOIN first ON first.digest = p.digest
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingled a JOIN shingled b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.a = d.doc_id GROUP BY d.doc_id
"""


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _alnum_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_AZ}), '{_ALNUM}')"


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte with the table of the polynomial 0xEDB88320."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    x = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, [CAST('0x' || {x}[2 * b + 1:2 * b + 2] AS BIGINT) FOR b IN range(len({x}) // 2)]), "
            f"lambda c, v: xor(c >> 8, ({table}::BIGINT[])[(xor(c, v) & 255) + 1])), 4294967295)")


RESAMPLING = rf"""
WITH d AS (SELECT doc_id, {_alnum_words('text')} AS w FROM documents),
b AS (SELECT {_alnum_words('text')} AS w FROM benchmark),
df AS (SELECT doc_id, unnest(list_concat(w, [array_to_string(w[i:i + 1], ' ') for i in range(1, len(w))],
  [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, [array_to_string(w[i:i + 1], ' ') for i in range(1, len(w))],
  [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])) AS f FROM b),
dn AS (SELECT doc_id, f, count(*) AS n FROM df GROUP BY ALL),
named AS (SELECT f FROM dn UNION SELECT f FROM bf),
placed AS (SELECT f, {_crc32('f')} % 10000 AS bucket FROM named),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dn JOIN placed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN placed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM dn JOIN placed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(w) >= 20 AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights ON weights.doc_id = d.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS r, 5 * (count(*) FILTER (fit) OVER ()) // 100 AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND r <= k THEN r END AS rank FROM ranked
"""

TRIE = rf"""
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
named AS (SELECT DISTINCT c, c - c % 20 AS b, CAST(c AS VARCHAR) AS decimals FROM o),
ids AS (SELECT c, b, {_crc32('decimals')} % 4 AS h FROM named),
g AS (SELECT ids.c, ids.h, least(h, coalesce(n, 0)) AS k FROM ids LEFT JOIN (SELECT c, count(*) AS n FROM o GROUP BY c) s ON s.c = ids.b),
r AS (
  SELECT ids.c, p, role, text FROM ids JOIN o ON o.c = ids.b AND p <= h
  UNION ALL SELECT g.c, p - h + k, role, text FROM g JOIN o ON o.c = g.c AND p > h),
seqs AS (
  SELECT ids.c, coalesce(list({{'role': role, 'text': text}} ORDER BY p) FILTER (p IS NOT NULL), []) AS s
  FROM ids LEFT JOIN r ON r.c = ids.c GROUP BY ids.c),
m AS (SELECT c, len(s) AS l, s, unnest(range(0, len(s) + 1)) AS d FROM seqs),
keyed AS (SELECT c, l, d, s[1:d] AS k FROM m),
nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n, coalesce(len(regexp_extract_all(k[d].text, '{_WORD}')), 0) AS words,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (l = d) AS ends
  FROM keyed GROUP BY d, k),
on_path AS (SELECT keyed.c, keyed.d, nodes.conv_id AS node FROM keyed JOIN nodes ON nodes.d = keyed.d AND nodes.k = keyed.k),
linked AS (SELECT nodes.*, a.node AS parent FROM nodes LEFT JOIN on_path a ON a.c = nodes.conv_id AND a.d = nodes.d - 1),
kids AS (SELECT d - 1 AS d, parent AS conv_id, count(*) AS kids FROM linked WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(kids, 0) AS kids FROM linked l LEFT JOIN kids ON kids.d = l.d AND kids.conv_id = l.conv_id),
sums AS (
  SELECT a.d, a.node AS conv_id, sum((kids = 0)::BIGINT) AS leaves, sum((n - 1) * words) AS saved
  FROM full_nodes x JOIN on_path a ON a.c = x.conv_id AND a.d <= x.d GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, parent AS parent_conv_id, CAST(n AS BIGINT) AS n_convs, CAST(kids AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_nodes f JOIN sums ON sums.d = f.d AND sums.conv_id = f.conv_id
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_alnum_words('text')} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_alnum_words('text')} AS w FROM benchmark),
held AS (
  SELECT DISTINCT item, unnest([array_to_string(w[k:k + 9], ' ') for k in range(1, greatest(len(w) - 9, 1) + 1)]) AS phrase
  FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(string_split(phrase, ' ')) AS n FROM held),
starts AS (SELECT doc_id, n, unnest([{{'s': k, 'p': array_to_string(w[k:k + n - 1], ' ')}} for k in range(1, len(w) - n + 2)]) AS x FROM d, sizes),
found AS (SELECT DISTINCT doc_id, n, x.s AS s, x.p AS phrase FROM starts WHERE x.p IN (SELECT phrase FROM held)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found JOIN held USING (phrase)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""
