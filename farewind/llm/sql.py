"""DuckDB SQL that gives the rows of the registered queries which SQL can express."""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
         sha256(payload) AS address FROM p
), f AS (SELECT address, min(page_id) AS first_id FROM d GROUP BY address)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT)
             >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (address)
"""

_WORDS10 = """regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

DECONTAMINATE = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS10} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
      lambda i: array_to_string(w[i : i + 9], ' '))) AS win
  FROM b WHERE len(w) > 0
), d AS (SELECT doc_id, {_WORDS10} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i0, w
  FROM d, sizes WHERE len(w) >= size
), keyed AS (
  SELECT doc_id, size, i0, array_to_string(w[i0 : i0 + size - 1], ' ') AS win FROM dw
), hit AS (
  SELECT doc_id, i0, k.size, item FROM keyed k JOIN bw ON bw.win = k.win AND bw.size = k.size
), pos AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i0, i0 + size)) AS p FROM hit) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

CHAT = """
WITH o AS (
  SELECT conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    list(struct_pack(r := role, t := text) ORDER BY pos) AS said,
    string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
      || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
  FROM o GROUP BY conv_id
), u AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_copies, said, any_value(n_turns) AS n_turns,
    any_value(rendered) AS rendered
  FROM c GROUP BY said
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, n_copies, rendered FROM u
WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.said[1] = u.said[1] AND c.n_turns > u.n_turns
    AND c.said[1 : u.n_turns] = u.said)
"""

_WORD = r"[^\x20\x09-\x0D]+"
_LINE_OK = r"""(
  (regexp_matches(l, '[.!?…"''”’»)\]。！？][\x20\x09-\x0D]*$') OR len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 12)
  AND NOT regexp_matches(lower(l), '(?:\S*\s*[|»›→•·>]\s*\S+){3,}|^\s*(?:home|menu|login|log in|sign in|sign up|next|previous|back to top|read more|share)\s*$')
  AND NOT (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) < 30 AND regexp_matches(lower(l), 'all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|uses? cookies|enable javascript|lorem ipsum|click here|subscribe to our|©|licensed under|released under')))"""

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '{_WORD}')) AS ls
  FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i0, w FROM d WHERE len(w) >= 8
), keyed AS (SELECT doc_id, i0, array_to_string(w[i0 : i0 + 7], ' ') AS k FROM win),
rep AS (
  SELECT doc_id, i0 FROM keyed
  QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
), cov AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest(range(i0, i0 + 8)) AS p FROM rep) GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    list_sum(list_transform(list_filter(ls, lambda l: {_LINE_OK}),
      lambda l: len(regexp_extract_all(l, '{_WORD}')))) AS n_kept
  FROM d LEFT JOIN cov USING (doc_id)
), r AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * coalesce(n_kept, 0) >= 40 * n_words AS kept
FROM r
"""

NEAR_DUPS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM b JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)
), both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT a AS node, a AS reached FROM both_ways
  UNION
  SELECT r.node, e.b FROM r JOIN both_ways e ON e.a = r.reached
), c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
  coalesce(component_id, w.doc_id) AS component_id,
  coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.node = w.doc_id
"""

#: crc32 of a BLOB's hexadecimal digits, as a macro body over the name ``hex``.
_CRC_TABLE = """(SELECT list(t ORDER BY b) FROM (
  SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda x, i: xor(x >> 1, (x & 1) * 3988292384)) AS t FROM range(256) r(b)))"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of the SQL expression ``text``; needs a column crc_table."""
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({text}))),
      lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
      lambda s, b: xor(s >> 8, crc_table[(xor(s, b) & 255) + 1])), 4294967295)"""


PREFIX_TRIE = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS crc_table),
o AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (SELECT conv_id, count(*) AS n_turns FROM o GROUP BY conv_id),
h AS (
  SELECT conv_id AS c, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM n, crc
), x AS (
  SELECT c, pos, r, t FROM h JOIN o ON o.conv_id = base AND pos <= h
  UNION ALL SELECT c, pos, r, t FROM h JOIN o ON o.conv_id = c AND pos > h
), s AS (
  SELECT c, coalesce(said, []) AS said
  FROM h LEFT JOIN (SELECT c, list(struct_pack(r := r, t := t) ORDER BY pos) AS said FROM x GROUP BY c) USING (c)
), p AS (SELECT c, len(said) AS size, said, unnest(range(len(said) + 1)) AS d FROM s),
nodes AS (
  SELECT d, said[1 : d] AS path, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends_sha256
  FROM p GROUP BY d, path
), told AS (
  SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(path[d].t)) END AS saves,
    NOT EXISTS (SELECT 1 FROM nodes k WHERE k.d = nodes.d + 1 AND k.path[1 : nodes.d] = nodes.path) AS leaf
  FROM nodes
)
SELECT a.conv_id, a.d AS depth, up.conv_id AS parent_conv_id, a.n_convs,
  count(*) FILTER (WHERE b.d = a.d + 1) AS n_children, count(*) FILTER (WHERE b.leaf) AS n_leaves,
  CAST(sum(b.saves) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM told a JOIN told b ON b.d >= a.d AND b.path[1 : a.d] = a.path
LEFT JOIN nodes up ON up.d = a.d - 1 AND up.path = a.path[1 : a.d - 1]
GROUP BY a.d, a.path, a.conv_id, up.conv_id, a.n_convs, a.ends_sha256
"""

SPELLING = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS crc_table),
runs AS (
  SELECT doc_id, translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS u FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), 'None') || ':' || run")} AS h
  FROM runs, crc WHERE length(run) >= 7
), v AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
    || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), less AS (
  SELECT DISTINCT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM v)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM less WHERE rest IN (SELECT word FROM v)
  UNION SELECT rest, word FROM less WHERE rest IN (SELECT word FROM v)
), best AS (
  SELECT a AS word, count(*) AS n_near,
    min(struct_pack(m := -v.n, w := encode(b))) AS top
  FROM pairs JOIN v ON v.word = b GROUP BY a
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top.m >= 10 * v.n THEN decode(top.w) END AS form, CASE WHEN -top.m >= 10 * v.n THEN -top.m END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS root, form AS next FROM f
    UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.next
  ) SELECT word, root FROM c WHERE next IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM f JOIN chain USING (word)
"""
