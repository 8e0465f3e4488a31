"""SQL twins of the text queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# A mark of a turn has 12 and 10 characters, and two line feeds; "<|" in a text grows by one backslash.
CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, 24 + length(text) + len(regexp_extract_all(text, '<\\*\|'))
    + length(role) + len(regexp_extract_all(role, '[\\\n]')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

LEAKS = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wanted),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, n, item FROM places JOIN wanted USING (g, n)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

# CRC-32 by a table of 256 steps, over a list of bytes.
_CRC_STEPS = """(SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS t(i)))"""


def _crc32(bytes_: str, steps: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda a, b: xor(a >> 8, {steps}[(xor(a, b) & 255) + 1])), 4294967295)"


_DIGITS = "list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"

TRIE = f"""
WITH steps AS (SELECT {_CRC_STEPS} AS s),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32(_DIGITS, "s")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), steps),
heads AS (
  SELECT c.conv_id, i AS depth, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND i <= h),
taken AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads UNION ALL
  SELECT t.conv_id, coalesce(n, 0) + i - h, role, text
  FROM turns t JOIN convs USING (conv_id) LEFT JOIN taken USING (conv_id) WHERE i > h),
named AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS size,
    md5(string_agg(md5(md5(role) || text), '' ) OVER (PARTITION BY conv_id ORDER BY depth)) AS name FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT min(conv_id) AS conv_id, depth, name, count(*) AS n, any_value(size) AS size FROM named GROUP BY depth, name),
lasts AS (SELECT conv_id, max(depth) AS depth FROM named GROUP BY conv_id),
ends AS (
  SELECT depth, name, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
  FROM lasts JOIN named USING (conv_id, depth) GROUP BY depth, name),
up AS (
  SELECT x.name, x.depth, p.conv_id AS parent, p.name AS parent_name
  FROM nodes x JOIN named r ON r.conv_id = x.conv_id AND r.depth = x.depth - 1 JOIN nodes p ON p.depth = r.depth AND p.name = r.name),
children AS (SELECT parent_name AS name, depth - 1 AS depth, count(*) AS n_children FROM up GROUP BY ALL),
below AS (
  SELECT r.depth, r.name, sum((y.n - 1) * y.size) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
  FROM nodes y JOIN named r ON r.conv_id = y.conv_id AND r.depth <= y.depth
    LEFT JOIN children c ON c.depth = y.depth AND c.name = y.name GROUP BY r.depth, r.name)
SELECT x.conv_id, x.depth::BIGINT AS depth, parent AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM nodes x LEFT JOIN up USING (depth, name) LEFT JOIN children USING (depth, name) LEFT JOIN ends USING (depth, name)
  JOIN below USING (depth, name)"""

# Letters beyond ASCII are two bytes, of which the first is 195.
_KEY_BYTES = """list_transform(string_split(doc_id::VARCHAR || ':', ''), lambda c: ascii(c)::BIGINT)
    || flatten(list_transform(string_split(run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c) - 64] END))"""

SPELLING = rf"""
WITH RECURSIVE steps AS (SELECT {_CRC_STEPS} AS s),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32(_KEY_BYTES, "s")} AS h FROM runs, steps),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, n, k, left(word, k) || substr(word, k + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.k = y.k AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM shorter x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, y.n, x.word, x.n FROM shorter x JOIN words y ON x.rest = y.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
known AS (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, form AS further FROM known
  UNION ALL SELECT w.word, k.word, k.form FROM walk w JOIN known k ON k.word = w.further)
SELECT word, form, root, n, n_near, form_n FROM known JOIN (SELECT word, root FROM walk WHERE further IS NULL) USING (word)"""

ORACLES = {"op13_spelling_variants": SPELLING, "op11_conversation_trie": TRIE, "op2_chat_format": CHAT, "op4_decontamination": LEAKS}
