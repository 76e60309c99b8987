"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

#: CRC-32 by its table: ``table(256 entries)`` as CTE crc_table(t), and the checksum of a text's UTF-8 bytes.
CRC_TABLE = """
crc_table AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(b)))"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text expression; ``t`` of crc_table is in scope."""
    bytes_of = (f"list_transform(range(octet_length(encode({text}))), lambda i: "
                f"('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::UBIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_of}), "
            f"lambda c, b: xor(c >> 8, t[(xor(c & 255, b) + 1)::INT])), 4294967295::UBIGINT)")


PREFIX_TRIE = f"""
WITH {CRC_TABLE.strip()},
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS pos,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT conv_id, list(said ORDER BY pos) AS said FROM turns GROUP BY conv_id),
headed AS (SELECT conv_id, said, ({crc32('conv_id::VARCHAR')} % 4)::INT AS h FROM whole, crc_table),
made AS (SELECT c.conv_id, list_concat(coalesce(f.said, [])[1:c.h], c.said[c.h + 1:]) AS said
  FROM headed c LEFT JOIN whole f ON f.conv_id = c.conv_id - ((c.conv_id % 20) + 20) % 20),
prefixes AS (SELECT conv_id, len(said) AS total, d, said[1:d] AS path FROM made, range(0, 1000000) r(d) WHERE d <= len(said)),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[d].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM prefixes GROUP BY path, d),
children AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path, d)),
sums AS (
  SELECT k.path[1:r.d] AS path, r.d, sum(k.saved) AS saved_tokens, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves
  FROM known k, range(0, 1000000) r(d) WHERE r.d <= k.d GROUP BY ALL)
SELECT k.conv_id, k.d AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN sums s USING (path, d) LEFT JOIN nodes p ON k.d > 0 AND p.d = k.d - 1 AND p.path = k.path[1:k.d - 1]
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE.strip()},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]{{7,}}')) AS run
  FROM documents),
hashed AS (SELECT run, copies, {crc32("id || ':' || run")} AS h FROM (SELECT id, run, count(*) AS copies FROM runs GROUP BY ALL), crc_table),
typed AS (
  SELECT copies, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(copies)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(copies) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, 10000) r(i) WHERE i <= length(word)),
near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION ALL SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
    UNION ALL SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest)),
best AS (SELECT word, count(*) AS n_near, first({{'other': other, 'n': other_n}} ORDER BY other_n DESC, encode(other)) AS b FROM near GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.other END AS form,
    CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS root FROM found WHERE form IS NOT NULL
  UNION SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NOT NULL),
tops AS (SELECT c.word, c.root FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM found LEFT JOIN tops USING (word)
"""

NEAR_DUPLICATES = """
WITH RECURSIVE
split AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, row, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
member AS (SELECT doc_id, row, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.row AS a, b.row AS b, count(*) AS same, any_value(a.n) AS an, any_value(b.n) AS bn
  FROM member a JOIN member b ON a.shingle = b.shingle AND a.row < b.row GROUP BY a.row, b.row),
links AS (SELECT a, b FROM pairs WHERE 100 * same >= 85 * (an + bn - same)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT row AS a, row AS b FROM sets UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b)
SELECT s.doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(t.doc_id) AS component_id, s.doc_id = min(t.doc_id) AS kept
FROM sets s JOIN reach r ON r.a = s.row JOIN sets t ON t.row = r.b GROUP BY s.row, s.doc_id
"""

EMBEDDING_LINKS = """
WITH RECURSIVE
vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v,
    embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AS whole FROM embeddings),
usable AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors WHERE whole AND list_dot_product(v, v) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT r.a AS vec_id, (SELECT count(*) FROM links l WHERE l.a = r.a) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r GROUP BY r.a
"""
