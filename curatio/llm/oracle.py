"""DuckDB SQL of the registered operator queries that SQL can express. Each
states the result anew, from the contract, by plain joins."""

from __future__ import annotations


def crc32_table() -> list[int]:
    out = []
    for k in range(256):
        for _ in range(8):
            k = (k >> 1) ^ (0xEDB88320 if k & 1 else 0)
        out.append(k)
    return out


def crc32(text: str) -> str:
    """CRC-32 of a string expression of ASCII characters."""
    table = ",".join(map(str, crc32_table()))
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            f"lambda z: ascii(z)::BIGINT)), lambda a, z: xor(a // 256, ([{table}]::BIGINT[])[(xor(a, z) & 255) + 1])), "
            "4294967295::BIGINT)")


PREFIX_TRIE = rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
         struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS m
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(m ORDER BY i) AS turns FROM t GROUP BY c),
k AS (SELECT c, turns, CASE WHEN c % 20 = 0 THEN 0 ELSE {crc32("c::VARCHAR")} % 4 END AS h FROM own),
re AS (SELECT k.c, list_concat(list_slice(coalesce(b.turns, []), 1, k.h), list_slice(k.turns, k.h + 1, len(k.turns))) AS turns
       FROM k LEFT JOIN own b ON b.c = k.c - k.c % 20),
p AS (SELECT c, d, sha256(list_slice(turns, 1, d)::VARCHAR) AS k,
             CASE WHEN d > 0 THEN sha256(list_slice(turns, 1, d - 1)::VARCHAR) END AS pk,
             CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words,
             d = len(turns) AS ends
      FROM re, unnest(range(len(turns) + 1)) AS u(d)),
n AS (SELECT k, d AS depth, min(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs,
             (count(*) - 1) * max(words) AS saved,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY k, d),
kids AS (SELECT pk, count(*) AS n_children FROM n WHERE pk IS NOT NULL GROUP BY pk),
sums AS (SELECT a.k, sum(CASE WHEN kids.pk IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
         FROM n LEFT JOIN kids ON kids.pk = n.k JOIN p a ON a.c = n.conv_id AND a.d <= n.depth GROUP BY a.k)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children,
       sums.n_leaves::BIGINT AS n_leaves, sums.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN sums USING (k) LEFT JOIN kids ON kids.pk = n.k LEFT JOIN n up ON up.k = n.pk
"""

HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS s
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT pos.a AS anchor_id, pos.b AS positive_id,
       (row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY s.s DESC, s.b))::INTEGER AS rank,
       s.b AS negative_id, pos.s AS positive_score, s.s AS negative_score
FROM pos JOIN s ON s.a = pos.a AND NOT s.same AND 100 * s.s BETWEEN 30 * pos.s AND 90 * pos.s
QUALIFY rank <= 10
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
  FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
c AS (SELECT r AS a, r AS b FROM w UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM w LEFT JOIN n ON n.r = w.r JOIN c ON c.a = w.r JOIN w o ON o.r = c.b GROUP BY w.r, w.doc_id, n.n
"""

ARC_TO_WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT d, max(page_id) AS r FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN r IS NULL OR r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r <> page_id THEN r END AS refers_to
FROM p LEFT JOIN k ON k.d = p.d AND n >= 1000
"""
