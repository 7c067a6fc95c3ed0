"""DuckDB SQL with the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, list_aggregate(ws[i : i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (
  SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, link.v FROM reach JOIN link ON link.u = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, r.c = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


OP1 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
top AS (SELECT payload_digest AS digest, max(page_id) AS largest FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN largest IS NOT NULL AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM p LEFT JOIN top ON digest = payload_digest AND payload_bytes >= 1000
"""

OP3 = """
WITH usable AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM usable),
numbered AS (SELECT vec_id, v, row_number() OVER (ORDER BY vec_id, v) AS r FROM whole),
asking AS (SELECT vec_id, max(v) AS v FROM whole WHERE vec_id % 50 = 0 GROUP BY vec_id),
q AS (SELECT vec_id, len(v) AS n, unnest(range(len(v))) AS i, unnest(v) AS c FROM asking),
parts AS (SELECT vec_id, r, len(v) AS n, unnest(range(len(v))) AS i, unnest(v) AS c FROM numbered),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, b.r, CAST(sum(a.c * b.c) AS BIGINT) AS score
  FROM q a JOIN parts b ON a.i = b.i AND a.n = b.n AND a.vec_id <> b.vec_id GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


OP12 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({_LOWER.replace('text', "coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
  SELECT lang, k AS words, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM ws, (SELECT unnest([1, 2, 3, 4]) AS k) sizes WHERE len(w) >= k)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM runs GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a FROM f WHERE words > 1 AND f >= 30),
inside AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN c AS x ON x.lang = c.lang AND x.words > c.words
    AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' ') AND 100::HUGEINT * x.a >= 80::HUGEINT * c.a),
kept AS (SELECT c.* FROM c ANTI JOIN inside ON inside.lang = c.lang AND inside.phrase = c.phrase),
cuts AS (
  SELECT lang, phrase, a, k, list_aggregate(w[1 : k], 'string_agg', ' ') AS head,
         list_aggregate(w[k + 1 :], 'string_agg', ' ') AS tail
  FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = head JOIN f r ON r.lang = cuts.lang AND r.phrase = tail
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


_CRC32 = """
xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''),
      lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, op: CASE WHEN op >= 0 THEN xor(a, op)
                       ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END) END), 4294967295::BIGINT)
"""

OP13 = f"""
WITH t AS (
  SELECT conv_id AS c, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS e, strlen(coalesce(text, '')) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, {_CRC32.format('c')} % 9 AS h, c - c % 5 AS base FROM (SELECT DISTINCT c FROM t) ids),
head AS (SELECT convs.c, pos, e, bytes FROM convs JOIN t ON t.c = base AND pos <= h),
own AS (SELECT convs.c, 9 + pos AS pos, e, bytes FROM convs JOIN t ON t.c = convs.c AND pos > h),
r AS (
  SELECT c, row_number() OVER w AS depth, string_agg(e, '') OVER w AS path, bytes
  FROM (SELECT * FROM head UNION ALL SELECT * FROM own) turns
  WINDOW w AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, 0, '', 0 FROM convs),
last AS (SELECT c, max(depth) AS n FROM r GROUP BY c),
node AS (
  SELECT depth, path, min(r.c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(r.c AS VARCHAR) END, ',' ORDER BY r.c), '')) AS ends_sha256
  FROM r JOIN last ON last.c = r.c GROUP BY depth, path),
kids AS (
  SELECT p.depth, p.path, count(k.depth) AS n_children FROM node p
  LEFT JOIN node k ON k.depth = p.depth + 1 AND substr(k.path, 1, 32 * p.depth::BIGINT) = p.path GROUP BY ALL),
owned AS (SELECT node.*, n_children FROM node JOIN kids ON kids.depth = node.depth AND kids.path = node.path),
below AS (
  SELECT d AS depth, substr(path, 1, 32 * d) AS path, count(CASE WHEN n_children = 0 THEN 1 END) AS n_leaves,
         sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth::BIGINT + 1)) AS d FROM owned) every GROUP BY ALL)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, o.ends_sha256
FROM owned o JOIN below b ON b.depth = o.depth AND b.path = o.path
LEFT JOIN owned p ON p.depth = o.depth - 1 AND p.path = substr(o.path, 1, 32 * (o.depth::BIGINT - 1))
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1, "op3_mtree_top_k": OP3, "op8_minhash_near_dedup": OP8, "op12_collocations": OP12,
            "op13_prefix_trie": OP13}
