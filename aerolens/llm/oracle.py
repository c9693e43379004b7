"""DuckDB SQL for those text queries that SQL can express, the plain way: all
shingles, windows and pairs. Language model, tokenizer, match positions of
regular expressions, edit joins and alignments are tested by brute force."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
component AS (SELECT id, MIN(other) AS component_id FROM reach GROUP BY id)
"""

_MINHASH = f"""WITH RECURSIVE
worded AS (SELECT doc_id AS id, COALESCE(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT id, w, UNNEST(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT w.id, COUNT(shingle) AS n FROM worded w LEFT JOIN shingles s ON w.id = s.id GROUP BY w.id),
nodes AS (SELECT id FROM worded),
links AS (
  SELECT a.id AS a, b.id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.id < b.id
  JOIN sizes x ON x.id = a.id JOIN sizes y ON y.id = b.id
  GROUP BY a.id, b.id, x.n, y.n
  HAVING 100 * COUNT(*) >= 80 * (x.n + y.n - COUNT(*))),
{_COMPONENTS}
SELECT c.id AS doc_id, n AS n_shingles, component_id, c.id = component_id AS kept
FROM component c JOIN sizes s ON c.id = s.id"""

_SUBSTRING = f"""WITH worded AS (
  SELECT doc_id, COALESCE(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS window_hash
  FROM (SELECT doc_id, w, UNNEST(range(1, len(w) - 33)) AS i FROM worded WHERE len(w) >= 35)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY window_hash) > 1),
gone AS (SELECT DISTINCT doc_id, UNNEST(range(i, i + 35)) AS k FROM repeated),
each AS (SELECT doc_id, UNNEST(w) AS word, UNNEST(range(1, len(w) + 1)) AS k FROM worded),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.k) AS kept, COUNT(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.k = g.k GROUP BY e.doc_id)
SELECT w.doc_id, len(w) AS n_words, len(w) - COALESCE(n, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k ON w.doc_id = k.doc_id"""

_SUFFIX = """WITH hexed AS (
  SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h, octet_length(encode(COALESCE(text, ''))) AS n FROM documents),
strings AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, UNNEST(range(0, n - 49)) AS p FROM hexed WHERE n >= 50)),
seen AS (SELECT doc_id, p FROM strings QUALIFY doc_id > MIN(doc_id) OVER (PARTITION BY s)),
gone AS (SELECT DISTINCT doc_id, UNNEST(range(p, p + 50)) AS k FROM seen),
runs AS (
  SELECT doc_id, COUNT(*) AS n_removed, COUNT(*) FILTER (WHERE previous IS NULL OR previous < k - 1) AS n_spans
  FROM (SELECT doc_id, k, LAG(k) OVER (PARTITION BY doc_id ORDER BY k) AS previous FROM gone) GROUP BY doc_id),
each AS (SELECT doc_id, h, UNNEST(range(0, n)) AS k FROM hexed),
kept AS (
  SELECT e.doc_id, string_agg(substr(h, 2 * e.k + 1, 2), '' ORDER BY e.k) AS kept
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.k = g.k GROUP BY e.doc_id)
SELECT x.doc_id, CAST(n AS BIGINT) AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
       sha256(unhex(COALESCE(kept, ''))) AS kept_sha256
FROM hexed x LEFT JOIN runs r ON x.doc_id = r.doc_id LEFT JOIN kept k ON x.doc_id = k.doc_id"""

_EMBEDDING = f"""WITH RECURSIVE
nodes AS (SELECT vec_id AS id FROM embeddings),
sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
{_COMPONENTS}
SELECT c.id AS vec_id, (SELECT COUNT(*) FROM both_ways l WHERE l.a = c.id) AS n_links, component_id,
       c.id = component_id AS kept
FROM component c"""

_DECONTAMINATION = f"""WITH
worded AS (SELECT doc_id, COALESCE(regexp_extract_all({_LOWER}, '{_ALNUM}'), []) AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT item, w, least(10, len(w)) AS size, UNNEST(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)),
windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, UNNEST(range(1, len(w) - size + 2)) AS i
        FROM worded, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, w.size, item FROM windows w JOIN item_windows USING (s, size)),
covered AS (
  SELECT doc_id, COUNT(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, UNNEST(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM worded w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN found f ON w.doc_id = f.doc_id"""


def _moved(before: str, n: int) -> str:
    """A Lloyd round: the nearest entry of each part, then the floored means."""
    return f"""
far{n} AS (
  SELECT r, p, e, SUM((x - c) * (x - c)) AS d FROM comp JOIN {before} USING (p, k) GROUP BY r, p, e),
near{n} AS (SELECT r, p, arg_min(e, d * 64 + e) AS e, MIN(d) AS d FROM far{n} GROUP BY r, p),
mean{n} AS (
  SELECT p, e, k, CAST(floor(SUM(x) / COUNT(*)) AS BIGINT) AS c
  FROM near{n} JOIN comp USING (r, p) GROUP BY p, e, k),
book{n} AS (
  SELECT b.p, b.e, b.k, COALESCE(m.c, b.c) AS c
  FROM {before} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e AND b.k = m.k)"""


_CODES = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS (
  SELECT r, CAST(floor(i / (len(v) / 16)) AS INTEGER) AS p, i % (len(v) // 16) AS k, v[i + 1] AS x
  FROM (SELECT r, v, UNNEST(range(0, len(v))) AS i FROM kept)),
book0 AS (SELECT p, r - 1 AS e, k, x AS c FROM comp WHERE r <= 64),
{_moved("book0", 1)},
{_moved("book1", 2)},
{_moved("book2", 3)},
coded AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(SUM(d) AS BIGINT) AS error
  FROM near3 GROUP BY r),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, k)) AS s FROM book2)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       s AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": _MINHASH,
        "op4_substring_dedup": _SUBSTRING,
        "op5_suffix_dedup": _SUFFIX,
        "op7_embedding_dedup": _EMBEDDING,
        "op10_decontamination": _DECONTAMINATION,
        "op12_vector_codes": _CODES,
    }
