"""DuckDB SQL of the queries that SQL can express, for the checks."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM words
), flat AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS far FROM documents
  UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON reach.far = links.u
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(far) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

CONTAMINATED = rf"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), widths AS (
  SELECT DISTINCT least(5, len(w)) AS n FROM words WHERE kind = 'i' AND len(w) > 0
), flat AS (
  SELECT kind, id, n, unnest(list_distinct(
    list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' ')))) AS g
  FROM words CROSS JOIN widths WHERE len(w) >= n AND (kind = 'd' OR n = least(5, len(w)))
), items AS (
  SELECT id, n, g, count(*) OVER (PARTITION BY id) AS n_item FROM flat WHERE kind = 'i'
)
SELECT d.id AS doc_id, i.id AS item_id, i.n_item, count(*) AS n_shared
FROM flat d JOIN items i ON d.g = i.g AND d.n = i.n WHERE d.kind = 'd'
GROUP BY d.id, i.id, i.n_item HAVING 100 * count(*) >= 80 * i.n_item
"""

#: crc32 of the decimal digits of ``doc_id``: eight shifts a byte.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    parts = [f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


_RUN = "array_to_string(nodes[i + 1 : i + 3], '')"
_WALK = """
    array_to_string(nodes[i - i % 3 + 1 : i], '') AS l, array_to_string(nodes[i + 2 : i - i % 3 + 3], '') AS r"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce(':' || source, '-') AS s, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claim,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i
  FROM documents
), levels AS (
  SELECT s, 0 AS k, list(leaf ORDER BY i) AS nodes FROM leaves GROUP BY s
  UNION ALL
  SELECT s, k + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256({_RUN}))
  FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT s, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(s)) - 1 AS i FROM levels WHERE len(nodes) = 1
), tops AS (
  SELECT 0 AS k, list(subroot ORDER BY i) AS nodes FROM subroots
  UNION ALL
  SELECT k + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256({_RUN})) FROM tops WHERE len(nodes) > 1
), walk AS (
  SELECT doc_id, s, leaf, claim AS fold, '' AS proof, i, 0 AS k FROM leaves
  UNION ALL
  SELECT doc_id, s, leaf, sha256(l || fold || r), proof || l || r, i // 3, k + 1
  FROM (SELECT walk.*, {_WALK} FROM walk JOIN levels USING (s, k) WHERE len(nodes) > 1)
), up AS (
  SELECT walk.doc_id, walk.s, leaf, fold, proof, subroots.i AS i, 0 AS k
  FROM walk JOIN levels USING (s, k) JOIN subroots ON walk.s = subroots.s WHERE len(nodes) = 1
  UNION ALL
  SELECT doc_id, s, leaf, sha256(l || fold || r), proof || l || r, i // 3, k + 1
  FROM (SELECT up.*, {_WALK} FROM up JOIN tops USING (k) WHERE len(nodes) > 1)
)
SELECT up.doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
  fold = nodes[1] AS verified
FROM up JOIN tops USING (k) JOIN subroots ON up.s = subroots.s WHERE len(nodes) = 1
"""
