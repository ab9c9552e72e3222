"""DuckDB SQL for the operators' queries, over the same tables."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, i, m, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS span
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)
),
h AS (SELECT dw.doc_id, dw.i, dw.m, iw.item_id FROM dw JOIN iw USING (m, span)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
g AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + least(len(w), 4) - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM g AS a JOIN g AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
e AS (
  SELECT p.a, p.b FROM p JOIN n AS x ON x.doc_id = p.a JOIN n AS y ON y.doc_id = p.b
  WHERE 100 * p.k >= 85 * (x.n + y.n - p.k)
),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents AS d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) AS c USING (doc_id)
"""

OP7 = """
WITH c AS (
  SELECT vec_id, i, CAST(floor(64 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings
        WHERE embedding IS NOT NULL)
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY 1, 2
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLE = {"op1_decontamination": OP1, "op7_topk": OP7, "op8_jaccard_join": OP8}

OP11 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 34], 'string_agg', ' ') AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)
),
r AS (SELECT v FROM v GROUP BY v HAVING count(*) > 1),
h AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM v JOIN r USING (v)),
k AS (
  SELECT doc_id, count(h.i) AS n, string_agg(x, ' ' ORDER BY i) FILTER (h.i IS NULL) AS kept
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w) LEFT JOIN h USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

# A decimal number's crc32: a table of 256 steps, folded over its digits.
_CRC = """
RECURSIVE step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM step WHERE k < 8
),
crc_steps AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
crc AS (
  SELECT id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT {id} AS id FROM {source}), crc_steps
)"""

_LEAF = " || ".join(
    f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars")
)
_TEXT = "coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || {t}, '-')"


def _climb(tree: str, start: str, out: str) -> str:
    """Levels of trees over ``start`` (tree, place, digest), and each first node's siblings, level by level."""
    return f"""
{out}(tree, level, place, digest, width) AS (
  SELECT {tree}, 0, place, digest, count(*) OVER (PARTITION BY {tree}) FROM {start}
  UNION ALL
  SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (max(width) + 15) // 16
  FROM {out} WHERE width > 1 GROUP BY tree, level, place // 16
)"""


def _siblings(levels: str, start: str) -> str:
    return f"""
  SELECT s.id, l.level, list(l.digest ORDER BY l.place) FILTER (l.place <> s.place // CAST(16 ** l.level AS BIGINT)) AS kin,
    count(*) FILTER (l.place < s.place // CAST(16 ** l.level AS BIGINT)) AS slot
  FROM {start} AS s JOIN {levels} AS l ON l.tree IS NOT DISTINCT FROM s.tree AND l.width > 1
    AND l.place // 16 = s.place // CAST(16 ** (l.level + 1) AS BIGINT)
  GROUP BY s.id, l.level"""


OP12 = f"""
WITH {_CRC.format(id="doc_id", source="documents")},
d AS (
  SELECT doc_id, source AS tree, sha256({_LEAF} || {_TEXT.format(t="text")}) AS digest,
    sha256({_LEAF} || {_TEXT.format(t=f"translate(text, '{UPPER}', '{UPPER.lower()}')")}) AS changed
  FROM documents
),
leaves AS (
  SELECT doc_id AS id, tree, digest, CASE WHEN crc % 5 = 0 THEN changed ELSE digest END AS changed,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place
  FROM d LEFT JOIN crc ON crc.id = d.doc_id
), {_climb("tree", "leaves", "own")},
subroots AS (
  SELECT tree AS id, 0 AS tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place FROM own WHERE width = 1
), {_climb("tree", "subroots", "tops")},
kin AS (
  SELECT id, level, coalesce(kin, []) AS kin, slot FROM ({_siblings("own", "leaves")})
  UNION ALL
  SELECT l.id, 1000 + k.level, coalesce(k.kin, []), k.slot FROM leaves AS l JOIN ({_siblings("tops", "subroots")}) AS k
    ON k.id IS NOT DISTINCT FROM l.tree
),
ordered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level) AS step FROM kin),
climbed(id, step, digest) AS (
  SELECT id, 0, changed FROM leaves
  UNION ALL
  SELECT c.id, c.step + 1, sha256(array_to_string(list_concat(list_append(o.kin[1:o.slot], c.digest), o.kin[o.slot + 1:]), ''))
  FROM climbed AS c JOIN ordered AS o ON o.id = c.id AND o.step = c.step + 1
),
proofs AS (SELECT id, sha256(string_agg(array_to_string(kin, ''), '' ORDER BY step)) AS proof FROM ordered GROUP BY id),
root AS (SELECT digest FROM tops WHERE width = 1)
SELECT l.id AS doc_id, l.digest AS leaf, s.digest AS subroot, root.digest AS root,
  coalesce(p.proof, sha256('')) AS proof_sha256, f.folded AS folded_root, f.folded = root.digest AS verified
FROM leaves AS l JOIN subroots AS s ON s.id IS NOT DISTINCT FROM l.tree
JOIN (SELECT id, max_by(digest, step) AS folded FROM climbed GROUP BY id) AS f ON f.id = l.id
LEFT JOIN proofs AS p ON p.id = l.id, root
"""

OP13 = f"""
WITH {_CRC.format(id="conv_id", source="conversations")},
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS at FROM conversations
),
c AS (SELECT id AS conv_id, crc % 4 AS h, id - id % 20 AS base FROM crc WHERE id IS NOT NULL),
b AS (SELECT c.conv_id, c.h, c.base, (SELECT count(*) FROM t WHERE t.conv_id = c.base AND t.at <= c.h) AS b FROM c),
r AS (
  SELECT b.conv_id, t.at AS depth, t.role, t.text FROM b JOIN t ON t.conv_id = b.base AND t.at <= b.h
  UNION ALL
  SELECT b.conv_id, t.at - b.h + b.b, t.role, t.text FROM b JOIN t ON t.conv_id = b.conv_id AND t.at > b.h
),
p AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
    string_agg(len(role) || ':' || role || len(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
    string_agg(len(role) || ':' || role || len(text) || ':' || text, '') OVER (
      PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c
),
q AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends, CASE WHEN depth > 0 THEN coalesce(above, '') END AS up FROM p),
n AS (
  SELECT path, depth, up, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * max(words) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM q GROUP BY path, depth, up
),
k AS (SELECT up AS path, depth - 1 AS depth, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(k.n, 0) AS children FROM n LEFT JOIN k USING (path, depth)),
s AS (
  SELECT x.path, x.depth, sum(y.saved) AS saved, count(*) FILTER (y.children = 0) AS leaves
  FROM m AS x JOIN m AS y ON y.depth >= x.depth AND starts_with(y.path, x.path) GROUP BY 1, 2
)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, m.n AS n_convs, m.children AS n_children,
  s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s USING (path, depth) LEFT JOIN n AS u ON u.path = m.up AND u.depth = m.depth - 1
"""

ORACLE |= {"op11_substring_dedup": OP11, "op12_merkle_manifest": OP12, "op13_prefix_trie": OP13}
