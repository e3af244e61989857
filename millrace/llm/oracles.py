"""The same results as SQL, for the queries that SQL can express.

The classifier, the semantic search, the tokenizer, the keyed permutation, the optimal buckets and the content-defined
chunks have none; tests/llm checks them against brute force, round trips or held-out labels.
"""

from __future__ import annotations

import string

_REACH = """
reach AS (SELECT {id} AS x, {id} AS y FROM {table} UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit; 3988292384 is the reversed polynomial."""
    step = "xor(a >> 1, 3988292384 * (a & 1))"
    byte = f"list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {codes}, lambda c, b: {byte}), 4294967295)"


def _coded(field: str) -> str:
    return f"coalesce(strlen(CAST({field} AS VARCHAR)) || ':' || CAST({field} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_coded(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLES: dict[str, str] = {
    "op2_jaccard_join": rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM cut WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
),
{_REACH.format(id="doc_id", table="documents")}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN lowest ON x = d.doc_id""",
    "op3_suffix_dedup": """
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM hexed WHERE len(h) >= 400)
),
hits AS (SELECT doc_id, i FROM strings JOIN (SELECT k FROM strings GROUP BY k HAVING count(*) > 1) USING (k)),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM hits
),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM grouped GROUP BY doc_id, g),
after AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
heads AS (
  SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head, max(b) AS last,
         CAST(sum(b - a) AS BIGINT) AS r, count(*) AS c
  FROM after JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(r, 0) AS n_removed, coalesce(c, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM hexed LEFT JOIN heads USING (doc_id)""",
    "op6_embedding_dedup": f"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93
),
{_REACH.format(id="vec_id", table="embeddings")},
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN lowest l ON l.x = e.vec_id LEFT JOIN degrees d ON d.x = e.vec_id""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(CAST(n_chars AS HUGEINT) + 1)")} ELSE {_leaf("n_chars")} END AS claim
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
lower_nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM lower_nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2
),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM lower_nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS lvl, pos, subroot AS h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM upper_nodes WHERE n > 1 GROUP BY lvl, pos // 2
),
steps AS (
  SELECT p.doc_id, p.tree, p.pos, k.lvl AS step, (p.pos >> k.lvl) % 2 AS side, s.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, lvl FROM lower_nodes WHERE n > 1) k ON k.tree = p.tree
  LEFT JOIN lower_nodes s ON s.tree = p.tree AND s.lvl = k.lvl AND s.pos = xor(p.pos >> k.lvl, 1)
  UNION ALL
  SELECT p.doc_id, p.tree, p.pos, 100 + k.lvl, (r.pos >> k.lvl) % 2, s.h
  FROM placed p JOIN subroots r ON r.tree = p.tree, (SELECT DISTINCT lvl FROM upper_nodes WHERE n > 1) k
  LEFT JOIN upper_nodes s ON s.lvl = k.lvl AND s.pos = xor(r.pos >> k.lvl, 1)
),
proofs AS (
  SELECT tree, pos, string_agg(coalesce(sibling, ''), '' ORDER BY step) AS proof,
         list({{'side': side, 'h': coalesce(sibling, '')}} ORDER BY step) AS walk
  FROM steps GROUP BY tree, pos
),
fold AS (
  SELECT p.*, subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce([{{'side': CAST(0 AS BIGINT), 'h': claim}}] || coalesce(walk, []),
                     lambda a, s: {{'side': s.side, 'h': sha256(CASE WHEN s.side = 1 THEN s.h || a.h ELSE a.h || s.h END)}}).h AS folded_root
  FROM placed p JOIN subroots r USING (tree) LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM fold""",
    "op13_prefix_trie": f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations
),
convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS head, count(*) AS n, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h
  FROM conversations GROUP BY conv_id
),
heads AS (SELECT c, h, n, (SELECT count(*) FROM turns WHERE conv_id = head AND pos < h) AS k FROM convs),
whole AS (
  SELECT c, pos AS p, role, text FROM convs JOIN turns ON conv_id = head AND pos < h
  UNION ALL
  SELECT c, pos - h + k, role, text FROM heads JOIN turns ON conv_id = c AND pos >= h
),
listed AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY p) AS l FROM whole GROUP BY c),
lists AS (SELECT c, coalesce(l, []) AS l FROM convs LEFT JOIN listed USING (c)),
members AS (SELECT c, d, l[1:d] AS prefix, len(l) = d AS ending FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM lists)),
nodes AS (
  SELECT d, min(c) AS m, count(*) AS n, prefix, any_value(coalesce(length(prefix[-1].text), 0)) AS size,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ending), '')) AS ends_sha256
  FROM members GROUP BY d, prefix
),
linked AS (SELECT x.*, y.m AS up FROM nodes x LEFT JOIN nodes y ON y.d = x.d - 1 AND y.prefix = x.prefix[1:x.d - 1]),
counted AS (
  SELECT d, m, n, size, up, ends_sha256, (SELECT count(*) FROM linked z WHERE z.d = x.d + 1 AND z.up = x.m) AS n_children FROM linked x
),
below AS (
  SELECT y.d, y.m, sum(CAST(z.n_children = 0 AS INT)) AS n_leaves, sum((z.n - 1) * z.size) AS saved
  FROM members a JOIN nodes y ON y.d = a.d AND y.prefix = a.prefix JOIN counted z ON z.m = a.c AND z.d >= y.d GROUP BY y.d, y.m
)
SELECT m AS conv_id, d AS depth, up AS parent_conv_id, n AS n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN below USING (d, m)""",
}

_FLAT = "lower(trim(regexp_replace({0}, '\\s+', ' ', 'g')))"

_QUOTING = """
said AS (SELECT conv_id, turn, replace(max(text), chr(10), chr(10) || '> ') AS near, replace(max(text), chr(10), chr(10) || '>> ') AS far
         FROM conversations GROUP BY conv_id, turn),
source AS (
  SELECT c.conv_id, c.turn, c.role,
         coalesce('>> ' || f.far || chr(10), '') || coalesce('> ' || n.near || chr(10), '') || c.text AS text
  FROM conversations c
  LEFT JOIN said n ON n.conv_id = c.conv_id AND n.turn = c.turn - 1 - (c.conv_id + c.turn) % 3
  LEFT JOIN said f ON f.conv_id = c.conv_id AND f.turn = c.turn - 2 - c.conv_id % 3
)"""


def _linked(source: str) -> str:
    """CTEs that end in ``linked``: every message of ``source`` without its quotes, with its originals and its thread."""
    flat, line = _FLAT.format("part"), "string_split_regex(coalesce(text, ''), '\\r?\\n')"
    marks, announces = "'^\\s*>[>\\s]*'", "'^\\s*(On .{1,200} wrote|Am .{1,200} schrieb.{0,100}|Le .{1,200} a écrit|El .{1,200} escribió)\\s*:\\s*$'"
    return f"""{source},
msgs AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, {line} AS ls FROM source),
lines AS (SELECT rid, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS no FROM msgs),
marked AS (SELECT rid, no, length(regexp_replace(regexp_extract(line, {marks}), '[^>]', '', 'g')) AS lvl, regexp_replace(line, {marks}, '') AS body FROM lines),
levels AS (
  SELECT rid, no, body, CASE WHEN lvl = 0 AND lead(lvl, 1, 0) OVER (PARTITION BY rid ORDER BY no) > 0 AND regexp_matches(body, {announces}) THEN -1 ELSE lvl END AS lvl
  FROM marked
),
edges AS (SELECT *, CAST(lvl IS DISTINCT FROM lag(lvl) OVER (PARTITION BY rid ORDER BY no) AS INT) AS new FROM levels),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY no) AS run FROM edges),
passages AS (SELECT rid, run, any_value(lvl) AS lvl, string_agg(body, chr(10) ORDER BY no) AS passage FROM numbered WHERE lvl > 0 GROUP BY rid, run),
own AS (SELECT rid, regexp_replace(string_agg(body, chr(10) ORDER BY no), '\\A\\s*\\n|\\s+\\z', '', 'g') AS text FROM levels WHERE lvl = 0 GROUP BY rid),
cut AS (SELECT m.rid, conv_id, turn, role, coalesce(o.text, '') AS text FROM msgs m LEFT JOIN own o USING (rid)),
pieces AS (SELECT conv_id, turn, unnest([text] || string_split(text, chr(10)) || string_split_regex(text, '\\n\\s*\\n')) AS part FROM cut),
held AS (SELECT conv_id, {flat} AS k, min(turn) AS origin FROM pieces GROUP BY ALL HAVING k <> ''),
parts AS (
  SELECT rid, run, lvl, true AS entire, passage AS part FROM passages
  UNION ALL SELECT rid, run, lvl, false, unnest(string_split(passage, chr(10))) FROM passages
),
asked AS (SELECT rid, run, lvl, {flat} AS k, bool_or(entire) AS entire FROM parts GROUP BY ALL HAVING k <> ''),
met AS (
  SELECT a.rid, lvl, origin, length(k) AS size, entire, bool_or(entire) OVER (PARTITION BY a.rid, run) AS whole
  FROM asked a JOIN cut c USING (rid) JOIN held h USING (conv_id, k) WHERE origin < c.turn
),
found AS (SELECT rid, lvl, origin, max(size) AS size FROM met WHERE entire = whole GROUP BY rid, lvl, origin),
replies AS (
  SELECT rid, string_agg(lvl || ':' || origin, ',' ORDER BY lvl, origin) AS originals, first(origin ORDER BY lvl, size DESC, origin DESC) AS reply_to
  FROM found GROUP BY rid
),
links AS (SELECT conv_id, turn, min(reply_to) AS up FROM cut JOIN replies USING (rid) GROUP BY conv_id, turn),
chain AS (
  SELECT rid, conv_id, reply_to AS reached FROM cut JOIN replies USING (rid)
  UNION ALL SELECT rid, conv_id, up FROM chain JOIN links USING (conv_id) WHERE links.turn = chain.reached
),
counts AS (SELECT rid, count(*) AS n, max(lvl) AS deepest FROM passages GROUP BY rid),
linked AS (
  SELECT rid, conv_id, turn, role, text, CAST(coalesce(n, 0) AS INT) AS n_quotes, CAST(coalesce(deepest, 0) AS INT) AS deepest,
         coalesce(originals, '') AS originals, reply_to, coalesce((SELECT min(reached) FROM chain WHERE chain.rid = cut.rid), turn) AS thread,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS formatted
  FROM cut LEFT JOIN replies USING (rid) LEFT JOIN counts USING (rid)
)"""


_SHOWN = "SELECT conv_id, turn, role, text, n_quotes, deepest, originals, reply_to, thread, formatted FROM linked"

ORACLES["op5_chat_formatting"] = f"WITH RECURSIVE {_linked('source AS (SELECT * FROM conversations)')} {_SHOWN}"
ORACLES["quoted_links"] = f"WITH RECURSIVE {_linked(_QUOTING)} {_SHOWN}"
ORACLES["quoted_threads"] = f"""
WITH RECURSIVE {_linked(_QUOTING)},
placed AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, thread ORDER BY turn) - 1) // 3 AS part FROM linked)
SELECT conv_id, thread, part, CAST(count(*) AS INT) AS n_messages, string_agg(turn, ',' ORDER BY turn) AS turns, string_agg(formatted, '' ORDER BY turn) AS formatted
FROM placed GROUP BY conv_id, thread, part"""
