"""SQL that some registered queries must agree with, over the given tables as views."""

from __future__ import annotations

from docstrata.llm.decontaminate import ENOUGH_PART, ENOUGH_TOKENS, SHORTEST, UNIT_WORDS, UNITS, UNSPACED, WINDOW
from docstrata.llm.embeddings import COSINE
from docstrata.llm.hard_negatives import EVERY, HIGHEST, LABELS, LOWEST, NEGATIVES, POSITIVES, SCALE, SHIFTED
from docstrata.llm.prefix_trie import FAMILY
from docstrata.llm.suffix_dedup import LENGTH


def _tokens(text: str) -> str:
    plain = f"regexp_replace(coalesce({text}, ''), '[\\x01-\\x03]', ' ', 'g')"
    apart = f"regexp_replace({plain}, '([{UNSPACED}])', ' \\1 ', 'g')"
    capitals = f"regexp_replace({apart}, '(\\p{{Lu}}\\p{{Ll}})', chr(3) || '\\1', 'g')"
    named = f"replace(regexp_replace({capitals}, '([\\p{{L}}\\p{{N}},;:]\\s+)\\x03', '\\1' || chr(1), 'g'), chr(3), '')"
    marked = f"regexp_replace({named}, '([0-9]\\s?)({UNIT_WORDS})([^\\p{{L}}\\p{{M}}\\p{{N}}]|$)', '\\1' || chr(2) || '\\2\\3', 'g')"
    return f"regexp_extract_all({marked}, '[\\x01\\x02]?[0-9]+(?:[.,][0-9]+)*|[\\x01\\x02]?\\p{{L}}[\\p{{L}}\\p{{M}}]*')"


_SLOT = "(starts_with(t, chr(1)) OR starts_with(t, chr(2)) OR t[1] BETWEEN '0' AND '9')"
_CODE = "CASE WHEN starts_with(t, chr(1)) THEN '#1' WHEN starts_with(t, chr(2)) THEN '#2' WHEN t[1] BETWEEN '0' AND '9' THEN '#3' ELSE lower(t) END"
#: A window agrees with another by its template, or by its words if most of it are slots or it is a whole short text.
_KEY = f"""CASE WHEN size < {SHORTEST} OR 2 * len([t FOR t IN w IF {_SLOT}]) > size THEN 'words ' || array_to_string([lower(t) FOR t IN w], ' ')
       ELSE array_to_string([{_CODE} FOR t IN w], ' ') END"""

OP1 = f"""
WITH plain_items AS (SELECT DISTINCT item_id, {_tokens("text")} AS toks FROM benchmark),
forms AS (
  SELECT item_id, toks FROM plain_items
  UNION SELECT item_id, [chr(1) || toks[1]] || toks[2:] FROM plain_items WHERE regexp_matches(toks[1], '^\\p{{Lu}}\\p{{Ll}}')
  UNION SELECT item_id, [chr(2) || toks[1]] || toks[2:] FROM plain_items WHERE toks[1] IN ({", ".join(f"'{u}'" for u in UNITS)})
),
items AS (SELECT *, CAST(len(toks) AS INTEGER) AS n, CAST(least({WINDOW}, len(toks)) AS INTEGER) AS size FROM forms WHERE len(toks) > 0),
docs AS (SELECT DISTINCT doc_id, text, {_tokens("text")} AS toks FROM documents),
known AS (
  SELECT DISTINCT item_id, n, size, iat, {_KEY} AS key, [t FOR t IN w IF {_SLOT}] AS islots
  FROM (SELECT item_id, n, size, iat, toks[iat + 1 : iat + size] AS w FROM (SELECT *, UNNEST(range(n - size + 1)) AS iat FROM items))
),
doc_windows AS (
  SELECT doc_id, text, size, dat, {_KEY} AS key, [t FOR t IN w IF {_SLOT}] AS slots
  FROM (SELECT doc_id, text, size, dat, toks[dat + 1 : dat + size] AS w
        FROM (SELECT d.*, s.size, UNNEST(range(greatest(0, len(d.toks) - s.size + 1))) AS dat FROM docs d
              JOIN (SELECT DISTINCT size FROM items) s ON s.size >= {SHORTEST} OR s.size = len(d.toks)))
),
hits AS (
  SELECT doc_id, text, item_id, n, d.size AS size, dat - iat AS shift, iat, slots, islots
  FROM doc_windows d JOIN known k ON d.key = k.key AND d.size = k.size
),
pairs AS (SELECT DISTINCT doc_id, text, item_id, n, size, shift, UNNEST(islots) AS i, UNNEST(slots) AS s FROM hits),
torn AS (
  SELECT doc_id, text, item_id, n, size, shift, count(*) <> count(DISTINCT i) OR count(*) <> count(DISTINCT s) AS torn
  FROM pairs GROUP BY doc_id, text, item_id, n, size, shift
),
good AS (
  SELECT h.* FROM hits h LEFT JOIN torn t ON h.doc_id IS NOT DISTINCT FROM t.doc_id AND h.text = t.text AND h.item_id = t.item_id
    AND h.n = t.n AND h.size = t.size AND h.shift = t.shift
  WHERE h.slots = h.islots OR NOT coalesce(t.torn, FALSE)
),
shifts AS (
  SELECT doc_id, text, item_id, n, size, shift, count(DISTINCT iat) > count(DISTINCT CASE WHEN slots = islots THEN iat END) AS changed
  FROM good GROUP BY doc_id, text, item_id, n, size, shift
),
counted AS (
  SELECT doc_id, text, item_id, n, size, bool_and(changed) AS reparameterised FROM shifts GROUP BY doc_id, text, item_id, n, size
),
placed AS (
  SELECT doc_id, text, item_id, n, size, CAST(count(DISTINCT iat) AS INTEGER) AS n_windows
  FROM good GROUP BY doc_id, text, item_id, n, size
),
covered AS (
  SELECT doc_id, text, item_id, n, size, CAST(count(DISTINCT p) AS INTEGER) AS matched_tokens
  FROM (SELECT doc_id, text, item_id, n, size, UNNEST(range(iat, iat + size)) AS p FROM good) GROUP BY doc_id, text, item_id, n, size
)
SELECT c.doc_id AS doc_id, c.item_id AS item_id, n_windows, matched_tokens, c.n AS item_tokens, reparameterised
FROM counted c JOIN placed q ON c.doc_id IS NOT DISTINCT FROM q.doc_id AND c.text = q.text AND c.item_id = q.item_id AND c.n = q.n AND c.size = q.size
JOIN covered v ON c.doc_id IS NOT DISTINCT FROM v.doc_id AND c.text = v.text AND c.item_id = v.item_id AND c.n = v.n AND c.size = v.size
WHERE matched_tokens >= least({ENOUGH_TOKENS}, ceil(c.n * {ENOUGH_PART}))
"""

OP10 = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}
),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM vectors
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, min(other) AS component_id, node = min(other) AS kept
FROM reach GROUP BY node
"""

OP4 = f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, UNNEST(range(len(h) // 2)) AS p FROM texts),
strings AS (
  SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), 2) AS b,
         CASE WHEN p + {LENGTH} <= len(h) // 2 THEN md5(substr(h, CAST(2 * p + 1 AS BIGINT), {2 * LENGTH})) END AS string
  FROM places
),
marked AS (
  SELECT doc_id, p, b, string IS NOT NULL AND row_number() OVER (PARTITION BY string ORDER BY doc_id, p) > 1 AS again FROM strings
),
covered AS (
  SELECT doc_id, p, b, max(CAST(again AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM marked
),
edges AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM covered),
counted AS (
  SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, count(*) FILTER (WHERE gone = 1 AND before = 0) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY p) FILTER (WHERE gone = 0), '') AS kept
  FROM edges GROUP BY doc_id
)
SELECT t.doc_id AS doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts t LEFT JOIN counted c ON t.doc_id = c.doc_id
"""

#: The checksum of an id's decimal text, one byte and eight shifts at a time.
_CRC = """xor(list_reduce(
  list_concat([4294967295::BIGINT], flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(c::VARCHAR, '')])),
  lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END), 4294967295)"""

OP12 = f"""
WITH turns AS (
  SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (SELECT c, {_CRC} % 9 AS h, c - c % {FAMILY} AS base FROM (SELECT DISTINCT c FROM turns)),
planned AS (SELECT c, h, base, (SELECT count(*) FROM turns t WHERE t.c = convs.base AND p <= h) AS got FROM convs),
built AS (
  SELECT planned.c, p AS d, role, text FROM planned JOIN turns ON turns.c = base AND p <= h
  UNION ALL SELECT planned.c, p - h + got, role, text FROM planned JOIN turns ON turns.c = planned.c AND p > h
),
paths AS (
  SELECT c, d, text, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d) AS k FROM built
  UNION ALL SELECT c, 0, '', '' FROM convs
),
ends AS (SELECT c, max(d) AS d, max_by(k, d) AS k FROM paths GROUP BY c),
hashes AS (SELECT k, d, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h FROM ends GROUP BY k, d),
nodes AS (SELECT k, d, min(c) AS c, count(*) AS n, any_value(strlen(text)) AS b FROM paths GROUP BY k, d),
parents AS (
  SELECT DISTINCT a.k AS k, a.d AS d, b.k AS pk FROM paths a JOIN paths b ON a.c = b.c AND b.d = a.d - 1
),
linked AS (SELECT n.*, p.pk, q.c AS pc FROM nodes n LEFT JOIN parents p ON n.k = p.k AND n.d = p.d LEFT JOIN nodes q ON q.k = p.pk AND q.d = n.d - 1),
counted AS (SELECT l.*, (SELECT count(*) FROM linked m WHERE m.pk = l.k AND m.d = l.d + 1) AS children FROM linked l)
SELECT u.c AS conv_id, u.d::BIGINT AS depth, u.pc AS parent_conv_id, u.n AS n_convs, u.children AS n_children,
       count(*) FILTER (WHERE v.children = 0) AS n_leaves, sum((v.n - 1) * v.b)::BIGINT AS saved_tokens, coalesce(any_value(h), sha256('')) AS ends_sha256
FROM counted u JOIN counted v ON v.d >= u.d AND starts_with(v.k, u.k) LEFT JOIN hashes ON hashes.k = u.k AND hashes.d = u.d
GROUP BY u.c, u.d, u.pc, u.n, u.children, u.k
"""

OP13 = f"""
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
scores AS (
  SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.id % {EVERY} = 0 AND a.id <> b.id AND len(a.q) = len(b.q)
),
positives AS (
  SELECT anchor, id, score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {POSITIVES}
),
ranked AS (
  SELECT p.anchor, p.id AS positive, p.score AS ps, n.id AS negative, n.score AS ns,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND {LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {HIGHEST} * p.score
)
SELECT anchor AS anchor_id, positive AS positive_id, place::INTEGER AS rank, negative AS negative_id, ps AS positive_score, ns AS negative_score
FROM ranked WHERE place <= {NEGATIVES}
"""
