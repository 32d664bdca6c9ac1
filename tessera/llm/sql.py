"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tessera.llm.common import LOWER, UPPER
from tessera.llm.decontaminate import WINDOW
from tessera.llm.mix import BLOCK_WORDS, GOLDEN, MAX_REPEATS, SEED, WEIGHTS
from tessera.llm.neardup import PERCENT, SHINGLE
from tessera.llm.topk import SCALE, TOP
from tessera.llm.urls import RULES


def _lower(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all({_lower('text')}, '{_ALNUM}'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower('text')}, '{_ALNUM}') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS n, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS g
        FROM b, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM d, (SELECT DISTINCT n FROM win) AS k, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT rid, i, n, item FROM dw JOIN win USING (n, g)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN it USING (rid)
"""

_ESCAPES = r"len(regexp_extract_all({0}, '[<\[]\\*(?:\||/?s>|/?INST\])')) + len(regexp_extract_all({0}, '\|\\*>'))"

OP2 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, length(text) + length(role) + {len('<|') + len('|>') + 1 + len('<|end|>') + 1}
        + {_ESCAPES.format('text')} + {_ESCAPES.format('role')} AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM m GROUP BY conv_id
"""

OP3 = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_BLANK}')), 0) AS size,
                  md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}) + 1] AS weight,
              source_size * {MAX_REPEATS} AS cap FROM s0),
s2 AS (SELECT *, cap / weight AS cap_level,
   (sum(source_size) OVER () - coalesce(sum(cap) OVER lo, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER lo, 0)) AS lvl
   FROM s1 WINDOW lo AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, arg_min(lvl, cap_level) FILTER (cap_level >= lvl) OVER () AS level FROM s2),
t AS (SELECT source, source_size, CASE WHEN level IS NULL OR cap_level <= level THEN CAST(cap AS DOUBLE) ELSE weight * level END AS target FROM s3),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS quota, (source_size + {BLOCK_WORDS} - 1) // {BLOCK_WORDS} AS blocks FROM t),
p AS (SELECT row_number() OVER () AS rid, d.doc_id, d.source, d.size, q.source_size, q.target, q.quota,
   CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
   FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
-- The schedule: golden-ratio points through the cumulative shares of the slots needed.
n0 AS (SELECT *, quota // source_size * blocks + (quota % source_size + {BLOCK_WORDS} - 1) // {BLOCK_WORDS} AS need
       FROM q WHERE target > 0 AND source_size > 0),
n1 AS (SELECT *, CAST(sum(need) OVER () AS BIGINT) AS slots,
          CAST(sum(need) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM n0),
pt AS (SELECT slot, ((slot + 1) * CAST('{GOLDEN}' AS DOUBLE)) % 1.0::DOUBLE AS point
       FROM (SELECT unnest(range(coalesce(max(slots), 0))) AS slot FROM n1)),
hit AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
        FROM pt JOIN n1 ON point >= (upto - need) / slots AND point < upto / slots),
got AS (SELECT n1.source, any_value(need) AS need, any_value(slots) AS slots, count(hit.slot) AS got
        FROM n1 LEFT JOIN hit ON hit.source IS NOT DISTINCT FROM n1.source GROUP BY n1.source),
sl AS (SELECT source, slot, rank FROM hit
       UNION ALL SELECT source, slots + r, r FROM (SELECT source, slots, unnest(range(got, need)) AS r FROM got)),
tk AS (SELECT sl.source, rank % blocks AS block, slot,
          least({BLOCK_WORDS}, source_size - rank % blocks * {BLOCK_WORDS}, quota - rank // blocks * source_size - rank % blocks * {BLOCK_WORDS}) AS words
       FROM sl JOIN n1 ON sl.source IS NOT DISTINCT FROM n1.source WHERE rank < need),
fb AS (SELECT source, block, words, min(slot) AS slot FROM tk GROUP BY source, block, words),
pc AS (SELECT rid, source, start, size, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM p WHERE size > 0),
fs AS (SELECT rid, min(slot) AS first_slot FROM pc JOIN fb ON pc.source IS NOT DISTINCT FROM fb.source AND pc.block = fb.block
       WHERE start < pc.block * {BLOCK_WORDS} + words GROUP BY rid)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
   CASE WHEN size = 0 THEN 0 ELSE quota // source_size * size
     + greatest(0, least(start + size, quota % source_size) - start) END AS taken, first_slot
FROM p LEFT JOIN fs USING (rid)
"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_lower('text')}, '{_BLANK}'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least({SHINGLE}, len(w)) - 1], ' ') AS g
       FROM d, unnest(range(1, len(w) - least({SHINGLE}, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
         JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
         GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= {PERCENT} * (na.n + nb.n - count(*))),
reach(root, node) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.root, l.y FROM reach r JOIN link l ON l.x = r.node),
comp AS (SELECT root AS doc_id, min(node) AS component_id FROM reach GROUP BY root)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""

_REST = "CASE WHEN strpos({0}, '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END"


def _host(u: str) -> str:
    return f"coalesce({_lower(f'regexp_extract({_REST.format(u)}, ' + chr(39) + '^[^/?#]*' + chr(39) + ')')}, '')"


def _path(u: str) -> str:
    return f"coalesce(regexp_extract({_REST.format(u)}, '^[^/?#]*([^?#]*)', 1), '')"


def _node(u: str) -> str:
    return f"({_host(u)} || {_path(u)} || regexp_extract({_REST.format(u)}, '^[^?#]*(\\?[^#]*)', 1))"


def _canonical(n: str) -> str:
    bare = rf"regexp_replace({n}, '([?&])(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*', '\1', 'g')"
    bare = rf"regexp_replace(regexp_replace({bare}, '\?&+', '?', 'g'), '&&+', '&', 'g')"
    return rf"regexp_replace(regexp_replace({bare}, '[?&]+$', ''), '(?s)^([^/]+/.*[^/])/$', '\1')"


def _href(tag: str, mark: str, name: str) -> str:
    el = rf"regexp_extract(coalesce(html, ''), '(?is)<{tag}\b[^>]*\b{mark}[^>]*>')"
    return rf"nullif(regexp_extract({el}, '(?is)\b{name}\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)', 1), '')"


_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

OP5 = f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {_RULES_SQL}),
p AS (SELECT row_number() OVER () AS rid, page_id, url, html, {_host('url')} AS host, {_path('url')} AS path,
             CASE WHEN strpos(url, '://') > 0 THEN {_node('url')} END AS node FROM pages),
raw AS (SELECT host, node, unnest([url, {_href('link', r'rel\s*=\s*[\x22\x27]?canonical', 'href')},
                                  {_href('meta', r'http-equiv\s*=\s*[\x22\x27]?refresh', 'url')}]) AS t FROM p WHERE node IS NOT NULL),
ab AS (SELECT node, CASE WHEN starts_with(t, '//') THEN 'http:' || t WHEN starts_with(t, '/') THEN 'http://' || host || t ELSE t END AS t
       FROM raw WHERE t IS NOT NULL),
e AS (SELECT DISTINCT node AS x, {_canonical(_node('t'))} AS y FROM ab WHERE strpos(t, '://') > 0),
e2 AS (SELECT x, y FROM e WHERE x <> y UNION SELECT y, x FROM e WHERE x <> y),
reach(root, node) AS (SELECT DISTINCT x, x FROM e2 UNION SELECT r.root, e2.y FROM reach r JOIN e2 ON e2.x = r.node),
nodes AS (SELECT DISTINCT node, regexp_extract(node, '^[^/?#]*') AS host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
pairs AS (SELECT DISTINCT host, path FROM (SELECT host, path FROM p UNION ALL SELECT host, path FROM nodes)),
m AS (SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath) * 1000 + length(rhost)) AS rule,
             arg_max(verdict, length(rhost || rpath) * 1000 + length(rhost)) AS rv
      FROM pairs JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
blk AS (SELECT root FROM reach JOIN nodes USING (node) JOIN m USING (host, path) GROUP BY root
        HAVING bool_or(rv = 'block') AND NOT bool_or(rv = 'allow'))
SELECT page_id, p.host, p.path, rule, coalesce(rv, CASE WHEN blk.root IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON m.host = p.host AND m.path = p.path LEFT JOIN blk ON blk.root = p.node
"""

OP10 = f"""
WITH v AS (SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}
"""


# --- 12: Merkle manifest -------------------------------------------------------

# Levels of a language's tree and of the tree over the languages: enough for
# 8**9 rows of a language and 8**4 languages.
_LANG_LEVELS, _TOP_LEVELS = 9, 4


def _encoded(c: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    return f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_encoded(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# CRC-32 of a decimal number, bit by bit.
_CRC32 = """xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, levels: int) -> str:
    """Levels of the trees in ``{name}0`` (t, i, n, h), each with what stands left
    and right of a node in its run."""
    out = []
    for k in range(levels):
        at = f"{name}{k}"
        out.append(f"""{at}_run AS (SELECT t, i // 8 AS r, n, list({{'i': i, 'h': h}} ORDER BY i) AS run FROM {at} GROUP BY t, r, n),
{name}{k + 1} AS (
    SELECT t, r AS i, CASE WHEN n = 1 THEN 1 ELSE (n + 7) // 8 END AS n,
           CASE WHEN n = 1 THEN run[1].h ELSE sha256(array_to_string([x.h for x in run], '')) END AS h
    FROM {at}_run),
{at}_sib AS (
    SELECT a.t, a.i, array_to_string([x.h for x in b.run if x.i < a.i], '') AS lft,
           array_to_string([x.h for x in b.run if x.i > a.i], '') AS rgt, a.n > 1 AS up
    FROM {at} a JOIN {at}_run b ON a.t = b.t AND a.i // 8 = b.r)""")
    return ",\n".join(out)


def _fold(start: str, source: str, name: str, levels: int, tag: str) -> str:
    """CTEs that fold ``f`` and ``bad`` of ``source`` (rid, t, i) up the levels."""
    out, prev = [], source
    for k in range(levels):
        at = f"{tag}{k}"
        out.append(f"""{at} AS (
    SELECT p.rid, p.t, p.i // 8 AS i, p.proof || s.lft || s.rgt AS proof,
           CASE WHEN s.up THEN sha256(s.lft || p.f || s.rgt) ELSE p.f END AS f
    FROM {prev} p JOIN {name}{k}_sib s ON p.t = s.t AND p.i = s.i)""")
        prev = at
    return ",\n".join(out)


OP12 = f"""
WITH d AS (
    SELECT *, coalesce('v' || lang, '-') AS tree, {_leaf('text')} AS leaf,
           CASE WHEN text IS NOT NULL AND {_CRC32} % 3 = 0 THEN {_leaf(_LOWER)} END AS bad
    FROM documents
),
rows_ AS (
    SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS rid,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           COUNT(*) OVER (PARTITION BY tree) AS n
    FROM d
),
l0 AS (SELECT tree AS t, i, n, leaf AS h FROM rows_),
{_tree('l', _LANG_LEVELS)},
g0 AS (
    SELECT 0 AS t, row_number() OVER (ORDER BY t) - 1 AS i, COUNT(*) OVER () AS n, h, t AS tree
    FROM l{_LANG_LEVELS}
),
{_tree('g', _TOP_LEVELS)},
start_ AS (SELECT rid, tree AS t, i, '' AS proof, coalesce(bad, leaf) AS f FROM rows_),
{_fold('start_', 'start_', 'l', _LANG_LEVELS, 'u')},
mid AS (
    SELECT u.rid, 0 AS t, g0.i, u.proof, u.f FROM u{_LANG_LEVELS - 1} u JOIN g0 ON u.t = g0.tree
),
{_fold('mid', 'mid', 'g', _TOP_LEVELS, 'w')}
SELECT r.doc_id, r.leaf, s.h AS subroot, g.h AS root, sha256(w.proof) AS proof_sha256, w.f AS folded_root,
       w.f = g.h AS verified,
       CAST(r.i + list_sum([r.i // CAST(8 ** k AS BIGINT) for k in range(1, {_LANG_LEVELS + 1})]) AS BIGINT) AS log_position
FROM rows_ r JOIN w{_TOP_LEVELS - 1} w USING (rid) JOIN g0 s ON s.tree = r.tree CROSS JOIN g{_TOP_LEVELS} g"""
