"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from cytogrid.llm.url_templates import ENOUGH, MOST_CHILDREN, PRIOR, RARE, REJECT, RULES, SIMILAR_Z

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = r"""
WITH l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL) q),
n AS (SELECT *, CAST('0x' || substr(md5(s), 1, 5) AS BIGINT) AS c, length(s) >= 99 AND regexp_matches(s, '^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){49}[^\x20\x09-\x0D]') AS wide, lead(s) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM l),
b AS (SELECT *, CASE WHEN nxt IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY s, nxt) END AS beside FROM n),
e AS (SELECT *, coalesce(lag(beside) OVER w, 0) AS before,
  CAST(wide OR coalesce(lead(wide) OVER w, true) OR ((31 * coalesce(lag(c) OVER w, 0) + c) * 40503 % 67108864) // 1024 % 3 = 0
    OR beside < greatest(coalesce(lag(beside) OVER w, 0), coalesce(lead(beside) OVER w, 0)) AS INT) AS ends FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk, lag(s) OVER (PARTITION BY doc_id ORDER BY i) AS prv FROM e),
g AS (SELECT doc_id, chunk, min(i) AS start, string_agg(s, chr(10) ORDER BY i) AS body, count(*) >= 2 OR bool_or(wide) AS several, any_value(before) AS before, any_value(beside) AS beside, any_value(prv) AS prv, any_value(nxt) AS nxt
  FROM k GROUP BY 1, 2 HAVING bool_or(regexp_matches(s, '[^\x20\x09-\x0D]'))),
u AS (SELECT doc_id, chunk, start, body FROM g WHERE several UNION ALL SELECT doc_id, chunk, start - 1, prv || chr(10) || body FROM g WHERE NOT several AND before >= 2
  UNION ALL SELECT doc_id, chunk, start, body || chr(10) || nxt FROM g WHERE NOT several AND beside >= 2),
r AS (SELECT DISTINCT doc_id, chunk FROM (SELECT doc_id, chunk, start, min((doc_id, start)) OVER (PARTITION BY body) AS least FROM u) q WHERE (doc_id, start) <> least),
m AS (SELECT k.doc_id, count(r.chunk) AS removed, string_agg(s, chr(10) ORDER BY i) FILTER (WHERE r.chunk IS NULL) AS kept, count(*) AS n FROM k LEFT JOIN r ON r.doc_id = k.doc_id AND r.chunk = k.chunk GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(removed, 0) AS n_removed_lines, md5(CASE WHEN removed > 0 THEN coalesce(kept, '') ELSE text END) AS text_md5 FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id"""


#: Levels of the tree that the SQL spells out; the test tables have no deeper paths.
LEVELS = 6


def _rule_case(verdict: bool) -> str:
    """CASE over the rules, the longest first; of equally long ones the first listed."""
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    arms = (f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{what if verdict else h + p}'" for what, h, p in ordered)
    return f"CASE {' '.join(arms)} END"


def _tree_level(i: int) -> str:
    """Template parts of level ``i`` (from 1), after t{i - 1}."""
    return f"""k{i} AS (SELECT host, template, shape[{i}] AS seg, sum(n) AS n, sum(labelled) AS l, sum(blocked) AS b FROM t{i - 1} WHERE len(shape) >= {i} GROUP BY 1, 2, 3),
w{i} AS (SELECT host, template, seg, n, l, b, count(*) OVER p AS kids, sum(n) OVER p AS all_n, sum(l) OVER p AS all_l, sum(b) OVER p AS all_b FROM k{i} WINDOW p AS (PARTITION BY host, template)),
r{i} AS (SELECT *, CAST(all_b AS DOUBLE) / nullif(all_l, 0) AS rate, CAST(b AS DOUBLE) / nullif(l, 0) - CAST(all_b - b AS DOUBLE) / nullif(all_l - l, 0) AS gap, CAST(1 AS DOUBLE) / nullif(l, 0) + CAST(1 AS DOUBLE) / nullif(all_l - l, 0) AS inv FROM w{i}),
d{i} AS (SELECT host, template, seg, CASE WHEN kids = 1 OR (coalesce(gap * gap > CAST('{SIMILAR_Z**2!r}' AS DOUBLE) * (rate * (1 - rate) * inv), false) AND (kids <= {MOST_CHILDREN} OR all_n >= {RARE} * kids OR l >= {ENOUGH})) THEN seg ELSE '*' END AS part FROM r{i}),
t{i} AS (SELECT t.host, shape, n, labelled, blocked, t.template || coalesce('/' || part, '') AS template FROM t{i - 1} t LEFT JOIN d{i} d ON d.host = t.host AND d.template = t.template AND d.seg = t.shape[{i}])"""


OP5 = rf"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
v AS (SELECT *, {_rule_case(False)} AS rule, {_rule_case(True)} AS listed,
  list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: regexp_replace(regexp_replace(s, '[0-9a-fA-F]*[0-9][0-9a-fA-F]{{7,}}', '{{x}}', 'g'), '[0-9]+', '{{n}}', 'g')) AS plain FROM u),
p AS (SELECT page_id, host, path, rule, listed, plain AS shape FROM v),
t0 AS (SELECT host, shape, count(*) AS n, count(listed) AS labelled, count(*) FILTER (WHERE listed = 'block') AS blocked, '' AS template FROM p GROUP BY 1, 2),
{(',' + chr(10)).join(_tree_level(i) for i in range(1, LEVELS + 1))},
o AS (SELECT coalesce(CAST(sum(blocked) AS DOUBLE) / nullif(sum(labelled), 0), 0) AS rate FROM t{LEVELS}),
h AS (SELECT host, (sum(blocked) + CAST({PRIOR} AS DOUBLE) * any_value(rate)) / (sum(labelled) + CAST({PRIOR} AS DOUBLE)) AS host_rate FROM t{LEVELS}, o GROUP BY 1),
j AS (SELECT t.host, template, (sum(blocked) + CAST({PRIOR} AS DOUBLE) * any_value(host_rate)) / (sum(labelled) + CAST({PRIOR} AS DOUBLE)) AS purity FROM t{LEVELS} t JOIN h ON h.host = t.host GROUP BY 1, 2)
SELECT page_id, p.host, path, rule, coalesce(listed, CASE WHEN purity >= CAST({REJECT} AS DOUBLE) THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM p JOIN t{LEVELS} t ON t.host = p.host AND t.shape = p.shape JOIN j ON j.host = t.host AND j.template = t.template"""

OP7 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, coalesce('s' || source, 'n') AS skey, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS digest FROM documents),
s AS (SELECT skey, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS ord FROM s),
w AS (SELECT *, CASE (ord - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM o),
lv AS (SELECT *, ((SELECT sum(source_size) FROM w) - 3 * coalesce(sum(source_size) OVER r, 0)) / CAST((SELECT sum(w) FROM w) - coalesce(sum(w) OVER r, 0) AS DOUBLE) AS level
  FROM w WINDOW r AS (ORDER BY source_size / CAST(w AS DOUBLE), ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fr AS (SELECT level FROM lv WHERE level * w <= 3 * source_size ORDER BY source_size / CAST(w AS DOUBLE), ord LIMIT 1),
t AS (SELECT skey, source, source_size, least(coalesce((SELECT level FROM fr) * w, 0.0), CAST(3 * source_size AS DOUBLE)) AS target FROM lv),
x AS (SELECT d.doc_id, d.size, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate, row_number() OVER (PARTITION BY d.skey ORDER BY d.size, d.digest, d.doc_id) AS rank FROM d JOIN t ON t.skey = d.skey),
u AS (SELECT skey, CAST(CAST('0x' || substr(md5(coalesce(source, '') || ':0'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u FROM t)
SELECT x.doc_id, x.size, x.source_size, x.target, CAST(size * (floor(rank * rate + u) - floor((rank - 1) * rate + u)) AS BIGINT) AS taken FROM x JOIN u ON u.skey = x.skey"""

OP8 = rf"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
i AS (SELECT doc_id, w[k] AS a, w[k + 1] AS b, w[k + 2] AS c, k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS k FROM d) q),
r AS (SELECT doc_id, k FROM i QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
n AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM r) q GROUP BY 1),
l AS (SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) q WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
m AS (SELECT d.doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
g AS (SELECT *, base_failed OR 100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 30 * n_lines AS failed FROM f),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE failed) AS bad FROM g GROUP BY 1),
p AS (SELECT avg(bad / CAST(n AS DOUBLE)) AS m, var_pop(bad / CAST(n AS DOUBLE)) AS v FROM h),
ab AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, least(m * (1 - m) / v - 1, 1000.0)) ELSE 1000.0 END AS ab FROM p),
v AS (SELECT host, (bad + m * ab) / (n + ab) <= 0.5 AS ok FROM h, ab)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept FROM g JOIN v USING (host)"""

OP9 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_dot_product(q.v, e.v) AS BIGINT) AS score FROM e q JOIN e ON q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) q WHERE rank <= 20"""

_START = "sha256('3:' || CAST(vec_id AS VARCHAR)), v"


def _lloyd_round(i: int) -> str:
    """The nearest of the centroids of round ``i`` for each vector, and the centroids after it; all sums are whole numbers below 2^53."""
    return f"""p{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': CAST(list_dot_product(k.v, k.v) - 2 * list_dot_product(k.v, c.v) + list_dot_product(c.v, c.v) AS BIGINT), 'c': cluster}}) AS best FROM kept k, c{i} c GROUP BY r),
s{i} AS (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT best.c AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM p{i}) q GROUP BY 1, 2),
m{i} AS (SELECT cluster, list(CAST((s - ((s % n + n) % n)) // n AS DOUBLE) ORDER BY i) AS v FROM s{i} GROUP BY 1),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (cluster))"""


OP11 = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY {_START}) - 1 AS INT) AS cluster, v FROM (SELECT vec_id, v FROM kept WHERE vec_id IS NOT NULL ORDER BY {_START} LIMIT 8) q),
{("," + chr(10)).join(_lloyd_round(i) for i in range(11))}
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256 FROM p10 JOIN c10 c ON c.cluster = best.c"""

_MARKS = r"<\||</?s>|<</?SYS>>|\[/?INST\]"

#: An escaped text is longer by one for each backslash and by two for each control string.
OP12 = rf"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (SELECT conv_id, turn, coalesce(role, '') AS role, role = 'assistant' AS spoken, coalesce(text, '') AS text FROM t),
e AS (SELECT *, length(text) + length(text) - length(replace(text, chr(92), '')) + 2 * len(regexp_extract_all(text, '{_MARKS}')) AS long,
  length(role) + length(role) - length(replace(replace(role, chr(92), ''), chr(10), '')) + 2 * len(regexp_extract_all(role, '{_MARKS}')) AS wide FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (WHERE spoken), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE spoken), '')) AS loss_sha256, CAST(sum(12 + wide + 1 + long + 11) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""

SQL = {"op2_line_dedup": OP2, "op5_url_templates": OP5, "op7_source_mixing": OP7, "op8_host_rules": OP8, "op9_exact_top_k": OP9, "op11_lloyd_clusters": OP11, "op12_chat_format": OP12}
