"""DuckDB SQL for those queries that SQL can express."""

from quire.llm.mixing import MAX_EPOCHS, SEED, WEIGHTS
from quire.llm.quality import RULES, STOP_WORDS

_W = r"[^\x20\x09-\x0D]+"
_STOPS = ", ".join(f"'{form}'" for w in STOP_WORDS for form in dict.fromkeys((w, w.capitalize(), w.upper())))
_RULES = " AND ".join(f"({r.metric}) BETWEEN {r.low} AND {r.high}" for r in RULES)

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_W}') AS w FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (SELECT w.doc_id, len(w.w) AS n_words, coalesce(length(array_to_string(w.w, '')), 0) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l.l) AS n_lines, len(l.l) - len(list_distinct(l.l)) AS n_dup_lines,
  len(list_filter(l.l, lambda x: regexp_matches(x, '^ *([-*+•]|[0-9]+[.)])[ \t]'))) AS n_bullet_lines,
  len(list_filter(l.l, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS n_ellipsis_lines,
  len(list_filter(w.w, lambda x: x IN ({_STOPS}))) AS n_stop_words, coalesce(cov.n, 0) AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND {_RULES} AS kept FROM b
"""

CHAT = r"""
WITH RECURSIVE msg AS (SELECT conv_id, turn, role, text, string_split(text, chr(10)) AS lines FROM conversations),
ln0 AS (SELECT conv_id, turn, i, length(regexp_replace(regexp_extract(x, '^[ \t]*(>[ \t]*)+'), '[^>]', '', 'g')) AS level,
  trim(regexp_replace(lower(regexp_replace(x, '^[ \t]*(>[ \t]*)+', '')), '[\x20\x01\x02\x09-\x0D]+', ' ', 'g')) AS said FROM (SELECT conv_id, turn, unnest(lines) AS x, unnest(range(len(lines))) AS i FROM msg WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
ln1 AS (SELECT conv_id, turn, i, said, CASE WHEN regexp_matches(said, '[\p{L}\p{N}]') THEN level END AS level FROM ln0),
ln AS (SELECT *, sum(CASE WHEN level IS NOT DISTINCT FROM before THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, turn ORDER BY i) AS passage FROM (SELECT *, lag(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS before FROM ln1)),
ps AS (SELECT conv_id, turn, passage, level, list(said ORDER BY i) AS said FROM ln WHERE level IS NOT NULL GROUP BY ALL),
un AS (SELECT conv_id, turn, passage, level, 0 AS kind, array_to_string(said, ' ') AS hash FROM ps UNION ALL SELECT conv_id, turn, passage, level, 2, unnest(said) FROM ps
  UNION ALL SELECT conv_id, turn, passage, level, 1, array_to_string(w[i : i + 7], ' ') FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM (SELECT conv_id, turn, passage, level, string_split(array_to_string(said, ' '), ' ') AS w FROM ps))),
q AS (SELECT conv_id, turn, passage, level, kind, hash, count(*) AS n FROM un WHERE level > 0 GROUP BY ALL),
s AS (SELECT DISTINCT conv_id, turn, kind, hash FROM un WHERE level = 0),
f AS (SELECT q.conv_id, q.turn, q.passage, q.level, q.kind, q.hash, q.n, max(s.turn) AS parent_turn FROM q JOIN s ON s.conv_id = q.conv_id AND s.kind = q.kind AND s.hash = q.hash AND s.turn < q.turn GROUP BY ALL),
g AS (SELECT conv_id, turn, passage, level, kind, parent_turn, sum(n) AS n FROM f GROUP BY ALL),
h AS (SELECT conv_id, turn, level, parent_turn FROM g QUALIFY row_number() OVER (PARTITION BY conv_id, turn, passage ORDER BY kind, n DESC, parent_turn DESC) = 1),
v AS (SELECT conv_id, turn, level, parent_turn, count(*) AS n FROM h GROUP BY ALL),
p AS (SELECT conv_id, turn, parent_turn FROM v QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, parent_turn DESC) = 1),
r AS (SELECT conv_id, turn, parent_turn AS root_turn FROM p UNION ALL SELECT r.conv_id, r.turn, p.parent_turn FROM r JOIN p ON p.conv_id = r.conv_id AND p.turn = r.root_turn),
t AS (SELECT conv_id, turn, min(root_turn) AS root_turn FROM r GROUP BY ALL)
SELECT m.conv_id, coalesce(t.root_turn, m.turn) AS root_turn, m.turn, p.parent_turn, m.role,
  coalesce(list_max(list_transform(m.lines, lambda x: length(regexp_replace(regexp_extract(x, '^[ \t]*(>[ \t]*)+'), '[^>]', '', 'g')))), 0)::INT AS quote_depth,
  coalesce(len(list_filter(m.lines, lambda x: regexp_matches(x, '^[ \t]*>'))), 0)::BIGINT AS n_quoted,
  regexp_replace(regexp_replace(array_to_string(list_filter(m.lines, lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)), '^\n+|\n+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS text
FROM msg m LEFT JOIN p USING (conv_id, turn) LEFT JOIN t USING (conv_id, turn)
"""

MIXED = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '{_W}')) AS size FROM documents),
k AS (SELECT doc_id, source, size, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) * pow(2::DOUBLE, -52))
  / least(1::DOUBLE, greatest(0.25::DOUBLE, length(t) / (len(string_split(t, chr(10))) * 64::DOUBLE))) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, ({list(map(float, WEIGHTS))}::DOUBLE[])[(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM s),
c AS (SELECT *, row_number() OVER by_cap AS place, (sum(source_size) OVER () - {MAX_EPOCHS} * coalesce(sum(source_size) OVER before, 0))::BIGINT AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0::DOUBLE) AS rest_weight FROM w
  WINDOW by_cap AS (ORDER BY source_size / weight, encode(source) NULLS LAST), before AS (ORDER BY source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest / rest_weight, place) FILTER ({MAX_EPOCHS} * source_size * rest_weight >= weight * rest) AS level FROM c),
t AS (SELECT source, source_size, CASE WHEN {MAX_EPOCHS} * source_size * rest_weight < weight * rest THEN ({MAX_EPOCHS} * source_size)::DOUBLE ELSE weight * level END AS target FROM c, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END::BIGINT AS epochs FROM t),
g AS (SELECT source, key, doc_id, sum(size) AS size FROM k GROUP BY ALL),
m AS (SELECT source, key, doc_id, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST) - size / 2 AS mid FROM g)
SELECT k.doc_id, k.size::BIGINT AS size, e.source_size, e.target, (k.size * (e.epochs + (m.mid <= greatest(0::DOUBLE, e.target - e.epochs * e.source_size))::INT))::BIGINT AS taken
FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source JOIN m ON k.source IS NOT DISTINCT FROM m.source AND k.key = m.key AND k.doc_id IS NOT DISTINCT FROM m.doc_id
"""

NEAR = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM k JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * same >= 85 * (x.n + y.n - same)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT DISTINCT a AS root, a AS id FROM u UNION SELECT r.root, u.b FROM r JOIN u ON u.a = r.id),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, coalesce(m.root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m ON m.id = d.doc_id
"""

ORACLE = {"op2_source_mix": MIXED, "op5_near_duplicates": NEAR, "op8_reply_order": CHAT, "op9_quality_rules": QUALITY}
