"""DuckDB SQL of the registered queries of this subpackage that SQL can express."""

OP4 = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM t),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT k.*, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

#: Smallest reachable id over links (a, b) between nodes (id).
COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(greatest(1, len(w) - 4)),
    lambda i: array_to_string(w[i + 1:i + 5], ' '))) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),""" + COMPONENTS + """
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(least.b, s.doc_id)) AS component_id
FROM s LEFT JOIN least ON least.a = s.doc_id
"""

OP10 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),""" + COMPONENTS + """,
n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
  vec_id <= coalesce(least.b, vec_id) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

OP12 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
least AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
lab AS (SELECT doc_id AS label_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
          max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w.w) < 50 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w.w)) < 65 * len(w.w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * length(w.text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(w.text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN least.least < w.doc_id THEN 'E' ELSE '' END) AS fails
  FROM w JOIN least ON w.text = least.text LEFT JOIN lab ON lab.label_id = w.doc_id),
k AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
p AS (SELECT '' AS o UNION ALL SELECT p.o || x FROM p, letters WHERE NOT contains(p.o, x)),
s AS (SELECT o, step, substr(o, step, 1) AS own, substr(o, 1, step - 1) AS earlier
  FROM p, (SELECT unnest(range(1, 6)) AS step) WHERE length(o) = 5),
r AS (SELECT k.part, s.o, s.step, s.own, k.n, k.good, k.toxic, contains(fails, s.own) AS failing, fails = s.own AS only_this,
    len(list_filter(string_split(fails, ''), lambda x: x <> '' AND contains(s.earlier, x))) > 0 AS gone
  FROM k, s),
t AS (SELECT part, o, step, any_value(own) AS own,
    coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE failing AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE only_this), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE failing AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE failing AND NOT gone), 0) AS toxic_lost
  FROM r GROUP BY part, o, step)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM t
"""

ORACLE = {"op4_line_dedup": OP4, "op8_jaccard_join": OP8, "op10_cap_filters": OP10, "op12_filter_audit": OP12}
