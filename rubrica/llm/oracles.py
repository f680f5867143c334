"""SQL of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from . import mixing, url_tree

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
WITH d AS (SELECT doc_id, {_FOLD.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""

MIX = f"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '{mixing.WORDS}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS turn FROM s),
w AS (SELECT *, CASE (turn - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM r),
l AS (SELECT *, row_number() OVER o AS place,
    ((SELECT sum(source_size) FROM s) * CAST(1.5 AS DOUBLE)
      - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY source_size / weight, turn)),
c AS (SELECT min_by(level, place) AS common FROM l WHERE level * weight <= source_size * 2),
t AS (SELECT source, source_size,
    coalesce(least(CAST(source_size * 2 AS DOUBLE), common * weight), CAST(source_size * 2 AS DOUBLE)) AS target
  FROM l, c),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM j"""

AUDIT = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
     regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
  FROM w LEFT JOIN l USING (doc_id)),
k AS (SELECT *, len(list_filter(fails, lambda f: f)) AS m FROM d),
c AS (SELECT part, fails, good, bad, m, count(*) AS n FROM k GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o, [a.i, b.i, c.i, d.i, e.i] AS i FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT array_to_string(o, '') AS filter_order, i, CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step FROM o),
j AS (SELECT c.*, filter_order, step, fails[i[step]] AS own,
    len(list_filter(i[1:step - 1], lambda q: fails[q])) > 0 AS earlier FROM c, s)
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (NOT own AND NOT earlier), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (own AND NOT earlier), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (own AND earlier), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (own AND m = 1), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(n) FILTER (own AND NOT earlier AND good), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(n) FILTER (own AND NOT earlier AND bad), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * 120 // m) FILTER (own), 0) AS BIGINT) AS shapley
FROM j GROUP BY ALL"""


def _rule(rules, value: str) -> str:
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2]), reverse=True)
    whens = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') "
        f"THEN '{a if value == 'said' else h + p}'" for a, h, p in order)
    return f"CASE {whens} END AS {value}"


def urls(rules) -> str:
    u = url_tree
    levels, last = [], "t0"
    for i in range(1, u.DEPTH + 1):
        levels.append(f"""
c{i} AS (SELECT host, template, s[{i + 1}] AS seg, sum(n) AS n FROM {last} WHERE len(s) > {i} GROUP BY ALL),
k{i} AS (SELECT c.host, c.template, c.seg FROM c{i} c
  JOIN (SELECT host, template, sum(n) AS total FROM c{i} GROUP BY ALL) a USING (host, template)
  WHERE c.n >= {u.SUPPORT} AND c.n >= total * CAST({u.SHARE} AS DOUBLE)),
t{i} AS (SELECT t.host, t.path, t.n, t.labelled, t.blocked, t.s,
    CASE WHEN len(t.s) <= {i} THEN t.template WHEN k.seg IS NOT NULL THEN t.template || '/' || k.seg
      WHEN regexp_matches(t.s[{i + 1}], '^[0-9]+$') THEN t.template || '/{{n}}'
      WHEN regexp_matches(t.s[{i + 1}], '^[0-9]+[.][a-z]+$')
        THEN t.template || '/{{n}}' || regexp_extract(t.s[{i + 1}], '[.][a-z]+$')
      ELSE t.template || '/{{*}}' END AS template
  FROM {last} t LEFT JOIN k{i} k ON t.host = k.host AND t.template = k.template AND t.s[{i + 1}] = k.seg)""")
        last = f"t{i}"
    purity = f"(blocked + {u.PRIOR} * base) / (labelled + {u.PRIOR})"
    return f"""
WITH p AS (SELECT page_id,
    {_FOLD.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
q AS (SELECT *, {_rule(rules, 'rule')}, {_rule(rules, 'said')} FROM p),
t0 AS (SELECT host, path, count(*) AS n, count(said) AS labelled, count(*) FILTER (said = 'block') AS blocked,
    string_split(path, '/') AS s, '' AS template FROM q GROUP BY host, path),{",".join(levels)},
t AS (SELECT host, path, labelled, blocked,
    template || CASE WHEN len(s) > {u.DEPTH + 1} THEN '/{{**}}' ELSE '' END AS template FROM {last}),
b AS (SELECT CASE WHEN sum(labelled) > 0 THEN sum(blocked) / CAST(sum(labelled) AS DOUBLE) ELSE 0.0 END AS base FROM t),
e AS (SELECT host, template, sum(labelled) AS labelled, sum(blocked) AS blocked FROM t GROUP BY ALL),
f AS (SELECT host, template, labelled, blocked, base,
    regexp_replace(template, '/[^{{/]+', '/*', 'g') AS skeleton, floor({purity} * 10) AS tenth FROM e, b),
m AS (SELECT host, skeleton, tenth, base, sum(labelled) AS labelled, sum(blocked) AS blocked FROM f GROUP BY ALL),
g AS (SELECT f.host, f.template, (m.blocked + {u.PRIOR} * m.base) / (m.labelled + {u.PRIOR}) AS purity
  FROM f JOIN m USING (host, skeleton, tenth))
SELECT q.page_id, q.host, q.path, q.rule, t.template, round(g.purity, 6) AS purity,
  coalesce(q.said, CASE WHEN g.purity >= {u.REJECT} THEN 'block' ELSE 'allow' END) AS verdict
FROM q JOIN t USING (host, path) JOIN g ON t.host = g.host AND t.template = g.template"""
