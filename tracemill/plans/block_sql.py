"""SQL of boxes, targets and blocks, as chains of common table expressions over ``src(k, t)``."""

from __future__ import annotations

from tracemill.functions.text import ANNOUNCED, BLOCK_OPENERS
from tracemill.plans.registry import WS, canonical, clean, lines, sentences, strip

_OPENS = "'^(?:" + "|".join(BLOCK_OPENERS) + ")'"

#: ``box(k, i, v)``: the contents of closed boxes in order. Braces are counted over tokens, of which an escaped character is one.
BOXES = rf"""tk AS (SELECT k, t, regexp_extract_all(t, '(?s)\\.|[{{}}]|[^\\{{}}]+|\\') AS l FROM src WHERE t LIKE '%\boxed%'),
tok AS (SELECT k, i, l[i] AS x FROM (SELECT k, l, unnest(generate_series(1, len(l))) AS i FROM tk)),
pos AS (SELECT k, i, x, sum(length(x)) OVER w AS e, sum(CASE x WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER w AS d FROM tok WINDOW w AS (PARTITION BY k ORDER BY i)),
opened AS (SELECT pos.k, i, e, d, t FROM pos JOIN tk USING (k) WHERE x = '{{' AND regexp_matches(substr(t, 1, CAST(e AS BIGINT)), '\\boxed{WS}*\{{$')),
closed AS (SELECT o.k, o.i, any_value(o.t) AS t, any_value(o.e) AS a, min(p.e) AS b FROM opened o JOIN pos p ON p.k = o.k AND p.i > o.i AND p.x = '}}' AND p.d = o.d - 1 GROUP BY o.k, o.i),
box AS (SELECT k, i, v FROM (SELECT k, i, {strip('substr(t, CAST(a + 1 AS BIGINT), CAST(b - a - 1 AS BIGINT))')} AS v FROM closed) WHERE v <> '')"""


def _announced(x: str) -> str:
    one, two = (clean(f"regexp_extract({x}, '{p}', 1)") for p in (f"(?i){ANNOUNCED[0]}", ANNOUNCED[1]))
    return f"CASE WHEN {one} <> '' THEN {one} ELSE {two} END"


#: ``goal(k, targets)``: the targets of each text, those with the key of an earlier one left out.
TARGETS = f"""{BOXES},
bl AS (SELECT k, list(v ORDER BY i) AS l FROM box GROUP BY k),
sn AS (SELECT k, list_reverse(s[greatest(len(s) - 7, 1) :]) AS s FROM (SELECT k, {sentences('t')} AS s FROM src)),
an AS (SELECT k, coalesce(list_filter(list_transform(s, lambda x: {_announced('x')}), lambda x: x <> '')[1], {clean('s[1]')}) AS v FROM sn WHERE len(s) > 0),
raw AS (SELECT src.k, list_filter(list_transform(coalesce(bl.l, CASE WHEN an.v IS NULL THEN [] ELSE [an.v] END), lambda x: {clean('x')}), lambda x: x <> '') AS v FROM src LEFT JOIN bl USING (k) LEFT JOIN an USING (k)),
keyed AS (SELECT k, v, list_transform(v, lambda x: {canonical('x')}) AS keys FROM raw),
goal AS (SELECT k, list_transform(list_filter(generate_series(1, len(v)), lambda j: keys[j] = '' OR list_position(keys, keys[j]) = j), lambda j: v[j]) AS targets FROM keyed)"""

#: ``block(k, block_id, x)``: the blocks of each text. Needs WITH RECURSIVE.
BLOCKS = rf"""bare AS (SELECT k, t FROM (SELECT k, {strip(rf"regexp_replace({strip(f'''regexp_replace(coalesce(t, ''), '(?i)</?think>', '', 'g')''')}, '\r\n?', chr(10), 'g')")} AS t FROM src) WHERE t <> ''),
para AS (SELECT k, pid, l[pid] AS p FROM (SELECT k, l, unnest(generate_series(1, len(l))) AS pid FROM (SELECT k, list_filter(list_transform(string_split_regex(t, '\n{WS}*\n+'), lambda s: {strip('s')}), lambda s: s <> '') AS l FROM bare))),
row_ AS (SELECT k, pid, p, lid, l[lid] AS x, len(l) AS n FROM (SELECT k, pid, p, l, unnest(generate_series(1, len(l))) AS lid FROM (SELECT k, pid, p, {lines('p')} AS l FROM para))),
grouped AS (SELECT k, pid, lid, x, sum(CASE WHEN lid = 1 OR regexp_matches(x, {_OPENS}) THEN 1 ELSE 0 END) OVER (PARTITION BY k, pid ORDER BY lid) AS blk FROM row_ WHERE n > 1),
whole AS (SELECT k, pid, p FROM row_ WHERE n = 1 UNION ALL SELECT k, 0, t FROM bare),
cut AS (SELECT k, pid, p, CASE WHEN length(p) > 900 AND len(s) > 1 THEN s ELSE [p] END AS s FROM (SELECT k, pid, p, {sentences('p')} AS s FROM whole)),
sent AS (SELECT k, pid, j, s[j] AS x, length(s[j]) AS n, regexp_matches(s[j], {_OPENS}) AS opens FROM (SELECT k, pid, s, unnest(generate_series(1, len(s))) AS j FROM cut)),
fill AS (SELECT k, pid, j, x, n + 1 AS size, 1 AS blk FROM sent WHERE j = 1
  UNION ALL SELECT s.k, s.pid, s.j, s.x, CASE WHEN f.size + s.n > 900 AND s.opens THEN s.n ELSE f.size + s.n + 1 END, f.blk + CASE WHEN f.size + s.n > 900 AND s.opens THEN 1 ELSE 0 END FROM fill f JOIN sent s ON s.k = f.k AND s.pid = f.pid AND s.j = f.j + 1),
found AS (SELECT k, pid, blk, string_agg(x, chr(10) ORDER BY lid) AS x FROM grouped GROUP BY ALL UNION ALL SELECT k, pid, blk, string_agg(x, ' ' ORDER BY j) FROM fill GROUP BY ALL),
many AS (SELECT k, count(*) > 1 AS several FROM found WHERE pid > 0 GROUP BY k),
kept AS (SELECT found.k, x, row_number() OVER (PARTITION BY found.k ORDER BY pid, blk) AS idx FROM found JOIN many USING (k) WHERE CASE WHEN several THEN pid > 0 ELSE pid = 0 END),
marked AS (SELECT k, x, idx, sum(CASE WHEN idx = 1 OR length(x) >= 28 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY idx) AS blk FROM kept),
block AS (SELECT k, CAST(blk - 1 AS INT) AS block_id, string_agg(x, chr(10) ORDER BY idx) AS x FROM marked GROUP BY k, blk)"""

_STEP = rf"'^(?:\n?{WS}*(?i:Step|步骤){WS}*[0-9]+[:：.)]|\n?{WS}*[0-9]+{WS}*[.、)]{WS}+)'"

#: ``logic(k, block_id, x)``: the logic blocks of each text. Needs WITH RECURSIVE.
LOGIC = rf"""lt AS (SELECT k, t, list_filter(generate_series(2, length(t)), lambda p: regexp_matches(substr(t, p), {_STEP})) AS c FROM (SELECT k, {strip("coalesce(t, '')")} AS t FROM src) WHERE t <> ''),
lc AS (SELECT k, t, list_concat([1], c) AS a, list_append(c, length(t) + 1) AS b FROM lt),
lp AS (SELECT k, list_filter(list_transform(flatten(list_transform(generate_series(1, len(a)), lambda i: string_split_regex(substr(t, a[i], b[i] - a[i]), '\n{WS}*\n+'))), lambda s: {strip('s')}), lambda s: s <> '') AS l FROM lc),
lb AS (SELECT k, pid, l[pid] AS p FROM (SELECT k, l, unnest(generate_series(1, len(l))) AS pid FROM lp)),
ls AS (SELECT k, pid, CASE WHEN length(p) > 900 THEN list_filter(list_transform(string_split_regex(regexp_replace(p, '([。！？.!?；;]){WS}+', '\1' || chr(10), 'g'), '\n+'), lambda s: {strip('s')}), lambda s: s <> '') ELSE [p] END AS s FROM lb),
lj AS (SELECT k, pid, j, s[j] AS x, length(s[j]) AS n FROM (SELECT k, pid, s, unnest(generate_series(1, len(s))) AS j FROM ls)),
lf AS (SELECT k, pid, j, x, n AS size, 1 AS blk FROM lj WHERE j = 1
  UNION ALL SELECT s.k, s.pid, s.j, s.x, CASE WHEN f.size >= 180 AND f.size + s.n > 900 THEN s.n ELSE f.size + s.n END, f.blk + CASE WHEN f.size >= 180 AND f.size + s.n > 900 THEN 1 ELSE 0 END FROM lf f JOIN lj s ON s.k = f.k AND s.pid = f.pid AND s.j = f.j + 1),
logic AS (SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY pid, blk) - 1 AS INT) AS block_id, x FROM (SELECT k, pid, blk, string_agg(x, ' ' ORDER BY j) AS x FROM lf GROUP BY ALL))"""
