"""DuckDB SQL of the queries of this package that SQL can express."""

#: The current rows of scored, shared by several queries.
CURRENT = """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY coalesce(trace_id, chr(1) || CAST(score_id AS VARCHAR)) ORDER BY scored_at DESC NULLS LAST, score_id DESC) AS rn
  FROM scored WHERE status = 'ok') WHERE rn = 1"""

P1_FOUND = f"""WITH cur AS ({CURRENT})
SELECT _cluster, score_id FROM (
  SELECT _cluster, score_id, row_number() OVER (PARTITION BY _cluster ORDER BY global_score DESC,
      CASE WHEN isfinite(IFD_Score) THEN IFD_Score END DESC NULLS LAST, output_chars ASC NULLS LAST, score_id) AS p
  FROM cur WHERE _cluster IS NOT NULL AND global_score IS NOT NULL AND NOT isnan(global_score)) WHERE p <= 3"""

_FUSED = f"""WITH cur AS ({CURRENT}),
v AS (SELECT judge_batch, score_id,
    CASE WHEN isfinite(winner_score) THEN winner_score ELSE CAST('-inf' AS DOUBLE) END AS a,
    CASE WHEN isfinite(IFD_Score) THEN IFD_Score ELSE CAST('-inf' AS DOUBLE) END AS b,
    CASE problem_difficulty WHEN 'Easy' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Hard' THEN 3 ELSE 0 END AS c
  FROM cur WHERE judge_batch IS NOT NULL),
r AS (SELECT judge_batch, score_id,
    rank() OVER (PARTITION BY judge_batch ORDER BY a DESC) AS ra, rank() OVER (PARTITION BY judge_batch ORDER BY b DESC) AS rb,
    rank() OVER (PARTITION BY judge_batch ORDER BY c DESC) AS rc FROM v),
o AS (SELECT judge_batch, score_id, list_sort([ra, rb, rc]) AS l FROM r),
f AS (SELECT judge_batch, score_id, CAST(1 AS DOUBLE) / (60 + l[1]) + CAST(1 AS DOUBLE) / (60 + l[2]) + CAST(1 AS DOUBLE) / (60 + l[3]) AS fusion FROM o)
"""

P7_FUSION = _FUSED + "SELECT judge_batch, score_id, fusion FROM f"
P7_FOUND = _FUSED + "SELECT judge_batch, score_id FROM (SELECT judge_batch, score_id, row_number() OVER (PARTITION BY judge_batch ORDER BY fusion DESC, score_id) AS p FROM f) WHERE p = 1"

_LEAKS = """WITH t AS (SELECT row_id, regexp_extract_all(lower(problem), '[\\p{L}\\p{N}]+') AS w FROM problems WHERE problem IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(problem), '[\\p{L}\\p{N}]+') AS w FROM benchmark_items WHERE problem IS NOT NULL),
p AS (SELECT DISTINCT item_id, len(w[s : s + least(12, len(w)) - 1]) AS n, array_to_string(w[s : s + least(12, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(12, len(w)) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT DISTINCT row_id, n, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM (SELECT row_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM t, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT row_id, item_id FROM g JOIN p USING (n, g))
"""
P6_FOUND = _LEAKS + "SELECT row_id, item_id FROM hit"
P6_ITEMS = _LEAKS + "SELECT item_id, count(*) AS n_records FROM hit GROUP BY item_id"

#: Positions count from 1 here; a stretch of six is repeated from its second start on.
P2_FOUND = """WITH g AS (SELECT row_id, i AS gen_pos, regexp_extract_all(lower(generations[i + 1]), '[\\p{L}\\p{N}]+') AS w
  FROM (SELECT row_id, generations, unnest(generate_series(0, len(generations) - 1)) AS i FROM problems WHERE len(generations) > 0) WHERE generations[i + 1] IS NOT NULL),
s AS (SELECT row_id, gen_pos, p, array_to_string(w[p : p + 5], ' ') AS gram FROM (SELECT row_id, gen_pos, w, unnest(generate_series(1, len(w) - 5)) AS p FROM g WHERE len(w) >= 6)),
again AS (SELECT row_id, gen_pos, p FROM (SELECT row_id, gen_pos, p, row_number() OVER (PARTITION BY row_id, gen_pos, gram ORDER BY p) AS k FROM s) WHERE k > 1),
c AS (SELECT row_id, gen_pos, count(DISTINCT q) AS n FROM (SELECT row_id, gen_pos, unnest(generate_series(p, p + 5)) AS q FROM again) GROUP BY ALL)
SELECT row_id, CAST(gen_pos AS INT) AS gen_pos FROM c JOIN g USING (row_id, gen_pos) WHERE CAST(n AS DOUBLE) / len(w) >= 0.3"""



def _measures() -> str:
    """Covered words and characters for stretches of 3, 6 and 12 words, and lines that repeat an earlier one."""
    parts = []
    for n in (3, 6, 12):
        parts.append(f"""s{n} AS (SELECT row_id, gen_pos, p, array_to_string(w[p : p + {n - 1}], ' ') AS gram FROM (SELECT row_id, gen_pos, w, unnest(generate_series(1, len(w) - {n - 1})) AS p FROM g WHERE len(w) >= {n})),
a{n} AS (SELECT row_id, gen_pos, p FROM (SELECT row_id, gen_pos, p, row_number() OVER (PARTITION BY row_id, gen_pos, gram ORDER BY p) AS k FROM s{n}) WHERE k > 1),
c{n} AS (SELECT row_id, gen_pos, count(*) AS words_{n}, CAST(sum(length(w[q])) AS BIGINT) AS chars_{n} FROM (SELECT DISTINCT row_id, gen_pos, unnest(generate_series(p, p + {n - 1})) AS q FROM a{n}) JOIN g USING (row_id, gen_pos) GROUP BY ALL)""")
    zero = ", ".join(f"coalesce({k}_{n}, 0) AS {k}_{n}" for n in (3, 6, 12) for k in ("words", "chars"))
    return f"""WITH t AS (SELECT row_id, CAST(i AS INT) AS gen_pos, coalesce(generations[i + 1], '') AS t FROM (SELECT row_id, generations, unnest(generate_series(0, len(generations) - 1)) AS i FROM problems WHERE len(generations) > 0)),
g AS (SELECT row_id, gen_pos, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS w, list_filter(list_transform(string_split(lower(t), chr(10)), lambda x: array_to_string(regexp_extract_all(x, '[\\p{{L}}\\p{{N}}]+'), ' ')), lambda x: x <> '') AS l FROM t),
{", ".join(parts)}
SELECT row_id, gen_pos, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS n_chars, {zero}, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS lines_repeated
FROM g LEFT JOIN c3 USING (row_id, gen_pos) LEFT JOIN c6 USING (row_id, gen_pos) LEFT JOIN c12 USING (row_id, gen_pos)"""


#: The near rows of a row are its whole group, as groups are far apart in these tables.
P3_FOUND = f"""WITH cur AS ({CURRENT}),
v AS (SELECT score_id, CAST(embedding AS DOUBLE[]) AS e FROM cur WHERE len(embedding) = 32 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT score_id, e FROM v WHERE list_max(list_transform(e, lambda x: abs(x))) > 0)
SELECT min(a.score_id) AS rep_id, b.score_id AS member_id FROM u a JOIN u b ON a.score_id < b.score_id AND list_cosine_similarity(a.e, b.e) >= 0.95 GROUP BY b.score_id"""

ORACLE = {"p1_found": P1_FOUND, "p2_found": P2_FOUND, "p2_measures": _measures(), "p3_found": P3_FOUND, "p6_found": P6_FOUND, "p6_items": P6_ITEMS, "p7_found": P7_FOUND, "p7_fusion": P7_FUSION}
