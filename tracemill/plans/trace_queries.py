"""Queries about traces: loops, pairs, scores, clusters, blocks, markers, rewritings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.arrays import or_empty
from tracemill.functions.blocks import udf_blocks, udf_logic_blocks
from tracemill.functions.parsing import targets, udf_boxed
from tracemill.functions.text import DEPENDENCY_TOKEN, MATH_SIGN, NON_SUPPORTING_MARKERS, NUMBER, REASONING_MARKERS, STOPWORDS
from tracemill.operators import clusters, compression, contamination, judging, loops, phrases, pruning, refinement, selection
from tracemill.plans.block_sql import BLOCKS, BOXES, LOGIC, TARGETS
from tracemill.plans.registry import WS, canonical, lower, query, strip, table
from tracemill.sources.stage import staged

# --- loops -----------------------------------------------------------------------

_ALNUM = r"[0-9a-zA-Z+\-*/=()\[\]{}^$\\.,:;_]"


def _loop_sql(least: int, line_times: int, words: int, span: int, word_times: int, lines: int) -> str:
    """CTEs that give ``kind`` per generation (``row_id, i, t``)."""
    skeleton = strip(rf"regexp_replace(regexp_replace({lower('t')}, '{_ALNUM}', ' ', 'g'), '{WS}+', ' ', 'g')")
    return rf"""z AS (SELECT row_id, unnest(generate_series(0, len(generations) - 1)) AS i, generations, is_reasoning_complete AS c FROM problems WHERE len(generations) > 0),
g AS (SELECT row_id, i, generations[i + 1] AS t, coalesce(c[i + 1], false) AS done FROM z),
l AS (SELECT row_id, i, t, done, list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip('x')}), lambda x: length(x) > 30) AS ls, string_split({skeleton}, ' ') AS ws FROM g),
s3 AS (SELECT row_id, i, array_to_string(ls[k : k + 2], '|') AS s FROM (SELECT row_id, i, ls, unnest(generate_series(1, len(ls) - 2)) AS k FROM l WHERE len(ls) > {lines})),
b3 AS (SELECT row_id, i, max(n) AS n3 FROM (SELECT row_id, i, s, count(*) AS n FROM s3 GROUP BY ALL) GROUP BY ALL),
s10 AS (SELECT row_id, i, array_to_string(ws[k : k + {span - 1}], ' ') AS s FROM (SELECT row_id, i, ws, unnest(generate_series(1, len(ws) - {span - 1})) AS k FROM l WHERE len(ws) > {words})),
b10 AS (SELECT row_id, i, max(n) AS n10 FROM (SELECT row_id, i, s, count(*) AS n FROM s10 GROUP BY ALL) GROUP BY ALL),
k AS (SELECT row_id, CAST(i AS INT) AS i, t, done, CASE WHEN length(t) < {least} THEN 'Valid' WHEN coalesce(n3, 0) >= {line_times} THEN 'Physical Loop'
  WHEN coalesce(n10, 0) >= {word_times} THEN 'Skeleton Loop' ELSE 'Valid' END AS kind FROM l LEFT JOIN b3 USING (row_id, i) LEFT JOIN b10 USING (row_id, i) WHERE t IS NOT NULL)"""


def _generations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems").select("row_id", F.posexplode("generations").alias("i", "t"))
    return rows.filter("t IS NOT NULL")


@query(f"WITH {_loop_sql(2000, 5, 50, 10, 6, 20)} SELECT row_id, i, kind FROM k")
def loop_detect(spark: SparkSession, folder: str) -> DataFrame:
    return _generations(spark, folder).select("row_id", "i", loops.loop_kind(F.col("t")).alias("kind"))


@query(f"WITH {_loop_sql(300, 2, 8, 4, 3, 4)} SELECT row_id, i, kind FROM k")
def loop_detect_lowthr(spark: SparkSession, folder: str) -> DataFrame:
    kind = loops.loop_kind(F.col("t"), least_chars=300, line_times=2, words=8, word_span=4, word_times=3, lines=4)
    return _generations(spark, folder).select("row_id", "i", kind.alias("kind"))


def _fold_sql(most: int) -> str:
    before, after = (x.replace("\n", "' || chr(10) || '") for x in loops.FOLD_MARK.split("{}"))
    return (
        f"CASE WHEN length(t) <= {most} THEN t ELSE array_to_string(ls[1:40], chr(10)) || '{before}' || CAST(len(ls) - 80 AS VARCHAR) || '{after}' "
        f"|| array_to_string(CASE WHEN len(ls) <= 40 THEN ls ELSE ls[len(ls) - 39 :] END, chr(10)) END"
    )


@query(f"""WITH g AS (SELECT row_id, i, generations[i + 1] AS t FROM (SELECT row_id, generations, unnest(generate_series(0, len(generations) - 1)) AS i FROM problems WHERE len(generations) > 0)),
l AS (SELECT row_id, i, t, string_split(t, chr(10)) AS ls FROM g WHERE t IS NOT NULL)
SELECT row_id, CAST(i AS INT) AS i, md5({_fold_sql(1000)}) AS folded FROM l""")
def fold_long_text(spark: SparkSession, folder: str) -> DataFrame:
    return _generations(spark, folder).select("row_id", "i", F.md5(loops.folded(F.col("t"), 1000).cast("binary")).alias("folded"))


@query(f"""WITH {_loop_sql(2000, 5, 50, 10, 6, 20)}, d AS (SELECT kind, CAST(length(t) AS BIGINT) AS pre, string_split(t, chr(10)) AS ls, t FROM k WHERE done),
f AS (SELECT kind, pre, CAST(length({_fold_sql(4000)}) AS BIGINT) AS post FROM d)
SELECT count(*) AS checked, count_if(kind = 'Physical Loop') AS physical, count_if(kind = 'Skeleton Loop') AS skeleton,
  CAST(floor(CAST(sum(pre) FILTER (kind <> 'Valid') AS DOUBLE) / count_if(kind <> 'Valid')) AS BIGINT) AS mean_before,
  CAST(floor(CAST(sum(post) FILTER (kind <> 'Valid') AS DOUBLE) / count_if(kind <> 'Valid')) AS BIGINT) AS mean_after,
  max(pre) FILTER (kind <> 'Valid') AS longest_before, max(post) FILTER (kind <> 'Valid') AS longest_after,
  1.0::DOUBLE - CAST(sum(post) FILTER (kind <> 'Valid') AS DOUBLE) / sum(pre) FILTER (kind <> 'Valid') AS saved FROM f""")
def loop_repair_report(spark: SparkSession, folder: str) -> DataFrame:
    return loops.repair_report(table(spark, folder, "problems"))


@query("""WITH z AS (SELECT row_id, list_filter(list_transform(generate_series(1, len(generations)), lambda i: {'t': generations[i], 'd': coalesce(is_reasoning_complete[i], false), 'c': coalesce(correctness_math_verify[i], false)}), lambda g: g.d) AS z
  FROM problems WHERE len(generations) > 0)
SELECT row_id, CAST(len(z) AS INT) AS n, md5(array_to_string(list_transform(z, lambda g: coalesce(g.t, '~')), '|')) AS texts, CAST(len(list_filter(z, lambda g: g.c)) AS INT) AS n_correct FROM z WHERE len(z) > 0""")
def parallel_array_compaction(spark: SparkSession, folder: str) -> DataFrame:
    rows = loops.complete_only(table(spark, folder, "problems"))
    joined = F.array_join(F.transform("generations", lambda t: F.coalesce(t, F.lit("~"))), "|")
    return rows.select("row_id", F.size("generations").alias("n"), F.md5(joined.cast("binary")).alias("texts"), F.size(F.filter("correctness_math_verify", lambda x: x)).alias("n_correct"))


# --- pairs and scores ---------------------------------------------------------------


@query("""WITH r AS (SELECT row_id, i, CAST(length(generations[i + 1]) AS BIGINT) AS n FROM (SELECT row_id, generations, unnest(generate_series(0, len(generations) - 1)) AS i FROM problems WHERE len(generations) > 0) WHERE generations[i + 1] IS NOT NULL),
m AS (SELECT row_id, list_sort(list(n))[count(*) // 2 + 1] AS m FROM r GROUP BY row_id HAVING count(*) >= 2),
v AS (SELECT r.* FROM r JOIN m USING (row_id) WHERE n >= 0.5 * m),
m2 AS (SELECT row_id, list_sort(list(n))[count(*) // 2 + 1] AS m FROM v GROUP BY row_id HAVING count(*) >= 2),
o AS (SELECT row_id, i, row_number() OVER (PARTITION BY row_id ORDER BY abs(n - m), n, i) AS k FROM v JOIN m2 USING (row_id))
SELECT row_id, CAST(max(i) FILTER (k = 1) AS INT) AS a, CAST(max(i) FILTER (k = 2) AS INT) AS b FROM o GROUP BY row_id""")
def pick_pair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems").select("row_id", selection.pick_pair(F.col("generations")).alias("p"))
    return rows.filter("p IS NOT NULL").select("row_id", "p.a", "p.b")


def _case(items: dict[str, float], x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in items.items()) + " ELSE 0.0::DOUBLE END"


def _score_sql(tags: str, issues: str, label: str) -> str:
    total = lambda a, t: f"coalesce(list_sum(list_transform(coalesce({a}, []), lambda x: {_case(t, 'x')})), 0.0::DOUBLE)"
    raw = f"(CASE WHEN {label} = 'verified_correct' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END + {total(tags, selection.QUALITY_WEIGHT)} - {total(issues, selection.ISSUE_PENALTY)})"
    caps = " ".join(f"WHEN list_contains(coalesce({issues}, []), '{i}') THEN least({raw}, {c}::DOUBLE)" for i, c in selection.SEVERE_CAPS)
    return f"CASE {caps} ELSE {raw} END"


_A = _score_sql("metadata.cot_a_tags", "metadata.cot_a_issues", "metadata.label_a")
_B = _score_sql("metadata.cot_b_tags", "metadata.cot_b_issues", "metadata.label_b")
_SCORED = f"SELECT selected_id, problem_difficulty, metadata, {_A} AS a, {_B} AS b FROM selected WHERE status = 'ok'"


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").filter("status = 'ok'")
    score = lambda x: selection.selection_score(F.col(f"metadata.cot_{x}_tags"), F.col(f"metadata.cot_{x}_issues"), F.col(f"metadata.label_{x}"))
    return rows.withColumn("a", score("a")).withColumn("b", score("b"))


@query(f"SELECT selected_id, a, b FROM ({_SCORED})")
def selection_score(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select("selected_id", "a", "b")


@query(f"SELECT selected_id, greatest(a, b) + {_case(selection.DIFFICULTY_BONUS, 'problem_difficulty')} AS global_score FROM ({_SCORED})")
def global_score(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select("selected_id", selection.global_score(F.greatest("a", "b"), F.col("problem_difficulty")).alias("global_score"))


@query("""SELECT selected_id, CASE WHEN verified_label = 'verified_correct' THEN (10.0::DOUBLE + 2.5::DOUBLE * len(list_filter(list_distinct(coalesce(metadata.cot_a_tags, [])), lambda t: t IN ('Deep', 'Present', 'Exploratory', 'Cohesive'))))
  * CASE problem_difficulty WHEN 'Hard' THEN 1.2::DOUBLE WHEN 'Easy' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END ELSE 0.0::DOUBLE END AS score FROM selected WHERE status = 'ok'""")
def score_v1(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").filter("status = 'ok'")
    return rows.select("selected_id", selection.process_score(F.col("verified_label") == "verified_correct", F.col("metadata.cot_a_tags"), F.col("problem_difficulty")).alias("score"))


@query(f"""SELECT selected_id, CASE WHEN a > b THEN 'a' WHEN b > a THEN 'b' WHEN metadata.cot_b_length < metadata.cot_a_length THEN 'b' ELSE 'a' END AS winner FROM ({_SCORED})""")
def pairwise_winner(spark: SparkSession, folder: str) -> DataFrame:
    best = selection.winner(F.col("a"), F.col("b"), F.col("metadata.cot_a_length"), F.col("metadata.cot_b_length"))
    return _scores(spark, folder).select("selected_id", best.alias("winner"))


@query("""WITH g AS (SELECT row_id, is_reasoning_complete AS d, correctness_math_verify AS c, unnest(generate_series(0, len(generations) - 1)) AS i FROM problems WHERE len(generations) > 0)
SELECT row_id, CAST(i AS INT) AS i, CASE WHEN coalesce(CASE WHEN len(d) > i THEN d[i + 1] WHEN len(c) > i THEN c[i + 1] END, false) THEN 'verified_correct' ELSE 'unverified_or_wrong' END AS label FROM g""")
def verified_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems").select("row_id", "is_reasoning_complete", "correctness_math_verify", F.posexplode("generations").alias("i", "_t"))
    return rows.select("row_id", "i", selection.verified_label(F.col("i")).alias("label"))


_TAGS = "('" + "', '".join(selection.QUALITY_WEIGHT) + "')"
_ISSUES = "('" + "', '".join(selection.ISSUE_PENALTY) + "')"


def _unknown(a: str, known: str) -> str:
    return f"len(list_filter(coalesce({a}, []), lambda x: x NOT IN {known})) > 0"


@query(f"""SELECT selected_id, CASE WHEN NOT coalesce(problem_difficulty IN ('Hard', 'Medium', 'Easy'), false) THEN 'problem_difficulty'
  WHEN {_unknown('metadata.cot_a_tags', _TAGS)} THEN 'cot_a.quality_tags' WHEN {_unknown('metadata.cot_a_issues', _ISSUES)} THEN 'cot_a.issues'
  WHEN {_unknown('metadata.cot_b_tags', _TAGS)} THEN 'cot_b.quality_tags' WHEN {_unknown('metadata.cot_b_issues', _ISSUES)} THEN 'cot_b.issues'
  WHEN NOT coalesce(metadata.judge_winner IN ('a', 'b'), false) THEN 'winner' END AS problem FROM selected WHERE status = 'ok'""")
def judge_validate(spark: SparkSession, folder: str) -> DataFrame:
    m = "metadata."
    error = judging.judgement_error(F.col("problem_difficulty"), F.col(m + "cot_a_tags"), F.col(m + "cot_a_issues"), F.col(m + "cot_b_tags"), F.col(m + "cot_b_issues"), F.col(m + "judge_winner"))
    return table(spark, folder, "selected").filter("status = 'ok'").select("selected_id", error.alias("problem"))


# --- clusters ----------------------------------------------------------------------


def _top_sql(score: str, least: int) -> str:
    return f"""WITH r AS (SELECT score_id, global_score, IFD_Score, row_number() OVER (PARTITION BY _cluster ORDER BY {score} DESC NULLS LAST, IFD_Score DESC NULLS LAST, output_chars ASC NULLS FIRST, score_id) AS p,
  greatest({least}, floor(count(*) OVER (PARTITION BY _cluster) * 0.8::DOUBLE)) AS most FROM scored WHERE status = 'ok'),
s AS (SELECT score_id, CASE WHEN p <= most THEN 'high' ELSE 'low' END AS split, global_score, IFD_Score FROM r) """


def _top(spark: SparkSession, folder: str, score: str, keep_one: bool) -> DataFrame:
    rows = table(spark, folder, "scored").filter("status = 'ok'")
    order = [F.col(score).desc_nulls_last(), F.col("IFD_Score").desc_nulls_last(), F.col("output_chars").asc_nulls_first(), F.col("score_id")]
    return selection.ranked_share(rows, "score_id", "_cluster", order, 0.8, keep_one)


@query(_top_sql("global_score", 1) + "SELECT score_id, split FROM s")
def cluster_topk_v2(spark: SparkSession, folder: str) -> DataFrame:
    return _top(spark, folder, "global_score", True).select("score_id", "split")


@query(_top_sql("winner_score", 0) + "SELECT score_id, split FROM s")
def cluster_topk_v1(spark: SparkSession, folder: str) -> DataFrame:
    return _top(spark, folder, "winner_score", False).select("score_id", "split")


@query(f"SELECT 'ok' AS status, count(*) AS n FROM selected WHERE status = 'ok' UNION ALL SELECT 'failed', count(*) FROM selected WHERE status = 'judge_failed' UNION ALL SELECT 'skipped', count(*) FROM problems WHERE len(list_filter(coalesce(generations, []), lambda g: g IS NOT NULL)) < 2 OR generations IS NULL")
def selection_summary(spark: SparkSession, folder: str) -> DataFrame:
    """How many problems gave a pair, failed in judging, or were skipped for lack of two traces."""
    done, problems = table(spark, folder, "selected"), table(spark, folder, "problems")
    counts = done.select(F.when(F.col("status") == "ok", "ok").when(F.col("status") == "judge_failed", "failed").alias("status")).unionByName(
        problems.filter(F.size(F.filter(or_empty("generations"), lambda g: g.isNotNull())) < 2).select(F.lit("skipped").alias("status"))
    )
    every = spark.createDataFrame([("ok",), ("failed",), ("skipped",)], "status string")
    found = counts.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return every.join(found, "status", "left").select("status", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query(_top_sql("global_score", 1) + """SELECT split, count(*) AS n, round(avg(CASE WHEN NOT isnan(global_score) AND NOT isinf(global_score) THEN global_score END), 6) AS avg_score,
  round(avg(CASE WHEN NOT isnan(IFD_Score) AND NOT isinf(IFD_Score) THEN IFD_Score END), 6) AS avg_ifd FROM s GROUP BY split""")
def cluster_split_summary(spark: SparkSession, folder: str) -> DataFrame:
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.col(c))
    scores = table(spark, folder, "scored").select("score_id", finite("global_score").alias("global_score"), finite("IFD_Score").alias("IFD_Score"))
    rows = _top(spark, folder, "global_score", True).join(scores, "score_id")
    out = selection.split_summary(rows, "global_score", "IFD_Score")
    return out.select("split", "n", F.round("avg_score", 6).alias("avg_score"), F.round("avg_ifd", 6).alias("avg_ifd"))


@query()
def kmeans_cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "scored").filter("status = 'ok' AND size(embedding) = 32")
    model = clusters.fit_kmeans(rows, "embedding", 40)
    return clusters.with_clusters(rows, "embedding", model).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


# --- blocks and targets ----------------------------------------------------------------

_OUTPUTS = "src AS (SELECT selected_id AS k, output AS t FROM selected WHERE output IS NOT NULL)"
_DOCS = "src AS (SELECT doc_id AS k, text AS t FROM documents)"


@query(f"WITH {_OUTPUTS}, {BOXES} SELECT selected_id, coalesce((SELECT list(v ORDER BY i) FROM box WHERE k = selected_id), []) AS boxed FROM selected WHERE output IS NOT NULL")
def boxed_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "selected").filter("output IS NOT NULL").select("selected_id", udf_boxed("output").alias("boxed"))


@query(f"WITH RECURSIVE {_DOCS}, {BLOCKS} SELECT k AS doc_id, block_id, x AS text FROM block")
def segment_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.posexplode(udf_blocks("text")).alias("block_id", "text"))


@query(f"WITH RECURSIVE {_OUTPUTS}, {LOGIC} SELECT k AS selected_id, block_id, x AS text FROM logic")
def logic_block_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").filter("output IS NOT NULL")
    return rows.select("selected_id", F.posexplode(udf_logic_blocks("output")).alias("block_id", "text"))


@query(f"WITH src AS (SELECT selected_id AS k, coalesce(output, '') AS t FROM selected WHERE status = 'ok'), {TARGETS} SELECT k AS selected_id, targets FROM goal")
def trace_targets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "selected").filter("status = 'ok'").select("selected_id", targets("output").alias("targets"))


def _any_sql(x: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({lower(x)}, '{p}')" for p in phrases) + ")"


def _tokens_sql(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return rf"list_filter(list_distinct(regexp_extract_all(regexp_replace({lower(x)}, '\\[a-zA-Z]+', ' ', 'g'), '{DEPENDENCY_TOKEN}')), lambda t: t NOT IN ({stop}) AND length(t) > 1)"


def _facts_sql(x: str) -> str:
    return f"{canonical(x)} AS key, {_tokens_sql(x)} AS tokens, list_distinct(regexp_extract_all({x}, '{NUMBER}')) AS numbers"


#: ``st``: statistics of each text with blocks and targets; ``e``: which block supports which target; ``bad``: what is missing elsewhere.
_SUPPORT = rf"""src AS (SELECT selected_id AS k, coalesce(output, '') AS t FROM selected WHERE status = 'ok'), {TARGETS}, {BLOCKS},
bf AS (SELECT k, block_id, x, {_facts_sql('x')}, {_any_sql('x', REASONING_MARKERS)} OR regexp_matches(x, '{MATH_SIGN}') AS signal, {_any_sql('x', NON_SUPPORTING_MARKERS)} AS marked FROM block),
tf AS (SELECT k, target, x, {_facts_sql('x')} FROM (SELECT k, CAST(j - 1 AS INT) AS target, targets[j] AS x FROM (SELECT k, targets, unnest(generate_series(1, len(targets))) AS j FROM goal))),
e AS (SELECT bf.k, block_id, target FROM bf JOIN tf USING (k) WHERE (tf.key <> '' AND contains(bf.key, tf.key)) OR (NOT (marked OR (len(bf.tokens) <= 1 AND NOT regexp_matches(bf.x, '\\boxed|\d|[=<>]'))) AND signal AND (
   (len(tf.tokens) > 0 AND (len(list_intersect(tf.tokens, bf.tokens)) = len(tf.tokens) OR len(list_intersect(tf.tokens, bf.tokens)) >= 2))
   OR (len(tf.numbers) > 0 AND len(list_intersect(tf.numbers, bf.numbers)) = len(tf.numbers))))),
w AS (SELECT k, block_id, len(regexp_extract_all(x, '\S+')) AS n, EXISTS (SELECT 1 FROM e WHERE e.k = block.k AND e.block_id = block.block_id) AS kept FROM block),
st AS (SELECT k, CAST(count(*) AS INT) AS num_blocks, CAST(count_if(kept) AS INT) AS num_supporting, CAST(count_if(kept) AS DOUBLE) / count(*) AS compression_ratio_blocks,
  CAST(sum(n) AS INT) AS num_tokens_total, CAST(coalesce(sum(n) FILTER (kept), 0) AS INT) AS num_tokens_supporting,
  coalesce((SELECT CAST(count(DISTINCT target) AS DOUBLE) FROM e WHERE e.k = w.k) / nullif((SELECT len(targets) FROM goal WHERE goal.k = w.k), 0), 0.0::DOUBLE) AS target_coverage FROM w GROUP BY k)"""


def _traces(spark: SparkSession, folder: str) -> DataFrame:
    return compression.compressed(table(spark, folder, "selected").filter("status = 'ok'"), "selected_id", "output")


def _stats(spark: SparkSession, folder: str) -> DataFrame:
    return _traces(spark, folder).filter("num_blocks > 0")


@query(f"WITH RECURSIVE {_SUPPORT} SELECT k AS selected_id, block_id, target FROM e")
def block_target_edges(spark: SparkSession, folder: str) -> DataFrame:
    return _traces(spark, folder).select("selected_id", F.explode("dependency_graph").alias("e")).select("selected_id", F.col("e.block").alias("block_id"), "e.target")


@query(f"WITH RECURSIVE {_SUPPORT} SELECT k AS selected_id, num_blocks, num_supporting, compression_ratio_blocks, target_coverage, num_tokens_total, num_tokens_supporting FROM st")
def compression_stats_per_doc(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder).select("selected_id", "num_blocks", "num_supporting", "compression_ratio_blocks", "target_coverage", "num_tokens_total", "num_tokens_supporting")


@query(f"""WITH RECURSIVE {_SUPPORT}, l AS (SELECT list_sort(list(compression_ratio_blocks)) AS l, count(*) AS n FROM st)
SELECT count(*) AS n, round(avg(compression_ratio_blocks), 9) AS mean_ratio, quantile_cont(compression_ratio_blocks, 0.5) AS median_ratio, round(avg(target_coverage), 9) AS mean_coverage, avg(num_blocks) AS mean_blocks,
  count_if(compression_ratio_blocks >= 0.99) AS all_supporting, count_if(compression_ratio_blocks <= 0.01) AS none_supporting, count_if(compression_ratio_blocks < 0.2) AS very_high, count_if(compression_ratio_blocks > 0.9) AS very_low,
  any_value(l.l[1 + CAST(least(floor(l.n * 10 / 100.0), l.n - 1) AS BIGINT)]) AS p10, any_value(l.l[1 + CAST(least(floor(l.n * 90 / 100.0), l.n - 1) AS BIGINT)]) AS p90, any_value(l.l[1 + l.n // 2]) AS upper_median FROM st, l""")
def compression_batch_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = compression.batch_summary(_stats(spark, folder))
    return out.withColumns({"mean_ratio": F.round("mean_ratio", 9), "mean_coverage": F.round("mean_coverage", 9)})


def _bins_sql(x: str, edges: list, shape: str, last: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} >= {a} AND {x} < {b} THEN '{shape.format(a, b)}'" for a, b in zip(edges, edges[1:], strict=False)) + f" ELSE '{last}' END"


@query(f"""WITH RECURSIVE {_SUPPORT} SELECT kind, bin, count(*) AS n FROM (
  SELECT 'ratio' AS kind, {_bins_sql('compression_ratio_blocks', compression.RATIO_EDGES, '{:.1f}-{:.1f}', '1.0')} AS bin FROM st
  UNION ALL SELECT 'blocks', {_bins_sql('num_blocks', compression.BLOCK_EDGES, '{}-{}', '100+')} FROM st) GROUP BY ALL""")
def compression_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return compression.histograms(_stats(spark, folder))


@query(f"""WITH RECURSIVE {_SUPPORT}, a AS (SELECT 'very_high_compression' AS kind, k FROM st WHERE compression_ratio_blocks < 0.1 UNION ALL SELECT 'very_low_compression', k FROM st WHERE compression_ratio_blocks > 0.95
  UNION ALL SELECT 'zero_supporting', k FROM st WHERE num_supporting = 0 UNION ALL SELECT 'full_supporting', k FROM st WHERE num_supporting = num_blocks)
SELECT kind, count(*) AS n, list_sort(list(k))[1:10] AS first_keys FROM a GROUP BY kind""")
def compression_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return compression.anomalies(_stats(spark, folder), "selected_id")


@query(f"""WITH RECURSIVE {_SUPPORT} SELECT src.k AS selected_id, CASE WHEN {strip('t')} = '' THEN 'empty_cot' WHEN len(targets) = 0 THEN 'empty_target' WHEN st.k IS NULL THEN 'empty_blocks' END AS error,
  CAST(len(targets) AS INT) AS num_targets, coalesce(num_blocks, 0) AS num_blocks, coalesce((SELECT list(DISTINCT block_id ORDER BY block_id) FROM e WHERE e.k = src.k), []) AS supporting_blocks,
  coalesce((SELECT list(block_id ORDER BY block_id) FROM w WHERE w.k = src.k AND NOT kept), []) AS redundant_blocks FROM src JOIN goal USING (k) LEFT JOIN st USING (k)""")
def compressed_traces(spark: SparkSession, folder: str) -> DataFrame:
    return _traces(spark, folder).select("selected_id", "error", "num_targets", "num_blocks", "supporting_blocks", "redundant_blocks")


@query("SELECT coalesce(error, 'unknown') AS type, count(*) AS n FROM selected WHERE status <> 'ok' GROUP BY ALL")
def failure_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return compression.failure_kinds(table(spark, folder, "selected").filter("status <> 'ok'"), "error")


# --- pruning -------------------------------------------------------------------------------


@query()
def backward_prune_heuristic(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", udf_blocks("text").alias("blocks")).filter("size(blocks) > 0")
    return rows.withColumn("p", pruning.udf_needed("blocks")).select("doc_id", F.size("blocks").alias("n_blocks"), "p.kept", "p.jump")


# --- rewritings -----------------------------------------------------------------------------

_REFINE = """r AS (SELECT selected_id, output, solution AS new_output, verified_label = 'verified_correct' AS old_ok, score_b > score_a AS new_ok, problem_difficulty FROM selected WHERE status = 'ok' AND output IS NOT NULL),
p AS (SELECT *, CASE WHEN new_output IS NULL THEN 'Error' WHEN NOT coalesce(old_ok, false) AND coalesce(new_ok, false) THEN 'A' WHEN coalesce(old_ok, false) AND NOT coalesce(new_ok, false) THEN 'B'
  WHEN coalesce(old_ok, false) AND coalesce(new_ok, false) THEN CASE WHEN (CASE WHEN length(output) > 0 THEN CAST(length(new_output) AS DOUBLE) / length(output) ELSE 1.0 END) < 0.7 AND regexp_matches(new_output, '(?i)step \\d') THEN 'C_Success' ELSE 'C_Fail' END
  ELSE 'D' END AS path FROM r)"""


def _refine(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").filter("status = 'ok' AND output IS NOT NULL")
    return rows.select(
        "selected_id", "problem_difficulty", "output", F.col("solution").alias("new_output"),
        (F.col("verified_label") == "verified_correct").alias("old_correct"), (F.col("score_b") > F.col("score_a")).alias("new_correct"),
    )


@query(f"WITH {_REFINE} SELECT selected_id, path FROM p")
def refine_routing(spark: SparkSession, folder: str) -> DataFrame:
    path = refinement.refine_path(F.col("old_correct"), F.col("new_correct"), F.col("output"), F.col("new_output"))
    return _refine(spark, folder).select("selected_id", path.alias("path"))


@query(f"WITH {_REFINE} SELECT v.path, count(p.path) AS n FROM (VALUES ('A'), ('B'), ('C_Success'), ('C_Fail'), ('D'), ('Error')) AS v(path) LEFT JOIN p USING (path) GROUP BY v.path")
def refine_path_counts(spark: SparkSession, folder: str) -> DataFrame:
    return refinement.path_counts(refine_routing(spark, folder))


@query(f"""WITH {_REFINE} SELECT selected_id, output FROM r WHERE old_ok UNION ALL
SELECT selected_id, new_output FROM p WHERE path IN ('A', 'C_Success', 'D') AND problem_difficulty IN ('Easy', 'Medium')""")
def audit_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = _refine(spark, folder)
    known = F.when(F.col("problem_difficulty").isin("Easy", "Medium", "Hard"), F.col("problem_difficulty") == "Hard")
    reports = rows.select("selected_id", known.alias("is_cheating"))
    base = rows.filter("old_correct").select("selected_id", "output")
    return refinement.audited_union(base, refinement.refined(rows).select("selected_id", "output"), reports, "selected_id")


@query("SELECT CASE WHEN problem_difficulty = 'Hard' THEN 'cheat' WHEN problem_difficulty IN ('Easy', 'Medium') THEN 'pass' ELSE 'error' END AS status, count(*) AS n FROM selected GROUP BY ALL")
def audit_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    known = F.when(F.col("problem_difficulty").isin("Easy", "Medium", "Hard"), F.col("problem_difficulty") == "Hard")
    return refinement.audit_counts(table(spark, folder, "selected").select(known.alias("is_cheating")))


@query(f"""WITH {_loop_sql(2000, 5, 50, 10, 6, 20)}, hit AS (SELECT DISTINCT row_id FROM problems p, benchmark_items b WHERE b.problem <> '' AND contains(p.problem, b.problem)),
f AS (SELECT row_id, count(*) - arg_min(length(t), i) / 10000.0::DOUBLE AS score FROM k WHERE done AND kind = 'Valid' GROUP BY row_id),
r AS (SELECT row_id, source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, row_id) AS p, greatest(1, floor(count(*) OVER (PARTITION BY source) * 0.8::DOUBLE)) AS most
  FROM f JOIN problems USING (row_id) WHERE row_id NOT IN (SELECT row_id FROM hit))
SELECT row_id, source, score FROM r WHERE p <= most""")
def high_quality_split(spark: SparkSession, folder: str) -> DataFrame:
    """From raw problems to the high split: contamination out, loops out, then the best share of each source by trace length."""
    problems, bench = table(spark, folder, "problems"), table(spark, folder, "benchmark_items")
    hits = phrases.phrase_hits(problems, bench, "row_id", "problem", "problem", "item_id")
    rows = loops.complete_only(contamination.without_matches(problems, hits, "row_id"))
    sound = F.filter(or_empty("generations"), lambda t: t.isNotNull() & (loops.loop_kind(t) == "Valid"))
    rows = rows.withColumn("_sound", sound).filter(F.size("_sound") > 0)
    rows = rows.select("row_id", "source", (F.size("_sound") - F.length(F.get("_sound", F.lit(0))) / 10000.0).alias("score"))
    split = selection.ranked_share(staged(rows, "sound"), "row_id", "source", [F.col("score").desc()], 0.8, keep=("source", "score"))
    return split.filter("split = 'high'").select("row_id", "source", "score")
