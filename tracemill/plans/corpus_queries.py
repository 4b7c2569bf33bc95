"""Queries that profile, filter, sample and format the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.text import canonical_target, logic_skeleton, normalize_answer, problem_key, sentences, word_count
from tracemill.operators import contamination, formats, phrases, profile, resume, sampling
from tracemill.plans.registry import WS, lower, query, strip, table
from tracemill.sources.readers import shard_output_name
from tracemill.streaming.incremental import windowed_counts

_WORDS = r"CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT)"
_THINK = rf"""CASE WHEN len(regexp_extract_all(text, '(?is)<think>(.*?)</think>', 1)) > 0
  THEN array_to_string(list_transform(regexp_extract_all(text, '(?is)<think>(.*?)</think>', 1), lambda s: {strip('s')}), chr(10))
  WHEN instr(lower(text), '<think>') > 0 THEN {strip("substr(text, instr(lower(text), '<think>') + 7)")} ELSE {strip('text')} END"""


@query(f"""SELECT count(n) AS n, avg(n) AS mean, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.95) AS p95,
  quantile_cont(n, 0.99) AS p99, max(n) AS longest FROM (SELECT {_WORDS} AS n FROM documents WHERE text IS NOT NULL)""")
def length_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.length_profile(table(spark, folder, "documents"), "text")


@query(f"""WITH w AS (SELECT {_WORDS} AS n FROM documents WHERE text IS NOT NULL), a AS (SELECT list_sort(list(n)) AS l, count(*) AS c, max(n) AS longest, avg(n) AS mean FROM w)
SELECT longest, mean, l[1 + CAST(least(floor(c * 0.9), c - 1) AS BIGINT)] AS p90, l[1 + CAST(least(floor(c * 0.95), c - 1) AS BIGINT)] AS p95,
  l[1 + CAST(least(floor(c * 0.99), c - 1) AS BIGINT)] AS p99, CAST((l[1 + CAST(least(floor(c * 0.95), c - 1) AS BIGINT)] // 512 + 1) * 512 AS BIGINT) AS suggested FROM a""")
def length_profile_index_pct(spark: SparkSession, folder: str) -> DataFrame:
    return profile.length_profile_index(table(spark, folder, "documents"), "text")


@query(f"""WITH w AS (SELECT doc_id, CAST(length({_THINK}) AS BIGINT) AS think_char_len FROM documents WHERE text IS NOT NULL),
a AS (SELECT list_sort(list(think_char_len)) AS l, count(*) AS c FROM w),
cut AS (SELECT l[1 + CAST(round_even(CAST(0.7 AS DOUBLE) * (c - 1), 0) AS BIGINT)] AS cut FROM a)
SELECT doc_id, think_char_len, CASE WHEN think_char_len > cut THEN 'long' ELSE 'short' END AS route FROM w, cut""")
def p70_length_routing(spark: SparkSession, folder: str) -> DataFrame:
    return profile.route_by_length(table(spark, folder, "documents"), "text").select("doc_id", "think_char_len", "route")


@query(f"""WITH w AS (SELECT CAST(length({_THINK}) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL)
SELECT count(*) AS n, min(n) AS shortest, max(n) AS longest, avg(n) AS mean, list_sort(list(n))[1 + CAST(round_even(CAST(0.7 AS DOUBLE) * (count(*) - 1), 0) AS BIGINT)] AS cut FROM w""")
def think_length_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.think_length_profile(table(spark, folder, "documents"), "text")


@query("""SELECT source, doc_id, length FROM (SELECT source, doc_id, CAST(length(text) AS BIGINT) AS length,
  row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1""")
def longest_doc_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return profile.longest_text(table(spark, folder, "documents"), "source", "text", "doc_id")


@query(f"""WITH n AS (SELECT CASE WHEN generations IS NULL THEN -1 ELSE CAST(len(list_filter(generations, lambda g: g IS NOT NULL AND {strip('g')} <> '')) AS INT) END AS n_generations FROM problems)
SELECT CAST(n_generations AS INT) AS n_generations, count(*) AS rows, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct FROM n GROUP BY n_generations""")
def generation_count_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.generations_histogram(table(spark, folder, "problems"))


@query(f"""SELECT count(*) AS rows, count_if(generations IS NULL) AS missing,
  count_if(generations IS NOT NULL AND len(list_filter(generations, lambda g: g IS NOT NULL AND {strip('g')} <> '')) = 0) AS all_empty,
  avg(coalesce(len(generations), 0)) AS mean_entries FROM problems""")
def generation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.generations_summary(table(spark, folder, "problems"))


@query("""WITH f AS (SELECT coalesce(len(is_reasoning_complete), 0) AS n, coalesce(len(list_filter(is_reasoning_complete, lambda x: NOT x)), 0) AS bad FROM problems)
SELECT count(*) AS rows, CAST(sum(n) AS BIGINT) AS flags, CAST(sum(bad) AS BIGINT) AS incomplete, count_if(bad > 0) AS rows_incomplete,
  CAST(sum(bad) AS DOUBLE) / sum(n) AS share_incomplete, CAST(count_if(bad > 0) AS DOUBLE) / count(*) AS share_rows FROM f""")
def completeness_report(spark: SparkSession, folder: str) -> DataFrame:
    return profile.completeness(table(spark, folder, "problems"))


@query("""SELECT count_if(ok) AS correct, count_if(NOT ok) AS incorrect, 100.0::DOUBLE * count_if(ok) / count(*) AS pct_correct
FROM (SELECT coalesce(verified_label = 'verified_correct', false) AS ok FROM selected WHERE status = 'ok')""")
def correctness_share(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").filter("status = 'ok'")
    return profile.correctness_share(rows, F.col("verified_label") == "verified_correct")


@query(f"""SELECT field, count(*) AS n FROM (SELECT CASE WHEN {strip('output')} <> '' THEN 'output' WHEN {strip('solution')} <> '' THEN 'solution' ELSE '' END AS field FROM selected) GROUP BY field""")
def field_usage(spark: SparkSession, folder: str) -> DataFrame:
    return profile.field_usage(table(spark, folder, "selected"), ["output", "solution"])


@query("SELECT row_id, item_id FROM problems p, benchmark_items b WHERE b.problem <> '' AND contains(p.problem, b.problem)")
def contamination_contains(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrase_hits(table(spark, folder, "problems"), table(spark, folder, "benchmark_items"), "row_id", "problem", "problem", "item_id")


def _answer(x: str) -> str:
    lowered = lower(strip(f"coalesce({x}, '')"))
    return rf"replace(replace(regexp_replace({lowered}, '\\boxed\{{(.*?)\}}', '\1', 'g'), '$', ''), ' ', '')"


_PAIRS = rf"""pairs AS (SELECT p.row_id, b.item_id, list_distinct(regexp_extract_all({lower('p.problem')}, '[a-z]+')) AS pw, list_distinct(regexp_extract_all({lower('b.problem')}, '[a-z]+')) AS bw
  FROM problems p JOIN benchmark_items b ON {_answer('p.answer')} = {_answer('b.answer')}),
hit AS (SELECT DISTINCT row_id FROM pairs WHERE len(list_intersect(pw, bw)) >= 0.5 * len(bw))"""


@query(f"WITH {_PAIRS} SELECT row_id FROM problems WHERE row_id NOT IN (SELECT row_id FROM hit)")
def decontaminate_normalized_equi(spark: SparkSession, folder: str) -> DataFrame:
    problems, bench = table(spark, folder, "problems"), table(spark, folder, "benchmark_items")
    hits = contamination.answer_matches(problems, bench, "row_id", contamination.word_overlap_judge())
    return contamination.without_matches(problems, hits, "row_id").select("row_id")


@query(f"SELECT row_id, {_answer('answer')} AS answer FROM problems")
def answer_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "problems").select("row_id", normalize_answer("answer").alias("answer"))


@query("SELECT row_id FROM problems WHERE md5(coalesce(problem, '')) NOT IN (SELECT problem_hash FROM selected WHERE status = 'ok' AND problem_hash IS NOT NULL)")
def resume_pending(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "selected").filter("status = 'ok'")
    return resume.pending_problems(table(spark, folder, "problems"), done).select("row_id")


@query("SELECT row_id FROM problems WHERE md5(coalesce(problem, '')) NOT IN (SELECT problem_hash FROM selected WHERE problem_hash IS NOT NULL)")
def resume_pending_union(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "selected")
    return resume.pending_problems(table(spark, folder, "problems"), done.filter("status = 'ok'"), done.filter("status <> 'ok'")).select("row_id")


_PROBES = {"circles": "Two circles", "stamps": "stamps", "unseen": "no such phrase"}
_PROBE_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in _PROBES.items())


@query(f"""SELECT name, count(row_id) AS n, max(row_id) AS last_key FROM (VALUES {_PROBE_ROWS}) AS v(name, pattern)
LEFT JOIN problems ON contains(problem, pattern) GROUP BY name""")
def keyword_probe(spark: SparkSession, folder: str) -> DataFrame:
    patterns = spark.createDataFrame(list(_PROBES.items()), "name string, pattern string")
    return contamination.last_mention(table(spark, folder, "problems"), patterns, "row_id", "problem")


_SKELETON = strip("regexp_replace(regexp_replace(" + lower("text") + r", '[0-9a-zA-Z+\-*/=()\[\]{}^$\\.,:;_]', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')")


@query(f"SELECT doc_id, {_SKELETON} AS skeleton FROM documents WHERE text IS NOT NULL")
def logic_skeletons(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter("text IS NOT NULL")
    return rows.select("doc_id", logic_skeleton("text").alias("skeleton"))


@query(rf"""SELECT doc_id, CAST(len(list_filter(list_transform(string_split_regex(regexp_replace({strip('text')}, '([.!?。！？]){WS}+', '\1' || chr(10), 'g'), '\n+'), lambda s: {strip('s')}), lambda s: s <> '')) AS INT) AS n_sentences
FROM documents WHERE text IS NOT NULL""")
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", F.size(sentences("text")).alias("n_sentences"))


_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace({strip('''regexp_replace(answer, '(?i)</?think>', '', 'g')''')}, '^[:：=\-{WS[1:-1]}]+', ''), '{WS}+', ' ', 'g'), '^[ \t\r\n.。]+|[ \t\r\n.。]+$', '', 'g')"


@query(
    rf"""SELECT row_id, regexp_replace(regexp_replace(regexp_replace({lower(_CLEAN)}, '\\(?:boxed|text|mathrm)\s*\{{([^{{}}]*)\}}', '\1', 'g'), '\\[a-zA-Z]+', '', 'g'), '[{WS[1:-1]}$`''".,;:，。；：]+', '', 'g') AS target
FROM problems WHERE answer IS NOT NULL"""
)
def target_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "problems").filter("answer IS NOT NULL").select("row_id", canonical_target("answer").alias("target"))


@query(f"SELECT {strip('instruction')} AS query, {strip('output')} AS response FROM selected WHERE {strip('instruction')} <> '' AND {strip('output')} <> ''")
def sft_query_response(spark: SparkSession, folder: str) -> DataFrame:
    return formats.query_response(table(spark, folder, "selected"))


@query("SELECT instruction, output FROM selected")
def sft_instruction(spark: SparkSession, folder: str) -> DataFrame:
    return formats.instruction_output(table(spark, folder, "selected"))


@query(f"""WITH r AS (SELECT row_id, {strip('messages[1].content')} AS u, generations[1:2] AS g FROM problems WHERE {strip('messages[1].content')} <> '' AND generations IS NOT NULL),
e AS (SELECT row_id, u, unnest(generate_series(0, len(g) - 1)) AS i, g FROM r WHERE len(g) > 0)
SELECT row_id, CAST(i AS INT) AS i, u AS question, {strip('g[i + 1]')} AS reply FROM e WHERE {strip('g[i + 1]')} <> ''""")
def sft_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = formats.chat_rows(table(spark, folder, "problems"), "row_id")
    return rows.select("row_id", "i", F.col("messages")[0]["content"].alias("question"), F.col("messages")[1]["content"].alias("reply"))


@query(f"""WITH r AS (SELECT coalesce({strip('messages[1].content')} <> '' AND len(generations) > 0, false) AS usable, coalesce(len(list_filter(generations[1:2], lambda g: g IS NOT NULL AND {strip('g')} <> '')), 0) AS made FROM problems)
SELECT CAST(coalesce(sum(CASE WHEN usable THEN made END), 0) AS BIGINT) AS valid, count_if(NOT usable) AS skipped FROM r""")
def sft_message_counts(spark: SparkSession, folder: str) -> DataFrame:
    return formats.chat_counts(table(spark, folder, "problems"))


@query(f"""WITH g AS (SELECT row_id, solution, list_filter(generations, lambda g: g IS NOT NULL AND {strip('g')} <> '') AS g FROM problems),
l AS (SELECT row_id, solution, g, list_max(list_transform(g, lambda x: length(x))) AS n FROM g)
SELECT row_id, CASE WHEN len(g) > 0 THEN 'generations' WHEN {strip('solution')} <> '' THEN 'solution' ELSE 'messages' END AS field,
  CAST(CASE WHEN len(g) > 0 THEN length({strip('list_filter(g, lambda x: length(x) = n)[1]')}) WHEN {strip('solution')} <> '' THEN length({strip('solution')}) END AS INT) AS n_chars
FROM l WHERE len(g) > 0 OR {strip('solution')} <> ''""")
def trace_text(spark: SparkSession, folder: str) -> DataFrame:
    problems = table(spark, folder, "problems")
    rows = problems.select("row_id", formats.trace_text(problems).alias("t")).filter("t.field IN ('generations', 'solution')")
    return rows.select("row_id", F.col("t.field").alias("field"), F.length("t.text").alias("n_chars"))


@query("SELECT doc_id FROM documents ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 300")
def exact_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.exact_sample(table(spark, folder, "documents").select("doc_id"), 300, "doc_id")


@query("""WITH t AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS total FROM documents),
s AS (SELECT doc_id, CAST(list_sum(list_transform(generate_series(1, 9), lambda i: CASE WHEN pos >= total * i // 10 THEN 1 ELSE 0 END)) AS INT) AS stratum FROM t),
r AS (SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('20260521-' || CAST(doc_id AS VARCHAR)), doc_id) AS k FROM s)
SELECT doc_id, stratum FROM r WHERE k <= 42 // 10 + CASE WHEN stratum < 42 % 10 THEN 1 ELSE 0 END""")
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_sample(table(spark, folder, "documents").select("doc_id"), 42, 10, "doc_id", seed=20260521)


@query("SELECT shard, count(*) AS rows, regexp_replace(shard || '.parquet', '^(train-\\d+)-of-\\d+\\.parquet$', 'optimized_\\1.jsonl') AS output_name FROM problems GROUP BY shard")
def shard_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems").groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumn("output_name", shard_output_name(F.concat("shard", F.lit(".parquet"))))


@query("""SELECT 'ok' AS part, problem_hash FROM selected WHERE status = 'ok' UNION ALL SELECT 'rest', problem_hash FROM selected WHERE status <> 'ok'""")
def shard_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").select("status", "problem_hash")
    ok = rows.filter("status = 'ok'").select(F.lit("ok").alias("part"), "problem_hash")
    return ok.unionByName(rows.filter("status <> 'ok'").select(F.lit("rest").alias("part"), "problem_hash"))


@query("""SELECT selected_id, len(list_distinct(list_concat(a, b))) AS n_any, len(list_intersect(list_distinct(a), list_distinct(b))) AS n_both,
  len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x))) AS n_only_a
FROM (SELECT selected_id, metadata.cot_a_tags AS a, metadata.cot_b_tags AS b FROM selected WHERE metadata.cot_a_tags IS NOT NULL AND metadata.cot_b_tags IS NOT NULL)""")
def set_ops(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").select("selected_id", F.col("metadata.cot_a_tags").alias("a"), F.col("metadata.cot_b_tags").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    size = lambda c: F.size(c).cast("bigint")
    return rows.select("selected_id", size(F.array_union("a", "b")).alias("n_any"), size(F.array_intersect("a", "b")).alias("n_both"), size(F.array_except("a", "b")).alias("n_only_a"))


@query("SELECT row_id, md5(problem) AS problem_hash FROM problems WHERE problem IS NOT NULL")
def problem_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "problems").filter("problem IS NOT NULL").select("row_id", problem_key("problem").alias("problem_hash"))


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS INT) AS n_words FROM documents WHERE text IS NOT NULL")
def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", word_count("text").alias("n_words"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windowed_counts(table(spark, folder, "events"), "ts", "event_type").withColumn("start", F.col("start").cast("timestamp_ntz"))
