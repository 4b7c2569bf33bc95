"""Queries about single texts and fields: think spans, boxes, forms, previews, fields, labels, answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions import text
from tracemill.functions.blocks import udf_form, udf_marker_blocks
from tracemill.functions.parsing import udf_all_text, udf_flat_text, udf_last_boxed, udf_prompt_blocks, udf_think, udf_with_answer, udf_with_think
from tracemill.operators import answers, clusters, compression, formats, markers, profile, refinement, sampling, selection
from tracemill.plans.block_sql import BLOCKS, BOXES
from tracemill.plans.registry import WS, clean, lower, query, sentences, strip, table

_OK = "SELECT * FROM selected WHERE status = 'ok'"


def _ok(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "selected").filter("status = 'ok'")


# --- think spans, boxes, forms -----------------------------------------------------------


@query(f"""WITH r AS (SELECT doc_id, text AS t, regexp_matches(text, '(?is)<think>.*?</think>') AS tagged FROM documents WHERE text IS NOT NULL)
SELECT doc_id, tagged, CASE WHEN tagged THEN {strip("regexp_extract(t, '(?is)<think>(.*?)</think>', 1)")} ELSE {strip('t')} END AS think,
  CASE WHEN tagged THEN {strip("regexp_replace(t, '(?is)^.*?<think>.*?</think>', '')")} ELSE '' END AS final,
  CASE WHEN tagged THEN regexp_replace(t, '(?is)^(.*?<think>).*?(</think>)', '\\1x = 1\\2') ELSE 'x = 1' END AS spliced FROM r""")
def think_parts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").filter("text IS NOT NULL").withColumn("p", udf_think("text"))
    return docs.select("doc_id", "p.think", "p.final", "p.tagged", udf_with_think("text", F.lit("x = 1")).alias("spliced"))


@query(f"""WITH src AS (SELECT selected_id AS k, coalesce(output, '') AS t FROM selected WHERE status = 'ok'), {BOXES},
f AS (SELECT k, arg_min(a, i) AS a, arg_min(b, i) AS b FROM closed GROUP BY k), r AS (SELECT selected_id, coalesce(output, '') AS t, {strip("coalesce(answer, '')")} AS v FROM selected WHERE status = 'ok')
SELECT selected_id, CASE WHEN a IS NOT NULL THEN substr(t, 1, CAST(a AS BIGINT)) || v || substr(t, CAST(b AS BIGINT)) ELSE rtrim(t, chr(10)) || chr(10) || 'Final Answer' || chr(10) || '\\boxed{{' || v || '}}' END AS text FROM r LEFT JOIN f ON k = selected_id""")
def truth_injected(spark: SparkSession, folder: str) -> DataFrame:
    return _ok(spark, folder).select("selected_id", udf_with_answer("output", "answer").alias("text"))


def _form_sql(x: str) -> str:
    shown = r"CASE WHEN regexp_full_match(x, '[a-z_]+') THEN CASE WHEN length(x) > 1 OR x = '_' THEN 'VAR' ELSE ' ' END WHEN (regexp_matches(x, '^[\\$\p{Nd}]') AND x <> '\') OR regexp_matches(x, '^[-+].') THEN ' ' ELSE x END"
    parts = rf"regexp_extract_all({lower(x)}, '(?s)\\[a-z]+|\$+|\\[()\[\]]|[-+]?\p{{Nd}}+(?:\.\p{{Nd}}+)?|[\p{{L}}\p{{Nl}}\p{{No}}_]+|.')"
    return strip(f"regexp_replace(array_to_string(list_transform({parts}, lambda x: {shown}), ''), '{WS}+', ' ', 'g')")


@query(f"SELECT doc_id, {_form_sql('text')} AS form FROM documents WHERE text IS NOT NULL")
def block_forms(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", udf_form("text").alias("form"))


_STOP = ", ".join(f"'{w}'" for w in text.OVERLAP_STOPWORDS)


@query(rf"SELECT doc_id, list_sort(list_filter(list_distinct(regexp_extract_all(regexp_replace({lower('text')}, '\\[a-zA-Z]+', ' ', 'g'), '{text.OVERLAP_TOKEN}')), lambda t: t NOT IN ({_STOP}))) AS tokens FROM documents WHERE text IS NOT NULL")
def overlap_token_sets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", F.array_sort(text.overlap_tokens("text")).alias("tokens"))


_MARKED = ["Therefore", "Thus", "Hence", "So", "Then", "Now"]
_BOUNDED = "'(?i)(?:^|[^A-Za-z0-9_])(" + "|".join(_MARKED) + ")$'"


@query(rf"""WITH t0 AS (SELECT doc_id AS k, {strip(r"regexp_replace(text, '\r\n?', chr(10), 'g')")} AS t FROM documents WHERE text IS NOT NULL),
m AS (SELECT k, t, list_filter(generate_series(2, length(t)), lambda p: regexp_matches(substr(t, p, 12), '^(?i:{"|".join(_MARKED)})(?:[^A-Za-z0-9_]|$)') AND NOT regexp_matches(substr(t, p - 1, 1), '[A-Za-z0-9_]')) AS c FROM t0),
c1 AS (SELECT k, t, list_filter(list_transform(generate_series(1, len(c) + 1), lambda i: {strip("substr(t, CASE WHEN i = 1 THEN 1 ELSE c[i - 1] END, CASE WHEN i = len(c) + 1 THEN length(t) + 1 ELSE c[i] END - CASE WHEN i = 1 THEN 1 ELSE c[i - 1] END)")}), lambda s: s <> '') AS a FROM m),
c2 AS (SELECT k, CASE WHEN len(a) > 2 THEN a ELSE CASE WHEN len(p) > 2 THEN p ELSE s END END AS l FROM (SELECT k, a, list_filter(list_transform(string_split_regex(t, '\n{WS}*\n+'), lambda s: {strip('s')}), lambda s: s <> '') AS p,
  list_filter(list_transform(string_split(regexp_replace(t, '([.!?。！？]){WS}+', '\1' || chr(1), 'g'), chr(1)), lambda s: {strip('s')}), lambda s: s <> '') AS s FROM c1)),
c3 AS (SELECT k, flatten(list_transform(l, lambda b: CASE WHEN len(list_filter(string_split(b, chr(10)), lambda s: {strip('s')} <> '')) > 1 AND (len(string_split(b, chr(10))) > 2 OR len(regexp_extract_all(b, '\S+')) > 60)
  THEN list_filter(list_transform(string_split(b, chr(10)), lambda s: {strip('s')}), lambda s: s <> '') ELSE [b] END)) AS l FROM c2),
c4 AS (SELECT k, i, l[i] AS x, sum(CASE WHEN i = 1 OR length(l[i]) >= 32 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) AS blk FROM (SELECT k, l, unnest(generate_series(1, len(l))) AS i FROM c3))
SELECT k AS doc_id, CAST(blk - 1 AS INT) AS block_id, string_agg(x, chr(10) || chr(10) ORDER BY i) AS text FROM c4 GROUP BY k, blk""")
def marker_block_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter("text IS NOT NULL")
    return rows.select("doc_id", F.posexplode(udf_marker_blocks("text", _MARKED)).alias("block_id", "text"))


@query(rf"""WITH RECURSIVE src AS (SELECT selected_id AS k, output AS t FROM selected WHERE status = 'ok'), {BLOCKS},
p AS (SELECT k, block_id, '[BLOCK ' || block_id || ']' || chr(10) || CASE WHEN length(x) > 1500 THEN substr(x, 1, 750) || chr(10) || '[...]' || chr(10) || right(x, 750) ELSE x END AS p FROM block),
r AS (SELECT k, block_id, p, sum(length(p) + 2) OVER (PARTITION BY k ORDER BY block_id) - 2 AS size, count(*) OVER (PARTITION BY k) AS n FROM p),
g AS (SELECT k, any_value(n) AS n, count_if(size <= 1200) AS fit, max(size) AS whole, string_agg(p, chr(10) || chr(10) ORDER BY block_id) FILTER (size <= 1200) AS kept, string_agg(p, chr(10) || chr(10) ORDER BY block_id) AS every FROM r GROUP BY k)
SELECT k AS selected_id, CASE WHEN whole <= 1200 THEN every ELSE CASE WHEN fit > 0 THEN kept || chr(10) || chr(10) ELSE '' END || chr(10) || '[... ' || (n - fit) || ' more blocks truncated ...]' END AS shown FROM g""")
def prompt_blocks(spark: SparkSession, folder: str) -> DataFrame:
    from tracemill.functions.blocks import udf_blocks

    rows = _ok(spark, folder).select("selected_id", udf_blocks("output").alias("b")).filter("size(b) > 0")
    return rows.select("selected_id", udf_prompt_blocks("b", 1200).alias("shown"))


@query(rf"""WITH r AS (SELECT doc_id, regexp_replace({strip('text')}, '{WS}+', ' ', 'g') AS s, text AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN length(s) <= 100 THEN s ELSE substr(s, 1, 100) || '...' END AS head, CASE WHEN length(s) <= 60 THEN s ELSE '...' || right(s, 60) END AS tail,
  CASE WHEN length(t) > 400 THEN substr(t, 1, 150) || chr(10) || '[...]' || chr(10) || right(t, 150) ELSE t END AS middle_out FROM r""")
def previews(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", text.preview("text").alias("head"), text.preview("text", 60, True).alias("tail"), text.middle_out("text", 400, 150).alias("middle_out"))


@query(f"SELECT row_id, i, truth FROM (SELECT row_id, CAST(i AS INT) AS i, CASE i WHEN 0 THEN coalesce({strip('lower(answer)')} IN ('true', 'yes', 'y', '1', '是', '有用', '充分'), false) OR coalesce(TRY_CAST(CASE WHEN regexp_full_match({strip('answer')}, '[-+]?[0-9]+(\\.[0-9]+)?') THEN {strip('answer')} END AS DOUBLE) <> 0, false) ELSE coalesce(is_reasoning_complete[1], false) END AS truth FROM problems, (VALUES (0), (1)) v(i))")
def coerced_truth(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems")
    both = F.posexplode(F.array(text.coerce_bool("answer"), text.coerce_bool(F.get("is_reasoning_complete", F.lit(0))))).alias("i", "truth")
    return rows.select("row_id", both)


@query(f"SELECT doc_id, count_if(regexp_matches(s, '^(?:{'|'.join(text.BLOCK_OPENERS)})')) AS n_openers, coalesce(any_value({clean('f')}), '') AS first FROM (SELECT doc_id, unnest(l) AS s, l[1] AS f FROM (SELECT doc_id, {sentences('text')} AS l FROM documents WHERE text IS NOT NULL)) GROUP BY doc_id")
def opener_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", text.sentences("text").alias("s")).filter("size(s) > 0")
    return rows.select("doc_id", F.size(F.filter("s", text.opens_block)).cast("bigint").alias("n_openers"), text.clean_target(F.get("s", F.lit(0))).alias("first"))


# --- fields ----------------------------------------------------------------------------------


@query(f"""WITH r AS (SELECT *, CASE WHEN selected_id % 3 > 0 THEN 'u' || selected_id END AS uid FROM selected), src AS (SELECT selected_id AS k, coalesce(output, '') AS t FROM selected), {BOXES}
SELECT selected_id, coalesce(uid, CAST(selected_id AS VARCHAR)) AS sample_id, CASE WHEN {strip('problem')} <> '' THEN {strip('problem')} WHEN {strip('instruction')} <> '' THEN {strip('instruction')} ELSE '' END AS question, problem AS benchmark_question,
  CASE WHEN {strip('answer')} <> '' THEN {strip('answer')} ELSE coalesce((SELECT arg_min(v, i) FROM box WHERE k = selected_id), '') END AS answer FROM r""")
def record_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected")
    own = rows.select("selected_id", "problem", "answer", "output", F.col("instruction").alias("prompt"), F.when(F.col("selected_id") % 3 > 0, F.concat(F.lit("u"), "selected_id")).alias("uid"), F.col("selected_id").alias("index"))
    return own.select("selected_id", formats.sample_id(own, F.lit("")).alias("sample_id"), formats.question_text(own).alias("question"), formats.benchmark_question(own).alias("benchmark_question"), formats.final_answer(F.col("answer"), F.coalesce("output", F.lit(""))).alias("answer"))


@query("""SELECT row_id, CASE WHEN messages IS NULL THEN '' ELSE array_to_string(list_transform(messages, lambda m: coalesce(m.content, m.role, '')), chr(10)) END AS flat,
  CASE WHEN messages IS NULL THEN '' ELSE coalesce(array_to_string(list_transform(messages, lambda m: coalesce(m.role, '') || coalesce(m.content, '')), ''), '') END AS leaves,
  coalesce(array_to_string(list_filter(generations, lambda g: g IS NOT NULL), chr(10)), '') AS joined, generations IS NULL AS missing FROM problems""")
def flattened_cells(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems").withColumn("j", F.to_json("messages"))
    return rows.select("row_id", udf_flat_text("j").alias("flat"), udf_all_text("j").alias("leaves"), F.coalesce(formats.all_generations(F.col("generations")), F.lit("")).alias("joined"), F.col("generations").isNull().alias("missing"))


@query("""SELECT row_id, CASE WHEN generations IS NULL OR row_id % 5 = 0 THEN 0 ELSE len(generations) END AS n, CASE WHEN row_id % 5 > 0 THEN generations[1] END AS first FROM problems""")
def json_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Lists that came as JSON text, every fifth one cut off: what doesn't parse counts as missing."""
    cell = F.when(F.col("row_id") % 5 == 0, F.concat(F.lit('["'), F.col("row_id"))).otherwise(F.to_json("generations"))
    rows = table(spark, folder, "problems").select("row_id", text.json_strings(cell).alias("g"))
    return rows.select("row_id", F.coalesce(F.size("g"), F.lit(0)).cast("bigint").alias("n"), F.get("g", F.lit(0)).alias("first"))


@query("""SELECT row_id, coalesce(length(generations[1]) <= 1500 AND length(generations[2]) <= 1500, false) AS usable, coalesce(len(generations), 0) >= 2 AS two FROM problems""")
def first_two_usable(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "problems")
    return rows.select("row_id", selection.first_two_short(F.col("generations"), 1500).alias("usable"), F.coalesce(F.size("generations") >= 2, F.lit(False)).alias("two"))


@query("SELECT selected_id, CASE judge WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE 0 END AS chosen FROM (SELECT selected_id, CASE WHEN selected_id % 4 = 3 THEN 'x' ELSE CAST(selected_id % 4 AS VARCHAR) END AS judge FROM selected)")
def chosen_index(spark: SparkSession, folder: str) -> DataFrame:
    said = F.when(F.col("selected_id") % 4 == 3, "x").otherwise((F.col("selected_id") % 4).cast("string"))
    return table(spark, folder, "selected").select("selected_id", selection.chosen_index(said).alias("chosen"))


@query("""SELECT selected_id, metadata.judge_reason AS reason, CASE WHEN selected_id % 2 = 0 THEN 'logic' END AS error_type, right(output, 600) AS tail FROM selected WHERE status = 'ok'""")
def critic_reports(spark: SparkSession, folder: str) -> DataFrame:
    rows = _ok(spark, folder)
    reports = rows.filter("selected_id % 2 = 0").select("selected_id", F.lit("logic").alias("error_type"), F.lit("").alias("error_span"), F.lit("").alias("advice"))
    own = refinement.with_report(rows, reports, "selected_id")
    cases = refinement.bad_cases(rows, "selected_id").select("selected_id", "tail")
    return own.select("selected_id", F.col("metadata.judge_reason").alias("reason"), F.col("metadata.critic_report.error_type").alias("error_type")).join(cases, "selected_id")


@query(r"""WITH r AS (SELECT selected_id, output AS t, coalesce(length(output) - length(replace(output, '\boxed{', '')), 0) // 7 AS n FROM selected WHERE status = 'ok'),
l AS (SELECT selected_id, n, CASE WHEN n > 0 THEN string_split(t, '\boxed{')[-1] END AS rest, t FROM r),
d AS (SELECT selected_id, rest, list_filter(generate_series(1, length(rest)), lambda i: substr(rest, i, 1) = '}' AND length(replace(substr(rest, 1, i), '{', '')) - length(replace(replace(substr(rest, 1, i), '{', ''), '}', '')) = length(substr(rest, 1, i)) - length(replace(substr(rest, 1, i), '{', '')) + 1)[1] AS stop FROM l WHERE rest IS NOT NULL)
SELECT l.selected_id, CASE WHEN l.rest IS NULL THEN right(coalesce(l.t, ''), 200) WHEN stop IS NULL THEN l.rest ELSE substr(l.rest, 1, stop - 1) END AS found FROM l LEFT JOIN d USING (selected_id)""")
def last_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return _ok(spark, folder).select("selected_id", udf_last_boxed("output").alias("found"))


# --- labels, payloads ---------------------------------------------------------------------------

_LABELS = """n AS (SELECT selected_id, CAST(selected_id % 4 + 1 AS INT) AS n FROM selected),
lab AS (SELECT selected_id, n, list_transform(generate_series(0, 3), lambda i: {'block_id': CAST((i * 2) % 6 AS INT), 'type': CASE WHEN (selected_id + i) % 5 = 0 THEN 'OTHER' WHEN (selected_id + i) % 3 = 0 THEN 'SUPPORTING' ELSE 'NON_SUPPORTING' END,
  'supports': CASE WHEN (selected_id + i) % 3 = 0 AND (selected_id + i) % 7 > 0 THEN CASE WHEN (selected_id + i) % 11 = 0 THEN [0, 9] ELSE [0] END ELSE CAST([] AS INT[]) END}) AS labels FROM n)"""


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    s = lambda i: F.col("selected_id") + i
    ints = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<int>")
    label = lambda i: F.struct(
        ((i * 2) % 6).cast("int").alias("block_id"), F.when(s(i) % 5 == 0, "OTHER").when(s(i) % 3 == 0, "SUPPORTING").otherwise("NON_SUPPORTING").alias("type"),
        F.when((s(i) % 3 == 0) & (s(i) % 7 > 0), F.when(s(i) % 11 == 0, ints(0, 9)).otherwise(ints(0))).otherwise(ints()).alias("supports"),
    )
    rows = table(spark, folder, "selected").select("selected_id", (F.col("selected_id") % 4 + 1).cast("int").alias("n"))
    return rows.withColumn("labels", F.transform(F.sequence(F.lit(0), F.lit(3)), label)).withColumn("ids", F.sequence(F.lit(0), F.col("n") - 1))


@query(f"""WITH {_LABELS}, u AS (SELECT selected_id, n, unnest(labels) AS x FROM lab)
SELECT selected_id, coalesce(list_distinct(list(f) FILTER (f IS NOT NULL)), []) AS found FROM (SELECT selected_id, unnest([CASE WHEN x.block_id >= n THEN 'unknown_block' END, CASE WHEN x.type NOT IN ('SUPPORTING', 'NON_SUPPORTING') THEN 'bad_type' END,
  CASE WHEN list_contains(x.supports, 9) THEN 'unknown_target' END, CASE WHEN x.type = 'NON_SUPPORTING' AND len(x.supports) > 0 THEN 'supports_without_type' END, CASE WHEN x.type = 'SUPPORTING' AND len(x.supports) = 0 THEN 'type_without_supports' END]) AS f FROM u) GROUP BY selected_id""".replace("coalesce(list_distinct(list(f) FILTER (f IS NOT NULL)), [])", "list_sort(coalesce(list_distinct(list(f) FILTER (f IS NOT NULL)), []))"))
def payload_violations(spark: SparkSession, folder: str) -> DataFrame:
    found = compression.violations(F.col("labels"), F.col("ids"), F.array(F.lit(0)))
    return _labels(spark, folder).select("selected_id", F.array_sort(found).alias("found"))


@query("""SELECT selected_id, list_sort(list_concat(['blocks', 'dependency_graph', 'redundant_blocks', 'statistics', 'supporting_blocks'], CASE WHEN answer IS NULL THEN ['targets'] ELSE [] END, CASE WHEN metadata IS NULL THEN ['block_labels'] ELSE [] END)) AS missing FROM selected""")
def payload_missing_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "selected").select("selected_id", F.col("selected_id").alias("sample_id"), F.col("answer").alias("targets"), F.col("metadata").alias("block_labels"))
    return rows.select("selected_id", compression.missing_fields(rows).alias("missing"))


@query(f"""WITH {_LABELS}, u AS (SELECT selected_id, n, unnest(generate_series(1, 4)) AS j, labels FROM lab),
good AS (SELECT selected_id, labels[j].block_id AS block_id, CASE WHEN labels[j].type = 'SUPPORTING' AND list_contains(labels[j].supports, 0) THEN 'SUPPORTING' ELSE 'NON_SUPPORTING' END AS type FROM u WHERE labels[j].block_id < n),
every AS (SELECT selected_id, block_id, type FROM good UNION ALL SELECT selected_id, CAST(b AS INT), 'NON_SUPPORTING' FROM (SELECT selected_id, unnest(generate_series(0, n - 1)) AS b FROM n) m WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.selected_id = m.selected_id AND g.block_id = b))
SELECT selected_id, block_id, type, count(*) AS n FROM every GROUP BY ALL""")
def labels_fixed(spark: SparkSession, folder: str) -> DataFrame:
    fixed = compression.fixed_labels(F.col("labels"), F.col("ids"), F.array(F.lit(0)))
    rows = _labels(spark, folder).select("selected_id", F.explode(fixed).alias("x")).select("selected_id", "x.block_id", "x.type")
    return rows.groupBy("selected_id", "block_id", "type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE src AS (SELECT selected_id AS k, output AS t FROM selected WHERE status = 'ok'), {BLOCKS}, w AS (SELECT k, block_id, len(regexp_extract_all(x, '\\S+')) AS n, (k + block_id) % 3 = 0 AS kept, x FROM block),
g AS (SELECT k, count(*) AS nb, count_if(kept) AS ns, sum(n) AS tok, coalesce(sum(n) FILTER (kept), 0) AS stok, coalesce(string_agg(x, chr(10) || chr(10) ORDER BY block_id) FILTER (kept), '') AS kept_text, list(x ORDER BY block_id)[-2:] AS last FROM w GROUP BY k)
SELECT k AS selected_id, CAST(nb AS INT) AS num_blocks, CAST(ns AS INT) AS num_supporting, round(CAST(ns AS DOUBLE) / nb, 4) AS compression_ratio_blocks, round(CAST(stok AS DOUBLE) / tok, 4) AS compression_ratio_tokens,
  CASE WHEN ns > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target_coverage, kept_text, last, CAST(2 * ns AS INT) AS n_edges FROM g""")
def short_label_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The short form of labelling: supporting block numbers only, each going with both targets."""
    from tracemill.functions.blocks import udf_blocks

    rows = _ok(spark, folder).select("selected_id", udf_blocks("output").alias("blocks")).filter("size(blocks) > 0")
    rows = rows.withColumn("own", F.filter(F.sequence(F.lit(0), F.size("blocks") - 1), lambda i: (F.col("selected_id") + i) % 3 == 0))
    s = compression.short_statistics(F.col("blocks"), F.col("own"))
    edges = compression.all_target_edges(F.col("own"), F.array(F.lit(0), F.lit(1)))
    return rows.withColumn("s", s).select(
        "selected_id", "s.num_blocks", "s.num_supporting", "s.compression_ratio_blocks", "s.compression_ratio_tokens", "s.target_coverage",
        compression.kept_text(F.col("blocks"), F.col("own")).alias("kept_text"), compression.last_blocks(F.col("blocks"), 2)["blocks"].alias("last"), F.size(edges).alias("n_edges"),
    )


# --- markers ----------------------------------------------------------------------------------------

_LEAD = "|".join(m.replace("'", "''").replace(" ", " \x01 ") for m in markers.LEADING)
#: What may stand around a marker is written twice with a mark between, as one copy is used up by the marker before.
_LEADING = rf"""tripled AS (SELECT regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '([,:.!?{WS[1:-1]}])', '\1' || chr(1) || '\1', 'g') AS t FROM documents WHERE text IS NOT NULL),
lead0 AS (SELECT unnest(regexp_extract_all(t, '(?i)(?:^|[\n.!?](?:{WS}\x01{WS})+)({_LEAD})[,:.{WS[1:-1]}]', 1)) AS m FROM tripled), led AS (SELECT replace(m, ' ' || chr(1) || ' ', ' ') AS marker, count(*) AS n FROM lead0 GROUP BY ALL)"""


@query(f"WITH {_LEADING} SELECT marker, n FROM led")
def marker_leading_counts(spark: SparkSession, folder: str) -> DataFrame:
    return markers.leading_counts(table(spark, folder, "documents"), "text")


def _doubled(x: str) -> str:
    return f"regexp_replace({x}, '([^A-Za-z])', '\\1\\1', 'g')"


def _seed_sql() -> str:
    rows = ", ".join(f"('{c}', '" + m.replace("'", "''") + "')" for c, group in markers.SEEDS.items() for m in group)
    clean_ = "regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g')"
    return rf"""c AS (SELECT {_doubled(clean_)} AS t FROM documents WHERE text IS NOT NULL), m AS (SELECT * FROM (VALUES {rows}) AS v(category, marker)),
s AS (SELECT marker, CAST(sum(len(regexp_extract_all(t, '(?i)(?:^|[^A-Za-z])' || {_doubled('marker')} || '(?:[^A-Za-z]|$)'))) AS BIGINT) AS n FROM m, c GROUP BY marker)"""


@query(f"WITH {_seed_sql()} SELECT marker, n FROM s WHERE n > 0")
def marker_counts(spark: SparkSession, folder: str) -> DataFrame:
    return markers.seed_counts(table(spark, folder, "documents"), "text")


def _head_sql(heads: list[str]) -> str:
    return " OR ".join("starts_with(lower(marker), '" + h.replace("'", "''") + "')" for h in heads)


@query(rf"""WITH {_seed_sql()}, {_LEADING}, both_ AS (SELECT marker, sum(n) AS n FROM (SELECT marker, n FROM s WHERE n > 0 UNION ALL SELECT marker, n FROM led) GROUP BY marker),
every AS (SELECT DISTINCT category, marker FROM (SELECT category, marker FROM m UNION ALL SELECT CASE WHEN {_head_sql(markers.VERIFICATION_HEADS)} THEN 'B_verification_reflection_markers'
  WHEN {_head_sql(markers.TRANSITION_HEADS)} THEN 'C_starting_transition_markers' ELSE 'A_derivation_markers' END, marker FROM both_ WHERE n >= 2)
  WHERE length(marker) <= 80 AND NOT regexp_matches(marker, '[$\\=<>^_{{}}]|\d') AND NOT regexp_matches(marker, '[.;:!?]{{2,}}') AND len(regexp_extract_all(marker, '[A-Za-z]+(?:''[A-Za-z]+)?')) BETWEEN 1 AND 8)
SELECT category, marker, CAST(row_number() OVER (PARTITION BY category ORDER BY length(marker) DESC, lower(marker), marker) AS INT) AS position FROM every""")
def marker_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return markers.dictionary(table(spark, folder, "documents"), "text")


# --- answers, lengths, embeddings, samples ---------------------------------------------------------------


def _number_sql(x: str) -> str:
    stripped = rf"regexp_replace(regexp_replace({x}, '[ \t\n\x0B\f\r$]', '', 'g'), '^\\boxed\{{(.*)\}}$', '\1')"
    b = f"CASE WHEN regexp_full_match({stripped}, '[-+]?[0-9]{{1,3}}(?:,[0-9]{{3}})+(?:\\.[0-9]+)?') THEN replace({stripped}, ',', '') ELSE {stripped} END"
    part = lambda p, i: f"TRY_CAST(regexp_extract({b}, '{p}', {i}) AS DOUBLE)"
    sign = lambda p: f"CASE WHEN regexp_extract({b}, '{p}', 1) = '-' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"
    a = answers
    return f"""CASE WHEN regexp_matches({b}, '{a.PLAIN}') THEN TRY_CAST({b} AS DOUBLE) WHEN regexp_matches({b}, '{a.PERCENT}') THEN {part(a.PERCENT, 1)} / 100.0 WHEN regexp_matches({b}, '{a.SLASHED}') THEN {part(a.SLASHED, 1)} / nullif({part(a.SLASHED, 2)}, 0)
  WHEN regexp_matches({b}, '{a.FRACTION}') THEN {sign(a.FRACTION)} * {part(a.FRACTION, 2)} / nullif({part(a.FRACTION, 3)}, 0) WHEN regexp_matches({b}, '{a.ROOT}') THEN {sign(a.ROOT)} * coalesce({part(a.ROOT, 2)}, 1.0) * sqrt({part(a.ROOT, 3)}) END"""


@query(f"SELECT row_id, round({_number_sql('answer')}, 9) AS value FROM problems")
def answer_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "problems").select("row_id", F.round(answers.number(F.col("answer")), 9).alias("value"))


@query(rf"""WITH r AS (SELECT selected_id, answer AS g, output AS t, CASE WHEN contains(output, '\boxed{{') THEN string_split(output, '\boxed{{')[-1] END AS rest FROM selected WHERE status = 'ok'),
d AS (SELECT selected_id, g, CASE WHEN rest IS NULL THEN right(coalesce(t, ''), 200) ELSE coalesce(substr(rest, 1, list_filter(generate_series(1, length(rest)), lambda i: substr(rest, i, 1) = '}}' AND length(replace(substr(rest, 1, i), '{{', '')) - length(replace(replace(substr(rest, 1, i), '{{', ''), '}}', '')) = length(substr(rest, 1, i)) - length(replace(substr(rest, 1, i), '{{', '')) + 1)[1] - 1), rest) END AS f FROM r),
b AS (SELECT selected_id, g, f, translate(coalesce(g, ''), ' $', '') AS gb, translate(f, ' $', '') AS fb, {_number_sql('g')} AS x, {_number_sql('f')} AS y FROM d)
SELECT selected_id, coalesce(abs(x - y) <= 1e-9::DOUBLE * greatest(abs(x), abs(y), 1.0), false) OR gb = fb OR (gb <> '' AND contains(fb, gb)) AS is_equivalent FROM b""")
def answers_verified(spark: SparkSession, folder: str) -> DataFrame:
    return refinement.verified(_ok(spark, folder), "output", "answer").select("selected_id", "is_equivalent")


@query(r"""WITH w AS (SELECT CAST(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\x0B\f\r]')) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL)
SELECT count(n) AS n, avg(n) AS mean, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.95) AS p95, quantile_cont(n, 0.99) AS p99, max(n) AS longest FROM w""")
def token_length_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.length_profile(table(spark, folder, "documents"), "text", profile.word_pieces)


@query("""WITH e AS (SELECT score_id, CAST(embedding AS DOUBLE[]) AS e FROM scored WHERE len(embedding) = 32 AND status = 'ok')
SELECT score_id, round(exp(list_avg(list_transform(e, lambda x: abs(x)))), 6) AS ifd, list_transform(generate_series(1, 8), lambda j: round((e[j] + e[8 + j] + e[24 + j]) / 3.0, 6)) AS pooled FROM e""")
def loss_and_pooling(spark: SparkSession, folder: str) -> DataFrame:
    """Losses and token states as they come from a model (here: the vector as 32 losses, and as four states of eight values, the third masked)."""
    rows = table(spark, folder, "scored").filter("size(embedding) = 32 AND status = 'ok'").select("score_id", F.col("embedding").cast("array<double>").alias("e"))
    states = F.transform(F.array(*[F.lit(8 * i + 1) for i in range(4)]), lambda i: F.slice("e", i, 8))
    pooled = clusters.mean_pooled(states, F.array(*[F.lit(i != 2) for i in range(4)]))
    return rows.select("score_id", F.round(clusters.sequence_perplexity(F.transform("e", F.abs)), 6).alias("ifd"), F.transform(pooled, lambda x: F.round(x, 6)).alias("pooled"))


@query("""(SELECT 'first' AS kind, doc_id FROM documents ORDER BY doc_id LIMIT 5) UNION ALL (SELECT 'usable', doc_id FROM documents WHERE length(text) > 200 ORDER BY doc_id LIMIT 7)
UNION ALL (SELECT 'at', doc_id FROM documents ORDER BY doc_id LIMIT 1 OFFSET 17) UNION ALL (SELECT 'long', doc_id FROM (SELECT doc_id, length(text) AS n FROM documents) ORDER BY CASE WHEN n >= 3000 THEN doc_id END NULLS LAST, n DESC NULLS LAST, doc_id LIMIT 1)""")
def picked_records(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    picks = {"first": sampling.first_rows(docs, 5, "doc_id"), "usable": sampling.first_usable(docs, 7, F.length("text") > 200, "doc_id"), "long": sampling.long_record(docs, "text", "doc_id", 3000)}
    out = docs.limit(0).select(F.lit("").alias("kind"), "doc_id")
    if docs.count() > 17:
        picks["at"] = sampling.record_at(docs, 17, "doc_id")
    for kind, rows in picks.items():
        out = out.unionByName(rows.select(F.lit(kind).alias("kind"), "doc_id"))
    return out


@query("SELECT least(5, count(*)) AS n FROM documents")
def unseeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.any_rows(table(spark, folder, "documents").select("doc_id"), 5).agg(F.count_distinct("doc_id").alias("n"))
