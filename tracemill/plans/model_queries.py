"""Queries about the model steps: their requests, replies, failures, and searches that ask in rounds. The model is a fixed rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.blocks import udf_blocks, udf_logic_blocks
from tracemill.functions.parsing import udf_json, udf_last_boxed
from tracemill.operators import compression, contamination, judging, loops, model_calls, prompts, resume, rounds
from tracemill.operators.prompts import STEPS
from tracemill.plans.block_sql import LOGIC
from tracemill.plans.registry import query, strip, table
from tracemill.plans.trace_queries import _loop_sql


def _ok(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "selected").filter("status = 'ok'")


def _prompt_sql(kind: str, **columns: str) -> str:
    """SQL of a step's prompt: literal parts and columns, one after another."""
    import re

    text, parts, at = STEPS[kind].text, [], 0
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    for m in re.finditer(r"\{\{|\}\}|\{(\w+)\}", text):
        parts += [quote(text[at : m.start()]), f"coalesce(CAST({columns[m.group(1)]} AS VARCHAR), '')" if m.group(1) else quote(m.group()[0])]
        at = m.end()
    return " || ".join([*parts, quote(text[at:])])


_ROWS = "FROM selected WHERE status = 'ok'"
_REQUESTS = {
    "judge": (f"SELECT problem_hash || '-' || selected_id AS key, {_prompt_sql('judge', problem='instruction', cot_a='output', cot_b='solution', label_a='metadata.label_a', label_b='metadata.label_b')} AS p {_ROWS}"),
    "choose": f"SELECT problem_hash || '-' || selected_id, {_prompt_sql('choose', problem='instruction', cot_a='output', cot_b='solution')} {_ROWS}",
    "critic": f"SELECT problem_hash || '-' || selected_id, {_prompt_sql('critic', instruction='instruction', output='substr(output, 1, 3000)', answer='answer')} {_ROWS}",
    "refine": f"SELECT problem_hash || '-' || selected_id, {_prompt_sql('refine', instruction='instruction', answer='answer', error_type='problem_difficulty', error_span='verified_label', advice='winner')} {_ROWS}",
    "equivalent": f"SELECT problem_hash || '-' || selected_id, {_prompt_sql('equivalent', instruction='instruction', answer='answer', found='solution')} {_ROWS}",
    "audit": f"SELECT problem_hash || '-' || selected_id, {_prompt_sql('audit', instruction='instruction', answer='answer', output='output')} {_ROWS}",
    "markers": f"SELECT problem_hash || '-' || selected_id, {_prompt_sql('markers', text='output')} {_ROWS}",
}


@query("SELECT key, kind, md5(p) AS prompt FROM (" + " UNION ALL ".join(f"SELECT key, '{kind}' AS kind, p FROM ({sql}) t(key, p)" for kind, sql in _REQUESTS.items()) + ")")
def step_requests(spark: SparkSession, folder: str) -> DataFrame:
    rows = _ok(spark, folder).withColumn("key", F.concat_ws("-", "problem_hash", "selected_id")).filter("problem_hash IS NOT NULL")
    c = F.col
    made = [
        prompts.requests(rows, "judge", "key", problem=c("instruction"), cot_a=c("output"), cot_b=c("solution"), label_a=c("metadata.label_a"), label_b=c("metadata.label_b")),
        prompts.requests(rows, "choose", "key", problem=c("instruction"), cot_a=c("output"), cot_b=c("solution")),
        prompts.requests(rows, "critic", "key", instruction=c("instruction"), output=F.substring("output", 1, 3000), answer=c("answer")),
        prompts.requests(rows, "refine", "key", instruction=c("instruction"), answer=c("answer"), error_type=c("problem_difficulty"), error_span=c("verified_label"), advice=c("winner")),
        prompts.requests(rows, "equivalent", "key", instruction=c("instruction"), answer=c("answer"), found=c("solution")),
        prompts.requests(rows, "audit", "key", instruction=c("instruction"), answer=c("answer"), output=c("output")),
        prompts.requests(rows, "markers", "key", text=c("output")),
    ]
    out = made[0]
    for other in made[1:]:
        out = out.unionByName(other)
    return out.select("key", "kind", F.md5(F.col("prompt").cast("binary")).alias("prompt"))


@query(f"WITH {_loop_sql(300, 2, 8, 4, 3, 4)}, r AS (SELECT row_id, i, kind, length(t) AS n FROM k WHERE done AND kind <> 'Valid' AND t IS NOT NULL) SELECT row_id, i, kind, CASE WHEN n % 5 > 0 THEN 'line 1 of ' || row_id END AS text FROM r")
def loop_rewrites(spark: SparkSession, folder: str) -> DataFrame:
    """Loop rewriting as requests and replies; the model gives no text for every fifth length, so that generation is dropped."""
    limits = {"least_chars": 300, "line_times": 2, "words": 8, "word_span": 4, "word_times": 3, "lines": 4}
    found = loops.loop_requests(table(spark, folder, "problems"), "row_id", **limits)
    keyed = found.withColumn("key", F.concat_ws("-", "row_id", "i")).withColumn("problem", F.concat(F.col("row_id").cast("string"), F.lit(" "), F.col("pre_length").cast("string")))

    def model(prompt: str, kind: str) -> str:
        row, n = prompt.split("Problem:\n", 1)[1].split("\n", 1)[0].split(" ")
        return f" line 1 of {row}\n" if int(n) % 5 else "  "

    said = prompts.replies(model_calls.ask(prompts.requests(keyed, "stitch", "key", kind=F.col("kind"), problem=F.col("problem"), folded=F.col("folded")), model), "stitch")
    return keyed.join(said.select("key", F.col("value").alias("text")), "key").select("row_id", "i", "kind", "text")


@query("""SELECT row_id, item_id FROM problems p JOIN benchmark_items b ON p.answer = b.answer WHERE length(coalesce(p.problem, '')) % 3 = 0""")
def same_problem_asked(spark: SparkSession, folder: str) -> DataFrame:
    """The semantic test of decontamination as requests: asked of each pair with equal answers, a failed call is a no."""
    problems, bench = table(spark, folder, "problems"), table(spark, folder, "benchmark_items")

    def model(prompt: str, kind: str) -> str:
        n = len(prompt.split("First: ", 1)[1].rsplit("\nSecond: ", 1)[0])
        if n % 3 == 1:
            raise TimeoutError("too slow")
        return "yes." if n % 3 == 0 else "no"

    judge = contamination.asked_judge(model, "row_id")
    same = problems.join(bench.select("item_id", F.col("answer").alias("_b")), F.col("answer") == F.col("_b")).select("row_id", "item_id")
    return contamination.answer_matches(problems, bench, "row_id", judge).join(same, ["row_id", "item_id"], "left_semi")


_JUDGED = "CASE selected_id % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'no json' WHEN 2 THEN 'bad winner' ELSE 'fine' END"


@query(f"""SELECT selected_id, CASE {_JUDGED} WHEN 'fine' THEN 'ok' ELSE 'judge_failed' END AS status, CASE {_JUDGED} WHEN 'timeout' THEN 'network' WHEN 'no json' THEN 'json' WHEN 'bad winner' THEN 'other' END AS error_kind,
  CASE {_JUDGED} WHEN 'fine' THEN CASE WHEN selected_id % 2 = 0 THEN 'a' ELSE 'b' END END AS winner FROM selected WHERE status = 'ok'""")
def judge_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """The pairwise judge from request to outcome: failed calls, replies without JSON and invalid judgements become failures of their kind."""
    rows = _ok(spark, folder).select("selected_id", F.col("selected_id").cast("string").alias("key"))

    def model(prompt: str, kind: str) -> str:
        i = int(prompt.split("Problem:\n", 1)[1].split("\n", 1)[0])
        if i % 5 == 0:
            raise TimeoutError("no reply: timeout")
        good = '"problem_difficulty": "Hard", "cot_a": {"quality_tags": ["Deep"], "issues": []}, "cot_b": {"quality_tags": [], "issues": []}, "brief_reason": "x"'
        return ("I think a is better", "```json\n{%s, \"winner\": \"c\"}\n```" % good, "So: {%s, \"winner\": \"%s\"} as said" % (good, "ab"[i % 2]))[min(i % 5, 3) - 1]

    blank = F.lit("")
    made = prompts.requests(rows, "judge", "key", problem=F.col("key"), cot_a=blank, cot_b=blank, label_a=blank, label_b=blank)
    wrong = lambda v: judging.judgement_error(v["problem_difficulty"], v["cot_a"]["quality_tags"], v["cot_a"]["issues"], v["cot_b"]["quality_tags"], v["cot_b"]["issues"], v["winner"])
    said = model_calls.ask_validated(made, model, STEPS["judge"].reply, wrong, rounds=2)
    bad = F.col("error").isNotNull()
    joined = rows.join(said, "key")
    return joined.select("selected_id", F.when(bad, "judge_failed").otherwise("ok").alias("status"), model_calls.error_type("error").alias("error_kind"), F.when(~bad, F.col("value.winner")).alias("winner"))


@query("SELECT status, type, count(*) AS n FROM (SELECT CASE WHEN selected_id % 4 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN selected_id % 8 = 0 THEN 'unknown' WHEN selected_id % 4 = 0 THEN 'network' END AS type FROM selected) GROUP BY ALL UNION ALL SELECT 'pending', NULL, count(*) FROM documents WHERE doc_id NOT IN (SELECT selected_id FROM selected)")
def resume_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of finished and failed records, and what is still to do by it."""
    rows = table(spark, folder, "selected").select(F.col("selected_id").alias("sample_id"))
    done, failed = rows.filter("sample_id % 4 <> 0"), rows.filter("sample_id % 4 = 0").withColumn("type", F.when(F.col("sample_id") % 8 > 0, "network"))
    own = resume.ledger(done, failed)
    todo = resume.pending(table(spark, folder, "documents").select(F.col("doc_id").alias("sample_id")), own, key="sample_id")
    return own.groupBy("status", "type").agg(F.count(F.lit(1)).alias("n")).unionByName(todo.agg(F.lit("pending").alias("status"), F.lit(None).cast("string").alias("type"), F.count(F.lit(1)).alias("n")))


@query(f"""SELECT selected_id, kind, CASE kind WHEN 'choose' THEN CAST(CASE WHEN selected_id % 3 IN (1, 2) THEN selected_id % 3 - 1 ELSE 0 END AS VARCHAR) WHEN 'critic' THEN 'span ' || selected_id WHEN 'refine' THEN 'Step 1 for ' || selected_id
  WHEN 'equivalent' THEN CASE WHEN selected_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 'audit' THEN CASE WHEN selected_id % 7 = 0 THEN 'error' WHEN selected_id % 2 = 1 THEN 'cheat' ELSE 'pass' END
  WHEN 'supporting' THEN '[0,' || (selected_id % 4) || ']' WHEN 'label' THEN CASE WHEN selected_id % 2 = 0 THEN '0' ELSE '0' END || ':' || 'SUPPORTING' WHEN 'sufficient' THEN 'true/' || CASE WHEN selected_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 'markers' THEN 'So then|So' END AS got
FROM (SELECT selected_id FROM selected WHERE status = 'ok'), (VALUES ('choose'), ('critic'), ('refine'), ('equivalent'), ('audit'), ('supporting'), ('label'), ('sufficient'), ('markers')) v(kind)""")
def step_replies(spark: SparkSession, folder: str) -> DataFrame:
    """A reply of each kind of step, read by its schema."""
    rows = _ok(spark, folder).select("selected_id", F.col("selected_id").cast("string").alias("key"))

    def model(prompt: str, kind: str) -> str:
        i = int(prompt)
        return {
            "choose": '{"better_index": %d, "quality_tags": ["Deep"]}' % (i % 3), "critic": '{"error_type": "x", "error_span": "span %d", "advice": ""}' % i, "refine": f"  Step 1 for {i}\n",
            "equivalent": '{"is_equivalent": %s}' % str(i % 2 == 0).lower(), "audit": "???" if i % 7 == 0 else 'Sure! {"is_cheating": %s, "reason": "r"}' % str(i % 2 == 1).lower(),
            "supporting": '{"supporting": [0, %d]}' % (i % 4), "label": '```json\n{"block_labels": [{"block_id": 0, "type": "SUPPORTING", "supports": [0]}]}\n```',
            "sufficient": '{"useful": "Yes", "sufficient": %s}' % (i % 2 == 0 and 1 or 0), "markers": '{"A_derivation_markers": ["So", " So then "], "B_verification_reflection_markers": []}',
        }[kind]

    from tracemill.functions.text import coerce_bool
    from tracemill.operators.refinement import audit_status
    from tracemill.operators.selection import chosen_index

    v = F.col("value")
    shown = {
        "choose": chosen_index(v["better_index"]).cast("string"), "critic": v["error_span"], "refine": v, "equivalent": F.coalesce(v["is_equivalent"], F.lit(False)).cast("string"), "audit": audit_status(v["is_cheating"]),
        "supporting": F.to_json(v["supporting"]), "label": F.concat_ws(":", F.get(v["block_labels"], F.lit(0))["block_id"], F.get(v["block_labels"], F.lit(0))["type"]),
        "sufficient": F.concat_ws("/", coerce_bool(v["useful"]).cast("string"), coerce_bool(v["sufficient"]).cast("string")), "markers": F.array_join(prompts.marker_lists(v)["A_derivation_markers"], "|"),
    }
    asked = rows.crossJoin(F.broadcast(spark.createDataFrame([(k,) for k in shown], "kind string"))).select(F.concat_ws("/", "kind", "key").alias("key"), F.col("key").alias("prompt"), "kind")  # nine kinds
    said = model_calls.ask(asked, model)
    out = None
    for kind, value in shown.items():
        own = prompts.replies(said.filter(F.col("key").startswith(kind + "/")), kind).select(F.substring_index("key", "/", -1).cast("bigint").alias("selected_id"), F.lit(kind).alias("kind"), value.alias("got"))
        out = own if out is None else out.unionByName(own)
    return out


_MATH = r"'[=<>]|\\frac|\\boxed|\\sum|\\sqrt|\d'"
_SUFFIX = rf"""src AS (SELECT selected_id AS k, output AS t FROM selected WHERE status = 'ok'), {LOGIC},
n AS (SELECT k, count(*) AS n FROM logic GROUP BY k), s AS (SELECT logic.k, n - block_id AS size, n, x, string_agg(x, chr(10) || chr(10)) OVER (PARTITION BY logic.k ORDER BY block_id DESC) AS back, regexp_matches(x, {_MATH}) AS useful FROM logic JOIN n USING (k)),
c AS (SELECT s.k, size, n, useful, (SELECT string_agg(l.x, chr(10) || chr(10) ORDER BY l.block_id) FROM logic l WHERE l.k = s.k AND l.block_id >= s.n - s.size) AS cand FROM s WHERE size <= 80),
j AS (SELECT c.*, coalesce(answer, '') <> '' AND contains(cand, coalesce(answer, '')) AND contains(cand, chr(10) || chr(10)) AS enough FROM c JOIN selected ON selected_id = k),
e AS (SELECT k, any_value(n) AS n, min(size) FILTER (enough) AS good, min(size) FILTER (NOT useful AND size > 1) AS stop FROM j GROUP BY k),
f AS (SELECT e.k, e.n, good, stop, coalesce(good <= coalesce(stop, good), false) AS won, CASE WHEN good <= coalesce(stop, good) THEN good ELSE coalesce(stop, least(e.n, 80)) END AS checked FROM e)
SELECT selected_id, CASE WHEN f.k IS NULL THEN 'no_blocks' WHEN won THEN 'success' ELSE 'failed' END AS status, CAST(coalesce(checked, 0) AS INT) AS checked,
  CAST(coalesce((SELECT max(size) FROM j WHERE j.k = f.k AND j.size <= f.checked AND useful), 0) AS INT) AS best, CASE WHEN won THEN list_transform(generate_series(f.n - f.checked, f.n - 1), lambda i: CAST(i AS INT)) ELSE CAST([] AS INT[]) END AS kept
FROM selected LEFT JOIN f ON f.k = selected_id WHERE status = 'ok'"""


@query(f"WITH RECURSIVE {_SUFFIX}")
def suffix_search_stub(spark: SparkSession, folder: str) -> DataFrame:
    from tracemill.operators import pruning

    rows = _ok(spark, folder).select("selected_id", udf_logic_blocks("output").alias("blocks"), "answer")
    return rows.withColumn("p", pruning.udf_suffix("blocks", "answer")).select("selected_id", "p.status", "p.checked", "p.best", "p.kept")


@query(f"WITH RECURSIVE {_SUFFIX}".replace("size <= 80", "size <= 20").replace("least(e.n, 80)", "least(e.n, 20)"))
def suffix_search_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """The same search as tables of requests: one round asks the model once about every text that is still open."""
    rows = _ok(spark, folder).select(F.col("selected_id").cast("string").alias("key"), udf_logic_blocks("output").alias("blocks"), F.lit("").alias("question"), "answer")
    out = rounds.suffix_rounds(rows, rounds.rule_model, most_blocks=20)
    return out.select(F.col("key").cast("bigint").alias("selected_id"), "status", "checked", "best", "kept")


@query()
def backward_search_rounds(spark: SparkSession, folder: str) -> DataFrame:
    rows = _ok(spark, folder).select(F.col("selected_id").cast("string").alias("key"), udf_blocks("output").alias("blocks")).filter("size(blocks) > 0")
    return rounds.backward_rounds(rows, rounds.rule_model).select("key", "kept", "jump")


@query("""SELECT 'rows' AS metric, count(*) AS value FROM selected WHERE status = 'ok' UNION ALL SELECT 'characters', CAST(sum(length(output)) AS BIGINT) FROM selected WHERE status = 'ok' UNION ALL SELECT 'failed', count_if(output IS NULL) FROM selected WHERE status = 'ok'""")
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of a run taken while it writes its result."""
    from tracemill.operators.metrics import measured

    rows = _ok(spark, folder).select("selected_id", "output", F.when(F.col("output").isNull(), "empty").alias("error"))
    figures = measured(rows, lambda df: df.write.format("noop").mode("overwrite").save(), "output", "error")
    return spark.createDataFrame([(k, int(figures[k])) for k in ("rows", "characters", "failed")], "metric string, value bigint")
