"""What the model steps ask and what they must answer: a template, a reply schema and call settings for each kind of request."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.parsing import udf_prompt_blocks
from tracemill.functions.text import strip
from tracemill.operators.markers import SEEDS, collected
from tracemill.operators.model_calls import error_type, parsed, template


@dataclass(frozen=True)
class Step:
    """One kind of request: its template, the schema of its reply (None: plain text), and how it is called."""

    text: str
    reply: str | None
    temperature: float = 0.0
    timeout: float = 120.0
    tries: int = 1


_JSON = "Answer with one JSON object and nothing else: "
# The fields of the replies, temperatures, time limits and numbers of tries.
STEPS = {
    "stitch": Step(
        "A worked solution below runs in circles ({kind}); its middle was folded away.\nWrite it out again with one smooth sentence in place of the fold. Keep the line of thought, the result (right or wrong) "
        "and the <think> tags; add nothing and don't solve the problem anew.\n\nProblem:\n{problem}\n\nFolded solution:\n{folded}\n\nWhole solution:",
        None, 0.1,
    ),
    "same_problem": Step("Do these two texts pose the same problem, that is the same question with the same numbers, perhaps in other words? Say YES or NO.\n\nFirst: {problem}\nSecond: {item_problem}\n", None, 0.0, 10.0),
    "choose": Step(
        "Two solutions of one problem follow. Which teaches more? Look at how hard the problem is, at depth, checking, trying of alternatives and coherence.\n\nProblem: {problem}\n\nSolution 1:\n{cot_a}\n\nSolution 2:\n{cot_b}\n\n"
        + _JSON + '{{"better_index": 1 or 2, "difficulty_level": "Easy" or "Hard", "quality_tags": [of "Deep", "Present", "Exploratory", "Cohesive"], "brief_reason": "..."}}',
        "better_index string, difficulty_level string, quality_tags array<string>, brief_reason string", 0.1, 300.0,
    ),
    "judge": Step(
        "Compare two solutions of one problem.\n\nProblem:\n{problem}\n\nSolution a ({label_a}):\n{cot_a}\n\nSolution b ({label_b}):\n{cot_b}\n\n"
        + _JSON + '{{"problem_difficulty": "Easy", "Medium" or "Hard", "cot_a": {{"quality_tags": [...], "issues": [...]}}, "cot_b": {{"quality_tags": [...], "issues": [...]}}, "winner": "a" or "b", "brief_reason": "..."}}',
        "problem_difficulty string, cot_a struct<quality_tags: array<string>, issues: array<string>>, cot_b struct<quality_tags: array<string>, issues: array<string>>, winner string, brief_reason string", 0.0, 120.0, 3,
    ),
    "critic": Step(
        "A solution came to a wrong or poor result. Find where.\n\nProblem:\n{instruction}\n\nCorrect result: {answer}\n\nSolution:\n{output}\n\n" + _JSON + '{{"error_type": "...", "error_span": "...", "advice": "..."}}',
        "error_type string, error_span string, advice string", 0.1,
    ),
    "refine": Step(
        "An earlier solution of this problem failed: {error_type}; at: {error_span}; advice: {advice}.\nThe correct result is {answer}.\nPlan the solution anew and write it in steps (Step 1, Step 2, ...), short and complete, "
        "inside <think> tags, with the result in \\boxed{{}} at the end.\n\nProblem:\n{instruction}\n",
        None, 0.2, 300.0,
    ),
    "equivalent": Step("Problem:\n{instruction}\n\nExpected result: {answer}\nGiven result: {found}\n\nDo both mean the same, whatever the notation? " + _JSON + '{{"is_equivalent": true or false}}', "is_equivalent boolean", 0.0, 60.0),
    "audit": Step(
        "Problem:\n{instruction}\n\nCorrect result: {answer}\n\nSolution:\n{output}\n\nDoes the solution really derive the result, or does it jump to it? " + _JSON + '{{"is_cheating": true or false, "reason": "..."}}',
        "is_cheating boolean, reason string", 0.1,
    ),
    "label": Step(
        "Which blocks does each target need?\n\nTargets: {targets}\n\n{blocks}\n\n" + _JSON + '{{"block_labels": [{{"block_id": 0, "type": "SUPPORTING" or "NON_SUPPORTING", "supports": [target numbers]}}]}}',
        "block_labels array<struct<block_id: int, type: string, supports: array<int>>>", 0.0, 300.0, 2,
    ),
    "supporting": Step("Which blocks are needed to reach the targets? Leave out repetitions, dead ends and remarks, and every block you doubt.\n\nTargets: {targets}\n\n{blocks}\n\n" + _JSON + '{{"supporting": [block numbers]}}', "supporting array<int>", 0.0, 300.0, 2),
    "sufficient": Step(
        "Problem:\n{question}\n\nResult: {answer}\n\nNew block:\n{added}\n\nBlocks so far, the new one first:\n{candidate}\n\nIs the new block useful for the result, and do the blocks suffice to derive it? " + _JSON + '{{"useful": true or false, "sufficient": true or false}}',
        "useful string, sufficient string", 0.0, 120.0, 3,
    ),
    "depends": Step(
        "Statement:\n{target}\n\nEarlier blocks:\n{candidate}\n\nDoes the statement use the last of these blocks, and do they all suffice for it? " + _JSON + '{{"useful": true or false, "sufficient": true or false}}', "useful string, sufficient string", 0.0, 120.0, 3,
    ),
    "markers": Step(
        "Collect the phrases that steer the reasoning in these texts (no formulas, names or numbers).\n\n{text}\n\n" + _JSON + "{{" + ", ".join(f'"{c}": [...]' for c in SEEDS) + "}}", ", ".join(f"{c} array<string>" for c in SEEDS),
    ),
}


def load_prompt(spark: SparkSession, path: str) -> str:
    """The text of a template file."""
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # one small file


def requests(rows: DataFrame, kind: str, key: str, own_text: str | None = None, /, **columns: Column) -> DataFrame:
    """Requests ``(key, prompt, kind)`` of a step; ``columns`` fill the places of its template (or of ``own_text``); missing values are empty."""
    return rows.select(F.col(key).cast("string").alias("key"), template(own_text or STEPS[kind].text, **columns).alias("prompt"), F.lit(kind).alias("kind"))


def block_list(blocks: Column, most: int = 12000) -> Column:
    """The blocks of a row as a prompt shows them: numbered, long ones without their middle, as many as fit."""
    return udf_prompt_blocks(blocks, most)


def replies(responses: DataFrame, kind: str) -> DataFrame:
    """``key, value, error, error_kind``: the reply of each request in the form its step promises.

    A plain text is stripped, an empty one is an error. Of a JSON reply the
    fields of the schema are kept; without a JSON object ``error`` says so.
    """
    schema = STEPS[kind].reply
    if schema is None:
        text = strip("raw")
        rows = responses.withColumn("value", F.when(text != "", text)).withColumn("error", F.when(F.col("error").isNull() & (F.coalesce(text, F.lit("")) == ""), "empty reply").otherwise(F.col("error")))
    else:
        rows = parsed(responses, schema)
    return rows.select("key", "value", "error", error_type("error").alias("error_kind"))


def says_yes(value: Column) -> Column:
    """Whether a plain reply says yes; a failed call is a no."""
    return F.coalesce(F.contains(F.upper(value), F.lit("YES")), F.lit(False))


def marker_lists(value: Column) -> Column:
    """The markers of a reply of ``markers`` by category, each list in dictionary order."""
    return F.create_map(*[x for c in SEEDS for x in (F.lit(c), collected(F.create_map(F.lit(c), F.coalesce(value[c], F.array().cast("array<string>")))))])
