"""Checks of what a judging model returned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracemill.functions.arrays import or_empty
from tracemill.functions.parsing import udf_json
from tracemill.operators.selection import DIFFICULTY_BONUS, ISSUE_PENALTY, QUALITY_WEIGHT

#: The reply of the pairwise judge.
JUDGEMENT = (
    "problem_difficulty string, cot_a struct<quality_tags: array<string>, issues: array<string>>, "
    "cot_b struct<quality_tags: array<string>, issues: array<string>>, winner string, brief_reason string"
)


def _known(items: Column, table: dict) -> Column:
    return F.size(F.array_except(or_empty(items), F.array(*[F.lit(k) for k in table]))) == 0


def judgement_error(difficulty: Column, tags_a: Column, issues_a: Column, tags_b: Column, issues_b: Column, winner: Column) -> Column:
    """The first thing wrong with a judgement, or null: difficulty, tags and issues of a, of b, winner."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~yes(difficulty.isin(*DIFFICULTY_BONUS)), "problem_difficulty")
        .when(~_known(tags_a, QUALITY_WEIGHT), "cot_a.quality_tags")
        .when(~_known(issues_a, ISSUE_PENALTY), "cot_a.issues")
        .when(~_known(tags_b, QUALITY_WEIGHT), "cot_b.quality_tags")
        .when(~_known(issues_b, ISSUE_PENALTY), "cot_b.issues")
        .when(~yes(winner.isin("a", "b")), "winner")
    )


def parsed_judgement(reply: Column) -> Column:
    """The judgement in a reply as a struct; null if no JSON can be found in it."""
    return F.from_json(udf_json(reply), JUDGEMENT)
