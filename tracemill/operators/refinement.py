"""Rewritten traces: correctness in stages, routing, audit and union."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.parsing import udf_last_boxed
from tracemill.operators.answers import same_number

# All outcomes of a rewriting.
PATHS = ["A", "B", "C_Success", "C_Fail", "D", "Error"]


def answers_equal(truth: Column, found: Column) -> Column:
    """The string stage: equal without spaces and ``$``, or the truth is part of the answer (so 1 accepts 12)."""
    bare = lambda c: F.translate(F.coalesce(c, F.lit("")), " $", "")
    return (bare(truth) == bare(found)) | ((F.length(bare(truth)) > 0) & F.contains(bare(found), bare(truth)))


def verified(df: DataFrame, text: str, truth: str, symbolic: Callable[[Column, Column], Column] = same_number, judged: DataFrame | None = None, key: str = "") -> DataFrame:
    """A column ``is_equivalent``: comparison as numbers (or by another ``symbolic``), then strings, then a judge's verdicts ``(key, is_equivalent)``.

    A stage is asked only where the ones before it failed; without verdict it
    is false.
    """
    rows = df.withColumn("_found", udf_last_boxed(text))
    ok = answers_equal(F.col(truth), F.col("_found"))
    ok = F.coalesce(symbolic(F.col(truth), F.col("_found")), F.lit(False)) | ok
    if judged is not None:
        rows = rows.join(judged.select(key, F.col("is_equivalent").alias("_verdict")), key, "left")
        ok = ok | F.coalesce("_verdict", F.lit(False))
    return rows.withColumn("is_equivalent", ok).drop("_found", "_verdict")


def refine_path(old_correct: Column, new_correct: Column, old: Column, new: Column, most: float = 0.7) -> Column:
    """Where a rewriting goes: A turned right, B turned wrong, C both right (a success if shorter and in steps), D both wrong."""
    ratio = F.when(F.length(old) > 0, F.length(new) / F.length(old)).otherwise(1.0)
    before, after = F.coalesce(old_correct, F.lit(False)), F.coalesce(new_correct, F.lit(False))
    good = (ratio < most) & new.rlike(r"(?i)step \d")
    return (
        F.when(new.isNull(), "Error").when(~before & after, "A").when(before & ~after, "B")
        .when(before & after & good, "C_Success").when(before & after, "C_Fail").otherwise("D")
    )


def refined(df: DataFrame) -> DataFrame:
    """From rows with ``output, new_output, old_correct, new_correct``: those that a rewriting replaces, with its path and ratio."""
    rows = df.withColumn("path", refine_path(F.col("old_correct"), F.col("new_correct"), F.col("output"), F.col("new_output")))
    ratio = F.when(F.col("path") == "C_Success", F.length("new_output") / F.length("output"))
    return rows.filter(F.col("path").isin("A", "C_Success", "D")).withColumn("compression_ratio", ratio).withColumn("output", F.col("new_output")).withColumn("refine_path", F.substring("path", 1, 1))


def path_counts(df: DataFrame, path: str = "path") -> DataFrame:
    """Rows per outcome, 0 for those that don't occur."""
    every = df.sparkSession.createDataFrame([(p,) for p in PATHS], "path string")
    counts = df.groupBy(F.col(path).alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "path", "left").select("path", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def audit_status(is_cheating: Column) -> Column:
    return F.when(is_cheating.isNull(), "error").when(is_cheating, "cheat").otherwise("pass")


def audited_union(base: DataFrame | None, refined_rows: DataFrame, reports: DataFrame, key: str) -> DataFrame:
    """The rows that were good before and the rewritten ones that passed the audit; a missing base is an empty one."""
    passed = refined_rows.join(reports.filter(audit_status(F.col("is_cheating")) == "pass").select(key), key, "left_semi")
    return passed if base is None else base.unionByName(passed, allowMissingColumns=True)


def audit_counts(reports: DataFrame) -> DataFrame:
    """Rows per audit status: ``status, n``."""
    return reports.groupBy(audit_status(F.col("is_cheating")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def with_report(df: DataFrame, reports: DataFrame, key: str) -> DataFrame:
    """The critic's report as a field of ``metadata``; a missing report is an empty one."""
    own = reports.select(key, F.struct("error_type", "error_span", "advice").alias("_r"))
    return df.join(own, key, "left").withColumn("metadata", F.col("metadata").withField("critic_report", F.col("_r"))).drop("_r")


def bad_cases(df: DataFrame, key: str) -> DataFrame:
    """For a look at failures: key, truth, the answer found and the end of the text."""
    return df.select(key, "answer", udf_last_boxed("output").alias("found"), F.right(F.col("output"), F.lit(600)).alias("tail"))
