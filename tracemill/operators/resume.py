"""Taking up a job where it ended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import problem_key


def pending(todo: DataFrame, *done: DataFrame, key: str = "problem_hash") -> DataFrame:
    """The rows whose key is in none of the ledgers; without a ledger all of them."""
    if not done:
        return todo
    seen = done[0].select(key)
    for other in done[1:]:
        seen = seen.unionByName(other.select(key))
    return todo.join(seen.distinct(), key, "left_anti")


def pending_problems(problems: DataFrame, *done: DataFrame) -> DataFrame:
    """The problems whose md5 is in none of the ledgers."""
    return pending(problems.withColumn("problem_hash", problem_key(F.coalesce("problem", F.lit("")))), *done)


def ledger(results: DataFrame, failures: DataFrame | None = None, key: str = "sample_id") -> DataFrame:
    """``key, status, type``: a row per finished record, failed ones with their type."""
    ok = results.select(key, F.lit("ok").alias("status"), F.lit(None).cast("string").alias("type"))
    if failures is None:
        return ok
    return ok.unionByName(failures.select(key, F.lit("failed").alias("status"), F.coalesce("type", F.lit("unknown")).alias("type")))
