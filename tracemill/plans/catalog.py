"""All core queries with their SQL, and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracemill.plans import corpus_queries, file_queries, model_queries, text_queries, trace_queries  # noqa: F401  (registers the queries)
from tracemill.plans.registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Raw problems to high-quality rows: contamination and loops out, the best share of each source."""
    return trace_queries.high_quality_split(spark, folder)
