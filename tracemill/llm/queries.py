"""The named queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracemill.llm.oracle import ORACLE
from tracemill.llm.p10_level import level_profile, reading_levels, top_level
from tracemill.llm.p1_top_n import top_traces
from tracemill.llm.p2_repetition import generations, repeated_generations, text_repetition
from tracemill.llm.p3_clusters import group_profiles, near_traces
from tracemill.llm.p4_pairs import defect_counts, defects
from tracemill.llm.p5_truncation import cut_generations, truncation_rates
from tracemill.llm.p6_leaks import leak_report, leaked_items
from tracemill.llm.p7_fusion import best_of_batch, fused
from tracemill.llm.p8_encode import encode_corpus
from tracemill.llm.p9_mix import document_tokens, mix, mix_plan, reached_shares, unreachable
from tracemill.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return top_traces(table(spark, folder, "scored")).select("_cluster", "score_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_generations(table(spark, folder, "problems"))


def p2_measures(spark: SparkSession, folder: str) -> DataFrame:
    return text_repetition(generations(table(spark, folder, "problems"), "row_id"), ["row_id", "gen_pos"], "text")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_traces(table(spark, folder, "scored"))


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    return group_profiles(table(spark, folder, "scored"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return defects(table(spark, folder, "selected"), table(spark, folder, "documents"))


def p4_counts(spark: SparkSession, folder: str) -> DataFrame:
    return defect_counts(table(spark, folder, "selected"), table(spark, folder, "documents"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return cut_generations(table(spark, folder, "problems"))


def p5_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation_rates(table(spark, folder, "problems"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "problems"), table(spark, folder, "benchmark_items"), "row_id", "problem")


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    return leak_report(table(spark, folder, "problems"), table(spark, folder, "benchmark_items"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return best_of_batch(table(spark, folder, "scored"))


def p7_fusion(spark: SparkSession, folder: str) -> DataFrame:
    return fused(table(spark, folder, "scored"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return unreachable(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return reached_shares(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_mixed(spark: SparkSession, folder: str) -> DataFrame:
    docs, targets = table(spark, folder, "documents"), table(spark, folder, "mix_targets")
    return mix(docs, mix_plan(document_tokens(docs, targets), targets))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return top_level(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))


def p10_levels(spark: SparkSession, folder: str) -> DataFrame:
    return reading_levels(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))


def p10_profile(spark: SparkSession, folder: str) -> DataFrame:
    return level_profile(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
