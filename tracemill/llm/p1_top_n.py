"""Problem 1: the first N rows of every group, in an order that leaves no tie open."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.operators.ranking import ranked
from tracemill.llm.tables import current_rows


def finite(name: str) -> F.Column:
    """The value of a double column, or null where it is null, NaN or infinite."""
    c = F.col(name).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def top_traces(scored: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` current rows of each cluster: ``(_cluster, score_id, position)``.

    Rows with a null ``_cluster`` or a null or NaN ``global_score`` take no
    part. Order: ``global_score`` descending (infinity first), ``IFD_Score``
    descending with null, NaN and infinite last, ``output_chars`` ascending
    with null last, ``score_id`` ascending. A group may be of any size: it is
    spread over as many range partitions as it needs. An empty table gives
    an empty result.
    """
    rows = current_rows(scored, "_cluster", "global_score", "IFD_Score", "output_chars")
    rows = rows.filter(F.col("_cluster").isNotNull() & F.col("global_score").isNotNull() & ~F.isnan("global_score"))
    rows = rows.select("_cluster", "score_id", "output_chars", F.col("global_score").alias("_score"), finite("IFD_Score").alias("_ifd"))
    order = [F.col("_score").desc(), F.col("_ifd").desc_nulls_last(), F.col("output_chars").asc_nulls_last(), F.col("score_id").asc()]
    return ranked(rows, ["_cluster"], ["_score"], order, ["score_id"], first=n).select("_cluster", "score_id", "position")
