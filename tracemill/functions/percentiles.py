"""The definitions of percentiles and medians that the pipelines use side by side; they differ on purpose.

Each takes the exact rank of a distributed sort-free aggregate: the value
counts are aggregated first (partial sums before the shuffle), and the rank is
looked up in the cumulative counts, so no list of all values is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def linear(c: Column | str, p: float) -> Column:
    """Linear interpolation between neighbours."""
    return F.percentile(c, F.lit(p))


def index_floor(p: float) -> Column:
    """Index floor(n * p), at most n - 1."""
    return F.least(F.floor(F.col("_n") * F.lit(p)), F.col("_n") - 1)


def index_round(p: float) -> Column:
    """Index round(p * (n - 1)), halves to the even number."""
    return F.bround(F.lit(p) * (F.col("_n") - 1))


def index_percent(p: int) -> Column:
    """Index floor(n * p / 100), at most n - 1."""
    return F.least(F.floor(F.col("_n") * F.lit(p) / 100), F.col("_n") - 1)


def index_upper_median() -> Column:
    """Index n // 2: the upper one of the two middle values."""
    return F.floor(F.col("_n") / 2)


def at_index(df: DataFrame, value: str, wanted: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """One row (or one per group) with the values at the wanted indices of the sorted values; nulls are left out.

    The window runs over distinct values with their counts, of one group or
    of the whole table: for lengths and rates that is a small table whatever
    the number of rows.
    """
    by = by or []
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    run = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_end", F.sum("_c").over(run)).withColumn("_n", F.sum("_c").over(whole))
    picked = [F.min(F.when(F.col("_end") > index, F.col(value))).alias(name) for name, index in wanted.items()]
    return ranked.groupBy(*by).agg(*picked) if by else ranked.agg(*picked)
