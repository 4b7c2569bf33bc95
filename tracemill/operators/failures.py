"""Rows that went wrong: put aside, or a reason to stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parted(df: DataFrame, key: str, error: str, skip_errors: bool = True) -> tuple[DataFrame, DataFrame]:
    """The good rows, and failures ``(key, status, type)``.

    With ``skip_errors`` false the good rows fail at the first row that has an
    error, with its key and error in the message (when they are used).
    """
    bad = F.col(error).isNotNull()
    failures = df.filter(bad).select(F.col(key), F.lit("failed").alias("status"), F.col(error).alias("type"))
    if skip_errors:
        return df.filter(~bad).drop(error), failures
    stop = F.when(bad, F.raise_error(F.concat(F.lit("record "), F.col(key).cast("string"), F.lit(": "), F.col(error))).cast("string"))
    return df.withColumn(error, stop).filter(F.col(error).isNull()).drop(error), failures
