"""Access to the test tables and to the rows that count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hash_sample(df: DataFrame, n: int, rows: int, *keys: str) -> DataFrame:
    """About ``n`` of the ``rows`` rows by a hash of the keys: the same ones on every run, and no task sees more than its own. Where keys repeat, the caller sets a limit besides."""
    if rows <= n:
        return df
    share = int(2**62 * n / rows)
    return df.filter(F.shiftrightunsigned(F.xxhash64(*keys), 2) < share)


def current_rows(scored: DataFrame, *columns: str) -> DataFrame:
    """The latest ``ok`` scoring of each trace, with only the wanted columns.

    Later ``scored_at`` wins, then larger ``score_id``; a null ``scored_at``
    loses against any time. Rows without a ``trace_id`` stand for themselves.
    A trace has few scorings, but a null or hot ``trace_id`` may have many:
    the ranking keeps a bounded heap per partition and key (window group
    limit), so such a key is cut down before the shuffle.
    """
    ok = scored.filter(F.col("status") == "ok")
    keep = list(dict.fromkeys(["score_id", *columns]))
    own = F.coalesce(F.col("trace_id"), F.concat(F.lit("\x00"), F.col("score_id").cast("string")))
    order = Window.partitionBy("_trace").orderBy(F.col("scored_at").desc_nulls_last(), F.col("score_id").desc())
    return (
        ok.select(own.alias("_trace"), "scored_at", *keep)
        .withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") == 1)
        .select(*keep)
    )
