"""Samples of an exact size that don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.sources.readers import numbered
from tracemill.sources.stage import staged


def _draw(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows (all, if there are fewer) in an order drawn by the seed from the key; equal seeds give equal samples."""
    return df.orderBy(_draw(seed, key), key).limit(n)


def stratified_sample(df: DataFrame, n: int, strata: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows spread over ``strata`` equal stretches of the table in the order of the key: all columns and ``stratum``.

    Stretch i of m rows goes from m*i//strata to m*(i+1)//strata; the first
    ``n % strata`` give a row more. Positions come from counts per key range,
    so no task sees the whole table: rows are range-partitioned by the key.
    """
    total = df.count()
    n = min(n, total)
    if not n:
        return df.limit(0).withColumn("stratum", F.lit(0))
    strata = max(1, min(strata, n))
    rows = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("_part", F.shiftright("_at", 33)), "ordered")
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_part", "_low", before.alias("_before")))  # one row per partition
    placed = rows.join(offsets, "_part").withColumn("_pos", F.col("_at") - F.col("_low") + F.col("_before"))
    bounds = [total * i // strata for i in range(strata + 1)]
    placed = placed.withColumn("stratum", sum((F.when(F.col("_pos") >= b, 1).otherwise(0) for b in bounds[1:-1]), F.lit(0)))
    quota = F.lit(n // strata) + F.when(F.col("stratum") < n % strata, 1).otherwise(0)
    order = Window.partitionBy("stratum").orderBy(_draw(seed, key), key)
    drawn = placed.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n // strata + 1)
    return drawn.filter(F.col("_r") <= quota).select(*df.columns, "stratum")


def any_rows(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows (all, if there are fewer) drawn anew on every run."""
    return df.orderBy(F.rand()).limit(n)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first rows in a given order."""
    return df.orderBy(*order).limit(n)


def first_usable(df: DataFrame, n: int, usable: Column, *order: str) -> DataFrame:
    """The first rows that can be used."""
    return df.filter(F.coalesce(usable, F.lit(False))).orderBy(*order).limit(n)


def record_at(df: DataFrame, index: int, *order: str) -> DataFrame:
    """The record at a position from 0 in the given order; an error if there is none."""
    rows = numbered(df, *order)
    found = rows.filter(F.col("index") == index).drop("index")
    if index < 0 or not found.limit(1).count():
        raise IndexError(f"record {index} of {rows.count()}")
    return found


def long_record(df: DataFrame, text: str, order: str, least: int) -> DataFrame:
    """The first record whose text has ``least`` characters, else the longest (the first of equals)."""
    n = F.coalesce(F.length(text), F.lit(0))
    rows = df.withColumn("_first", F.when(n >= least, F.col(order))).withColumn("_n", n)
    return rows.orderBy(F.col("_first").asc_nulls_last(), F.col("_n").desc(), order).limit(1).drop("_first", "_n")
