"""Profiles of a corpus: lengths, completeness, generations per problem, correctness."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.arrays import or_empty, with_row
from tracemill.functions.percentiles import at_index, index_floor, index_round, linear
from tracemill.functions.text import non_blank, strip, think_text


#: A tokenizer that needs no vocabulary: runs of letters and digits, and every other character that isn't white space.
WORD_PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
Tokenizer = Callable[[Column], Column]


def word_pieces(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PIECES))


def _length(c: Column | str, unit: str | Tokenizer) -> Column:
    """``unit``: ``words``, ``chars``, or a tokenizer: a function from a text column to its number of tokens (a built-in expression or a vectorised function)."""
    text = F.col(c) if isinstance(c, str) else c
    if callable(unit):
        return unit(text).cast("bigint")
    if unit == "words":
        return F.regexp_count(text, F.lit(r"\S+")).cast("bigint")
    return F.length(text).cast("bigint")


def length_profile(df: DataFrame, text: str, unit: str | Tokenizer = "words") -> DataFrame:
    """Number, mean, interpolated percentiles 50 to 99 and maximum of the lengths; null texts don't count.

    An empty table gives one row with 0 and nulls.
    """
    n = df.select(_length(text, unit).alias("n")).filter(F.col("n").isNotNull())
    shares = {f"p{int(p * 100)}": linear("n", p) for p in (0.5, 0.9, 0.95, 0.99)}
    return n.agg(F.count("n").alias("n"), F.avg("n").alias("mean"), *[c.cast("double").alias(k) for k, c in shares.items()], F.max("n").alias("longest"))


def length_profile_index(df: DataFrame, text: str, unit: str | Tokenizer = "words") -> DataFrame:
    """Maximum, mean, the values at index floor(n p) and the cut-off rounded up to the next multiple of 512."""
    n = df.select(_length(text, unit).alias("n")).filter(F.col("n").isNotNull())
    at = at_index(n, "n", {"p90": index_floor(0.9), "p95": index_floor(0.95), "p99": index_floor(0.99)})
    return with_row(n.agg(F.max("n").alias("longest"), F.avg("n").alias("mean")), at).withColumn("suggested", (F.floor(F.col("p95") / 512) + 1) * 512)


def longest_text(df: DataFrame, by: str, text: str, order: str) -> DataFrame:
    """Per group the longest text, the first by ``order`` of equals: ``by, order, length``; null texts don't count."""
    rows = df.filter(F.col(text).isNotNull())
    best = F.max_by(F.col(order), F.struct(F.length(text), -F.col(order)))
    return rows.groupBy(by).agg(best.alias(order), F.max(F.length(text)).cast("bigint").alias("length"))


def think_length_profile(df: DataFrame, text: str, share: float = 0.7) -> DataFrame:
    """Number, range, mean and percentile (rounded index, halves to even) of the lengths of the thinking."""
    n = df.filter(F.col(text).isNotNull()).select(F.length(think_text(text)).cast("bigint").alias("n"))
    cut = at_index(n, "n", {"cut": index_round(share)})
    return with_row(n.agg(F.count("n").alias("n"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.avg("n").alias("mean")), cut)


def route_by_length(df: DataFrame, text: str, share: float = 0.7) -> DataFrame:
    """All rows with a text, their thinking's length, and ``route``: ``long`` above the percentile, else ``short``."""
    rows = df.filter(F.col(text).isNotNull()).withColumn("think_char_len", F.length(think_text(text)).cast("bigint"))
    cut = at_index(rows.select("think_char_len"), "think_char_len", {"cut": index_round(share)}).scalar()
    return rows.withColumn("route", F.when(F.col("think_char_len") > cut, "long").otherwise("short"))


def completeness(df: DataFrame, flags: str = "is_reasoning_complete") -> DataFrame:
    """Rows, flags, false flags, rows with a false flag, and both shares; a null list is a row without flags."""
    false = F.filter(flags, lambda x: ~x)
    total = F.coalesce(F.size(or_empty(flags, "array<boolean>")), F.lit(0))
    out = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("flags"),
        F.coalesce(F.sum(F.size(F.coalesce(false, F.array().cast("array<boolean>")))), F.lit(0)).cast("bigint").alias("incomplete"),
        F.count_if(F.size(F.coalesce(false, F.array().cast("array<boolean>"))) > 0).alias("rows_incomplete"),
    )
    return out.withColumn("share_incomplete", F.try_divide("incomplete", "flags")).withColumn("share_rows", F.try_divide("rows_incomplete", "rows"))


def generations_histogram(df: DataFrame, texts: str = "generations") -> DataFrame:
    """How many rows have how many non-blank generations, with the share of all rows; null lists are -1."""
    n = F.when(F.col(texts).isNull(), -1).otherwise(F.size(F.filter(texts, non_blank))).alias("n_generations")
    counts = df.select(n).groupBy("n_generations").agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select("n_generations", "rows", (F.lit(100.0) * F.col("rows") / total).alias("pct"))


def generations_summary(df: DataFrame, texts: str = "generations") -> DataFrame:
    """Rows, rows without a list, rows with only blank entries, and the mean number of entries (0 for a null list)."""
    n = F.coalesce(F.size(or_empty(texts)), F.lit(0))
    filled = F.coalesce(F.size(F.filter(texts, non_blank)), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(texts).isNull()).alias("missing"),
        F.count_if(F.col(texts).isNotNull() & (filled == 0)).alias("all_empty"), F.avg(n).alias("mean_entries"),
    )


def correctness_share(df: DataFrame, correct: Column) -> DataFrame:
    """Correct and incorrect rows and the share of correct ones in percent; null counts as incorrect."""
    yes = F.coalesce(correct, F.lit(False))
    out = df.agg(F.count_if(yes).alias("correct"), F.count_if(~yes).alias("incorrect"))
    return out.withColumn("pct_correct", F.try_divide(F.lit(100.0) * F.col("correct"), F.col("correct") + F.col("incorrect")))


def field_usage(df: DataFrame, fields: list[str]) -> DataFrame:
    """How many rows take their text from which of the fields, in order of priority: ``field, n``; '' if none has any."""
    used = F.coalesce(*[F.when(strip(f) != "", F.lit(f)) for f in fields], F.lit("")).alias("field")
    return df.select(used).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
