"""Functions over arrays and over positionally parallel arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import let, non_blank  # noqa: F401  (let is used through this module)


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """The columns of a table of one row next to every row, as a scalar subquery."""
    one = row.select(F.struct(*row.columns).alias("one")).scalar()
    return df.select("*", *[one.getField(c).alias(c) for c in row.columns])


def or_empty(c: Column | str, kind: str = "array<string>") -> Column:
    """The array, or an empty one for null."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast(kind))


def flag_at(flags: Column | str, i: Column) -> Column:
    """The flag at a position from 0; false for null and beyond the end."""
    return F.coalesce(F.get(flags, i), F.lit(False))


def zipped(texts: Column, **flags: Column) -> Column:
    """``array<struct<i, text, ...flags>>`` of parallel arrays; the texts give the length, missing flags are false."""
    return F.transform(texts, lambda x, i: F.struct(i.alias("i"), x.alias("text"), *[flag_at(c, i).alias(k) for k, c in flags.items()]))


def shingles(a: Column, n: int, sep: str) -> Column:
    """All stretches of ``n`` consecutive elements, joined; empty for a shorter array."""
    ends = F.when(F.size(a) >= n, F.sequence(F.lit(1), F.size(a) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda i: F.array_join(F.slice(a, i, n), sep))


def most_common_count(a: Column) -> Column:
    """How often the most frequent element occurs; 0 for an empty array.

    Equal elements are neighbours once sorted: one fold over the sorted array,
    linear after the sort, and no shuffle.
    """
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when(acc["last"].eqNullSafe(x), acc["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.array_sort(a), start, step, lambda acc: acc["best"])


def longest_non_blank(a: Column) -> Column:
    """The longest element that isn't blank, the first of equals; null if there is none."""
    kept = F.filter(a, non_blank)
    return F.aggregate(
        kept, F.lit(None).cast("string"), lambda acc, x: F.when(acc.isNull() | (F.length(x) > F.length(acc)), x).otherwise(acc)
    )


def chat(user: Column, assistant: Column) -> Column:
    """A conversation of one question and one reply."""
    return F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), assistant.alias("content")))
