"""Traces that run in circles: detection, folding, repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.arrays import flag_at, most_common_count, or_empty, shingles, zipped
from tracemill.functions.text import logic_skeleton, strip

# Limits of the two detectors.
LIMITS = {"least_chars": 2000, "line_chars": 30, "lines": 20, "line_span": 3, "line_times": 5, "words": 50, "word_span": 10, "word_times": 6}
# Fixed value: what stands for the folded middle of a trace.
FOLD_MARK = "\n\n...[系统提示：已物理折叠中间 {} 行深陷循环的冗余文本]...\n\n"


def loop_kind(text: Column, **limits: int) -> Column:
    """``Physical Loop``, ``Skeleton Loop`` or ``Valid``; null stays null.

    Physical: the same three long lines in a row occur five times. Skeleton:
    so do ten words of what is left without ASCII letters, digits and
    mathematical signs, six times. Short texts are valid. Arrays and folds
    only: no shuffle, whatever the length of a text.
    """
    own = LIMITS | limits
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: F.length(x) > own["line_chars"])
    physical = (F.size(lines) > own["lines"]) & (most_common_count(shingles(lines, own["line_span"], "|")) >= own["line_times"])
    words = F.split(logic_skeleton(text), " ")
    skeleton = (F.size(words) > own["words"]) & (most_common_count(shingles(words, own["word_span"], " ")) >= own["word_times"])
    return F.when(text.isNull(), None).when(F.length(text) < own["least_chars"], "Valid").when(physical, "Physical Loop").when(skeleton, "Skeleton Loop").otherwise("Valid")


def folded(text: Column, most: int = 4000, side: int = 40) -> Column:
    """A text beyond ``most`` characters as its first and last ``side`` lines around a mark with the number of lines between.

    With fewer lines than both sides hold, the sides overlap and the number is
    negative, as the measure is characters but the cut is by lines.
    """
    lines = F.split(text, "\n")
    n = F.size(lines)
    tail = F.when(n <= side, lines).otherwise(F.slice(lines, -side, side))
    before, after = FOLD_MARK.split("{}")
    parts = [F.array_join(F.slice(lines, 1, side), "\n"), F.lit(before), (n - 2 * side).cast("string"), F.lit(after), F.array_join(tail, "\n")]
    return F.when(F.length(text) <= most, text).otherwise(F.concat(*parts))


def zipped_generations(df: DataFrame) -> DataFrame:
    """A column ``_z`` with text, completeness and correctness of each generation; missing flags are false."""
    z = zipped(or_empty("generations"), done=F.col("is_reasoning_complete"), correct=F.col("correctness_math_verify"))
    return df.withColumn("_z", z)


def complete_only(df: DataFrame) -> DataFrame:
    """The three parallel arrays with only the complete generations in them; rows left without any are dropped."""
    rows = zipped_generations(df).withColumn("_z", F.filter("_z", lambda g: g["done"]))
    return _unzipped(rows.filter(F.size("_z") > 0))


def _unzipped(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "generations": F.transform("_z", lambda g: g["text"]),
            "is_reasoning_complete": F.transform("_z", lambda g: g["done"]),
            "correctness_math_verify": F.transform("_z", lambda g: g["correct"]),
        }
    ).drop("_z")


def loop_requests(df: DataFrame, key: str, **limits: int) -> DataFrame:
    """The complete generations that loop, folded for a rewriting model: ``key, i, kind, pre_length, folded``."""
    rows = zipped_generations(df).select(key, F.explode(F.filter("_z", lambda g: g["done"] & g["text"].isNotNull())).alias("g"))
    kind = loop_kind(F.col("g.text"), **limits)
    return rows.withColumn("kind", kind).filter(F.col("kind") != "Valid").select(key, "g.i", "kind", F.length("g.text").cast("bigint").alias("pre_length"), folded(F.col("g.text")).alias("folded"))


def repaired(df: DataFrame, key: str, responses: DataFrame) -> DataFrame:
    """Complete generations with the looping ones replaced by their rewriting ``(key, i, text)``.

    A looping generation without a rewriting is dropped, and so is a row that
    keeps none. Rows move only for the join with the rewritings, which are
    gathered per row first: a row has few generations.
    """
    new = responses.filter(F.col("text").isNotNull()).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", "text"))).alias("_new"))
    rows = zipped_generations(df).join(new, key, "left")
    rows = rows.withColumn("_z", F.filter("_z", lambda g: g["done"] & g["text"].isNotNull()))
    fixed = F.transform("_z", lambda g: F.struct(F.when(loop_kind(g["text"]) == "Valid", g["text"]).otherwise(F.get(F.array(F.col("_new")[g["i"]]), F.lit(0))).alias("text"), g["done"].alias("done"), g["correct"].alias("correct")))
    rows = rows.withColumn("_z", F.filter(fixed, lambda g: g["text"].isNotNull())).drop("_new")
    return _unzipped(rows.filter(F.size("_z") > 0))


def repair_report(df: DataFrame) -> DataFrame:
    """Generations checked, looping ones by kind, and lengths before and after folding (whole-number means, share saved)."""
    rows = zipped_generations(df).select(F.explode(F.filter("_z", lambda g: g["done"] & g["text"].isNotNull())).alias("g"))
    rows = rows.select(F.length("g.text").cast("bigint").alias("pre"), F.length(folded(F.col("g.text"))).cast("bigint").alias("post"), loop_kind(F.col("g.text")).alias("kind"))
    loop = F.col("kind") != "Valid"
    out = rows.agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(F.col("kind") == "Physical Loop").alias("physical"), F.count_if(F.col("kind") == "Skeleton Loop").alias("skeleton"),
        F.sum(F.when(loop, F.col("pre"))).alias("_pre"), F.sum(F.when(loop, F.col("post"))).alias("_post"),
        F.max(F.when(loop, F.col("pre"))).alias("longest_before"), F.max(F.when(loop, F.col("post"))).alias("longest_after"),
    ).withColumn("_n", F.col("physical") + F.col("skeleton"))
    mean = lambda c: F.floor(F.try_divide(F.col(c), F.col("_n")))
    return out.select("checked", "physical", "skeleton", mean("_pre").alias("mean_before"), mean("_post").alias("mean_after"), "longest_before", "longest_after", (F.lit(1.0) - F.try_divide("_post", "_pre")).alias("saved"))


def flags_aligned(df: DataFrame, key: str) -> DataFrame:
    """One row per generation with its flags: ``key, i, done, correct``; flags beyond the end of their list are false."""
    rows = df.select(key, F.posexplode("generations").alias("i", "_t"), "is_reasoning_complete", "correctness_math_verify")
    return rows.select(key, "i", flag_at("is_reasoning_complete", F.col("i")).alias("done"), flag_at("correctness_math_verify", F.col("i")).alias("correct"))
