"""Removal of rows that a benchmark contains."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.text import lower, normalize_answer
from tracemill.operators import prompts
from tracemill.operators.model_calls import Backend, ask
from tracemill.operators.phrases import phrase_hits
from tracemill.sources.stage import staged

Judge = Callable[[DataFrame], DataFrame]


def answer_matches(train: DataFrame, bench: DataFrame, key: str, judge: Judge | None = None, salts: int = 16) -> DataFrame:
    """Pairs of a training row and a benchmark item with the same normalised answer: ``(key, item_id)``.

    A null answer is an empty one and matches empty ones. ``judge`` gets the
    candidate pairs (with ``problem`` and ``item_problem``) and returns those
    that are the same problem; it runs after the equi join, so a costly model
    sees only candidates. Of the training side only rows whose answer an item
    has take part; as an answer such as the empty one may be that of a large
    part of them, the join key is salted by the row's key, with a copy of the (few) items of
    an answer for each salt.
    """
    left = train.select(key, F.col("problem"), normalize_answer("answer").alias("_a"), F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt"))
    right = bench.select("item_id", F.col("problem").alias("item_problem"), normalize_answer("answer").alias("_a")).distinct()
    pairs = left.join(right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))), ["_a", "_salt"])
    return (judge(pairs) if judge else pairs).select(key, "item_id")


def word_overlap_judge(share: float = 0.5) -> Judge:
    """A judge without a model: the problems share that part of the words of the item."""

    def run(pairs: DataFrame) -> DataFrame:
        words = lambda c: F.array_distinct(F.regexp_extract_all(lower(c), F.lit("[a-z]+"), F.lit(0)))
        both = F.size(F.array_intersect(words("problem"), words("item_problem")))
        return pairs.filter(both >= F.lit(share) * F.size(words("item_problem")))

    return run


def asked_judge(backend: Backend, key: str) -> Judge:
    """A judge that asks a model about each pair whether both are the same problem; a failed call is a no."""

    def run(pairs: DataFrame) -> DataFrame:
        own = staged(pairs.withColumn("_key", F.concat_ws("/", key, "item_id")), "pairs")
        said = prompts.replies(ask(prompts.requests(own, "same_problem", "_key", problem=F.col("problem"), item_problem=F.col("item_problem")), backend, name="same"), "same_problem")
        return own.join(said.filter(prompts.says_yes(F.col("value"))).select(F.col("key").alias("_key")), "_key", "left_semi").drop("_key")

    return run


def without_matches(train: DataFrame, matches: DataFrame, key: str) -> DataFrame:
    """The rows that no match names; a row without a key stays."""
    return train.join(matches.select(key).distinct(), key, "left_anti")


def last_mention(texts: DataFrame, patterns: DataFrame, key: str, text: str) -> DataFrame:
    """For each pattern the last row (by key) that contains it, and how many do: ``name, n, last_key``; patterns without any are kept with 0."""
    hits = phrase_hits(texts, patterns, key, text, "pattern", "name").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("last_key"))
    return patterns.select("name").join(hits, "name", "left").select("name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "last_key")
