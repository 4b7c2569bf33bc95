"""Problem 9: mixing sources to target shares of all tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.p8_encode import count_tokens
from tracemill.sources.stage import staged


def document_tokens(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(id_col, source, n_tokens)`` of every document of a target source, counted once and written.

    Documents of other sources and with a null source don't go through the
    tokenizer; a null or empty text has 0 tokens; repeated rows count each.
    """
    wanted = targets.select("source").filter(F.col("source").isNotNull()).distinct()
    own = docs.select(F.col(id_col), F.col(source_col).alias("source"), F.col(text_col).alias("text")).join(wanted, "source", "left_semi")
    return staged(count_tokens(own, [id_col, "source"]), "tokens")


def source_tokens(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Tokens and documents per target source: ``source, target_share, max_repeats, n_docs, tokens, total``.

    A target without documents has 0 tokens; a target row with a null source
    is dropped. Partial sums are made before the shuffle, so a hot source
    costs one row per partition.
    """
    wanted = targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    sums = counts.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    zero = F.lit(0).cast("bigint")
    joined = wanted.join(sums, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("n_docs", zero).alias("n_docs"), F.coalesce("tokens", zero).alias("tokens"))
    return joined.withColumn("total", joined.agg(F.coalesce(F.sum("tokens"), zero)).scalar())


def mix_plan(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the repetition rate that gives its share, at most ``max_repeats``, from the counts of ``document_tokens``.

    ``reaches`` is false where even ``max_repeats`` copies give less than the
    target. The size aimed at is the total of all target sources, so where a
    source cannot reach its share, the mix is smaller and the shares of the
    others rise above their targets in proportion. A null share or limit
    counts as 0. A source with no tokens has rate 0.
    """
    rows = source_tokens(counts, targets)
    limit = F.coalesce(F.col("max_repeats"), F.lit(0)).cast("double")
    need = F.coalesce(F.col("target_share"), F.lit(0.0)) * F.col("total")
    rate = F.when(F.col("tokens") > 0, F.least(need / F.col("tokens"), limit)).otherwise(0.0)
    return rows.withColumn("rate", rate).withColumn("reaches", ~(limit * F.col("tokens") < need))


def _copies(id_col: str, seed: int) -> Column:
    """How often a document is used: floor(rate) times, and once more if the hash of seed and id is below the fraction."""
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    whole = F.floor("rate")
    return whole + F.when(share < F.col("rate") - whole, 1).otherwise(0)


def mix(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 20240601) -> DataFrame:
    """The mixed corpus as ``(id_col, source, copy)``: each document floor(rate) times, and once more with probability frac(rate).

    The extra copy is decided by a hash of seed and id, so a rerun and any
    partitioning give the same mix. Rows with equal ids decide alike. Documents
    of other sources and with a null source are left out. The plan has a row
    per target source and is joined without moving the documents.
    """
    drawn = docs.select(F.col(id_col), F.col(source_col).alias("source")).join(plan.select("source", "rate"), "source").withColumn("_n", _copies(id_col, seed).cast("int"))
    return drawn.filter(F.col("_n") > 0).select(F.col(id_col), "source", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))


def reached_shares(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", seed: int = 20240601) -> DataFrame:
    """The shares the mix really has: ``source, target_share, max_repeats, tokens, rate, mixed_tokens, mixed_share``."""
    counts = document_tokens(docs, targets, id_col)
    plan = staged(mix_plan(counts, targets), "plan")
    mixed = counts.join(plan.select("source", "rate"), "source").groupBy("source").agg(F.sum(_copies(id_col, seed) * F.col("n_tokens")).alias("mixed_tokens"))
    rows = plan.join(mixed, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)).cast("bigint"))
    every = rows.agg(F.sum("mixed_tokens")).scalar()
    share_ = F.when(every > 0, F.col("mixed_tokens") / every).otherwise(0.0)
    return rows.select("source", "target_share", "max_repeats", "tokens", "rate", "mixed_tokens", share_.alias("mixed_share"))


def unreachable(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """The target sources that cannot reach their share within ``max_repeats``: ``(source)``."""
    return mix_plan(document_tokens(docs, targets), targets).filter(~F.col("reaches")).select("source")
