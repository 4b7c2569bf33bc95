"""Blocks of a trace and the targets they support: labels, statistics, integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.functions.arrays import let, or_empty, with_row
from tracemill.functions.blocks import udf_blocks
from tracemill.functions.parsing import targets as text_targets
from tracemill.functions.percentiles import at_index, index_percent, index_upper_median
from tracemill.functions.text import canonical_target, dependency_tokens, has_reasoning_signal, is_non_supporting, numbers, word_count
from tracemill.sources.stage import staged


def _ints() -> Column:
    return F.array().cast("array<int>")


def block_facts(text: Column, least_key: Column) -> Column:
    """What deciding about a block needs, worked out once per block; the key only where the block is long enough to hold one of ``least_key`` letters."""
    key = F.when(F.length(text) >= least_key, canonical_target(text)).otherwise("")
    return F.struct(text.alias("text"), key.alias("key"), dependency_tokens(text).alias("tokens"), numbers(text).alias("numbers"))


def target_facts(text: Column) -> Column:
    return F.struct(canonical_target(text).alias("key"), dependency_tokens(text).alias("tokens"), numbers(text).alias("numbers"))


def supports(block: Column, target: Column) -> Column:
    """Whether a block supports a target: it contains it, or reasons with its words (all, or two) or with all its numbers.

    The set tests come first: only where they hold is the block searched for
    signs of reasoning and of doubt.
    """
    contained = (target["key"] != "") & F.contains(block["key"], target["key"])
    shared = F.size(F.array_intersect(target["tokens"], block["tokens"]))
    words = (F.size(target["tokens"]) > 0) & ((shared == F.size(target["tokens"])) | (shared >= 2))
    figures = (F.size(target["numbers"]) > 0) & (F.size(F.array_except(target["numbers"], block["numbers"])) == 0)
    reasons = has_reasoning_signal(block["text"]) & ~is_non_supporting(block["text"], block["tokens"])
    return F.coalesce(contained | ((words | figures) & reasons), F.lit(False))


def labelled(df: DataFrame, blocks: Column, targets: Column) -> DataFrame:
    """``block_labels``: for each block its number, type and the targets it supports.

    The nested loop of blocks and targets stays within the row as array
    functions: no shuffle, and a row's product is as large as its own text.
    """

    def label(b: Column, i: Column, goals: Column) -> Column:
        hits = F.transform(F.filter(goals, lambda x: supports(b, x["t"])), lambda x: x["j"])
        return let(hits, lambda own: F.struct(i.alias("block_id"), F.when(F.size(own) > 0, "SUPPORTING").otherwise("NON_SUPPORTING").alias("type"), own.alias("supports")))

    def labels(goals: Column) -> Column:
        least = F.array_min(F.filter(F.transform(goals, lambda g: F.length(g["t"]["key"])), lambda n: n > 0))
        facts = let(F.coalesce(least, F.lit(2**31 - 1)), lambda n: F.transform(blocks, lambda b: block_facts(b, n)))
        return F.transform(facts, lambda b, i: label(b, i, goals))

    goals = F.transform(targets, lambda t, j: F.struct(j.alias("j"), target_facts(t).alias("t")))
    return df.withColumn("block_labels", let(goals, labels))


def label_parts(df: DataFrame) -> DataFrame:
    """From ``block_labels``: the edges of the dependency graph and the supporting and redundant block numbers."""
    labels = F.col("block_labels")
    edges = F.flatten(F.transform(labels, lambda x: F.transform(x["supports"], lambda t: F.struct(x["block_id"].alias("block"), t.alias("target")))))
    of = lambda kind: F.transform(F.filter(labels, lambda x: x["type"] == kind), lambda x: x["block_id"])
    return df.withColumns({"dependency_graph": edges, "supporting_blocks": of("SUPPORTING"), "redundant_blocks": of("NON_SUPPORTING")})


def statistics(df: DataFrame, blocks: Column, targets: Column, digits: int | None = None) -> DataFrame:
    """Block and token counts and ratios of each row; ratios of nothing are 0, and are rounded if ``digits`` is given."""
    labels = F.col("block_labels")
    kept = F.filter(labels, lambda x: x["type"] == "SUPPORTING")
    n, k = F.size(blocks), F.size(kept)
    words = F.transform(blocks, lambda b: word_count(b))
    add = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    total, part = add(words), add(F.transform(kept, lambda x: F.get(words, x["block_id"])))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    known = F.size(F.array_distinct(F.flatten(F.transform(labels, lambda x: x["supports"]))))
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return df.withColumns(
        {
            "num_blocks": n, "num_supporting": k, "num_redundant": n - k, "num_targets": F.size(targets),
            "compression_ratio_blocks": shown(ratio(k, n)), "num_tokens_total": total, "num_tokens_supporting": part,
            "compression_ratio_tokens": shown(ratio(part, total)), "target_coverage": shown(ratio(known, F.size(targets))),
            "dependency_open": n - F.size(F.array_distinct(F.transform(labels, lambda x: x["block_id"]))),
            "dependency_open_rate": shown(ratio(n - F.size(F.array_distinct(F.transform(labels, lambda x: x["block_id"]))), n)),
        }
    )


def compressed(df: DataFrame, key: str, text: str) -> DataFrame:
    """A text from end to end by rules: targets, blocks, labels, graph, statistics, and ``error`` where there is nothing to do.

    ``error`` is ``empty_cot``, ``empty_target``, ``empty_blocks`` or null;
    rows with an error have empty arrays.
    """
    rows = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("targets", text_targets("_text")).withColumn("blocks", udf_blocks("_text"))
    rows = labelled(rows, F.col("blocks"), F.col("targets"))
    error = F.when(F.trim(F.regexp_replace("_text", r"\s+", " ")) == "", "empty_cot").when(F.size("targets") == 0, "empty_target").when(F.size("blocks") == 0, "empty_blocks")
    return statistics(label_parts(rows), F.col("blocks"), F.col("targets")).withColumn("error", error).drop("_text")


def fixed_labels(labels: Column, block_ids: Column, target_ids: Column) -> Column:
    """A model's labels put right: unknown blocks and targets dropped, supporting nothing is no support, missing blocks filled in, in order.

    Repeated labels of a block stay.
    """
    own = F.filter(labels, lambda x: F.array_contains(block_ids, x["block_id"]))

    def fix(x: Column) -> Column:
        known = F.filter(F.coalesce(x["supports"], _ints()), lambda t: F.array_contains(target_ids, t))
        good = (x["type"] == "SUPPORTING") & (F.size(known) > 0)
        good = F.coalesce(good, F.lit(False))
        return F.struct(x["block_id"].alias("block_id"), F.when(good, "SUPPORTING").otherwise("NON_SUPPORTING").alias("type"), F.when(good, known).otherwise(_ints()).alias("supports"))

    named = F.transform(own, lambda x: x["block_id"])
    rest = F.transform(F.array_except(block_ids, named), lambda b: F.struct(b.alias("block_id"), F.lit("NON_SUPPORTING").alias("type"), _ints().alias("supports")))
    return F.array_sort(F.concat(F.transform(own, fix), rest), lambda a, b: F.when(a["block_id"] < b["block_id"], -1).when(a["block_id"] > b["block_id"], 1).otherwise(0))


def all_target_edges(supporting: Column, targets: Column) -> Column:
    """The short form of labelling: every supporting block goes with every target."""
    return F.flatten(F.transform(supporting, lambda b: F.transform(targets, lambda t: F.struct(b.alias("block"), t.alias("target")))))


# The fields that a payload must have.
REQUIRED = ["sample_id", "targets", "blocks", "block_labels", "dependency_graph", "redundant_blocks", "supporting_blocks", "statistics"]


def missing_fields(df: DataFrame) -> Column:
    """The required fields that a payload lacks (no column or null), by name."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) if c in df.columns else F.lit(c) for c in sorted(REQUIRED)]), lambda x: x.isNotNull())


def short_statistics(blocks: Column, supporting: Column, digits: int = 4) -> Column:
    """Statistics of the short form of labelling, where every supporting block goes with every target: coverage is 1 as soon as there is one, and no block is open."""
    own = F.array_intersect(F.coalesce(supporting, _ints()), F.sequence(F.lit(0), F.greatest(F.size(blocks) - 1, F.lit(0))))
    n, k = F.size(blocks), F.when(F.size(blocks) > 0, F.size(own)).otherwise(0)
    words = F.transform(blocks, lambda b: word_count(b))
    add = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    ratio = lambda a, b: F.round(F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0)), digits)
    part = add(F.transform(own, lambda i: F.coalesce(F.get(words, i), F.lit(0))))
    return F.struct(
        n.alias("num_blocks"), k.alias("num_supporting"), (n - k).alias("num_redundant"), ratio(k, n).alias("compression_ratio_blocks"), ratio(part, add(words)).alias("compression_ratio_tokens"),
        F.when(k > 0, 1.0).otherwise(0.0).alias("target_coverage"), F.lit(0).alias("dependency_open"), F.lit(0.0).alias("dependency_open_rate"),
    )


def violations(labels: Column, block_ids: Column, target_ids: Column) -> Column:
    """What is wrong with the labels of a payload: the kinds of violation, in a fixed order; an empty array for sound ones."""
    bad = {
        "unknown_block": lambda x: ~F.array_contains(block_ids, x["block_id"]),
        "bad_type": lambda x: ~x["type"].isin("SUPPORTING", "NON_SUPPORTING"),
        "unknown_target": lambda x: F.size(F.array_except(x["supports"], target_ids)) > 0,
        "supports_without_type": lambda x: (x["type"] == "NON_SUPPORTING") & (F.size(x["supports"]) > 0),
        "type_without_supports": lambda x: (x["type"] == "SUPPORTING") & (F.size(x["supports"]) == 0),
    }
    found = [F.when(F.exists(labels, test), F.lit(name)) for name, test in bad.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def batch_summary(stats: DataFrame) -> DataFrame:
    """Means, both medians and percentiles of the block ratios over all rows, and how many rows are extreme."""
    stats = staged(stats.select("compression_ratio_blocks", "target_coverage", "num_blocks"), "stats")  # read twice below
    ratio = F.col("compression_ratio_blocks")
    at = at_index(stats, "compression_ratio_blocks", {"p10": index_percent(10), "p90": index_percent(90), "upper_median": index_upper_median()})
    out = stats.agg(
        F.count(F.lit(1)).alias("n"), F.avg(ratio).alias("mean_ratio"), F.percentile(ratio, F.lit(0.5)).alias("median_ratio"), F.avg("target_coverage").alias("mean_coverage"),
        F.avg("num_blocks").alias("mean_blocks"), F.count_if(ratio >= 0.99).alias("all_supporting"), F.count_if(ratio <= 0.01).alias("none_supporting"),
        F.count_if(ratio < 0.2).alias("very_high"), F.count_if(ratio > 0.9).alias("very_low"),
    )
    return with_row(out, at)


# Edges of the histograms.
RATIO_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
BLOCK_EDGES = [0, 5, 10, 20, 30, 50, 100]


def _binned(c: Column, edges: list, name: str, last: str) -> Column:
    out = F
    for low, high in zip(edges, edges[1:], strict=False):
        out = out.when((c >= low) & (c < high), name.format(low, high))
    return out.otherwise(last)


def histograms(stats: DataFrame) -> DataFrame:
    """How many rows fall into which bin: ``kind, bin, n``; a ratio of 1 and a hundred blocks and more have their own."""
    ratio = stats.select(F.lit("ratio").alias("kind"), _binned(F.col("compression_ratio_blocks"), RATIO_EDGES, "{:.1f}-{:.1f}", "1.0").alias("bin"))
    blocks = stats.select(F.lit("blocks").alias("kind"), _binned(F.col("num_blocks"), BLOCK_EDGES, "{}-{}", "100+").alias("bin"))
    return ratio.unionByName(blocks).groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"))


def anomalies(stats: DataFrame, key: str, shown: int = 10) -> DataFrame:
    """Extreme rows by kind, with their number and the first keys: ``kind, n, first_keys``.

    Only the ``shown`` smallest keys of a kind are gathered.
    """
    ratio = F.col("compression_ratio_blocks")
    kinds = {
        "very_high_compression": ratio < 0.1, "very_low_compression": ratio > 0.95,
        "zero_supporting": F.col("num_supporting") == 0, "full_supporting": F.col("num_supporting") == F.col("num_blocks"),
    }
    marks = F.array(*[F.when(test, F.lit(kind)) for kind, test in kinds.items()])
    rows = stats.select(F.col(key).alias("_k"), F.explode(F.filter(marks, lambda x: x.isNotNull())).alias("kind"))
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("kind").orderBy("_k"))).filter(F.col("_r") <= shown)
    keys = first.groupBy("kind").agg(F.array_sort(F.collect_list("_k")).alias("first_keys"))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).join(keys, "kind")


def failure_kinds(failures: DataFrame, kind: str = "type") -> DataFrame:
    """Failures by type; a missing one is ``unknown``."""
    return failures.groupBy(F.coalesce(F.col(kind), F.lit("unknown")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


def kept_text(blocks: Column, kept: Column) -> Column:
    """The kept blocks of a row, in their order, with a blank line between."""
    return F.array_join(F.transform(kept, lambda i: F.get(blocks, i)), "\n\n")


def last_blocks(blocks: Column, most: int) -> Column:
    """``struct<offset, blocks>``: at most the last ``most`` blocks and how many come before."""
    n = F.size(or_empty(blocks))
    return F.struct(F.greatest(n - most, F.lit(0)).alias("offset"), F.when(n > most, F.slice(blocks, -most, most)).otherwise(blocks).alias("blocks"))
