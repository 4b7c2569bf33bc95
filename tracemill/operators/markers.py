"""A dictionary of discourse markers, counted over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.functions.text import is_clean_marker, lower, quoted, squeeze_blanks, strip

# The markers that are always in the dictionary, by category.
SEEDS = {
    "A_derivation_markers": [
        "Putting it all together", "This is equivalent to", "Which is equivalent to", "This implies that", "This means that", "Which means that",
        "From this we get", "Substituting this back", "Substituting into", "Solving for", "Rearranging gives", "Therefore, we have", "Therefore",
        "Consequently", "It follows that", "Thus, we get", "Thus", "Hence", "So, we have", "So this gives", "So", "Using the fact that",
        "By substitution", "Combining these", "Simplifying gives", "After simplification", "Then", "Therefore, the answer is",
    ],
    "B_verification_reflection_markers": [
        "Wait, let me check that", "Wait, let me check", "Let me check this", "Let me verify this", "Let's verify this", "Let's check this",
        "Let me double-check", "Double-checking", "To verify", "Check original equations", "Checking the conditions", "But wait", "Wait", "Hold on",
        "However", "But", "This seems", "That seems", "Need to check", "We need to check", "Let's test", "As a check",
    ],
    "C_starting_transition_markers": [
        "Let's tackle this problem step by step", "Let's solve this step by step", "Let's start by", "Let me start by", "First, let me", "First,",
        "At first", "Initially", "Now, let's", "Next,", "Then,", "Finally", "In summary", "To summarize", "Now", "Also", "Alternatively",
        "Another way", "Case 1", "Case 2", "Suppose that", "Assume that", "Let's assume", "Let's denote", "Let me denote", "Let me recall",
        "Let's see", "Moving on",
    ],
}
# The markers that are harvested at the start of a sentence.
LEADING = [
    "But wait", "Wait", "So", "Therefore", "Thus", "Hence", "Then", "Now", "First", "Next", "Finally", "Alternatively", "However", "In summary",
    "To summarize", "Let's see", "Let's check", "Let's verify", "Let's assume", "Let's denote", "Let me check", "Let me verify", "Let me compute",
    "Let me denote", "Let me recall", "Suppose", "Assume",
]
# Beginnings that decide the category; the first list goes before the second.
VERIFICATION_HEADS = [
    "wait", "but wait", "let me check", "let me double-check", "let me verify", "let's verify", "let's check", "double-check", "to verify", "check",
    "checking", "hold on", "however", "need to check", "we need to check", "let's test", "as a check", "this seems", "that seems", "but",
]
TRANSITION_HEADS = [
    "first", "at first", "initially", "next", "finally", "in summary", "to summarize", "let's start", "let me start", "let's tackle", "let's solve",
    "let's assume", "assume", "suppose", "let's denote", "let me denote", "let me recall", "let's see", "moving on", "case ", "another way",
    "alternatively", "now, let's", "also",
]


def category(marker: Column) -> Column:
    """Verification before transition before derivation, by how the marker begins."""
    begins = lambda heads: lower(marker).rlike("^(?:" + "|".join(map(quoted, heads)) + ")")
    return F.when(begins(VERIFICATION_HEADS), "B_verification_reflection_markers").when(begins(TRANSITION_HEADS), "C_starting_transition_markers").otherwise("A_derivation_markers")


def _heads(markers: list[str]) -> dict[str, list[str]]:
    """For each marker (in lower case) the markers that it begins with, itself included, at the end of a word."""
    low = {m.lower(): m for m in markers}
    ends = lambda x, p: len(x) == len(p) or not ("a" <= x[len(p)] <= "z")
    return {x: [low[p] for p in low if x.startswith(p) and ends(x, p)] for x in low}


def seed_counts(texts: DataFrame, text: str) -> DataFrame:
    """How often each seed occurs, ASCII case ignored and no letter next to it: ``marker, n``.

    One pattern finds the longest seed at every place (without consuming it,
    so seeds may overlap); the seeds that it begins with are counted with it.
    Only counts leave the partition.
    """
    seeds = [m for group in SEEDS.values() for m in group]
    ways = "|".join(quoted(m) for m in sorted(seeds, key=len, reverse=True))
    heads = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for kv in _heads(seeds).items() for x in kv])
    found = F.regexp_extract_all(squeeze_blanks(text), F.lit(f"(?i)(?<![A-Za-z])(?=({ways})(?![A-Za-z]))"), F.lit(1))
    counts = texts.select(F.explode(found).alias("_m")).groupBy(F.lower("_m").alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(F.explode(heads[F.col("_m")]).alias("marker"), "_n").groupBy("marker").agg(F.sum("_n").alias("n"))


def leading_counts(texts: DataFrame, text: str) -> DataFrame:
    """How often a marker opens a sentence, by the form it is written in: ``marker, n``."""
    pattern = r"(?i)(?:^|[\n.!?]\s+)(" + "|".join(map(quoted, LEADING)) + r")(?=[,\s:.])"
    found = texts.select(F.explode(F.regexp_extract_all(squeeze_blanks(text), F.lit(pattern), F.lit(1))).alias("_m"))
    marker = F.regexp_replace(F.regexp_replace("_m", r"^[ ,:\n\t]+|[ ,:\n\t]+$", ""), r"\s+", " ")
    return found.select(marker.alias("marker")).filter(is_clean_marker("marker")).groupBy("marker").agg(F.count(F.lit(1)).alias("n"))


def dictionary(texts: DataFrame, text: str, least: int = 2) -> DataFrame:
    """The marker dictionary: ``category, marker, position``; longer markers first, then by lower case.

    Counts of both kinds are added; what occurs ``least`` times joins the
    seeds of its category. Seeds with a digit are no clean markers and fall out.
    """
    spark = texts.sparkSession
    counts = seed_counts(texts, text).unionByName(leading_counts(texts, text)).groupBy("marker").agg(F.sum("n").alias("n"))
    frequent = counts.filter(F.col("n") >= least).select(category(F.col("marker")).alias("category"), "marker")
    seeds = spark.createDataFrame([(c, m) for c, group in SEEDS.items() for m in group], "category string, marker string")
    rows = seeds.unionByName(frequent).select("category", strip("marker").alias("marker")).filter(is_clean_marker("marker")).distinct()
    order = Window.partitionBy("category").orderBy(F.length("marker").desc(), lower("marker"), "marker")
    return rows.withColumn("position", F.row_number().over(order))


def collected(values: Column) -> Column:
    """The markers of a map of lists: stripped, distinct, longest first, then by lower case."""
    flat = F.filter(F.array_distinct(F.transform(F.flatten(F.map_values(values)), lambda m: strip(m))), lambda m: m != "")
    return F.transform(F.array_sort(F.transform(flat, lambda m: F.struct((-F.length(m)).alias("n"), lower(m).alias("low"), m.alias("m")))), lambda x: x["m"])
