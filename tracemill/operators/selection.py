"""Choosing the better of two traces of a problem, and ranking across problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.arrays import let, or_empty
from tracemill.operators.ranking import ranked

# Weights, penalties, caps and bonuses of the scores.
QUALITY_WEIGHT = {"Present": 3.0, "Cohesive": 3.0, "Deep": 2.0, "Concise": 2.0, "Exploratory": 1.0}
ISSUE_PENALTY = {
    "redundant_restatement": 1.0, "redundant_verification": 1.5, "unnecessary_cross_validation": 3.0,
    "hallucinated_context": 6.0, "forced_verification_alignment": 8.0,
}
SEVERE_CAPS = [("forced_verification_alignment", 3.0), ("hallucinated_context", 5.0), ("unnecessary_cross_validation", 8.0)]
VERIFIED_BONUS = 10.0
DIFFICULTY_BONUS = {"Hard": 2.0, "Medium": 0.0, "Easy": -1.0}
TAG_POINTS_V1 = {"Deep", "Present", "Exploratory", "Cohesive"}
FACTOR_V1 = {"Hard": 1.2, "Easy": 0.8}


def _lookup(table: dict[str, float], key: Column, default: float) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def _total(items: Column, table: dict[str, float]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + _lookup(table, x, 0.0))


def selection_score(tags: Column | str, issues: Column | str, label: Column | str) -> Column:
    """Points of a trace within its problem; repeated tags count each, unknown ones nothing, a severe issue caps the score."""
    tags, issues = or_empty(tags), or_empty(issues)
    verified = F.coalesce((F.col(label) if isinstance(label, str) else label) == "verified_correct", F.lit(False))
    raw = F.when(verified, VERIFIED_BONUS).otherwise(0.0) + _total(tags, QUALITY_WEIGHT) - _total(issues, ISSUE_PENALTY)
    capped = None
    for issue, cap in SEVERE_CAPS:
        hit = F.coalesce(F.array_contains(issues, issue), F.lit(False))
        capped = (F if capped is None else capped).when(hit, F.least(raw, F.lit(cap)))
    return capped.otherwise(raw)


def global_score(selection: Column, difficulty: Column) -> Column:
    """Points of a trace across problems; an unknown difficulty adds nothing."""
    return selection + _lookup(DIFFICULTY_BONUS, difficulty, 0.0)


def process_score(correct: Column, tags: Column | str, difficulty: Column) -> Column:
    """The earlier score: nothing for a wrong trace, else 10 and 2.5 for each known tag, times a factor of the difficulty."""
    known = F.size(F.array_intersect(or_empty(tags), F.array(*[F.lit(t) for t in sorted(TAG_POINTS_V1)])))
    points = (F.lit(10.0) + F.lit(2.5) * known) * _lookup(FACTOR_V1, difficulty, 1.0)
    return F.when(F.coalesce(correct, F.lit(False)), points).otherwise(0.0)


def winner(score_a: Column, score_b: Column, len_a: Column, len_b: Column, ifd_a: Column | None = None, ifd_b: Column | None = None) -> Column:
    """``a`` or ``b``: higher score, then higher difficulty to learn (if both are given), then shorter, then ``a``."""
    out = F.when(score_a > score_b, "a").when(score_b > score_a, "b")
    if ifd_a is not None and ifd_b is not None:
        out = out.when(ifd_a > ifd_b, "a").when(ifd_b > ifd_a, "b")
    return out.when(len_b < len_a, "b").otherwise("a")


def verified_label(i: Column) -> Column:
    """The label of a generation: the completeness list decides if it reaches so far, then the correctness list."""
    done, correct = F.col("is_reasoning_complete"), F.col("correctness_math_verify")
    flag = F.when(F.size(F.coalesce(done, F.array().cast("array<boolean>"))) > i, F.get(done, i))
    flag = flag.when(F.size(F.coalesce(correct, F.array().cast("array<boolean>"))) > i, F.get(correct, i))
    return F.when(F.coalesce(flag, F.lit(False)), "verified_correct").otherwise("unverified_or_wrong")


def pick_pair(texts: Column, least_share: float = 0.5) -> Column:
    """``struct<a, b>``: the two generations nearest to the upper median length, after those below half of it are left out.

    Null generations are left out. Equal distances go to the shorter, then to
    the earlier one. Null if fewer than two remain. Array functions only: a
    problem's generations never leave their row.
    """
    rows = F.filter(F.transform(or_empty(texts), lambda x, i: F.struct(F.length(x).alias("n"), i.alias("i"))), lambda g: g["n"].isNotNull())
    median = lambda a: F.get(F.array_sort(F.transform(a, lambda g: g["n"])), F.floor(F.size(a) / 2).cast("int"))
    enough = lambda a: let(median(a), lambda m: F.filter(a, lambda g: g["n"] >= F.lit(least_share) * m))
    nearest = lambda a: let(median(a), lambda m: F.array_sort(F.transform(a, lambda g: F.struct(F.abs(g["n"] - m).alias("d"), g["n"].alias("n"), g["i"].alias("i")))))
    pair = lambda a: F.when(F.size(a) >= 2, F.struct(F.get(a, F.lit(0))["i"].alias("a"), F.get(a, F.lit(1))["i"].alias("b")))
    return let(rows, lambda r: F.when(F.size(r) >= 2, let(let(enough(r), nearest), pair)))


def first_two_short(texts: Column, most: int = 12000) -> Column:
    """Whether there are two generations and the first two are no longer than ``most``."""
    return F.coalesce((F.size(texts) >= 2) & (F.length(F.get(texts, F.lit(0))) <= most) & (F.length(F.get(texts, F.lit(1))) <= most), F.lit(False))


def chosen_index(answer: Column) -> Column:
    """The judge's 1-based choice as an index from 0; 0 if it is no number or none of the two."""
    i = F.when(F.trim(answer).rlike(r"^[-+]?\d{1,9}$"), F.trim(answer).cast("int")) - 1
    return F.when(i.isin(0, 1), i).otherwise(0)


def ranked_share(df: DataFrame, key: str, cluster: str, order: list[Column], share: float, keep_one: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *keep, split)``: ``high`` for the first floor(n * share) rows of each cluster (at least one if ``keep_one``), else ``low``.

    Clusters may be of any size: positions come from one range sort of all
    rows with prefix sums (``ranking.ranked``) instead of a window that puts a
    cluster into one task; cluster sizes are counted before the shuffle.
    ``key`` is unique and decides between equal rows. Null clusters form one
    of their own.
    """
    name = F.coalesce(F.col(cluster).cast("string"), F.lit("\x00"))
    rows = df.withColumn("__cluster", name)
    placed = ranked(rows, ["__cluster"], [key], [*order, F.col(key)], [key, *keep])
    sizes = rows.groupBy("__cluster").agg(F.floor(F.count(F.lit(1)) * F.lit(float(share))).alias("__size"))
    most = F.greatest(F.col("__size"), F.lit(1)) if keep_one else F.col("__size")
    return placed.join(sizes, "__cluster").select(key, *keep, F.when(F.col("position") <= most, "high").otherwise("low").alias("split"))


def split_summary(df: DataFrame, score: str, ifd: str | None = None) -> DataFrame:
    """Rows and mean scores of each split; NaN and null scores are left out of the means."""
    clean = lambda c: F.avg(F.when(~F.isnan(c), F.col(c)))
    cols = [F.count(F.lit(1)).alias("n"), clean(score).alias("avg_score")]
    return df.groupBy("split").agg(*cols, *([clean(ifd).alias("avg_ifd")] if ifd else []))
