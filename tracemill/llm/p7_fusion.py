"""Problem 7: one ranking from scores on different scales, by reciprocal rank fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.p1_top_n import finite
from tracemill.operators.ranking import ranked
from tracemill.llm.tables import current_rows

#: The order of the difficulty levels.
LEVELS = {"Easy": 1.0, "Medium": 2.0, "Hard": 3.0}


def fusion_of(ranks: Column, k: int = 60) -> Column:
    """The sum of 1/(k + rank) over three sorted ranks, from the first to the last."""
    a, b, c = (F.lit(1.0) / (F.lit(float(k)) + F.get(ranks, F.lit(i))) for i in range(3))
    return a + b + c


def fused(scored: DataFrame, k: int = 60) -> DataFrame:
    """``(judge_batch, score_id, fusion)`` of each current row; within a batch a larger ``fusion`` is better.

    Each score is ranked by itself within the batch, higher first, equal
    values sharing the better rank; a missing, unknown or non-finite score
    ranks below all others. ``fusion`` is the sum of 1/(k + rank), the best
    rank first: equal ranks give equal sums whichever score they are of, and
    nothing is rounded, so that far ranks of a large batch stay apart. Rows
    without a batch take no part. A batch of any size is ranked by the range sort of
    ``ranked``; the three scores go through one sort as three rows.
    """
    rows = current_rows(scored, "judge_batch", "winner_score", "IFD_Score", "problem_difficulty").filter(F.col("judge_batch").isNotNull())
    level = F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])[F.col("problem_difficulty")]
    worst = F.lit(float("-inf"))
    scores = F.array(*[F.coalesce(c, worst) for c in (finite("winner_score"), finite("IFD_Score"), level)])
    # -0.0 + 0.0 is 0.0: both zeros are one value
    tall = rows.select("judge_batch", "score_id", F.posexplode(scores).alias("_which", "_v")).withColumn("_v", F.col("_v") + F.lit(0.0))
    ranks = ranked(tall, ["judge_batch", "_which"], ["_v"], [F.col("_v").desc(), F.col("score_id").asc()], ["score_id"])
    of = [F.max(F.when(F.col("_which") == i, F.col("rank"))) for i in range(3)]
    placed = ranks.groupBy("judge_batch", "score_id").agg(F.array_sort(F.array(*of)).alias("_r"))
    return placed.select("judge_batch", "score_id", fusion_of(F.col("_r"), k).alias("fusion"))


def best_of_batch(scored: DataFrame, k: int = 60) -> DataFrame:
    """The row ranked first in each batch, the smallest ``score_id`` of equals: ``(judge_batch, score_id)``."""
    best = F.max(F.struct(F.col("fusion"), (-F.col("score_id")).alias("_id")))
    return fused(scored, k).groupBy("judge_batch").agg(best.alias("_best")).select("judge_batch", (-F.col("_best._id")).alias("score_id"))
