import random
from datetime import datetime, timedelta

import pytest
from oracle import connect, same_rows
from pyspark.sql import functions as F

from tracemill.llm import queries
from tracemill.llm.oracle import ORACLE
from tracemill.llm.p1_top_n import top_traces
from tracemill.llm.p7_fusion import best_of_batch, fused, fusion_of
from tracemill.operators.ranking import ranked

SCHEMA = "score_id bigint, trace_id string, status string, problem_difficulty string, winner_score double, IFD_Score double, global_score double, _cluster int, output_chars bigint, judge_batch string, embedding array<float>, scored_at timestamp"


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, small, con, name):
    same_rows(queries.queries()[name](spark, small), con, ORACLE[name])


def rows(n, seed=1):
    """Half of the rows in one cluster and batch, few distinct scores, every odd value."""
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    out = []
    for i in range(n):
        score = rng.choice([*odd, *[float(rng.randrange(4)) for _ in range(6)]])
        ifd = rng.choice([*odd, 1.0, 2.0])
        hot = rng.random() < 0.5
        out.append((
            i, rng.choice([None, f"t{rng.randrange(n)}"]), rng.choice(["ok", "ok", "ok", "judge_failed", None]), rng.choice(["Easy", "Medium", "Hard", "Unknown", None]),
            score, ifd, score, None if rng.random() < 0.05 else 7 if hot else rng.randrange(100, 110), rng.choice([None, 5, 5, 9]), None if rng.random() < 0.05 else "hot" if hot else f"b{rng.randrange(9)}",
            None, rng.choice([None, datetime(2024, 1, 1) + timedelta(days=rng.randrange(3))]),
        ))
    return out


def current(data):
    best = {}
    for r in data:
        if r[2] == "ok":
            key = r[1] if r[1] is not None else ("own", r[0])
            if key not in best or (r[11] or datetime.min, r[0]) > (best[key][11] or datetime.min, best[key][0]):
                best[key] = r
    return list(best.values())


def finite(x):
    return x is not None and x == x and abs(x) != float("inf")


@pytest.mark.parametrize("parts", [1, 6])
def test_top_traces_against_brute_force(spark, parts):
    data = rows(1500)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["_cluster"], r["score_id"], r["position"]) for r in top_traces(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = set()
    groups = {}
    for r in current(data):
        if r[7] is not None and r[6] is not None and r[6] == r[6]:
            groups.setdefault(r[7], []).append(r)
    for c, own in groups.items():
        own.sort(key=lambda r: (-r[6], not finite(r[5]), -r[5] if finite(r[5]) else 0, r[8] is None, r[8] or 0, r[0]))
        expected |= {(c, r[0], i + 1) for i, r in enumerate(own[:3])}
    assert got == expected


def test_fusion_against_brute_force(spark):
    data = rows(1200, seed=2)
    batches = {}
    for r in current(data):
        if r[9] is not None:
            batches.setdefault(r[9], []).append(r)
    level = {"Easy": 1, "Medium": 2, "Hard": 3}
    expected = {}
    for b, own in batches.items():
        scores = [[r[4] if finite(r[4]) else float("-inf") for r in own], [r[5] if finite(r[5]) else float("-inf") for r in own], [level.get(r[3], float("-inf")) for r in own]]
        for i, r in enumerate(own):
            first, second, third = sorted(1 + sum(x > s[i] for x in s) for s in scores)
            expected[b, r[0]] = 1.0 / (60 + first) + 1.0 / (60 + second) + 1.0 / (60 + third)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    assert {(r["judge_batch"], r["score_id"]): r["fusion"] for r in fused(df).collect()} == expected
    best = {r["judge_batch"]: r["score_id"] for r in best_of_batch(df).collect()}
    assert best == {b: min((-expected[b, r[0]], r[0]) for r in own)[1] for b, own in batches.items()}


def test_far_ranks_stay_apart(spark):
    """Neighbouring ranks of a batch of millions have different sums, and the same ranks the same sum in any order."""
    rows = spark.createDataFrame([([1, 5, 2_000_000],), ([1, 5, 2_000_001],), ([1, 5, 2_000_002],)], "r array<int>")
    sums = [x[0] for x in rows.select(fusion_of(F.col("r"))).collect()]
    assert sums[0] > sums[1] > sums[2]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_ranks_across_partitions(spark, parts):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.8 else rng.choice("ab"), rng.choice([1, 1, 1, 2, 3]), i) for i in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranked(spark.createDataFrame(data, "g string, v int, id int"), ["g"], ["v"], [F.col("v").desc(), F.col("id").asc()], ["id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for r in out:
        own = [x for x in data if x[0] == r["g"]]
        v = next(x[1] for x in own if x[2] == r["id"])
        assert r["rank"] == 1 + sum(x[1] > v for x in own)
        assert r["position"] == 1 + sum((-x[1], x[2]) < (-v, r["id"]) for x in own)
    assert len(out) == len(data)
