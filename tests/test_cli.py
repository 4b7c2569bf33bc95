"""The steps of the command line on the small tables."""

import json

import pytest
from pyspark.sql import functions as F

from tracemill.cli import main
from tracemill.sources import stage


def run(spark, *args):
    assert main(list(map(str, args)), spark) == 0


def test_decontaminate_sample_and_chat(spark, tmp_path):
    small = "/root/testdata/sf0.01"
    run(spark, "decontaminate", "--input", f"{small}/problems.parquet", "--benchmark", f"{small}/benchmark_items.parquet", "--output", tmp_path / "clean.parquet")
    clean, every = spark.read.parquet(str(tmp_path / "clean.parquet")).count(), spark.read.parquet(f"{small}/problems.parquet").count()
    assert 0 < clean < every
    run(spark, "sample", "--input", tmp_path / "clean.parquet", "--n", 7, "--output", tmp_path / "some.jsonl")
    assert spark.read.json(str(tmp_path / "some.jsonl")).count() == 7
    run(spark, "chat", "--input", tmp_path / "clean.parquet", "--output", tmp_path / "chat.parquet")
    assert spark.read.parquet(str(tmp_path / "chat.parquet")).first()["messages"][1]["role"] == "assistant"


def test_select_writes_requests_and_takes_replies(spark, small, tmp_path):
    out = tmp_path / "selected"
    run(spark, "select", "--input", f"{small}/problems.parquet", "--output", out)
    asked = spark.read.parquet(f"{out}/requests.parquet")
    good = {"problem_difficulty": "Hard", "cot_a": {"quality_tags": ["Deep"], "issues": []}, "cot_b": {"quality_tags": [], "issues": []}, "winner": "a", "brief_reason": ""}
    said = asked.select("key", F.when(F.substring("key", 1, 1) < "8", F.lit(json.dumps(good))).otherwise(F.lit("none")).alias("raw"), F.lit(None).cast("string").alias("error"))
    said.write.parquet(str(tmp_path / "replies.parquet"))
    run(spark, "select", "--input", f"{small}/problems.parquet", "--output", out, "--responses", tmp_path / "replies.parquet")
    done, failed = spark.read.parquet(f"{out}/selected.parquet"), spark.read.parquet(f"{out}/failed.parquet")
    assert done.count() + failed.count() == asked.count() and done.filter("status <> 'ok' OR score_a <= score_b").filter("score_a < score_b").count() <= done.count()
    before = done.count()
    run(spark, "select", "--input", f"{small}/problems.parquet", "--output", out, "--responses", tmp_path / "replies.parquet", "--resume")
    assert spark.read.parquet(f"{out}/selected.parquet").count() == before


def test_cluster_compress_stats(spark, small, tmp_path, capsys):
    run(spark, "cluster", "--input", f"{small}/scored.parquet", "--output", tmp_path / "c", "--clusters", 4)
    high, low = (spark.read.parquet(f"{tmp_path}/c/{x}.parquet").count() for x in ("high", "low"))
    assert high > low > 0
    run(spark, "compress", "--input", f"{small}/selected.parquet", "--output", tmp_path / "k")
    run(spark, "stats", "--input", f"{tmp_path}/k/compressed.parquet")
    assert "mean_ratio" in capsys.readouterr().out
    run(spark, "compress", "--text", "Step 1: we have 3 + 4 = 7.\nSo the answer is \\boxed{7}.", "--output", tmp_path / "one", "--json")
    assert main(["compress", "--text", " ", "--output", str(tmp_path / "bad"), "--fail-fast"], spark) == 1


def test_refine_markers_lengths(spark, small, tmp_path, capsys):
    rows = spark.createDataFrame([(1, "x" * 100 + "\\boxed{4}", "Step 1 \\boxed{4}", "4"), (2, "\\boxed{3}", "\\boxed{4}", "4")], "row_id int, output string, new_output string, answer string")
    rows.write.parquet(str(tmp_path / "r.parquet"))
    run(spark, "refine", "--input", tmp_path / "r.parquet", "--output", tmp_path / "refined.parquet")
    assert sorted(r["refine_path"] for r in spark.read.parquet(str(tmp_path / "refined.parquet")).collect()) == ["A", "C"]
    run(spark, "markers", "--input", f"{small}/problems.parquet", "--output", tmp_path / "m.parquet")
    run(spark, "lengths", "--input", f"{small}/problems.parquet")
    assert "p99" in capsys.readouterr().out


def test_staged_tables_are_released(spark, tmp_path):
    df = stage.staged(spark.range(3), "x")
    assert df.count() == 3 and stage.release(spark) >= 1
    with pytest.raises(Exception, match="FAILED_READ|PATH_NOT_FOUND|does not exist"):
        df.count()
