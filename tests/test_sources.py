import json

import pytest
from pyspark.sql import functions as F

from tracemill.sources import readers, writers
from tracemill.streaming.incremental import run_incremental, table_stream, windowed_counts


def test_json_modes(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('﻿{"a": 1}\n\n{"a": 2}\n{bad\n', encoding="utf-8")
    assert sorted(r["a"] for r in readers.json_lines(spark, str(path), "a int", "lenient").collect() if r["a"]) == [1, 2]
    kept = readers.json_lines(spark, str(path), "a int", "keep").collect()
    assert [r["_corrupt"] for r in kept if r["_corrupt"]] == ["{bad"]
    with pytest.raises(Exception, match="FAILFAST|FAILED_READ"):
        readers.json_lines(spark, str(path), "a int").collect()


def test_sniffing_and_suffixes(spark, tmp_path):
    array, lines, text = tmp_path / "x.json", tmp_path / "y.json", tmp_path / "note.md"
    array.write_text(' [\n{"a": 1},\n{"a": 2}]')
    lines.write_text('{"a": 3}\n{"a": 4}\n')
    text.write_text("line 1\nline 2")
    assert sorted(r["a"] for r in readers.read_any(spark, str(array), "a int").collect()) == [1, 2]
    assert sorted(r["a"] for r in readers.read_any(spark, str(lines), "a int").collect()) == [3, 4]
    assert [tuple(r) for r in readers.read_any(spark, str(text)).collect()] == [("note", "line 1\nline 2")]
    with pytest.raises(ValueError):
        readers.read_any(spark, "a.bin")


def test_shards(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([(i, "x")], "a int, b string").coalesce(1).write.parquet(str(tmp_path / f"s{i}"))
    rows = readers.parquet_shards(spark, str(tmp_path / "s*"), "a")
    assert rows.columns == ["a", "shard_file"] and rows.count() == 2
    name = spark.createDataFrame([("train-00003-of-00010.parquet",)], "n string").select(readers.shard_output_name("n")).first()[0]
    assert name == "optimized_train-00003.jsonl"


def test_numbering_and_markers(spark, tmp_path):
    df = spark.range(50).select((F.lit(50) - F.col("id")).alias("k"))
    assert all(r["index"] == r["k"] - 1 for r in readers.numbered(df.repartition(5), "k").collect())
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"metadata": {"x": "no"}, "logic_markers": {"A": ["So", " Thus "], "B": [["so far"]]}}))
    assert readers.marker_list(spark, str(path)) == ["so far", "Thus", "So"]
    path.write_text("{}")
    with pytest.raises(ValueError):
        readers.marker_list(spark, str(path))


def test_writing(spark, tmp_path):
    df = spark.createDataFrame([("a", "é"), ("b", "x")], "k string, v string")
    writers.write_json_lines(df, str(tmp_path / "j"))
    assert "é" in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("*.json"))
    target = str(tmp_path / "t")
    assert writers.append_new(df, target, "k") == 2 and writers.append_new(df, target, "k") == 0
    writers.write_routes(df.withColumn("route", F.upper("k")), "route", str(tmp_path / "r"))
    assert [r["v"] for r in writers.read_route(spark, str(tmp_path / "r"), "route", "A").collect()] == ["é"]
    assert writers.unfinished_shards(spark, ["j", "none"], str(tmp_path)) == ["none"]
    assert json.loads(writers.envelope(df.limit(1), df.limit(0))) == [{"k": "a", "v": "é"}]
    assert set(json.loads(writers.envelope(df, df))) == {"results", "errors"}
    with pytest.raises(ValueError):
        writers.small_json(df, 1)
    writers.clear(spark, target)
    assert writers.unfinished_shards(spark, ["t"], str(tmp_path)) == ["t"]
    assert "logic jump at 1" in writers.prune_log(["a", "b"], [1], 1)


def test_incremental_run_appends_once(spark, tmp_path):
    source = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source.write.parquet(str(tmp_path / "in"))
    stream = lambda: table_stream(spark, str(tmp_path / "in"), source.schema)
    for checkpoint in ("c1", "c1", "c2"):  # the second run sees nothing new, the third sees all again
        run_incremental(stream(), lambda b: b.withColumn("v", F.col("v") * 10), str(tmp_path / "out"), "k", str(tmp_path / checkpoint)).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("k", "v").collect()) == [("a", 10), ("b", 20)]


def test_windows(spark):
    rows = spark.createDataFrame([("2024-01-01 00:10:00", "x"), ("2024-01-01 00:50:00", "x"), ("2024-01-01 01:00:00", "x")], "t string, k string")
    assert sorted(r["n"] for r in windowed_counts(rows.withColumn("t", F.col("t").cast("timestamp")), "t", "k").collect()) == [1, 2]
