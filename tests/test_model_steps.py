"""Model steps: the endpoint and its fallback, validated rounds, searches in rounds, failures."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tracemill.functions.blocks import udf_blocks
from tracemill.operators import answers, contamination, failures, metrics, model_calls, phrases, prompts, pruning, rounds
from tracemill.sources import readers, writers


@pytest.fixture()
def endpoint():
    """An endpoint that has only completions, and fails once before it answers."""
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.path, body))
            if self.path == "/chat":
                code, out = 404, {"error": "This is not a chat model, use v1/completions"}
            elif sum(p == "/complete" for p, _ in seen) == 1:
                code, out = 500, {}
            else:
                code, out = 200, {"choices": [{"text": f"got {body['prompt'][-20:]!r}"}]}
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


def test_chat_falls_back_to_completions(endpoint):
    url, seen = endpoint
    backend = model_calls.HttpBackend(f"{url}/chat", "m", completions=f"{url}/complete", waits=(("other", 0.0), ("http", 0.0)))
    assert backend("hello", "x").startswith("got") and [p for p, _ in seen] == ["/chat", "/complete", "/complete"]
    assert seen[-1][1]["prompt"] == "USER:\nhello\n\nASSISTANT:\n" and seen[0][1]["messages"][0]["content"] == "hello"
    with pytest.raises(RuntimeError, match="connection"):
        model_calls.HttpBackend("http://127.0.0.1:9/none", "m", tries=2, waits=(("connection", 0.0), ("other", 0.0)))("x", "y")


def test_invalid_replies_are_asked_again(spark):
    asked = spark.createDataFrame([("1", "fine", "k"), ("2", "never", "k")], "key string, prompt string, kind string")
    wrong = lambda v: F.when(v["n"] > 5, F.lit("n"))
    got = {r["key"]: r for r in model_calls.ask_validated(asked, lambda p, k: '{"n": %d}' % (3 if p == "fine" else 9), "n int", wrong, rounds=2).collect()}
    assert got["1"]["value"]["n"] == 3 and got["1"]["error"] is None and got["2"]["error"] == "validation failed: n" and len(got) == 2


def test_plain_replies_and_templates(spark):
    said = spark.createDataFrame([("1", " text ", None), ("2", " ", None), ("3", None, "Timeout")], "key string, raw string, error string")
    got = {r["key"]: (r["value"], r["error"], r["error_kind"]) for r in prompts.replies(said, "refine").collect()}
    assert got == {"1": ("text", None, None), "2": (None, "empty reply", "other"), "3": (None, "Timeout", "network")}
    rows = spark.createDataFrame([(1, "p", None)], "id int, a string, b string")
    made = prompts.requests(rows, "same_problem", "id", problem=F.col("a"), item_problem=F.col("b")).first()
    assert made["key"] == "1" and "First: p\nSecond: \n" in made["prompt"]
    for kind, step in prompts.STEPS.items():
        assert "{" in step.text and step.tries >= 1, kind


def test_searches_in_rounds_equal_those_in_a_row(spark, small):
    rows = spark.read.parquet(f"{small}/selected.parquet").filter("status = 'ok'").limit(12)
    traces = rows.select(F.col("selected_id").cast("string").alias("key"), udf_blocks("output").alias("blocks"), F.lit("q").alias("question"), "answer")
    double = traces.unionByName(traces.limit(1))
    got = sorted((r["key"], r["kept"], r["jump"]) for r in rounds.backward_rounds(double, rounds.rule_model).collect())
    own = sorted((r["key"], r["p"]["kept"], r["p"]["jump"]) for r in double.filter("size(blocks) > 0").select("key", pruning.udf_needed("blocks").alias("p")).collect())
    assert got == own
    short = double.filter("size(blocks) < 9").unionByName(spark.createDataFrame([("none", [], "q", "1")], double.schema))
    found = sorted(tuple(r) for r in rounds.suffix_rounds(short, rounds.rule_model).select("key", "status", "checked", "best", "kept").collect())
    assert found == sorted((r["key"], r["p"]["status"], r["p"]["checked"], r["p"]["best"], r["p"]["kept"]) for r in short.select("key", pruning.udf_suffix("blocks", "answer").alias("p")).collect())


def test_failures_are_put_aside_or_fatal(spark):
    df = spark.createDataFrame([(1, None), (2, "bad")], "k int, error string")
    good, bad = failures.parted(df, "k", "error")
    assert [r["k"] for r in good.collect()] == [1] and [tuple(r) for r in bad.collect()] == [(2, "failed", "bad")]
    with pytest.raises(Exception, match="record 2: bad"):
        failures.parted(df, "k", "error", skip_errors=False)[0].collect()
    seen = metrics.measured(df, lambda x: x.collect(), error="error")
    assert (seen["rows"], seen["failed"], seen["characters"]) == (2, 1, 0) and seen["rows_per_second"] > 0


def test_numbers_are_compared_by_value(spark):
    pairs = [("1/2", "0.5", True), ("\\frac{1}{2}", "50\\%", True), ("$ 1,000 $", "1000.0", True), ("-\\dfrac{3}{4}", "-0.75", True), ("2\\sqrt{3}", "\\sqrt{12}", True), ("\\boxed{7}", "7", True), ("x", "x", False), ("1", "12", False), ("1/0", "1/0", False), (None, "1", False)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(answers.same_number(F.col("a"), F.col("b"))).collect()] == [p[2] for p in pairs]


def test_phrases_in_parts_and_salted_answers(spark):
    texts = spark.createDataFrame([(1, "abcab"), (2, None), (3, ""), (4, "xbcx"), (1, "abcab")], "k bigint, t string")
    phrase = spark.createDataFrame([("p", "ab"), ("q", "bc"), ("r", ""), ("s", None), ("t", "ab")], "name string, p string")
    expected = sorted([(1, "p"), (1, "q"), (1, "t")] * 2 + [(4, "q")])
    for chars in (8_000_000, 2):
        assert sorted(tuple(r) for r in phrases.phrase_hits(texts, phrase, "k", "t", "p", "name", chars).collect()) == expected
    assert phrases.phrase_hits(texts, phrase.limit(0), "k", "t", "p", "name").count() == 0
    train = spark.createDataFrame([(i, f"text {i}", None) for i in range(50)], "row_id int, problem string, answer string")
    bench = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "item_id int, problem string, answer string")
    assert contamination.answer_matches(train, bench, "row_id").count() == 50


def test_numbered_lines_name_the_bad_one(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_bytes('﻿{"a": 1}\n\n{"a": "é"}\n'.encode() + b'{"a": "\xff"}\n')
    rows = readers.json_lines_checked(spark, str(path), "a string").orderBy("line_no").collect()
    assert [(r["line_no"], r["a"]) for r in rows] == [(1, "1"), (3, "é"), (4, "�")]
    for bad in ("[1]", "{oops"):
        path.write_text(f'{{"a": 1}}\n\n{bad}\n')
        with pytest.raises(Exception, match="at line 3"):
            readers.json_lines_checked(spark, str(path), "a string").collect()


def test_results_of_pruning_and_repeated_appends(spark, tmp_path):
    out = json.loads(writers.prune_result("s", ["a", "b", "c"], [0, 2], None))
    assert out["pruned_think"] == "a\n\nc" and out["status"] == "success" and json.loads(writers.prune_result("s", ["a"], [0], 0))["exception_block"] == 0
    df = spark.createDataFrame([("a", 2, [1]), ("a", 1, [2]), ("b", None, None)], "k string, v int, l array<int>")
    assert writers.append_new(df, str(tmp_path / "t"), "k") == 2
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("a", 1), ("b", None)]
