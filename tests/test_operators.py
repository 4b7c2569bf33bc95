import json

import pytest
from pyspark.sql import functions as F

from tracemill.operators import clusters, compression, contamination, formats, judging, loops, markers, model_calls, pruning, refinement, resume, sampling, selection


def test_physical_and_skeleton_loops(spark):
    lines = ["this is a rather long line number %d of it" % (i % 3) for i in range(60)]
    chinese = " ".join("甲乙丙丁戊己庚辛壬癸") + " "
    rows = [("\n".join(lines),), (chinese * 120,), ("short",), ("z" * 2500,), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(loops.loop_kind(F.col("t"))).collect()]
    assert got == ["Physical Loop", "Skeleton Loop", "Valid", "Valid", None]


def test_fold_overlaps_with_few_lines(spark):
    text = "\n".join("x" * 100 for _ in range(50))
    out = spark.createDataFrame([(text,)], "t string").select(loops.folded(F.col("t"))).first()[0]
    assert "-30" in out and out.count("\n" + "x" * 100) >= 78


def test_repair_replaces_or_drops(spark):
    loop = "\n".join("this is a rather long line number %d of it" % (i % 3) for i in range(60))
    schema = "row_id int, generations array<string>, is_reasoning_complete array<boolean>, correctness_math_verify array<boolean>"
    df = spark.createDataFrame([(1, ["a", loop, "b"], [True, True], [True]), (2, [loop], [True], [True]), (3, None, None, None)], schema)
    fixed = {r["row_id"]: r for r in loops.repaired(df, "row_id", spark.createDataFrame([(1, 1, "new")], "row_id int, i int, text string")).collect()}
    assert fixed[1]["generations"] == ["a", "new"] and fixed[1]["correctness_math_verify"] == [True, False] and set(fixed) == {1}
    assert [(r["row_id"], r["i"], r["kind"]) for r in loops.loop_requests(df, "row_id").orderBy("row_id").collect()] == [(1, 1, "Physical Loop"), (2, 0, "Physical Loop")]


def test_scores(spark):
    rows = [(["Deep", "Deep", "odd"], ["hallucinated_context"], "verified_correct"), (["Present"], [], None), (None, ["forced_verification_alignment"], "verified_correct")]
    df = spark.createDataFrame(rows, "t array<string>, i array<string>, l string")
    assert [r[0] for r in df.select(selection.selection_score("t", "i", "l")).collect()] == [5.0, 3.0, 2.0]
    best = spark.createDataFrame([(1.0, 1.0, 5, 4, 0.1, 0.2), (1.0, 1.0, 4, 4, 0.3, 0.3)], "a double, b double, la int, lb int, ia double, ib double")
    cols = [F.col(c) for c in ("a", "b", "la", "lb", "ia", "ib")]
    assert [r[0] for r in best.select(selection.winner(*cols)).collect()] == ["b", "a"]
    chosen = spark.createDataFrame([("1",), ("2",), ("3",), ("x",), (None,)], "c string").select(selection.chosen_index(F.col("c"))).collect()
    assert [r[0] for r in chosen] == [0, 1, 0, 0, 0]


def test_pick_pair_by_hand(spark):
    rows = [([10, 20, 30, 4],), ([10],), ([7, 7, 7],), ([100, 1],)]
    df = spark.createDataFrame([([("x" * n) for n in r[0]],) for r in rows], "g array<string>").select(selection.pick_pair(F.col("g")).alias("p"))
    assert [tuple(r["p"]) if r["p"] else None for r in df.collect()] == [(1, 0), None, (0, 1), None]


def test_top_share_keeps_one(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (2, 3), (2, 4), (2, 5)], "c int, v int")
    own = df.withColumn("k", F.col("c") * 10 + F.col("v"))
    high = lambda keep: {(r["k"] // 10, r["v"]) for r in selection.ranked_share(own, "k", "c", [F.col("v").desc()], 0.8, keep, ("v",)).filter("split = 'high'").collect()}
    assert high(True) == {(1, 1), (2, 5), (2, 4), (2, 3), (2, 2)} and high(False) == high(True) - {(1, 1)}


def test_judgements(spark):
    good = {"problem_difficulty": "Hard", "cot_a": {"quality_tags": ["Deep"], "issues": []}, "cot_b": {"quality_tags": [], "issues": []}, "winner": "a"}
    rows = [(json.dumps(good),), ("```json\n" + json.dumps(good | {"winner": "c"}) + "\n```",), ("no json",)]
    df = spark.createDataFrame(rows, "r string").select(judging.parsed_judgement(F.col("r")).alias("j"))
    error = judging.judgement_error(F.col("j.problem_difficulty"), F.col("j.cot_a.quality_tags"), F.col("j.cot_a.issues"), F.col("j.cot_b.quality_tags"), F.col("j.cot_b.issues"), F.col("j.winner"))
    assert [r[0] for r in df.select(error).collect()] == [None, "winner", "problem_difficulty"]


def test_compressed_end_to_end(spark):
    text = "Step 1: we have 3 + 4 = 7 apples in the basket.\nStep 2: wait, this is irrelevant chatter here.\nStep 3: therefore the total is \\boxed{7} apples."
    out = compression.compressed(spark.createDataFrame([(1, text), (2, " "), (3, None)], "k int, t string"), "k", "t").orderBy("k").collect()
    assert out[0]["targets"] == ["7"] and out[0]["error"] is None
    assert sorted(out[0]["supporting_blocks"] + out[0]["redundant_blocks"]) == list(range(out[0]["num_blocks"]))
    assert out[0]["target_coverage"] == 1.0 and [r["error"] for r in out[1:]] == ["empty_cot", "empty_cot"]


def test_fixed_labels(spark):
    kind = "array<struct<block_id: int, type: string, supports: array<int>>>"
    df = spark.createDataFrame([([(5, "SUPPORTING", [0]), (1, "SUPPORTING", [9]), (0, "SUPPORTING", [0, 9]), (0, "x", [0])],)], f"l {kind}")
    got = df.select(compression.fixed_labels(F.col("l"), F.array(F.lit(0), F.lit(1), F.lit(2)), F.array(F.lit(0))).alias("f")).first()["f"]
    assert [(x["block_id"], x["type"], x["supports"]) for x in got] == [(0, "SUPPORTING", [0]), (0, "NON_SUPPORTING", []), (1, "NON_SUPPORTING", []), (2, "NON_SUPPORTING", [])]
    assert [tuple(e) for e in df.select(compression.all_target_edges(F.array(F.lit(0), F.lit(2)), F.array(F.lit(1)))).first()[0]] == [(0, 1), (2, 1)]


def test_backward_search():
    assert pruning.needed_blocks([]) == ([], None)
    assert pruning.needed_blocks(["a = 1"]) == ([0], None)
    kept, jump = pruning.needed_blocks(["start value 3", "words only", "x = 3 + 4", "so 7"])
    assert jump is None and kept[0] == 0 and kept[-1] == 3
    assert pruning.needed_blocks(["q", "!!!", "%%%"])[1] == 2
    calls = []

    def judge(candidate, added):
        calls.append(added)
        return added != "c", len(calls) == 3

    assert pruning.sufficient_suffix(["a", "b", "c"], judge)["kept"] == [0, 1, 2]
    assert pruning.sufficient_suffix(["a", "useless", "last"], lambda c, n: (n != "useless", False)) == {"status": "failed", "kept": [], "checked": 2, "best": 1}
    assert pruning.sufficient_suffix(["x"] * 100, lambda c, n: (True, c.count("x") == 3), most_blocks=10)["kept"] == [97, 98, 99]


def test_markers(spark):
    docs = spark.createDataFrame([("Wait, so it is. So, we have it.\nBut wait, So what? Thus x.",), (None,)], "t string")
    seeds = {r["marker"]: r["n"] for r in markers.seed_counts(docs, "t").collect()}
    assert seeds["Wait"] == 2 and seeds["So"] == 3 and seeds["But wait"] == 1 and seeds["But"] == 1
    leading = {r["marker"]: r["n"] for r in markers.leading_counts(docs, "t").collect()}
    assert leading == {"Wait": 1, "So": 1, "But wait": 1, "Thus": 1}
    rows = markers.dictionary(docs, "t").collect()
    assert not any(any(c.isdigit() for c in r["marker"]) for r in rows)
    first = next(r for r in rows if r["category"].startswith("C") and r["position"] == 1)
    assert first["marker"] == "Let's tackle this problem step by step"


def test_refine_paths(spark):
    rows = [(False, True, "old", "new"), (True, False, "old", "new"), (True, True, "o" * 10, "Step 1"), (True, True, "o" * 10, "n" * 9), (False, False, "a", "b"), (True, True, "a", None)]
    df = spark.createDataFrame(rows, "old_correct boolean, new_correct boolean, output string, new_output string")
    path = refinement.refine_path(*[F.col(c) for c in df.columns])
    assert [r[0] for r in df.select(path).collect()] == ["A", "B", "C_Success", "C_Fail", "D", "Error"]
    got = refinement.refined(df).collect()
    assert [(r["refine_path"], r["compression_ratio"]) for r in got] == [("A", None), ("C", 0.6), ("D", None)]
    equal = spark.createDataFrame([("1", "12"), ("$ 4$", "4"), (None, "x"), ("5", "4")], "t string, f string")
    assert [r[0] for r in equal.select(refinement.answers_equal(F.col("t"), F.col("f"))).collect()] == [True, True, False, False]


def test_verification_stages(spark):
    df = spark.createDataFrame([("a", "\\boxed{3}", "3"), ("b", "\\boxed{x}", "y"), ("c", "\\boxed{x}", "y")], "k string, o string, t string")
    judged = spark.createDataFrame([("b", True)], "k string, is_equivalent boolean")
    got = refinement.verified(df, "o", "t", judged=judged, key="k").orderBy("k").collect()
    assert [r["is_equivalent"] for r in got] == [True, True, False]


def test_contamination(spark):
    train = spark.createDataFrame([(1, "find the value of x", "\\boxed{4}"), (2, "other", "4"), (3, "no answer", None)], "row_id int, problem string, answer string")
    bench = spark.createDataFrame([(9, "find the value of x now", "$4$"), (8, "none", None)], "item_id int, problem string, answer string")
    every = {tuple(r) for r in contamination.answer_matches(train, bench, "row_id").collect()}
    assert every == {(1, 9), (2, 9), (3, 8)}
    hits = contamination.answer_matches(train, bench, "row_id", contamination.word_overlap_judge())
    assert {r["row_id"] for r in contamination.without_matches(train, hits, "row_id").collect()} == {2, 3}


def test_resume_is_idempotent(spark):
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "problem_hash string")
    done = todo.filter("problem_hash = 'a'")
    failed = todo.filter("problem_hash = 'b'")
    assert [r[0] for r in resume.pending(todo, done, failed).collect()] == ["c"]
    assert resume.pending(todo, todo).count() == 0 and resume.pending(todo).count() == 3


def test_samples(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    assert {r["k"] for r in sampling.exact_sample(df, 10, "k").collect()} == {r["k"] for r in sampling.exact_sample(df.repartition(7), 10, "k").collect()}
    strata = sampling.stratified_sample(df, 25, 10, "k").collect()
    assert len({r["k"] for r in strata}) == 25 and all(r["stratum"] == r["k"] // 10 for r in strata)
    assert sampling.record_at(df, 5, "k").first()["k"] == 5
    with pytest.raises(IndexError):
        sampling.record_at(df, 100, "k")
    texts = spark.createDataFrame([(0, "aa"), (1, "bbbb"), (2, "cccccc")], "i int, t string")
    assert sampling.long_record(texts, "t", "i", 4).first()["i"] == 1 and sampling.long_record(texts, "t", "i", 99).first()["i"] == 2


def test_formats(spark):
    schema = "row_id int, messages array<struct<role: string, content: string>>, generations array<string>, solution string, id string"
    df = spark.createDataFrame([(1, [("user", " q ")], ["a", " ", "c"], "s", None), (2, [], ["a"], None, "z"), (3, [("user", "q")], None, None, None)], schema)
    chats = formats.chat_rows(df, "row_id").collect()
    assert [(r["row_id"], r["i"], [m["content"] for m in r["messages"]]) for r in chats] == [(1, 0, ["q", "a"])]
    assert tuple(formats.chat_counts(df).first()) == (1, 2)
    assert [r[0] for r in df.select(formats.sample_id(df, F.col("row_id"))).collect()] == ["1", "z", "3"]
    assert [tuple(r[0]) for r in df.select(formats.trace_text(df)).collect()] == [("a", "generations"), ("a", "generations"), ("q", "messages")]


def test_model_calls(spark):
    def backend(prompt, kind):
        if "bad" in prompt:
            raise TimeoutError("too slow")
        return '```json\n{"winner": "%s"}\n```' % prompt[0]

    requests = spark.createDataFrame([("1", "a", None), ("2", "bad", "judge"), ("3", None, None), ("4", "b", "x")], "key string, prompt string, kind string")
    got = {r["key"]: r for r in model_calls.parsed(model_calls.ask(requests, backend, partitions=2), "winner string").collect()}
    assert got["1"]["value"]["winner"] == "a" and got["4"]["value"]["winner"] == "b"
    assert got["2"]["error"].startswith("TimeoutError") and got["3"]["error"] == "no prompt"
    items = spark.createDataFrame([("1",), ("2",), ("9",)], "problem_hash string")
    ok, failed = model_calls.attach(items, "problem_hash", spark.createDataFrame(list(got.values())))
    assert [r["problem_hash"] for r in ok.collect()] == ["1"]
    assert {(r["problem_hash"], r["status"]) for r in failed.collect()} == {("2", "judge_failed"), ("9", "judge_failed")}
    kinds = spark.createDataFrame([("Timeout",), ("JSON parse",), ("text too long",), ("?",), (None,)], "e string").select(model_calls.error_type("e")).collect()
    assert [r[0] for r in kinds] == ["network", "json", "too_long", "other", None]
    assert model_calls.reply_text({"choices": [{"text": "t"}]}) == "t"
    assert model_calls.joined_stream(iter([{"choices": [{"delta": {"content": "a"}}]}, {"choices": []}, {"choices": [{"delta": {"content": "b"}}]}])) == "ab"
    assert model_calls.resolve_key(None, {"B": "k"}, ("A", "B")) == "k"
    prompt = spark.createDataFrame([("p",)], "x string").select(model_calls.template('{{"a": {x}}} {y}', x=F.col("x"), y=F.lit(None).cast("string"))).first()[0]
    assert prompt == '{"a": p} '


def test_kmeans_parts_the_rows(spark):
    df = spark.createDataFrame([(i, [float(i % 2) * 10, 1.0]) for i in range(20)], "i int, e array<double>")
    out = clusters.with_clusters(df, "e", clusters.fit_kmeans(df, "e", 2)).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in out) == [10, 10]
