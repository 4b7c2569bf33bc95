"""The pipelines on the command line: ``python -m tracemill STEP --input ... --output ...``.

Every step reads a file or folder by its suffix, runs the operators on the
cluster that Spark is configured for, and writes Parquet or JSON lines by the
suffix of the output. Steps that need a model take ``--url`` and ``--model``;
without them they only write their requests, for a model run elsewhere, and
``--responses`` takes its replies (``key, raw, error``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.functions.arrays import or_empty
from tracemill.operators import clusters, compression, contamination, failures, formats, judging, loops, markers, model_calls, profile, prompts, refinement, resume, sampling, selection
from tracemill.operators.phrases import phrase_hits
from tracemill.session import build_session
from tracemill.sources import readers, writers
from tracemill.sources.stage import release, staged


def _write(df: DataFrame, path: str) -> None:
    (writers.write_json_lines if path.endswith((".json", ".jsonl")) else writers.write_parquet)(df, path)


def _replies(args: argparse.Namespace, made: DataFrame, kind: str) -> DataFrame | None:
    """The replies of a step: from the given table, from the model, or None after its requests are written."""
    step = prompts.STEPS[kind]
    if args.responses:
        return prompts.replies(readers.read_any(made.sparkSession, args.responses, "key string, raw string, error string"), kind)
    if not args.url:
        _write(made, f"{args.output}/requests.parquet")
        return None
    waits = {"waits": model_calls.JUDGE_WAITS} if kind == "judge" else {}
    backend = model_calls.HttpBackend(args.url, args.model, args.key, step.temperature, timeout=step.timeout, tries=step.tries, completions=args.completions, **waits)
    return prompts.replies(model_calls.ask(made, backend, args.at_once, args.partitions), kind)


def decontaminate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rows that a benchmark contains taken out: equal answers and the same words, or the whole text of an item."""
    rows, bench = readers.read_any(spark, args.input), readers.read_any(spark, args.benchmark)
    bench = bench.withColumn("problem", formats.benchmark_question(bench))
    hits = contamination.answer_matches(rows, bench, args.id, contamination.word_overlap_judge()).unionByName(phrase_hits(rows, bench, args.id, "problem", "problem", "item_id"))
    _write(contamination.without_matches(rows, hits, args.id), args.output)


def repair(spark: SparkSession, args: argparse.Namespace) -> None:
    """Looping traces rewritten by a model and put back; the report of what was found."""
    rows = readers.read_any(spark, args.input)
    found = staged(loops.loop_requests(rows, args.id).join(rows.select(args.id, "problem"), args.id), "loops")
    keyed = found.withColumn("_key", F.concat_ws("/", args.id, "i"))
    said = _replies(args, prompts.requests(keyed, "stitch", "_key", kind=F.col("kind"), problem=F.col("problem"), folded=F.col("folded")), "stitch")
    print(writers.small_json(loops.repair_report(rows)))
    if said is not None:
        new = keyed.join(said.select(F.col("key").alias("_key"), F.col("value").alias("text")), "_key").select(args.id, "i", "text")
        _write(loops.repaired(rows, args.id, new), args.output)


def select(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pairs of traces judged by a model and scored: ``selected.parquet``, ``failed.parquet``; problems of earlier runs are left out with ``--resume``."""
    rows = readers.read_any(spark, args.input)
    if args.resume:
        rows = resume.pending_problems(rows, *[spark.read.parquet(p).select("problem_hash") for p in (f"{args.output}/selected.parquet", f"{args.output}/failed.parquet")])
    else:
        rows = rows.withColumn("problem_hash", resume.problem_key(F.coalesce("problem", F.lit(""))))
    rows = rows.withColumn("_p", selection.pick_pair(F.col("generations"))).filter("_p IS NOT NULL")
    side = {x: F.get("generations", F.col(f"_p.{x}")) for x in "ab"}
    pairs = staged(rows.select("problem_hash", "problem", "answer", "solution", *[side[x].alias(f"cot_{x}") for x in "ab"], *[selection.verified_label(F.col(f"_p.{x}")).alias(f"label_{x}") for x in "ab"]).dropDuplicates(["problem_hash"]), "pairs")
    said = _replies(args, prompts.requests(pairs, "judge", "problem_hash", **{c: F.col(c) for c in ("problem", "cot_a", "cot_b", "label_a", "label_b")}), "judge")
    if said is None:
        return
    v = "value."
    wrong = judging.judgement_error(F.col(v + "problem_difficulty"), F.col(v + "cot_a.quality_tags"), F.col(v + "cot_a.issues"), F.col(v + "cot_b.quality_tags"), F.col(v + "cot_b.issues"), F.col(v + "winner"))
    said = said.withColumn("error", F.coalesce("error", F.concat(F.lit("validation failed: "), wrong)))
    good, bad = model_calls.attach(pairs, "problem_hash", said.withColumn("value", F.when(F.col("error").isNull(), F.col("value"))))
    score = {x: selection.selection_score(F.col(f"value.cot_{x}.quality_tags"), F.col(f"value.cot_{x}.issues"), F.col(f"label_{x}")) for x in "ab"}
    good = good.withColumn("score_a", score["a"]).withColumn("score_b", score["b"])
    good = good.withColumn("winner", selection.winner(F.col("score_a"), F.col("score_b"), F.length("cot_a"), F.length("cot_b")))
    own = F.when(F.col("winner") == "a", F.col("cot_a")).otherwise(F.col("cot_b"))
    good = good.select(
        "problem_hash", F.lit("ok").alias("status"), F.col("problem").alias("instruction"), own.alias("output"), "solution", "answer", F.col("value.problem_difficulty").alias("problem_difficulty"), "winner", F.greatest("score_a", "score_b").alias("winner_score"),
        "score_a", "score_b", F.when(F.col("winner") == "a", F.col("label_a")).otherwise(F.col("label_b")).alias("verified_label"), F.col("value").alias("judgement"),
    )
    writers.write_parquet(good, f"{args.output}/selected.parquet", args.resume)
    writers.write_parquet(bad, f"{args.output}/failed.parquet", args.resume)


def cluster(spark: SparkSession, args: argparse.Namespace) -> None:
    """Clusters by embedding, and the best share of each: ``high.parquet`` and ``low.parquet``."""
    rows = readers.embedding_cache(spark, args.input, ("embedding", args.id)).filter("status = 'ok'")
    rows = rows.withColumn("global_score", selection.global_score(F.col("winner_score"), F.col("problem_difficulty"))) if "global_score" not in rows.columns else rows
    own = staged(clusters.with_clusters(rows, "embedding", clusters.fit_kmeans(rows, "embedding", args.clusters, args.seed), "_cluster" if "_cluster" not in rows.columns else "_own_cluster"), "clustered")
    name = "_own_cluster" if "_own_cluster" in own.columns else "_cluster"
    order = [F.col("global_score").desc_nulls_last(), *([F.col("IFD_Score").desc_nulls_last()] if "IFD_Score" in own.columns else [])]
    split = staged(selection.ranked_share(own, args.id, name, order, args.share), "split")
    both = own.join(split, args.id).drop(name)
    for part in ("high", "low"):
        writers.write_parquet(both.filter(F.col("split") == part).drop("split"), f"{args.output}/{part}.parquet")
    print(writers.small_json(selection.split_summary(both, "global_score")))


def compress(spark: SparkSession, args: argparse.Namespace) -> None:
    """Traces in blocks with the targets they support, failures by type, statistics: ``compressed``, ``failures`` and a summary."""
    rows = readers.inline_text(spark, args.text) if args.text else readers.read_any(spark, args.input)
    key, text = formats.sample_id(rows, F.monotonically_increasing_id()), formats.trace_text(rows)["text"]
    own = staged(compression.compressed(rows.select(key.alias("sample_id"), text.alias("cot")), "sample_id", "cot"), "compressed")
    good, bad = failures.parted(own, "sample_id", "error", not args.fail_fast)
    _write(good, f"{args.output}/compressed.jsonl" if args.json else f"{args.output}/compressed.parquet")
    writers.write_parquet(bad, f"{args.output}/failures.parquet")
    print(writers.small_json(compression.batch_summary(good.filter("num_blocks > 0"))))
    print(writers.small_json(compression.failure_kinds(bad)))


def stats(spark: SparkSession, args: argparse.Namespace) -> None:
    """Histograms, anomalies and the summary of compressed traces."""
    rows = staged(readers.read_any(spark, args.input).filter("num_blocks > 0"), "stats")
    for df in (compression.batch_summary(rows), compression.histograms(rows), compression.anomalies(rows, "sample_id")):
        print(writers.small_json(df))


def refine(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rewritten traces routed by what became of their correctness; ``--input`` has ``output, new_output, answer``."""
    rows = readers.read_any(spark, args.input)
    old = refinement.verified(rows, "output", "answer").withColumnRenamed("is_equivalent", "old_correct")
    both = staged(refinement.verified(old, "new_output", "answer").withColumnRenamed("is_equivalent", "new_correct"), "verified")
    _write(refinement.refined(both), args.output)
    path = refinement.refine_path(F.col("old_correct"), F.col("new_correct"), F.col("output"), F.col("new_output"))
    print(writers.small_json(refinement.path_counts(both.withColumn("path", path))))


def extract_markers(spark: SparkSession, args: argparse.Namespace) -> None:
    """The marker dictionary of a stratified sample of the texts."""
    rows = readers.read_any(spark, args.input)
    own = rows.select(F.col(args.id).alias("_id"), formats.trace_text(rows)["text"].alias("_text"))
    _write(markers.dictionary(sampling.stratified_sample(own, args.n, args.strata, "_id", args.seed), "_text", args.min_count), args.output)


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    """A seeded sample of an exact size."""
    _write(sampling.exact_sample(readers.read_any(spark, args.input), args.n, args.id, args.seed), args.output)


def scan_lengths(spark: SparkSession, args: argparse.Namespace) -> None:
    """Token lengths of a column, and how many generations there are and how many are complete."""
    rows = readers.read_any(spark, args.input)
    print(writers.small_json(profile.length_profile(rows, args.column, profile.word_pieces)))
    if "generations" in rows.columns:
        print(writers.small_json(profile.generations_histogram(rows)))
    if "is_reasoning_complete" in rows.columns:
        print(writers.small_json(profile.completeness(rows)))


def to_chat(spark: SparkSession, args: argparse.Namespace) -> None:
    """Training records: chats of problems with generations, query and response of selected rows."""
    rows = readers.read_any(spark, args.input)
    chats = "generations" in rows.columns and "messages" in rows.columns
    _write(formats.chat_rows(rows.withColumn("generations", or_empty("generations")), args.id) if chats else formats.query_response(rows, args.system or None), args.output)


STEPS = {
    "decontaminate": decontaminate, "repair": repair, "select": select, "cluster": cluster, "compress": compress, "stats": stats, "refine": refine,
    "markers": extract_markers, "sample": sample, "lengths": scan_lengths, "chat": to_chat,
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tracemill", description=__doc__)
    steps = out.add_subparsers(dest="step", required=True)
    for name, f in STEPS.items():
        own = steps.add_parser(name, help=f.__doc__)
        own.add_argument("--input", default="")
        own.add_argument("--output", default="")
        own.add_argument("--id", default={"select": "problem_hash", "cluster": "score_id"}.get(name, "row_id"))
        own.add_argument("--seed", type=int, default={"markers": 20260521}.get(name, 42))
        if name in ("repair", "select"):
            for flag, default in (("--url", ""), ("--model", ""), ("--key", ""), ("--completions", ""), ("--responses", "")):
                own.add_argument(flag, default=default)
            own.add_argument("--at-once", type=int, default=4)
            own.add_argument("--partitions", type=int, default=4)
        if name == "select":
            own.add_argument("--resume", action="store_true")
        if name == "decontaminate":
            own.add_argument("--benchmark", required=True)
        if name == "cluster":
            own.add_argument("--clusters", type=int, default=40)
            own.add_argument("--share", type=float, default=0.8)
        if name == "compress":
            own.add_argument("--text", default="")
            own.add_argument("--fail-fast", action="store_true")
            own.add_argument("--json", action="store_true")
        if name in ("sample", "markers"):
            own.add_argument("--n", type=int, default=3000 if name == "sample" else 40)
        if name == "markers":
            own.add_argument("--strata", type=int, default=10)
            own.add_argument("--min-count", type=int, default=2)
        if name == "lengths":
            own.add_argument("--column", default="problem")
        if name == "chat":
            own.add_argument("--system", default="")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one step; 1 if it failed. What it staged is removed at the end."""
    args = parser().parse_args(argv)
    own = spark or build_session(f"tracemill {args.step}")
    try:
        STEPS[args.step](own, args)
        return 0
    except Exception as e:  # noqa: BLE001
        print(f"{args.step}: {type(e).__name__}: {str(e)[:1000]}", file=sys.stderr)
        return 1
    finally:
        release(own)
        if spark is None:
            own.stop()
