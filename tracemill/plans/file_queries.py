"""Queries that write tables in every form and read them again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators import compression, failures, markers, prompts
from tracemill.plans.block_sql import BLOCKS, TARGETS
from tracemill.plans.registry import query, strip, table
from tracemill.sources import readers, writers
from tracemill.sources.stage import own_folder
from tracemill.streaming.incremental import run_incremental, table_stream


@query("SELECT row_id, problem_hash FROM problems")
def shard_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Shards by a pattern, only the wanted columns, with a broken file among them."""
    path = own_folder(spark, "shards")
    table(spark, folder, "problems").select("row_id", "problem_hash", "problem", F.coalesce("shard", F.lit("none")).alias("part")).write.partitionBy("part").parquet(path)
    writers.write_text_file(spark, f"{path}/part=broken/x.parquet", "no parquet")
    return readers.parquet_shards(spark, f"{path}/part=*", "row_id", "problem_hash", skip_broken=True, schema="row_id bigint, problem_hash string").select("row_id", "problem_hash")


@query("SELECT shard FROM (SELECT shard, row_number() OVER (ORDER BY shard) AS r FROM (SELECT DISTINCT shard FROM problems WHERE shard IS NOT NULL)) WHERE r % 2 = 0")
def shards_to_do(spark: SparkSession, folder: str) -> DataFrame:
    """The shards without an output that holds data."""
    path, names = own_folder(spark, "outputs"), [r[0] for r in table(spark, folder, "problems").filter("shard IS NOT NULL").select("shard").distinct().orderBy("shard").collect()]  # a row per shard
    for i, name in enumerate(names):
        writers.write_text_file(spark, f"{path}/{name}", "" if i % 2 else "x")
    return spark.createDataFrame([(s,) for s in writers.unfinished_shards(spark, names, path)], "shard string")


_PLAIN = "selected_id bigint, instruction string, answer string, winner_score double"


@query("SELECT selected_id, instruction, answer, winner_score, true AS has_answer FROM selected")
def json_lines_strict(spark: SparkSession, folder: str) -> DataFrame:
    path = own_folder(spark, "lines")
    writers.write_json_lines(table(spark, folder, "selected").select("selected_id", "instruction", "answer", "winner_score"), path)
    keys = spark.read.text(path).filter(F.col("value").contains('"answer":')).select(F.from_json("value", "selected_id bigint")["selected_id"].alias("selected_id"), F.lit(True).alias("has_answer"))
    return readers.json_lines(spark, path, _PLAIN).join(keys, "selected_id")


@query("SELECT selected_id, instruction, answer, winner_score FROM selected")
def json_lines_numbered(spark: SparkSession, folder: str) -> DataFrame:
    path = own_folder(spark, "lines")
    writers.write_json_lines(table(spark, folder, "selected").select("selected_id", "instruction", "answer", "winner_score"), path)
    return readers.json_lines_checked(spark, f"{path}/*.json", _PLAIN).drop("line_no")


@query("SELECT selected_id, answer FROM selected WHERE answer IS NOT NULL")
def json_lines_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with blank, cut and foreign ones among them; those are left out."""
    path = own_folder(spark, "lines")
    rows = table(spark, folder, "selected").filter("answer IS NOT NULL").select(F.to_json(F.struct("selected_id", "answer")).alias("value"))
    noise = rows.select(F.explode(F.array(F.lit(""), F.substring("value", 1, 12), F.lit("[1, 2]"))).alias("value"))
    rows.unionByName(noise).write.text(path)
    return readers.json_lines(spark, path, "selected_id bigint, answer string", "lenient").filter("selected_id IS NOT NULL").select("selected_id", "answer")


@query("SELECT item_id, problem, answer, form FROM benchmark_items, (VALUES ('array'), ('lines'), ('envelope'), ('parquet')) v(form)")
def document_forms(spark: SparkSession, folder: str) -> DataFrame:
    """The same records as a JSON array, as lines, in an envelope with errors, and as Parquet, each read by what its file looks like."""
    path, rows = own_folder(spark, "forms"), table(spark, folder, "benchmark_items").select("item_id", "problem", "answer")
    kind = "item_id bigint, problem string, answer string"
    writers.write_text_file(spark, f"{path}/array.json", writers.small_json(rows))
    writers.write_text_file(spark, f"{path}/lines.jsonl", "\n".join(rows.toJSON().collect()))  # the held-out items, a small table
    writers.write_text_file(spark, f"{path}/both.json", writers.envelope(rows, spark.createDataFrame([("x", "bad")], "sample_id string, error string")))
    writers.write_parquet(rows, f"{path}/rows.parquet")
    both = readers.read_any(spark, f"{path}/both.json", f"results array<struct<item_id: bigint, problem: string, answer: string>>, errors array<struct<sample_id: string, error: string>>").filter("size(errors) = 1")
    found = {"array": readers.read_any(spark, f"{path}/array.json", kind), "lines": readers.read_any(spark, f"{path}/lines.jsonl", kind), "envelope": both.select(F.inline("results")), "parquet": readers.read_any(spark, f"{path}/rows.parquet")}
    out = None
    for form, own in found.items():
        own = own.select("item_id", "problem", "answer", F.lit(form).alias("form"))
        out = own if out is None else out.unionByName(own)
    return out.filter("item_id IS NOT NULL")


@query("SELECT CAST(item_id AS VARCHAR) AS sample_id, problem AS cot FROM benchmark_items WHERE problem <> '' UNION ALL SELECT '0', 'inline'")
def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Each held-out text (a small, fixed table) as a file of its own, and an inline text."""
    path = own_folder(spark, "texts")
    for r in table(spark, folder, "benchmark_items").filter("problem <> ''").collect():
        writers.write_text_file(spark, f"{path}/{r['item_id']}.txt", r["problem"])
    writers.write_text_file(spark, f"{path}/none.log", "not read")
    inline = readers.inline_text(spark, "inline")
    if not table(spark, folder, "benchmark_items").filter("problem <> ''").limit(1).count():
        return inline
    return readers.read_any(spark, f"{path}/*.txt").unionByName(inline)


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index FROM documents")
def numbered_records(spark: SparkSession, folder: str) -> DataFrame:
    return readers.numbered(table(spark, folder, "documents").select("doc_id"), "doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN 'first' ELSE 'second' END AS run FROM documents")
def append_once(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs that overlap, each of them repeated: every key is there once, from the run that had it first."""
    path, rows = own_folder(spark, "appended"), table(spark, folder, "documents").select("doc_id")
    writers.clear(spark, path)
    first, second = rows.filter("doc_id % 3 < 2").withColumn("run", F.lit("first")), rows.withColumn("run", F.lit("second"))
    for df in (first, first, second, second):
        writers.append_new(df, path, "doc_id")
    return spark.read.schema("doc_id bigint, run string").parquet(path).select("doc_id", "run")


@query("SELECT doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL")
def incremental_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The table as a stream of files, appended once by key; the run is repeated with a lost checkpoint."""
    path, rows = own_folder(spark, "stream"), table(spark, folder, "documents").select("doc_id", "text")
    rows.repartition(3).write.parquet(f"{path}/in")
    for checkpoint in ("one", "two"):
        stream = table_stream(spark, f"{path}/in", rows.schema, 2)
        run_incremental(stream, lambda b: b.filter("text IS NOT NULL").select("doc_id", F.length("text").cast("bigint").alias("n")), f"{path}/out", "doc_id", f"{path}/{checkpoint}").awaitTermination()
    return spark.read.schema("doc_id bigint, n bigint").parquet(f"{path}/out").select("doc_id", "n") if rows.limit(1).count() else rows.select("doc_id", F.lit(0).cast("bigint").alias("n"))


@query("SELECT selected_id, coalesce(verified_label, '') AS verified_label FROM selected WHERE status = 'ok' AND winner = 'a'")
def routed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One pass into several outputs, of which one is read again."""
    path, rows = own_folder(spark, "routes"), table(spark, folder, "selected")
    route = F.when(F.col("status") != "ok", "failed").when(F.col("winner") == "a", "a").otherwise("rest")
    writers.write_routes(rows.select("selected_id", F.coalesce("verified_label", F.lit("")).alias("verified_label"), route.alias("route")), "route", path)
    return writers.read_route(spark, path, "route", "a") if rows.limit(1).count() else rows.select("selected_id", "verified_label")


@query("SELECT score_id, embedding[1] AS head FROM scored WHERE status = 'ok' AND len(embedding) = 32")
def embedding_cache(spark: SparkSession, folder: str) -> DataFrame:
    path = own_folder(spark, "cache")
    writers.write_parquet(table(spark, folder, "scored").filter("status = 'ok' AND size(embedding) = 32").select("score_id", "embedding"), path)
    return readers.embedding_cache(spark, path, ("score_id", "embedding")).select("score_id", F.get("embedding", F.lit(0)).alias("head"))


@query("SELECT CAST(item_id AS VARCHAR) AS key, 'Solve: ' || coalesce(problem, '') || ' {as JSON}' AS prompt FROM benchmark_items")
def prompt_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{own_folder(spark, 'prompts')}/solve.txt"
    writers.write_text_file(spark, path, "Solve: {problem} {{as JSON}}")
    return prompts.requests(table(spark, folder, "benchmark_items"), "choose", "item_id", prompts.load_prompt(spark, path), problem=F.col("problem")).select("key", "prompt")


_SEED_ROWS = ", ".join("('" + m.replace("'", "''") + "')" for group in markers.SEEDS.values() for m in group)


@query(f"SELECT marker, CAST(row_number() OVER (ORDER BY -length(marker), lower(marker), marker) AS INT) AS position FROM (SELECT DISTINCT marker FROM (VALUES {_SEED_ROWS}) v(marker))")
def marker_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{own_folder(spark, 'markers')}/markers.json"
    writers.write_text_file(spark, path, json.dumps({"metadata": {"a": "x"}, "logic_markers": {c: [f" {m} " for m in group] for c, group in markers.SEEDS.items()}}))
    found = readers.marker_list(spark, path)
    return spark.createDataFrame([(m, i + 1) for i, m in enumerate(found)], "marker string, position int")


@query("SELECT * FROM (VALUES ('first', '2 files'), ('lost', 'failed: no such data set'), ('second', '1 files')) v(name, outcome)")
def snapshot_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    sets = {"first": ["a.parquet", "README.PDF", "b.parquet"], "second": ["c.jsonl", "logo.png", "x.jpg"]}

    def listed(name: str) -> list[str]:
        if name not in sets:
            raise OSError("no such data set")
        return sets[name]

    return spark.createDataFrame(sorted(readers.fetch_snapshot(listed, lambda name, file: None, ["first", "lost", "second"]).items()), "name string, outcome string")


@query(f"""WITH RECURSIVE src AS (SELECT selected_id AS k, coalesce(output, '') AS t FROM selected), {TARGETS}, {BLOCKS}, n AS (SELECT DISTINCT k FROM block),
o AS (SELECT src.k, CASE WHEN {strip('t')} = '' THEN 'empty_cot' WHEN len(targets) = 0 THEN 'empty_target' WHEN n.k IS NULL THEN 'empty_blocks' END AS type FROM src JOIN goal USING (k) LEFT JOIN n USING (k))
SELECT CASE WHEN type IS NULL THEN 'ok' ELSE 'failed' END AS status, type, count(*) AS n FROM o GROUP BY ALL""")
def batch_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that skips errors: results and typed failures."""
    rows = compression.compressed(table(spark, folder, "selected"), "selected_id", "output")
    good, bad = failures.parted(rows, "selected_id", "error")
    both = good.select(F.lit("ok").alias("status"), F.lit(None).cast("string").alias("type")).unionByName(bad.select("status", "type"))
    return both.groupBy("status", "type").agg(F.count(F.lit(1)).alias("n"))
