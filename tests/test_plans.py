"""Plans that matter at scale."""

from pyspark.sql import functions as F

from tracemill.operators import compression, loops, resume, selection
from tracemill.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_work_does_not_shuffle(spark, small):
    for name in ("loop_detect", "fold_long_text", "logic_skeletons", "pick_pair", "block_target_edges", "selection_score", "trace_text"):
        assert "Exchange" not in plan(catalog.queries()[name](spark, small)), name


def test_column_functions_stay_in_the_jvm(spark, small):
    given = spark.createDataFrame([(["x = 3 so 3"], ["3"])], "blocks array<string>, targets array<string>").coalesce(1)
    labelled = compression.statistics(compression.labelled(given, F.col("blocks"), F.col("targets")), F.col("blocks"), F.col("targets"))
    frames = {name: catalog.queries()[name](spark, small) for name in ("loop_detect", "marker_counts", "marker_leading_counts", "sentence_split", "target_canonical", "answer_numbers")} | {"labelled": labelled}
    for name, df in frames.items():
        assert "Python" not in plan(df) and "Arrow" not in plan(df), name


def test_no_nested_loops_and_no_windows_over_sources(spark, small):
    """Phrase searches read the texts once, and the flagship ranks without a window that holds a whole source."""
    for name in ("contamination_contains", "keyword_probe", "high_quality_split", "decontaminate_normalized_equi"):
        own = plan(catalog.queries()[name](spark, small))
        assert "NestedLoop" not in own and "Cartesian" not in own, name
        assert "Window" not in own, name


def test_scans_are_pruned(spark, small):
    df = loops.complete_only(spark.read.parquet(f"{small}/problems.parquet").select("row_id", "generations", "is_reasoning_complete", "correctness_math_verify"))
    assert "solution" not in plan(df.select("row_id"))
    done = plan(catalog.queries()["correctness_share"](spark, small))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,ok)]" in done and "output:string" not in done


def test_resume_is_an_anti_join(spark, small):
    rows = spark.read.parquet(f"{small}/problems.parquet")
    assert "LeftAnti" in plan(resume.pending_problems(rows, spark.read.parquet(f"{small}/selected.parquet")))


def test_ranked_share_has_no_window(spark):
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    assert "Window" not in plan(selection.ranked_share(df, "k", "c", [F.col("k")], 0.8))
