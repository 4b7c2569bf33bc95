"""Writing results."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines with characters as they are; null fields are written as null."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").parquet(path)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One file with a small text, such as a JSON result or a log."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def append_new(df: DataFrame, path: str, key: str) -> int:
    """Append the rows whose key isn't in the table yet, and say how many; repeating it appends nothing.

    Of several new rows with one key the first by the values of its columns
    stays (columns that have an order), so a repetition chooses alike.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c != key]
    sortable = F.struct(*[F.to_json(F.struct(c)).alias(c) for c in others]) if others else F.lit(0)
    new = df.groupBy(key).agg(F.min_by(F.struct(*others), sortable).alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in others]).select(*df.columns) if others else df.distinct()
    if _exists(spark, path):
        new = new.join(spark.read.schema(df.schema).parquet(path).select(key), key, "left_anti").select(*df.columns)
    batch = f"{path}/batch={uuid.uuid4().hex}"
    new.write.parquet(batch)
    return spark.read.parquet(batch).count()


def write_routes(df: DataFrame, route: str, path: str) -> None:
    """One pass, a folder per value of ``route``."""
    df.write.mode("overwrite").partitionBy(route).parquet(path)


def read_route(spark: SparkSession, path: str, route: str, value: str) -> DataFrame:
    """The rows of one route; only its folder is read."""
    return spark.read.parquet(path).filter(F.col(route) == value).drop(route)


def unfinished_shards(spark: SparkSession, shards: Iterable[str], folder: str) -> list[str]:
    """The shards that have no output with data in it."""
    return [s for s in shards if not _exists(spark, f"{folder}/{s}", filled=True)]


def clear(spark: SparkSession, path: str) -> None:
    """Remove an output before a run."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _exists(spark: SparkSession, path: str, filled: bool = False) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and (not filled or fs.getContentSummary(p).getLength() > 0)


def small_json(df: DataFrame, most: int = 10_000) -> str:
    """A small result as a pretty JSON array; a larger one is an error, it belongs into ``write_json_lines``."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return json.dumps([json.loads(r) for r in rows], ensure_ascii=False, indent=2)


def envelope(results: DataFrame, errors: DataFrame) -> str:
    """Small results as JSON; together with errors, if there are any, in an object of both."""
    own, bad = small_json(results), small_json(errors)
    return own if bad == "[]" else json.dumps({"results": json.loads(own), "errors": json.loads(bad)}, ensure_ascii=False, indent=2)


def prune_result(key: str, blocks: list[str], kept: list[int], jump: int | None, log: list[str] | None = None) -> str:
    """The outcome of pruning one trace as JSON: status, where it broke off, the kept blocks and their text."""
    own = set(kept)
    value = {
        "sample_id": key, "status": "success" if jump is None else "logic_jump", "exception_block": jump, "original_block_count": len(blocks), "kept_block_count": len(own),
        "kept_block_indices": sorted(own), "pruned_think": "\n\n".join(b for i, b in enumerate(blocks) if i in own), "logs": log or [],
    }
    return json.dumps(value, ensure_ascii=False, indent=2)


def prune_log(blocks: list[str], kept: list[int], jump: int | None) -> str:
    """What a pruning of one trace decided, for reading."""
    lines = [f"blocks {len(blocks)}, kept {len(kept)}, " + ("complete" if jump is None else f"logic jump at {jump}")]
    lines += [f"{'+' if i in set(kept) else '-'} B_{i}: {' '.join(b.split())[:120]}" for i, b in enumerate(blocks)]
    return "\n".join(lines)
