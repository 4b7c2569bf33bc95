"""Reading the file formats that traces come in."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from fnmatch import fnmatch
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.sources.stage import staged

CORRUPT = "_corrupt"


def parquet_shards(spark: SparkSession, pattern: str, *columns: str, skip_broken: bool = False, schema: T.StructType | str | None = None) -> DataFrame:
    """All shards of a pattern, with only the wanted columns, and the shard's file name in ``shard_file``.

    With ``skip_broken``, unreadable files are left out. Without a ``schema``
    it comes from the files.
    """
    broken = str(skip_broken).lower()
    reader = spark.read.option("ignoreCorruptFiles", broken).option("mergeSchema", broken)
    rows = (reader.schema(schema) if schema is not None else reader).parquet(pattern)
    return rows.select(*(columns or rows.columns), F.col("_metadata.file_name").alias("shard_file"))


def shard_output_name(name: Column | str) -> Column:
    """``train-X-of-Y.parquet`` as ``optimized_train-X.jsonl``."""
    return F.regexp_replace(name, r"^(train-\d+)-of-\d+\.parquet$", "optimized_$1.jsonl")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None, mode: str = "strict") -> DataFrame:
    """JSON lines; blank lines are left out and a byte order mark is no data.

    ``strict`` fails at an invalid line or one that is no object, ``lenient``
    leaves it out, ``keep`` gives it in a column ``_corrupt``.
    """
    reader = spark.read
    if schema is not None:
        own = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if mode == "keep":
            own = T.StructType([*own.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(own)
    option = {"strict": "FAILFAST", "lenient": "DROPMALFORMED", "keep": "PERMISSIVE"}[mode]
    return reader.option("mode", option).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def json_lines_checked(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with ``line_no`` (within its file, from 1), blank lines left out; an invalid line or one that is no object is an error that names its number.

    Each file is read by one task, as its lines are counted. Bytes that are no
    UTF-8 become replacement characters.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("_file"), F.posexplode(F.split("value", "\n")).alias("_i", "_line"))
    lines = lines.withColumn("_line", F.trim(F.col("_line"), F.lit("\ufeff \t\r"))).filter("_line <> ''")
    own = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).simpleString()
    value = F.when(F.col("_line").startswith("{"), F.from_json("_line", own, {"mode": "PERMISSIVE"}))
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("_line")).startswith("OBJECT"), F.lit(False))
    bad = F.raise_error(F.concat(F.lit("invalid JSON object in "), "_file", F.lit(" at line "), (F.col("_i") + 1).cast("string")))
    rows = lines.select((F.col("_i") + 1).alias("line_no"), F.when(is_object, value).otherwise(bad.cast(own)).alias("v"))
    return rows.select("line_no", "v.*")


def json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A file that holds one JSON array (a row per element) or one object (a row)."""
    reader = spark.read.option("multiLine", "true").option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def json_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """An array, one object over several lines, or lines: told apart by the first line that isn't blank."""
    head = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()  # one line of one file
    first = head[0]["value"].strip("﻿ \t\r\n") if head else ""
    return json_document(spark, path, schema) if first.startswith("[") or first == "{" else json_lines(spark, path, schema)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """A row per text file: ``sample_id`` (the name without suffix) and ``cot``."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("sample_id"), F.col("value").alias("cot"))


def inline_text(spark: SparkSession, text: str, sample_id: str = "0") -> DataFrame:
    return spark.createDataFrame([(sample_id, text)], "sample_id string, cot string")


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """By the suffix: .parquet, .jsonl, .json, .txt, .md; anything else is an error."""
    suffix = PurePosixPath(re.sub(r"[*?\[\]{}]", "x", path)).suffix.lower()
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".jsonl":
        return json_lines(spark, path, schema)
    if suffix == ".json":
        return json_any(spark, path, schema)
    if suffix in (".txt", ".md"):
        return whole_texts(spark, path)
    raise ValueError(f"no reader for {path!r}")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """A column ``index``, from 0, in the given order."""
    rows = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_part", "_low", before.alias("_before")))  # one row per partition
    joined = rows.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn("index", F.col("_at") - F.col("_low") + F.col("_before")).drop("_at", "_part", "_low", "_before")


def marker_list(spark: SparkSession, path: str) -> list[str]:
    """All strings of a JSON file of markers: stripped, distinct, longest first, then by lower case; none is an error."""
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())  # a configuration file
    found: set[str] = set()

    def walk(value: object) -> None:
        if isinstance(value, str):
            found.add(value.strip())
        elif isinstance(value, dict | list):
            for inner in value.values() if isinstance(value, dict) else value:
                walk(inner)

    data = json.loads(text)
    walk(data.get("logic_markers", data) if isinstance(data, dict) else data)
    found.discard("")
    if not found:
        raise ValueError(f"no markers in {path!r}")
    return sorted(found, key=lambda m: (-len(m), m.lower(), m))


def embedding_cache(spark: SparkSession, path: str, needed: tuple[str, ...] = ("solution",)) -> DataFrame:
    """A table of embeddings; columns that are missing from it are an error."""
    rows = spark.read.parquet(path)
    if missing := [c for c in needed if c not in rows.columns]:
        raise ValueError(f"{path!r} lacks {missing}")
    return rows


#: Files of a data set that hold no data.
IGNORED = ("*.pdf", "*.png", "*.jpg")


def fetch_snapshot(listed: Callable[[str], list[str]], fetch: Callable[[str, str], None], names: list[str], ignore: tuple[str, ...] = IGNORED) -> dict[str, str]:
    """Fetch the files of each data set but the ignored ones; the outcome of each, so that one failure doesn't stop the others.

    ``listed(name)`` gives the files of a data set, ``fetch(name, file)`` gets
    one; both come from the hub's client, which is no part of this library.
    """
    out = {}
    for name in names:
        try:
            files = [f for f in listed(name) if not any(fnmatch(f.lower(), p) for p in ignore)]
            for file in files:
                fetch(name, file)
            out[name] = f"{len(files)} files"
        except Exception as e:  # noqa: BLE001
            out[name] = f"failed: {e}"
    return out
