"""New files handled as they come, with the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tracemill.sources.writers import append_new


def table_stream(spark: SparkSession, folder: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    """The Parquet files of a folder as a stream; its checkpoint knows which are done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def run_incremental(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, key: str, checkpoint: str) -> StreamingQuery:
    """Transform every batch and append what the target doesn't have by key, then stop when all files are done.

    A batch that is repeated after a failure appends nothing twice.
    """

    def write(batch: DataFrame, _: int) -> None:
        append_new(transform(batch), target, key)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows per time window and kind; rows later than ``late`` behind the newest are left out in a stream."""
    rows = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return rows.groupBy(F.window("_t", width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")
