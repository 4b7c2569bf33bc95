"""Materialised intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode, where it is unset, a temporary one that goes with the process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tracemill-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return "file://" + _LOCAL[app]


def own_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; ``release`` removes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    The result no longer depends on shuffle files or cached blocks, so losing
    an executor costs only the tasks that were running on it.
    """
    spark = df.sparkSession
    path = own_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete everything that was staged in this application, and say how many tables that were.

    For the end of a run, when its results are written: a result that still
    reads staged tables is lost with them.
    """
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(made)
