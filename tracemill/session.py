"""Session defaults shared by the bench, the tests and ad-hoc use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tracemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; any of them can be overridden by ``conf``."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
