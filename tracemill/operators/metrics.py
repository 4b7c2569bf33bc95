"""Progress figures of a run, observed while its result is written."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def measured(df: DataFrame, write: Callable[[DataFrame], None], text: str | None = None, error: str | None = None) -> dict[str, float]:
    """Write ``df`` and say how many rows went through, how many had an error, their characters, the seconds and rows a second.

    The counts are observed inside the one job that writes; nothing is read again.
    """
    seen = Observation()
    zero = F.lit(0).cast("bigint")
    counts = [F.count(F.lit(1)).alias("rows"), (F.coalesce(F.sum(F.length(text).cast("bigint")), zero) if text else zero).alias("characters"), (F.count_if(F.col(error).isNotNull()) if error else zero).alias("failed")]
    began = time.monotonic()
    write(df.observe(seen, *counts))
    seconds = time.monotonic() - began
    return dict(seen.get) | {"seconds": seconds, "rows_per_second": seen.get["rows"] / max(seconds, 1e-9)}
