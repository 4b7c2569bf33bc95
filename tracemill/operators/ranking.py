"""Exact positions and ranks within groups, without gathering a group anywhere.

All rows are range-partitioned and sorted by group, then by the wanted order.
A group then lies in consecutive partitions, so only the first group of a
partition can have begun before it. Each partition counts locally and reports
one summary row; a prefix sum over these summaries (one per partition, however
many rows or groups there are) gives what the first group and the first run of
equal values have to be shifted by.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.sources.stage import staged


def _changes(columns: list[np.ndarray], last: list | None) -> np.ndarray:
    """Where a row differs from the one before it; the first row is compared with ``last``."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    for i, c in enumerate(columns):
        out[1:] |= c[1:] != c[:-1]
        out[0] |= last is None or c[0] != last[i]
    return out


class _Counter:
    """Positions in groups and ranks in runs over the sorted batches of one partition."""

    def __init__(self) -> None:
        self.group = self.run = self.first_group = self.first_run = None
        self.in_group = self.run_start = 0
        self.groups = self.runs = 0

    def feed(self, groups: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Local position, local rank, and 0 for the first run, 1 for the rest of the first group, 2 for other groups."""
        new_group = _changes(groups, self.group)
        new_run = _changes(values, self.run) | new_group
        n = len(new_group)
        at = np.arange(n, dtype=np.int64)
        start = np.maximum.accumulate(np.where(new_group, at, -1))
        position = np.where(start >= 0, at - start + 1, at + 1 + self.in_group)
        run_at = np.maximum.accumulate(np.where(new_run, at, -1))
        rank = np.where(run_at >= 0, position[np.maximum(run_at, 0)], self.run_start)
        group_no = self.groups + np.cumsum(new_group)
        run_no = self.runs + np.cumsum(new_run)
        if self.first_group is None:
            self.first_group, self.first_run = [c[0] for c in groups], [c[0] for c in values]
        self.group, self.run = [c[-1] for c in groups], [c[-1] for c in values]
        self.in_group, self.run_start = int(position[-1]), int(rank[-1])
        self.groups, self.runs = int(group_no[-1]), int(run_no[-1])
        return position, rank, np.where(run_no == 1, 0, np.where(group_no == 1, 1, 2))


def _plain(x):
    return x.item() if isinstance(x, np.generic) else x


def _shifts(summaries: list) -> list[tuple[int, int, int]]:
    """Per partition the rows of its first group before it, and the rank of its first run."""
    out, group, run, before, rank = [], None, None, 0, 0
    for s in sorted(summaries, key=lambda s: s["pid"]):
        same = group is not None and s["first_group"] == group
        shift = before if same else 0
        first_rank = rank if same and s["first_run"] == run else shift + 1
        out.append((s["pid"], shift, first_rank))
        if s["n_groups"] > 1:
            shift = 0
        rank = first_rank if s["n_runs"] == 1 else shift + s["last_rank"]
        before = shift + s["last_count"]
        group, run = s["last_group"], s["last_run"]
    return out


def ranked(rows: DataFrame, groups: list[str], values: list[str], order: list[Column], keep: list[str], first: int | None = None) -> DataFrame:
    """``groups``, ``keep``, ``position`` (from 1, unique in a group) and ``rank`` (that of the first row with equal ``values``).

    ``order`` sorts within the group and must begin with ``values``; with
    ``first``, only positions up to it are returned. Groups and values must
    not be null (callers fill or drop them). The sorted rows are written once
    to the shared folder, so positions cannot change when a task is repeated.
    """
    columns = [*groups, *values, *[c for c in keep if c not in values and c not in groups]]
    ordered = rows.repartitionByRange(*[F.col(g) for g in groups], *order).sortWithinPartitions(*[F.col(g) for g in groups], *order).select(*columns)
    ng, nv, extra = len(groups), len(values), [c for c in keep if c not in groups]
    where = [columns.index(c) for c in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, counter = TaskContext.get().partitionId(), _Counter()
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(ng + nv)]
            position, rank, part = counter.feed(arrays[:ng], arrays[ng:])
            picked = np.flatnonzero(position <= first) if first else np.arange(len(position))
            if len(picked):
                taken = batch.take(pa.array(picked))
                made = [pa.array(np.full(len(picked), pid, np.int32)), pa.array(part[picked].astype(np.int32)), pa.array(position[picked]), pa.array(rank[picked]), pa.nulls(len(picked), pa.string())]
                yield pa.RecordBatch.from_arrays([*[taken.column(i) for i in (*range(ng), *where)], *made], names=names)
        if counter.first_group is not None:
            summary = {
                "pid": pid, "first_group": repr([_plain(x) for x in counter.first_group]), "first_run": repr([_plain(x) for x in counter.first_run]),
                "last_group": repr([_plain(x) for x in counter.group]), "last_run": repr([_plain(x) for x in counter.run]),
                "n_groups": counter.groups, "n_runs": counter.runs, "last_count": counter.in_group, "last_rank": counter.run_start,
            }
            blank = [pa.nulls(1, batch.schema.field(i).type) for i in (*range(ng), *where)]
            yield pa.RecordBatch.from_arrays([*blank, pa.array([pid], pa.int32()), pa.array([-1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([repr(summary)])], names=names)

    names = [*groups, *extra, "_pid", "_part", "position", "rank", "_summary"]
    kind = {c: ordered.schema[c].dataType.simpleString() for c in columns}
    schema = ", ".join([*(f"`{c}` {kind[c]}" for c in (*groups, *extra)), "_pid int, _part int, position bigint, rank bigint, _summary string"])
    local = staged(ordered.mapInArrow(run, schema), "ranked")
    summaries = [ast.literal_eval(r[0]) for r in local.filter("_part = -1").select("_summary").collect()]  # one row per partition
    spark = rows.sparkSession
    shifts = spark.createDataFrame(_shifts(summaries), "_pid int, _shift bigint, _first_rank bigint")
    moved = local.filter("_part >= 0").join(F.broadcast(shifts), "_pid")  # one row per partition
    position = F.col("position") + F.when(F.col("_part") < 2, F.col("_shift")).otherwise(0)
    rank = F.when(F.col("_part") == 0, F.col("_first_rank")).when(F.col("_part") == 1, F.col("rank") + F.col("_shift")).otherwise(F.col("rank"))
    out = moved.select(*groups, *extra, position.alias("position"), rank.alias("rank"))
    return out.filter(F.col("position") <= first) if first else out
