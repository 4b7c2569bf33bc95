"""Problem 3: groups of mutually similar vectors, from mergeable cluster features."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, cos

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.llm.tables import current_rows, hash_sample
from tracemill.sources.stage import staged

#: Rows of one cluster-feature tree; a partition builds one after another, so its memory is bounded.
TREE_ROWS = 1 << 16
#: Rows that a cell of the reduction should hold, and from where on a cell of a tree is divided once more.
CELL_ROWS, SPLIT_ROWS = 200, 2048
#: A leaf whose second pivot is nearly as near (by so much of the cosine) goes to the cell of that one as well.
MARGIN = 0.04
#: From so many rows on a component is first looked at in blocks of ``BLOCK_ROWS`` rows, as it may be a single group; this changes no result.
EXACT_ROWS, BLOCK_ROWS = 1024, 16384
#: Numbers of a block of cosines or costs that a task holds at once, and clusters for which it holds what may merge, instead of comparing rows once more.
_HELD, HELD_CLUSTERS = 1 << 20, 8192
#: What rounding to bytes can take from a cosine.
_ROUNDING = 0.012


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1) if n else np.zeros((0, 1), kind)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _cells(unit: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of each lowest inner node of a tree: by the nearest of pivots among the rows, cells that are too large once more."""
    rng = np.random.default_rng(len(unit))
    todo = [np.argsort(ids, kind="stable")]
    while todo:
        rows = todo.pop()
        k = len(rows) // 256
        if k < 2:
            yield rows
            continue
        pivots = unit[rng.choice(rows, k, replace=False)]
        cell = np.concatenate([np.argmax(unit[rows[a : a + 8192]] @ pivots.T, axis=1) for a in range(0, len(rows), 8192)])
        order = np.argsort(cell, kind="stable")
        for part in np.split(rows[order], np.flatnonzero(np.diff(cell[order])) + 1):
            if len(part) <= SPLIT_ROWS:
                yield part
            elif len(part) < len(rows):
                todo.append(part)
            else:  # copies of one vector: no pivot parts them
                yield from (part[c : c + SPLIT_ROWS] for c in range(0, len(part), SPLIT_ROWS))


def _leaves(unit: np.ndarray, ids: np.ndarray, least: float) -> np.ndarray:
    """The leader of each row's leaf, itself if the row is a leaf of its own.

    A leaf holds the rows of a cell that are within ``least`` of its leader
    and of each other; if they aren't all, those in the cone around the leader
    in which they must be.
    """
    narrow = cos(acos(least) / 2)
    leader = np.arange(len(unit))
    for part in _cells(unit, ids):
        like = unit[part] @ unit[part].T
        close = like >= least
        free = np.ones(len(part), bool)
        for i in np.flatnonzero(close.sum(1) > 1):
            if free[i]:
                hit = np.flatnonzero(free & close[i])
                if not close[np.ix_(hit, hit)].all():
                    hit = np.flatnonzero(free & (like[i] >= narrow))
                leader[part[hit]] = part[i]
                free[hit] = False
    return leader


def leaf_rows(vectors: DataFrame, id_col: str, least: float, dims: int) -> DataFrame:
    """``(id, leaf, n, unit, centre)``: each row with the smallest id of its leaf and the leaf's size; ``centre`` only on that row.

    A leaf of many rows (a group that a large part of the table belongs to)
    leaves its partition as one entry per tree.
    """

    def flush(ids: list[np.ndarray], parts: list[np.ndarray]) -> pa.RecordBatch:
        own, unit = np.concatenate(ids), np.concatenate(parts)
        leader = _leaves(unit, own, least)
        n = np.bincount(leader, minlength=len(own))
        smallest = np.full(len(own), np.iinfo(np.int64).max)
        np.minimum.at(smallest, leader, own)
        total = np.zeros_like(unit)
        shared = n[leader] > 1
        np.add.at(total, leader[shared], unit[shared])
        total[n == 1] = unit[n == 1]
        centre = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)
        first = own == smallest[leader]
        centres = pa.array([centre[leader[i]].tobytes() if first[i] and shared[i] else None for i in range(len(own))], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(smallest[leader]), pa.array(n[leader].astype(np.int64)), _bytes(unit), centres], names=["id", "leaf", "n", "unit", "centre"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
            norm = np.linalg.norm(rows, axis=1)
            ok = np.isfinite(norm) & (norm > 0)
            ids.append(batch.column(0).to_numpy()[ok])
            parts.append((rows[ok] / norm[ok, None]).astype(np.float32))
            held += int(ok.sum())
            if held >= TREE_ROWS:
                yield flush(ids, parts)
                ids, parts, held = [], [], 0
        if held:
            yield flush(ids, parts)

    full = (F.size("_v") == dims) & ~F.exists("_v", lambda x: x.isNull())
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col("embedding").alias("_v")).filter(F.col("id").isNotNull() & F.coalesce(full, F.lit(False)))
    return rows.mapInArrow(run, "id bigint, leaf bigint, n bigint, unit binary, centre binary")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of batches that are sorted by their first column, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and held[0].column(0)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _components(unit: np.ndarray, least: float) -> np.ndarray:
    """For each row the first row that it is connected with by cosines of at least ``least``."""
    n = len(unit)
    label = np.arange(n)
    once = np.nonzero(unit @ unit.T >= least) if n <= 2048 else None
    if once is not None and len(once[0]) == n:
        return label
    blocks = [(0, 0)] if once else [(a, b) for a in range(0, n, 1024) for b in range(0, n, 8192)]
    while True:
        before = label.copy()
        for a, b in blocks:
            i, j = once or np.nonzero(unit[a : a + 1024] @ unit[b : b + 8192].T >= least)
            np.minimum.at(label, i + a, label[j + b])
        label = label[label]
        if (before == label).all():
            return label


def _two_nearest(unit: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row, and the second nearest where it is within ``MARGIN``, otherwise the nearest again."""
    first, second = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
    for a in range(0, len(unit), 4096):
        like = unit[a : a + 4096] @ pivots.T
        row = np.arange(len(like))
        best = like.argmax(1)
        top = like[row, best]
        like[row, best] = -2
        next_ = like.argmax(1)
        first[a : a + 4096] = best
        second[a : a + 4096] = np.where(top - like[row, next_] < MARGIN, next_, best)
    return first, second


def near_leaves(leaves: DataFrame, least: float, trees: int, dims: int) -> DataFrame:
    """Pairs ``(a, b)``, a > b, that connect leaves whose centres have a cosine of about ``least`` or more.

    The leaf summaries are reduced over several random sets of cells. The
    cells of a set are those of two small sets of pivots crossed (drawn from
    the leaves, so that crowded regions have more of them); a leaf near the
    border of a cell goes to the cells on both sides. Near leaves miss each
    other in one set with a few in a hundred, in all of them practically never
    (figures: README), at any number of cells. Within a cell each leaf is tied
    to the first one it is connected with: at most one pair per leaf and cell.
    """
    n = leaves.count()
    k = max(1, round((n / CELL_ROWS) ** 0.5))
    # a bounded sample: the root of the number of cells, for each of the sets
    drawn = hash_sample(leaves.select("id", "unit"), 2 * k * trees, n, "id").toArrow().sort_by("id")
    pool = _matrix(drawn.column(1).combine_chunks(), np.float32)
    if not len(pool):
        return leaves.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    pivots = [pool[t :: 2 * trees] if len(pool) >= 2 * trees else pool for t in range(2 * trees)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column(1), np.float32)
            packed = _bytes(np.rint(unit * 127).astype(np.int8))
            for t in range(trees):
                a, b = _two_nearest(unit, pivots[2 * t]), _two_nearest(unit, pivots[2 * t + 1])
                for i, j in ((0, 0), (0, 1), (1, 0), (1, 1)):
                    new = np.flatnonzero(((a[1] != a[0]) | (i == 0)) & ((b[1] != b[0]) | (j == 0)))
                    cell = (a[i][new] * len(pivots[2 * t + 1]) + b[j][new]) * trees + t
                    at = pa.array(new)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(0).take(at), packed.take(at)], names=["cell", "id", "v"])

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _grouped(batches):
            if cell.num_rows < 2:
                continue
            unit = _matrix(cell.column(2).combine_chunks(), np.int8).astype(np.float32)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            label = _components(unit, least - _ROUNDING)
            rows = np.flatnonzero(label != np.arange(len(label)))
            if len(rows):
                ids = cell.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(ids[label[rows]])], names=["a", "b"])

    routed = leaves.select("id", F.coalesce("centre", "unit").alias("_c")).mapInArrow(route, "cell bigint, id bigint, v binary")
    ties = routed.repartition("cell").sortWithinPartitions("cell", "id").mapInArrow(tie, "a bigint, b bigint")
    return ties.distinct()


def component_labels(pairs: DataFrame) -> DataFrame:
    """``(id, label)`` for the ids of ``pairs``: the smallest id of the connected component.

    Every round gives each id the smallest label around it and then the label
    of that label; it ends when nothing changes. All of it stays distributed.
    """
    both = staged(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "pairs")
    label = staged(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        around = both.join(label.select(F.col("id").alias("b"), F.col("label").alias("_l")), "b").groupBy(F.col("a").alias("id")).agg(F.min("_l").alias("_m"))
        met = label.join(around, "id").select("id", F.col("label").alias("old"), F.least("label", "_m").alias("low"))
        jump = label.select(F.col("id").alias("low"), F.col("label").alias("_j"))
        new = staged(met.join(jump, "low", "left").select("id", "old", F.least("low", "_j").alias("label")), "labels")
        if not new.filter(F.col("old") != F.col("label")).limit(1).count():
            return new.select("id", "label")
        label = new.select("id", "label")


def ward(sums: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Ward agglomeration of cluster features; the cluster of each (by its first). Only ``allowed`` pairs merge, and a merged one only where both were allowed.

    The cost of a merge is the growth of the squared distance to the centres.
    The plain form, with matrices of all pairs; ``_cones`` gives the same without them.
    """
    n = len(sums)
    cluster, total, size, ok = np.arange(n), sums.astype(np.float64).copy(), sizes.astype(np.float64).copy(), allowed.copy()
    np.fill_diagonal(ok, False)
    mean = total / size[:, None]
    cost = np.full((n, n), np.inf)
    i, j = np.nonzero(ok)
    cost[i, j] = ((mean[i] - mean[j]) ** 2).sum(1) * size[i] * size[j] / (size[i] + size[j])
    while True:
        at = int(np.argmin(cost))
        a, b = divmod(at, n)
        if not np.isfinite(cost[a, b]):
            return cluster
        a, b = min(a, b), max(a, b)
        cluster[cluster == b] = a
        total[a] += total[b]
        size[a] += size[b]
        mean[a] = total[a] / size[a]
        ok[a] &= ok[b]
        ok[:, a] = ok[a]
        ok[b] = ok[:, b] = False
        cost[[a, b]] = cost[:, [a, b]] = np.inf
        j = np.flatnonzero(ok[a])
        cost[a, j] = cost[j, a] = ((mean[a] - mean[j]) ** 2).sum(1) * size[a] * size[j] / (size[a] + size[j])


def _may_merge(centre: np.ndarray, group: np.ndarray, ask: np.ndarray, live: np.ndarray, cut: float) -> np.ndarray:
    """For each cluster of ``ask`` and each of ``live`` if all their rows have a cosine of at least ``cut`` with each other."""
    rows = np.flatnonzero(np.isin(group, live))
    rows = rows[np.argsort(group[rows], kind="stable")]
    others, starts = centre[rows].T, np.searchsorted(group[rows], live)
    ends = np.append(starts[1:], len(rows))
    at = np.searchsorted(live, ask)
    own = np.concatenate([rows[starts[i] : ends[i]] for i in at])
    whose = np.repeat(np.arange(len(at)), ends[at] - starts[at])
    may = np.ones((len(at), len(live)), bool)
    part = max(1, _HELD // len(rows))
    for r in range(0, len(own), part):
        near, to = centre[own[r : r + part]] @ others >= cut, whose[r : r + part]
        if len(rows) > len(live):
            near = np.logical_and.reduceat(near, starts, axis=1)
        first = np.flatnonzero(np.diff(to, prepend=-1))
        may[to[first]] &= np.logical_and.reduceat(near, first, axis=0)
    return may


def _cones(centre: np.ndarray, n: np.ndarray, angle: float) -> np.ndarray:
    """The group of each row, by its first: Ward agglomeration of rows of weight ``n``, where all rows of a group are within the angle of each other.

    One rule for any number of rows. Clusters that are the cheapest to merge
    for each other merge in rounds. A merged cluster is no cheaper for a third
    one than its parts were, so that gives what merging the cheapest pair of
    all, one after another, gives (``ward``), in memory in proportion to the
    rows. It ends when no two clusters may merge.
    """
    cut, count = np.cos(angle) - 1e-9, len(centre)
    part = max(1, _HELD // max(1, count))
    if all((centre[a : a + part] @ centre.T >= cut).all() for a in range(0, count, part)):
        return np.zeros(count, np.int64)
    group, total, size = np.arange(count), centre * n[:, None], np.asarray(n, np.float64).copy()
    mate, cost, live = np.full(count, -1), np.full(count, np.inf), np.arange(count)
    ask, held, place = live, None, np.zeros(count, np.int64)
    while True:
        if held is None and len(live) <= HELD_CLUSTERS:
            held = _may_merge(centre, group, live, live, cut)
            held &= held.T
            place[live] = np.arange(len(live))
        mean = total[live] / size[live, None]
        square, weight = (mean**2).sum(1), size[live]
        step = max(1, _HELD // len(live))
        for q in range(0, len(ask), step):
            own = ask[q : q + step]
            at, row = np.searchsorted(live, own), np.arange(len(own))
            may = _may_merge(centre, group, own, live, cut) if held is None else held[np.ix_(place[own], place[live])]
            price = (square[at, None] + square - 2 * mean[at] @ mean.T) * (weight[at, None] * weight / (weight[at, None] + weight))
            price[~may] = np.inf
            price[row, at] = np.inf
            best = price.argmin(1)
            cost[own] = price[row, best]
            mate[own] = np.where(np.isfinite(cost[own]), live[best], -1)
        live = live[mate[live] >= 0]
        if not len(live):
            return group
        ask = live[~np.isin(mate[live], live)]
        if len(ask):  # a cosine at the cut that another block rounds the other way
            continue
        a = live[(mate[mate[live]] == live) & (live < mate[live])]
        b = mate[a]
        if not len(a):  # a ring of equal costs
            i = live[np.argmin(cost[live])]
            a, b = np.array([min(i, mate[i])]), np.array([max(i, mate[i])])
        total[a] += total[b]
        size[a] += size[b]
        if held is not None:
            held[place[a]] &= held[place[b]]
            held[:, place[a]] &= held[:, place[b]]
        into = np.arange(count)
        into[b] = a
        group = into[group]
        new = np.zeros(count, bool)
        new[a] = new[b] = True
        live = live[~np.isin(live, b)]
        ask = live[new[live] | new[mate[live]]]


def similar_groups(scored: DataFrame, least: float = 0.95, dims: int = 32, trees: int = 5) -> DataFrame:
    """``(rep_id, member_id, centrality)`` for each row of a group of at least two; ``rep_id`` is its smallest id.

    Only current rows with a vector of ``dims`` finite values, not all zero.
    All members of a group have a cosine of at least ``least`` with each
    other; ``centrality`` is the cosine with the group's centre. The groups of
    a component are those of Ward agglomeration of its rows (``_cones``),
    whatever its size: no two groups, or a group and a row without one, could
    be one group. A component of more than ``EXACT_ROWS`` rows that is a
    single group is known as such without being gathered (``_parted``), with
    the same result. Exact copies and scaled copies are members like others.
    Near leaves meet in a cell of one of the random cell sets but with a
    vanishing probability (``near_leaves``; measured recall: README). An empty
    table gives an empty result.
    """
    schema = "rep_id bigint, member_id bigint, centrality double"

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches):
            ids, unit = part.column(1).to_numpy(), _matrix(part.column(2).combine_chunks(), np.float32).astype(np.float64)
            yield from _members(ids, unit, _cones(unit, np.ones(len(unit)), acos(least - 1e-6)))

    rows = staged(leaf_rows(current_rows(scored, "embedding"), "score_id", least, dims), "leaves")
    leaves = rows.filter(F.col("id") == F.col("leaf"))
    pairs = staged(near_leaves(leaves, least, trees, dims), "ties")
    labels = component_labels(pairs)
    own = rows.join(labels.select(F.col("id").alias("leaf"), "label"), "leaf", "left").filter(F.col("label").isNotNull() | (F.col("n") > 1))
    own = staged(own.withColumn("label", F.coalesce("label", "leaf")).select("label", "id", "unit"), "members")
    large = staged(own.groupBy("label").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > EXACT_ROWS), "large")
    if not large.limit(1).count():
        return own.repartition("label").sortWithinPartitions("label", "id").mapInArrow(settle, schema)
    hot = own.join(large, "label")
    whole = staged(large.join(_parted(hot, least), "label", "left_anti"), "whole")
    found = own.join(whole, "label", "left_anti").repartition("label").sortWithinPartitions("label", "id").mapInArrow(settle, schema)
    return found.unionByName(_centred(hot.join(whole, "label", "left_semi").select(F.col("label").alias("gid"), "id", "unit")).select("rep_id", F.col("id").alias("member_id"), F.col("central").alias("centrality")))


def _members(ids: np.ndarray, unit: np.ndarray, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    sizes = np.bincount(group, minlength=len(ids))
    for g in np.flatnonzero(sizes > 1):
        rows = np.flatnonzero(group == g)
        centre = unit[rows].sum(0)
        central = unit[rows] @ (centre / np.linalg.norm(centre))
        rep = int(ids[rows].min())
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), rep, np.int64)), pa.array(ids[rows]), pa.array(central)], names=["rep_id", "member_id", "centrality"])


def _blocked(n: str, rows: int) -> Column:
    """The number of blocks of about so many rows."""
    return F.ceil(F.col(n) / rows).cast("int")


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(3)), blocks).cast("int")


def _parted(own: DataFrame, least: float) -> DataFrame:
    """``(label)`` of the components, of rows ``(label, id, unit, _n)``, in which two rows have a cosine below ``least``.

    Two rows whose angles to the centre add up to at most that of the cosine
    need no look; all other pairs are compared, in pairs of blocks.
    """
    angle = acos(least - 1e-6)

    def clash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches):
            unit = _matrix(part.column(3).combine_chunks(), np.float32).astype(np.float64)
            asked = part.column(4).to_numpy(zero_copy_only=False)
            x, y = unit[asked], unit[~asked]
            step = max(1, _HELD // max(1, len(y)))
            if any((x[a : a + step] @ y.T < least - 1e-6).any() for a in range(0, len(x), step)):
                yield pa.RecordBatch.from_arrays([part.column(1).combine_chunks()[:1]], names=["label"])

    rows = own.select(F.col("label").alias("gid"), "id", "unit")
    centred = _centred(rows).select(F.col("gid").alias("label"), "id", "unit", F.acos(F.least(F.col("central"), F.lit(1.0))).alias("_angle"))
    widest = centred.groupBy("label").agg(F.max("_angle").alias("_far"))
    state = staged(centred.join(widest, "label"), "angles")
    # a small angle is exact to some 5e-4 only, as the rows are of single precision
    refs, asked = state.filter(F.col("_angle") + F.col("_far") > angle - 2e-3), state.filter(F.col("_angle") > angle / 2 - 1e-3)
    size = refs.groupBy("label").agg(F.count(F.lit(1)).alias("_r")).join(asked.groupBy("label").agg(F.count(F.lit(1)).alias("_q")), "label")
    size = staged(size, "sizes")
    r, q = _blocked("_r", BLOCK_ROWS), _blocked("_q", BLOCK_ROWS)
    key = F.concat_ws("/", "label", "_i", "_j").alias("key")
    left = refs.join(size, "label").withColumn("_i", _block(r)).withColumn("_j", F.explode(F.sequence(F.lit(0), q - 1)))
    right = asked.join(size, "label").withColumn("_j", _block(q)).withColumn("_i", F.explode(F.sequence(F.lit(0), r - 1)))
    pairs = left.select(key, "label", "id", "unit", F.lit(False).alias("asked")).unionByName(right.select(key, "label", "id", "unit", F.lit(True).alias("asked")))
    return pairs.repartition("key").sortWithinPartitions("key", "id").mapInArrow(clash, "label bigint").distinct()


def _centred(rows: DataFrame) -> DataFrame:
    """Rows ``(gid, id, unit)`` of groups of any size with ``rep_id``, the smallest id of the group, and ``central``, the cosine to its centre."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gid, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            unit = _matrix(batch.column(2), np.float32).astype(np.float64)
            total, least = np.zeros((len(gid), unit.shape[1])), np.full(len(gid), np.iinfo(np.int64).max)
            np.add.at(total, at, unit)
            np.minimum.at(least, at, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(gid), pa.array(least), _bytes(total)], names=["gid", "rep", "total"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches):
            total = _matrix(part.column(2).combine_chunks(), np.float64).sum(0)
            mean = total / max(np.linalg.norm(total), 1e-12)
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks()[:1], pa.array([min(part.column(1).to_pylist())]), _bytes(mean[None])], names=["gid", "rep_id", "_mean"])

    def central(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, mean = _matrix(batch.column(3), np.float32).astype(np.float64), _matrix(batch.column(4), np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array((unit * mean).sum(1))], names=["gid", "rep_id", "id", "unit", "central"])

    partial = rows.mapInArrow(sums, "gid bigint, rep bigint, total binary")
    means = partial.repartition("gid").sortWithinPartitions("gid").mapInArrow(whole, "gid bigint, rep_id bigint, _mean binary")
    return rows.join(means, "gid").select("gid", "rep_id", "id", "unit", "_mean").mapInArrow(central, "gid bigint, rep_id bigint, id bigint, unit binary, central double")


def near_traces(scored: DataFrame) -> DataFrame:
    """``(rep_id, member_id)``: the members of each group but its smallest id."""
    return similar_groups(scored).filter(F.col("rep_id") != F.col("member_id")).select("rep_id", "member_id")


def group_profiles(scored: DataFrame, typical: int = 3) -> DataFrame:
    """Each group with its size and its most typical members: ``rep_id, n, typical`` (nearest to the centre first, then by id)."""
    rows = staged(similar_groups(scored), "groups")
    order = Window.partitionBy("rep_id").orderBy(F.round("centrality", 6).desc(), "member_id")
    first = rows.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= typical)
    nearest = first.groupBy("rep_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "member_id"))), lambda x: x["member_id"]).alias("typical"))
    return rows.groupBy("rep_id").agg(F.count(F.lit(1)).alias("n")).join(nearest, "rep_id")
