"""Problem 10: the reading level of each document, by a latent difficulty model."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.sources.stage import staged

#: Words are hashed to so many buckets: the bound of everything that is collected or sent to the workers.
BUCKETS = 1 << 18
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")
_WORD = re.compile(r"[^\W\d_]+")
_CJK = re.compile(r"[㐀-鿿぀-ヿ]")
#: A stretch without a sentence end is taken in parts of so many words.
_PART = 25
#: A labelled document counts as so many others.
_LABEL_WEIGHT = 10.0
#: Prior of a word's spread: its variance in parts of the spread of all levels, and its weight in occurrences.
_PRIOR_VARIANCE, _PRIOR_WEIGHT = 1.0, 1.0
#: The fit stops when a round raises the log-likelihood by less than this part of it, at the latest after so many rounds.
_LEAST_GAIN, _ROUNDS = 0.01, 6


def _buckets(word: str, known: dict[str, list[int]]) -> list[int]:
    """The buckets of a word; of a run of ideographs those of its pairs."""
    parts = [word[i : i + 2] for i in range(max(1, len(word) - 1))] if _CJK.search(word) else [word]
    found = [crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]
    if len(word) <= 40:
        if len(known) >= 1 << 18:
            known.clear()
        known[word] = found
    return found


def segments(text: str, known: dict[str, list[int]]) -> tuple[list[int], list[int]]:
    """The buckets of the words of a text in order, and the number of them in each sentence."""
    out: list[int] = []
    sizes: list[int] = []
    for sentence in _SENTENCE.split(text.lower()):
        before = len(out)
        words = _WORD.findall(sentence)
        try:
            out.extend(chain.from_iterable(map(known.__getitem__, words)))
        except KeyError:
            del out[before:]
            for word in words:
                out.extend(known.get(word) or _buckets(word, known))
        n = len(out) - before
        while n > 2 * _PART:
            sizes.append(_PART)
            n -= _PART
        if n:
            sizes.append(n)
    return out, sizes


def bags(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep``, ``words, sizes`` of each text with at least one word: the buckets in order, and the words of each sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in batches:
            rows, words, sizes = [], [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if text:
                    own, n = segments(text, known)
                    if own:
                        rows.append(i)
                        words.append(np.array(own, np.int32))
                        sizes.append(np.array(n, np.int32))

            def lists(parts: list[np.ndarray]) -> pa.Array:
                ends = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))

            kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, lists(words), lists(sizes)], names=[*keep, "words", "sizes"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{kinds}, words array<int>, sizes array<int>")


class Difficulty:
    """Difficulty, slope and constant of each bucket under a population of levels N(mean, spread), and the scale of the levels.

    A word of difficulty m and variance v speaks for a level by
    ``sqrt(S / v) * exp(-a (level - m)^2 / 2)`` with the slope a = 1/v - 1/S,
    S being the spread of all levels: the nearer, the likelier, and a word
    that occurs at all levels alike says nothing.
    """

    def __init__(self, sums: np.ndarray, mean: float, spread: float, shift: float = 0.0, slope: float = 1.0) -> None:
        n, first, second = sums
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.where(n > 0, first / n, mean)
            variance = np.where(n > 0, np.maximum(second / n - own**2, 0.0), spread)
        variance = np.minimum((n * variance + _PRIOR_WEIGHT * _PRIOR_VARIANCE * spread) / (n + _PRIOR_WEIGHT), spread)
        self.mean, self.spread, self.variance = mean, spread, variance
        self.difficulty = own.astype(np.float32)
        self.weight = (1.0 / variance - 1.0 / spread).astype(np.float32)
        self.constant = (0.5 * np.log(spread / variance) - 0.5 * self.weight * own**2).astype(np.float32)
        self.shift, self.slope = shift, slope

    def prior(self) -> float:
        """The log of the prior of the variances."""
        v = self.variance[self.variance < self.spread * (1 - 1e-9)]
        top = np.log(self.spread) + _PRIOR_VARIANCE
        return float(-0.5 * _PRIOR_WEIGHT * (np.log(v) + _PRIOR_VARIANCE * self.spread / v - top).sum())

    def evidence(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each stretch of words that ends at ``ends``: the sums of slopes, of slopes by difficulty, and of constants."""
        starts = np.concatenate(([0], ends[:-1]))

        def total(x: np.ndarray) -> np.ndarray:
            run = np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))
            return run[ends] - run[starts]

        weight = self.weight[words]
        return total(weight), total(weight * self.difficulty[words]), total(self.constant[words])

    def posterior(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean and variance of each document's level given its words, and the log-likelihood of the words."""
        a, c, k = self.evidence(words, ends)
        precision, at = a + 1.0 / self.spread, c + self.mean / self.spread
        likelihood = k - 0.5 * np.log(self.spread * precision) + 0.5 * at**2 / precision - 0.5 * self.mean**2 / self.spread
        return at / precision, 1.0 / precision, likelihood

    def levels(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most likely level of each stretch of words that ends at ``ends``, on the scale of the labels, and the precision it has."""
        a, c, _ = self.evidence(words, ends)
        with np.errstate(divide="ignore", invalid="ignore"):
            level = np.where(a > 1e-6, c / a, np.nan)
        return self.shift + self.slope * level, a


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the ends of its lists."""
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)


def _word_sums(bags_: DataFrame, model: Difficulty | None) -> tuple[np.ndarray, float]:
    """Per bucket the occurrences, their expected levels and squared levels, and the log-likelihood; without a model by the labels in ``level``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, gained = np.zeros((3, BUCKETS)), 0.0
        for batch in batches:
            words, ends = _flat(batch.column(0))
            sizes = np.diff(np.concatenate(([0], ends)))
            if model is None:
                level, variance = batch.column(1).to_numpy(zero_copy_only=False), np.zeros(len(sizes))
            else:
                level, variance, likelihood = model.posterior(words, ends)
                gained += float(likelihood.sum())
            for i, value in enumerate((np.ones(len(sizes)), level, variance + level**2)):
                sums[i] += np.bincount(words, np.repeat(value, sizes), BUCKETS)
        at = np.flatnonzero(sums[0])
        made = [np.concatenate((s[at], [gained if i == 1 else 0.0])) for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), *map(pa.array, made)], names=["bucket", "n", "s1", "s2"])

    rows = bags_.select(*(["words", "level"] if model is None else ["words"])).mapInArrow(run, "bucket int, n double, s1 double, s2 double")
    table = rows.groupBy("bucket").agg(F.sum("n"), F.sum("s1"), F.sum("s2")).toArrow()  # at most BUCKETS + 1 rows
    at, (n, first, second) = table.column(0).to_numpy(), (table.column(i).to_numpy() for i in (1, 2, 3))
    sums = np.zeros((3, BUCKETS))
    sums[:, at[at >= 0]] = np.stack((n, first, second))[:, at >= 0]
    return sums, float(first[at < 0].sum())


def _scaled(labelled: DataFrame, model: Difficulty) -> Difficulty:
    """The model with the scale on which the labelled documents have their labels (least squares)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, _ = model.levels(*_flat(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(level), batch.column(1)], names=["x", "y"])

    fit = labelled.select("words", "level").mapInArrow(run, "x double, y double").filter(~F.isnan("x"))
    row = fit.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("shift")).first()
    if row["slope"] is not None and row["slope"] > 0:
        model.shift, model.slope = row["shift"], row["slope"]
    return model


def fit(bags_: DataFrame, labelled: DataFrame, rounds: int = _ROUNDS, history: list[float] | None = None) -> Difficulty | None:
    """Alternate between word difficulties and document levels by maximum likelihood; None without labels.

    Rasch-style, in the unfolding form: see ``Difficulty``. Given the words'
    parameters, the level of a document is Gaussian with the summed slopes as
    precision (one exact Newton step). Given the levels, with their variance,
    the best difficulty of a word is the mean level of its occurrences and the
    best variance theirs, under the prior. Labelled documents count
    ``_LABEL_WEIGHT`` times at their label besides. Each round can only raise
    the penalised log-likelihood (appended to ``history``); the fit stops when
    it gains less than ``_LEAST_GAIN``, at most after ``rounds``. The labels
    fix the scale; the last step is a least-squares fit of the levels to them.
    """
    anchor, _ = _word_sums(labelled, None)
    n = anchor[0].sum()
    if not n:
        return None
    mean = anchor[1].sum() / n
    spread = max(anchor[2].sum() / n - mean**2, 1e-3)
    anchor *= _LABEL_WEIGHT
    model, before = Difficulty(anchor, mean, spread), None
    for _ in range(rounds - 1):
        sums, gained = _word_sums(bags_, model)
        # the labelled documents at their labels, from the same sums that the words are estimated from
        fixed = (model.constant * anchor[0] + model.weight * (model.difficulty * anchor[1] - 0.5 * anchor[2])).sum()
        likelihood = gained + float(fixed) + model.prior()
        if history is not None:
            history.append(likelihood)
        if before is not None and likelihood - before < _LEAST_GAIN * abs(likelihood):
            break
        model, before = Difficulty(sums + anchor, mean, spread), likelihood
    return _scaled(labelled, model)


def estimate(bags_: DataFrame, model: Difficulty, keep: list[str]) -> DataFrame:
    """``keep``, ``level`` (mean over the words) and ``whole`` (the median over the words of their sentences' levels).

    The median is what the greater part of the text has: single words or
    sentences of another level don't move it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nk = len(keep)
            words, ends = _flat(batch.column(nk))
            sizes, parts = _flat(batch.column(nk + 1))
            level, _ = model.levels(words, ends)
            own, precision = model.levels(words, np.cumsum(sizes))
            whole = np.full(len(ends), np.nan)
            start = 0
            for i, end in enumerate(parts):
                x, w = own[start:end], np.where(precision[start:end] > 0.5, sizes[start:end], 0)
                start = end
                ok = ~np.isnan(x) & (w > 0)
                if ok.any():
                    order = np.argsort(x[ok], kind="stable")
                    total = np.cumsum(w[ok][order])
                    whole[i] = x[ok][order][np.searchsorted(total, total[-1] / 2)]
            kept = [batch.column(i) for i in range(nk)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(level, from_pandas=True), pa.array(whole, from_pandas=True)], names=[*keep, "level", "whole"])

    kinds = ", ".join(f"`{k}` {bags_.schema[k].dataType.simpleString()}" for k in keep)
    return bags_.select(*keep, "words", "sizes").mapInArrow(run, f"{kinds}, level double, whole double")


def cut_between(labelled: DataFrame, levels: DataFrame, model: Difficulty, upper: int = 4, bins: int = 500, slack: float = 0.005) -> float:
    """The value of ``whole`` that parts the labels from ``upper`` on from those below it.

    On histograms: of all cuts whose balanced error on the labelled documents
    is within ``slack`` of the least, the widest stretch, and in it the middle
    of the longest run of places that the fewest of all documents are near.
    Documents whose raters disagree about the side don't count.
    """
    known = estimate(labelled.withColumnRenamed("level", "label"), model, ["label"])
    clear = known.filter(F.col("whole").isNotNull() & (F.abs(F.col("label") - (upper - 0.5)) > 0.25))
    bin_ = F.least(F.greatest(F.floor(F.col("whole") / 5 * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = clear.groupBy(bin_.alias("bin"), (F.col("label") > upper - 0.5).cast("int").alias("kind")).count()
    every = levels.filter("whole IS NOT NULL").groupBy(bin_.alias("bin"), F.lit(2).alias("kind")).count()
    count = np.zeros((3, bins))
    for r in counted.unionByName(every).collect():  # at most 3 x bins rows
        count[r["kind"], r["bin"]] += r["count"]
    low, high, near = count
    if not high.sum():
        return float("inf")
    missed = np.concatenate(([0], np.cumsum(high))) / high.sum()
    wrong = (low.sum() - np.concatenate(([0], np.cumsum(low)))) / max(low.sum(), 1)
    error = missed + wrong

    def widest(places: np.ndarray) -> np.ndarray:
        return max(np.split(places, np.flatnonzero(np.diff(places) > 1) + 1), key=len)

    good = widest(np.flatnonzero(error <= error.min() + slack))
    density = np.convolve(np.concatenate(([0.0], near, [0.0])), np.ones(2), "valid")[good]
    best = good[widest(np.flatnonzero(density == density.min()))]
    return float((best[0] + best[-1]) / 2 / bins * 5)


def _prepared(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    own = staged(bags(docs, keep, text_col), "bags")
    marks = labels.filter(F.col("level").between(1, 4) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg("level").alias("level"))
    return own, staged(own.select(F.col(id_col).alias("_id"), "words", "sizes").join(marks, "_id"), "labelled")


def reading_levels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id_col, *keep, level, whole, top)`` of each text with a word: mean and median reading level, and whether it is of level 4 as a whole.

    Null, empty and white-space texts and texts without any letter are left
    out; repeated texts and rows count each. Without labels both levels are
    null and ``top`` is false. Several raters of a document are averaged;
    labels outside 1 to 4 are ignored.
    """
    columns = [id_col, *keep]
    own, labelled = _prepared(docs, labels, id_col, text_col, columns)
    model = fit(own, labelled)
    if model is None:
        return own.select(*columns, F.lit(None).cast("double").alias("level"), F.lit(None).cast("double").alias("whole"), F.lit(False).alias("top"))
    levels = staged(estimate(own, model, columns), "levels")
    return levels.withColumn("top", F.coalesce(F.col("whole") >= cut_between(labelled, levels, model), F.lit(False)))


def top_level(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are of level 4 as a whole: ``(doc_id)``."""
    return reading_levels(docs, labels).filter("top").select("doc_id")


def level_profile(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How many documents each source has at each rounded level: ``source, reading_level, n``; repeated rows count each."""
    levels = reading_levels(docs, labels, keep=("source",)).filter(F.col("whole").isNotNull())
    rounded = F.least(F.greatest(F.round("whole"), F.lit(1.0)), F.lit(4.0)).cast("int").alias("reading_level")
    return levels.groupBy("source", rounded).agg(F.count(F.lit(1)).alias("n"))
