"""Problem 2: the share of repeated content inside one text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_POINTS = 0x110000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it belongs to a word, and a random value that lower and upper case share."""
    points = np.arange(_POINTS, dtype=np.uint32)
    points[0xD800:0xE000] = 0
    chars = points.view("<U1")
    alnum = np.char.isalnum(chars)
    lower = points.copy()
    cased = np.flatnonzero(alnum & (np.char.isupper(chars) | np.char.istitle(chars)))
    low = [chr(p).lower() for p in cased.tolist()]
    single = np.array([len(c) == 1 for c in low])
    lower[cased[single]] = [ord(c) for c in low if len(c) == 1]
    return alnum, _mixed(lower.astype(np.uint64) * _ODD + np.uint64(1))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _ODD, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The rolling hash of each range of ``values``: difference of prefix sums, shifted to exponent 0."""
    size = 1 << max(10, int(len(values)).bit_length())
    up, down = _powers(size)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return _mixed((prefix[ends] - prefix[starts]) * down[starts] + _ODD * (ends - starts).astype(np.uint64))


def _later(keys: np.ndarray) -> np.ndarray:
    """Which elements have an equal one before them."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = ordered[1:] == ordered[:-1]
    return again


def _covered(hits: np.ndarray, n: int, span: int) -> np.ndarray:
    """Which of ``n`` positions lie in a stretch of ``span`` beginning at a hit."""
    edge = np.zeros(n + span + 1, np.int32)
    edge[hits] += 1
    edge[hits + span] -= 1
    return np.cumsum(edge[:n]) > 0


def repetition_measures(texts: list[str], sizes: tuple[int, ...]) -> dict[str, np.ndarray]:
    """For each text: words, the words in repeated stretches of each size, their characters, and repeated lines.

    A word is a longest run of letters and digits, case ignored. A stretch of
    ``n`` words is repeated if the same words occurred before it, beginning
    earlier, in the same text.
    """
    alnum, value = _classes()
    sep = "\n\x00\n"
    points = np.frombuffer(sep.join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.zeros(len(texts), np.int64)
    np.cumsum(lengths[:-1] + len(sep), out=begin[1:])
    inside = alnum[points]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edges[0::2], edges[1::2]
    owner = np.searchsorted(begin, starts, side="right") - 1
    words = _rolled(value[points], starts, ends)
    n_words = np.bincount(owner, minlength=len(texts))
    out = {"n_words": n_words, "n_chars": np.bincount(owner, weights=ends - starts, minlength=len(texts)).astype(np.int64)}
    salt = _mixed(owner.astype(np.uint64) + _ODD)
    at = np.arange(len(words))
    for n in sizes:
        if len(words) >= n:
            first = at[: len(words) - n + 1]
            first = first[owner[first] == owner[first + n - 1]]
            hashes = _rolled(words, first, first + n) ^ salt[first]
            hit = _covered(first[_later(hashes)], len(words), n)
        else:
            hit = np.zeros(len(words), bool)
        out[f"words_{n}"] = np.bincount(owner[hit], minlength=len(texts))
        out[f"chars_{n}"] = np.bincount(owner[hit], weights=(ends - starts)[hit], minlength=len(texts)).astype(np.int64)
    breaks = np.flatnonzero(points == 10)
    line_start = np.concatenate(([0], breaks + 1))
    line_of = np.searchsorted(line_start, starts, side="right") - 1
    first_word = np.flatnonzero(np.diff(np.concatenate(([-1], line_of))))
    last_word = np.concatenate((first_word[1:], [len(words)])) if len(first_word) else first_word
    line_hash = _rolled(words, first_word, last_word) ^ salt[first_word]
    again = _later(line_hash)
    line_owner = owner[first_word] if len(first_word) else first_word
    out["n_lines"] = np.bincount(line_owner, minlength=len(texts))
    out["lines_repeated"] = np.bincount(line_owner[again], minlength=len(texts))
    return out


def _batches(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    at = used = 0
    for i, t in enumerate(texts):
        used += len(t)
        if used >= chars:
            yield at, i + 1
            at, used = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def text_repetition(texts: DataFrame, keys: list[str], text_col: str, sizes: tuple[int, ...] = (3, 6, 12), chars_at_once: int = 1 << 20) -> DataFrame:
    """Repetition of each text: ``keys``, ``n_words``, ``n_chars``, ``words_n`` and ``chars_n`` for each size, ``n_lines``, ``lines_repeated``.

    A null text counts as an empty one: all measures are 0. Characters are
    those of words. A very long text is handled as a whole, in a batch of its
    own. Repeated rows and null keys are kept. No shuffle.
    """
    fields = ["n_words", "n_chars", *(f"{k}_{n}" for n in sizes for k in ("words", "chars")), "n_lines", "lines_repeated"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            parts = [repetition_measures(own[a:b], sizes) for a, b in _batches(own, chars_at_once)]
            columns = [pa.array(np.concatenate([p[f] for p in parts]) if parts else [], pa.int64()) for f in fields]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keys, *fields])

    schema = ", ".join([*(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys), *(f"{f} bigint" for f in fields)])
    return texts.select(*keys, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def generations(problems: DataFrame, *keep: str) -> DataFrame:
    """One row per entry of ``generations``: ``keep``, ``gen_pos`` from 0, ``text``; null and empty arrays give none."""
    return problems.select(*keep, F.posexplode("generations").alias("gen_pos", "text"))


def repeated_generations(problems: DataFrame, span: int = 6, share: float = 0.3) -> DataFrame:
    """The generations in which at least ``share`` of the words lie in repeated stretches of ``span`` words: ``(row_id, gen_pos)``."""
    spread = generations(problems, "row_id")
    measured = text_repetition(spread, ["row_id", "gen_pos"], "text", (span,))
    hit = (F.col("n_words") > 0) & (F.col(f"words_{span}") / F.col("n_words") >= share)
    return measured.filter(hit).select("row_id", "gen_pos")
