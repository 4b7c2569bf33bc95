"""Problem 6: evaluation texts inside training texts, by Wu-Manber search over words."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word is a longest run of letters and digits.
_WORDS = re.compile(r"[^\W_]+")
#: Patterns are searched in classes of similar length, so that a very short one doesn't spoil the shifts of the long ones.
_CLASSES = ((1, 1), (2, 2), (3, 5), (6, 11), (12, 1 << 30))


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


class WuManber:
    """Search for many word sequences at once.

    A window as long as the shortest pattern slides over the text. The block
    of words at its end gives the shift: the distance to the nearest place
    any pattern has this block, or past the block if none has. At shift 0 the
    bucket of that suffix block holds the candidate patterns, of which those
    with the right first word are compared directly.
    """

    def __init__(self, patterns: dict[tuple[str, ...], list]) -> None:
        self.window = min(map(len, patterns))
        self.block = min(2, self.window)
        self.default = self.window - self.block + 1
        self.shift: dict[tuple[str, ...], int] = {}
        self.buckets: dict[tuple[str, ...], dict[str, list]] = defaultdict(lambda: defaultdict(list))
        for pattern, found in patterns.items():
            for end in range(self.block, self.window + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.default), self.window - end)
            self.buckets[pattern[self.window - self.block : self.window]][pattern[0]].append((pattern, found))

    def search(self, text: list[str]) -> set:
        out: set = set()
        end, n, window, block, shift, default = self.window, len(text), self.window, self.block, self.shift, self.default
        while end <= n:
            key = tuple(text[end - block : end])
            step = shift.get(key, default)
            if step:
                end += step
                continue
            start = end - window
            for pattern, found in self.buckets[key].get(text[start], ()):
                if tuple(text[start : start + len(pattern)]) == pattern:
                    out.update(found)
            end += 1
        return out


def searchers(items: list[tuple[object, str | None]], span: int) -> list[WuManber]:
    """A search per length class for all stretches of ``span`` words of the items, and for the whole of shorter ones."""
    classes: dict[tuple[int, int], dict[tuple[str, ...], list]] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        own = words(text)
        if not own:
            continue
        size = min(span, len(own))
        kind = next(c for c in _CLASSES if c[0] <= size <= c[1])
        for pattern in {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}:
            classes[kind][pattern].append(item)
    return [WuManber(patterns) for patterns in classes.values()]


@lru_cache(maxsize=2)
def _kept_searchers(items: tuple[tuple[object, str | None], ...], span: int) -> list[WuManber]:
    """The search tables, built once per worker process and not for every task."""
    return searchers(list(items), span)


def leaked_items(
    corpus: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str = "item_id", item_text: str = "problem", span: int = 12, words_at_once: int = 2_000_000
) -> DataFrame:
    """``(id_col, item_id)`` for each text with at least ``span`` consecutive words of an item, or all words of a shorter one.

    Case, punctuation and spacing don't count. Null and empty texts have no
    match, items without a word give no pattern. Repeated rows are reported
    each. The corpus is only scanned, never shuffled. The items are the stated
    query set: the search tables of at most ``words_at_once`` pattern words go
    to the workers at a time, a larger set is searched in as many passes.
    """
    listed = items.select(F.col(item_id), F.col(item_text).cast("string").alias("_t"))
    # a word and its separator take two characters at least; each word opens at most one pattern of `span` words
    bound = listed.agg(F.coalesce(F.sum((F.length("_t") + 1) / 2), F.lit(0.0)).alias("n")).first()["n"] * span
    passes = max(1, -(-int(bound) // words_at_once))
    kinds = {id_col: corpus.schema[id_col].dataType.simpleString(), item_id: items.schema[item_id].dataType.simpleString()}
    schema = f"`{id_col}` {kinds[id_col]}, `{item_id}` {kinds[item_id]}"
    texts = corpus.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    found = None
    for i in range(passes):
        own = [tuple(r) for r in listed.filter(F.pmod(F.xxhash64(item_id), F.lit(passes)) == i).collect()]  # the query set, a bounded part at a time
        hits = texts.mapInArrow(_search(own, span, id_col, item_id, items.schema[item_id].dataType.simpleString()), schema)
        found = hits if found is None else found.unionByName(hits)
    return found


def _search(own: list, span: int, id_col: str, item_id: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _kept_searchers(tuple(own), span)
        item_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
        for batch in batches:
            rows, hits = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = words(text)
                for found in sorted(set().union(*(t.search(tokens) for t in tables)) if tokens else ()):
                    rows.append(i)
                    hits.append(found)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(hits, item_type)], names=[id_col, item_id])

    return run


def leak_report(problems: DataFrame, items: DataFrame) -> DataFrame:
    """Per item with a leak the number of records that contain it: ``(item_id, n_records)``."""
    return leaked_items(problems, items, "row_id", "problem").groupBy("item_id").agg(F.countDistinct("row_id").alias("n_records"))
