"""Search for a set of phrases in all texts, by one automaton that reads each text once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


@lru_cache(maxsize=2)
def _automaton(phrases: tuple[tuple[object, str], ...]) -> ahocorasick.Automaton:
    """All phrases with their ids; built once per worker process."""
    ids: dict[str, list] = defaultdict(list)
    for key, phrase in phrases:
        ids[phrase].append(key)
    out = ahocorasick.Automaton()
    for phrase, own in ids.items():
        out.add_word(phrase, own)
    out.make_automaton()
    return out


def phrase_hits(rows: DataFrame, phrases: DataFrame, key: str, text: str, phrase: str, phrase_id: str, chars_at_once: int = 8_000_000) -> DataFrame:
    """``(key, phrase_id)`` where the text has the phrase in it as it is, once for each pair.

    The phrases are a stated query set. They go to the workers in parts of
    about ``chars_at_once`` characters (by a hash of their id), so the memory
    of a worker is bounded; a larger set takes as many scans. Null and empty
    phrases match nothing, null texts have none. The rows never move.
    """
    own = phrases.select(F.col(phrase_id).alias("id"), F.col(phrase).cast("string").alias("p")).filter("p <> ''")
    passes = max(1, -(-int(own.agg(F.coalesce(F.sum(F.length("p")), F.lit(0))).first()[0]) // chars_at_once))
    kinds = [rows.schema[key].dataType, phrases.schema[phrase_id].dataType]
    schema, id_type = f"`{key}` {kinds[0].simpleString()}, `{phrase_id}` {kinds[1].simpleString()}", to_arrow_type(kinds[1])
    texts = rows.select(F.col(key), F.col(text).cast("string").alias("_text"))
    found = None
    for i in range(passes):
        part = tuple(sorted((tuple(r) for r in (own if passes == 1 else own.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == i)).collect()), key=repr))  # a bounded part of the query set
        hits = texts.mapInArrow(_search(part, [key, phrase_id], id_type), schema)
        found = hits if found is None else found.unionByName(hits)
    return found


def _search(part: tuple, names: list[str], id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(part) if part else None
        for batch in batches if automaton else ():
            at, ids = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    own = dict.fromkeys(x for _, found in automaton.iter(text) for x in found)
                    at += [i] * len(own)
                    ids += own
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(ids, id_type)], names=names)

    return run
