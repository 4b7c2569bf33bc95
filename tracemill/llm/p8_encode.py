"""Problem 8: the token ids of every text by a public byte-level tokenizer."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.bpe import encoder, on_worker, shipped, vocabulary_path


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``(id_col, ids)`` of each row, ids without special tokens.

    A null or empty text gives an empty list; look-alikes of special tokens
    are plain text; repeated rows and null ids come out as they are; other
    columns are never read. No shuffle: one pass over the pruned scan, batches
    through Arrow. The cache of known pieces is bounded (``ByteBPE``).
    """
    path = shipped(docs.sparkSession, vocabulary or vocabulary_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(on_worker(path))
        for batch in batches:
            ids, ends = array("i"), [0]
            for text in batch.column(1).to_pylist():
                bpe.encode_into(text, ids)
                ends.append(len(ids))
            flat = np.frombuffer(ids, dtype=np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def count_tokens(docs: DataFrame, keep: list[str], text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of each row; null and empty texts have 0."""
    path = shipped(docs.sparkSession, vocabulary or vocabulary_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(on_worker(path))
        for batch in batches:
            counts = pa.array([bpe.count(text) for text in batch.column(batch.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], names=[*keep, "n_tokens"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{schema}, n_tokens bigint")
