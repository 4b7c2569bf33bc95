"""Searches over the blocks of many traces that ask a model in rounds.

The state of every open search is a row. A round turns all open states into
one table of requests, asks them together, writes the replies, and moves every
state on; finished searches leave. So the model is asked in batches, a lost
round is repeated from the table before it, and a search of a thousand traces
takes as many rounds as its longest one.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.blocks import udf_similarity
from tracemill.functions.text import coerce_bool
from tracemill.operators import prompts
from tracemill.operators.model_calls import Backend, ask
from tracemill.operators.pruning import answer_judge, verify_by_rule
from tracemill.sources.stage import staged

_SEP = "\n\n"


def _numbered(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows with an ``id`` of their own, so that repeated keys stay apart; written, so that the ids stay as they are."""
    return staged(rows.select(F.monotonically_increasing_id().cast("string").alias("id"), *columns), "traces")


def _verdicts(requests: DataFrame, backend: Backend, kind: str) -> DataFrame:
    """``id, useful, enough, failed``; a reply without verdict counts as neither."""
    said = prompts.replies(ask(requests, backend, name=kind), kind)
    return said.select(F.col("key").alias("id"), coerce_bool("value.useful").alias("useful"), coerce_bool("value.sufficient").alias("enough"), F.col("error").isNotNull().alias("failed"))


def suffix_rounds(rows: DataFrame, backend: Backend, most_states: int = 128, most_blocks: int = 80) -> DataFrame:
    """``key, status, checked, best, kept``: the shortest run of last blocks that the model finds sufficient, of each ``(key, blocks, question, answer)``.

    The run grows by a block a round, as long as the added block is useful
    (the last block alone may be useless). ``status``: ``success``,
    ``failed``, ``no_blocks``; ``best``: the longest run with a useful block.
    Only the last ``most_blocks`` blocks and ``most_states`` runs are tried.
    A failed call counts as neither useful nor sufficient. Rows with the same
    key are searched each.
    """
    n = F.coalesce(F.size("blocks"), F.lit(0))
    state = _numbered(rows, "key", "blocks", "question", "answer").select("id", "key", "blocks", "question", "answer", n.alias("n"), F.lit(0).alias("best"), F.lit(False).alias("won"), (n == 0).alias("over"))
    done, size = state.filter("over").withColumn("checked", F.lit(0)), 0
    state = state.filter("NOT over")
    while state.limit(1).count():
        size += 1
        candidate = F.slice("blocks", F.col("n") - size + 1, size)
        asked = prompts.requests(state, "sufficient", "id", question=F.col("question"), answer=F.col("answer"), added=F.get(candidate, F.lit(0)), candidate=F.array_join(candidate, _SEP))
        judged = state.join(_verdicts(asked, backend, "sufficient"), "id")
        last = (F.least("n", F.lit(most_blocks), F.lit(most_states)) <= size) | (~F.col("useful") & F.lit(size > 1))
        moved = judged.select("id", "key", "blocks", "question", "answer", "n", F.when(F.col("useful"), size).otherwise(F.col("best")).alias("best"), F.col("enough").alias("won"), (F.col("enough") | last).alias("over"))
        moved = staged(moved, "suffix")
        done = done.unionByName(moved.filter("over").withColumn("checked", F.lit(size)))
        state = moved.filter("NOT over")
    status = F.when(F.col("n") == 0, "no_blocks").when(F.col("won"), "success").otherwise("failed")
    kept = F.when(F.col("won"), F.sequence(F.col("n") - F.col("checked"), F.col("n") - 1)).otherwise(F.array().cast("array<int>"))
    return done.select("key", status.alias("status"), "checked", "best", kept.alias("kept"))


def _block(i: Column) -> Column:
    return F.get("blocks", i)


def backward_rounds(rows: DataFrame, backend: Backend, alike: float = 0.8) -> DataFrame:
    """``key, kept, jump``: the blocks that the last one depends on, of each ``(key, blocks)``, and the block for which no support was found.

    State: the block in question, the supports found for it, the next earlier
    block to try, and the queue of needed blocks. A block with the form of the
    latest support belongs to it without a question; others are asked about.
    Block 0 is a premise. Rows with the same key are searched each; texts
    without blocks give nothing.
    """
    ints = F.array().cast("array<int>")
    start = _numbered(rows.filter(F.size("blocks") > 0), "key", "blocks").select("id", "key", "blocks", F.array(F.size("blocks") - 1).alias("queue"), F.lit(0).alias("at"), ints.alias("own"), (F.size("blocks") - 2).alias("i"), F.lit(None).cast("int").alias("jump"))
    over = (F.col("at") >= F.size("queue")) | F.col("jump").isNotNull()
    target = F.get("queue", F.col("at"))
    state, done = staged(_settled(start), "backward"), None
    while True:
        closed = state.filter(over)
        done = closed if done is None else done.unionByName(closed)
        open_ = state.filter(~over)
        if not open_.limit(1).count():
            return done.select("key", F.array_sort("queue").alias("kept"), "jump")
        near = F.coalesce(udf_similarity(_block(F.col("i")), _block(F.try_element_at("own", F.lit(-1)))) > alike, F.lit(False)) & (F.size("own") > 0)
        open_ = staged(open_.withColumn("near", near), "near")
        tried = F.concat("own", F.array("i"))
        asked = prompts.requests(open_.filter("NOT near"), "depends", "id", target=_block(target), candidate=F.array_join(F.transform(tried, _block), _SEP))
        judged = open_.join(_verdicts(asked, backend, "depends"), "id", "left")
        useful, enough = F.col("near") | F.coalesce("useful", F.lit(False)), ~F.col("near") & F.coalesce("enough", F.lit(False))
        queue = F.when(useful & ~F.array_contains("queue", F.col("i")), F.concat("queue", F.array("i"))).otherwise(F.col("queue"))
        own = F.when(useful, tried).otherwise(F.col("own"))
        moved = judged.select("id", "key", "blocks", queue.alias("queue"), "at", own.alias("own"), "i", "jump", enough.alias("enough"))
        # the next earlier block; if there is none left, no support was found
        next_ = moved.select(
            "id", "key", "blocks", "queue", F.when(F.col("enough"), F.col("at") + 1).otherwise(F.col("at")).alias("at"), F.when(F.col("enough"), ints).otherwise(F.col("own")).alias("own"),
            F.when(F.col("enough"), F.get("queue", F.col("at") + 1) - 1).otherwise(F.col("i") - 1).alias("i"), F.when(~F.col("enough") & (F.col("i") == 0), F.get("queue", F.col("at"))).alias("jump"),
        )
        state = staged(_settled(next_), "backward")


def _settled(state: DataFrame) -> DataFrame:
    """Block 0 needs no support: where it is next, the search goes on to the one after it (it is in the queue only once)."""
    first = F.coalesce(F.get("queue", F.col("at")) == 0, F.lit(False)) & F.col("jump").isNull()
    at = F.when(first, F.col("at") + 1).otherwise(F.col("at"))
    return state.select("id", "key", "blocks", "queue", at.alias("at"), "own", F.when(first, F.get("queue", F.col("at") + 1) - 1).otherwise(F.col("i")).alias("i"), "jump")


_PARTS = {"sufficient": re.compile(r"Result: (.*?)\n\nNew block:\n(.*?)\n\nBlocks so far, the new one first:\n(.*)\n\nIs the new block", re.S), "depends": re.compile(r"Statement:\n(.*?)\n\nEarlier blocks:\n(.*)\n\nDoes the statement", re.S)}


def rule_model(prompt: str, kind: str) -> str:
    """A model that follows the offline rules, for tests and dry runs: it reads the prompt and answers as the step demands."""
    parts = _PARTS[kind].search(prompt).groups()
    if kind == "sufficient":
        useful, enough = answer_judge(parts[0])(parts[2], parts[1])
    else:
        useful, enough = verify_by_rule(parts[0], parts[1].split(_SEP))
    return json.dumps({"useful": useful, "sufficient": enough})
