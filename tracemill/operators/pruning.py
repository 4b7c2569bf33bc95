"""Searching a trace backwards for the blocks its conclusion needs."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column

from tracemill.functions.blocks import form_similarity
from tracemill.functions.parsing import mapped
from tracemill.functions.text import OVERLAP_STOPWORDS, OVERLAP_TOKEN

Verdict = tuple[bool, bool]
_TOKEN = re.compile(OVERLAP_TOKEN)
_MATH = re.compile(r"[=<>]|\\frac|\\boxed|\\sum|\\sqrt|\d")
_STOP = frozenset(OVERLAP_STOPWORDS)


def overlap_tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(re.sub(r"\\[a-zA-Z]+", " ", text.lower()))) - _STOP


def verify_by_rule(target: str, supports: Sequence[str]) -> Verdict:
    """Whether the last of the supports is useful for the target, and whether all of them suffice.

    Useful: two tokens in common, mathematics in it, or a similar form. One
    useful support is always enough.
    """
    if not supports:
        return False, False
    candidate = supports[-1]
    useful = len(overlap_tokens(target) & overlap_tokens(candidate)) >= 2 or bool(_MATH.search(candidate)) or form_similarity(target, candidate) > 0.35
    return useful, useful


def needed_blocks(blocks: Sequence[str], verify: Callable[[str, Sequence[str]], Verdict] = verify_by_rule, alike: float = 0.8) -> tuple[list[int], int | None]:
    """The blocks that the last one depends on, and the block at which no support was found (or None).

    From each needed block the earlier ones are tried backwards until the
    supports suffice; one that has the form of the last support belongs to it
    without a question. Block 0 is a premise.
    """
    if not blocks:
        return [], None
    order = [len(blocks) - 1]
    needed = set(order)
    for target in order:
        if target == 0:
            continue
        own: list[int] = []
        enough = False
        for i in range(target - 1, -1, -1):
            if own and form_similarity(blocks[i], blocks[own[-1]]) > alike:
                useful = True
            else:
                useful, enough = verify(blocks[target], [blocks[j] for j in (*own, i)])
            if useful:
                own.append(i)
                if i not in needed:
                    needed.add(i)
                    order.append(i)
            if enough:
                break
        if not enough:
            return sorted(needed), target
    return sorted(needed), None


def sufficient_suffix(blocks: Sequence[str], judge: Callable[[str, str], Verdict], most_states: int = 128, most_blocks: int = 80) -> dict:
    """The shortest run of last blocks that a judge finds sufficient.

    The run grows backwards by a block as long as the added block is useful
    (the last block alone may be useless: it often only repeats the answer).
    ``judge(candidate, added)`` gives usefulness and sufficiency.
    """
    offset = max(0, len(blocks) - most_blocks)
    own = list(blocks[offset:])
    out = {"status": "no_blocks" if not own else "failed", "kept": [], "checked": 0, "best": 0}
    for size in range(1, min(len(own), most_states) + 1):
        start = len(own) - size
        useful, enough = judge("\n\n".join(own[start:]), own[start])
        out["checked"] = size
        if useful:
            out["best"] = size
        if enough:
            return out | {"status": "success", "kept": list(range(start + offset, len(own) + offset))}
        if not useful and size > 1:
            break
    return out


def answer_judge(answer: str) -> Callable[[str, str], Verdict]:
    """A judge without a model: a block with mathematics is useful, a run that holds the answer and two blocks suffices."""

    def judge(candidate: str, added: str) -> Verdict:
        return bool(_MATH.search(added)), bool(answer) and answer in candidate and "\n\n" in candidate

    return judge


def udf_needed(blocks: Column | str) -> Column:
    """``struct<kept, jump>`` of a column of blocks."""

    def run(own: list[str] | None) -> dict:
        kept, jump = needed_blocks([b for b in (own or [])])
        return {"kept": kept, "jump": jump}

    return mapped(run, "struct<kept: array<int>, jump: int>", blocks)


def udf_suffix(blocks: Column | str, answer: Column | str) -> Column:
    """The suffix search with the judge that knows the answer."""
    run = lambda own, a: sufficient_suffix(list(own or []), answer_judge(a or ""))
    return mapped(run, "struct<status: string, kept: array<int>, checked: int, best: int>", blocks, answer)
