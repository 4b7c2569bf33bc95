"""Problem 4: defects of instruction-response pairs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.endings import DANGLING, concluded, open_at_end, open_structures, terminated, without_mark, without_tags
from tracemill.llm.languages import Languages, fitted
from tracemill.llm.refusals import declines

DEFECTS = ("empty_answer", "refusal", "copied_question", "truncated", "wrong_language")

# --- empty -------------------------------------------------------------------

_MARKUP = re.compile(r"</?[a-zA-Z][^<>]{0,80}>|\\(?:boxed|text|mathrm|mathbf|fbox)\b|```\w*|&nbsp;")
_WORD = re.compile(r"[^\W_]+")
#: Placeholders that say nothing.
_PLACEHOLDERS = {"na", "null", "nan", "nil", "tbd", "todo", "tba", "placeholder", "undefined", "empty", "blank", "noanswer", "answerhere", "keineantwort", "pasderéponse", "sinrespuesta", "无", "暂无"}


def is_empty(text: str | None) -> bool:
    """Null, or nothing left besides space, empty markup, punctuation or a placeholder; a lone symbol such as an infinity sign is an answer."""
    if text is None:
        return True
    bare = _MARKUP.sub("", text)
    if sum(1 for _ in islice(_WORD.finditer(bare), 5)) == 5:
        return False  # five words say something
    kept = [c for c in bare if c.isalnum() or (unicodedata.category(c) == "Sm" and c not in "+-=<>|~−±")]
    return not kept or "".join(kept).casefold() in _PLACEHOLDERS


# --- words and sentences -------------------------------------------------------

_TOKENS = re.compile(r"[぀-ヿ一-鿿]|[^\W_぀-ヿ一-鿿]+")
_SIGNED = re.compile(r"[^\W_]+|[-+*/=<>^|!%\\√−×÷·]")
_SENTENCES = re.compile(r"(?<=[.!?。！？])\s+|(?<=[。！？])|\n+")
_THINK = re.compile(r"</?think(?:ing)?>", re.I)


def tokens(text: str) -> list[str]:
    return _TOKENS.findall(text.casefold())


# --- copied question -----------------------------------------------------------


def matches(text: list[str], pattern: list[str]) -> list[int]:
    """For each position of ``text`` the length of the longest stretch from there that ``pattern`` has too, in linear time.

    A suffix automaton of the reversed pattern reads the text from its end.
    """
    link, length, step = [-1], [0], [{}]
    last = 0
    for token in reversed(pattern):
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        at = last
        while at >= 0 and token not in step[at]:
            step[at][token] = new
            at = link[at]
        if at >= 0:
            to = step[at][token]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(length)
                length.append(length[at] + 1)
                link.append(link[to])
                step.append(dict(step[to]))
                while at >= 0 and step[at].get(token) == to:
                    step[at][token] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    out = [0] * len(text)
    at = n = 0
    for i in range(len(text) - 1, -1, -1):
        token = text[i]
        while at and token not in step[at]:
            at = link[at]
            n = length[at]
        if token in step[at]:
            at = step[at][token]
            n += 1
        out[i] = n
    return out


def tiles(text: list[str], pattern: list[str], least: int = 3) -> list[bool]:
    """Greedy string tiling: which tokens of ``text`` lie in a tile shared with ``pattern``.

    The longest common stretch that is still free becomes a tile (the first of
    equals), until none of ``least`` tokens is left. A text may give the
    pattern, or a part of it, back more than once.
    """
    taken = [False] * len(text)
    heap = [(-n, i) for i, n in enumerate(matches(text, pattern)) if n >= least]
    heapify(heap)
    while heap:
        n, i = heappop(heap)
        n = -n
        if taken[i]:
            continue
        free = next((k for k in range(n) if taken[i + k]), n)
        if free < n:
            if free >= least:
                heappush(heap, (-free, i))
            continue
        taken[i : i + n] = [True] * n
    return taken


def is_copy(text: str, instruction: str, share: float = 0.75) -> bool:
    """Whether the text is the instruction again, framed or slightly changed, and nothing else."""
    own, asked = tokens(text), tokens(instruction)
    if not own or not asked:
        return False
    if len(own) < 4 or len(asked) < 4:
        # too short for tiles: the instruction once or more and nothing else, its signs included
        own, asked = (_SIGNED.findall(_THINK.sub(" ", t.casefold())) for t in (text, instruction))
        return bool(own and asked) and own == asked * (len(own) // len(asked))
    known = set(asked)
    if sum(t in known for t in own) < share * len(own):
        return False
    taken = tiles(own, asked)
    free = [t for t, x in zip(own, taken, strict=True) if not x]
    new = [t for t in free if t not in known]
    return sum(taken) >= share * len(own) and len(free) <= max(4, len(own) // 4) and not (new and new[-1] == own[-1] and new[-1].isdigit())


# --- refusal -------------------------------------------------------------------

_SOLVED = re.compile(r"\\boxed\{[^}]|\d\s*[.$}]*\s*$")


def is_refusal(text: str, instruction: str) -> bool:
    """Whether the text declines instead of answering.

    A sentence of the form of a refusal (``refusals``) must be there, and
    besides it nothing but courtesies (sentences without any number or
    formula, at most 14 words) and the instruction given back.
    """
    sentences = [s for s in _SENTENCES.split(_THINK.sub("\n", text)) if s and s.strip()]
    declined = [declines(s) for s in sentences]
    if not any(declined):
        return False
    asked = tokens(instruction)
    rest = 0
    for s, no in zip(sentences, declined, strict=True):
        own = tokens(s)
        figures = any(c.isdigit() for c in s)
        if no:
            if figures and len(own) > 20 and not any(tiles(own, asked)):
                rest += len(own)
        elif figures or "\\" in s or len(own) > 14:
            shared = sum(tiles(own, asked))
            if shared < 0.6 * len(own) and len(own) > 3:
                rest += len(own) - shared
            elif len(own) <= 3 and _SOLVED.search(s):
                rest += 100
        if rest > 6:
            return False
    return True


# --- truncated -----------------------------------------------------------------

_HANGING = re.compile(r"(?:[=+*/,:;(^_&<>≤≥≈·×÷\-−]|\\(?:frac|sqrt|cdot|times|pm|left|d?frac\{[^{}]*\}|sqrt\[[^\]]*\])|\\[a-z]*)\s*$|等于\s*$|是\s*$|为\s*$")
_NOTHING = re.compile(r"\b(?:no|not|none|never|nobody|kein\w*|nicht|aucun\w*|pas|ningun\w*|ningún|no existe\w*)\b|无解|不存在", re.I)


def is_cut_answer(text: str) -> bool:
    """Whether a short answer stops inside a word, sentence or formula; a bare value is complete."""
    bare, marked = without_mark(text)
    if marked and bare and not terminated(bare):
        return True
    if open_structures(bare) or _HANGING.search(bare):
        return True
    if terminated(bare):
        return False
    own = re.findall(r"[^\W\d_]+", re.sub(r"\\[a-zA-Z]+", " ", bare))
    if own and own[-1].lower() in DANGLING and (len(own) > 1 and len(own[-1]) > 1):
        return True
    if re.search(r"[぀-ヿ一-鿿]", bare):
        return False
    return len(own) >= 4 and own[0][:1].isupper() and not concluded(bare) and not _NOTHING.search(bare)


def is_cut_output(text: str) -> bool:
    """Whether a response stops inside a word, sentence or formula; one that ends with its conclusion is complete."""
    bare, marked = without_mark(text)
    inner = without_tags(bare)
    if not inner or concluded(inner):
        return False
    if marked and not terminated(inner):
        return True
    if [s for s in open_at_end(inner) if s[0] != "<"]:
        return True
    if len(tokens(inner)) <= 6:
        return is_cut_answer(inner)
    return not terminated(inner)


# --- language ------------------------------------------------------------------


def is_other_language(text: str, instruction: str, languages: Languages, share: float = 0.8) -> bool:
    """Whether nearly all of the text is in one language and the instruction in another."""
    found = languages.shares(text)
    if not found:
        return False
    lang = max(found, key=found.get)
    if found[lang] < share * sum(found.values()):
        return False
    asked = languages.of(instruction)
    return asked is not None and lang != asked


# --- operator ------------------------------------------------------------------


def defect(text: str | None, instruction: str | None, short: bool, languages: Languages) -> str | None:
    """The defect of one field, or None; the first that applies in the order of ``DEFECTS``."""
    if is_empty(text):
        return "empty_answer"
    asked = instruction or ""
    if is_refusal(text, asked):
        return "refusal"
    if is_copy(text, asked):
        return "copied_question"
    if is_cut_answer(text) if short else is_cut_output(text):
        return "truncated"
    return "wrong_language" if is_other_language(text, asked, languages) else None


def defects(selected: DataFrame, docs: DataFrame) -> DataFrame:
    """``(selected_id, field, defect)`` for each defective ``output`` or ``answer`` of the rows with status ``ok``.

    A null field is empty. With a null or blank instruction a field can be
    neither a copy nor in another language. Repeated rows are reported each.
    The languages are learnt from a bounded sample of the labelled ``docs``
    (``languages.fitted``). One pass, no shuffle; texts are read as a whole.
    """
    languages = fitted(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, fields, found = [], [], []
            asked = batch.column(1).to_pylist()
            for column, field, short in ((2, "output", False), (3, "answer", True)):
                for i, text in enumerate(batch.column(column).to_pylist()):
                    if d := defect(text, asked[i], short, languages):
                        rows.append(i)
                        fields.append(field)
                        found.append(d)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(fields, pa.string()), pa.array(found, pa.string())], names=["selected_id", "field", "defect"])

    rows = selected.filter(F.col("status") == "ok").select("selected_id", "instruction", "output", "answer")
    return rows.mapInArrow(run, "selected_id bigint, field string, defect string")


def defect_counts(selected: DataFrame, docs: DataFrame) -> DataFrame:
    """How often each field has each defect: ``field, defect, n``."""
    return defects(selected, docs).groupBy("field", "defect").agg(F.count(F.lit(1)).alias("n"))
