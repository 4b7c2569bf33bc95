"""Cutting a trace into blocks.

All ways of cutting are made of the same parts: pieces of the text, a mark for
each piece whether a block begins with it, and one joining of the pieces from
beginning to beginning. White space is ASCII white space, as in ``text``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from difflib import SequenceMatcher
from itertools import pairwise

import numpy as np
from pyspark.sql import Column

from tracemill.functions.parsing import mapped
from tracemill.functions.text import BLOCK_OPENERS, SENTENCE_END, WHITE

_SPACE = f"[{WHITE}]"
_SENTENCE = re.compile(SENTENCE_END)
_OPENER = re.compile("|".join(BLOCK_OPENERS), re.ASCII)
_THINK = re.compile("</?think>", re.I)
_PARAGRAPH = re.compile(rf"\n{_SPACE}*\n+")
#: Where a logic block begins besides blank lines, and what ends a part of a long one.
_STEP = rf"\n?{_SPACE}*(?:Step|步骤){_SPACE}*[0-9]+[:：.)]|\n?{_SPACE}*[0-9]+{_SPACE}*[.、)]{_SPACE}+"
_LOGIC = re.compile(rf"\n{_SPACE}*\n+|(?={_STEP})", re.I)
_CLAUSE = re.compile(rf"(?<=[。！？.!?；;]){_SPACE}+|\n+")


def pieces(text: str, cut: re.Pattern[str]) -> list[str]:
    """The stretches between the cuts, stripped, without empty ones."""
    return [p for p in (x.strip(WHITE) for x in cut.split(text) if x) if p]


def joined(parts: Sequence[str], begins: Sequence[bool] | np.ndarray, joint: str) -> list[str]:
    """Blocks of parts from beginning to beginning; the first part begins a block in any case."""
    edges = [0, *(i for i in range(1, len(parts)) if begins[i]), len(parts)]
    return [joint.join(parts[a:b]) for a, b in pairwise(edges)] if parts else []


def filled(parts: Sequence[str], most: int, least: int = 0, gap: int = 0, free: Sequence[bool] | None = None) -> np.ndarray:
    """Where blocks begin that are filled up to ``most`` characters.

    From a beginning on, the next one is the first part with which the block
    would get longer than ``most``, if it holds ``least`` characters by then and
    ``free`` allows a beginning there. ``gap`` is what each part adds to its
    length (a part that begins a later block adds none).
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    run = np.concatenate(([0], np.cumsum(sizes + gap)))
    allowed = np.ones(len(parts), bool) if free is None else np.asarray(free, bool)
    begins, at = np.zeros(len(parts), bool), 0
    while at < len(parts):
        held = run[at + 1 : -1] - run[at] - (gap if at else 0)
        found = np.flatnonzero(allowed[at + 1 :] & (held >= least) & (held + sizes[at + 1 :] > most))
        if not len(found):
            break
        at += 1 + int(found[0])
        begins[at] = True
    return begins


def merged_short(blocks: Sequence[str], least: int, joint: str) -> list[str]:
    """Blocks shorter than ``least`` go to the one before."""
    return joined(blocks, [len(b) >= least for b in blocks], joint)


def sentences_of(text: str) -> list[str]:
    return pieces(text.strip(WHITE), _SENTENCE)


def long_parts(paragraph: str, most: int = 900) -> list[str]:
    """A paragraph beyond ``most`` characters in parts that begin at sentences which open a block."""
    parts = sentences_of(paragraph) if len(paragraph) > most else []
    if len(parts) < 2:
        return [paragraph]
    return joined(parts, filled(parts, most, gap=1, free=[_OPENER.match(p) is not None for p in parts]), " ")


def blocks_of(text: str | None) -> list[str]:
    """The blocks of a trace: paragraphs, their lines gathered from opener to opener, long ones in parts, short ones merged."""
    bare = re.sub("\r\n?", "\n", _THINK.sub("", text or "").strip(WHITE)).strip(WHITE)
    if not bare:
        return []
    found: list[str] = []
    for paragraph in pieces(bare, _PARAGRAPH):
        lines = [x for x in (x.strip(WHITE) for x in paragraph.split("\n")) if x]
        found += joined(lines, [_OPENER.match(x) is not None for x in lines], "\n") if len(lines) > 1 else long_parts(paragraph)
    return merged_short(found if len(found) > 1 else long_parts(bare), 28, "\n")


def marker_pattern(markers: Sequence[str]) -> re.Pattern[str] | None:
    """One pattern for all markers, at word boundaries, in the order given."""
    bound = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
    own = [(bound[0] if m[0].isalnum() else "") + re.escape(m) + (bound[1] if m[-1].isalnum() else "") for m in markers if m]
    return re.compile("|".join(own), re.I) if own else None


def marker_blocks(text: str | None, pattern: re.Pattern[str] | None) -> list[str]:
    """Blocks that begin at markers, or paragraphs, or sentences: the first way that gives three. Long ones go line by line, short ones are merged."""
    bare = re.sub("\r\n?", "\n", text or "").strip(WHITE)
    at = sorted({0, len(bare), *(m.start() for m in pattern.finditer(bare))}) if pattern else []
    marked = [p for p in (bare[a:b].strip(WHITE) for a, b in pairwise(at)) if p]
    ways = (lambda: marked, lambda: pieces(bare, _PARAGRAPH), lambda: pieces(bare, re.compile(rf"(?<=[.!?。！？]){_SPACE}+")))
    own: list[str] = []
    for way in ways:
        own = way()
        if len(own) > 2:
            break
    out: list[str] = []
    for block in own:
        lines = [x for x in (x.strip(WHITE) for x in block.split("\n")) if x]
        out += lines if len(lines) > 1 and (block.count("\n") > 1 or len(block.split()) > 60) else [block]
    return merged_short(out, 32, "\n\n")


def logic_blocks(text: str | None, most: int = 900, least: int = 180) -> list[str]:
    """Blocks at blank lines, steps and numbered items; a longer one is filled up clause by clause."""
    out: list[str] = []
    for block in pieces((text or "").strip(WHITE), _LOGIC):
        parts = pieces(block, _CLAUSE) if len(block) > most else [block]
        out += joined(parts, filled(parts, most, least), " ")
    return out


#: What the form of a block is made of: commands, formula marks, numbers, words, everything else.
_FORM = re.compile(r"\\[a-z]+|\$+|\\[()\[\]]|[-+]?\d+(?:\.\d+)?|[^\W\d]+|.", re.S)
_NAME = re.compile("[a-z_]+")
_LETTERS = str.maketrans("İΣ", "iσ")


def form(text: str) -> str:
    """The form of a block: commands, formula marks, numbers and single letters dropped, every other ASCII word is VAR, white space squeezed."""

    def shown(token: str) -> str:
        if _NAME.fullmatch(token):
            return "VAR" if len(token) > 1 or token == "_" else " "
        dropped = token[0] == "$" or token[0].isdecimal() or len(token) > 1 and token[0] in "\\+-"
        return " " if dropped else token

    low = text.translate(_LETTERS).lower()
    return " ".join(p for p in re.split(f"{_SPACE}+", "".join(map(shown, _FORM.findall(low)))) if p)


def form_similarity(left: str, right: str) -> float:
    """How alike the forms of two blocks are; 0 if one has no form."""
    a, b = form(left), form(right)
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


# --- columns -------------------------------------------------------------------


def udf_blocks(c: Column | str) -> Column:
    return mapped(blocks_of, "array<string>", c)


def udf_logic_blocks(c: Column | str) -> Column:
    return mapped(logic_blocks, "array<string>", c)


def udf_marker_blocks(c: Column | str, markers: Sequence[str]) -> Column:
    own, kept = list(markers), []

    def run(text: str | None) -> list[str]:
        if not kept:
            kept.append(marker_pattern(own))
        return marker_blocks(text, kept[0])

    return mapped(run, "array<string>", c)


def udf_form(c: Column | str) -> Column:
    return mapped(lambda s: form(s or ""), "string", c)


def udf_similarity(left: Column | str, right: Column | str) -> Column:
    return mapped(lambda a, b: form_similarity(a or "", b or ""), "double", left, right)
