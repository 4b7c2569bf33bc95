"""How a text ends: open structures by a pushdown parser, terminal marks, conclusions and marks of a cut."""

from __future__ import annotations

import re

#: Closers by opener.
_PAIRS = {"(": ")", "[": "]", "{": "}", "“": "”", "„": "”", "「": "」", "『": "』"}
_CLOSERS = {v: k for k, v in _PAIRS.items()} | {"”": "“"}
#: An interval may be open on one side.
_INTERVAL = {")": "[", "]": "("}
#: What ends a sentence, and what may follow it.
TERMINAL = ".!?。！？…"
AFTER = "\"'”’»)]}*_`"
_TOKENS = re.compile(r"```|\$\$|\\[\[\]()]|\\begin\{(\w+\*?)\}|\\end\{(\w+\*?)\}|\\.|[$(){}\[\]“”„「」『』«»]|</?(\w+)>")
#: Marks of which either may open a quotation, and the other then closes it.
_EITHER = {"«": "»", "»": "«"}
#: What a blank line doesn't end.
_SPANNING = re.compile(r"```|\$\$|\\[\[\]]|\\begin\{(\w+\*?)\}|\\end\{(\w+\*?)\}|\\.|</?(\w+)>")
_MARK = re.compile(r"\s*(?:\[\s*(?:cut|cut off|truncated|snip|\.\.\.|…)\s*\]|\(\s*(?:cut|truncated)\s*\)|<\s*(?:cut|truncated)\s*/?>|…|\.\.\.+)\s*$", re.I)
_TAGS = re.compile(r"</?[a-zA-Z]\w*>\s*$")
#: Words that announce a result, by language.
_RESULT = (
    "answer|result|solution|value|total|qed|therefore|thus|hence|so"
    "|antwort|ergebnis|lösung|somit|also"
    "|réponse|résultat|donc|obtient"
    "|respuesta|resultado|solución|obtiene"
    "|答案|结果|因此|所以"
)
_CONCLUSION = re.compile(rf"(?:{_RESULT})\W*(?:\w+\W+){{0,4}}?[:=：]?[\s*$]*[-+−]?(?:\d[\d.,]*|[a-z]\s*=\s*[-+−]?\d[\d.,]*|\\[a-z]*(?:frac|sqrt|boxed)\b.*)[\s*$}}]*[.!。]?\s*$", re.I)
_LABELLED = re.compile(r"(?:answer|result|antwort|ergebnis|réponse|résultat|respuesta|resultado|答案|结果)\W*[:：][\s*$]*[^\s].*$", re.I)
_QED = re.compile(r"(?:\bq\.?e\.?d\.?|∎|■|□|\\qed\b|\\blacksquare)[\s$.]*$", re.I)
#: Words that cannot end a sentence or a value.
DANGLING = frozenset(
    "a an the of to and or is are was be equals for with by from than that in on at as if so which we it has have gives giving when then but hence since"
    " ist sind der die das den dem ein eine und oder von zu mit für bei als wenn dass gleich beträgt also denn aber"
    " est sont le la les un une et ou de du des à au aux que qui si donc car pour avec dans par égal vaut mais"
    " es son el los las una y o del al que si con por para en igual vale así porque pero".split()
)
#: What a list entry or heading begins with; a sentence that ends inside a text; so many words without one are a style.
_ENTRY = re.compile(r"^[ \t]*(?:\d+[.)]|[-*•]|#+)[ \t]+", re.M)
_ENDED = re.compile(rf"[{TERMINAL}][{re.escape(AFTER)}$]*(?:\s|$)|[。！？]")
_STYLE_WORDS = 40


def open_structures(text: str, before: list[str] | None = None, tokens: re.Pattern = _TOKENS) -> list[str]:
    """The brackets, quotations, formulas, fences, environments and tags that are still open at the end; ``before``: those open at the beginning.

    A closer without its opener is ignored; inside a formula or a fence, what
    opened before it stays on the stack. ``\\(`` and ``\\[`` are formulas,
    other escaped characters stand for themselves. ``[0, 1)`` is closed, and a
    German quotation by the mark that opens an English one.
    """
    stack: list[str] = list(before or ())
    for m in tokens.finditer(text):
        t = m.group()
        if stack and stack[-1] == "```" and t != "```":
            continue
        if t in ("```", "$$", "$"):
            if t in stack:
                while stack.pop() != t:
                    pass
            else:
                stack.append(t)
        elif t in ("\\(", "\\["):
            stack.append(t)
        elif t in ("\\)", "\\]"):
            opener = "\\(" if t == "\\)" else "\\["
            if opener in stack:
                while stack.pop() != opener:
                    pass
        elif m.group(1):
            stack.append("env " + m.group(1))
        elif m.group(2):
            if (name := "env " + m.group(2)) in stack:
                while stack.pop() != name:
                    pass
        elif m.group(3):
            name = "<" + m.group(3).lower()
            if t[1] != "/":
                stack.append(name)
            elif name in stack:
                while stack.pop() != name:
                    pass
        elif t in _EITHER:
            if (other := _EITHER[t]) in stack:
                while stack.pop() != other:
                    pass
            else:
                stack.append(t)
        elif t == "“" and "„" in stack:
            del stack[len(stack) - 1 - stack[::-1].index("„") :]
        elif t in _PAIRS:
            stack.append(t)
        elif t in _INTERVAL and stack and stack[-1] == _INTERVAL[t] and _CLOSERS[t] not in stack:
            stack.pop()
        elif t in _CLOSERS and _CLOSERS[t] in stack:
            opener = _CLOSERS[t]
            at = len(stack) - 1 - stack[::-1].index(opener)
            if not any(s in ("$", "$$", "```") for s in stack[at:]):
                del stack[at:]
    return stack


def open_at_end(text: str) -> list[str]:
    """What is open at the end of a text of several paragraphs.

    Fences, displayed formulas, environments and tags from anywhere; brackets,
    quotations and inline formulas end with their paragraph. ``item`` stands
    for an empty last entry of a list.
    """
    at = text.rfind("\n\n") + 1
    stack = open_structures(text[at:], open_structures(text[:at], tokens=_SPANNING))
    return [*stack, "item"] if empty_item(text) else stack


def open_tags(text: str) -> bool:
    """Whether markup is open at the end."""
    return any(s[0] == "<" for s in open_structures(text, tokens=_SPANNING))


def empty_item(text: str) -> bool:
    """Whether the text stops at the mark of a list entry that others come before."""
    m = re.search(r"\n[ \t]*(?:(\d+)[.)]|[-*•])\s*$", text[-40:])
    if not m:
        return False
    mark = rf"{int(m.group(1)) - 1}[.)]" if m.group(1) else re.escape(m.group().strip())
    return re.search(rf"^[ \t]*{mark}[ \t]+\S", text, re.M) is not None


def without_mark(text: str) -> tuple[str, bool]:
    """The text without a mark of a cut at its end, and whether there was one."""
    bare = text.rstrip()
    m = _MARK.search(bare[-40:])
    return (bare[: len(bare) - len(bare[-40:]) + m.start()].rstrip(), True) if m else (bare, False)


def without_tags(text: str) -> str:
    """The text without closing markup at its end."""
    while m := _TAGS.search(text[-40:]):
        text = text[: len(text) - len(text[-40:]) + m.start()].rstrip()
    return text


def last_line(text: str) -> str:
    return text.rstrip().rsplit("\n", 1)[-1]


def terminated(text: str) -> bool:
    """Whether the last sentence has its end."""
    bare = text.rstrip().rstrip(AFTER + "$").rstrip()
    return bool(bare) and bare[-1] in TERMINAL


def concluded(text: str) -> bool:
    """Whether the text ends with a result: a closed box, a labelled value, or an end-of-proof mark."""
    line = last_line(text)
    tail = line[-300:]
    if _QED.search(tail):
        return True
    at = tail.rfind("\\boxed{")
    if at >= 0:
        depth = 0
        for i in range(at + 6, len(tail)):
            depth += (tail[i] == "{") - (tail[i] == "}")
            if not depth:
                return tail[at + 7 : i].strip() != "" and not re.search(r"\w\w", tail[i + 1 :])
        return False
    if _LABELLED.search(tail) and not open_structures(tail):
        return True
    return bool(_CONCLUSION.search(tail)) and len(tail) < 120 and tail.rstrip()[-1:] in TERMINAL


def labelled_word(text: str) -> bool:
    """Whether the conclusion that the text ends with is a labelled one that ends in a word: nothing but the word shows that it is whole."""
    tail = last_line(text)[-300:]
    return tail.rstrip()[-1:].isalpha() and "\\boxed{" not in tail and not _QED.search(tail) and concluded(text)


def loose(text: str) -> bool:
    """Whether the text may end without the end of a sentence: a list entry or heading where most others have none, or lines or much text without any; never after a word that cannot end one."""
    line = last_line(text)
    last = re.search(r"[^\W\d_]{2,}$", line)
    if last and last.group().lower() in DANGLING:
        return False
    if _ENTRY.match(line):
        others = [x for x in text.rstrip().split("\n")[:-1] if _ENTRY.match(x)]
        return 2 * sum(map(terminated, others)) <= len(others)
    bare = _ENTRY.sub("", text.strip())
    return not _ENDED.search(bare) and ("\n" in bare or len(bare.split(None, _STYLE_WORDS)) > _STYLE_WORDS)
