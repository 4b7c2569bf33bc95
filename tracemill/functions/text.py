"""Text functions as column expressions; all of them stay in the JVM.

White space is ASCII white space throughout. A null in gives a null out
unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no dependency between blocks.
STOPWORDS = [
    "the", "and", "that", "this", "then", "with", "from", "have", "will", "into", "case", "therefore", "thus", "hence", "because", "since",
    "answer", "final", "boxed", "math", "text", "frac", "sqrt", "left", "right", "cdot", "times", "so", "we", "is", "are", "to", "of", "in",
    "for", "a", "an", "it", "as", "on", "by", "be", "or", "if",
]
# The shorter list used for overlap between blocks.
OVERLAP_STOPWORDS = [
    "the", "and", "that", "this", "then", "with", "from", "have", "will", "into", "case", "so", "we", "is", "are", "to", "of", "in", "for",
    "a", "an",
]
# Substrings that mark reasoning, in any position of a word.
REASONING_MARKERS = [
    "because", "since", "therefore", "thus", "hence", "so", "then", "we get", "we have", "implies", "derive", "calculate", "solve",
    "substitute", "simplify", "verify", "check", "assume", "let", "given", "as a result",
    "因为", "由于", "所以", "因此", "可得", "得到", "计算", "化简", "代入", "验证", "设",
]
# Substrings that mark a block as no support; "I should" never matches lower-cased text.
NON_SUPPORTING_MARKERS = [
    "wait", "oops", "mistake", "wrong", "irrelevant", "not needed", "ignore", "instead", "let me think", "I should", "actually", "sorry",
    "等等", "错了", "不对", "无关", "忽略", "重新",
]
# What opens a new block of a trace.
BLOCK_OPENERS = [
    r"(?i:step|case|part)\s*\d+[\).:\-]",
    r"\(?\d+[\).]\s+",
    r"[A-Za-z]\)\s+",
    r"(?:First|Second|Third|Next|Finally|Now|Then|Thus|Therefore|Hence)\b",
    r"(?:首先|其次|然后|接着|最后|因此|所以)",
]
# Fixed value: signs of mathematics in a block.
MATH_SIGN = r"[=<>≤≥]|\\frac|\\sqrt|\\sum|\\int|\d\s*[-+*/]\s*\d"
NUMBER = r"[-+]?\d+(?:\.\d+)?"
DEPENDENCY_TOKEN = r"[a-zA-Z_][a-zA-Z_0-9]*|[-+]?\d+(?:\.\d+)?|[一-鿿]+"
OVERLAP_TOKEN = r"[a-zA-Z_][a-zA-Z_0-9]*|[-+]?\d+(?:\.\d+)?"
#: White space in all text functions, inside a character class.
WHITE = " \t\n\x0b\f\r"
_SPACE = r"[ \t\n\x0B\f\r]"
SENTENCE_END = rf"(?<=[.!?。！？]){_SPACE}+|\n+"
# How a final answer is announced.
ANNOUNCED = (
    r"(?:final\s+answer|answer|therefore|thus|so)\s*(?:is|:|=)?\s*(.+)$",
    r"(?:答案|最终答案|所以|因此)\s*(?:是|为|:|：)?\s*(.+)$",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c: Column | str) -> Column:
    """Lower case, letter by letter: the dotted capital I becomes i and the capital sigma the middle one, wherever they stand."""
    return F.lower(F.translate(_col(c), "İΣ", "iσ"))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value worked out once per row, also where ``f`` uses it inside another array function."""
    return F.element_at(F.transform(F.array(value), f), 1)


def replaced(c: Column, pattern: str, by: str, sign: str) -> Column:
    """``regexp_replace`` for texts that hold ``sign``, without which the pattern cannot match: a plain search spares most texts the pattern."""
    return let(c, lambda x: F.when(F.contains(x, F.lit(sign)), F.regexp_replace(x, pattern, by)).otherwise(x))


def quoted(text: str) -> str:
    """The text as a literal inside a regular expression."""
    return "".join("\\" + ch if not ch.isalnum() and ord(ch) < 128 and ch not in " '" else ch for ch in text)


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.trim(_col(c), F.lit(WHITE))


def non_blank(c: Column | str) -> Column:
    """Whether there is more than white space; false for null."""
    return F.coalesce(strip(c) != "", F.lit(False))


def first_non_blank(*columns: Column | str) -> Column:
    """The first of the columns that is not blank, stripped; null if there is none."""
    return F.coalesce(*[F.when(non_blank(c), strip(c)) for c in columns])


def normalize_answer(c: Column | str) -> Column:
    """Answer for equality: lower case, box unwrapped (up to the first closing brace), without ``$`` and spaces; null becomes ''."""
    return F.translate(F.regexp_replace(lower(strip(F.coalesce(_col(c), F.lit("")))), r"\\boxed\{(.*?)\}", "$1"), "$ ", "")


def strip_think(c: Column | str) -> Column:
    """Without the think tags; what they hold stays."""
    return strip(replaced(_col(c), "(?i)</?think>", "", "<"))


def think_text(c: Column | str) -> Column:
    """What all think spans hold, joined by a line feed; after an unclosed tag the rest; without any tag the whole text."""
    text = _col(c)
    spans = F.regexp_extract_all(text, F.lit("(?is)<think>(.*?)</think>"), F.lit(1))
    start = F.locate("<think>", lower(text))
    rest = F.when(start > 0, F.substring(text, start + 7, F.length(text))).otherwise(text)
    return F.when(F.size(spans) > 0, F.array_join(F.transform(spans, strip), "\n")).otherwise(strip(rest))


def sentences(c: Column | str) -> Column:
    """Sentences of a text, stripped, without empty ones: after an end mark with white space, and at line feeds."""
    return F.filter(F.transform(F.split(strip(c), SENTENCE_END), strip), lambda s: s != "")


def clean_target(c: Column | str) -> Column:
    """Target text without think tags, leading ``:=-``, repeated white space and full stops at the ends."""
    text = F.regexp_replace(strip_think(c), r"^[:：=\-\s]+", "")
    text = F.regexp_replace(text, r"\s+", " ")
    return F.regexp_replace(text, r"^[ \t\r\n.。]+|[ \t\r\n.。]+$", "")


def canonical_target(c: Column | str) -> Column:
    """Key under which two targets are the same: the cleaned target in lower case, wrappers opened, commands, white space and punctuation dropped.

    What cleaning squeezes and trims is dropped here anyway, so only the think
    tags and what leads the text are taken off before.
    """
    text = F.regexp_replace(replaced(_col(c), "(?i)</?think>", "", "<"), r"^[:：=\-\s]+", "")
    text = replaced(lower(text), r"\\(?:boxed|text|mathrm)\s*\{([^{}]*)\}", "$1", "\\")
    return F.regexp_replace(replaced(text, r"\\[a-zA-Z]+", "", "\\"), r"[\s$`'\".,;:，。；：]+", "")


def announced_answer(c: Column | str) -> Column:
    """The answer that one of the last eight sentences announces, the last first, else the last sentence, cleaned; null for a blank text."""
    parts = sentences(c)
    last = F.reverse(F.slice(parts, F.greatest(F.size(parts) - 7, F.lit(1)), 8))

    def of(sentence: Column) -> Column:
        own = [clean_target(F.regexp_extract(sentence, "(?id)" + p, 1)) for p in ANNOUNCED]
        return F.when(own[0] != "", own[0]).otherwise(own[1])

    found = F.get(F.filter(F.transform(last, of), lambda x: x != ""), F.lit(0))
    return F.coalesce(found, F.when(F.size(parts) > 0, clean_target(F.get(last, F.lit(0)))))


def logic_skeleton(c: Column | str) -> Column:
    """The text without ASCII letters, digits and mathematical punctuation, white space squeezed."""
    text = F.regexp_replace(lower(_col(c)), r"[0-9a-zA-Z+\-*/=()\[\]{}^$\\.,:;_]", " ")
    return strip(F.regexp_replace(text, r"\s+", " "))


def dependency_tokens(c: Column | str) -> Column:
    """Distinct identifiers, numbers and runs of ideographs, longer than one character and no stop word."""
    text = replaced(lower(_col(c)), r"\\[a-zA-Z]+", " ", "\\")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(DEPENDENCY_TOKEN), F.lit(0)))
    return F.filter(found, lambda t: ~t.isin(STOPWORDS) & (F.length(t) > 1))


def overlap_tokens(c: Column | str) -> Column:
    """Distinct identifiers and numbers that are no stop word of the shorter list."""
    text = replaced(lower(_col(c)), r"\\[a-zA-Z]+", " ", "\\")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(OVERLAP_TOKEN), F.lit(0)))
    return F.filter(found, lambda t: ~t.isin(OVERLAP_STOPWORDS))


def numbers(c: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(NUMBER), F.lit(0)))


def any_of(phrases: list[str]) -> str:
    """A pattern for any of the phrases: their tree of letters, entered only at letters that one of them begins with."""
    tree: dict = {}
    for phrase in phrases:
        node = tree
        for letter in phrase:
            node = node.setdefault(letter, {})
        node[""] = {}

    def branch(node: dict) -> str:
        ways = [quoted(letter) + branch(below) for letter, below in node.items() if letter]
        return "" if "" in node or not ways else ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return f"(?=[{''.join(map(quoted, tree))}]){branch(tree)}"


def has_reasoning_signal(c: Column | str) -> Column:
    text = _col(c)
    return lower(text).rlike(any_of(REASONING_MARKERS)) | text.rlike(MATH_SIGN)


def is_non_supporting(c: Column | str, tokens: Column | None = None) -> Column:
    """A block with a mark of doubt, or with hardly a token (given, if they are known) and nothing mathematical."""
    text = _col(c)
    marked = lower(text).rlike(any_of(NON_SUPPORTING_MARKERS))
    return marked | ((F.size(dependency_tokens(text) if tokens is None else tokens) <= 1) & ~text.rlike(r"\\boxed|\d|[=<>]"))


def opens_block(c: Column | str) -> Column:
    return strip(c).rlike("^(?:" + "|".join(BLOCK_OPENERS) + ")")


def unify_newlines(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), "\r\n?", "\n"))


def squeeze_blanks(c: Column | str) -> Column:
    """CR LF and CR as line feeds, runs of blanks and tabs as one blank."""
    return F.regexp_replace(F.regexp_replace(_col(c), "\r\n?", "\n"), "[ \t]+", " ")


def word_count(c: Column | str) -> Column:
    """Stretches without white space."""
    return F.regexp_count(_col(c), F.lit(r"\S+"))


def problem_key(c: Column | str) -> Column:
    """The hex md5 of the problem's UTF-8 bytes."""
    return F.md5(_col(c).cast("binary"))


def preview(c: Column | str, n: int = 100, tail: bool = False) -> Column:
    """White space squeezed, the first (or last) ``n`` characters, and an ellipsis if something was left out."""
    text = F.regexp_replace(strip(c), r"\s+", " ")
    cut = F.concat(F.lit("..."), F.right(text, F.lit(n))) if tail else F.concat(F.substring(text, 1, n), F.lit("..."))
    return F.when(F.length(text) <= n, text).otherwise(cut)


def middle_out(c: Column | str, most: int = 1500, side: int = 750) -> Column:
    """A block for a prompt: beyond ``most`` characters the first and last ``side``."""
    text = _col(c)
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, side), F.lit("\n[...]\n"), F.right(text, F.lit(side)))).otherwise(text)


# Spellings of truth.
_TRUE = ["true", "yes", "y", "1", "是", "有用", "充分"]


def coerce_bool(c: Column | str) -> Column:
    """Truth of a model's word: a known spelling of yes, or a number other than 0; everything else, null included, is false."""
    text = lower(strip(_col(c).cast("string")))
    number = F.when(text.rlike(r"^[-+]?\d+(\.\d+)?$"), text.cast("double"))
    return F.coalesce(text.isin(_TRUE), F.lit(False)) | F.coalesce(number != 0, F.lit(False))


def json_strings(c: Column | str) -> Column:
    """A JSON list of strings as an array; null where it doesn't parse."""
    return F.from_json(_col(c), "array<string>")


def is_clean_marker(c: Column | str) -> Column:
    """A marker of 1 to 8 words and at most 80 characters, without digits, formula signs or doubled punctuation."""
    text = strip(c)
    count = F.regexp_count(text, F.lit(r"[A-Za-z]+(?:'[A-Za-z]+)?"))
    return (text != "") & (F.length(text) <= 80) & ~text.rlike(r"[$\\=<>^_{}]|\d") & ~text.rlike(r"[.;:!?]{2,}") & count.between(1, 8)
