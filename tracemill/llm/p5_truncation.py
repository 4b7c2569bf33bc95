"""Problem 5: texts that were cut off, by a vocabulary trie, the end of the text and its length."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.endings import concluded, labelled_word, loose, open_at_end, open_tags, terminated, without_mark, without_tags
from tracemill.llm.p2_repetition import generations
from tracemill.sources.stage import staged

_LETTERS = re.compile(r"[^\W\d_]+")
#: A partial vocabulary is handed on when it has so many words.
_FLUSH = 200_000


def last_letters(text: str) -> str:
    """The letters at the very end of the text."""
    i = len(text)
    while i and text[i - 1].isalpha():
        i -= 1
    return text[i:]


def vocabulary(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)`` over all texts, letters only and in lower case; a word that the end of its text touches doesn't count.

    Counted per batch before the shuffle; null and empty texts give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    text = without_mark(text)[0].lower()
                    counts.update(_LETTERS.findall(text))
                    if last := last_letters(text):
                        counts[last] -= 1
            if len(counts) >= _FLUSH:
                yield out()
        if counts:
            yield out()

    return texts.select(F.col(text_col).cast("string")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


def trie(words: DataFrame) -> DataFrame:
    """The inner nodes of the vocabulary's trie: ``(node, below)``, each proper prefix of a word with the occurrences below it."""
    prefixes = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", F.lit(1), i)))
    return words.filter(F.length("word") > 1).select(prefixes.alias("node"), "n").groupBy("node").agg(F.sum("n").alias("below"))


def endings(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """How each text ends: ``keys``, ``length`` (without a mark of a cut), ``marked``, ``closed``, ``tagged``, ``ended``, ``result``, ``worded``, ``loose``, ``last``.

    ``closed``: no formula, bracket, quotation, fence, environment or list
    entry is open; ``tagged``: markup is open;
    ``ended``: the last sentence has its end; ``result``: the text ends with
    its conclusion; ``worded``: a labelled one that ends in a word; ``loose``:
    the text may end without the end of a sentence; ``last``: the letters at the very end, in lower case.
    Null and blank texts are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if not text or text.isspace():
                    continue
                bare, marked = without_mark(text)
                inner = without_tags(bare)
                left = open_at_end(inner)
                tagged = any(s[0] == "<" for s in left) and open_tags(bare)
                closed = not [s for s in left if s[0] != "<"]
                rows.append(i)
                ended, result, last = terminated(inner), concluded(inner), last_letters(bare).lower()
                worded = result and last != "" and labelled_word(inner)
                free = not ended and (worded or not result) and loose(inner)
                out.append((len(bare) if marked else len(text), marked, closed, tagged, ended, result, worded, free, last))
            cols = list(zip(*out, strict=True)) or [[]] * 9
            made = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.bool_()] * 7, pa.string()), strict=True)]
            kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keys, "length", "marked", "closed", "tagged", "ended", "result", "worded", "loose", "last"])

    kinds = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys)
    return texts.select(*keys, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{kinds}, length bigint, marked boolean, closed boolean, tagged boolean, ended boolean, result boolean, worded boolean, loose boolean, last string")


def length_limits(lengths: DataFrame, width: int = 64, least: int = 4, times: float = 8.0) -> DataFrame:
    """The lengths that far more texts have than those around: ``(length)``.

    A limit on a field shows as a spike: at least ``least`` texts of exactly
    this length that don't end by themselves, and ``times`` as many as an
    even spread over its ``width`` lengths would give.
    """
    exact = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("result") & ~F.col("ended")).alias("open"))
    band = exact.groupBy(F.floor(F.col("length") / width).alias("band")).agg(F.sum("n").alias("around"))
    spikes = exact.withColumn("band", F.floor(F.col("length") / width)).filter(F.col("open") >= least).join(band, "band")
    return spikes.filter(F.col("n") * width >= times * F.col("around")).select("length")


def evidence() -> Column:
    """Weights of the signs of a cut; 2 and more is a cut. A mark and an open structure decide by themselves, even before a full stop."""
    return (
        F.when(F.col("marked"), 3).otherwise(0)
        + F.when(~F.col("closed"), 3).otherwise(0)
        + F.when(F.col("tagged"), 1).otherwise(0)
        + F.when(F.col("prefix"), 2).otherwise(0)
        + F.when(F.col("at_limit"), 1).otherwise(0)
        + F.when(F.col("ended"), -1).when(F.col("loose"), 1).otherwise(2)
    )


def truncation(problems: DataFrame) -> DataFrame:
    """``row_id, gen_pos, source, cut`` and the evidence for every generation that isn't null or blank.

    A generation whose conclusion stands at its end is not cut, whatever its
    length or flag, unless the conclusion is a labelled word that the trie
    knows as a beginning only. Otherwise the signs are weighed: a mark of the
    cut, an open formula or bracket, open markup, a last word that is unknown but a proper
    prefix of known words (or rarer by far than the words it begins), a length
    at which many texts stop, a last sentence without its end. In a list,
    under a heading or in a text without sentence ends the last says little,
    so the trie or the length decides.
    """
    spread = generations(problems, "row_id", "source")
    ends = staged(endings(spread, ["row_id", "gen_pos", "source"]), "endings")
    words = vocabulary(spread.select("text"))
    asked = ends.filter((~F.col("result") | F.col("worded")) & (F.col("last") != ""))
    # texts of different lengths that conclude with the same word: it is one, though the vocabulary leaves out last words
    last = asked.groupBy("last").agg(F.countDistinct(F.when(F.col("worded"), F.col("length"))).alias("ways"))
    # only the words of nodes that are asked for go through the joins: vocabulary and trie keep their hash partitioning
    words = staged(words, "vocabulary")
    known = last.join(words.select(F.col("word").alias("last"), "n"), "last", "left").join(trie(words).select(F.col("node").alias("last"), "below"), "last", "left")
    seen, below = F.coalesce("n", F.lit(0)), F.coalesce("below", F.lit(0))
    begun = (seen == 0) & (below > 0)
    judged = known.select("last", ((below > 0) & (seen * 20 < below)).alias("prefix"), begun.alias("begun"), (begun & (F.col("ways") < 2) & (F.length("last") > 2)).alias("broken"))
    limits = length_limits(ends).withColumn("at_limit", F.lit(True))
    no = F.lit(False)
    joined = ends.join(judged, "last", "left").join(limits, "length", "left").withColumns({c: F.coalesce(c, no) for c in ("prefix", "begun", "broken", "at_limit")})
    overruled = F.col("worded") & (F.col("broken") | (F.col("begun") & F.col("at_limit")))
    weight = F.when(F.col("result") & ~overruled, 0).otherwise(evidence())
    return joined.select("row_id", "gen_pos", "source", "length", "marked", "closed", "ended", "result", "prefix", "at_limit", (weight >= 2).alias("cut"))


def cut_generations(problems: DataFrame) -> DataFrame:
    """The generations that were cut: ``(row_id, gen_pos)``."""
    return truncation(problems).filter("cut").select("row_id", "gen_pos")


def truncation_rates(problems: DataFrame) -> DataFrame:
    """Per source how many generations there are and how many were cut: ``source, n, n_cut, rate``; a null source is one of its own."""
    rows = truncation(problems)
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("cut").alias("n_cut")).withColumn("rate", F.col("n_cut") / F.col("n"))
