"""Languages of sentences: script checks, and a character model of each alphabetic language fitted on labelled documents."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.tables import hash_sample

#: About so many labelled documents (never twice as many) are taken for the fit, and so many characters of each; the sample is by a hash of the id.
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 1000
#: A language takes part if so many sampled documents have its label; a stretch is decided if its best language leads by so many nats.
LEAST_DOCS, LEAD = 3, 4.0
#: Words kept with their scores in a worker.
KEPT_WORDS = 1 << 17
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_FORMULA = re.compile(r"\$[^$]*\$|\\[a-zA-Z]+(?:\{[^{}]*\})*|</?think(?:ing)?>", re.I)
#: Words, and what ends a sentence.
_PARTS = re.compile(r"[^\W\d_]+|[.!?](?=\s)|[。！？\n]")
_ENDS = frozenset(".!?。！？\n")


def _grams(word: str) -> list[str]:
    """The letters of a word with the two before each."""
    padded = f"\x02\x02{word}\x03"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


class Languages:
    """Scores of words by the log-likelihood of their letters in each language; ideographs are told by their script."""

    def __init__(self, counts: dict[str, Counter]) -> None:
        self.names = [*sorted(counts), "zh"]
        n = len(counts)
        self.table: dict[str, np.ndarray] = {}
        grams = set().union(*counts.values()) if counts else set()
        contexts = [Counter() for _ in range(n)]
        for own, lang in zip(contexts, sorted(counts), strict=True):
            for gram, c in counts[lang].items():
                own[gram[:2]] += c
        alphabet = len({g[2] for g in grams}) + 1
        self.unseen = np.zeros(n)
        for gram in grams:
            row = [np.log((counts[lang][gram] + 0.5) / (own[gram[:2]] + 0.5 * alphabet)) for own, lang in zip(contexts, sorted(counts), strict=True)]
            self.table[gram] = np.array(row)
        self._forget()

    def _row(self, word: str) -> np.ndarray:
        """Scores by language, then letters, then ideographs."""
        n = len(self.names) - 1
        row = np.zeros(n + 2)
        row[n] = len(word)
        if cjk := len(_CJK.findall(word)):
            row[n + 1] = cjk
        elif len(word) > 1:
            score = sum((self.table.get(g, self.unseen) for g in _grams(word[:40])), np.zeros(n))
            row[:n] = score - score.max(initial=-np.inf) if n else 0.0
        return row

    def _scores(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the parts of a text, and which of them end a sentence (rows of zeros)."""
        if len(self.words) > KEPT_WORDS:
            self._forget()
        new = set(parts).difference(self.words)
        for w in new:
            self.words[w] = len(self.rows)
            self.rows.append(self._row(w))
        if new:
            self.matrix = np.concatenate([self.matrix, np.array(self.rows[len(self.matrix) :])])
        at = np.fromiter(map(self.words.__getitem__, parts), np.int64, len(parts))
        return self.matrix[at], at < len(_ENDS)

    def _forget(self) -> None:
        n = len(self.names) + 1
        self.words, self.rows, self.matrix = {w: i for i, w in enumerate(sorted(_ENDS))}, [np.zeros(n)] * len(_ENDS), np.zeros((len(_ENDS), n))

    def _decided(self, total: np.ndarray) -> np.ndarray:
        """The language of each stretch from its summed scores, by its number; -1 where it can't be told."""
        n = len(self.names) - 1
        out = np.full(len(total), -1)
        if n > 1:
            score = total[:, :n]
            best = score.argmax(1)
            lead = np.sort(score, axis=1)
            out = np.where(lead[:, -1] - lead[:, -2] >= LEAD, best, -1)
        return np.where((total[:, -1] > 0) & (total[:, -1] * 3 >= total[:, -2]), n, out)

    def of(self, text: str) -> str | None:
        """The language of a text as one stretch, or None where it can't be told."""
        parts = _PARTS.findall(_FORMULA.sub(" ", text).lower())
        if not parts:
            return None
        at = self._decided(self._scores(parts)[0].sum(0, keepdims=True))[0]
        return self.names[at] if at >= 0 else None

    def shares(self, text: str) -> dict[str, float]:
        """Letters by language over the sentences of a text (an ideograph counts three); undecided sentences are left out."""
        parts = _PARTS.findall(_FORMULA.sub(" ", text).lower())
        if not parts:
            return {}
        rows, ends = self._scores(parts)
        starts = np.flatnonzero(np.concatenate(([True], ends[:-1])))
        total = np.add.reduceat(rows, starts, axis=0)
        lang = self._decided(total)
        letters = np.bincount(lang + 1, total[:, -2], len(self.names) + 1)[1:]
        letters[-1] *= 3
        return {name: float(x) for name, x in zip(self.names, letters, strict=True) if x}


def counted(rows: list[tuple[str, str]]) -> dict[str, Counter]:
    """Letter counts by language from labelled texts; a text whose letters another language explains better is left out of a second count."""

    def count(kept: list[tuple[str, str]]) -> dict[str, Counter]:
        out: dict[str, Counter] = {}
        number = Counter(lang for lang, _ in kept)
        for lang, text in kept:
            if number[lang] >= LEAST_DOCS:
                own = out.setdefault(lang, Counter())
                for word, c in Counter(w for w in _PARTS.findall(text) if len(w) > 1 and not _CJK.search(w)).items():
                    for gram in _grams(word[:40]):
                        own[gram] += c
        return {lang: own for lang, own in out.items() if own.total() >= 200}

    clean = [(lang.strip().lower(), _FORMULA.sub(" ", text[:SAMPLE_CHARS]).lower()) for lang, text in rows]
    clean = [(lang, text) for lang, text in clean if len(_CJK.findall(text)) * 3 < sum(map(str.isalpha, text))]
    first = Languages(count(clean))
    return count([(lang, text) for lang, text in clean if first.of(text) == lang])


def fitted(docs: DataFrame) -> Languages:
    """The model of the languages that ``docs`` (``doc_id, text, lang``) is labelled with, from a bounded sample.

    Null, blank and wrong labels and texts do no harm: a label of few
    documents is no language, and a text that its label explains badly is left
    out. Without labelled documents only scripts are told apart.
    """
    own = docs.filter(F.col("lang").isNotNull()).select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    drawn = hash_sample(own, SAMPLE_DOCS, own.select("lang").count(), "doc_id", "lang").limit(2 * SAMPLE_DOCS)
    rows = drawn.filter(F.length("text") > 0).select("lang", "text").collect()  # a bounded sample
    return Languages(counted(sorted(tuple(r) for r in rows)))
