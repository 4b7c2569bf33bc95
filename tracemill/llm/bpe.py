"""Byte-level BPE with a rank queue over hierarchical bitmaps.

A pre-token becomes a linked list of byte tokens. Each mergeable neighbour
pair is put in the bucket of its merge rank, and three levels of bitmaps tell
which buckets hold something: find-first-set from the top level down gives the
lowest rank in a constant number of word operations, however long the
pre-token is. A merge leaves the entries of its neighbours in place; they are
recognised as stale when they come up, since the pair at the position then has
another rank. The cost is linear in the bytes of the pre-token.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import regex
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: White space as Unicode's White_Space property has it, as used by the pre-tokenizer.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A piece is a run without white space together with one space before it, or white space alone. No pre-token crosses from one piece into the next.
_PIECES = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Fixed value: the pre-token pattern of the public byte-level vocabulary.
_PRETOKENS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Longer pieces are not kept, so the cache is bounded in bytes as well as in entries.
_LONG = 64
_WORD = 64
_MASK = _WORD - 1


class RankQueue:
    """Positions by rank, with find-first-set over three bitmap levels."""

    def __init__(self, ranks: int) -> None:
        words = (ranks + _MASK) // _WORD
        self.leaf = [0] * words
        self.mid = [0] * ((words + _MASK) // _WORD)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        word, block = rank >> 6, rank >> 12
        self.leaf[word] |= 1 << (rank & _MASK)
        self.mid[block] |= 1 << (word & _MASK)
        self.top |= 1 << block

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank with all its positions, or None."""
        if not self.top:
            return None
        block = (self.top & -self.top).bit_length() - 1
        bits = self.mid[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.leaf[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        bits &= bits - 1
        self.leaf[word] = bits
        if not bits:
            self.mid[block] &= ~(1 << (word & _MASK))
            if not self.mid[block]:
                self.top &= ~(1 << block)
        return rank, self.buckets.pop(rank)


class ByteBPE:
    """Encoder for a vocabulary given as ranks; special tokens do not exist for it."""

    def __init__(self, path: str, cache_entries: int = 1 << 18) -> None:
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(token): int(number) for token, number in rows}
        self.token = {number: token for token, number in self.rank.items()}
        self.size = max(self.token) + 1
        self.byte_id = [self.rank[bytes([b])] for b in range(256)]
        self.cache_entries = cache_entries
        self._pretokens: dict[str, tuple[int, ...]] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._lengths: dict[str, int] = {}
        self._queue = RankQueue(self.size)

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        rank, token = self.rank, self.token
        ids = [self.byte_id[b] for b in data]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = self._queue
        for i in range(n - 1):
            r = rank.get(token[ids[i]] + token[ids[i + 1]])
            if r is not None:
                queue.push(r, i)
        while (least := queue.pop()) is not None:
            r, positions = least
            merged = token[r]
            positions.sort()
            for i in positions:
                if ids[i] < 0 or (j := after[i]) >= n or token[ids[i]] + token[ids[j]] != merged:
                    continue  # stale: one side went into another merge
                ids[i] = r
                ids[j] = -1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    right = rank.get(merged + token[ids[k]])
                    if right is not None:
                        queue.push(right, i)
                h = before[i]
                if h >= 0:
                    left = rank.get(token[ids[h]] + merged)
                    if left is not None:
                        queue.push(left, h)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def _piece(self, piece: str) -> tuple[int, ...]:
        known = self._pretokens
        out: list[int] = []
        for pretoken in _PRETOKENS.findall(piece):
            ids = known.get(pretoken)
            if ids is None:
                ids = tuple(self.merge(pretoken.encode("utf-8", "surrogatepass")))
                if len(pretoken) <= _LONG:
                    if len(known) >= self.cache_entries:
                        known.clear()
                    known[pretoken] = ids
            out.extend(ids)
        return tuple(out)

    def _learn(self, pieces: list[str], known: dict, value: Callable) -> list[str]:
        """Put the new pieces into a cache of bounded size; the long ones among them are returned, to be taken out again."""
        if len(known) >= self.cache_entries:
            known.clear()
        new = set(pieces).difference(known)
        for piece in new:
            known[piece] = value(piece)
        return [piece for piece in new if len(piece) > _LONG]

    def encode_into(self, text: str | None, out: array) -> None:
        """Append the ids of ``text`` to ``out``; nothing for a null or empty text."""
        if text:
            pieces, known = _PIECES.findall(text), self._pieces
            long = self._learn(pieces, known, self._piece)
            out.extend(chain.from_iterable(map(known.__getitem__, pieces)))
            for piece in long:
                del known[piece]

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        self.encode_into(text, out)
        return out.tolist()

    def count(self, text: str | None) -> int:
        """The number of ids of ``text``."""
        if not text:
            return 0
        pieces, lengths = _PIECES.findall(text), self._lengths
        long = self._learn(pieces, lengths, lambda piece: len(self._piece(piece)))
        n = sum(map(lengths.__getitem__, pieces))
        for piece in long:
            del lengths[piece]
        return n


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBPE:
    """One encoder per worker process and vocabulary."""
    return ByteBPE(path)


def shipped(spark: SparkSession, path: str) -> str:
    """Send the vocabulary file along with the application where the workers may run on other machines."""
    if not spark.sparkContext.master.startswith("local"):
        spark.sparkContext.addFile(path)
    return path


def on_worker(path: str) -> str:
    """The vocabulary file as this worker has it: at the same path, or shipped with the application."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def vocabulary_path(name: str = "byte_bpe_50k", folder: str = "/opt/tokenizers") -> str:
    return f"{folder}/{name}.tiktoken"
