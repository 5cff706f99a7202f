"""Encoding of texts with a public byte-level BPE vocabulary (problem 7).

Method: pair occurrence index. The distinct pieces of a partition's texts become one long sequence of byte symbols. An index maps each
adjacent pair that the vocabulary can merge to all its positions; the pairs' ranks wait in a heap. The lowest active rank is applied to all its
positions at once, and only the lists of the pairs beside those positions are updated. Every distinct piece is thus encoded once per
partition, however often it occurs.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: The default vocabulary file; the path is a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: A vocabulary file larger than this isn't broadcast but refused.
VOCABULARY_BYTES = 64_000_000
#: Distinct pieces that a task keeps; beyond it the memory of pieces starts anew, which costs time and changes no result.
PIECES_KEPT = 400_000

# White space by its Unicode property, and the split pattern of the vocabulary.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary file's content, read where the plan is made and broadcast, so that executors need no such file."""
    if (size := os.path.getsize(path)) > VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is too large to be broadcast")
    with open(path, "rb") as file:
        return file.read()


def _byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable Latin-1 for itself, the others in order from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PairIndexEncoder:
    """Ids of texts; exact for vocabularies whose merges are given in order of rank."""

    def __init__(self, vocabulary: bytes):
        import regex

        model = json.loads(vocabulary)["model"]
        ids = model["vocab"]
        self.byte_ids = [ids[c] for c in _byte_symbols()]
        self.width = max(ids.values()) + 1
        self.rank, self.merged, self.parts = {}, [], []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(ids[left] * self.width + ids[right], rank)
            self.parts.append((ids[left], ids[right]))
            self.merged.append(ids[left + right])
        self.split = regex.compile(PATTERN).findall
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.first, self.rest = _Numbered(""), _Numbered(" ")
        self.first.shared = self.rest.shared = self.units = []
        self.ids = np.empty(0, np.int32)
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of each distinct piece, by the pair occurrence index over all of them."""
        symbol: list[int] = []
        starts = []
        for piece in pieces:
            starts.append(len(symbol))
            symbol.extend(map(self.byte_ids.__getitem__, piece.encode("utf-8", "surrogatepass")))
        size = len(symbol)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        for s in starts:
            if s < size:
                before[s] = -1
            if s:
                after[s - 1] = -1
        if size:
            after[-1] = -1
        rank_of, width, index = self.rank.get, self.width, {}
        for p in range(size):
            if after[p] >= 0 and (r := rank_of(symbol[p] * width + symbol[p + 1])) is not None:
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            places, (left, right), new = index.pop(rank), self.parts[rank], self.merged[rank]
            if left == right:
                places.sort()
            for p in places:
                q = after[p]
                if symbol[p] != left or q < 0 or symbol[q] != right:
                    continue
                n, b = after[q], before[p]
                symbol[p], symbol[q], after[p] = new, -1, n
                if b >= 0 and (r := rank_of(symbol[b] * width + new)) is not None:
                    if r in index:
                        index[r].append(b)
                    else:
                        index[r] = [b]
                        heapq.heappush(active, r)
                if n >= 0:
                    before[n] = p
                    if (r := rank_of(new * width + symbol[n])) is not None:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            heapq.heappush(active, r)
        ends = [*starts[1:], size]
        return [tuple(x for x in symbol[s:e] if x >= 0) for s, e in zip(starts, ends)]

    def _learn(self, units: list[str]) -> None:
        """Adds the ids of new units; a unit is a stretch of text that no piece crosses."""
        split, known = [self.split(u) for u in units], self.pieces
        fresh = list({p: None for u in split for p in u if p not in known})
        known.update(zip(fresh, self.encode_pieces(fresh)))
        lists = [[x for p in u for x in known[p]] for u in split]
        length = np.fromiter(map(len, lists), np.int64, len(lists))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, np.fromiter((x for u in lists for x in u), np.int32, int(length.sum()))])

    def _numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts as numbers, and how many units each text has."""
        if len(self.units) > PIECES_KEPT or len(self.pieces) > PIECES_KEPT:
            self._forget()
        first, rest = self.first.__getitem__, self.rest.__getitem__
        seen, flat, counts = len(self.units), [], []
        for text in texts:
            if not text:
                counts.append(0)
                continue
            parts = BREAK.split(text) if DOUBTFUL(text) else text.split(" ")
            flat.append(first(parts[0]))
            flat.extend(map(rest, parts[1:]))
            counts.append(len(parts))
        if len(self.units) > seen:
            self._learn(self.units[seen:])
        return np.array(flat, np.int64), np.array(counts, np.int64)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        units, per_text = self._numbers(texts)
        total = np.concatenate([[0], np.cumsum(self.length[units])])
        end = np.cumsum(per_text)
        return total[end] - total[end - per_text]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the offsets at which each text's ids begin and the last ends."""
        units, per_text = self._numbers(texts)
        length = self.length[units]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(self.start[units] - total[:-1], length) + np.arange(total[-1])]
        return ids, total[np.concatenate([[0], np.cumsum(per_text)])]


#: A blank after something that isn't white space; no piece of the pattern crosses it.
BREAK = re.compile(rf"(?<=[^{WHITE}]) ")
DOUBTFUL = re.compile(r"\s ").search


class _Numbered(dict):
    """Numbers for units in order of appearance; ``lead`` is what stands before the key in the text."""

    def __init__(self, lead: str):
        self.lead, self.shared = lead, []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self.shared)
        self.shared.append(self.lead + key)
        return number


def token_ids(spark: SparkSession, path: str = VOCABULARY) -> Callable[[Column], Column]:
    """A function from a text column to its ids, ``array<int>``, without special tokens; text that looks like one is plain text.

    Null, empty: an empty list. Blank text, very long text and text without any white space are encoded like any other. Equal texts
    get equal ids. The empty table gives no rows. It is a column expression, so the other columns of a table stay as they are.
    """
    content = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = PairIndexEncoder(content.value)
        for batch in batches:
            ids, offsets = encoder.encode(batch.to_pylist())
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    return encode


def token_counts(spark: SparkSession, path: str = VOCABULARY) -> Callable[[Column], Column]:
    """A function from a text column to the number of its ids; 0 for null and empty."""
    content = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf("int")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = PairIndexEncoder(content.value)
        for batch in batches:
            yield pa.array(encoder.counts(batch.to_pylist()), pa.int32())

    return count
