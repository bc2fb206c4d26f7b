"""Encoding of texts with a public byte-level tokenizer.

Method: texts are cut into words by the tokenizer's pattern; the words of a batch not met before are encoded together. Their
symbols lie in one flat array; each round finds the rank of every neighbouring pair by binary search over the sorted pair
keys, merges in each word the pairs of its lowest rank, and closes up the array, until no word has a pair left. Words are cut
beforehand where no token can reach across, so a word of megabytes takes no more rounds than its longest such stretch.

Defined results: null, empty and missing texts give an empty list; white space is text like any other; lone surrogates (which no
table can hold) become question marks; very long texts and words are encoded whole; special tokens are
ordinary text; repeated rows give repeated results; empty inputs give an empty result; other columns play no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

#: Where the vocabulary lies; read by the driver only.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that cuts text into words before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept with their ids between batches, and the longest that are kept.
KEPT, KEPT_LENGTH = 400_000, 64
_NONE = np.iinfo(np.int64).max


@dataclass
class Merges:
    """Sorted pair keys (left << 32 | right) with rank and merged id, the ids of single bytes, and which bytes stand next to
    each other within any token."""

    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    single: np.ndarray
    inside: np.ndarray


def _byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable ones as themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def load_merges(path: str = VOCABULARY) -> Merges:
    """The tables of a byte-level vocabulary in the JSON form of its public file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    ids: dict[str, int] = model["vocab"]
    letters = _byte_letters()
    single = np.zeros(256, np.int64)
    for letter, byte in letters.items():
        single[byte] = ids[letter]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    left, right, merged = (np.array([ids[x] for x in column], np.int64) for column in (*zip(*pairs), map("".join, pairs)))
    order = np.argsort(left << 32 | right, kind="stable")
    inside = np.zeros((256, 256), bool)
    for a, b in pairs:
        for x, y in zip(a + b, (a + b)[1:]):
            inside[letters[x], letters[y]] = True
    return Merges((left << 32 | right)[order], order.astype(np.int64), merged[order], single, inside)


def merge_words(words: list[bytes], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and the offset at which each word starts (and the last ends)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols, own = m.single[raw], np.repeat(np.arange(len(words)), size)
    # no token reaches over two bytes that no token holds side by side: what lies between such places is merged by itself,
    # so a round serves all stretches of a long word at once
    ends = np.r_[True, (own[1:] != own[:-1]) | ~m.inside[raw[:-1], raw[1:]]] if len(raw) else np.empty(0, bool)
    word = np.cumsum(ends) - 1
    first = own[ends]
    finished: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols) > 1:
        key = symbols[:-1] << 32 | symbols[1:]
        at = np.searchsorted(m.keys, key)
        at[at == len(m.keys)] = 0
        rank = np.where((m.keys[at] == key) & (word[:-1] == word[1:]), m.ranks[at], _NONE)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(np.append(rank, _NONE), starts)
        open_ = lowest != _NONE
        length = np.diff(np.append(starts, len(word)))
        if not open_.all():  # words without pairs leave the array
            keep = np.repeat(open_, length)
            finished.append((word[~keep], symbols[~keep]))
            symbols, word = symbols[keep], word[keep]
            if not len(symbols):
                break
            rank, at = np.append(rank, _NONE)[keep], np.append(at, 0)[keep]
            lowest, length = lowest[open_], length[open_]
        else:
            rank, at = np.append(rank, _NONE), np.append(at, 0)
        hit = rank == np.repeat(lowest, length)
        # of overlapping pairs (the same symbol again and again) every other one from the left counts
        run = np.flatnonzero(hit)
        if len(run) > 1:
            fresh = np.r_[True, np.diff(run) != 1]
            place = np.arange(len(run)) - np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
            run = run[place % 2 == 0]
        symbols[run] = m.merged[at[run]]
        keep = np.ones(len(symbols), bool)
        keep[run + 1] = False
        symbols, word = symbols[keep], word[keep]
    finished.append((word, symbols))
    word, symbols = (np.concatenate(x) for x in zip(*finished))
    order = np.argsort(word, kind="stable")
    return symbols[order].astype(np.int32), np.searchsorted(first[word[order]], np.arange(len(words) + 1))


@dataclass
class Encoder:
    """Encodes batches of texts; words are remembered between batches within a bound."""

    merges: Merges
    pattern: str = PATTERN
    known: dict[str, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.cut = regex.compile(self.pattern).findall

    def words(self, texts: list[str | None]) -> list[list[str]]:
        """Each text's words, all of which are known afterwards."""
        if len(self.known) > KEPT:
            self.known.clear()
        pieces = [self.cut(t) if t else [] for t in texts]
        fresh = [w for w in set(chain.from_iterable(pieces)) if w not in self.known]
        if fresh:
            ids, offsets = merge_words([w.encode("utf-8", "replace") for w in fresh], self.merges)
            ids, offsets = ids.tolist(), offsets.tolist()
            self.known.update((w, ids[a:b]) for w, a, b in zip(fresh, offsets, offsets[1:]))
        return pieces

    def forget_long(self, pieces: list[list[str]]) -> None:
        for w in {w for p in pieces for w in p if len(w) > KEPT_LENGTH}:
            del self.known[w]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        pieces = self.words(texts)
        known = self.known
        out = [list(chain.from_iterable(map(known.__getitem__, p))) for p in pieces]
        self.forget_long(pieces)
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        pieces = self.words(texts)
        known = self.known
        out = [sum(len(known[w]) for w in p) for p in pieces]
        self.forget_long(pieces)
        return out


#: Encoders of this process by vocabulary, so that words stay known from task to task.
_encoders: dict[str, Encoder] = {}


def _shared(spark: SparkSession, vocabulary: str):
    """A function that gives the executor's encoder; the tables (about 2 MB, fixed) are broadcast by the driver."""
    tables = spark.sparkContext.broadcast(load_merges(vocabulary))

    def encoder() -> Encoder:
        if vocabulary not in _encoders:
            _encoders[vocabulary] = Encoder(tables.value)
        return _encoders[vocabulary]

    return encoder


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)


#: Characters of text that are encoded at once.
BATCH_CHARS = 4_000_000


def _portions(b: pa.RecordBatch, last: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of a batch by the size of its texts."""
    texts = b.column(last).to_pylist()
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS or i + 1 == len(texts):
            yield b.slice(start, i + 1 - start), texts[start : i + 1]
            start, size = i + 1, 0


def token_ids(df: DataFrame, keys: list[str], text: str, vocabulary: str = VOCABULARY, out: str = "ids") -> DataFrame:
    """keys and ``out`` (array of int): the token ids of each text."""
    encoder = _shared(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _portions(b, len(keys)):
                ids = encoder().encode(texts)
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])
                yield pa.record_batch([*part.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*keys, out])

    return df.select(*keys, text).mapInArrow(run, _ddl(df, keys) + f"`{out}` array<int>")


def token_counts(df: DataFrame, keys: list[str], text: str, vocabulary: str = VOCABULARY, out: str = "tokens") -> DataFrame:
    """keys and ``out`` (long): the number of tokens of each text."""
    encoder = _shared(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _portions(b, len(keys)):
                yield pa.record_batch([*part.columns[:-1], pa.array(encoder().count(texts), pa.int64())], [*keys, out])

    return df.select(*keys, text).mapInArrow(run, _ddl(df, keys) + f"`{out}` long")
