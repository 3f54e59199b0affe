"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

``encode(text, path)`` gives the token ids of a text as an array, ``decode(ids, path)`` the text of ids. Both
are column functions, so the other columns of a table stay as they are, whatever their names.

Each piece of text that the pre-tokenizer cuts off is a row of a matrix: its bytes are the leaves of a tree
whose inner nodes hold the least ``rank * width + position`` below them. The root therefore names the leftmost
pair of the lowest rank. A merge changes three leaves and the nodes above them, which takes logarithmic time;
it goes on until the root says that no pair can be merged. All rows of the matrix take their next merge
together, as NumPy operations.

Null texts give null (the query takes null for the empty text), empty texts an empty array. Repeated rows are
encoded alike, tables without rows give none, and texts of any length are encoded whole. Null ids decode to
null; ids outside the vocabulary are an error.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

# The pre-tokenizer's pattern and the characters that stand for bytes in the file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Cells of one matrix of trees, and pieces remembered by a worker between batches. Neither changes a result.
CELLS = 1 << 21
REMEMBERED = 150_000
NONE = np.iinfo(np.int64).max


def _bytes_of_characters() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizer:
    """A vocabulary with its merges, read from a file in the JSON format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        to_byte = _bytes_of_characters()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens: dict[int, bytes] = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        self.tokens.update({i: t.encode() for t, i in self.special.items()})
        by_byte = {to_byte[t]: i for t, i in vocab.items() if len(t) == 1}
        self.first = np.array([by_byte[b] for b in range(256)], dtype=np.int64)
        self.span = max(self.tokens) + 1
        keys = np.array([vocab[a] * self.span + vocab[b] for a, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.pieces = regex.compile(PIECES)
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NONE where it is not in the vocabulary. Ids below 0 stand for no token."""
        key = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NONE)

    def _merge(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of at most ``width`` bytes, one after another, and how many each has."""
        n = len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        place = np.arange(width)
        inside = place < lengths[:, None]
        ids = np.full((n, width), -1, dtype=np.int64)
        ids[inside] = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        after = np.where(place + 1 < lengths[:, None], place + 1, -1)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        if width > 1:
            rank = self.rank_of(ids[:, :-1], ids[:, 1:])
            tree[:, width : 2 * width - 1] = np.where(rank == NONE, NONE, rank * width + place[:-1])
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root % width
            gone = after[rows, at]
            ids[rows, at] = self.merged[root // width]
            ids[rows, gone] = -1
            follow, lead = after[rows, gone], before[rows, at]
            after[rows, at] = follow
            some = follow >= 0
            before[rows[some], follow[some]] = at[some]
            here = self.rank_of(ids[rows, at], np.where(some, ids[rows, follow], -1))
            left = self.rank_of(np.where(lead >= 0, ids[rows, lead], -1), ids[rows, at])
            tree[rows, width + gone] = NONE
            tree[rows, width + at] = np.where(here == NONE, NONE, here * width + at)
            led = lead >= 0
            tree[rows[led], width + lead[led]] = np.where(left == NONE, NONE, left * width + lead)[led]
            node = width + np.stack([np.where(led, lead, at), at, gone], axis=1)
            line = rows[:, None]
            while node[0, 0] > 1:
                node >>= 1
                tree[line, node] = np.minimum(tree[line, 2 * node], tree[line, 2 * node + 1])
            rows = rows[tree[rows, 1] != NONE]
        alive = ids >= 0
        return ids[alive], alive.sum(axis=1)

    def _learn(self, words: list[str]) -> None:
        """Add the ids of new words to those remembered."""
        raw = [w.encode() for w in words]
        widths = np.array([1 << max(0, len(w) - 1).bit_length() for w in raw])
        flat, start, length = [self.flat], np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        at = len(self.flat)
        for width in np.unique(widths):
            chosen, step = np.flatnonzero(widths == width), max(1, CELLS // int(width))
            for i in range(0, len(chosen), step):
                part = chosen[i : i + step]
                ids, counts = self._merge([raw[k] for k in part], int(width))
                flat.append(ids.astype(np.int32))
                start[part] = at + np.cumsum(counts) - counts
                length[part] = counts
                at += len(ids)
        for w in words:
            self.slot[w] = len(self.slot)
        self.flat = np.concatenate(flat)
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text; special tokens are recognised where their text stands."""
        if len(self.slot) > REMEMBERED:
            self._forget()
        cut = []
        for text in texts:
            parts = self.marks.split(text) if self.marks else [text]
            words = []
            for part in parts:
                words += [part] if part in self.special else self.pieces.findall(part)
            cut.append(words)
        for mark, i in self.special.items():
            if mark not in self.slot:
                self.slot[mark] = len(self.slot)
                self.start = np.append(self.start, len(self.flat))
                self.length = np.append(self.length, 1)
                self.flat = np.append(self.flat, np.int32(i))
        new = list(dict.fromkeys(w for words in cut for w in words if w not in self.slot))
        if new:
            self._learn(new)
        out = []
        for words in cut:
            slots = np.fromiter(map(self.slot.__getitem__, words), dtype=np.int64, count=len(words))
            lengths = self.length[slots]
            ends = np.cumsum(lengths)
            shift = np.repeat(self.start[slots] - (ends - lengths), lengths)
            out.append(self.flat[shift + np.arange(len(shift))])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, read once in each worker."""
    return Tokenizer(path)


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column as ``array<int>``. ``path`` must be readable on every executor."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        known = texts.notna().to_numpy()
        found = iter(tokenizer(path).encode(texts[known].tolist()))
        return pd.Series([next(found) if k else None for k in known], dtype=object)

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of a column of token ids."""

    @F.pandas_udf(StringType())
    def text(series: pd.Series) -> pd.Series:
        t = tokenizer(path)
        return pd.Series([None if x is None else t.decode(np.asarray(x, dtype=np.int64)) for x in series], dtype=object)

    return text(ids)
