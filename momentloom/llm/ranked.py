"""Ranked search: bit-sliced signatures give upper bounds of scores, documents not excluded by them are scored exactly.

A term is a run of digits, ASCII letters and characters beyond ASCII; only A to Z are lower-cased. The score of a document
for an item sums, over the item's terms with repeats, ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and ``m = 25 + (75 n N) div L``.

The signature of a document is a Bloom filter over pairs of a term and a level: level j of a term is set if the term
occurs 2**j times or more. Documents of a like number of pairs share a block, a matrix of one bitmap over its documents
for each bit of the filter (a slice). The bitmap of a pair is the conjunction of its slices; it holds all documents that have
the pair and a few that have not. Levels that hold up to j bound tf by 2**(j + 1) - 1, as scores grow with tf, so the
weighted sum of bitmaps bounds each score from above.

The search runs in three steps: the documents of the largest bounds are scored, the last of the best ``k`` of them is a floor
of the result, and all documents whose bound does not lie below the floor are scored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from momentloom.llm.common import kept
from momentloom.llm.words import mixed

#: Bits of a filter for each pair, at least; slices of a pair.
BITS, SLICES = 12, 4
#: Documents of a block at most, and bytes of its slices at most (one document at least).
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 20
#: Items and their distinct terms that are searched at once; one more item may go beyond the terms.
ITEMS_AT_ONCE, TERMS_AT_ONCE = 512, 16_384
#: Keys of candidates that a broadcast may hold; beyond that, the join shuffles.
BROADCAST_KEYS = 500_000

_TERM_BYTES = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.encode().lower().translate(_TERM_BYTES).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(n_terms: int, n_docs: int, n_all: int) -> int:
    """m of a document of ``n_terms`` terms."""
    return 25 + 75 * n_terms * n_docs // n_all


def part(tf: int, m: int) -> int:
    """What one occurrence of a term in an item counts before its weight."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class _Codes(dict):
    """Hashes by term, each computed when first asked for."""

    def __missing__(self, term: bytes) -> int:
        self[term] = code = xxhash.xxh3_64_intdigest(term)
        return code


def _at_level(codes: np.ndarray, level: int) -> np.ndarray:
    """Hashes of the pairs of terms and a level."""
    return mixed(codes + np.uint64(level))


def _slices(codes: np.ndarray, size: int) -> np.ndarray:
    """For each pair, the ``SLICES`` bits of a filter of ``size`` bits (a power of two)."""
    low, high = codes & np.uint64(0xFFFFFFFF), (codes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(SLICES, dtype=np.uint64)
    return ((low[:, None] + high[:, None] * steps) & np.uint64(size - 1)).astype(np.int32)


def _filter_size(n_pairs: int) -> int:
    return 1 << max(8, (n_pairs * BITS - 1).bit_length())


SIGNATURES = "size long, n_rows long, keys array<long>, ids array<long>, lengths array<long>, slices binary"


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known, waiting = _Codes(), {}

    def block(size: int, docs: list[tuple]) -> pd.DataFrame:
        width = -(-len(docs) // 8)
        bits = np.zeros((size, width * 8), dtype=bool)
        for i, (*_, places) in enumerate(docs):
            bits[places, i] = True
        keys, ids, lengths, _ = zip(*docs)
        return pd.DataFrame({"size": [size], "n_rows": [len(docs)], "keys": [list(keys)], "ids": [list(ids)], "lengths": [list(lengths)], "slices": [np.packbits(bits, axis=1).tobytes()]})

    for batch in batches:
        for key, doc, text in zip(batch["key"].tolist(), batch["doc"].tolist(), batch["text"]):
            found = terms(text)
            if not found:
                continue
            counts = Counter(found)
            codes = np.fromiter(map(known.__getitem__, counts), dtype=np.uint64, count=len(counts))
            times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
            codes = np.concatenate([_at_level(codes[times >= 1 << level], level) for level in range(int(times.max()).bit_length())])
            size = _filter_size(len(codes))
            if len(known) > 200_000:
                known.clear()
            docs = waiting.setdefault(size, [])
            docs.append((key, doc, len(found), _slices(codes, size).ravel()))
            if len(docs) >= min(BLOCK_ROWS, max(8, BLOCK_BYTES * 8 // size)):
                yield block(size, waiting.pop(size))
    for size, docs in waiting.items():
        yield block(size, docs)


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Blocks of bit-sliced signatures of all documents with a term, on shared storage.

    ``keys`` are hashes of id and text, ``ids`` the ids (a null id is the largest long, so it comes last among equals).
    """
    return kept(_rows(docs, doc_id, text).mapInPandas(_sign, SIGNATURES))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    last = F.lit((1 << 63) - 1)
    return docs.select(F.xxhash64(doc_id, text).alias("key"), F.coalesce(F.col(doc_id).cast("long"), last).alias("doc"), F.col(text).alias("text"))


def _counted(wanted: dict[bytes, int]):
    """Documents with terms, their terms, and the documents of each wanted term, summed over a task."""
    names = set(wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n_docs, n_all, df = 0, 0, Counter()
        for batch in batches:
            for text in batch["text"]:
                found = terms(text)
                n_docs += len(found) > 0
                n_all += len(found)
                df.update(names.intersection(found))
        yield pd.DataFrame({"term": [-2, -1, *(wanted[t] for t in df)], "n": [n_docs, n_all, *df.values()]})

    return run


class _Items:
    """A block of items: terms by number, each item's terms with repeats, and weights once the counts are known."""

    def __init__(self, rows: list[tuple]):
        self.keys = [key for key, _ in rows]
        counts = [Counter(terms(text)) for _, text in rows]
        self.terms = sorted(set(chain.from_iterable(counts)))
        self.codes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], dtype=np.uint64)
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.parts = [[(self.number[t], c) for t, c in count.items()] for count in counts]

    def weighed(self, counts: dict[int, int]) -> None:
        self.n_docs, self.n_all = counts.get(-2, 0), counts.get(-1, 0)
        self.weights = [weight(self.n_docs, counts.get(i, 0)) for i in range(len(self.terms))]
        self.uses = np.zeros((len(self.parts), len(self.terms)), dtype=np.float64)
        for i, parts in enumerate(self.parts):
            for t, c in parts:
                self.uses[i, t] = c
        # Sums of integers are exact in doubles below 2**53; beyond, they are taken in 64-bit integers.
        top = max((sum(c * self.weights[t] for t, c in p) for p in self.parts), default=0) * 1_000_000
        if top >= 1 << 53:
            self.uses = self.uses.astype(np.int64)


def _bounds(block, items: _Items) -> np.ndarray:
    """Upper bounds of the scores, items by documents of the block."""
    size, n, lengths = block["size"], block["n_rows"], np.asarray(block["lengths"], dtype=np.int64)
    slices = np.frombuffer(block["slices"], dtype=np.uint8).reshape(size, -1)
    m = np.array([damping(x, items.n_docs, items.n_all) for x in lengths.tolist()], dtype=np.int64)
    out = np.zeros((len(items.terms), n), dtype=items.uses.dtype)
    weights = np.array(items.weights, dtype=np.int64)
    open_terms, level = np.arange(len(items.terms)), 0
    alive = np.full((len(items.terms), slices.shape[1]), 255, dtype=np.uint8)
    while len(open_terms):
        places = _slices(_at_level(items.codes[open_terms], level), size)
        bitmap = alive
        for s in range(SLICES):
            bitmap = bitmap & slices[places[:, s]]
        some = bitmap.any(axis=1)
        open_terms, alive = open_terms[some], bitmap[some]
        # A term of the level holds 2**(level + 1) - 1 times at most, and no more often than the document has terms.
        tf = np.minimum((2 << level) - 1, lengths)
        value = 1_000_000_000 * tf // (1000 * tf + 8 * m)
        row, column = np.nonzero(np.unpackbits(alive, axis=1, count=n))
        out[open_terms[row], column] = weights[open_terms[row]] * value[column]
        level += 1
    return items.uses @ out


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_dict("records")


def _best_bounds(items: _Items, k: int):
    """The ``k`` documents of largest bounds of each item, by task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[] for _ in items.parts]
        for block in _blocks(batches):
            bounds = _bounds(block, items)
            for i, row in enumerate(bounds):
                chosen = np.argpartition(-row, k)[:k] if len(row) > k else np.arange(len(row))
                best[i] = sorted([*best[i], *((-int(row[j]), int(block["ids"][j]), int(block["keys"][j])) for j in chosen if row[j] > 0)])[:k]
        yield pd.DataFrame([(i, -b, d, key) for i, rows in enumerate(best) for b, d, key in rows], columns=["item", "bound", "doc", "key"])

    return run


def _not_excluded(items: _Items, floors: dict[int, tuple[int, int]]):
    """Items and keys whose bound reaches the floor of the item, or is above 0 where an item has no floor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            bounds, ids, keys = _bounds(block, items), np.asarray(block["ids"], dtype=np.int64), np.asarray(block["keys"], dtype=np.int64)
            found = np.zeros(bounds.shape, dtype=bool)
            for i, row in enumerate(bounds):
                score, doc = floors.get(i, (0, -1))
                found[i] = (row > score) | ((row == score) & (score > 0) & (ids <= doc))
            columns = np.flatnonzero(found.any(axis=0))
            if len(columns):
                yield pd.DataFrame({"key": keys[columns], "items": [np.flatnonzero(found[:, c]).tolist() for c in columns]})

    return run


def _scored(items: _Items, k: int):
    """Exact scores above 0 of candidates, the best ``k`` rows of each item and task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[] for _ in items.parts]
        for batch in batches:
            for doc, text, wanted in zip(batch["doc"].tolist(), batch["text"], batch["items"]):
                found = terms(text)
                counts = Counter(found)
                m = damping(len(found), items.n_docs, items.n_all)
                for i in wanted:
                    score = sum(c * items.weights[t] * part(counts[items.terms[t]], m) for t, c in items.parts[i] if items.terms[t] in counts)
                    if score > 0:
                        best[i].append((-score, doc))
                        if len(best[i]) >= 8 * k + 64:
                            best[i] = sorted(best[i])[:k]
        yield pd.DataFrame([(i, -s, d) for i, rows in enumerate(best) for s, d in sorted(rows)[:k]], columns=["item", "score", "doc"])

    return run


def _best(found: DataFrame, k: int, value: str) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc(value), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(rows: DataFrame, signed: DataFrame, items: _Items, k: int) -> DataFrame:
    counts = rows.select("text").mapInPandas(_counted(items.number), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    items.weighed({r["term"]: r["n"] for r in counts.collect()})

    def score(candidates: DataFrame) -> DataFrame:
        small = F.broadcast(candidates) if candidates.count() <= BROADCAST_KEYS else candidates
        pairs = rows.join(small, "key").select("doc", "text", "items")
        return kept(_best(pairs.mapInPandas(_scored(items, k), "item long, score long, doc long"), k, "score"))

    first = _best(signed.mapInPandas(_best_bounds(items, k), "item long, bound long, doc long, key long"), k, "bound")
    # k rows of each item of the block.
    scored = score(kept(first.groupBy("key").agg(F.collect_set("item").alias("items"))))
    floors = {r["item"]: (r["score"], r["doc"]) for r in scored.where(F.col("rank") == k).collect()}
    rest = signed.mapInPandas(_not_excluded(items, floors), "key long, items array<long>").distinct()
    return score(kept(rest.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))))


def _item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Distinct items with a term, some at a time."""
    block, n_terms = [], 0
    for row in items.select(F.col(item_id).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct().toLocalIterator():
        n = len(set(terms(row["text"])))
        if n:
            block.append((row["key"], row["text"]))
            n_terms += n
        if len(block) >= ITEMS_AT_ONCE or n_terms >= TERMS_AT_ONCE:
            yield block
            block, n_terms = [], 0
    if block:
        yield block


def search(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every item, scores above 0 only.

    Equal scores rank by ascending id, null ids last. Null and empty texts have no terms: such documents are none of the
    N and such items have no rows. Repeated rows of documents are documents of their own and fill ranks of their own; items
    repeated in id and text count once. Items are searched in blocks, each against all documents. Empty tables give empty
    results; other columns are not looked at.
    """
    rows, signed = _rows(docs, doc_id, text), None
    spark, last = docs.sparkSession, (1 << 63) - 1
    out = None
    for block in _item_blocks(items, item_id, item_text):
        signed = signatures(docs, doc_id, text) if signed is None else signed
        found = _Items(block)
        names = spark.createDataFrame(list(enumerate(found.keys)), f"item long, item_id {items.schema[item_id].dataType.simpleString()}")
        best = _searched(rows, signed, found, k).join(F.broadcast(names), "item")
        best = best.select("item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc") != last, F.col("doc")).alias("doc_id"), "score")
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, doc_id long, score long")
    return out
