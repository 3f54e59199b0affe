"""Benchmark passages in documents: spaced seeds, tolerant of substituted words.

A mask picks some of a run of words and ignores the others. Test items and documents are hashed through the
same masks at every place; equal hashes are hits. Around each hit the words of item and document are aligned without
gaps, and the longest stretch that begins and ends with equal words and has a share of ``identity`` equal words
is the overlap. It is reported from ``least`` words on. An item that is shorter must stand in the document whole
and unchanged, as so few words leave no room for a seed beside a substitution.

The masks of ``MASKS`` were searched so that every stretch of 13 words or more that begins and ends with equal words and
has a fifth substituted at most is hit by at least one of them, wherever the substitutions lie. Items that are shorter than the
longest mask get a seed of all their words instead, one kind for each length.

Documents are hashed in one pass. A Bloom filter of the items' hashes, whose size is fixed, goes to every task, so
that only places that probably match are written, with the words around them; false positives go in the exact
join that follows, and any number of items stays correct. A passage in a third of all documents gives that many
hits with few hashes, which the join spreads.

Words ignore case and punctuation. Items without a word match nothing, nor do null or empty texts; an item of one
word matches every document with that word, unless ``shortest`` asks for more words. Ties between alignments go to more equal words, then to the first place in
the item and in the document. Repeated rows of documents are one document, repeated rows of items one
item; ids may be null and are then null in the result. Tables without rows give none.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept
from momentloom.llm.words import mixed, run_sums, word_hashes

MASKS = ("1111011", "11001000111", "10101100011", "111011111")
LEAST = 13
IDENTITY = 0.8
#: Least number of words of an item.
SHORTEST = 1
#: Power of two that gives the bits of the filter, two megabytes, and bits set for each hash.
FILTER_BITS = 24
FILTER_HASHES = 3


@lru_cache(maxsize=64)
def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


#: Words from which on each mask fits an item.
FULL = max(map(len, MASKS))


def seeds(words: np.ndarray, lengths: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all masks at all places and of the runs of the given lengths, and the places."""
    codes = [run_sums(words, _offsets(m), seed=i) for i, m in enumerate(MASKS)]
    codes += [run_sums(words, list(range(n)), seed=len(MASKS) + n) for n in lengths]
    return np.concatenate(codes), np.concatenate([np.arange(len(c)) for c in codes])


def item_seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of an item: of the masks, or of all its words at once where it is shorter than the longest mask."""
    if len(words) >= FULL:
        return seeds(words)
    return run_sums(words, list(range(len(words))), seed=len(MASKS) + len(words)), np.zeros(1, dtype=np.int64)


def _bit(codes: np.ndarray, turn: int, power: int) -> np.ndarray:
    """The filter's bit for each hash at one turn; the first takes the hash as it is, as every place is asked for it."""
    spread = mixed(codes + np.uint64(turn)) if turn else codes
    return (spread >> np.uint64(64 - power)).astype(np.int64)


def _item_words(shortest: int):
    def words_of(batches):
        for batch in batches:
            words = [word_hashes(t or "").astype(np.int64) for t in batch["text"]]
            out = batch[["item", "ikey"]].assign(iwords=words)
            yield out[[len(w) >= shortest for w in words]].astype({"item": "Int64"})

    return words_of


def _item_seeds(batches):
    for batch in batches:
        for key, words in zip(batch["ikey"], batch["iwords"]):
            codes, places = item_seeds(np.asarray(words).astype(np.uint64))
            yield pd.DataFrame({"ikey": key, "code": codes.astype(np.int64), "iplace": places})


def _filter_of(codes: DataFrame, power: int) -> np.ndarray:
    """The Bloom filter of the items' hashes, put together from pages of bits: of one size whatever their number."""

    def set_bits(batches):
        for batch in batches:
            codes = batch["code"].to_numpy().astype(np.uint64)
            yield pd.DataFrame({"bit": np.unique(np.concatenate([_bit(codes, t, power) for t in range(FILTER_HASHES)]))})

    bits = codes.select("code").distinct().mapInPandas(set_bits, "bit long")
    pages = bits.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"))
    out = np.zeros(1 << (power - 3), dtype=np.uint8)
    # Pages hold 32,768 bits, lowest bit first, and are numbered from 1.
    for row in pages.collect():
        start = (row["page"] - 1) * 4096
        raw = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        out[start : start + len(raw)] |= raw
    return out


def _hits(filter_bits: np.ndarray, power: int, reach: int, lengths: tuple[int, ...]):
    """Hits of the filter, by the masks and by runs of the given lengths, with the words around them; hits whose surroundings overlap share a region."""

    def scan(batches):
        for batch in batches:
            for key, doc_id, text in zip(batch["key"], batch["doc_id"].astype("Int64"), batch["text"]):
                words = word_hashes(text or "")
                codes, places = seeds(words, lengths)
                if not len(codes):
                    continue
                for turn in range(FILTER_HASHES):  # few places pass the first bit
                    bits = _bit(codes, turn, power)
                    hit = np.flatnonzero((filter_bits[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1)
                    codes, places = codes[hit], places[hit]
                if not len(codes):
                    continue
                order = np.argsort(places, kind="stable")
                codes, places = codes[order], places[order]
                starts = np.r_[0, np.flatnonzero(np.diff(places) > 2 * reach) + 1]
                for begin, end in zip(starts, np.r_[starts[1:], len(places)]):
                    low, high = max(0, int(places[begin]) - reach), min(len(words), int(places[end - 1]) + reach)
                    yield pd.DataFrame({
                        "key": [key],
                        "doc_id": pd.Series([doc_id], dtype="Int64"),
                        "low": [low],
                        "words": [words[low:high].astype(np.int64)],
                        "codes": [codes[begin:end].astype(np.int64)],
                        "places": [places[begin:end]],
                    })

    return scan


def overlap(item: np.ndarray, doc: np.ndarray, shift: int, least: int, identity: float) -> tuple[int, int, int]:
    """Start in the item, length and equal words of the longest overlap where item word i meets doc word i + shift."""
    begin, end = max(0, -shift), min(len(item), len(doc) - shift)
    if end - begin < least:
        return 0, 0, 0
    equal = item[begin:end] == doc[begin + shift : end + shift]
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0, 0
    # A stretch from at[i] to at[j] has j - i + 1 equal words; it is long enough if equal - identity * length >= 0.
    gain = np.arange(len(at)) - identity * at
    low = np.minimum.accumulate(gain)
    first = np.searchsorted(-low, -(gain + 1 - identity) - 1e-9)
    length = at - at[first] + 1
    # The first longest stretch; equality of the share is meant to count, hence the small tolerance.
    best = int(length.argmax())
    if length[best] < least:
        return 0, 0, 0
    return begin + int(at[first[best]]), int(length[best]), best - int(first[best]) + 1


def demand(words: int, least: int, identity: float) -> tuple[int, float]:
    """Least length and share of equal words for an item of so many words."""
    return (least, identity) if words >= least else (words, 1.0)


def _verified(least: int, identity: float):
    def verify(batches):
        for batch in batches:
            rows = []
            columns = [batch[c] for c in ("item", "key", "doc_id", "ikey", "low", "shift", "iwords", "words")]
            for item, key, doc_id, ikey, low, shift, mine, theirs in zip(*columns):
                mine, theirs = np.asarray(mine), np.asarray(theirs)
                start, length, equal = overlap(mine, theirs, shift - low, *demand(len(mine), least, identity))
                if length:
                    rows.append((item, ikey, key, doc_id, len(mine), start, start + shift, length, equal))
            out = pd.DataFrame(rows, columns=["item", "ikey", "key", "doc_id", "n_item", "item_start", "doc_start", "n_words", "n_equal"])
            yield out.astype({"item": "Int64", "doc_id": "Int64"})

    return verify


def overlaps(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: int = LEAST, identity: float = IDENTITY, filter_bits: int = FILTER_BITS, shortest: int = SHORTEST) -> DataFrame:
    """One row for each document and item that overlap.

    ``doc_id, item_id, doc_key, n_item, item_start, doc_start, n_words, n_equal``: places and lengths in words.
    ``doc_key`` is a hash of id and text, by which rows of ``docs`` can be matched whatever their id.
    """
    source = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).distinct()
    source = source.withColumn("ikey", F.xxhash64("item", "text"))
    tests = kept(source.mapInPandas(_item_words(max(1, shortest)), "item long, ikey long, iwords array<long>"))
    sizes = F.size("iwords")
    # At most one length for each number of words below that of the longest mask.
    told = tests.agg(F.max(sizes).alias("reach"), F.collect_set(F.when(sizes < FULL, sizes)).alias("lengths")).first()
    reach, lengths = told["reach"] or 0, tuple(sorted(told["lengths"]))
    codes = kept(tests.select("ikey", "iwords").mapInPandas(_item_seeds, "ikey long, code long, iplace long"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", document_key("doc_id", "text").alias("key"), "text")
    scanned = rows.mapInPandas(_hits(_filter_of(codes, filter_bits), filter_bits, reach, lengths), "key long, doc_id long, low long, words array<long>, codes array<long>, places array<long>")
    regions = kept(scanned)
    hits = regions.select("key", "low", F.explode(F.arrays_zip("codes", "places")).alias("h")).select("key", "low", F.col("h.codes").alias("code"), F.col("h.places").alias("place"))
    met = hits.join(codes, "code")
    met = met.select("key", "low", "ikey", (F.col("place") - F.col("iplace")).alias("shift")).distinct()
    texts = regions.select("key", "doc_id", "low", "words").dropDuplicates(["key", "low"])
    pairs = met.join(tests, "ikey").join(texts, ["key", "low"])
    fields = "item long, ikey long, key long, doc_id long, n_item long, item_start long, doc_start long, n_words long, n_equal long"
    found = pairs.mapInPandas(_verified(least, identity), fields)
    rank = F.struct("n_words", "n_equal", (-F.col("item_start")).alias("i"), (-F.col("doc_start")).alias("d"))
    best = found.groupBy("key", "ikey").agg(F.first("doc_id").alias("doc_id"), F.first("item").alias("item_id"), F.first("n_item").alias("n_item"), F.max(rank).alias("r"))
    return best.select("doc_id", "item_id", F.col("key").alias("doc_key"), "n_item", (-F.col("r.i")).alias("item_start"), (-F.col("r.d")).alias("doc_start"), F.col("r.n_words").alias("n_words"), F.col("r.n_equal").alias("n_equal"))


def document_key(doc_id: str, text: str):
    """The hash that ``overlaps`` gives as ``doc_key``."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))
