"""Repeated byte strings: bytes of texts that lie in a string of given length which starts at a second place too.

The strings are found by common prefixes of suffixes: a batch of texts is turned into its Burrows-Wheeler transform,
whose intervals are extended backwards, breadth first. The strings of length l that end a run of equal suffixes give
the places where neighbouring suffixes share l - 1 bytes; the expansion stops at the threshold, and neighbours that have
no value by then share that many bytes or more.

Texts meet in a batch through content: the windows of ``length`` bytes of a text are cut into parts, each a run of
windows with the same least hash of a string of ``grain`` bytes. Equal windows have equal least hashes, so every window belongs to one part, and all
windows equal to it lie in parts of the same hash. Only hashes that several parts have, or one part more than once, are
looked at, and their parts go through the transform, equal ones twice however many they are. Groups under one hash that would not fit a task are cut again
by a longer grain; at ``grain = length`` the parts of a group are equal windows, and counting them decides. No group is too
large for that, and none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, splittable, stored
from momentloom.llm.graph import whole_groups
from momentloom.llm.words import mixed

#: A text is hashed in slices of this many window starts, which bounds memory, not results.
SLICE = 1 << 17
#: Bytes of the parts under one hash, equal ones counted twice, beyond which the group is cut by the next grain.
GROUP_BYTES = 400_000
#: Bytes of a batch, with the groups that fill it, are under ``2**SPOT_BITS``.
BATCH = 600_000
SPOT_BITS = 20

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def _string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the string of ``size`` bytes at each place of a slice."""
    n, room = len(data) - size + 1, SLICE + (len(data) // SLICE) * SLICE
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODES[data] * _powers(_FACTOR, room)[: len(data)], out=sums[1:])
    return mixed((sums[size:] - sums[:n]) * _powers(_INVERSE, room)[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if width == 1:
        return values
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def parts(text: bytes, length: int, grain: int) -> Iterator[tuple[int, int, bool, int, int]]:
    """``start, size, again, least hash, hash of the bytes`` of the parts of a text; each holds size - length + 1 windows.

    ``again`` tells that the least string occurs a second place behind the first window that starts with it. Windows of one
    part can be equal only then.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    view = memoryview(text)
    windows = len(data) - length + 1
    for low in range(0, windows, SLICE):
        high = min(low + SLICE, windows)
        hashes = _string_hashes(data[low : high + length - 1], grain)
        least = _least(hashes, length - grain + 1)
        differs = least[1:] != least[:-1]
        starts = np.concatenate([[0], np.flatnonzero(differs) + 1])
        again = np.zeros(len(least), dtype=bool)
        again[:-1] = (hashes[: len(least) - 1] == least[:-1]) & ~differs
        again = np.logical_or.reduceat(again, starts).tolist()
        codes = least[starts].view(np.int64).tolist()
        starts = (starts + low).tolist()
        for start, end, more, code in zip(starts, [*starts[1:], high], again, codes):
            size = end - start + length - 1
            yield start, size, more, code, xxhash.xxh3_64_intdigest(view[start : start + size]) - (1 << 63)


def _sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes, which is right for the first ``depth`` symbols at least."""
    n, bits = len(symbols), SPOT_BITS
    place = np.arange(n, dtype=np.uint64)
    ahead = np.zeros(n + 4, dtype=np.uint64)
    ahead[:n] = symbols
    order = (ahead[:n] << np.uint64(27)) | (ahead[1 : n + 1] << np.uint64(18)) | (ahead[2 : n + 2] << np.uint64(9)) | ahead[3 : n + 3]
    done, spots = 4, np.uint64((1 << bits) - 1)
    while True:
        packed = np.sort((order << np.uint64(bits)) | place)
        places = (packed & spots).astype(np.int32)
        keys = packed >> np.uint64(bits)
        new = np.empty(n, dtype=bool)
        new[0], new[1:] = True, keys[1:] != keys[:-1]
        ranks = np.cumsum(new)
        if done >= depth or ranks[-1] == n:
            return places
        order = np.zeros(n, dtype=np.uint64)
        order[places] = ranks
        second = np.zeros(n, dtype=np.uint64)
        second[: n - done] = order[done:]
        order = (order << np.uint64(bits + 1)) | second
        done *= 2


class _Wavelets:
    """A wavelet matrix over the transform: which symbols stand before the suffixes of an interval, and the
    intervals of the strings extended by them."""

    def __init__(self, transform: np.ndarray):
        n = len(transform)
        self.bits = max(1, int(transform.max()).bit_length())
        self.zeros, rows = [], transform
        starts = np.zeros(1 << self.bits, dtype=np.int32)
        for bit in range(self.bits - 1, -1, -1):
            one = (rows >> bit) & 1 == 1
            before = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            which = (np.arange(1 << self.bits) >> bit) & 1 == 1
            starts = np.where(which, before[n] + starts - before[starts], before[starts]).astype(np.int32)
            rows = np.concatenate([rows[~one], rows[one]])
        counts = np.bincount(transform, minlength=1 << self.bits)
        self.shift = (np.cumsum(counts) - counts - starts).astype(np.int32)

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of all one-symbol extensions to the left, without those by the separator (symbol 0)."""
        symbol = np.zeros(len(low), dtype=np.int32)
        for before in self.zeros:
            n_zeros = before[-1]
            low0, high0 = before[low], before[high]
            low1, high1 = n_zeros + low - low0, n_zeros + high - high0
            zero, one = high0 > low0, high1 > low1
            low, high = np.concatenate([low0[zero], low1[one]]), np.concatenate([high0[zero], high1[one]])
            symbol = np.concatenate([symbol[zero] * 2, symbol[one] * 2 + 1])
        real = symbol > 0
        shift = self.shift[symbol[real]]
        return low[real] + shift, high[real] + shift


def _repeated_starts(texts: list[bytes], length: int) -> np.ndarray:
    """Places in the texts, each followed by one separator, whose window occurs at a second place."""
    data = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    symbols = np.unique(data, return_inverse=True)[1].astype(np.int32) + 1
    symbols[ends] = 0
    n = len(symbols)
    places = _sorted_suffixes(symbols, length)
    wavelets = _Wavelets(symbols[places - 1])
    unknown = np.ones(n + 1, dtype=bool)
    unknown[0] = unknown[n] = False
    low, high = np.zeros(1, dtype=np.int32), np.full(1, n, dtype=np.int32)
    for _ in range(length):
        low, high = wavelets.extended(low, high)
        first = unknown[high]
        low, high = low[first], high[first]
        unknown[high] = False
        if not len(low):
            break
    inside = np.zeros(n, dtype=bool)
    for text, end in zip(texts, ends):
        inside[end - len(text) : max(end - length + 1, end - len(text))] = True
    inside = inside[places]
    same = unknown[1:n] & inside[1:] & inside[:-1]
    again = np.zeros(n, dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    return np.sort(places[again])


def spans_of_starts(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes for the sorted starts of windows."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), (starts[np.concatenate([cut, [len(starts) - 1]])] + length).tolist()))


def repeated_spans(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each text, the maximal runs of bytes that lie in a window which starts at a second place in any of them."""
    found = _repeated_starts(texts, length)
    bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
    cuts = np.searchsorted(found, bounds)
    return [spans_of_starts(found[a:b] - bounds[i], length) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def _cut(length: int, grain: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["a", "b", "weight", "start", "size", "again", "code", "digest"]
        for batch in batches:
            rows = []
            for a, b, weight, text in zip(batch["a"], batch["b"], batch["weight"], batch["bytes"]):
                if text is None or len(text) < length:
                    continue
                for row in parts(text, length, grain):
                    rows.append((a, b, weight, *row))
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            yield pd.DataFrame(rows, columns=names)

    return run


def _compared(length: int):
    """Batches of whole groups through the transform."""

    def judged(rows: list[pd.DataFrame]) -> pd.DataFrame:
        found = pd.concat(rows, ignore_index=True) if len(rows) > 1 else rows[0]
        spans = repeated_spans(found["bytes"].tolist(), length)
        out = pd.DataFrame({"code": found["code"], "digest": found["digest"], "spans": [[{"low": x, "high": y} for x, y in s] for s in spans]})
        return out[[len(s) > 0 and w == 1 for s, w in zip(spans, found["weight"])]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size = [], 0
        for group in whole_groups(batches, ["code"]):
            n = int((group["bytes"].str.len() + 1).sum())
            if waiting and size + n > BATCH:
                yield judged(waiting)
                waiting, size = [], 0
            waiting.append(group)
            size += n
        if waiting:
            yield judged(waiting)

    return run


SPANS = "array<struct<low:long,high:long>>"


def _grains(length: int) -> list[int]:
    """Lengths of the strings whose least hash deals the windows out: short at first, the whole window at last."""
    return sorted({max(1, length * 4 // 25), max(1, length * 16 // 25), max(1, length * 49 // 50), length})


def _spans(texts: DataFrame, length: int, grains: list[int]) -> DataFrame:
    """``a, b, spans`` of the texts ``a, b, weight, bytes`` that hold repeated windows; spans are relative, not merged."""
    schema = "a long, b long, weight long, start long, size long, again boolean, code long, digest long"
    places = stored(texts.select("a", "b", "weight", "bytes").mapInPandas(_cut(length, grains[0]), schema))
    shared = splittable(places.groupBy("code").agg(F.sum("weight").alias("n"), F.max("again").alias("inner")).where("n > 1 or inner").select("code"))
    places = stored(places.join(shared, "code"))
    classes = kept(places.groupBy("code", "digest").agg(F.sum("weight").alias("weight"), F.max("again").alias("again"), F.min(F.struct("a", "b", "start", "size")).alias("one")).select("code", "digest", "weight", "again", "one.*"))
    entire = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("size").alias("high")))
    if len(grains) == 1:
        found = classes.where("weight > 1 or again").select("code", "digest", entire.alias("spans"))
    else:
        found = classes.where("weight > 1").select("code", "digest", entire.alias("spans"))
        single = F.col("weight") == 1
        groups = classes.groupBy("code").agg(F.count("*").alias("texts"), F.max(single & F.col("again")).alias("inner"), F.max(single).alias("open"), F.sum(F.col("size") + 1).alias("total"))
        groups = splittable(groups.where("open and (texts > 1 or inner)").select("code", "total"))
        known = kept(classes.drop("again").join(groups, "code"))
        cut = F.substring(F.col("bytes"), (F.col("start") + 1).cast("int"), F.col("size").cast("int"))
        pieces = known.join(texts.select("a", "b", "bytes"), ["a", "b"]).select("a", "b", "code", "digest", "weight", "total", cut.alias("bytes"))
        pieces = pieces.dropDuplicates(["a", "b", "code", "digest"]).drop("a", "b")
        fits = F.col("total") <= GROUP_BYTES
        some_large = not known.where(~fits).isEmpty()
        if some_large:
            pieces = stored(pieces)  # read twice: the texts, which are far larger, are dealt once
        rows = pieces.where(fits).select("code", "digest", "weight", "bytes").repartition("code").sortWithinPartitions("code")
        found = found.unionByName(rows.mapInPandas(_compared(length), f"code long, digest long, spans {SPANS}"))
        if some_large:
            large = kept(pieces.where(~fits).select(F.col("code").alias("a"), F.col("digest").alias("b"), "weight", "bytes"))
            again = _spans(large, length, grains[1:])
            found = found.unionByName(again.select(F.col("a").alias("code"), F.col("b").alias("digest"), "spans"))
    marked = places.select("a", "b", "start", "code", "digest").join(splittable(found), ["code", "digest"])
    moved = F.transform("spans", lambda s: F.struct((s["low"] + F.col("start")).alias("low"), (s["high"] + F.col("start")).alias("high")))
    return marked.select("a", "b", moved.alias("spans")).groupBy("a", "b").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _merged(spans: Column) -> Column:
    """Maximal runs of spans that overlap or touch, in order."""
    empty = F.array().cast(SPANS)
    joined = lambda out, s: F.concat(
        F.slice(out, 1, F.size(out) - 1),
        F.array(F.struct(F.element_at(out, -1)["low"].alias("low"), F.greatest(F.element_at(out, -1)["high"], s["high"]).alias("high"))),
    )
    step = lambda out, s: F.when((F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["high"] >= s["low"]), joined(out, s)).otherwise(F.concat(out, F.array(s)))
    return F.aggregate(F.array_sort(spans), empty, step)


def mark_repeats(docs: DataFrame, doc_id: str, text: str, length: int = 400) -> DataFrame:
    """Every row as ``doc_id``, ``bytes`` (the text in UTF-8) and ``spans``: its bytes covered by repeated strings of ``length``.

    ``spans`` are maximal runs (low, high), high exclusive, in order, with gaps between them. A null text is empty; a text
    shorter than ``length`` has none. Rows with the same id and text are documents of their own: each repeats the other, and
    both get the same spans. Null ids stay null. Empty tables give empty results; other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    rows = rows.select("doc_id", "bytes", F.xxhash64("doc_id", "bytes").alias("a"), F.xxhash64("bytes", "doc_id", F.lit(length)).alias("b"))
    found = _spans(rows.withColumn("weight", F.lit(1).cast("long")), length, _grains(length))
    found = splittable(found.select("a", "b", _merged(F.col("spans")).alias("spans")))
    joined = rows.join(found, ["a", "b"], "left")
    return joined.select("doc_id", "bytes", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def without_spans(data: Column, spans: Column) -> Column:
    """The bytes outside the spans of ``mark_repeats``, concatenated."""
    n = F.octet_length(data).cast("long")
    edge = lambda low, high: F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))
    ends = F.concat(F.array(edge(F.lit(0), F.lit(0))), spans, F.array(edge(n, n)))
    gaps = F.transform(
        F.sequence(F.lit(1), F.size(ends) - 1),
        lambda i: F.hex(F.substring(data, (F.element_at(ends, i)["high"] + 1).cast("int"), (F.element_at(ends, i + 1)["low"] - F.element_at(ends, i)["high"]).cast("int"))),
    )
    return F.unhex(F.array_join(gaps, ""))
