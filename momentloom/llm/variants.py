"""Spelling variants: words one inserted, deleted or replaced letter apart, grouped under their most frequent form.

One edit changes the vector of letter counts by one letter less, one more, or both. Words of each length are dealt to the
cells of a k-d tree over these vectors, and a word is sent as a query to all cells of its own length and of both
neighbouring lengths whose box such an edit can reach. In a cell, a further tree over its own words is pruned by the boxes of its
leaves, and pairs with counts near enough are compared letter by letter.

The upper tree is cut by a bounded sample of the words. It only deals words out: every word has exactly one cell, every
box that can hold a near word is searched, whatever the sample. A cell with many words is dealt over several tasks, each with
a part of the words and all queries of the cell.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, splittable
from momentloom.llm.graph import whole_groups

RUN = re.compile("[a-zÀ-ÿ]+")
#: Letters of words are these, each a place of the vector of counts.
LETTERS = np.concatenate([np.arange(ord("a"), ord("z") + 1), np.arange(0xC0, 0x100)])
_PLACE = np.zeros(0x100, dtype=np.int64)
_PLACE[LETTERS] = np.arange(len(LETTERS))

#: Words of which the upper tree is cut, and how many of all words a cell shall have.
SAMPLE, CELL = 100_000, 2_000
#: Words of a cell beyond which it is dealt over several tasks.
PART = 8_000
#: Words of a leaf in a cell.
LEAF = 12
#: Numbers that an array may hold when vectors or words are compared.
AT_ONCE = 8_000_000
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000


def runs_of(text: str) -> Counter:
    """How often each maximal run of letters occurs, A to Z lower-cased."""
    return Counter(RUN.findall(text.encode().lower().decode()))


def _spelled(every: int, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, crc32 = defaultdict(int), zlib.crc32
        out = lambda: pd.DataFrame({"word": list(counts), "n": list(counts.values())}, columns=["word", "n"])
        for batch in batches:
            for doc, text in zip(batch["doc"], batch["text"]):
                if not text:
                    continue
                start = crc32(f"{doc}:".encode())
                for word, n in runs_of(text).items():
                    # Leaving a letter out makes no word longer.
                    if len(word) < least:
                        continue
                    if every and not (code := crc32(word.encode(), start)) % every:
                        at = code % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    counts[word] += n
                if len(counts) >= COUNTED:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return run


def vocabulary(docs: DataFrame, doc_id: str, text: str, every: int = 199, least: int = 6, seen: int = 5) -> DataFrame:
    """``word, n`` of the words of at least ``least`` letters that occur ``seen`` times or more in all texts.

    Of a run whose hash with the id is divisible by ``every`` one letter is left out (none if ``every`` is 0). A null text has no
    words; a null id counts as an empty one. Repeated rows count as often as they stand.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text"))
    counted = rows.mapInPandas(_spelled(every, least), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def vectors(rows: np.ndarray) -> np.ndarray:
    """The letter counts of rows of letters."""
    n, length = rows.shape
    kind = np.int8 if length < 127 else np.int32
    out = np.empty((n, len(LETTERS)), dtype=kind)
    step = max(1, AT_ONCE // max(length, len(LETTERS)))
    for low in range(0, n, step):
        some = rows[low : low + step]
        at = _PLACE[some] + np.arange(len(some))[:, None] * len(LETTERS)
        out[low : low + step] = np.bincount(at.ravel(), minlength=len(some) * len(LETTERS)).reshape(len(some), -1)
    return out


def _halves(counts: np.ndarray) -> tuple[int, int] | None:
    """The place and the bound (counts up to it go left) that cut the vectors most evenly; None if all are equal."""
    n, best = len(counts), None
    for place in np.flatnonzero(counts.min(axis=0) < counts.max(axis=0)).tolist():
        tally = np.cumsum(np.bincount(counts[:, place]))
        bound = int(np.abs(2 * tally[:-1] - n).argmin())
        off = abs(2 * int(tally[bound]) - n)
        if best is None or off < best[0]:
            best = off, place, bound
    return best and best[1:]


def upper_tree(counts: np.ndarray, leaf: int, first: int) -> tuple:
    """Nested ``place, bound, left, right``, or the number of a cell, counted from ``first``."""
    cut = _halves(counts) if len(counts) > leaf else None
    if cut is None:
        return (first,)
    left = counts[:, cut[0]] <= cut[1]
    below = upper_tree(counts[left], leaf, first)
    return (*cut, below, upper_tree(counts[~left], leaf, first + _cells(below)))


def _cells(tree: tuple) -> int:
    return 1 if len(tree) == 1 else _cells(tree[2]) + _cells(tree[3])


def reached(tree: tuple, counts: np.ndarray, gains: int, losses: int) -> Iterator[tuple[int, np.ndarray]]:
    """Cells and the rows that come into their box by ``gains`` letters more and ``losses`` letters less at most."""
    open_boxes = [(tree, np.arange(len(counts)), np.zeros(len(counts), dtype=np.int64), np.zeros(len(counts), dtype=np.int64), {})]
    while open_boxes:
        node, rows, more, less, moved = open_boxes.pop()
        if len(node) == 1:
            yield node[0], rows
            continue
        place, bound, below, above = node
        # What is needed of a letter counts once, for the narrowest box: ``moved`` is what it took so far.
        values = counts[rows, place].astype(np.int64)
        up, down = moved.get(place, (np.zeros(len(rows), dtype=np.int64),) * 2)
        need_up, need_down = np.maximum(up, bound + 1 - values), np.maximum(down, values - bound)
        for child, new_up, new_down in ((below, up, need_down), (above, need_up, down)):
            new_more, new_less = more + new_up - up, less + new_down - down
            ok = (new_more <= gains) & (new_less <= losses)
            if ok.any():
                kept_moves = {p: (u[ok], d[ok]) for p, (u, d) in moved.items()} | {place: (new_up[ok], new_down[ok])}
                open_boxes.append((child, rows[ok], new_more[ok], new_less[ok], kept_moves))


def _dealt(trees: dict[int, tuple]):
    """Every word as a point of its own cell and as a query of the cells that it reaches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, times = batch["word"].to_numpy(), batch["n"].to_numpy()
            sizes = batch["word"].str.len().to_numpy()
            for size in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == size)
                counts = vectors(letters(words[some].tolist()))
                for length, gains, losses, point in ((size, 0, 0, True), (size, 1, 1, False), (size + 1, 1, 0, False), (size - 1, 0, 1, False)):
                    found = list(reached(trees.get(length, (0,)), counts, gains, losses))
                    rows = some[np.concatenate([r for _, r in found])]
                    cells = np.repeat([c for c, _ in found], [len(r) for _, r in found])
                    for i in range(0, len(rows), 50_000):
                        at = rows[i : i + 50_000]
                        yield pd.DataFrame({"length": length, "cell": cells[i : i + 50_000], "point": point, "word": words[at], "n": times[at]})

    return run


def _leaves(counts: np.ndarray) -> list[np.ndarray]:
    """Rows of the leaves of a k-d tree."""
    out, waiting = [], [np.arange(len(counts))]
    while waiting:
        rows = waiting.pop()
        some = counts[rows]
        cut = _halves(some) if len(rows) > LEAF else None
        if cut is None:
            out += [rows[i : i + LEAF] for i in range(0, len(rows), LEAF)]
        else:
            left = some[:, cut[0]] <= cut[1]
            waiting += [rows[left], rows[~left]]
    return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one replaced letter, or by one that the longer rows have more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    n, length = a.shape
    head, tail = a != b[:, :-1], (a != b[:, 1:])[:, ::-1]
    before = np.where(head.any(axis=1), head.argmax(axis=1), length)
    behind = np.where(tail.any(axis=1), tail.argmax(axis=1), length)
    return before + behind >= length


def near_pairs(queries: list[str], points: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and points that are one edit apart; queries have one length and points one."""
    a, b = letters(queries), letters(points)
    x, y = vectors(a), vectors(b)
    used = (x.any(axis=0)) | (y.any(axis=0))
    # Distances are the two lengths together at most.
    kind = np.int8 if a.shape[1] + b.shape[1] < 127 else np.int32
    x, y = np.ascontiguousarray(x[:, used], dtype=kind), np.ascontiguousarray(y[:, used], dtype=kind)
    longer = b.shape[1] - a.shape[1]
    most = 2 if longer == 0 else 1
    leaves = _leaves(y)
    order, starts = np.concatenate(leaves), np.cumsum([0, *map(len, leaves)])
    low = np.minimum.reduceat(y[order], starts[:-1], axis=0)
    high = np.maximum.reduceat(y[order], starts[:-1], axis=0)
    sizes = np.diff(starts)
    out_x, out_y = [], []
    step = max(1, AT_ONCE // max(1, len(leaves) * x.shape[1]))
    for first in range(0, len(x), step):
        some = x[first : first + step]
        near = np.zeros((len(some), len(leaves)), dtype=kind)
        for place in range(x.shape[1]):
            value = some[:, place, None]
            near += np.maximum(np.maximum(low[:, place] - value, value - high[:, place]), 0)
        row, leaf = np.nonzero(near <= most)
        times = sizes[leaf]
        ends = np.cumsum(times)
        total = int(ends[-1]) if len(ends) else 0
        pair_step = max(1, AT_ONCE // max(1, max(x.shape[1], a.shape[1], b.shape[1])))
        rows = np.repeat(row + first, times)
        spots = order[np.arange(total) - np.repeat(ends - times, times) + np.repeat(starts[leaf], times)]
        for i in range(0, total, pair_step):
            r, s = rows[i : i + pair_step], spots[i : i + pair_step]
            close = np.abs(x[r] - y[s]).sum(axis=1, dtype=kind) <= most
            r, s = r[close], s[close]
            edit = one_edit(a[r], b[s])
            out_x.append(r[edit])
            out_y.append(s[edit])
    empty = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(out_x or empty), np.concatenate(out_y or empty)


PARTIAL = "word string, n_near long, form_n long, form string"


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For the queries of a part: near words counted, and the best of them."""
    for group in whole_groups(batches, ["length", "cell", "part"]):
        points = group[group["point"]]
        if not len(points):
            continue
        words, n = points["word"].to_numpy(), points["n"].to_numpy()
        # In the order of rank, so that the first near word is the best one.
        best_first = np.lexsort((words, -n))
        words, n = words[best_first], n[best_first]
        asked = group[~group["point"]]["word"]
        sizes = asked.str.len().to_numpy()
        for size in np.unique(sizes).tolist():
            queries = asked[sizes == size].to_numpy()
            a, b = near_pairs(queries.tolist(), words.tolist())
            if len(a):
                count = np.bincount(a, minlength=len(queries))
                best = np.full(len(queries), len(words), dtype=np.int64)
                np.minimum.at(best, a, b)
                rows = np.flatnonzero(count)
                yield pd.DataFrame({"word": queries[rows], "n_near": count[rows], "form_n": n[best[rows]], "form": words[best[rows]]})


def _trees(words: DataFrame) -> dict[int, tuple]:
    """Upper trees by length, cut by ``SAMPLE`` words at most, chosen by hash."""
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    unit = F.pmod(F.xxhash64("word", F.lit("tree")), F.lit(1 << 30)) / float(1 << 30)
    # Long words tell little and weigh much; one tree cell holds all of a rare length.
    chosen = words.where((unit < share) & (F.length("word") <= 64)).select("word").limit(2 * SAMPLE).toPandas()["word"]
    sizes = chosen.str.len()
    leaf = max(1, round(CELL * share))
    return {int(s): upper_tree(vectors(letters(chosen[sizes == s].tolist())), leaf, 0) for s in sizes.unique()}


def _roots(edges: DataFrame) -> DataFrame:
    """``word, root`` of words with a form: forms are followed to the last. Each round doubles the steps that are taken."""
    found = kept(edges.select("word", F.col("form").alias("root")))
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = kept(found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        found = more.select("word", "root")
        if more.where("moved").isEmpty():
            return found


def group_variants(words: DataFrame, word: str = "word", n: str = "n", times: int = 5) -> DataFrame:
    """``word, n, form, root, n_near, form_n`` of distinct words of ASCII small letters and U+00C0 to U+00FF.

    Near words differ by exactly one inserted, deleted or replaced letter. ``form`` is the near word of largest ``n``
    (ties: the smallest) if it occurs ``times`` times as often or more; ``root`` is the end of the chain of forms, the word itself if it
    has none. Null and empty words are left out. Empty tables give empty results; other columns are not looked at.
    """
    known = kept(words.select(F.col(word).alias("word"), F.col(n).cast("long").alias("n")).where(F.length(word) > 0))
    dealt = kept(known.mapInPandas(_dealt(_trees(known)), "length long, cell long, point boolean, word string, n long"))
    cells = splittable(dealt.where("point").groupBy("length", "cell").agg(F.ceil(F.count("*") / PART).alias("parts")))
    mine: Column = F.pmod(F.xxhash64("word", F.lit("part")), F.col("parts"))
    part = F.explode(F.when(F.col("point"), F.array(mine)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).alias("part")
    rows = dealt.join(cells, ["length", "cell"]).select("length", "cell", part, "point", "word", "n")
    keys = ["length", "cell", "part"]
    found = rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_compared, PARTIAL)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    near = kept(found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")))
    joined = known.join(near, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    formed = kept(joined.select("word", "n", F.when(enough, F.col("best.form")).alias("form"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n")))
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
