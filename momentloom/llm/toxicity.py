"""Severity grades of toxic texts by ordinal regression with a cumulative logit link.

The chance that a text is of a grade above k is ``sigmoid(s - threshold[k])``, where ``s`` sums the weights of
the text's sparse features; the weights are shared by all thresholds, which are in order. The expected
severity is the sum of these chances over the thresholds, from 0 to the highest grade.

Features are words and their beginnings of four to seven letters, in lower case. Each has two columns: whether the
text holds it, and the logarithm of one plus its occurrences per hundred words. Only features that labelled
toxic texts hold clearly more often than others are kept (``ODDS``, ``EVIDENCE``), so that long clean texts
gather nothing. Copies of a text count once in the choice and the fit.

The labels say only whether a text is toxic. Grade 0 is a text that is not; the grades 1 to ``GRADES`` - 1
split the toxic ones evenly by the share of their words that have a kept feature, a weak label for severity.

A null or empty text has no feature, and its severity is that of the thresholds alone. Rows with a null label
or id teach nothing. Without texts of both labels the severity is 0. Whole texts are read, repeated rows are
scored alike, and ``severity`` is a column function: other columns keep their names and values.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentloom.llm.common import kept, sampled
from momentloom.llm.words import WORD

GRADES = 4
PREFIXES = (4, 5, 6, 7)
#: Labelled texts of either kind that the model learns from, about.
PER_LABEL = 6_000
#: Least ratio of the shares of toxic and other texts that hold a feature, least G statistic against independence
#: (about twice the logarithm of the number of words that are tried). The bounded sample bounds the features; none that passes is dropped.
ODDS = 10.0
EVIDENCE = 20.0
RIDGE = 1.0
STEPS = 1_500
#: Words whose features a worker remembers between batches. It changes no result.
REMEMBERED = 200_000


def word_features(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


@dataclass(frozen=True)
class Model:
    """Both weights of each feature, and thresholds in order; no thresholds where nothing could be learned."""

    weights: dict[str, tuple[float, float]]
    thresholds: tuple[float, ...]


class _Reader:
    """Occurrences of the chosen features in texts."""

    def __init__(self, chosen: dict[str, int]):
        self.chosen, self.known = chosen, {}

    def read(self, text: str) -> tuple[dict[int, int], int, int]:
        """Occurrences by feature, words that have one, and words."""
        words = WORD.findall(text.lower())
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for w in words:
            if w not in self.known:
                self.known[w] = tuple(self.chosen[f] for f in word_features(w) if f in self.chosen)
        found = [self.known[w] for w in words if self.known[w]]
        counts: dict[int, int] = {}
        for features in found:
            for f in features:
                counts[f] = counts.get(f, 0) + 1
        return counts, len(found), len(words)


def _entries(counts: dict[int, int], words: int) -> tuple[list[int], list[float]]:
    """Columns and values of a text: for each feature that it holds, 1, and the logarithm of its density."""
    columns = [2 * f for f in counts] + [2 * f + 1 for f in counts]
    return columns, [1.0] * len(counts) + [float(np.log1p(100 * c / words)) for c in counts.values()]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def ordinal(rows: np.ndarray, features: np.ndarray, values: np.ndarray, grade: np.ndarray, width: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and thresholds of the most likely cumulative logit model, by Adam on the mean loss.

    ``rows, features, values`` are the entries of the sparse matrix. Grade 0 and the others together weigh the
    same, however many texts each has. Thresholds are the first one and the logarithms of the steps to the next,
    which keeps them in order.
    """
    n = len(grade)
    share = np.where(grade == 0, 0.5 / max(1, (grade == 0).sum()), 0.5 / max(1, (grade > 0).sum()))
    w, first, steps = np.zeros(width), np.zeros(1), np.zeros(grades - 2)
    moments = [np.zeros(width + grades - 1), np.zeros(width + grades - 1)]
    for t in range(1, STEPS + 1):
        score = np.bincount(rows, weights=values * w[features], minlength=n)
        cuts = np.r_[first, first + np.cumsum(np.exp(steps))]
        edges = np.r_[-np.inf, cuts, np.inf]
        upper, lower = _sigmoid(edges[grade + 1] - score), _sigmoid(edges[grade] - score)
        upper, lower = np.where(grade == grades - 1, 1.0, upper), np.where(grade == 0, 0.0, lower)
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        up, low = up * share, low * share
        slope = np.bincount(features, weights=values * (up - low)[rows], minlength=width) + RIDGE * w / n
        at_cut = np.array([low[grade == k + 1].sum() - up[grade == k].sum() for k in range(grades - 1)])
        after = np.cumsum(at_cut[::-1])[::-1]
        gradient = np.r_[slope, after[0], after[1:] * np.exp(steps)]
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = 0.02 * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-9)
        w, first, steps = w - move[:width], first - move[width], steps - move[width + 1 :]
    return w, np.r_[first, first + np.cumsum(np.exp(steps))]


def fit(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, bound: int = PER_LABEL) -> Model:
    """A model from about ``bound`` toxic texts and as many others, chosen by a hash of the id.

    The sample of labels has a stated size, so it is broadcast; the documents are read once and not shuffled.
    """
    marks = labels.select(F.col(label_id).alias("k"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    marks = sampled(marks, ["y"], bound, "k")
    texts = docs.select(F.col(doc_id).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = kept(texts.join(F.broadcast(marks), "k").select("y", "t").distinct())

    def presence(batches):
        for batch in batches:
            for y, t in zip(batch["y"], batch["t"]):
                found = {f for w in set(WORD.findall(t.lower())) for f in word_features(w)}
                yield pd.DataFrame({"y": y, "f": sorted(found)})

    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Model({}, ())
    counts = rows.mapInPandas(presence, "y int, f string").groupBy("f").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))
    bad, rest = F.col("bad"), F.col("n") - F.col("bad")
    ratio = (bad / sizes[1]) / ((rest + 0.5) / sizes[0])
    base = sizes[1] / (sizes[0] + sizes[1])
    surprise = lambda seen, share: F.when(seen > 0, 2 * seen * F.log(seen / (F.col("n") * share))).otherwise(0.0)
    evidence = surprise(bad, base) + surprise(rest, 1 - base)
    chosen = counts.where((bad > 0) & (ratio >= ODDS) & (evidence >= EVIDENCE)).orderBy(F.desc("bad"), "f")
    names = [r["f"] for r in chosen.select("f", "bad").collect()]
    if not names:
        return Model({}, ())
    number = {f: i for i, f in enumerate(names)}

    def entries(batches):
        reader = _Reader(number)
        for batch in batches:
            read = [reader.read(t) for t in batch["t"]]
            pairs = [_entries(c, n) for c, _, n in read]
            yield pd.DataFrame({
                "y": batch["y"],
                "share": [hit / max(1, n) for _, hit, n in read],
                "columns": [c for c, _ in pairs],
                "data": [v for _, v in pairs],
            })

    told = rows.mapInPandas(entries, "y int, share double, columns array<int>, data array<double>").collect()
    told = sorted(told, key=lambda r: (r["y"], r["share"], r["columns"], r["data"]))
    y, share = np.array([r["y"] for r in told]), np.array([r["share"] for r in told])
    cuts = np.quantile(share[y == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(y == 1, 1 + np.searchsorted(cuts, share, side="left"), 0)
    index = np.repeat(np.arange(len(told)), [len(r["columns"]) for r in told])
    columns = np.array([c for r in told for c in r["columns"]], dtype=np.int64)
    values = np.array([v for r in told for v in r["data"]])
    w, thresholds = ordinal(index, columns, values, grade, 2 * len(names), GRADES)
    return Model({f: (w[2 * i], w[2 * i + 1]) for i, f in enumerate(names)}, tuple(thresholds.tolist()))


def severity(text: Column, model: Model) -> Column:
    """``struct<severity, grade, toxic>``: the expected grade, the likeliest one, and whether it is above 0 by a chance over one half."""
    names = list(model.weights)
    weights = np.array([w for f in names for w in model.weights[f]])
    reader = _Reader({f: i for i, f in enumerate(names)})

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def graded(texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        if not model.thresholds:
            return pd.DataFrame({"severity": np.zeros(n), "grade": np.zeros(n, dtype=np.int32), "toxic": np.zeros(n, dtype=bool)})
        score = np.zeros(n)
        for i, t in enumerate(texts.fillna("")):
            counts, _, words = reader.read(t)
            if counts:
                columns, values = _entries(counts, words)
                score[i] = weights[columns] @ np.array(values)
        above = _sigmoid(score[:, None] - np.array(model.thresholds))
        chance = -np.diff(np.c_[np.ones(n), above, np.zeros(n)], axis=1)
        return pd.DataFrame({"severity": above.sum(axis=1), "grade": chance.argmax(axis=1).astype(np.int32), "toxic": above[:, 0] > 0.5})

    return graded(text)
