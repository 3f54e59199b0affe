"""Exact quantiles of whole columns without sorting them and without holding their values.

The built-in exact ``percentile`` keeps every distinct value in its buffer and sorts it in one
task. Here a rank is enclosed instead: ``percentile_approx`` (a mergeable sketch) proposes an
interval, one aggregate counts the rows below and inside it, and the interval shrinks until it
holds few rows or a single value. Only that proven small remainder is collected. With the default
accuracy each round shrinks the interval by some thousand times, so 10**12 rows need four.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import floor

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ACCURACY = 10_000
SMALL_REMAINDER = 4_096


@dataclass
class _Target:
    col: str
    prob: float
    position: float
    lo: float
    hi: float
    low_end: float
    high_end: float
    margin: float
    below: int = 0
    inside: int = 0
    values: list[float] = field(default_factory=list)

    @property
    def first(self) -> int:
        return floor(self.position)

    def last(self, n: int) -> int:
        return min(self.first + 1, n - 1)

    def condition(self):
        return F.col(self.col).between(F.lit(self.lo), F.lit(self.hi))


def _bracket(prob: float, margin: float) -> list[float]:
    return [max(0.0, prob - margin), min(1.0, prob + margin)]


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    accuracy: int = ACCURACY,
    small: int = SMALL_REMAINDER,
) -> dict[str, dict[float, float | None]]:
    """Quantiles with linear interpolation between neighbours, for each column and probability.

    Nulls are left out. A column without values gives None. An interval of up to ``small`` rows is collected.
    """
    return quantiles_beside(df, cols, probs, (), accuracy, small)[0]


def quantiles_beside(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    others: Sequence[Column],
    accuracy: int = ACCURACY,
    small: int = SMALL_REMAINDER,
) -> tuple[dict[str, dict[float, float | None]], Row]:
    """The same, with the row of further aggregates of ``df`` that the first pass takes along."""
    number = [F.col(c).cast("double") for c in cols]
    data = df.select(*[v.alias(c) for v, c in zip(number, cols)])
    margin = 4.0 / accuracy
    wanted = sorted({b for p in probs for b in _bracket(p, margin)})
    first = df.agg(
        *[F.count(v).alias(f"_n_{i}") for i, v in enumerate(number)],
        *[F.min(v).alias(f"_lo_{i}") for i, v in enumerate(number)],
        *[F.max(v).alias(f"_hi_{i}") for i, v in enumerate(number)],
        *[F.percentile_approx(v, wanted, accuracy).alias(f"_q_{i}") for i, v in enumerate(number)],
        *others,
    ).first()

    result: dict[str, dict[float, float | None]] = {c: {} for c in cols}
    sizes: dict[str, int] = {}
    targets: list[_Target] = []
    for i, c in enumerate(cols):
        n = sizes[c] = first[f"_n_{i}"]
        if n == 0:
            result[c] = {p: None for p in probs}
            continue
        ends = first[f"_lo_{i}"], first[f"_hi_{i}"]
        guess = dict(zip(wanted, first[f"_q_{i}"]))
        for p in probs:
            low, high = _bracket(p, margin)
            lo = guess[low] if low > 0 else ends[0]
            hi = guess[high] if high < 1 else ends[1]
            targets.append(_Target(c, p, p * (n - 1), lo, hi, *ends, margin))

    open_targets = list(targets)
    while open_targets:
        counted = data.agg(
            *[F.count_if(F.col(t.col) < t.lo).alias(f"below_{i}") for i, t in enumerate(open_targets)],
            *[F.count_if(t.condition()).alias(f"inside_{i}") for i, t in enumerate(open_targets)],
        ).first()
        to_shrink = []
        missed = []
        for i, t in enumerate(open_targets):
            t.below, t.inside = counted[f"below_{i}"], counted[f"inside_{i}"]
            n = sizes[t.col]
            if t.below > t.first or t.below + t.inside <= t.last(n):
                # The sketch missed the rank: widen on the side it missed, and trust it less.
                t.margin *= 4
                if t.below > t.first:
                    t.lo = t.low_end
                if t.below + t.inside <= t.last(n):
                    t.hi = t.high_end
                missed.append(t)
            elif t.lo < t.hi and t.inside > small:
                to_shrink.append(t)
        if to_shrink:
            rows = data.agg(
                *[
                    F.percentile_approx(
                        F.when(t.condition(), F.col(t.col)),
                        _bracket((t.position - t.below) / (t.inside - 1), t.margin),
                        accuracy,
                    ).alias(f"q_{i}")
                    for i, t in enumerate(to_shrink)
                ]
            ).first()
            stuck = []
            for i, t in enumerate(to_shrink):
                lo, hi = rows[f"q_{i}"]
                if (lo, hi) == (t.lo, t.hi):
                    stuck.append(t)
                t.low_end, t.high_end = t.lo, t.hi
                t.lo, t.hi = lo, hi
            for t in stuck:
                # Two values share nearly all rows of the interval: look at the values themselves.
                _settle_by_counts(data, t, sizes[t.col])
            to_shrink = [t for t in to_shrink if not t.values]
        open_targets = missed + to_shrink

    remaining = [t for t in targets if not t.values and t.lo < t.hi]
    if remaining:
        got = data.agg(
            *[F.sort_array(F.collect_list(F.when(t.condition(), F.col(t.col)))).alias(f"v_{i}") for i, t in enumerate(remaining)]
        ).first()
        for i, t in enumerate(remaining):
            inside = got[f"v_{i}"]
            t.values = [inside[t.first - t.below], inside[t.last(sizes[t.col]) - t.below]]
    for t in targets:
        a, b = t.values or (t.lo, t.lo)
        part = t.position - t.first
        # Between equal or infinite neighbours the difference is not a number; the rank itself needs none.
        result[t.col][t.prob] = a if part == 0 or a == b else a + part * (b - a)
    return result, first


def _settle_by_counts(data: DataFrame, t: _Target, n: int) -> None:
    """Find the two neighbours of a rank by counting rows at and around the interval's ends."""
    c = F.col(t.col)
    row = data.agg(
        F.count_if(c <= t.lo).alias("to_lo"),
        F.min(F.when(c > t.lo, c)).alias("above_lo"),
        F.max(F.when(c < t.hi, c)).alias("under_hi"),
        F.count_if(c < t.hi).alias("to_under_hi"),
    ).first()

    def value_at(rank: int) -> float | None:
        if rank < row["to_lo"]:
            return t.lo
        if rank >= row["to_under_hi"]:
            return t.hi
        if rank == row["to_lo"]:
            return row["above_lo"]
        if rank == row["to_under_hi"] - 1:
            return row["under_hi"]
        return None

    pair = [value_at(t.first), value_at(t.last(n))]
    if None not in pair:
        t.values = pair
        return
    # Both neighbours lie strictly between the ends: leave the two heavy values out and go on.
    t.lo, t.hi = row["above_lo"], row["under_hi"]
