"""Chained steps: choose columns, standardise them, fit a model; fitted once, applied to any rows.

The order in which steps are given does not matter where it only costs work: columns are chosen
before they are standardised, so the scans read no others, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from momentloom.operators import linear
from momentloom.operators.linear import LinearModel, Standardizer


@dataclass(frozen=True)
class Select:
    """Keep these features; the target and the columns to carry along are kept anyway."""

    features: tuple[str, ...]


@dataclass(frozen=True)
class Standardize:
    """Centre the features and scale them to unit deviation."""


@dataclass(frozen=True)
class Regress:
    """Least squares on all features, with a penalty if ``lam`` is positive."""

    target: str
    lam: float = 0.0


@dataclass(frozen=True)
class Fitted:
    features: tuple[str, ...]
    scaler: Standardizer | None
    model: LinearModel | None

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The features after all steps beside the columns ``keep``, and ``prediction`` if there is a model."""
        rows = df.select(*dict.fromkeys([*keep, *self.features]))
        rows = self.scaler.apply(rows) if self.scaler else rows
        return self.model.predict(rows) if self.model else rows


def pipeline(steps: Sequence[Select | Standardize | Regress], df: DataFrame, features: Sequence[str]) -> Fitted:
    """Fit the steps on ``df``, whose ``features`` are those that no ``Select`` has narrowed."""
    chosen = list(features)
    for step in steps:
        if isinstance(step, Select):
            missing = [c for c in step.features if c not in chosen]
            if missing:
                raise ValueError(f"no such features: {missing}")
            chosen = [c for c in chosen if c in step.features]
    targets = [s for s in steps if isinstance(s, Regress)]
    if len(targets) > 1:
        raise ValueError("a chain has one model at most")
    scaler = linear.standardize_fit(df, chosen) if any(isinstance(s, Standardize) for s in steps) else None
    if not targets:
        return Fitted(tuple(chosen), scaler, None)
    rows = df.select(targets[0].target, *chosen)
    rows = scaler.apply(rows) if scaler else rows
    return Fitted(tuple(chosen), scaler, linear.ridge(rows, targets[0].target, chosen, targets[0].lam))
