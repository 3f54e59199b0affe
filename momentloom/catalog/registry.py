"""The list of named analyses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Analysis:
    name: str
    run: Run
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Analysis] = {}


def analysis(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with the survey rows it covers."""

    def add(run: Run) -> Run:
        name = run.__name__
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Analysis(name, run, sql, tuple(covers.split()))
        return run

    return add
