"""Saved models and the metrics log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model, path: str) -> None:
    """Write a fitted model; folders are made as needed and an older model is replaced."""
    model.write().overwrite().save(path)


def load_model(path: str, kind=PipelineModel):
    """Read a saved model; ``kind`` is its class where it is not a pipeline."""
    return kind.load(path)


def metrics_rows(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """One row per logged step, as a table."""
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def log_metrics(rows: DataFrame, path: str) -> None:
    """Append to the log folder; readers see whole appends only."""
    rows.write.mode("append").parquet(path)
