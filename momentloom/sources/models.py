"""A table of versioned models: the library's own fitted models, saved as rows and read back.

A row holds name, version, kind and the model's numbers as JSON, which keeps every digit. ``save`` appends one row in one
file, and a file appears whole when its job commits, so a reader sees a model whole or not at all and older
versions stay. Of two writers that take the same version at once, the row of the greater ``stamp`` is that version.
"""

from __future__ import annotations

import json
from dataclasses import fields, is_dataclass
from uuid import uuid4

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.operators.linear import Components, Interval, LinearModel, Standardizer
from momentloom.operators.logistic import LogisticModel
from momentloom.operators.steps import Fitted

SCHEMA = "name string, version long, stamp string, kind string, body string"
KINDS = {kind.__name__: kind for kind in (LinearModel, Interval, Standardizer, Components, LogisticModel, Fitted)}


def encoded(value):
    """Models, tuples and arrays as plain JSON values."""
    if is_dataclass(value):
        if KINDS.get(type(value).__name__) is not type(value):
            raise TypeError(f"{type(value).__name__} is no kind of model that can be saved")
        return {"kind": type(value).__name__, "fields": {f.name: encoded(getattr(value, f.name)) for f in fields(value)}}
    if isinstance(value, np.ndarray):
        return {"shape": value.shape, "cells": value.ravel().tolist()}
    if isinstance(value, (tuple, list)):
        return [encoded(v) for v in value]
    if isinstance(value, np.generic):
        return value.item()
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    raise TypeError(f"{type(value).__name__} cannot be saved")


def decoded(value):
    """What ``encoded`` was given; sequences come back as tuples, as the models hold them."""
    if isinstance(value, dict) and "kind" in value:
        return KINDS[value["kind"]](**{name: decoded(v) for name, v in value["fields"].items()})
    if isinstance(value, dict):
        return np.array(value["cells"], dtype=float).reshape(value["shape"])
    return tuple(map(decoded, value)) if isinstance(value, list) else value


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a model table, one for each name and version; none where the folder does not exist."""
    try:
        rows = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], SCHEMA)
    best = F.max_by(F.struct("stamp", "kind", "body"), "stamp")
    return rows.groupBy("name", "version").agg(best.alias("m")).select("name", "version", "m.*")


def save(spark: SparkSession, model, path: str, name: str) -> int:
    """Append a model under the next version of its name, which is returned; the first is 1."""
    body = json.dumps(encoded(model))
    last = versions(spark, path).where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    row = spark.createDataFrame([(name, version, uuid4().hex, type(model).__name__, body)], SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)
    return version


def load(spark: SparkSession, path: str, name: str, version: int | None = None):
    """The model of a name: its latest version, or the one asked for."""
    rows = versions(spark, path).where(F.col("name") == name)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    row = rows.orderBy(F.desc("version")).select("body").first()
    if row is None:
        raise KeyError(f"no model {name!r}" + ("" if version is None else f" of version {version}"))
    return decoded(json.loads(row["body"]))
