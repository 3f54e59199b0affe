"""Samples, shared folders and groups across batches."""

from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from momentloom.llm.common import kept, sampled, shared_folder
from momentloom.llm.graph import forest, whole_groups


def test_samples_are_bounded_and_the_same_on_every_run(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, "a").when(F.col("id") < 4900, "b").alias("l"))
    found = sampled(df, ["l"], 300, "id")
    counts = {r["l"]: r["n"] for r in found.groupBy("l").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["a"] - 300) < 90 and abs(counts["b"] - 300) < 90 and counts[None] == 100
    again = sampled(df.repartition(7), ["l"], 300, "id")
    assert {r["id"] for r in found.collect()} == {r["id"] for r in again.collect()}
    assert sampled(df.where("id < 0"), ["l"], 10, "id").count() == 0
    assert sampled(df.select(F.lit(None).cast("long").alias("id"), "l"), ["l"], 10, "id").count() == 0


def test_a_cluster_must_name_its_shared_folder():
    session = lambda master, **conf: SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)))
    assert shared_folder(session("yarn", spark_checkpoint_dir="hdfs:///x")) == "hdfs:///x"
    assert shared_folder(session("local[8]", spark_sql_warehouse_dir="/w")) == "/w/_checkpoints"
    for master in ("yarn", "spark://a:1", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_kept_tables_have_no_lineage(spark):
    df = kept(spark.range(10).selectExpr("id * 2 as v"))
    assert "Range" not in df._jdf.queryExecution().toString() and sorted(r["v"] for r in df.collect()) == list(range(0, 20, 2))


def test_groups_lie_whole_wherever_batches_end():
    rows = pd.DataFrame({"a": [1, 1, 1, 2, 2, 3, 3, 3, 3], "b": [0, 0, 1, 1, 1, 1, 1, 2, 2], "v": range(9)})
    want = [list(g["v"]) for _, g in rows.groupby(["a", "b"])]
    for size in range(1, 10):
        batches = [rows.iloc[i : i + size] for i in range(0, 9, size)] + [rows.iloc[:0]]
        assert [list(g["v"]) for g in whole_groups(iter(batches), ["a", "b"])] == want
    assert list(whole_groups(iter([]), ["a"])) == []


def test_forests_connect_what_the_pairs_connect():
    import numpy as np

    a, b = np.array([1, 2, 3, 7, 1]), np.array([2, 3, 1, 8, 3])
    assert sorted(forest(a, b)) == [(1, 2), (2, 3), (7, 8)]
