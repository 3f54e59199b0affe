import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from momentloom.operators import ordered, sequences, splits


@pytest.fixture(autouse=True, params=[True, False], ids=["few tasks", "many tasks"])
def spread(request, spark):
    """Small tables in one partition, then in as many as a large table would have."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(request.param).lower())
    yield request.param
    spark.conf.set(name, "true")


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 holds a third of all rows, group 1 a fifth, many others a few each."""
    rng = np.random.default_rng(3)
    n = 900
    group = np.where(rng.random(n) < 0.34, 0, np.where(rng.random(n) < 0.3, 1, rng.integers(2, 60, n)))
    pdf = pd.DataFrame({"g": group, "t": rng.permutation(n) * 0.5, "v": np.round(rng.normal(20, 9, n), 2), "id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def rows_per_part(df, by, order):
    return ordered.place(df, by, order).rows.groupBy("_part").count().toPandas()["count"]


def test_groups_nulls_and_ties_spread_over_tasks(spark, skewed, spread):
    if spread:
        return
    n = 4000
    base = spark.range(n).select("id", F.lit(1.0).alias("v"))
    one_group = base.select("*", F.lit(1).alias("g"), F.col("id").alias("t"))
    null_group = base.select("*", F.lit(None).cast("int").alias("g"), F.col("id").alias("t"))
    one_value = base.select("*", F.lit(1).alias("g"), F.lit(5).alias("t"))
    for df in (one_group, null_group, one_value):
        assert rows_per_part(df, "g", "t").max() < n / 3
        assert sorted(r["step"] for r in ordered.step_number(df, "g", "t").collect()) == list(range(1, n + 1))
        assert max(r["running_total"] for r in ordered.running_total(df, "g", "t", "v").collect()) == n
        ratios = [r["cumulative_ratio"] for r in ordered.cumulative_ratio(df, "v", "t", "g").collect()]
        assert len(ratios) == n and max(ratios) == pytest.approx(1.0)
    assert rows_per_part(skewed[1], "g", "t").max() < 400


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (None, 1, 3.0), (None, 2, 1.0), (1, 2, None), (2, 1, 0.0)], "g int, t int, v double")
    got = {(r["g"], r["t"]): r["cumulative_ratio"] for r in ordered.cumulative_ratio(df, "v", "t", "g").collect()}
    assert got == {(1, 1): 1.0, (None, 1): 0.75, (None, 2): 1.0, (1, 2): 1.0, (2, 1): None}


def test_running_values(skewed):
    pdf, df = skewed
    s = pdf.sort_values("t")
    total = by_id(ordered.running_total(df, "g", "t", "v"), "running_total")
    want = s.assign(w=s.groupby("g")["v"].cumsum()).set_index("id")["w"]
    assert all(total[i] == pytest.approx(want[i]) for i in want.index)
    top = by_id(ordered.running_max(df, "g", "t", "v"), "running_max")
    want = s.assign(w=s.groupby("g")["v"].cummax()).set_index("id")["w"]
    assert all(top[i] == want[i] for i in want.index)
    step = by_id(ordered.step_number(df, "g", "t"), "step")
    want = s.assign(w=s.groupby("g").cumcount() + 1).set_index("id")["w"]
    assert all(step[i] == want[i] for i in want.index)


def test_following_row(skewed):
    pdf, df = skewed
    got = by_id(ordered.following(df, "g", "t", ["id"]), "next_id")
    s = pdf.sort_values("t")
    want = s.assign(w=s.groupby("g")["id"].shift(-1)).set_index("id")["w"]
    for i in want.index:
        assert (got[i] is None and np.isnan(want[i])) or got[i] == want[i]


def test_following_row_of_large_and_small_groups(spark, monkeypatch):
    """Only groups beyond the bound are spread; both forms give the rows, null groups and ties included."""
    rows = [(g, t, i) for i, (g, t) in enumerate([(None, t) for t in range(30)] + [(1, t) for t in range(40)] + [(2, 2), (2, 1), (2, 1), (3, 5)])]
    df = spark.createDataFrame(rows, "g int, t int, id int")
    whole = sorted(map(tuple, ordered.following(df, "g", "t", ["t", "id"]).collect()), key=str)
    monkeypatch.setattr(ordered, "WHOLE_GROUP", 10)
    assert sorted(map(tuple, ordered.following(df, "g", "t", ["t", "id"]).collect()), key=str) == whole
    after = {r[2]: r[4] for r in whole}
    assert [after[i] for i in (28, 29, 30, 68, 69, 70, 73)] == [29, None, 31, 69, None, None, None] and after[71] in (72, 70) and len(whole) == 74


def test_small_groups_take_one_shuffle(spark):
    points = spark.range(300).select((F.col("id") % 7).alias("seq_id"), F.col("id").alias("step"), F.sin("id").alias("x"), F.cos("id").alias("y"))
    made = sequences.sequence_features(points)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1 and "hashpartitioning(seq_id" in plan


def test_running_best_and_final_best_agree(skewed):
    pdf, df = skewed
    best = ordered.running_best(df, "g", "t", "v").toPandas()
    want = []
    for g, part in pdf.sort_values("t").groupby("g"):
        bar = 10.0
        for t, v in zip(part["t"], part["v"]):
            if v > bar:
                bar = v
                want.append((g, t, v))
    assert sorted(best.itertuples(index=False, name=None)) == sorted(want)
    last = best.sort_values("t").groupby("g").tail(1).set_index("g")
    final = ordered.final_best(df, "g", "t", "v").toPandas().set_index("g")
    assert final["best"].to_dict() == last["best"].to_dict()
    assert final["last_improvement"].to_dict() == last["t"].to_dict()


def test_row_index_over_many_partitions(spark):
    df = spark.range(1000).select(F.pmod(F.col("id") * 7919, F.lit(1000)).alias("k"), F.pmod("id", F.lit(3)).alias("third"))
    got = ordered.with_row_index(df, ["third", "k"]).toPandas()
    want = got.sort_values(["third", "k"]).reset_index(drop=True)
    assert list(want["row_id"]) == list(range(1000))


def test_row_index_of_empty_table(spark):
    assert ordered.with_row_index(spark.range(0), ["id"]).count() == 0


def test_best_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 1.0), (3, float("nan")), (4, None)], "candidate int, score double")
    assert ordered.best(df, "score", "candidate").first()["candidate"] == 1
    assert ordered.best(df, "score", "candidate", smallest=False).first()["candidate"] == 0
    assert ordered.best(df.where("candidate > 2"), "score", "candidate").count() == 0


def test_sequence_features_do_not_depend_on_cuts(spark):
    angle = F.col("id") * 0.1
    points = spark.range(300).select(F.lit(1).alias("seq_id"), F.col("id").alias("step"), F.cos(angle).alias("x"), F.sin(angle).alias("y"))
    whole = sequences.sequence_features(points).first()
    x, y = np.cos(np.arange(300) * 0.1), np.sin(np.arange(300) * 0.1)
    assert whole["n_points"] == 300
    assert whole["path_length"] == pytest.approx(np.hypot(np.diff(x), np.diff(y)).sum())
    assert whole["mean_turn"] == pytest.approx(np.sin(0.1))
    assert whole["signed_area"] == pytest.approx(299 * np.sin(0.1))


def test_long_heads_and_samples_use_the_row_index(spark):
    df = spark.range(200).select((F.lit(500) - F.col("id")).alias("k"))
    short = [sorted(r["k"] for r in d.collect()) for d in (ordered.head(df, ["k"], 60), splits.sample_k(df, "k", 60, 1))]
    long = [sorted(r["k"] for r in d.collect()) for d in (ordered.long_head(df, ["k"], 60), splits.large_sample(df, "k", 60, 1))]
    assert short == long and len(long[0]) == 60
