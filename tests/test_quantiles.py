import numpy as np
import pytest

from momentloom.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def check(spark, values, **kwargs):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    got = exact_quantiles(df, ["v"], PROBS, **kwargs)["v"]
    known = np.array([v for v in values if v is not None], dtype=float)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("accuracy,small", [(10_000, 4_096), (50, 20), (20, 2)])
@pytest.mark.parametrize("kind", ["normal", "heavy tail", "few values", "one hot value", "two values"])
def test_against_numpy(spark, kind, accuracy, small):
    rng = np.random.default_rng(5)
    values = {
        "normal": rng.normal(size=3001),
        "heavy tail": np.exp(8 * rng.normal(size=2500)),
        "few values": rng.integers(0, 4, 3000),
        "one hot value": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(size=3000) * 10),
        "two values": np.repeat([1.0, 2.0], 1000),
    }[kind]
    check(spark, list(values), accuracy=accuracy, small=small)


def test_small_tables_and_nulls(spark):
    check(spark, [3.0])
    check(spark, [1.0, None, 2.0, None])
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": {0.5: None}}


def test_two_heavy_ends_with_few_between(spark):
    check(spark, [0.0] * 500 + [1.0, 2.0, 3.0] + [9.0] * 500, accuracy=20, small=2)
    check(spark, [0.0] * 500 + [1.0, 2.0] + [9.0] * 500, accuracy=20, small=2)


def test_infinite_neighbours(spark):
    inf = float("inf")
    for values, median in (([1.0, inf, inf], inf), ([-inf, -inf, 3.0], -inf), ([-inf, 2.0, inf], 2.0), ([1.0, 2.0, inf, inf], inf), ([inf], inf)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert exact_quantiles(df, ["v"], [0.5])["v"][0.5] == median
