import pytest
from pyspark.sql import functions as F

from momentloom.operators import splits


@pytest.fixture(scope="module")
def ten(spark):
    return spark.range(10).withColumnRenamed("id", "row_id")


def sets(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["split"], r["role"]), set()).add(r["row_id"])
    return out


def test_blocks_are_filled_to_the_ceiling(ten):
    blocks = sets(splits.train_blocks(ten, 10, 4))
    assert [len(blocks[(i, "train")]) for i in (1, 2, 3, 4)] == [3, 3, 3, 1]


def test_too_few_blocks_is_an_error_at_once(ten):
    with pytest.raises(ValueError, match="5 of 6"):
        splits.independent_cv(ten, 10, 6)
    with pytest.raises(ValueError):
        splits.independent_cv(ten, 10, 1)
    with pytest.raises(ValueError):
        splits.standard_cv(ten, 10, 11)


def test_independent_cv_validates_on_the_next_block(ten):
    parts = sets(splits.independent_cv(ten, 10, 4))
    for i in range(1, 5):
        after = i % 4 + 1
        assert parts[(i, "val")] == parts[(after, "train")]
        assert not parts[(i, "val")] & parts[(i, "train")]
    assert set().union(*(parts[(i, "train")] for i in range(1, 5))) == set(range(10))


def test_standard_cv_leaves_rows_that_are_never_tested(ten):
    parts = sets(splits.standard_cv(ten, 10, 3))
    assert [sorted(parts[(i, "test")]) for i in (1, 2, 3)] == [[3, 4, 5], [6, 7, 8], [0, 1, 2]]
    for i in (1, 2, 3):
        assert parts[(i, "train")] == set(range(10)) - parts[(i, "test")]
    assert splits.leftover(10, 3) == 1


def test_even_folds_differ_by_one_row(ten):
    sizes = ten.groupBy(splits.even_fold("row_id", 10, 4).alias("f")).count().collect()
    assert sorted((r["f"], r["count"]) for r in sizes) == [(0, 3), (1, 3), (2, 2), (3, 2)]


def test_splits_do_not_overlap_and_cover_everything(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    exact = splits.train_test_split(df, "k", 0.7, 5, exact=True).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in exact} == {"train": 1400, "test": 600}
    loose = {r["split"]: r["count"] for r in splits.train_test_split(df, "k", 0.7, 5).groupBy("split").count().collect()}
    assert sum(loose.values()) == 2000 and abs(loose["train"] - 1400) < 100
    folds = [r["count"] for r in splits.shuffled_fold(df, "k", 7, 5).groupBy("fold").count().collect()]
    assert sorted(folds) == [285, 285, 286, 286, 286, 286, 286]


def test_split_at_last_differs_from_filter_on_unsorted_rows(ten):
    early = F.col("row_id").isin(0, 1, 5)
    at_last = splits.split_at_last(ten, early).where("split = 'train'").count()
    assert at_last == 6 and splits.split_where(ten, early).where("split = 'train'").count() == 3
    assert splits.split_at_last(ten, F.lit(False)).where("split = 'train'").count() == 0


def test_seeds_give_unrelated_splits(spark):
    df = spark.range(4000)
    both = df.select(F.corr(splits.seeded_hash("id", 1), splits.seeded_hash("id", 2)).alias("r")).first()["r"]
    assert abs(both) < 0.06


def test_sample_without_replacement(spark):
    rows = splits.sample_k(spark.range(392), "id", 50, 9).collect()
    assert len({r["id"] for r in rows}) == 50
